"""Daily, weekly and monthly price summaries (hash aggregations with map-side partials)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.scalars import pct_change


def daily_summary(
    df: DataFrame,
    *,
    order_by: Sequence[str],
    date: str = "date",
    commodity: str = "commodity",
    market: str = "market",
    price: str = "close_price",
    volume: str = "volume",
    source: str | None = None,
) -> DataFrame:
    """Open/high/low/close of the recorded prices, volume and record count per day and market.

    ``order_by`` decides which price is first and last; high and low are taken from the
    recorded price column itself.
    """
    order = F.when(F.col(price).isNotNull(), F.struct(*order_by))
    first, last = F.min_by(price, order), F.max_by(price, order)
    several = F.count(price) > 1
    aggregates = [
        first.alias("open_price"),
        F.max(price).alias("high_price"),
        F.min(price).alias("low_price"),
        last.alias("close_price"),
        F.coalesce(F.sum(volume), F.lit(0.0)).alias("volume"),
        F.count(price).alias("record_count"),
        F.when(several, last - first).alias("price_change"),
        F.when(several, pct_change(last, first)).alias("price_change_pct"),
    ]
    if source:
        aggregates.append(F.count_distinct(source).alias("source_count"))
    return df.groupBy(
        F.col(date).alias("date"), F.col(commodity).alias("commodity"), F.col(market).alias("market")
    ).agg(*aggregates)


def _period_summary(df: DataFrame, groups: list[Column], price: str, volume: str, extra: list[Column]) -> DataFrame:
    return df.groupBy(*groups).agg(
        F.avg(price).alias("avg_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.coalesce(F.sum(volume), F.lit(0.0)).alias("total_volume"),
        *extra,
        F.count(price).alias("record_count"),
    )


def weekly_summary(
    daily: DataFrame, *, date: str = "date", commodity: str = "commodity",
    price: str = "close_price", volume: str = "volume",
) -> DataFrame:
    """Calendar year with ISO week, as the summaries are keyed; undated rows are left out."""
    day = F.col(date)
    return _period_summary(
        daily.filter(day.isNotNull()),
        [F.year(day).alias("year"), F.weekofyear(day).alias("week"), F.col(commodity).alias("commodity")],
        price, volume, [],
    )


def monthly_summary(
    daily: DataFrame, *, date: str = "date", commodity: str = "commodity",
    price: str = "close_price", volume: str = "volume",
) -> DataFrame:
    """Monthly averages with the population deviation as volatility (NULL for one record)."""
    day = F.col(date)
    volatility = F.when(F.count(price) > 1, F.stddev_pop(price)).alias("price_volatility")
    return _period_summary(
        daily.filter(day.isNotNull()),
        [F.year(day).alias("year"), F.month(day).alias("month"), F.col(commodity).alias("commodity")],
        price, volume, [volatility],
    )


def rows_in_range(df: DataFrame, *, column: str, start, end) -> DataFrame:
    """One row: how many rows fall in the closed range."""
    return df.filter(F.col(column).between(start, end)).agg(F.count(F.lit(1)).alias("row_count"))


def distinct_keys(df: DataFrame, *, columns: Sequence[str], limit: int = 10) -> DataFrame:
    """The first ``limit`` distinct key tuples in key order."""
    return df.select(*columns).distinct().orderBy(*columns).limit(limit)
