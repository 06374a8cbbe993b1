"""Analytical views over the price star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.functions.scalars import pct_change
from pricelake.operators.series import over_series, with_group_stats


def price_trends(
    facts: DataFrame, *, order_by: Sequence[str], keys: Sequence[str] = ("commodity",),
    price: str = "close_price", series_rows: int | None = None, **limits,
) -> DataFrame:
    """Previous price of the commodity with absolute and percent change."""
    def build(window):
        return {"prev_price": F.lag(price, 1).over(window)}

    lagged = over_series(facts, list(keys), list(order_by), build, before=1, series_rows=series_rows, **limits)
    return lagged.withColumns(
        {
            "price_change": F.col(price) - F.col("prev_price"),
            "price_change_pct": F.round(pct_change(F.col(price), F.col("prev_price")), 2),
        }
    )


def volatility(facts: DataFrame, *, keys: Sequence[str] = ("commodity",), date: str = "date") -> DataFrame:
    """Sample deviation of the close, mean volume and high-low range per month."""
    day = F.col(date)
    return facts.groupBy(*keys, F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.stddev_samp("close_price").alias("price_volatility"),
        F.avg("volume").alias("avg_volume"),
        (F.max("high_price") - F.min("low_price")).alias("price_range"),
    )


def source_comparison(facts: DataFrame, *, keys: Sequence[str] = ("date", "commodity")) -> DataFrame:
    """Number of fact rows that share the day and commodity, on every row."""
    return with_group_stats(facts, list(keys), sources_count=F.count(F.lit(1)))


def correlation(facts: DataFrame, *, price: str = "close_price") -> DataFrame:
    """Pearson correlation of commodity pairs that trade on the same day and market.

    Each (day, market, commodity) is reduced to count and moments before the
    self-join, so repeated rows never multiply; prices are shifted by the overall mean
    to keep the sums well conditioned.
    """
    centre = facts.agg(F.avg(price)).scalar()
    shifted = facts.select("date", "market", "commodity", (F.col(price) - centre).alias("x"))
    x = F.col("x")
    cells = shifted.groupBy("date", "market", "commodity").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("x").alias("n"),
        F.coalesce(F.sum(x), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum(x * x), F.lit(0.0)).alias("q"),
    )
    a, b = cells.alias("a"), cells.alias("b")
    same_cell = (F.col("a.date") == F.col("b.date")) & (F.col("a.market") == F.col("b.market"))
    pairs = a.join(b, same_cell & (F.col("a.commodity") < F.col("b.commodity")))
    na, nb = F.col("a.n"), F.col("b.n")
    sums = pairs.groupBy(
        F.col("a.commodity").alias("commodity_1"), F.col("b.commodity").alias("commodity_2")
    ).agg(
        F.sum(F.col("a.rows") * F.col("b.rows")).alias("overlap_days"),
        F.sum(na * nb).alias("n"),
        F.sum(F.col("a.s") * nb).alias("sx"),
        F.sum(F.col("b.s") * na).alias("sy"),
        F.sum(F.col("a.q") * nb).alias("sxx"),
        F.sum(F.col("b.q") * na).alias("syy"),
        F.sum(F.col("a.s") * F.col("b.s")).alias("sxy"),
    )
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    spread = F.sqrt((n * F.col("sxx") - sx * sx) * (n * F.col("syy") - sy * sy))
    return sums.select(
        "commodity_1", "commodity_2",
        F.try_divide(n * F.col("sxy") - sx * sy, spread).alias("price_correlation"),
        "overlap_days",
    )


def correlation_by_rows(facts: DataFrame, *, price: str = "close_price") -> DataFrame:
    """The same view as the fact self-join gives it: every row of one commodity meets every row of the other in its cell.

    A cell (day, market, commodity) enters by its row count, mean and squared deviations, from which the sums over
    all row pairs of two cells follow, so no row pair is built. A constant price has no correlation: NULL.
    """
    cells = facts.groupBy("date", "market", "commodity").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(price).alias("n"),
        F.avg(price).alias("mean"),
        F.var_pop(price).alias("var"),
        F.min(price).alias("lo"),
        F.max(price).alias("hi"),
    )
    cells = with_group_stats(cells, ["commodity"], centre=F.try_divide(F.sum(F.col("mean") * F.col("n")), F.sum("n")))
    s = F.coalesce((F.col("mean") - F.col("centre")) * F.col("n"), F.lit(0.0))
    q = F.coalesce(F.col("var") * F.col("n"), F.lit(0.0)) + F.coalesce(F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2), F.lit(0.0))
    cells = cells.select("date", "market", "commodity", "rows", "n", s.alias("s"), q.alias("q"), "lo", "hi")
    a, b = cells.alias("a"), cells.alias("b")
    same_cell = (F.col("a.date") == F.col("b.date")) & (F.col("a.market") == F.col("b.market"))
    na, nb = F.col("a.n"), F.col("b.n")
    both = (na > 0) & (nb > 0)
    sums = (
        a.join(b, same_cell & (F.col("a.commodity") < F.col("b.commodity")))
        .groupBy(F.col("a.commodity").alias("commodity_1"), F.col("b.commodity").alias("commodity_2"))
        .agg(
            F.sum(F.col("a.rows") * F.col("b.rows")).alias("overlap_days"),
            F.sum(na * nb).alias("n"),
            F.sum(F.col("a.s") * nb).alias("sx"),
            F.sum(F.col("b.s") * na).alias("sy"),
            F.sum(F.col("a.q") * nb).alias("sxx"),
            F.sum(F.col("b.q") * na).alias("syy"),
            F.sum(F.col("a.s") * F.col("b.s")).alias("sxy"),
            *[
                fn(F.when(both, F.col(f"{side}.{end}"))).alias(f"{side}_{end}")
                for side in "ab" for end, fn in (("lo", F.min), ("hi", F.max))
            ],
        )
    )
    n, sx, sy = F.nullif(F.col("n"), F.lit(0)), F.col("sx"), F.col("sy")
    spread = F.sqrt(F.col("sxx") - sx * sx / n) * F.sqrt(F.col("syy") - sy * sy / n)
    varies = (F.col("a_lo") < F.col("a_hi")) & (F.col("b_lo") < F.col("b_hi"))
    return sums.select(
        "commodity_1", "commodity_2",
        F.when(varies, F.try_divide(F.col("sxy") - sx * sy / n, spread)).alias("price_correlation"),
        "overlap_days",
    )


def year_over_year(facts: DataFrame, *, date: str = "date", price: str = "close_price") -> DataFrame:
    """Month averages against the same month one year earlier.

    Averaging before the self-join gives the same averages as joining the fact rows,
    because every row of a month meets the same number of rows of the other year.
    """
    day = F.col(date)
    months = facts.groupBy(
        "commodity", F.year(day).alias("year"), F.month(day).alias("month")
    ).agg(F.avg(price).alias("avg_price"))
    previous = months.select(
        F.col("commodity").alias("p_commodity"),
        F.col("month").alias("p_month"),
        F.col("year").alias("previous_year"),
        F.col("avg_price").alias("previous_year_avg_price"),
    )
    joined = months.join(
        previous,
        (F.col("commodity") == F.col("p_commodity"))
        & (F.col("month") == F.col("p_month"))
        & (F.col("year") == F.col("previous_year") + 1),
    )
    now, before = F.col("avg_price"), F.col("previous_year_avg_price")
    return joined.select(
        "month", "commodity", F.col("year").alias("current_year"),
        now.alias("current_year_avg_price"), "previous_year", before,
        F.round(pct_change(now, before), 2).alias("yoy_change_pct"),
    )


def volume_analysis(
    facts: DataFrame, *, order_by: Sequence[str], keys: Sequence[str] = ("commodity",),
    rows: int = 30, series_rows: int | None = None, **limits,
) -> DataFrame:
    """Mean volume of the last ``rows`` fact rows of the commodity and the ratio to it."""
    def build(window):
        return {"volume_30d_avg": F.avg("volume").over(window.rowsBetween(-(rows - 1), Window.currentRow))}

    averaged = over_series(
        facts, list(keys), list(order_by), build, before=rows - 1, series_rows=series_rows, **limits
    )
    return averaged.withColumn("volume_ratio_to_avg", F.try_divide("volume", "volume_30d_avg"))


# display order of each view: (column, descending)
VIEW_ORDER = {
    "price_trends": [("commodity", False), ("date", True)],
    "volatility": [("commodity", False), ("year", True), ("month", True)],
    "source_comparison": [("date", True), ("commodity", False), ("source", False)],
    "correlation": [("commodity_1", False), ("commodity_2", False)],
    "yoy_comparison": [("commodity", False), ("current_year", True)],
    "volume_analysis": [("commodity", False), ("date", True)],
}


def in_view_order(name: str, frame: DataFrame) -> DataFrame:
    """Sort a view for display; the views themselves stay unsorted so that further queries need no sort."""
    return frame.orderBy(*[F.col(c).desc() if descending else F.col(c) for c, descending in VIEW_ORDER[name]])


def views(facts: DataFrame, *, order_by: Sequence[str]) -> dict[str, DataFrame]:
    """Every view over one denormalised fact frame, by name."""
    return {
        "price_trends": price_trends(facts, order_by=order_by),
        "volatility": volatility(facts),
        "source_comparison": source_comparison(facts),
        "correlation": correlation(facts),
        "yoy_comparison": year_over_year(facts),
        "volume_analysis": volume_analysis(facts, order_by=order_by),
    }


def star_facts(
    fact: DataFrame, dates: DataFrame, commodities: DataFrame, markets: DataFrame,
    sources: DataFrame,
) -> DataFrame:
    """Fact joined to its dimensions (current commodity versions), with names as plain columns."""
    if "is_current" in commodities.columns:
        commodities = commodities.filter("is_current")
    return (
        fact.join(dates.select("date_key", F.col("calendar_date").alias("date")), "date_key")
        .join(commodities.select("commodity_key", F.col("commodity_name").alias("commodity")), "commodity_key")
        .join(markets.select("market_key", F.col("market_name").alias("market")), "market_key")
        .join(sources.select("source_key", F.col("source_name").alias("source")), "source_key")
    )


def register_views(spark: SparkSession, facts: DataFrame, *, order_by: Sequence[str]) -> list[str]:
    """Expose every view to ``spark.sql`` as ``v_<name>``."""
    names = []
    for name, frame in views(facts, order_by=order_by).items():
        frame.createOrReplaceTempView(f"v_{name}")
        names.append(f"v_{name}")
    return names
