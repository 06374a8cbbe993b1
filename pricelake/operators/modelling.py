"""From price series to model input: changes, treated outliers, seasonal parts, correlation matrix, labels and a split export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions.scalars import pct_change
from pricelake.operators.cleaning import quartile_bounds
from pricelake.operators.series import join_null_safe, over_series

#: A series has at most one row per month, so four centuries bound the windows over months.
MONTHS_OF_A_SERIES = 4_800


def treat_outliers(
    df: DataFrame, *, column: str, keys: Sequence[str] = (), threshold: float = 1.5, treated: str = "is_treated",
) -> DataFrame:
    """Winsorise: values outside their group's quartile fences become the nearer fence, and ``treated`` says so.

    Missing values stay missing; groups without values have no fences and stay as they are. The column becomes a double.
    """
    bounds = quartile_bounds(df, column=column, keys=keys, threshold=threshold).select(
        *keys, F.col("lower_bound").alias("__low"), F.col("upper_bound").alias("__high")
    )
    # without keys the fences are one row; a literal key joins it by equality
    key = list(keys) or ["__all"]
    if not keys:
        df, bounds = df.withColumn("__all", F.lit(1)), bounds.withColumn("__all", F.lit(1))
    joined, value = join_null_safe(df, bounds, key), F.col(column).cast("double")
    inside = F.when(value.isNotNull(), F.least(F.greatest(value, F.col("__low")), F.col("__high")))
    marked = joined.withColumn(treated, F.coalesce((value < F.col("__low")) | (value > F.col("__high")), F.lit(False)))
    return marked.withColumn(column, F.coalesce(inside, value)).drop("__low", "__high", "__all")


def _month_number(year: str, month: str) -> Column:
    return (F.col(year) * 12 + F.col(month) - 1).cast("int")


def period_changes(
    monthly: DataFrame, *, keys: Sequence[str] = ("commodity",), year: str = "year", month: str = "month", value: str = "avg_price",
) -> DataFrame:
    """Monthly rows with the change in percent on the month before (``mom_change_pct``) and twelve months before (``yoy_change_pct``).

    The comparison is with that calendar month, not with the row before; where it has no row, the change is NULL.
    """
    def build(window):
        def back(n: int) -> Column:
            return F.first(value).over(window.rangeBetween(-n, -n))

        return {"mom_change_pct": pct_change(F.col(value), back(1)), "yoy_change_pct": pct_change(F.col(value), back(12))}

    numbered = monthly.withColumn("__month", _month_number(year, month))
    return over_series(numbered, list(keys), ["__month"], build, before=12, series_rows=MONTHS_OF_A_SERIES).drop("__month")


def decompose(
    monthly: DataFrame, *, keys: Sequence[str] = ("commodity",), year: str = "year", month: str = "month", value: str = "avg_price",
) -> DataFrame:
    """Additive parts of monthly series: ``trend`` + ``seasonal`` + ``residual`` = value.

    The trend is the centred mean of a year (thirteen months, the two outer ones counted half) and NULL where one of the
    thirteen is missing. The seasonal part is the mean distance from the trend of a series' Januaries, Februaries and so on, less
    the mean of these means, so that a series' effects add up to zero. A month without any trend in all years has no effect; then
    the residual is NULL, as it is without a trend. One row per keys, year and month is expected.
    """
    def build(window):
        wide, narrow = window.rangeBetween(-6, 6), window.rangeBetween(-5, 5)
        both = F.sum(value).over(wide) + F.sum(value).over(narrow)
        return {"trend": F.when(F.count(value).over(wide) == 13, both / 24)}

    numbered = monthly.withColumn("__month", _month_number(year, month))
    told = over_series(numbered, list(keys), ["__month"], build, before=6, after=6, series_rows=MONTHS_OF_A_SERIES).drop("__month")
    effects = told.groupBy(*keys, month).agg(F.avg(F.col(value) - F.col("trend")).alias("__effect"))
    centres = effects.groupBy(*keys).agg(F.avg("__effect").alias("__centre"))
    seasonal = join_null_safe(effects, centres, list(keys)).select(*keys, month, (F.col("__effect") - F.col("__centre")).alias("seasonal"))
    return join_null_safe(told, seasonal, [*keys, month]).withColumn("residual", F.col(value) - F.col("trend") - F.col("seasonal"))


def correlation_matrix(
    facts: DataFrame, names: Sequence[str], *, name: str = "market", by: Sequence[str] = ("date",), price: str = "close_price",
) -> DataFrame:
    """A row and a column per name of a given list: Pearson correlation of their mean prices over the ``by`` cells that both have.

    Prices are averaged to one number per cell and name first, then every cell is one array of at most as many numbers as
    the list has names. Its outer product feeds mergeable co-moments, which are summed before they are shuffled, so neither facts nor cells
    are joined with themselves. Fewer than two common cells, or a series that never moves, give NULL.
    """
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(name)).cast("int")
    means = facts.filter(F.col(name).isin(*names)).groupBy(*by, place.alias("at")).agg(F.avg(price).alias("x")).filter("x is not null")
    cells = means.groupBy(*by).agg(F.collect_list(F.struct("at", "x")).alias("cell"))
    left = cells.select("cell", F.inline("cell").alias("a", "x"))
    pairs = left.select("a", "x", F.inline(F.filter("cell", lambda other: other["at"] >= F.col("a"))).alias("b", "y"))
    # the built-in correlation fails on a spread of zero
    spreads = F.stddev_pop("x") * F.stddev_pop("y")
    upper = pairs.groupBy("a", "b").agg(F.try_divide(F.covar_pop("x", "y"), spreads).alias("r"))
    mirrored = F.array(F.struct(F.col("a").alias("row"), F.col("b").alias("col"), "r"), F.struct(F.col("b").alias("row"), F.col("a").alias("col"), "r"))
    whole = upper.select(F.inline(mirrored))
    matrix = whole.groupBy("row").agg(*[F.max(F.when(F.col("col") == i, F.col("r"))).alias(n) for i, n in enumerate(names, 1)])
    listed = facts.sparkSession.range(1, len(names) + 1).select(
        F.col("id").cast("int").alias("row"), F.element_at(F.array(*[F.lit(n) for n in names]), F.col("id").cast("int")).alias(name)
    )
    return listed.join(matrix, "row", "left").drop("row")


def next_move(
    df: DataFrame, *, keys: Sequence[str], order_by: Sequence[str], date: str = "date", price: str = "close_price", **limits,
) -> DataFrame:
    """Labels that look one row ahead: ``next_return_pct``, ``direction`` (-1, 0 or 1) and ``label_date``, the day on which the label is known.

    The last row of a series has no label; a missing price on either side gives none but the date.
    """
    def build(window):
        return {"label_date": F.lead(date, 1).over(window), "__next": F.lead(price, 1).over(window)}

    told = over_series(df, keys, order_by, build, before=0, after=1, **limits)
    return told.withColumns({
        "next_return_pct": pct_change(F.col("__next"), F.col(price)), "direction": F.signum(F.col("__next") - F.col(price)).cast("int"),
    }).drop("__next")


def date_split(df: DataFrame, edges: Sequence[tuple[str, str]], *, date: str = "date", label_date: str = "label_date", split: str = "split") -> DataFrame:
    """Rows with their split by date, without those whose label is known only on or after the end of their split.

    ``edges`` lists (name, first day) in time order; rows before the first day or without a date belong to no split and go, and so
    do rows without a label. A row whose label date reaches the next split's first day would tell that split's prices to this one.
    """
    days = [day for _, day in edges]
    if not days or days != sorted(set(days)):
        raise ValueError("edges have to be in time order, with different days")
    known = df.filter(F.col(label_date).isNotNull())
    parts = None
    for (name, first), end in zip(edges, [*days[1:], None]):
        inside = F.col(date) >= F.lit(first).cast("date")
        if end is not None:
            inside = inside & (F.col(date) < F.lit(end).cast("date")) & (F.col(label_date) < F.lit(end).cast("date"))
        parts = F.when(inside, name) if parts is None else parts.when(inside, name)
    return known.withColumn(split, parts).filter(F.col(split).isNotNull())


def export_split(df: DataFrame, path: str, *, split: str = "split") -> None:
    """Write one folder per split; the rebalance hint lets AQE cut large splits into several files and merge small ones."""
    df.hint("rebalance", split).write.mode("overwrite").partitionBy(split).parquet(path)


def read_split(df_path: str, spark, *, split: str = "split", name: str | None = None) -> DataFrame:
    """All splits, or one of them, whose files alone are then read."""
    rows = spark.read.parquet(df_path)
    return rows if name is None else rows.filter(F.col(split) == name)
