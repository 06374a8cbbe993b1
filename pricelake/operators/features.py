"""Time-series features of ordered price series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions.scalars import pct_change
from pricelake.operators.series import join_null_safe, over_series


def lag_features(
    df: DataFrame, *, keys: Sequence[str], order_by: Sequence[str], price: str = "close_price",
    lags: Sequence[int] = (1, 7, 30), **limits,
) -> DataFrame:
    """Price n rows earlier in the series."""
    def build(window):
        return {f"price_lag_{n}d": F.lag(price, n).over(window) for n in lags}

    return over_series(df, keys, order_by, build, before=max(lags), **limits)


def rolling_features(
    df: DataFrame, *, keys: Sequence[str], order_by: Sequence[str], price: str = "close_price",
    windows: Sequence[int] = (7, 30, 90), **limits,
) -> DataFrame:
    """Mean, population deviation, minimum and maximum of the previous w rows once w rows exist."""
    def build(window):
        out: dict[str, Column] = {}
        for w in windows:
            frame = window.rowsBetween(-w, -1)
            full = F.count(F.lit(1)).over(frame) == w
            for label, value in (
                ("ma", F.avg(price)), ("std", F.stddev_pop(price)),
                ("min", F.min(price)), ("max", F.max(price)),
            ):
                out[f"price_{label}_{w}d"] = F.when(full, value.over(frame))
        return out

    return over_series(df, keys, order_by, build, before=max(windows), **limits)


def momentum_features(
    df: DataFrame, *, keys: Sequence[str], order_by: Sequence[str], price: str = "close_price",
    periods: Sequence[int] = (7, 30), **limits,
) -> DataFrame:
    """Rate of change in percent over n rows."""
    def build(window):
        return {
            f"momentum_roc_{n}d": pct_change(F.col(price), F.lag(price, n).over(window)) for n in periods
        }

    return over_series(df, keys, order_by, build, before=max(periods), **limits)


def rsi_feature(
    df: DataFrame, *, keys: Sequence[str], order_by: Sequence[str], price: str = "close_price",
    rows: int = 14, **limits,
) -> DataFrame:
    """Relative strength over the last ``rows`` price changes (simple means); NULL until they exist."""
    def change(window):
        return {"__change": F.col(price) - F.lag(price, 1).over(window)}

    def strength(window):
        frame = window.rowsBetween(-(rows - 1), 0)
        gain = F.avg(F.greatest(F.col("__change"), F.lit(0.0))).over(frame)
        loss = F.avg(F.greatest(-F.col("__change"), F.lit(0.0))).over(frame)
        ready = F.count("__change").over(frame) == rows
        value = F.when(loss == 0, 100.0).otherwise(100 - 100 / (1 + F.try_divide(gain, loss)))
        return {f"momentum_rsi_{rows}d": F.when(ready, value)}

    changed = over_series(df, keys, order_by, change, before=1, **limits)
    return over_series(changed, keys, order_by, strength, before=rows - 1, **limits).drop("__change")


EMA_CYCLE = 1024


def macd_feature(
    df: DataFrame, *, keys: Sequence[str], order_by: Sequence[str], price: str = "close_price",
    fast: int = 12, slow: int = 26, **limits,
) -> DataFrame:
    """Difference of two exponential means over all rows of the series so far.

    A weight keep^age is written as keep^(-place), with the common factor cancelled between weighted sum and
    weight sum.  Places restart every 1024 rows to stay in range: a row's means are running sums inside its
    cycle plus what the last cycle with prices left, faded by the cycles since, and that one plus the cycle with
    prices before it.  What lies further back has a relative weight below 1e-34, under the resolution of a double.
    In a gap without prices both sums fade alike, so the means stay as they are, however long it is.
    """
    value = F.col(price).cast("double")
    keeps = {"fast": 1 - 2 / (fast + 1), "slow": 1 - 2 / (slow + 1)}
    placed = over_series(
        df, keys, order_by, lambda window: {"__row": F.lit(1)}, before=0, position="__place", **limits
    ).withColumn("__cycle", F.floor(F.col("__place") / EMA_CYCLE))
    parts = {}
    for name, keep in keeps.items():
        weight = F.when(value.isNotNull(), F.pow(F.lit(1 / keep), F.col("__place") % EMA_CYCLE))
        parts |= {f"__{name}_v": value * weight, f"__{name}_w": weight}
    weighed = placed.withColumns(parts)
    scope = [*keys, "__cycle"]
    so_far = Window.partitionBy(*scope).orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    running = weighed.withColumns({f"{p}_sum": F.sum(p).over(so_far) for p in parts})
    whole = weighed.groupBy(*scope).agg(*[F.sum(p).alias(p) for p in parts])
    earlier = Window.partitionBy(*keys).orderBy("__cycle").rowsBetween(Window.unboundedPreceding, -1)

    def left(columns: dict[str, Column]) -> Column:
        """The latest earlier cycle with prices and these columns of it."""
        own = F.struct(F.col("__cycle").alias("cycle"), *[value.alias(name) for name, value in columns.items()])
        return F.last(F.when(F.col("__fast_w").isNotNull(), own), ignorenulls=True).over(earlier)

    def faded(part: str, since: Column) -> Column:
        keep = keeps["fast" if part.startswith("__fast") else "slow"] ** EMA_CYCLE
        return F.pow(F.lit(keep), F.col("__cycle") - since["cycle"]) * since[part]

    former = F.col("__left")
    summed = whole.withColumn("__left", left({p: F.col(p) for p in parts})).withColumns(
        {p: F.col(p) + F.coalesce(faded(p, former), F.lit(0.0)) for p in parts}
    )
    carried = summed.withColumn("__left", left({p: F.col(p) for p in parts})).select(*scope, "__left")
    joined = join_null_safe(running, carried, scope)

    def mean(name: str) -> Column:
        def total(part: str) -> Column:
            column = f"__{name}_{part}"
            own, rest = F.col(f"{column}_sum"), faded(column, former)
            return F.when(own.isNull(), former[column]).otherwise(own + F.coalesce(rest, F.lit(0.0)))

        return F.try_divide(total("v"), total("w"))

    return joined.select(*df.columns, (mean("fast") - mean("slow")).alias("momentum_macd"))


def seasonal_features(df: DataFrame, *, date: str = "date", harvest: Sequence[int] = (9, 10, 11)) -> DataFrame:
    """Cyclic month encoding, quarter and harvest flag."""
    month = F.month(F.col(date))
    angle = 2 * F.pi() * month / 12
    return df.withColumns(
        {
            "seasonal_month_sin": F.sin(angle),
            "seasonal_month_cos": F.cos(angle),
            "seasonal_quarter": F.quarter(F.col(date)),
            "seasonal_is_harvest": month.isin(*harvest),
        }
    )


def market_structure_features(df: DataFrame) -> DataFrame:
    """Typical price, day range and position of the close inside the range."""
    high, low, close = F.col("high_price"), F.col("low_price"), F.col("close_price")
    spread = high - low
    return df.withColumns(
        {
            "market_typical_price": (high + low + close) / 3,
            "market_price_range": spread,
            "market_close_position": F.when(
                F.col("open_price").isNotNull() & (spread > 0), F.try_divide(close - low, spread)
            ),
        }
    )
