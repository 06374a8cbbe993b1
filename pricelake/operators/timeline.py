"""As-of joins and gap filling along time, cut into calendar buckets.

No window spans a whole series of facts: rows meet inside (keys, bucket), and what has to cross a bucket's edge is
carried over one row per (keys, bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_AT, _BUCKET, _KIND, _VALUE, _CARRIED = "__at", "__bucket", "__kind", "__value", "__carried"


def asof_join(
    left: DataFrame, right: DataFrame, *, keys: Sequence[str], time: str, right_time: str, columns: Sequence[str],
    order_by: Sequence[str] = (), bucket: str = "month",
) -> DataFrame:
    """Left rows with ``right_time`` and ``columns`` of the latest right row of their keys at or before ``time``.

    The distinct (keys, time) points of the left side are answered, not its rows, and joined back by equality, so a
    key with most of the rows costs one point per distinct time. Of right rows at one time the greatest by
    ``order_by`` counts (by ``columns`` without one). NULL keys or times match nothing; without an earlier right
    row the new columns are NULL. ``bucket`` is a unit of ``date_trunc`` that holds a bearable number of times.
    """
    if set(columns) & set(left.columns) or right_time in left.columns:
        raise ValueError("left side already has a column of the right side")
    value = F.struct(F.col(right_time), *columns)
    best = F.max_by(value, F.struct(*order_by)) if order_by else F.max(value)
    quotes = (
        right.filter(F.col(right_time).isNotNull()).groupBy(*keys, F.col(right_time).cast("timestamp").alias(_AT))
        .agg(best.alias(_VALUE)).withColumn(_BUCKET, F.date_trunc(bucket, _AT))
    )
    points = left.select(*keys, F.col(time).cast("timestamp").alias(_AT)).distinct().na.drop()
    points = points.withColumns({_BUCKET: F.date_trunc(bucket, _AT), _VALUE: F.lit(None).cast(quotes.schema[_VALUE].dataType)})

    # One row per keys and bucket: the last quote of all earlier buckets opens the bucket.
    ends = quotes.groupBy(*keys, _BUCKET).agg(F.max_by(_VALUE, _AT).alias(_VALUE))
    wanted = points.groupBy(*keys, _BUCKET).agg(F.lit(None).cast(quotes.schema[_VALUE].dataType).alias(_VALUE))
    steps = ends.unionByName(wanted).groupBy(*keys, _BUCKET).agg(F.max(_VALUE).alias(_VALUE))
    earlier = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    opening = steps.select(
        *keys, _BUCKET, F.col(_BUCKET).alias(_AT), F.lit(0).alias(_KIND), F.last(_VALUE, ignorenulls=True).over(earlier).alias(_VALUE)
    )
    line = opening.unionByName(quotes.withColumn(_KIND, F.lit(1))).unionByName(points.withColumn(_KIND, F.lit(2)))
    so_far = Window.partitionBy(*keys, _BUCKET).orderBy(_AT, _KIND).rowsBetween(Window.unboundedPreceding, 0)
    answers = (
        line.withColumn(_CARRIED, F.last(_VALUE, ignorenulls=True).over(so_far)).filter(F.col(_KIND) == 2)
        .select(*[F.col(k).alias(f"__a_{k}") for k in keys], _AT, f"{_CARRIED}.*")
    )
    same = [F.col(k) == F.col(f"__a_{k}") for k in keys] + [F.col(time).cast("timestamp") == F.col(_AT)]
    return left.join(answers, same, "left").drop(_AT, *[f"__a_{k}" for k in keys])


def fill_gaps(
    series: DataFrame, *, keys: Sequence[str], date: str, value: str, bucket: str = "month", filled: str = "is_filled",
) -> DataFrame:
    """A row per day from the first to the last known value of each series, values between two known ones on a line.

    ``series`` has at most one row per keys and date. Rows without a value are gaps like missing rows. Each known row
    learns the next known one inside its bucket, the last of a bucket the first of the next bucket that has any
    (carried back over one row per bucket, however long the gap), and then writes the days up to it.
    """
    known = series.filter(F.col(value).isNotNull() & F.col(date).isNotNull()).select(
        *keys, F.col(date).cast("date").alias(date), F.col(value).cast("double").alias(value)
    )
    known = known.withColumn(_BUCKET, F.trunc(date, bucket))
    point = F.struct(date, value)
    firsts = known.groupBy(*keys, _BUCKET).agg(F.min(point).alias(_VALUE))
    later = Window.partitionBy(*keys).orderBy(_BUCKET)
    opens = firsts.select(*[F.col(k).alias(f"__n_{k}") for k in keys], F.col(_BUCKET).alias("__n_bucket"), F.lead(_VALUE).over(later).alias(_CARRIED))
    inside = Window.partitionBy(*keys, _BUCKET).orderBy(date)
    same = [F.col(k).eqNullSafe(F.col(f"__n_{k}")) for k in keys] + [F.col(_BUCKET) == F.col("__n_bucket")]
    told = known.withColumn(_VALUE, F.lead(point).over(inside)).join(opens, same, "left")
    told = told.withColumn(_VALUE, F.coalesce(_VALUE, _CARRIED))
    days = F.coalesce(F.date_diff(F.col(_VALUE)[date], F.col(date)), F.lit(1))
    spread = told.select(*keys, date, value, _VALUE, days.alias("__days"), F.explode(F.sequence(F.lit(0), days - 1)).alias("__step"))
    line = F.col(value) + (F.col(_VALUE)[value] - F.col(value)) * F.col("__step") / F.col("__days")
    return spread.select(
        *keys, F.date_add(date, F.col("__step")).alias(date), F.when(F.col("__step") == 0, F.col(value)).otherwise(line).alias(value),
        (F.col("__step") > 0).alias(filled),
    )
