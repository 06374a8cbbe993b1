"""Ordered per-series computations that stay bounded when one series is huge.

A plain ``Window.partitionBy(keys)`` sorts a whole series in one task, so a series with a third of all rows makes
one task do a third of the work.  What is planned follows from what the caller states, never from a measurement:

* ``series_rows``, an upper bound of a series such as one row per calendar day: the plain window.
* otherwise, with a date or time as first order column: windows over (keys, calendar bucket).  The few rows a
  frame needs from neighbouring buckets come along as copies, and a value to be carried is taken from one
  summary row per bucket, so building the plan starts no job.  ``bucket`` is a unit of ``date_trunc``.
* otherwise: rows are numbered by a range-partitioned sort (which runs when the plan is built, into a checkpoint) and
  cut into chunks of fixed length, with copies and carried values between chunks.

All give the same rows.  ``order_by`` has to be a total order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pricelake.session import checkpointed

PLAIN_WINDOW_ROWS = 5_000_000
CHUNK_ROWS = 1_000_000

_POS, _CHUNK, _OWN = "__pos", "__chunk", "__own"


def require_order(keys: Sequence[str], order_by: Sequence[str], single_series: bool = False) -> None:
    if not order_by:
        raise ValueError("order_by is required: results depend on row order")
    if not keys and not single_series:
        raise ValueError("keys is empty; pass single_series=True if the table is one series")


def join_null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``columns`` where NULL matches NULL; keeps the left key columns."""
    renamed = right.select(
        *[F.col(c).alias(f"__r_{c}") for c in columns],
        *[c for c in right.columns if c not in columns],
    )
    condition = reduce(
        lambda a, b: a & b,
        [left[c].eqNullSafe(renamed[f"__r_{c}"]) for c in columns],
    )
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in columns])


def with_group_stats(df: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Attach per-group aggregates to each row.

    Partial aggregation plus a join instead of an unordered window: the group is
    never gathered in one task, and AQE picks broadcast or a split skew join.
    """
    if not keys:
        one = df.agg(F.struct(*[value.alias(name) for name, value in aggregates.items()])).scalar()
        return df.withColumn("__stats", one).select(
            *df.columns, *[F.col("__stats")[name].alias(name) for name in aggregates]
        )
    stats = df.groupBy(*keys).agg(*[value.alias(name) for name, value in aggregates.items()])
    return join_null_safe(df, stats, keys)


def largest_series(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the biggest series: one map-side combined count over the key columns."""
    row = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()
    return int(row["n"] or 0)


def fits_plain_window(series_rows: int | None, limit: int | None = None) -> bool:
    """Whether the caller states a bound that one task can sort."""
    return series_rows is not None and series_rows <= (PLAIN_WINDOW_ROWS if limit is None else limit)


def calendar_bucket(df: DataFrame, order_by: Sequence[str], bucket: str | None) -> Column | None:
    """The bucket of a row, or None if the first order column is no date or time."""
    kind = dict(df.dtypes)[order_by[0]]
    if kind not in ("date", "timestamp", "timestamp_ntz"):
        if bucket is not None:
            raise ValueError(f"bucket needs a date or time as first order column, not {kind}")
        return None
    return F.date_trunc(bucket or "month", F.col(order_by[0]))


def with_position(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], name: str, blocks: int | None = None
) -> DataFrame:
    """Exact 0-based row position inside each series, without one task per series.

    Range partitioning splits a hot series over many blocks; sorted blocks number their
    own rows, and the row counts of earlier blocks are added.  Block ids depend on
    sampled boundaries, so the numbered rows are checkpointed before both uses.
    """
    spark = df.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpointed(
        df.repartitionByRange(blocks, *keys, *order_by)
        .sortWithinPartitions(*keys, *order_by)
        .withColumns({"__block": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    )
    scope = [*keys, "__block"]
    before = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy(*scope)
        .agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
        .select(*scope, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    )
    return (
        join_null_safe(ranged, shifts, scope)
        .withColumn(name, F.col("__row") + F.col("__shift"))
        .drop("__block", "__row", "__shift")
    )


def _bucket_sizes(cut: DataFrame, keys: Sequence[str], backwards: bool = False) -> DataFrame:
    """One row per (keys, bucket): rows in it and in all buckets before it (after it, if backwards)."""
    sizes = cut.groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    line = Window.partitionBy(*keys).orderBy(F.col(_CHUNK).desc() if backwards else F.col(_CHUNK).asc())
    return sizes.withColumn("__first", F.sum("__n").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n"))


def _halo(
    cut: DataFrame, keys: Sequence[str], order_by: Sequence[str], reach: int, backwards: bool = False
) -> DataFrame:
    """Copies of the rows that lie at most ``reach`` rows before (after, if backwards) a later (earlier) bucket.

    Every bucket has a row, so the last ``reach`` rows of a bucket and its next ``reach`` buckets are all that can meet.
    """
    towards = [F.col(c).asc() if backwards else F.col(c).desc() for c in order_by]
    rank = F.row_number().over(Window.partitionBy(*keys, _CHUNK).orderBy(*towards))
    edge = cut.withColumn("__rank", rank).filter(F.col("__rank") <= reach)
    line = Window.partitionBy(*keys).orderBy(F.col(_CHUNK).desc() if backwards else F.col(_CHUNK).asc())
    following = F.collect_list(F.struct(F.col("__first").alias("at"), F.col(_CHUNK).alias("bucket"))).over(line.rowsBetween(1, reach))
    near = _bucket_sizes(cut, keys, backwards).select(
        *keys, _CHUNK, (F.col("__first") + F.col("__n")).alias("__end"), following.alias("__next")
    )
    reached = F.filter("__next", lambda x: x["at"] - F.col("__end") + F.col("__rank") <= reach)
    met = join_null_safe(edge, near, [*keys, _CHUNK]).withColumn("__target", F.explode(reached))
    return met.withColumns({_CHUNK: F.col("__target.bucket"), _OWN: F.lit(False)}).drop("__rank", "__end", "__next", "__target")


def _over_buckets(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], build: Callable[[WindowSpec], dict[str, Column]],
    before: int, after: int, bucket: Column, position: str | None,
) -> DataFrame:
    cut = df.withColumn(_CHUNK, bucket)
    if position:
        placed = join_null_safe(cut, _bucket_sizes(cut, keys).drop("__n"), [*keys, _CHUNK])
        inside = F.row_number().over(Window.partitionBy(*keys, _CHUNK).orderBy(*order_by))
        cut = placed.withColumn(position, F.col("__first") + inside - 1).drop("__first")
    line = cut.withColumn(_OWN, F.lit(True))
    if before:
        line = line.unionByName(_halo(cut, keys, order_by, before))
    if after:
        line = line.unionByName(_halo(cut, keys, order_by, after, backwards=True))
    window = Window.partitionBy(*keys, _CHUNK).orderBy(*order_by)
    return line.withColumns(build(window)).filter(_OWN).drop(_CHUNK, _OWN)


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    build: Callable[[WindowSpec], dict[str, Column]],
    *,
    before: int,
    after: int = 0,
    series_rows: int | None = None,
    single_series: bool = False,
    plain_limit: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    bucket: str | None = None,
    position: str | None = None,
) -> DataFrame:
    """Add window columns whose frames reach at most ``before``/``after`` rows away.

    ``position`` names a column with the row's 0-based place in its series for ``build`` to use.
    """
    require_order(keys, order_by, single_series)
    if fits_plain_window(series_rows, plain_limit):
        window = Window.partitionBy(*keys).orderBy(*order_by)
        if position:
            df = df.withColumn(position, F.row_number().over(window).cast("long") - 1)
        return df.withColumns(build(window))
    cut = calendar_bucket(df, order_by, bucket)
    if cut is not None:
        return _over_buckets(df, keys, order_by, build, before, after, cut, position)

    chunk_rows = max(chunk_rows, before, after, 1)
    placed = with_position(df, keys, order_by, _POS)
    if position:
        placed = placed.withColumn(position, F.col(_POS))
    own = F.floor(F.col(_POS) / chunk_rows)
    offset = F.col(_POS) % chunk_rows
    nothing = F.lit(None).cast("long")
    targets = [own]
    if before:
        targets.append(F.when(offset >= chunk_rows - before, own + 1).otherwise(nothing))
    if after:
        targets.append(F.when((offset < after) & (own > 0), own - 1).otherwise(nothing))
    copies = (
        placed.withColumn(_OWN, own)
        .withColumn(_CHUNK, F.explode(F.array_compact(F.array(*targets))))
    )
    window = Window.partitionBy(*keys, _CHUNK).orderBy(_POS)
    return (
        copies.withColumns(build(window))
        .filter(F.col(_CHUNK) == F.col(_OWN))
        .drop(_POS, _CHUNK, _OWN)
    )


def carry_last(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    columns: dict[str, str],
    *,
    include_current: bool,
    series_rows: int | None = None,
    single_series: bool = False,
    plain_limit: int | None = None,
    chunk_rows: int = CHUNK_ROWS,
    bucket: str | None = None,
) -> DataFrame:
    """Latest non-NULL value so far; ``columns`` maps new column name to source column."""
    require_order(keys, order_by, single_series)
    end = 0 if include_current else -1

    def latest(window: WindowSpec) -> dict[str, Column]:
        frame = window.rowsBetween(Window.unboundedPreceding, end)
        return {out: F.last(src, ignorenulls=True).over(frame) for out, src in columns.items()}

    if fits_plain_window(series_rows, plain_limit):
        return df.withColumns(latest(Window.partitionBy(*keys).orderBy(*order_by)))

    cut = calendar_bucket(df, order_by, bucket)
    if cut is not None:
        # a row's place among those of its bucket is its order itself
        order = F.struct(F.lit(0).alias("seed"), *order_by)
        placed = df.withColumns({_CHUNK: cut, _POS: order})
        before_all = F.struct(F.lit(-1).alias("seed"), *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in order_by])
    else:
        placed = with_position(df, keys, order_by, _POS)
        placed = placed.withColumn(_CHUNK, F.floor(F.col(_POS) / chunk_rows))
        before_all = F.lit(-1).cast("long")
    scope = [*keys, _CHUNK]
    ends = placed.groupBy(*scope).agg(
        *[
            F.max_by(src, F.when(F.col(src).isNotNull(), F.col(_POS))).alias(f"__end_{out}")
            for out, src in columns.items()
        ]
    )
    earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    # the value carried into a chunk joins it as a row in front of its first row
    seeds = ends.select(
        *scope,
        *[F.last(f"__end_{out}", ignorenulls=True).over(earlier).alias(src) for out, src in columns.items()],
        before_all.alias(_POS), F.lit(True).alias("__seed"),
    )
    inside = placed.unionByName(seeds, allowMissingColumns=True)
    return (
        inside.withColumns(latest(Window.partitionBy(*scope).orderBy(_POS)))
        .filter(F.col("__seed").isNull())
        .drop(_POS, _CHUNK, "__seed")
    )
