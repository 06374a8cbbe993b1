"""Star-schema loads: dimensions, type-2 history, fact keys, summaries and snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from pricelake import reference_values as ref
from pricelake.functions.scalars import date_key, date_of_key
from pricelake.operators import aggregates
from pricelake.operators.cleaning import drop_duplicates
from pricelake.operators.enrich import add_date_dimensions, add_trading_flags
from pricelake.operators.quality import check_missing_values, check_row_count, referential_orphans, union_checks
from pricelake.operators.series import join_null_safe
from pricelake.schemas import TABLES
from pricelake.session import lookup, scratch_copy


def seed_dimensions(spark: SparkSession, loaded_at: Column | None = None) -> dict[str, DataFrame]:
    """Reference rows of the four fixed dimensions, in their table layouts."""
    at = F.current_timestamp() if loaded_at is None else loaded_at
    extra = {"is_active": F.lit(True), "created_at": at, "ended_at": F.lit(None).cast("timestamp")}
    first = {
        "effective_date": at.cast("date"), "end_date": F.lit(None).cast("date"),
        "is_current": F.lit(True), "version": F.lit(1),
    }
    seeds = {
        "dim_currency": (ref.SEED_CURRENCIES, {"created_at": at}),
        "dim_commodity": (ref.SEED_COMMODITIES, {**extra, **first}),
        "dim_market": (ref.SEED_MARKETS, extra),
        "dim_source": (ref.SEED_SOURCES, extra),
    }
    frames = {}
    for name, (rows, defaults) in seeds.items():
        given = ", ".join(part.strip() for part in TABLES[name].split(",")[: len(rows[0])])
        frames[name] = spark.createDataFrame(rows, given).withColumns(defaults)
    return frames


def insert_missing(current: DataFrame, incoming: DataFrame, keys: Sequence[str], *, order_by: Sequence[str]) -> DataFrame:
    """Current rows plus incoming rows whose key is new; the first copy of a key wins."""
    fresh = _new_rows(current, incoming, keys, order_by)
    return current.unionByName(fresh, allowMissingColumns=True)


def _new_rows(current: DataFrame, incoming: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    single = drop_duplicates(incoming, keys=keys, order_by=order_by)
    known = current.select(*keys).withColumn("__known", F.lit(True)).distinct()
    return join_null_safe(single, known, keys).filter(F.col("__known").isNull()).drop("__known")


def classify(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], *, order_by: Sequence[str],
    tracked: Sequence[str] | None = None,
) -> DataFrame:
    """Key, ``old`` and ``new`` row and the action: inserted, updated, unchanged or kept.

    The last copy of an incoming key wins.  ``tracked`` limits which columns count as a change.
    """
    columns = list(current.columns)
    tracked = list(tracked or [c for c in columns if c not in keys])
    latest = drop_duplicates(incoming, keys=keys, order_by=order_by, keep="last")
    old = current.select(*[F.col(k).alias(f"__o_{k}") for k in keys], F.struct(*columns).alias("old"))
    new = latest.select(*[F.col(k).alias(f"__n_{k}") for k in keys], F.struct(*columns).alias("new"))
    same_key = reduce(
        lambda a, b: a & b, [F.col(f"__o_{k}").eqNullSafe(F.col(f"__n_{k}")) for k in keys]
    )
    joined = old.join(new, same_key, "full")
    same = reduce(
        lambda a, b: a & b, [F.col("old")[c].eqNullSafe(F.col("new")[c]) for c in tracked], F.lit(True)
    )
    action = (
        F.when(F.col("old").isNull(), "inserted")
        .when(F.col("new").isNull(), "kept")
        .when(same, "unchanged")
        .otherwise("updated")
    )
    return joined.select("old", "new", action.alias("action"))


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], *, order_by: Sequence[str]) -> DataFrame:
    """Insert new keys and replace the rows of known ones."""
    return classify(current, incoming, keys, order_by=order_by).select(
        F.inline(F.array(F.coalesce("new", "old")))
    )


def load_statistics(classified: DataFrame) -> DataFrame:
    """Rows per action."""
    return classified.groupBy("action").agg(F.count(F.lit(1)).alias("row_count"))


HISTORY = ["effective_date", "end_date", "is_current", "version"]


def scd2_classify(
    history: DataFrame, incoming: DataFrame, keys: Sequence[str], *, tracked: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Current versions against the incoming rows; closed versions are not touched."""
    plain = [c for c in history.columns if c not in HISTORY]
    current = history.filter("is_current").select(*plain)
    return classify(current, incoming.select(*plain), keys, order_by=order_by, tracked=tracked)


def scd2_merge(
    history: DataFrame, incoming: DataFrame, keys: Sequence[str], *, tracked: Sequence[str],
    order_by: Sequence[str], effective: Column,
) -> DataFrame:
    """Close changed versions at ``effective`` and open the next version.

    One null-safe full join of the current versions with the de-duplicated input;
    every joined pair unfolds into one or two history rows.
    """
    plain = [c for c in history.columns if c not in HISTORY]
    latest = drop_duplicates(incoming.select(*plain), keys=keys, order_by=order_by, keep="last")
    layout = [*plain, *HISTORY]
    old = history.filter("is_current").select(
        *[F.col(k).alias(f"__o_{k}") for k in keys], F.struct(*layout).alias("old")
    )
    new = latest.select(*[F.col(k).alias(f"__n_{k}") for k in keys], F.struct(*plain).alias("new"))
    same_key = reduce(
        lambda a, b: a & b, [F.col(f"__o_{k}").eqNullSafe(F.col(f"__n_{k}")) for k in keys]
    )
    o, n = F.col("old"), F.col("new")
    changed = n.isNotNull() & (
        o.isNull() | ~reduce(lambda a, b: a & b, [o[c].eqNullSafe(n[c]) for c in tracked], F.lit(True))
    )
    closed = F.struct(
        *[o[c].alias(c) for c in plain], o["effective_date"].alias("effective_date"),
        F.when(changed, effective).otherwise(o["end_date"]).cast("date").alias("end_date"),
        (~changed).alias("is_current"), o["version"].alias("version"),
    )
    opened = F.struct(
        *[n[c].alias(c) for c in plain], effective.cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_current"),
        (F.coalesce(o["version"], F.lit(0)) + 1).alias("version"),
    )
    rows = F.array_compact(
        F.array(F.when(o.isNotNull(), closed), F.when(changed, opened))
    )
    past = history.filter(~F.col("is_current")).select(*layout)
    return past.unionByName(old.join(new, same_key, "full").select(F.inline(rows)))


def date_dimension(spark: SparkSession, start, end, holidays: Sequence[str] = ref.HOLIDAYS) -> DataFrame:
    """Calendar rows of a closed date range."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("calendar_date")
    )
    return calendar_rows(days, holidays)


def calendar_rows(days: DataFrame, holidays: Sequence[str] = ref.HOLIDAYS) -> DataFrame:
    """Date-dimension rows of a frame of calendar dates."""
    flagged = add_trading_flags(add_date_dimensions(days, date="calendar_date"), date="calendar_date", holidays=holidays)
    return flagged.select(
        date_key(F.col("calendar_date")).alias("date_key"), "calendar_date", "year", "quarter", "month",
        F.dayofmonth("calendar_date").alias("day"), "week_of_year", "day_of_week", "is_weekend",
        "is_holiday", "trading_status",
    )


def surrogate_key(columns: Sequence[str]) -> Column:
    """Deterministic 64-bit key of a natural key; NULL and empty parts differ."""
    parts = [F.struct(F.col(c).isNull(), F.col(c).cast("string")) for c in columns]
    return F.xxhash64(*parts)


def surrogate_collisions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Surrogate keys shared by different natural keys (expected: none)."""
    natural = F.to_json(F.struct(*[F.col(c).cast("string") for c in columns]))
    return (
        df.select(surrogate_key(columns).alias("surrogate_key"), natural.alias("natural"))
        .groupBy("surrogate_key")
        .agg(F.min("natural").alias("first_key"), F.max("natural").alias("last_key"))
        .filter("first_key <> last_key")
    )


FACT_KEYS = ["date_key", "commodity_key", "market_key", "source_key", "currency_key"]


def resolve_fact_keys(rows: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Look up the five dimension keys of silver rows; a missing match leaves NULL.

    The dimension sides are unique on their names; small ones are broadcast, so that facts are not gathered by name.
    """
    commodities = dims["dim_commodity"]
    if "is_current" in commodities.columns:
        commodities = commodities.filter("is_current")
    lookups = [
        (dims["dim_date"], "calendar_date", "date", "date_key"),
        (commodities, "commodity_name", "commodity", "commodity_key"),
        (dims["dim_market"], "market_name", "market", "market_key"),
        (dims["dim_source"], "source_name", "source", "source_key"),
        (dims["dim_currency"], "currency_code", "currency", "currency_key"),
    ]
    for dim, name, column, key in lookups:
        side = lookup(dim.select(F.col(name).alias("__name"), F.col(key).alias(key)))
        rows = rows.join(side, F.col(column) == F.col("__name"), "left").drop("__name")
    return rows


def _complete() -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in FACT_KEYS])


def _fact_decimals() -> dict[str, str]:
    typed = (c.strip().split(" ", 1) for c in TABLES["commodity_prices_fact"].split(", "))
    return {name: kind for name, kind in typed if kind.startswith("decimal")}


def _overflows(columns: Sequence[str]) -> Column:
    """Whether a value is too large for its column of the fact table."""
    return reduce(
        lambda a, b: a | b,
        [
            F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
            for name, kind in _fact_decimals().items() if name in columns
        ],
        F.lit(False),
    )


def fact_rows(resolved: DataFrame, *, natural_key: Sequence[str], loaded_at: Column | None = None) -> DataFrame:
    """Fact-table layout of the rows whose five keys are known and whose values fit their columns."""
    at = F.current_timestamp() if loaded_at is None else loaded_at
    typed = {name: kind for name, kind in (c.strip().split(" ", 1) for c in TABLES["commodity_prices_fact"].split(", "))}
    ready = resolved.filter(_complete() & ~_overflows(resolved.columns)).withColumns(
        {"price_id": surrogate_key(natural_key), "created_at": at, "updated_at": at}
    )
    return ready.select(
        *[
            (F.col(name).cast(kind) if kind.startswith("decimal") else F.col(name)).alias(name)
            for name, kind in typed.items()
        ]
    )


def rejected_rows(resolved: DataFrame) -> DataFrame:
    """Rows with all keys that hold a value too large for the fact table."""
    return resolved.filter(_complete() & _overflows(resolved.columns))


def fact_statistics(resolved: DataFrame) -> DataFrame:
    """Rows loaded, rows skipped for a missing key and rows rejected for a value that does not fit."""
    overflow = _overflows(resolved.columns)
    return resolved.agg(
        F.count_if(_complete() & ~overflow).alias("inserted"), F.count_if(~_complete()).alias("skipped"),
        F.count_if(_complete() & overflow).alias("rejected"),
    )


NAMED_DIMENSIONS = {
    "dim_commodity": ("commodity", "commodity_name", "commodity_key"),
    "dim_market": ("market", "market_name", "market_key"),
    "dim_source": ("source", "source_name", "source_key"),
    "dim_currency": ("currency", "currency_code", "currency_key"),
}


def dimensions_with(dims: Mapping[str, DataFrame], rows: DataFrame) -> dict[str, DataFrame]:
    """The five dimensions, extended by the names and dates of new rows.

    New names get the next keys in alphabetical order.  A dimension's names are few by design, so numbering them
    in one task is bounded by the dimension, not by the facts.
    """
    out = dict(dims)
    for name, (column, label, key) in NAMED_DIMENSIONS.items():
        known = dims[name]
        fresh = rows.select(F.col(column).alias(label)).filter(F.col(label).isNotNull()).distinct()
        fresh = fresh.join(known.select(F.col(label).alias("__known")), F.col(label) == F.col("__known"), "left_anti")
        top = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("__top"))
        numbered = fresh.crossJoin(top).select(
            label, (F.col("__top") + F.row_number().over(Window.orderBy(label))).cast(known.schema[key].dataType).alias(key)
        )
        if "is_current" in known.columns:
            numbered = numbered.withColumns({"is_current": F.lit(True), "version": F.lit(1)})
        out[name] = known.unionByName(numbered, allowMissingColumns=True)
    days = dims["dim_date"]
    fresh = rows.select(F.col("date").cast("date").alias("calendar_date")).filter("calendar_date is not null").distinct()
    fresh = fresh.join(days.select(F.col("calendar_date").alias("__known")), F.col("calendar_date") == F.col("__known"), "left_anti")
    out["dim_date"] = days.unionByName(calendar_rows(fresh), allowMissingColumns=True)
    return out


def with_partition(df: DataFrame, grain: str) -> tuple[DataFrame, str]:
    """Physical partition column of date-keyed tables: one folder per day, or per month for small data."""
    if grain == "day":
        return df, "date_key"
    if grain == "month":
        return df.withColumn("month_key", F.floor(F.col("date_key") / 100).cast("int")), "month_key"
    raise ValueError(f"unknown grain {grain!r}")


def merge_partitions(incoming: DataFrame, path: str, *, keys: Sequence[str], part: str, order_by: Sequence[str] = ()) -> str:
    """Insert or replace rows by ``keys`` inside the partitions that the incoming rows fall into.

    Rows of a touched partition that no incoming key replaces stay; other partitions keep their files.  The
    partition has to follow from the key, so that a key never moves.  The touched partition values are the
    batch's days (or months), few enough to name in the scan, which then reads only their folders.  Of incoming rows
    with one key the first by ``order_by`` descending stays; without it, or among ties, one that depends on the rows
    alone and not on their order.

    Only partitions with a replaced row are written again; to the others the new rows are added as files.  Stored rows
    are looked up by a hash of their keys (an equal hash of other keys only rewrites a partition for nothing).
    """
    spark = incoming.sparkSession
    ranked = [*[F.col(c).desc_nulls_last() for c in order_by], F.xxhash64(*incoming.columns)]
    place = F.row_number().over(_of_one_key(keys, part).orderBy(*ranked))
    fresh = _dealt(incoming, keys, part).withColumn("__place", place).filter("__place = 1").drop("__place", "__hash")
    if not path_exists(spark, path):
        _write_parts(fresh, path, part, "overwrite")
        return path
    with scratch_copy(fresh, "fresh") as fresh:
        touched = [r[0] for r in fresh.select(part).distinct().collect()]
        stored = spark.read.parquet(path).filter(_among(part, touched))
        again = touched
        if _layout(stored, keys, part) == _layout(fresh, keys, part):
            hashed = F.xxhash64(*keys).alias("__hash")
            met = stored.select(part, hashed).join(fresh.select(hashed), "__hash", "left_semi").select(part).distinct()
            again = [r[0] for r in met.collect()]
        if again:
            both = stored.filter(_among(part, again)).withColumn("__stored", F.lit(1)).unionByName(
                fresh.filter(_among(part, again)).withColumn("__stored", F.lit(0)), allowMissingColumns=True
            )
            # the incoming row of a key takes the place of all that are stored; a key that does not come in keeps its rows
            first = F.min("__stored").over(_of_one_key(keys, part))
            merged = _dealt(both, keys, part).withColumn("__first", first).filter("__stored = __first")
            # a dynamic overwrite replaces folders when all tasks have ended, so the stored rows can be read meanwhile
            _write_parts(merged.drop("__stored", "__first", "__hash"), path, part, "overwrite")
        if set(touched) - set(again):
            _write_parts(fresh.filter(~_among(part, again)), path, part, "append")
    return path


def _among(part: str, values: Sequence) -> Column:
    """Whether the partition is one of the values; NULL is a value like others."""
    named = F.col(part).isin([v for v in values if v is not None])
    return F.coalesce(named, F.lit(None in values))


def _layout(df: DataFrame, keys: Sequence[str], part: str) -> dict[str, str]:
    """Columns and types; a partition column's type is read from folder names and counts only as a key."""
    return {c: kind if c != part or c in keys else "" for c, kind in df.dtypes}


def _dealt(df: DataFrame, keys: Sequence[str], part: str) -> DataFrame:
    """Rows with ``__hash`` of their key, shuffled once into ranges of (partition, hash).

    A key's rows are together as the windows of ``_of_one_key`` need them, a partition's rows as the writer needs them, and a
    large partition spreads over several ranges.
    """
    return df.withColumn("__hash", F.xxhash64(*keys)).repartitionByRange(part, "__hash")


def _of_one_key(keys: Sequence[str], part: str) -> WindowSpec:
    return Window.partitionBy(part, "__hash", *[k for k in keys if k != part])


def _write_parts(df: DataFrame, path: str, part: str, mode: str) -> None:
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_fact(fact: DataFrame, path: str, *, grain: str = "day") -> str:
    """Merge by ``price_id`` inside the touched days (or months); loaded rows of the same day stay."""
    keyed, part = with_partition(fact, grain)
    return merge_partitions(keyed, path, keys=["price_id"], part=part)


def fact_daily_summary(fact: DataFrame, *, order_by: Sequence[str]) -> DataFrame:
    """Gold daily summary from fact rows, in decimals."""
    daily = aggregates.daily_summary(
        fact, order_by=order_by, date="date_key", commodity="commodity_key", market="market_key",
        source="source_key",
    ).select(
        surrogate_key(["date", "commodity", "market"]).alias("summary_id"),
        F.col("date").alias("date_key"), F.col("commodity").alias("commodity_key"),
        F.col("market").alias("market_key"), "open_price", "high_price", "low_price", "close_price",
        "volume", "price_change", "price_change_pct", F.col("source_count").cast("int"),
        F.col("record_count").cast("int"),
    )
    return _gold(daily, "daily_price_summary")


def _gold(df: DataFrame, name: str) -> DataFrame:
    kinds = dict(c.strip().split(" ", 1) for c in TABLES[name].split(", "))
    return df.select(
        *[
            (F.col(c).try_cast(kinds[c]) if kinds[c].startswith("decimal") else F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def fact_period_summaries(daily: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weekly and monthly gold summaries from gold daily rows."""
    dated = daily.withColumn("date", date_of_key(F.col("date_key")))
    dated = dated.withColumn("close_price", F.col("close_price").cast("double"))
    weekly = aggregates.weekly_summary(dated, commodity="commodity_key").withColumnsRenamed(
        {"commodity": "commodity_key", "week": "week_of_year"}
    )
    monthly = aggregates.monthly_summary(dated, commodity="commodity_key").withColumnRenamed(
        "commodity", "commodity_key"
    )
    keep = ["avg_price", "min_price", "max_price", "total_volume"]
    return (
        _gold(
            weekly.select(
                surrogate_key(["year", "week_of_year", "commodity_key"]).alias("summary_id"),
                "year", "week_of_year", "commodity_key", *keep,
            ),
            "weekly_commodity_summary",
        ),
        _gold(
            monthly.select(
                surrogate_key(["year", "month", "commodity_key"]).alias("summary_id"),
                "year", "month", "commodity_key", *keep, "price_volatility",
            ),
            "monthly_commodity_summary",
        ),
    )


def _replace(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    (
        df.hint("rebalance", *parts).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    )


def _inside_periods(days: DataFrame, position: int, grain: str) -> Column:
    """Whether a date key (or month key) lies in a week (or month, or year) that one of the days lies in.

    The touched periods are few; named as key ranges they prune the folders of the daily table.
    """
    day = date_of_key(F.col("date_key"))
    if grain == "month":
        start, end = F.make_date(F.year(day), F.lit(1), F.lit(1)), F.make_date(F.year(day), F.lit(12), F.lit(31))
    elif position == 0:
        start = F.date_trunc("week", day).cast("date")
        # the summaries are cut at calendar years as well, so a week may be half of one
        end = F.date_add(start, 6)
    else:
        start, end = F.trunc(day, "month"), F.last_day(day)
    spans = days.select(date_key(start).alias("lo"), date_key(end).alias("hi"), F.year(day).alias("y")).distinct().collect()
    if grain == "month":
        return reduce(lambda a, b: a | b, [F.col("month_key").between(r["lo"] // 100, r["hi"] // 100) for r in spans], F.lit(False))
    return reduce(
        lambda a, b: a | b, [F.col("date_key").between(max(r["lo"], r["y"] * 10000), min(r["hi"], r["y"] * 10000 + 1231)) for r in spans], F.lit(False)
    )


def refresh_summaries(
    spark: SparkSession, fact_path: str, base: str, *, order_by: Sequence[str],
    touched: DataFrame | None = None, tables: Sequence[str] | None = None, grain: str = "day",
) -> list[str]:
    """Recompute the summary partitions that ``touched`` (date_key) falls into; all by default.

    Daily rows are replaced per day (or month), weekly and monthly ones per (year, week)
    and (year, month) (or year), each computed again from every daily row of the partition.
    """
    names = list(tables or ["daily_price_summary", "weekly_commodity_summary", "monthly_commodity_summary"])
    base = base.rstrip("/")
    daily_path = f"{base}/daily_price_summary"
    days = None if touched is None else touched.select("date_key").distinct()
    if "daily_price_summary" in names:
        fact, part = spark.read.parquet(fact_path), "date_key" if grain == "day" else "month_key"
        if days is not None:
            fact = fact.join(with_partition(days, grain)[0].select(part).distinct(), part, "left_semi")
        _replace(with_partition(fact_daily_summary(fact, order_by=order_by), grain)[0], daily_path, [part])
    day = date_of_key(F.col("date_key"))
    periods = {
        "weekly_commodity_summary": {"year": F.year(day), "week_of_year": F.weekofyear(day)},
        "monthly_commodity_summary": {"year": F.year(day), "month": F.month(day)},
    }
    for position, (name, parts) in enumerate(periods.items()):
        if name not in names:
            continue
        if grain == "month":
            parts = {"year": parts["year"]}
        rows = spark.read.parquet(daily_path)
        if days is not None:
            rows = rows.filter(_inside_periods(days, position, grain))
        _replace(fact_period_summaries(rows)[position], f"{base}/{name}", list(parts))
    return names


def verify_warehouse(fact: DataFrame, dims: Mapping[str, DataFrame], *, minimum: int = 1) -> DataFrame:
    """Row count, required cells and the five foreign keys as check rows."""
    return union_checks(
        [
            check_row_count(fact, minimum=minimum),
            check_missing_values(fact, required=[*FACT_KEYS, "close_price"]),
            referential_orphans(
                fact, {key: (dims["dim_" + key.removesuffix("_key")], key) for key in FACT_KEYS}
            ),
        ]
    )


def point_in_time(history: DataFrame, moment: Column) -> DataFrame:
    """Versions of a type-2 dimension that were valid at ``moment``."""
    return history.filter(
        (F.col("effective_date") <= moment) & (F.col("end_date").isNull() | (moment < F.col("end_date")))
    )


def write_snapshot(df: DataFrame, base: str) -> str:
    """Write the next numbered snapshot; readers follow the newest finished one."""
    spark = df.sparkSession
    number = (_snapshots(spark, base) or [0])[-1] + 1
    path = f"{base.rstrip('/')}/v={number:08d}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_snapshot(spark: SparkSession, base: str) -> DataFrame:
    numbers = _snapshots(spark, base)
    if not numbers:
        raise FileNotFoundError(f"no finished snapshot below {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/v={numbers[-1]:08d}")


def _snapshots(spark: SparkSession, base: str) -> list[int]:
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/v=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(s.getPath().getParent().getName().removeprefix("v=")) for s in (found or []))
