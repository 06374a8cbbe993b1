"""Raw landing zone: staging columns, sinks, scans, status and backfill ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake import reference_values as ref
from pricelake.functions.scalars import date_key

FORMATS = ("json", "csv", "parquet")


def add_staging_metadata(df: DataFrame, *, source: str, extraction_time: datetime | None = None) -> DataFrame:
    """Batch columns; a column the records already have is kept."""
    moment = extraction_time or datetime.now(timezone.utc)
    values = {
        "_staging_timestamp": moment.isoformat(),
        "_source": source,
        "_staging_id": f"{source}_{moment.timestamp()}",
    }
    return df.withColumns({k: F.lit(v) for k, v in values.items() if k not in df.columns})


def land(
    df: DataFrame, base: str, *, source: str, file_format: str = "json", extraction_time: datetime | None = None
) -> str:
    """Append one batch below ``base/source`` and return its folder."""
    if file_format not in FORMATS:
        raise ValueError(f"unknown format {file_format!r}")
    moment = extraction_time or datetime.now(timezone.utc)
    path = f"{base.rstrip('/')}/{source}/{source}_{moment:%Y%m%d_%H%M%S}.{file_format}"
    writer = df.write.mode("append")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)
    return path


def save_results(
    spark: SparkSession, results, base: str, *, source: str, schema: str | None = None,
    file_format: str = "json", extraction_time: datetime | None = None,
) -> str | None:
    """Stage records, a pandas frame or a DataFrame with batch columns; nothing to save gives None."""
    if isinstance(results, (list, pd.DataFrame)):
        if len(results) == 0:
            return None
        results = spark.createDataFrame(results, schema)
    elif not isinstance(results, DataFrame):
        raise TypeError(f"unsupported result type {type(results).__name__}")
    elif results.isEmpty():
        return None
    moment = extraction_time or datetime.now(timezone.utc)
    staged = add_staging_metadata(results, source=source, extraction_time=moment)
    return land(staged, base, source=source, file_format=file_format, extraction_time=moment)


def scan_landed(
    spark: SparkSession, base: str, schema: str, *, source: str = "*", file_format: str = "json",
    multi_line: bool = False,
) -> DataFrame:
    """All landed rows with the file they came from; ``multi_line`` reads JSON array files."""
    path = f"{base.rstrip('/')}/{source}/*.{file_format}"
    reader = spark.read.schema(schema).format(file_format)
    if file_format == "json":
        reader = reader.option("multiLine", multi_line)
    elif file_format == "csv":
        reader = reader.option("header", True)
    return reader.load(path).withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_file_size": F.col("_metadata.file_size"),
            "_file_time": F.col("_metadata.file_modification_time"),
        }
    )


def file_volumes(landed: DataFrame, *, name: str) -> DataFrame:
    """Rows and bytes per landed file and day, as volume growth wants them."""
    return landed.groupBy("_file").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("_file_size").alias("byte_count"),
        F.to_date(F.max("_file_time")).alias("day"),
    ).select(F.lit(name).alias("table"), "day", "row_count", "byte_count")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _has_batches(spark: SparkSession, path: str, file_format: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*.{file_format}")
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def staging_status(
    spark: SparkSession, base: str, sources: Sequence[str], *, file_format: str = "json"
) -> DataFrame:
    """Per source: status, latest batch, number of batches, rows and time of the latest batch."""
    base = base.rstrip("/")
    state = {}
    for source in sources:
        if not _exists(spark, f"{base}/{source}"):
            state[source] = "no_data"
        else:
            state[source] = "active" if _has_batches(spark, f"{base}/{source}", file_format) else "no_files"
    listed = spark.createDataFrame(list(state.items()), "source string, status string")
    active = [s for s, status in state.items() if status == "active"]
    counts = None
    for source in active:
        rows = scan_landed(spark, base, "_source string", source=source, file_format=file_format)
        rows = rows.select(F.lit(source).alias("__source"), "_file", "_file_time")
        counts = rows if counts is None else counts.unionByName(rows)
    empty = F.lit(None)
    if counts is None:
        return listed.withColumns(
            {
                "latest_file": empty.cast("string"), "file_count": empty.cast("long"),
                "latest_row_count": empty.cast("long"), "latest_timestamp": empty.cast("timestamp"),
            }
        )
    batch = F.regexp_extract("_file", r"^(.*/[^/]+\." + file_format + ")/", 1)
    batches = counts.groupBy("__source", batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("_file_time").alias("at")
    )
    summary = batches.groupBy("__source").agg(
        F.max("batch").alias("latest_file"),
        F.count(F.lit(1)).alias("file_count"),
        F.max_by("rows", "batch").alias("latest_row_count"),
        F.max_by("at", "batch").alias("latest_timestamp"),
    )
    return listed.join(summary, F.col("source") == F.col("__source"), "left").drop("__source")


def batch_results(
    spark: SparkSession, rows: DataFrame, sources: Sequence[str], *, storage_type: str = "local",
    staged_paths: Mapping[str, str] | None = None,
) -> DataFrame:
    """Result row per source: success with its record count, or no_data."""
    paths = staged_paths or {}
    listed = spark.createDataFrame([(s, paths.get(s)) for s in sources], "source string, staged_path string")
    counted = rows.groupBy(F.col("_source").alias("__source")).agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    return listed.join(counted, F.col("source") == F.col("__source"), "left").select(
        F.when(n > 0, "success").otherwise("no_data").alias("status"),
        "source", n.alias("record_count"), F.lit(storage_type).alias("storage_type"),
        F.when(n > 0, F.col("staged_path")).alias("staged_path"),
    )


def consolidate(results: DataFrame, status: DataFrame) -> DataFrame:
    """Batch results with the staging status of each source."""
    staged = status.select(
        F.col("source").alias("__source"), F.col("status").alias("__staged"), "latest_file"
    )
    ok = F.col("status") == "success"
    joined = results.join(staged, F.col("source") == F.col("__source"), "left")
    return joined.select(
        "source", F.col("status").alias("parser_status"), "record_count",
        F.when(ok, F.col("__staged")).otherwise("not_extracted").alias("staging_status"),
        F.when(ok, F.col("latest_file")).alias("latest_file"), "staged_path",
    )


def consolidation_summary(consolidated: DataFrame) -> DataFrame:
    """One row: staged when at least one source is active."""
    active = F.count_if(F.col("staging_status") == "active")
    return consolidated.agg(
        F.when(active > 0, "staged").otherwise("no_data").alias("status"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_record_count"),
        active.alias("active_staged_sources"),
        F.count(F.lit(1)).alias("source_count"),
    )


def union_sources(frames: Mapping[str, DataFrame]) -> DataFrame:
    """All sources in one frame; columns a source lacks are NULL."""
    total = None
    for source, frame in frames.items():
        tagged = frame if "_source" in frame.columns else frame.withColumn("_source", F.lit(source))
        total = tagged if total is None else total.unionByName(tagged, allowMissingColumns=True)
    return total


def source_counts(rows: DataFrame) -> DataFrame:
    """Rows and usable rows per source."""
    return rows.groupBy("_source").agg(
        F.count(F.lit(1)).alias("record_count"), F.count_if(F.col("note") == ref.NOTE_OK).alias("ok_count")
    )


def write_silver(df: DataFrame, path: str, *, date: str = "date") -> str:
    """Write by ``date_key``, replacing only the dates present.

    The rebalance hint groups a date's rows and lets AQE split a heavy date into
    several files and merge light ones.
    """
    keyed = df if "date_key" in df.columns else df.withColumn("date_key", date_key(F.col(date)))
    (
        keyed.hint("rebalance", "date_key").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("date_key").parquet(path)
    )
    return path


def scan_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def backfill_range(
    df: DataFrame, start: date | str, end: date | str, *, sources: Sequence[str] | None = None,
    key: str = "date_key", source: str = "source",
) -> DataFrame:
    """Rows of the closed date range; the filter is on the partition column, so it prunes folders."""
    def as_key(day) -> int:
        return int(str(day).replace("-", "")[:8])

    chosen = df.filter(F.col(key).between(as_key(start), as_key(end)))
    return chosen if sources is None else chosen.filter(F.col(source).isin(*sources))


def last_days(days: int, today: date | None = None) -> tuple[date, date]:
    end = today or datetime.now(timezone.utc).date()
    return end - timedelta(days=days), end


def month_range(year: int, month: int) -> tuple[date, date]:
    start = date(year, month, 1)
    following = date(year + month // 12, month % 12 + 1, 1)
    return start, following - timedelta(days=1)


def month_bounds(year: Column, month: Column) -> tuple[Column, Column]:
    """The same inside a query."""
    first = F.make_date(year, month, F.lit(1))
    return first, F.last_day(first)
