"""Operation logs, alerts and health reports as queries over log tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.operators.series import join_null_safe

# ---------------------------------------------------------------- operation log


def _log(df: DataFrame, operation: Column, status: Column, details: Mapping[str, Column], level: Column) -> DataFrame:
    entries = [part for k, v in details.items() for part in (F.lit(k), v.cast("string"))]
    described = (
        F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())
        if entries else F.create_map().cast("map<string,string>")
    )
    return df.select(
        F.col("timestamp").cast("timestamp").alias("timestamp"), operation.alias("operation"),
        status.alias("status"), described.alias("details"), level.alias("level"),
    )


def _columns(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def operation_log(df: DataFrame) -> DataFrame:
    """From ``(timestamp, operation, status)`` and, where present, ``details`` and ``level``."""
    details = F.col("details") if "details" in df.columns else F.create_map().cast("map<string,string>")
    level = F.col("level") if "level" in df.columns else F.lit("INFO")
    return df.select(
        F.col("timestamp").cast("timestamp").alias("timestamp"), "operation", "status",
        F.coalesce(details, F.create_map().cast("map<string,string>")).alias("details"),
        F.coalesce(level, F.lit("INFO")).alias("level"),
    )


def extraction_log(df: DataFrame) -> DataFrame:
    """From ``(timestamp, source, record_count, duration_seconds, status)``."""
    return _log(
        df, F.concat(F.lit("extract_"), "source"), F.col("status"),
        _columns("source", "record_count", "duration_seconds"), F.lit("INFO"),
    )


def transformation_log(df: DataFrame) -> DataFrame:
    """From ``(timestamp, operation_type, input_count, output_count, duration_seconds, status)``."""
    details = _columns("operation_type", "input_count", "output_count", "duration_seconds")
    details["records_dropped"] = F.col("input_count") - F.col("output_count")
    return _log(df, F.concat(F.lit("transform_"), "operation_type"), F.col("status"), details, F.lit("INFO"))


def quality_log(df: DataFrame) -> DataFrame:
    """From check rows with a ``timestamp``."""
    details = _columns("row_count", "null_count", "error_message")
    return _log(
        df, F.concat(F.lit("quality_check_"), "check_name"),
        F.when(F.col("passed"), "passed").otherwise("failed"), details,
        F.when(F.col("passed"), "INFO").otherwise("ERROR"),
    )


def load_log(df: DataFrame) -> DataFrame:
    """From ``(timestamp, table, records_inserted, records_updated, duration_seconds, status)``."""
    return _log(
        df, F.concat(F.lit("warehouse_load_"), "table"), F.col("status"),
        _columns("table", "records_inserted", "records_updated", "duration_seconds"), F.lit("INFO"),
    )


def error_log(df: DataFrame) -> DataFrame:
    """From ``(timestamp, operation, error_message, traceback)``."""
    return _log(
        df, F.col("operation"), F.lit("failed"), _columns("error_message", "traceback"), F.lit("ERROR")
    )


def warning_log(df: DataFrame, details: Sequence[str] = ()) -> DataFrame:
    """From ``(timestamp, operation, warning_message)`` plus the named detail columns."""
    return _log(
        df, F.col("operation"), F.lit("warning"), _columns("warning_message", *details), F.lit("WARNING")
    )


def json_lines(log: DataFrame) -> DataFrame:
    """One JSON text per entry, ready for a text sink."""
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return log.select(
        F.to_json(F.struct(stamp.alias("timestamp"), "operation", "status", "details")).alias("value")
    )


def operation_summary(log: DataFrame) -> DataFrame:
    """Counts in total, by status and by operation, from one pass."""
    pairs = log.groupBy("status", "operation").agg(F.count(F.lit(1)).alias("n"))
    kinds = F.array(
        F.struct(F.lit("total").alias("kind"), F.lit("all").alias("name")),
        F.struct(F.lit("status").alias("kind"), F.col("status").alias("name")),
        F.struct(F.lit("operation").alias("kind"), F.col("operation").alias("name")),
    )
    return (
        pairs.select("n", F.inline(kinds)).groupBy("kind", "name").agg(F.sum("n").alias("operation_count"))
    )


def last_rows(log: DataFrame, *, order_by: Sequence[str] = ("timestamp",), limit: int = 100) -> DataFrame:
    """The newest entries (a top-k, not a sort of the whole log); ties are broken by all other columns."""
    rest = [
        F.to_json(c) if kind.startswith("map") else F.col(c) for c, kind in log.dtypes if c not in order_by
    ]
    return log.orderBy(*[F.col(c).desc() for c in order_by], *rest).limit(limit)


def load_report(log: DataFrame, *, limit: int = 100) -> DataFrame:
    """Newest warehouse load entries."""
    return last_rows(log.filter(F.col("operation").startswith("warehouse_load_")), limit=limit)


# ---------------------------------------------------------------- alert suppression

#: Lengths of the time blocks in windows, small blocks first.
BLOCKS = (64, 4_096)


def _jump(starts: np.ndarray, lasts: np.ndarray, window: int) -> np.ndarray:
    """For every piece, the piece the chain enters next (len = none)."""
    return np.searchsorted(starts, lasts + window, side="left")


def _summarise(window: int, size: int):
    """Reduce the pieces of a block to those a chain can enter first, each with its last kept time."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("start", ignore_index=True)
        starts, lasts = pdf["start"].to_numpy(), pdf["last"].to_numpy()
        step = _jump(starts, lasts, window)
        end = np.where(step < len(starts), step, np.arange(len(starts)))
        while True:
            further = end[end]
            if np.array_equal(further, end):
                break
            end = further
        edge = (starts[0] // size) * size + window
        entries = int(np.searchsorted(starts, edge, side="left")) + 1
        out = pdf.iloc[:entries].copy()
        out["last"] = lasts[end[:entries]]
        return out

    return run


def _walk(window: int):
    """Pieces visited by the chain that enters a block at ``entry``."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("start", ignore_index=True)
        starts = pdf["start"].to_numpy()
        step = _jump(starts, pdf["last"].to_numpy(), window)
        at = int(np.searchsorted(starts, pdf["entry"].iloc[0], side="left"))
        visited = []
        while at < len(starts):
            visited.append(at)
            at = int(step[at])
        return pdf.iloc[visited][["title", "start"]]

    return run


def kept_times(
    alerts: DataFrame, *, title: str = "title", timestamp: str = "timestamp", window_seconds: int = 3600,
    direct_points: int | None = None,
) -> DataFrame:
    """Times ``(title, start)`` in microseconds that survive suppression.

    An alert is kept when the last kept alert of its title is at least the window
    away, so each decision depends on the one before.  Time is cut into blocks: a chain can
    enter a block only within its first window, so a block is summed up by those entry
    points and where their chains end (pointers to the next kept one, doubled until they
    stay); blocks are summed up again into larger blocks, and the one true entry of each
    block is handed down again.  A group holds the times of 64 windows of one title, or the
    entry points of 64 blocks; the last one, a title's, those of one window per 4,096. The
    levels are fixed, so building the plan starts no job. ``direct_points`` chose another
    route once; it is accepted and changes nothing.
    """
    micros = window_seconds * 1_000_000
    stamp = F.unix_micros(F.col(timestamp).cast("timestamp"))
    points = alerts.select(F.col(title).alias("title"), stamp.alias("start")).filter(
        F.col("start").isNotNull()
    ).distinct()
    points = points.withColumn("last", F.col("start"))
    sizes = [n * micros for n in BLOCKS]
    pieces = "title string, start long, last long"
    levels = [points]
    for size in sizes:
        block = F.floor(F.col("start") / size)
        levels.append(
            levels[-1].groupBy("title", block.alias("block")).applyInPandas(_summarise(micros, size), pieces)
        )
    walk, visited = _walk(micros), "title string, start long"
    doors = levels[-1].groupBy(F.col("title").alias("__t")).agg(F.min("start").alias("entry"))
    entered = levels[-1].join(doors, F.col("title").eqNullSafe(F.col("__t"))).drop("__t")
    kept = entered.groupBy("title").applyInPandas(walk, visited)
    for level, size in zip(reversed(levels[:-1]), reversed(sizes)):
        block = F.floor(F.col("start") / size)
        doors = kept.select(F.col("title").alias("__t"), block.alias("__b"), F.col("start").alias("entry"))
        inside = level.withColumn("block", block)
        entered = inside.join(
            doors, inside["title"].eqNullSafe(F.col("__t")) & (inside["block"] == F.col("__b"))
        ).drop("__t", "__b")
        kept = entered.groupBy("title", "block").applyInPandas(walk, visited)
    return kept


def suppress_alerts(
    alerts: DataFrame, *, tie_break: Sequence[str], title: str = "title", timestamp: str = "timestamp",
    window_seconds: int = 3600, direct_points: int | None = None,
) -> DataFrame:
    """Alerts that are sent; of several at one kept instant the first by ``tie_break``."""
    kept = kept_times(
        alerts, title=title, timestamp=timestamp, window_seconds=window_seconds, direct_points=direct_points
    ).select(F.col("title").alias("__t"), F.col("start").alias("__s"))
    stamp = F.unix_micros(F.col(timestamp).cast("timestamp"))
    hit = alerts.withColumn("__us", stamp)
    sent = hit.join(kept, hit[title].eqNullSafe(F.col("__t")) & (F.col("__us") == F.col("__s")), "left_semi")
    first = Window.partitionBy(title, "__us").orderBy(*tie_break)
    return sent.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").drop("__rn", "__us")


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Alerts per level and in total."""
    levels = alerts.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(F.lit("total"), F.col("level"))
    return levels.select("n", F.explode(names).alias("level")).groupBy("level").agg(
        F.sum("n").alias("alert_count")
    )


def _alert(df: DataFrame, title: Column, message: Column, level: str, metadata: Mapping[str, Column]) -> DataFrame:
    entries = [part for k, v in metadata.items() for part in (F.lit(k), v.cast("string"))]
    return df.select(
        F.col("timestamp").cast("timestamp").alias("timestamp"), title.alias("title"), message.alias("message"),
        F.lit(level).alias("level"), F.create_map(*entries).alias("metadata"), F.lit(False).alias("sent"),
    )


def extraction_failures(log: DataFrame) -> DataFrame:
    """Alert per failed extraction of an operation log."""
    failed = log.filter(F.col("operation").startswith("extract_") & (F.col("status") == "failed"))
    source = F.regexp_replace("operation", "^extract_", "")
    return _alert(
        failed, F.concat(F.lit("Extraction Failed: "), source),
        F.concat(F.lit("Data extraction failed for source "), source), "error",
        {"source": source, "error": F.try_element_at("details", F.lit("error_message"))},
    )


def quality_failures(checks: DataFrame) -> DataFrame:
    """Alert per failed check row with a ``timestamp``."""
    name = F.col("check_name")
    return _alert(
        checks.filter(~F.col("passed")), F.concat(F.lit("Quality Check Failed: "), name),
        F.concat(F.lit("Data quality check failed: "), name), "error",
        {"check": name, "details": F.col("error_message")},
    )


def sla_breaches(runs: DataFrame, *, sla_minutes: float) -> DataFrame:
    """Alert per run ``(timestamp, dag, duration_minutes)`` slower than its allowance."""
    actual = F.col("duration_minutes").cast("string")
    allowed = F.lit(float(sla_minutes)).cast("string")
    return _alert(
        runs.filter(F.col("duration_minutes") > sla_minutes), F.concat(F.lit("SLA Breach: "), "dag"),
        F.concat(F.lit("DAG "), F.col("dag"), F.lit(" took "), actual, F.lit("m, SLA is "), allowed, F.lit("m")),
        "warning", {"dag": F.col("dag"), "actual_minutes": actual, "sla_minutes": allowed},
    )


def data_anomalies(rows: DataFrame) -> DataFrame:
    """Alert per flagged row ``(timestamp, anomaly_type, details)``."""
    kind = F.col("anomaly_type")
    return _alert(
        rows, F.concat(F.lit("Data Anomaly: "), kind), F.concat(F.lit("Anomaly detected: "), kind), "warning",
        {"type": kind, "details": F.col("details")},
    )


# ---------------------------------------------------------------- health


def source_health(log: DataFrame, sources: DataFrame) -> DataFrame:
    """Per expected source: last extraction, last success, records, errors and status."""
    source = F.regexp_replace("operation", "^extract_", "")
    records = F.try_element_at("details", F.lit("record_count")).try_cast("double").cast("long")
    seen = (
        log.filter(F.col("operation").startswith("extract_"))
        .groupBy(source.alias("__source"))
        .agg(
            F.max("timestamp").alias("last_extraction"),
            F.max(F.when(F.col("status") == "completed", F.col("timestamp"))).alias("last_update"),
            F.coalesce(F.sum(records), F.lit(0)).alias("record_count"),
            F.count_if(F.col("status") == "failed").alias("error_count"),
            F.max_by("status", "timestamp").alias("last_status"),
        )
    )
    joined = sources.select("source").join(seen, F.col("source") == F.col("__source"), "left").drop("__source")
    healthy = F.col("last_status") != "failed"
    return joined.select(
        "source", F.when(healthy, "HEALTHY").otherwise("UNHEALTHY").alias("status"),
        "last_extraction", "last_update", F.coalesce("record_count", F.lit(0)).alias("record_count"),
        F.coalesce("error_count", F.lit(0)).alias("error_count"),
    )


def pipeline_performance(runs: DataFrame) -> DataFrame:
    """Per DAG: mean and 95th percentile duration (exact: the value of that rank) and success rate.

    Durations are collapsed to (value, frequency) first, so the ranks are sums over distinct values.
    """
    figures = runs.groupBy("dag").agg(
        F.count(F.lit(1)).alias("run_count"),
        F.avg("duration_minutes").alias("average_duration_minutes"),
        F.avg((F.col("status") == "completed").cast("double")).alias("success_rate"),
    )
    values = runs.filter(F.col("duration_minutes").isNotNull()).groupBy("dag", "duration_minutes").agg(F.count("*").alias("__c"))
    upto = Window.partitionBy("dag").orderBy("duration_minutes").rowsBetween(Window.unboundedPreceding, 0)
    totals = values.groupBy("dag").agg(F.sum("__c").alias("__n"))
    ranked = join_null_safe(values.withColumn("__end", F.sum("__c").over(upto)), totals, ["dag"])
    p95 = ranked.filter(F.col("__end") * 100 >= F.col("__n") * 95).groupBy("dag").agg(
        F.min("duration_minutes").alias("p95_duration_minutes")
    )
    return join_null_safe(figures, p95, ["dag"]).select(
        "dag", "run_count", "average_duration_minutes", "p95_duration_minutes", "success_rate"
    )


def volume_growth(files: DataFrame) -> DataFrame:
    """Rows and bytes per table and day with day-over-day growth.

    ``files`` has ``(table, day, row_count, byte_count)``; after the daily sums a table has
    one row per calendar day, which bounds the window.
    """
    days = files.groupBy("table", "day").agg(
        F.sum("row_count").alias("row_count"), F.sum("byte_count").alias("byte_count")
    )
    order = Window.partitionBy("table").orderBy("day")
    before = F.lag("byte_count", 1).over(order)
    total = F.sum("byte_count").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return days.withColumns(
        {
            "total_bytes": total,
            "growth_bytes": F.col("byte_count") - before,
            "growth_rate_percent": F.try_divide((F.col("byte_count") - before) * 100.0, before),
        }
    )


def health_report(checks: DataFrame, *, limit: int = 10) -> DataFrame:
    """Newest health checks, newest first, with the last one marked."""
    newest = last_rows(checks, limit=limit)
    latest = checks.agg(F.max("timestamp")).scalar()
    return newest.withColumn("is_last_check", F.col("timestamp") == latest)
