"""Registered operation-log, alert, health and streaming queries over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.operators import oplog
from pricelake.plans.registry import register, sql_stable, stabled
from pricelake.session import scratch_path
from pricelake.sources.canonical import table
from pricelake.streaming import jobs


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def extraction_runs(spark, sf_dir):
    return events(spark, sf_dir).select(
        F.col("ts").alias("timestamp"), F.col("event_type").alias("source"),
        F.col("user_id").alias("record_count"), F.col("value").alias("duration_seconds"),
        F.when(F.col("event_id") % 10 == 0, "failed").otherwise("completed").alias("status"), "event_id",
    )


def extraction_log(spark, sf_dir):
    return oplog.extraction_log(extraction_runs(spark, sf_dir))


STATUS_SQL = "case when event_id % 10 = 0 then 'failed' else 'completed' end"


@register(
    "o1_extraction_log",
    f"""select ts as timestamp, 'extract_' || event_type as operation, {STATUS_SQL} as status, 'INFO' as level,
      event_type as source, cast(user_id as varchar) as record_count, value as duration_seconds from events""",
)
def o1_extraction_log(spark, sf_dir):
    detail = lambda k: F.try_element_at("details", F.lit(k))
    return extraction_log(spark, sf_dir).select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "operation", "status", "level",
        detail("source").alias("source"), detail("record_count").alias("record_count"),
        detail("duration_seconds").cast("double").alias("duration_seconds"),
    )


@register(
    "o1_transformation_log",
    """select 'transform_' || event_type as operation, cast(user_id + event_id - event_id as varchar) as dropped,
         'INFO' as level, count(*) as row_count from events group by 1, 2, 3""",
)
def o1_transformation_log(spark, sf_dir):
    runs = events(spark, sf_dir).select(
        F.col("ts").alias("timestamp"), F.col("event_type").alias("operation_type"),
        (F.col("user_id") + F.col("event_id")).alias("input_count"), F.col("event_id").alias("output_count"),
        F.col("value").alias("duration_seconds"), F.lit("completed").alias("status"),
    )
    dropped = F.try_element_at("details", F.lit("records_dropped"))
    return oplog.transformation_log(runs).groupBy("operation", dropped.alias("dropped"), "level").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@register(
    "o1_typed_logs",
    """select 'quality_check_' || event_type as operation, case when value > 20 then 'passed' else 'failed' end as status,
         case when value > 20 then 'INFO' else 'ERROR' end as level, count(*) as row_count from events group by 1, 2, 3
       union all select 'warehouse_load_' || event_type, 'completed', 'INFO', count(*) from events group by 1
       union all select event_type, 'failed', 'ERROR', count(*) from events group by 1
       union all select event_type, 'warning', 'WARNING', count(*) from events group by 1""",
)
def o1_typed_logs(spark, sf_dir):
    rows = events(spark, sf_dir).withColumnRenamed("ts", "timestamp")
    checks = rows.select(
        "timestamp", F.col("event_type").alias("check_name"), (F.col("value") > 20).alias("passed"),
        F.col("user_id").alias("row_count"), F.col("event_id").alias("null_count"), F.col("props").alias("error_message"),
    )
    loads = rows.select(
        "timestamp", F.col("event_type").alias("table"), F.col("user_id").alias("records_inserted"),
        F.col("event_id").alias("records_updated"), F.col("value").alias("duration_seconds"),
        F.lit("completed").alias("status"),
    )
    errors = rows.select(
        "timestamp", F.col("event_type").alias("operation"), F.col("props").alias("error_message"),
        F.lit(None).cast("string").alias("traceback"),
    )
    warnings = errors.select("timestamp", "operation", F.col("error_message").alias("warning_message"))
    logs = (
        oplog.quality_log(checks).unionByName(oplog.load_log(loads)).unionByName(oplog.error_log(errors))
        .unionByName(oplog.warning_log(warnings))
    )
    return logs.groupBy("operation", "status", "level").agg(F.count(F.lit(1)).alias("row_count"))


@register("o1_json_lines")
def o1_json_lines(spark, sf_dir):
    return oplog.json_lines(extraction_log(spark, sf_dir))


@register(
    "o2_operation_summary",
    f"""select 'total' as kind, 'all' as name, count(*) as operation_count from events
       union all select 'status', {STATUS_SQL}, count(*) from events group by 2
       union all select 'operation', 'extract_' || event_type, count(*) from events group by 2""",
)
def o2_operation_summary(spark, sf_dir):
    return oplog.operation_summary(extraction_log(spark, sf_dir))


@register(
    "o3_last_operations",
    f"""select ts as timestamp, 'extract_' || event_type as operation, {STATUS_SQL} as status from events
       order by ts desc limit 100""",
)
def o3_last_operations(spark, sf_dir):
    return oplog.last_rows(extraction_log(spark, sf_dir), limit=100).select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "operation", "status"
    )


SUPPRESSED_SQL = """with recursive ranked as (
  select event_id, event_type, ts, row_number() over (partition by event_type order by ts, event_id) as rn from events),
walk as (
  select event_id, event_type, ts, rn, ts as last_kept, true as kept from ranked where rn = 1
  union all
  select r.event_id, r.event_type, r.ts, r.rn,
    case when r.ts - w.last_kept >= interval 3600 second then r.ts else w.last_kept end,
    r.ts - w.last_kept >= interval 3600 second
  from walk w join ranked r on r.event_type = w.event_type and r.rn = w.rn + 1)
"""


@register("o4_alert_suppression", SUPPRESSED_SQL + "select event_id, event_type, ts from walk where kept")
def o4_alert_suppression(spark, sf_dir):
    sent = oplog.suppress_alerts(
        events(spark, sf_dir), tie_break=["event_id"], title="event_type", timestamp="ts"
    )
    return sent.select("event_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


@register("o4_alert_suppression_blocks", SUPPRESSED_SQL + "select event_id, event_type, ts from walk where kept")
def o4_alert_suppression_blocks(spark, sf_dir):
    """The same through time blocks, as a title too large for one task takes it."""
    sent = oplog.suppress_alerts(
        events(spark, sf_dir), tie_break=["event_id"], title="event_type", timestamp="ts", direct_points=0
    )
    return sent.select("event_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


LEVEL_SQL = "case when value > 50 then 'critical' when value > 20 then 'error' else 'warning' end"


@register(
    "o5_alert_summary",
    f"""select {LEVEL_SQL} as level, count(*) as alert_count from events group by 1
       union all select 'total', count(*) from events""",
)
def o5_alert_summary(spark, sf_dir):
    value = F.col("value")
    level = F.when(value > 50, "critical").when(value > 20, "error").otherwise("warning")
    return oplog.alert_summary(events(spark, sf_dir).withColumn("level", level))


@register(
    "o5_recent_alerts",
    "select event_id, event_type, ts from events order by ts desc limit 10",
)
def o5_recent_alerts(spark, sf_dir):
    recent = oplog.last_rows(events(spark, sf_dir), order_by=["ts"], limit=10)
    return recent.select("event_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))


@register(
    "o6_alert_rules",
    """select ts as timestamp, 'Extraction Failed: ' || event_type as title,
         'Data extraction failed for source ' || event_type as message, 'error' as level, event_type as about
       from events where event_id % 10 = 0
       union all select ts, 'SLA Breach: ' || event_type,
         'DAG ' || event_type || ' took ' || value || 'm, SLA is 30.0m', 'warning', event_type from events where value > 30
       union all select ts, 'Quality Check Failed: ' || event_type, 'Data quality check failed: ' || event_type, 'error',
         event_type from events where value <= 5
       union all select ts, 'Data Anomaly: ' || event_type, 'Anomaly detected: ' || event_type, 'warning', event_type
         from events where value > 60""",
)
def o6_alert_rules(spark, sf_dir):
    rows = events(spark, sf_dir).withColumnRenamed("ts", "timestamp")
    alerts = (
        oplog.extraction_failures(extraction_log(spark, sf_dir))
        .unionByName(
            oplog.sla_breaches(
                rows.select("timestamp", F.col("event_type").alias("dag"), F.col("value").alias("duration_minutes")),
                sla_minutes=30,
            )
        )
        .unionByName(
            oplog.quality_failures(
                rows.select(
                    "timestamp", F.col("event_type").alias("check_name"), (F.col("value") > 5).alias("passed"),
                    F.col("props").alias("error_message"),
                )
            )
        )
        .unionByName(
            oplog.data_anomalies(
                rows.filter("value > 60").select(
                    "timestamp", F.col("event_type").alias("anomaly_type"), F.col("props").alias("details")
                )
            )
        )
    )
    about = F.coalesce(*[F.try_element_at("metadata", F.lit(k)) for k in ("source", "dag", "check", "type")])
    return alerts.select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "title", "message", "level", about.alias("about")
    )


@register(
    "o7_source_health",
    f"""select event_type as source, case arg_max({STATUS_SQL}, ts) when 'failed' then 'UNHEALTHY' else 'HEALTHY' end as status,
         max(ts) as last_extraction, max(ts) filter (event_id % 10 <> 0) as last_update,
         cast(sum(user_id) as bigint) as record_count, count(*) filter (event_id % 10 = 0) as error_count
       from events group by event_type
       union all select 'missing', 'UNHEALTHY', null, null, 0, 0""",
)
def o7_source_health(spark, sf_dir):
    log = extraction_log(spark, sf_dir)
    known = events(spark, sf_dir).select(F.col("event_type").alias("source")).distinct()
    sources = known.unionByName(spark.createDataFrame([("missing",)], "source string"))
    plain = {c: F.col(c).cast("timestamp_ntz") for c in ("last_extraction", "last_update")}
    return oplog.source_health(log, sources).withColumns(plain)


@register(
    "o8_pipeline_performance",
    f"""select event_type as dag, count(*) as run_count, {sql_stable("avg(value)")} as average_duration_minutes,
         quantile_disc(value, 0.95) as p95_duration_minutes,
         {sql_stable("avg(case when event_id % 10 = 0 then 0.0 else 1.0 end)", 6)} as success_rate
       from events group by event_type""",
)
def o8_pipeline_performance(spark, sf_dir):
    runs = extraction_runs(spark, sf_dir).select(
        F.col("source").alias("dag"), F.col("duration_seconds").alias("duration_minutes"), "status"
    )
    out = oplog.pipeline_performance(runs)
    return stabled(stabled(out, "average_duration_minutes"), "success_rate", digits=6)


@register(
    "o9_volume_growth",
    f"""with days as (select event_type as "table", cast(ts as date) as day, count(*) as row_count,
        cast(sum(length(props)) as bigint) as byte_count from events group by 1, 2)
    select "table", day, row_count, byte_count,
      cast(sum(byte_count) over (w rows unbounded preceding) as bigint) as total_bytes,
      byte_count - lag(byte_count) over w as growth_bytes,
      {sql_stable("(byte_count - lag(byte_count) over w) * 100.0 / nullif(lag(byte_count) over w, 0)")} as growth_rate_percent
    from days window w as (partition by "table" order by day)""",
)
def o9_volume_growth(spark, sf_dir):
    files = events(spark, sf_dir).select(
        F.col("event_type").alias("table"), F.col("ts").cast("date").alias("day"),
        F.lit(1).cast("long").alias("row_count"), F.length("props").cast("long").alias("byte_count"),
    )
    return stabled(oplog.volume_growth(files), "growth_rate_percent")


@register(
    "o10_health_report",
    """select ts as timestamp, event_type as name, ts = (select max(ts) from events) as is_last_check
       from events order by ts desc limit 10""",
)
def o10_health_report(spark, sf_dir):
    checks = events(spark, sf_dir).select(F.col("ts").alias("timestamp"), F.col("event_type").alias("name"))
    return oplog.health_report(checks).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# ---------------------------------------------------------------- streaming


def stream(spark, sf_dir):
    # a pattern, because a stream wants a folder or a pattern and the table may be one file
    return jobs.read_events(spark, f"{sf_dir.rstrip('/')}/events.parque[t]")


EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value", "day"]


@register(
    "t1_incremental_load",
    "select event_id, user_id, event_type, value, cast(ts as date) as day from events",
)
def t1_incremental_load(spark, sf_dir):
    base = scratch_path(spark, "t1")
    rows = stream(spark, sf_dir).withColumn("day", F.col("ts").cast("date"))
    load = jobs.partition_loader(f"{base}/table", partition="day", keys=["event_id"], order_by=["ts"])
    jobs.run_available(rows, f"{base}/checkpoint", each_batch=load)
    return spark.read.parquet(f"{base}/table").select(*EVENT_COLUMNS)


@register(
    "t1_append_log",
    "select event_id, user_id, event_type, value, cast(ts as date) as day from events",
)
def t1_append_log(spark, sf_dir):
    """Events appended in micro-batches, compacted, replayed once more, and read back by key."""
    base = scratch_path(spark, "t1")
    rows = stream(spark, sf_dir).withColumn("day", F.col("ts").cast("date"))
    load, newest = jobs.append_log(f"{base}/log"), {"keys": ["event_id"], "order_by": ["ts"]}
    jobs.run_available(rows, f"{base}/checkpoint", each_batch=load)
    jobs.compact_log(spark, f"{base}/log", **newest)
    jobs.run_available(rows, f"{base}/checkpoint-again", each_batch=load)
    return jobs.latest_rows(spark, f"{base}/log", **newest).select(*EVENT_COLUMNS)


@register("t2_stream_dedup", "select distinct user_id, event_type from events")
def t2_stream_dedup(spark, sf_dir):
    base = scratch_path(spark, "t2")
    rows = jobs.dedup_stream(stream(spark, sf_dir), keys=["user_id", "event_type"], timestamp="ts", delay="60 days")
    jobs.run_available(rows, f"{base}/checkpoint", path=f"{base}/table")
    return spark.read.parquet(f"{base}/table").select("user_id", "event_type")


@register(
    "t3_stream_daily",
    """select cast(ts as date) as date, event_type, arg_min(value, row(ts, event_id)) as open_price,
         max(value) as high_price, min(value) as low_price, arg_max(value, row(ts, event_id)) as close_price,
         sum(user_id)::double as volume, count(*) as record_count
       from events group by 1, 2""",
)
def t3_stream_daily(spark, sf_dir):
    base = scratch_path(spark, "t3")
    rows = stream(spark, sf_dir).withColumn("user_id", F.col("user_id").cast("double"))
    days = jobs.daily_ohlcv_stream(
        rows, keys=["event_type"], timestamp="ts", price="value", volume="user_id", order_by=["ts", "event_id"]
    )

    def replace(batch, number):
        batch.write.mode("overwrite").parquet(f"{base}/table")

    jobs.run_available(days, f"{base}/checkpoint", mode="complete", each_batch=replace)
    return stabled(spark.read.parquet(f"{base}/table"), "volume")


END = "end of stream"


def suppressed(spark, rows, base, delay):
    """All alerts of a stream let through; what the last delay holds is decided by an end mark after it."""
    previous = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    jobs.use_rocksdb(spark)
    try:
        kept = jobs.suppress_stream(rows, title="event_type", timestamp="ts", delay=delay)
        jobs.run_available(kept.filter(F.col("title") != END), f"{base}/checkpoint", path=f"{base}/table")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", previous)
    return spark.read.parquet(f"{base}/table").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def end_mark(spark, sf_dir, path):
    """Writes an event a century after the newest one."""
    newest = events(spark, sf_dir).agg((F.max("ts") + F.expr("interval 100 years")).alias("ts"))
    newest.select("ts", F.lit(END).alias("event_type")).write.parquet(path)
    return jobs.read_events(spark, path)


SUPPRESSED_ROWS = SUPPRESSED_SQL + "select distinct event_type as title, ts as timestamp from walk where kept"


@register("t4_stream_suppression", SUPPRESSED_ROWS)
def t4_stream_suppression(spark, sf_dir):
    base = scratch_path(spark, "t4")
    rows = stream(spark, sf_dir).select("ts", "event_type").unionByName(end_mark(spark, sf_dir, f"{base}/end"))
    return suppressed(spark, rows, base, "1 day")


@register("t4_stream_late_alerts", SUPPRESSED_ROWS)
def t4_stream_late_alerts(spark, sf_dir):
    """The events arrive in three micro-batches without regard to their time; the end mark comes last."""
    base = scratch_path(spark, "t4")
    for part in range(3):
        own = events(spark, sf_dir).filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part)
        own.select("ts", "event_type").coalesce(1).write.parquet(f"{base}/in/{part}")
    end_mark(spark, sf_dir, f"{base}/in/end")
    rows = jobs.read_events(spark, f"{base}/in/*", files_per_trigger=1)
    return suppressed(spark, rows, base, "3650 days")


@register("t5_stream_freshness", "select event_type as source, max(ts) as last_seen from events group by 1")
def t5_stream_freshness(spark, sf_dir):
    base = scratch_path(spark, "t5")
    latest = jobs.freshness_stream(stream(spark, sf_dir), source="event_type", timestamp="ts")

    def append(batch, number):
        batch.write.mode("append").parquet(f"{base}/table")

    jobs.run_available(latest, f"{base}/checkpoint", mode="update", each_batch=append)
    seen = spark.read.parquet(f"{base}/table").groupBy("source").agg(F.max("last_seen").alias("last_seen"))
    return seen.withColumn("last_seen", F.col("last_seen").cast("timestamp_ntz"))
