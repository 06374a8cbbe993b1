"""Greedy alert suppression against a direct walk."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pricelake.operators import oplog
from pricelake.streaming import jobs

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def walk(alerts, window):
    last, kept = {}, []
    for at, number, title in sorted(alerts, key=lambda a: (a[0], a[1])):
        if title not in last or (at - last[title]).total_seconds() >= window:
            last[title] = at
            kept.append(number)
    return sorted(kept)


def make(seed, sizes, span):
    rng = random.Random(seed)
    out = []
    for title, size in sizes.items():
        for _ in range(size):
            out.append((START + timedelta(seconds=rng.randint(0, span)), len(out), title))
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("direct", [None, 0])
def test_matches_walk(spark, seed, direct):
    alerts = make(seed, {"hot": 3000, "warm": 300, "rare": 5, None: 20}, 400_000)
    df = spark.createDataFrame(alerts, "ts timestamp, id int, title string")
    sent = oplog.suppress_alerts(df, tie_break=["id"], timestamp="ts", window_seconds=97, direct_points=direct)
    assert sorted(r["id"] for r in sent.collect()) == walk(alerts, 97)


def test_chains_over_many_large_blocks_start_no_job_while_planning(spark):
    alerts = make(5, {"long": 6000, "sparse": 40, None: 900}, 20 * oplog.BLOCKS[1])
    dense = [(START + timedelta(milliseconds=n * 7), 100_000 + n, "dense") for n in range(9000)]  # many times in one window
    df = spark.createDataFrame(alerts + dense, "ts timestamp, id int, title string")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    sent = oplog.suppress_alerts(df, tie_break=["id"], timestamp="ts", window_seconds=7)
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert sorted(r["id"] for r in sent.collect()) == walk(alerts + dense, 7)


def test_exact_window_edge_is_kept(spark):
    alerts = [(START + timedelta(seconds=s), i, "t") for i, s in enumerate((0, 3599, 3600, 3600, 7199, 7200))]
    df = spark.createDataFrame(alerts, "ts timestamp, id int, title string")
    for direct in (None, 0):
        sent = oplog.suppress_alerts(df, tie_break=["id"], timestamp="ts", direct_points=direct)
        assert sorted(r["id"] for r in sent.collect()) == [0, 2, 5]


def test_stream_keeps_state_between_batches(spark, tmp_path):
    alerts = sorted(make(11, {"hot": 400, "rare": 4}, 40_000))
    for part in range(4):
        chunk = alerts[part * 101 : (part + 1) * 101]
        df = spark.createDataFrame(chunk, "ts timestamp, id int, title string").coalesce(1)
        df.write.parquet(f"{tmp_path}/in/{part}")
    previous = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    jobs.use_rocksdb(spark)
    try:
        for part in range(4):  # one run per arrival: state comes from the checkpoint
            source = f"{tmp_path}/in/[0-{part}]"
            stream = jobs.read_events(spark, source)
            kept = jobs.suppress_stream(stream, title="title", timestamp="ts", window_seconds=600)
            jobs.run_available(kept, f"{tmp_path}/cp", path=f"{tmp_path}/out")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", previous)
    got = {(r["title"], r["timestamp"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    wanted = {(t, at.replace(tzinfo=None)) for at, i, t in alerts if i in set(walk(alerts, 600))}
    assert got == wanted


def test_rules_and_reports(spark):
    log = spark.createDataFrame(
        [(START, "extract_fx", "failed", {"error_message": "timeout"}, "ERROR"), (START, "extract_fx", "completed", {}, "INFO")],
        "timestamp timestamp, operation string, status string, details map<string,string>, level string",
    )
    alert = oplog.extraction_failures(log).first()
    assert alert["title"] == "Extraction Failed: fx"
    assert alert["metadata"] == {"source": "fx", "error": "timeout"}
    runs = spark.createDataFrame([(START, "etl", 90.0), (START, "etl", 10.0)], "timestamp timestamp, dag string, duration_minutes double")
    breach = oplog.sla_breaches(runs, sla_minutes=60).collect()
    assert [b["message"] for b in breach] == ["DAG etl took 90.0m, SLA is 60.0m"]
    assert oplog.json_lines(log.limit(1)).first()["value"].startswith('{"timestamp":"2024-01-01T00:00:00.000000"')
    rows = spark.createDataFrame([(START, "s", 10, 8, 1.5, "completed")], "timestamp timestamp, operation_type string, input_count int, output_count int, duration_seconds double, status string")
    assert oplog.transformation_log(rows).first()["details"]["records_dropped"] == "2"


def test_empty_log(spark):
    empty = spark.createDataFrame([], "ts timestamp, id int, title string")
    assert oplog.suppress_alerts(empty, tie_break=["id"], timestamp="ts").count() == 0
    assert oplog.alert_summary(empty.withColumn("level", F.lit("x"))).count() == 0
