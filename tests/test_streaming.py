"""Streaming jobs over several micro-batches."""

from __future__ import annotations

import random
import time
import tracemalloc
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest

from pricelake.streaming import jobs

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture()
def arrivals(spark, tmp_path):
    """Three files: events of three days, with repeats across files."""
    for part in range(3):
        rows = [
            (i, START + timedelta(hours=4 * i), "ab"[i % 2], float(i % 7), 1.0)
            for i in range(part * 6, part * 6 + 8)
        ]
        df = spark.createDataFrame(rows, "id int, ts timestamp, k string, price double, volume double")
        df.coalesce(1).write.parquet(f"{tmp_path}/in/{part}")
    return f"{tmp_path}/in/*", str(tmp_path)


def test_loader_merges_and_replays(spark, arrivals):
    source, base = arrivals
    rows = jobs.read_events(spark, source, files_per_trigger=1).selectExpr("*", "cast(ts as date) as day")
    load = jobs.partition_loader(f"{base}/t", partition="day", keys=["id"], order_by=["ts"])
    jobs.run_available(rows, f"{base}/cp", each_batch=load)
    assert sorted(r["id"] for r in spark.read.parquet(f"{base}/t").collect()) == list(range(20))
    load(spark.read.parquet(f"{base}/in/1").selectExpr("*", "cast(ts as date) as day"), 1)
    assert sorted(r["id"] for r in spark.read.parquet(f"{base}/t").collect()) == list(range(20))


def test_dedup_across_batches(spark, arrivals):
    source, base = arrivals
    rows = jobs.dedup_stream(
        jobs.read_events(spark, source, files_per_trigger=1), keys=["id"], timestamp="ts", delay="10 days"
    )
    jobs.run_available(rows, f"{base}/cp", path=f"{base}/t")
    assert sorted(r["id"] for r in spark.read.parquet(f"{base}/t").collect()) == list(range(20))


def test_daily_append_emits_closed_windows(spark, arrivals):
    source, base = arrivals
    days = jobs.daily_ohlcv_stream(
        jobs.read_events(spark, source, files_per_trigger=1), keys=["k"], timestamp="ts", price="price",
        volume="volume", order_by=["ts", "id"], delay="1 hour",
    )
    jobs.run_available(days, f"{base}/cp", path=f"{base}/t")
    out = {(r["date"].day, r["k"]): r for r in spark.read.parquet(f"{base}/t").collect()}
    assert set(out) == {(d, k) for d in (1, 2, 3) for k in "ab"}
    assert (out[(1, "a")]["open_price"], out[(1, "a")]["close_price"]) == (0.0, 4.0)


def test_freshness_updates(spark, arrivals):
    source, base = arrivals
    seen = {}

    def remember(batch, number):
        seen.update({r["source"]: r["last_seen"] for r in batch.collect()})

    latest = jobs.freshness_stream(jobs.read_events(spark, source, files_per_trigger=1), source="k", timestamp="ts")
    jobs.run_available(latest, f"{base}/cp", mode="update", each_batch=remember)
    assert {k: v.replace(tzinfo=timezone.utc) for k, v in seen.items()} == {
        "a": START + timedelta(hours=72), "b": START + timedelta(hours=76)
    }


def test_append_log_keeps_the_newest_row_of_a_key_whose_day_moves(spark, tmp_path):
    base, newest = f"{tmp_path}/log", {"keys": ["id"], "order_by": ["version"]}
    load = jobs.append_log(base)

    def batch(*rows):
        return spark.createDataFrame(list(rows), "id int, day int, version int, price double")

    def read():
        return sorted(tuple(r) for r in jobs.latest_rows(spark, base, **newest).select("id", "day", "version", "price").collect())

    load(batch((1, 1, 1, 1.0), (2, 1, 1, 2.0)), 0)
    load(batch((1, 2, 2, 1.5), (3, 1, 1, 3.0)), 1)
    wanted = [(1, 2, 2, 1.5), (2, 1, 1, 2.0), (3, 1, 1, 3.0)]
    assert read() == wanted
    load(batch((1, 2, 2, 1.5), (3, 1, 1, 3.0)), 1)  # a replay changes nothing
    assert read() == wanted
    assert jobs.compact_log(spark, base, **newest) == 1 == jobs.compact_log(spark, base, **newest)
    assert read() == wanted
    load(batch((2, 9, 1, 2.5), (1, 1, 1, 0.0)), 2)  # equal versions: the later batch; an older version: none
    assert read() == [(1, 2, 2, 1.5), (2, 9, 1, 2.5), (3, 1, 1, 3.0)]
    files = sorted(p.name for p in (tmp_path / "log" / "batches").iterdir())
    assert files == [f"batch={n:012d}" for n in range(3)]  # a batch wrote its own folder only
    assert jobs.compact_log(spark, base, **newest, upto=1) == 1
    assert jobs.compact_log(spark, base, **newest) == 2
    assert read() == [(1, 2, 2, 1.5), (2, 9, 1, 2.5), (3, 1, 1, 3.0)]
    with pytest.raises(ValueError):
        jobs.latest_rows(spark, f"{tmp_path}/none", **newest)


def test_late_alerts_get_the_batch_answer_and_state_stays_within_the_delay(spark, tmp_path):
    draw = random.Random(4)
    minutes = [draw.randrange(60 * 48) for _ in range(250)]
    rows = [(START + timedelta(minutes=m), draw.choice("ab")) for m in minutes]
    order = sorted(range(250), key=lambda i: rows[i][0].timestamp() + draw.randrange(7200))  # up to two hours late
    for part in range(5):
        own = [rows[i] for i in order[part * 50:part * 50 + 50]]
        spark.createDataFrame(own, "ts timestamp, k string").coalesce(1).write.parquet(f"{tmp_path}/in/{part}")
        time.sleep(1.1)  # files are read by their modification time
    end = spark.createDataFrame([(START + timedelta(days=900), "end")], "ts timestamp, k string")
    end.coalesce(1).write.parquet(f"{tmp_path}/in/9")
    previous = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    jobs.use_rocksdb(spark)
    try:
        alerts = jobs.read_events(spark, f"{tmp_path}/in/*", files_per_trigger=1)
        jobs.run_available(jobs.suppress_stream(alerts, title="k", timestamp="ts", delay="3 hours"), f"{tmp_path}/cp", path=f"{tmp_path}/t")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", previous)
    wanted, last = set(), {}
    for moment, title in sorted(rows):
        if title not in last or moment - last[title] >= timedelta(hours=1):
            wanted.add((title, moment))
            last[title] = moment
    got = [(r["title"], r["timestamp"].replace(tzinfo=timezone.utc)) for r in spark.read.parquet(f"{tmp_path}/t").collect() if r["title"] != "end"]
    assert len(got) == len(set(got)) and set(got) == wanted


class _State:
    """What a suppressor uses of its states and timers, in this process."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, *_):
        return _State()

    getListState = getValueState

    def registerTimer(self, moment):
        self.timers.append(moment)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def appendValue(self, value):
        self.value = [*(self.value or []), value]

    def clear(self):
        self.value = None

    def __getattr__(self, name):
        if name != "getCurrentWatermarkInMs":
            raise AttributeError(name)
        return lambda: self.value


def test_a_title_of_many_alerts_is_held_packed():
    """Two batches of 400,000 alerts a title, none decided before the last call; the answer is that of a plain walk."""
    draw = random.Random(5)
    times = [draw.randrange(30 * 86_400_000_000) for _ in range(800_000)]
    suppressor, handle, clock = jobs._Suppressor(3600), _State(), _State()
    suppressor.init(handle)
    chunks = [pd.DataFrame({"us": times[i:i + 10_000]}) for i in range(0, len(times), 10_000)]
    clock.value = 0
    tracemalloc.start()
    out = [*suppressor.handleInputRows(("a",), iter(chunks[:40]), clock), *suppressor.handleInputRows(("a",), iter(chunks[40:]), clock)]
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out == [] and len(suppressor.pending.get()) > 1 and handle.timers[-1] == min(times) // 1000 + 1
    assert held < 50e6  # as Python integers in sets and tuples more than 100 MB
    clock.value = 15 * 86_400_000
    got = [t for frame in suppressor.handleExpiredTimer(("a",), clock, None) for t in frame["us"]]
    clock.value = 40 * 86_400_000
    got += [t for frame in suppressor.handleExpiredTimer(("a",), clock, None) for t in frame["us"]]
    wanted = []
    for moment in sorted(times):
        if not wanted or moment - wanted[-1] >= 3_600_000_000:
            wanted.append(moment)
    assert got == wanted and not suppressor.pending.exists()
