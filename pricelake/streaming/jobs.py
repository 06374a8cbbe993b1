"""Streaming forms of the batch operators.

Every function takes streaming frames and leaves sink, trigger and checkpoint to
``run_available`` or the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pricelake.operators.cleaning import drop_duplicates
from pricelake.session import ROCKSDB_PROVIDER, checkpointed


def read_events(spark: SparkSession, path: str, *, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files as a stream; zone-less timestamps become session-zone timestamps."""
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    zoneless = [f.name for f in schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return rows.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else rows


def run_available(
    stream: DataFrame, checkpoint: str, *, path: str | None = None, mode: str = "append",
    each_batch: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Process everything that is available and stop; append to ``path`` or call ``each_batch``."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if each_batch is not None:
        query = writer.foreachBatch(each_batch).start()
    else:
        query = writer.format("parquet").start(path)
    query.awaitTermination()


def partition_loader(path: str, *, partition: str, keys: Sequence[str], order_by: Sequence[str]):
    """``foreachBatch`` sink that merges a micro-batch into the partitions it touches.

    The touched partitions are read, the newest row per key is kept and the partitions are
    replaced, so a replayed batch gives the same table.
    """
    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        known = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
        merged = batch
        if known:
            touched = batch.select(partition).distinct()
            old = spark.read.parquet(path).join(touched, partition, "left_semi")
            merged = old.unionByName(batch)
        newest = drop_duplicates(merged, keys=keys, order_by=order_by, keep="last")
        # read and overwrite of one path: cut the plan first
        newest = checkpointed(newest) if known else newest
        (
            newest.hint("rebalance", partition).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
        )

    return load


def append_log(path: str):
    """``foreachBatch`` sink that appends each micro-batch to a log and rewrites nothing.

    A batch owns the folder of its number, so a replayed batch replaces itself and no other. Read the
    log with ``latest_rows`` and keep it short with ``compact_log``.
    """
    def load(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batches/batch={number:012d}")

    return load


def _numbered(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the complete folders ``kind=<number>`` below a path, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    out = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(f"{kind}=") and files.exists(done):
            out.append(int(name.partition("=")[2]))
    return sorted(out)


_BATCH = "__batch"


def _log_rows(spark: SparkSession, path: str, newest: int | None = None) -> tuple[DataFrame | None, int | None]:
    """(rows of the log with the number of their batch, number of the last batch among them)."""
    base = path.rstrip("/")
    levels = [n for n in _numbered(spark, f"{base}/compacted", "upto") if newest is None or n <= newest]
    batches = [n for n in _numbered(spark, f"{base}/batches", "batch") if (not levels or n > levels[-1]) and (newest is None or n <= newest)]
    parts = [spark.read.parquet(f"{base}/compacted/upto={levels[-1]:012d}")] if levels else []
    if batches:
        rows = spark.read.option("basePath", f"{base}/batches").parquet(*[f"{base}/batches/batch={n:012d}" for n in batches])
        parts.append(rows.withColumn(_BATCH, F.col("batch").cast("long")).drop("batch"))
    if not parts:
        return None, None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows, batches[-1] if batches else levels[-1]


def _newest(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return drop_duplicates(rows, keys=keys, order_by=[*order_by, _BATCH], keep="last")


def latest_rows(spark: SparkSession, path: str, *, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The newest row of each key in an append log, by ``order_by`` and then by batch.

    A key is looked up in the whole log, not in one partition of it, so a row whose other columns
    change (its day, say) is counted once.
    """
    rows, _ = _log_rows(spark, path)
    if rows is None:
        raise ValueError(f"no batch in {path}")
    return _newest(rows, keys, order_by).drop(_BATCH)


def compact_log(spark: SparkSession, path: str, *, keys: Sequence[str], order_by: Sequence[str], upto: int | None = None) -> int | None:
    """Write the newest row of each key in all batches (up to a number) as one level; readers then skip those batches.

    The level counts once it is complete; batches and older levels stay until the caller removes them, so
    readers that began before keep their files.
    """
    rows, last = _log_rows(spark, path, upto)
    if rows is not None and last not in _numbered(spark, f"{path.rstrip('/')}/compacted", "upto"):
        _newest(rows, keys, order_by).hint("rebalance").write.mode("overwrite").parquet(f"{path.rstrip('/')}/compacted/upto={last:012d}")
    return last


def dedup_stream(events: DataFrame, *, keys: Sequence[str], timestamp: str, delay: str) -> DataFrame:
    """First row per key while the watermark allows a repeat."""
    return events.withWatermark(timestamp, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_ohlcv_stream(
    events: DataFrame, *, keys: Sequence[str], timestamp: str, price: str, volume: str,
    order_by: Sequence[str], delay: str = "1 day",
) -> DataFrame:
    """Open, high, low, close and volume per key and day."""
    order = F.when(F.col(price).isNotNull(), F.struct(*order_by))
    return (
        events.withWatermark(timestamp, delay)
        .groupBy(F.window(timestamp, "1 day").alias("w"), *keys)
        .agg(
            F.min_by(price, order).alias("open_price"), F.max(price).alias("high_price"),
            F.min(price).alias("low_price"), F.max_by(price, order).alias("close_price"),
            F.coalesce(F.sum(volume), F.lit(0.0)).alias("volume"), F.count(price).alias("record_count"),
        )
        .select(
            F.col("w.start").cast("date").alias("date"), *keys, "open_price", "high_price", "low_price",
            "close_price", "volume", "record_count",
        )
    )


_BLOCK_TIMES = 100_000


def _merged(times: list[np.ndarray]) -> np.ndarray:
    """Distinct instants in order, sorted in place: eight bytes each, and one copy."""
    every = np.concatenate(times)
    every.sort()
    new = np.ones(len(every), bool)
    np.not_equal(every[1:], every[:-1], out=new[1:])
    return every if new.all() else every[new]


class _Suppressor(StatefulProcessor):
    """Per title the last alert let through, and the alerts that the watermark has not passed yet.

    Instants are held as packed arrays, in the state in blocks of them.
    """

    def __init__(self, window_seconds: int) -> None:
        self.window = window_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")
        self.pending = handle.getListState("pending", "times binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        times, fresh, size = np.zeros(0, np.int64), [], 0
        for chunk in rows:
            fresh.append(chunk["us"].to_numpy(np.int64, copy=True))
            size += len(fresh[-1])
            if size > max(_BLOCK_TIMES, len(times)):
                times, fresh, size = _merged([times, *fresh]), [], 0
        yield from self._settle(key, _merged([times, *fresh]), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self._settle(key, np.zeros(0, np.int64), timerValues.getCurrentWatermarkInMs())

    def _settle(self, key: Any, times: np.ndarray, watermark_ms: int) -> Iterator[pd.DataFrame]:
        """Decide what the watermark has passed: no earlier alert can come any more. The rest waits for a timer."""
        last = self.last.get()[0] if self.last.exists() else None
        waited = self.pending.exists()
        if waited:
            times = _merged([times, *(np.frombuffer(row[0], np.int64) for row in self.pending.get())])
        due = int(np.searchsorted(times, watermark_ms * 1000, "right"))
        kept, at = [], 0 if last is None else int(np.searchsorted(times[:due], last + self.window))
        while at < due:
            last = int(times[at])
            kept.append(last)
            at = int(np.searchsorted(times[:due], last + self.window))
        if waited:
            self.pending.clear()
        # block by block, so that no second copy of the whole is made on the way to the state
        for i in range(due, len(times), _BLOCK_TIMES):
            self.pending.appendValue((times[i:i + _BLOCK_TIMES].tobytes(),))
        if due < len(times):
            self.handle.registerTimer(int(times[due]) // 1000 + 1)
        if kept:
            self.last.update((last,))
            yield pd.DataFrame({"title": [key[0]] * len(kept), "us": kept})

    def close(self) -> None:
        pass


def suppress_stream(
    alerts: DataFrame, *, title: str, timestamp: str, window_seconds: int = 3600, delay: str = "0 seconds",
) -> DataFrame:
    """Instants ``(title, timestamp)`` at which an alert is let through; needs the RocksDB state store.

    An alert is decided when the watermark (``delay`` behind the newest alert) has passed it, so alerts may come
    out of order by up to the delay, also over micro-batches, and the answer is that of the batch form. Alerts
    later than that are dropped by the watermark; without a stated delay alerts have to come in order. A title holds its last kept alert and those of the last delay.
    """
    seen = alerts.withWatermark(timestamp, delay)
    points = seen.select(F.col(title).alias("title"), F.unix_micros(timestamp).alias("us"), timestamp)
    kept = points.groupBy("title").transformWithStateInPandas(
        statefulProcessor=_Suppressor(window_seconds),
        outputStructType="title string, us long",
        outputMode="append",
        timeMode="EventTime",
    )
    return kept.select("title", F.timestamp_micros("us").alias("timestamp"))


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def freshness_stream(events: DataFrame, *, source: str, timestamp: str) -> DataFrame:
    """Latest event time per source, updated with every batch."""
    return events.groupBy(F.col(source).alias("source")).agg(F.max(timestamp).alias("last_seen"))
