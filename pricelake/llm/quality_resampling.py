"""Quality classifier by importance resampling.

Two generative models over hashed n-grams are compared: one of all raw text, one of target text (labelled
good and not toxic). A text's log importance weight is the summed log ratio of the two, over a power of its
length so that long and short texts compare. Gumbel top-k then draws k texts without replacement, with
probabilities that follow the weights; k is the number of texts whose weight reaches the level that all but
a small share of held-back target texts reach.

A bucket's target probability leaves its background value (the raw probability) only where the counts differ
significantly; rare n-grams that the labelled texts happen to miss carry no weight.

Raw counts cover all texts. Labelled texts are a seeded sample of at most `max_labels`; half of it is counted,
the other half sets the level.

Edge cases: null and empty texts have weight 0 and are decided like any other. Equal rows get equal keys, and
all rows tied at the cut stay. Without labelled target texts every row stays. A null doc_id has a key of its
own text. Extra columns are ignored; a label that occurs more than once counts as its worst.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import saved, shipped, table, without_rows
from pricelake.llm.textops import bucket_grams, chunks
from pricelake.plans.registry import register

BITS = 16
MAX_LABELS = 20_000
#: Share of the held-back target texts that the level keeps.
KEEP_TARGET = 0.995
#: Scale of the Gumbel noise against the weights.
TEMPERATURE = 0.02
SEED = 17

_PRIOR, _DEVIATIONS, _LEAST_LOG = 2.0, 6.0, 1.0
_STEP = 1 << 32


def _counted(fit: frozenset[int], bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task (bucket, n-grams of all texts, n-grams of target texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        raw, target = np.zeros(3 << bits, np.int64), np.zeros(3 << bits, np.int64)
        for batch in batches:
            chosen = np.array([i in fit for i in batch.column(0).to_pylist()], bool)
            for first, raws in chunks(batch.column(1)):
                buckets, rows = bucket_grams(raws, bits)
                raw += np.bincount(buckets, minlength=len(raw))
                inside = chosen[first:first + len(raws)]
                if inside.any():
                    target += np.bincount(buckets[inside[rows]], minlength=len(raw))
        used = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])

    return run


def _weigher(ratios: np.ndarray, bits: int) -> Callable:
    """Adds the log importance weight of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for batch in batches:
            weights = np.zeros(batch.num_rows)
            for first, raws in chunks(batch.column("text")):
                buckets, rows = bucket_grams(raws, bits)
                total = np.bincount(rows, weights=ratios[buckets], minlength=len(raws))[:len(raws)]
                count = np.bincount(rows, minlength=len(raws))[:len(raws)]
                weights[first:first + len(raws)] = total / np.sqrt(count + 50.0)
            yield pa.record_batch(
                [*(c for n, c in zip(batch.schema.names, batch.columns) if n != "text"), pa.array(weights)],
                names=[*(n for n in batch.schema.names if n != "text"), "weight"],
            )

    return run


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the log of target over raw probability, 0 where the counts do not tell them apart."""
    seen = raw > 0
    if not target.sum():
        return np.zeros(len(raw))
    frequent = raw >= np.quantile(raw[seen], 0.9)
    share = np.median(target[frequent] / raw[frequent])
    expected = raw * share
    ratio = np.log((target + _PRIOR) / (expected + _PRIOR))
    clear = (np.abs(target - expected) >= _DEVIATIONS * np.sqrt(expected + 1)) & (np.abs(ratio) >= _LEAST_LOG)
    return np.where(clear, ratio, 0.0)


def _label_sample(labels: DataFrame, most: int, seed: int) -> tuple[frozenset[int], list[int]]:
    """Target ids for the counts and for the level, from at most so many labelled rows."""
    judged = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.min("quality").eqNullSafe(1) & F.max("toxic").eqNullSafe(0)).alias("target")
    ).filter("doc_id is not null")
    picked = judged.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(most).collect()
    good = sorted(r["doc_id"] for r in picked if r["target"])
    return frozenset(good[0::2]), good[1::2]


def _cut(keys: DataFrame, key: str, k: int) -> int | None:
    """The k-th largest of a long column, by counting one 16-bit digit after the other."""
    low, wanted = None, k
    for shift in (48, 32, 16, 0):
        digit = F.shiftright(F.col(key), shift)
        rows = keys if low is None else keys.filter(F.shiftright(F.col(key), shift + 16) == low)
        counts = sorted(((r["d"], r["c"]) for r in rows.groupBy(digit.alias("d")).agg(F.count("*").alias("c")).collect()), reverse=True)
        for value, count in counts:
            if wanted <= count:
                low = value
                break
            wanted -= count
        else:
            return None
    return low


def gumbel_key(weight: Column, seed: int, temperature: float) -> Column:
    """Fixed-point sum of the scaled weight and the row's own Gumbel noise."""
    spin = F.xxhash64("doc_id", "text_hash", F.lit(seed))
    uniform = (F.shiftrightunsigned(spin, 11).cast("double") + 0.5) / float(1 << 53)
    return F.floor((weight / temperature - F.log(-F.log(uniform))) * _STEP).cast("long")


def resampling_model(
    docs: DataFrame, labels: DataFrame, bits: int = BITS, max_labels: int = MAX_LABELS, keep_target: float = KEEP_TARGET,
    temperature: float = TEMPERATURE, seed: int = SEED,
) -> tuple[np.ndarray, int | None, DataFrame]:
    """(log ratios, cut of the keys, the rows with weight and key): a row stays if its key reaches the cut."""
    shipped(__name__)
    fit, level_ids = _label_sample(labels, max_labels, seed)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = base.mapInArrow(_counted(fit, bits), "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    )
    raw, target = np.zeros(3 << bits), np.zeros(3 << bits)
    for r in counts.toLocalIterator():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    ratios = log_ratios(raw, target)
    weighed = saved(with_keys(docs, ratios, bits, seed, temperature), "weights")
    level_frame = docs.sparkSession.createDataFrame([(i,) for i in level_ids], "id long")
    told = weighed.join(level_frame, weighed.doc_id == level_frame.id, "left_semi").select("weight")
    level = told.agg(F.percentile("weight", F.lit(1 - keep_target)).alias("w")).first()["w"]
    if level is None:
        return ratios, None, weighed
    k = weighed.filter(F.col("weight") >= level).count()
    return ratios, _cut(weighed, "key", k), weighed


def with_keys(docs: DataFrame, ratios: np.ndarray, bits: int, seed: int, temperature: float) -> DataFrame:
    """(doc_id, text_hash, weight, key) of every row."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    weighed = base.mapInArrow(_weigher(ratios, bits), "doc_id long, text_hash long, weight double")
    return weighed.withColumn("key", gumbel_key(F.col("weight"), seed, temperature))


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, weight, kept) of every row."""
    _, cut, weighed = resampling_model(docs, labels)
    return weighed.select("doc_id", "weight", (F.lit(True) if cut is None else F.col("key") >= cut).alias("kept"))


def keep_sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the draw keeps, with all their columns."""
    _, cut, weighed = resampling_model(docs, labels)
    if cut is None:
        return docs
    gone = weighed.filter(F.col("key") < cut).select("doc_id", "text_hash").distinct()
    return without_rows(docs, saved(gone, "gone"), F.xxhash64("text"))


@register("op1_quality_resampling")
def op1_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
