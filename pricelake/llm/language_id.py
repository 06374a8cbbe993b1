"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three letters are hashed into a fixed number of buckets; term counts enter as 1 + log, are
weighed by inverse document frequency and scaled to length one. The weights are learnt by follow-the-regularised-
leader (FTRL-proximal) with L1 and L2 penalties, so most of them are exactly zero, and the probabilities are
calibrated by one temperature on rows that the learner has not seen.

Document frequencies and languages are counted over all training rows. The weights are fitted on a seeded sample of at
most `max_fit` of them (an equal share per language, but up to two of each), each at most one number per bucket, so
the driver's share is bounded. Every fifth sampled row of a language, never its only one, goes to the temperature.

Edge cases: null text, or text without a letter, gives `und` and score 0. If no language can be learnt, every
row gets `und`. Repeated rows get equal results; texts of any length are read whole; a null doc_id counts as
the text of no remainder (not held out) and is never learnt from. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.llm.common import saved, shipped, table
from pricelake.plans.registry import register

BITS = 14
MAX_FIT = 4_000
FOLDS = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.002
SEED = 29
UNKNOWN = "und"
#: Texts are featurised together up to so many characters or so many texts.
CHUNK_CHARS, CHUNK_TEXTS = 1 << 19, 64


def _letter_table() -> np.ndarray:
    """For each code point 1 if it is a letter, 0 if not, -1 if nobody has asked yet."""
    return np.full(0x110000, -1, np.int8)


def _is_letter(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    known = table[points]
    if (known < 0).any():
        for c in np.unique(points[known < 0]):
            table[c] = chr(c).isalpha()
        known = table[points]
    return known > 0


def _groups(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    first, size, out = 0, 0, []
    for i, x in enumerate(texts):
        x = x or ""
        if out and (size + len(x) > CHUNK_CHARS or len(out) == CHUNK_TEXTS):
            yield first, out
            first, size, out = i, 0, []
        out.append(x)
        size += len(x)
    if out:
        yield first, out


def gram_counts(texts: list[str], table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of the n-grams of each text, and whether each text has a letter."""
    raw = [x.lower().encode("utf-32-le", "surrogatepass") for x in texts]
    points = np.frombuffer(b" \0\0\0".join(raw) + b" \0\0\0", np.uint32)
    points = np.where(_is_letter(points, table), points, np.uint32(32))
    rows = np.repeat(np.arange(len(texts)), [len(r) // 4 + 1 for r in raw])
    keep = np.append(True, (points[1:] != 32) | (points[:-1] != 32))
    points, rows = points[keep], rows[keep]
    shift = np.uint64(64 - bits)
    code, found = points.astype(np.uint64), []
    for n in (1, 2, 3):
        gram = code[: len(code) - n + 1]
        for k in range(1, n):
            gram = (gram << np.uint64(21)) | code[k: len(code) - n + 1 + k]
        own = rows[: len(gram)]
        inside = own == rows[n - 1:]
        if n < 3:
            inside &= points[: len(gram)] != 32
        bucket = ((gram * np.uint64(4) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)
        found.append(((own << bits) + bucket)[inside])
    counts = np.bincount(np.concatenate(found), minlength=len(texts) << bits)
    used = np.flatnonzero(counts)
    lettered = np.bincount(rows[points != 32], minlength=len(texts))[: len(texts)] > 0
    return used >> bits, used & ((1 << bits) - 1), counts[used], lettered


def tf_idf(rows: np.ndarray, buckets: np.ndarray, counts: np.ndarray, idf: np.ndarray, texts: int) -> np.ndarray:
    weighed = (1 + np.log(counts)) * idf[buckets]
    norm = np.sqrt(np.bincount(rows, weights=weighed * weighed, minlength=texts))
    return weighed / np.maximum(norm, 1e-12)[rows]


def _frequencies(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task (bucket, texts that have it); bucket -1 counts the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        known, found, total = _letter_table(), np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for _, texts in _groups(batch.column(0).to_pylist()):
                _, buckets, _, lettered = gram_counts(texts, known, bits)
                found += np.bincount(buckets, minlength=len(found))
                total += int(lettered.sum())
        used = np.flatnonzero(found)
        yield pa.record_batch([pa.array(np.append(used, -1)), pa.array(np.append(found[used], total))], names=["bucket", "n"])

    return run


def _vectors(idf: np.ndarray, bits: int) -> Callable:
    """(doc_id, lang, buckets, values) of the sampled training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        known = _letter_table()
        for batch in batches:
            for first, texts in _groups(batch.column("text").to_pylist()):
                at, buckets, counts, _ = gram_counts(texts, known, bits)
                values = tf_idf(at, buckets, counts, idf, len(texts)).astype(np.float32)
                cuts = np.searchsorted(at, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.record_batch([
                    batch.column("doc_id").slice(first, len(texts)), batch.column("lang").slice(first, len(texts)),
                    pa.ListArray.from_arrays(cuts, pa.array(buckets.astype(np.int32))), pa.ListArray.from_arrays(cuts, pa.array(values)),
                ], names=["doc_id", "lang", "buckets", "values"])

    return run


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, size: int, epochs: int = EPOCHS, alpha: float = ALPHA,
    beta: float = BETA, l1: float = L1, l2: float = L2, seed: int = SEED,
) -> np.ndarray:
    """(buckets + bias) x classes weights; rows are (buckets, values, class)."""
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        za = z[at]
        return np.where(np.abs(za) <= l1, 0.0, -(za - np.sign(za) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            buckets, values, label = rows[i]
            at, x = np.append(buckets, size), np.append(values, 1.0)[:, None]
            w = weights(at)
            logits = (w * x).sum(0)
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            g = x * p
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    return weights(np.arange(size + 1))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden-section search."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        s = logits / t
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(labels)), labels]).mean())

    low, high, ratio = np.log(0.02), np.log(50.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(np.exp(a)) <= loss(np.exp(b)) else (a, high)
    return float(np.exp((low + high) / 2))


def _predictor(idf: np.ndarray, weights: np.ndarray, temperature: float, classes: list[str], bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        known = _letter_table()
        for batch in batches:
            names, scores = [], []
            for _, texts in _groups(batch.column("text").to_pylist()):
                at, buckets, counts, lettered = gram_counts(texts, known, bits)
                if not classes:
                    names += [UNKNOWN] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                values = tf_idf(at, buckets, counts, idf, len(texts))
                logits = np.stack([np.bincount(at, weights=values * weights[buckets, c], minlength=len(texts)) for c in range(len(classes))], 1)
                logits = (logits + weights[-1]) / temperature
                p = np.exp(logits - logits.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                best = p.argmax(1)
                names += [classes[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
                scores += np.where(lettered, p[np.arange(len(texts)), best], 0.0).tolist()
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def remainder(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


def identify(docs: DataFrame, bits: int = BITS, max_fit: int = MAX_FIT, seed: int = SEED) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, learnt from text and lang of the rows not held out."""
    shipped(__name__)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    train = rows.filter((remainder(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = train.select("text").mapInArrow(_frequencies(bits), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r["bucket"]: r["n"] for r in counted.collect()}  # one row per bucket
    total = found.pop(-1, 0)
    idf = np.full(1 << bits, np.log(1 + total) + 1)
    idf[list(found)] = np.log((1 + total) / (1 + np.array(list(found.values())))) + 1
    keyed = train.withColumn("text_hash", F.xxhash64("text")).withColumn("key", F.xxhash64("doc_id", "text_hash", F.lit(seed)))
    labels = {r["lang"]: r["n"] for r in keyed.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()}  # one row per language
    classes = sorted(labels)
    each = max(2, max_fit // max(1, len(classes)))
    # Only keys under a bound that twice the share is expected to be under are ordered, in a total order per language.
    bounds = [(x, (1 << 63) - 1 if n <= 2 * each + 50 else int((2 * each + 50) / n * (1 << 64)) - (1 << 63)) for x, n in labels.items()]
    bound = docs.sparkSession.createDataFrame(bounds, "lang string, bound long")
    low = keyed.select("lang", "doc_id", "text_hash", "key").join(F.broadcast(bound), "lang").filter("key <= bound").drop("bound").distinct()
    place = F.row_number().over(W.partitionBy("lang").orderBy("key", "doc_id", "text_hash"))
    picked = saved(low.withColumn("place", place).filter(F.col("place") <= each).drop("place", "key"), "picked")
    chosen = keyed.drop("key").join(F.broadcast(picked), ["lang", "doc_id", "text_hash"], "left_semi").dropDuplicates(["lang", "doc_id", "text_hash"])
    sample = chosen.select("doc_id", "lang", "text").mapInArrow(_vectors(idf, bits), "doc_id long, lang string, buckets array<int>, values array<float>")
    sample = sorted(sample.collect(), key=lambda r: (r["lang"], r["doc_id"], r["buckets"], r["values"]))
    apart, fit, seen = [], [], dict.fromkeys(classes, 0)
    for r in sample:
        side = apart if seen[r["lang"]] % FOLDS == 1 else fit
        side.append((np.array(r["buckets"], np.int64), np.array(r["values"], float), classes.index(r["lang"])))
        seen[r["lang"]] += 1
    weights = fit_ftrl(fit, len(classes), 1 << bits) if classes else np.zeros((1, 0))
    logits = np.array([(weights[b] * v[:, None]).sum(0) + weights[-1] for b, v, _ in apart]) if classes else np.empty((0, 0))
    temperature = fit_temperature(logits, np.array([y for _, _, y in apart], int))
    shown = rows.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "text")
    return shown.mapInArrow(
        _predictor(idf, weights, temperature, classes, bits), "doc_id long, held_out boolean, lang_pred string, score double"
    )


@register("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
