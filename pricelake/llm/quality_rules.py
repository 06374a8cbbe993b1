"""Quality rules under weak supervision.

Each rule votes for (+1), against (-1) or abstains (0). The rules' accuracies and the share of good texts are
estimated by expectation-maximisation over the counts of vote patterns, of which there are at most 3^rules
whatever the number of texts; a text stays if its posterior probability of being good is at least one half.

Edge cases: null, empty and word-less texts have all counts 0 and fail the base rule. Repeated rows are judged
one by one and alike. An empty table gives an empty result. Extra columns are ignored. Lines are split at \\n
only and compared whole; texts of any length are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import saved, shipped, table
from pricelake.llm.textops import chunks, gram_hashes, word_hashes, word_spans
from pricelake.plans.registry import register

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
ITERATIONS = 50
#: First guess and strength (as so many votes) of the prior of each accuracy and of the share of good texts.
ACCURACY, ACCURACY_STRENGTH = 0.9, 20.0
GOOD_SHARE, GOOD_STRENGTH = 0.85, 20.0

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_lower", "n_echoes", "n_distinct", "n_ends",
]


def _per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)[:n].astype(np.int64)


def _line_counts(raw: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def text_counts(raws: list[bytes], window: int = WINDOW) -> dict[str, np.ndarray]:
    """The counts in COUNTS of each text."""
    n = len(raws)
    data, starts, ends, rows = word_spans(raws)
    words = word_hashes(data, starts, ends)
    owners = np.repeat(np.arange(n), [len(r) + 1 for r in raws])
    heads = (data & 0xC0) != 0x80
    heads_before = np.concatenate(([0], np.cumsum(heads)))
    symbol = np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8))
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    echo = np.zeros(len(words))
    echo[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    lines = [_line_counts(r) for r in raws]
    repeated, distinct = np.zeros(n, np.int64), np.zeros(n, np.int64)
    grams, gram_rows = gram_hashes(words, rows, window)
    word_cuts = np.searchsorted(rows, np.arange(n + 1))
    gram_cuts = np.searchsorted(gram_rows, np.arange(n + 1))
    for i in range(n):
        own = np.sort(words[word_cuts[i]:word_cuts[i + 1]])
        distinct[i] = len(own) and 1 + np.count_nonzero(own[1:] != own[:-1])
        runs = grams[gram_cuts[i]:gram_cuts[i + 1]]
        order = np.argsort(runs, kind="stable")
        same = runs[order][1:] == runs[order][:-1]
        if same.any():
            twice = np.zeros(len(runs), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            cover = np.zeros(len(runs) + window, np.int64)
            np.add.at(cover, np.flatnonzero(twice), 1)
            np.add.at(cover, np.flatnonzero(twice) + window, -1)
            repeated[i] = np.count_nonzero(np.cumsum(cover)[:-1] > 0)
    return {
        "n_words": np.bincount(rows, minlength=n)[:n], "word_chars": _per_row(heads_before[ends] - heads_before[starts], rows, n),
        "n_symbols": _per_row(symbol, owners, n), "n_dup_lines": np.array([d for _, d in lines], np.int64), "n_repeat_words": repeated,
        "n_lines": np.array([k for k, _ in lines], np.int64), "n_upper": _per_row(upper, owners, n), "n_lower": _per_row(lower, owners, n),
        "n_echoes": _per_row(echo, rows, n), "n_distinct": distinct,
        "n_ends": _per_row(np.isin(data[ends - 1], np.frombuffer(b".?!", np.uint8)) if len(ends) else ends, rows, n),
    }


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    np.seterr(over="ignore")
    for batch in batches:
        out = {c: np.zeros(batch.num_rows, np.int64) for c in COUNTS}
        for first, raws in chunks(batch.column(1)):
            for c, values in text_counts(raws).items():
                out[c][first:first + len(raws)] = values
        yield pa.record_batch([batch.column(0), *(pa.array(out[c]) for c in COUNTS)], names=["doc_id", *COUNTS])


def counted(docs: DataFrame) -> DataFrame:
    shipped(__name__)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_counter, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def _vote(against: Column, favour: Column | None = None) -> Column:
    vote = F.when(against, -1)
    return F.coalesce((vote if favour is None else vote.when(favour, 1)).otherwise(0), F.lit(0))


def rules() -> dict[str, Column]:
    """A vote per rule, from the counts."""
    words, letters, ends = F.col("n_words"), F.col("n_upper") + F.col("n_lower"), F.col("n_ends")
    prose = (words >= 5) & (ends * 100 >= words * 2) & (ends * 100 <= words * 45) & (F.col("n_symbols") * 10 <= words)
    return {
        "symbols": _vote(F.col("n_symbols") * 10 > words * 3),
        "density": _vote((words >= 20) & (F.col("n_symbols") * 100 > F.col("word_chars") * 5)),
        "capitals": _vote((F.col("n_upper") * 2 > letters) & (letters > 20)),
        "echoes": _vote(F.col("n_echoes") * 100 > words * 15),
        "repeats": _vote(F.col("n_repeat_words") * 100 > words * 15),
        "vocabulary": _vote((words >= 50) & (words <= 2000) & (F.col("n_distinct") * 100 < words * 15)),
        "lines": _vote((F.col("n_lines") >= 4) & (F.col("n_dup_lines") * 2 > F.col("n_lines"))),
        "sentences": _vote((words >= 30) & ((ends * 1000 < words * 3) | (ends * 10 > words * 6)), prose),
        "lengths": _vote((words >= 20) & ((F.col("word_chars") > words * 14) | (F.col("word_chars") < words * 2))),
    }


def fit_votes(patterns: dict[tuple[int, ...], int], iterations: int = ITERATIONS) -> tuple[list[float], float, dict[tuple[int, ...], float]]:
    """(accuracy per rule, share of good texts, posterior per pattern) by expectation-maximisation."""
    if not patterns:
        return [], GOOD_SHARE, {}
    votes = np.array(list(patterns), float)
    counts = np.array(list(patterns.values()), float)
    accuracy, share = np.full(votes.shape[1], ACCURACY), GOOD_SHARE

    def posterior() -> np.ndarray:
        odds = math.log(share / (1 - share)) + votes @ np.log(accuracy / (1 - accuracy))
        return 1 / (1 + np.exp(-odds))

    for _ in range(iterations):
        good = posterior()[:, None]
        right = (np.where(votes > 0, good, 0) + np.where(votes < 0, 1 - good, 0)) * counts[:, None]
        cast = (np.abs(votes) * counts[:, None]).sum(0)
        accuracy = np.clip((right.sum(0) + ACCURACY * ACCURACY_STRENGTH) / (cast + ACCURACY_STRENGTH), 0.7, 0.99)
        share = float(np.clip((good[:, 0] @ counts + GOOD_SHARE * GOOD_STRENGTH) / (counts.sum() + GOOD_STRENGTH), 0.05, 0.95))
    return accuracy.tolist(), share, dict(zip(patterns, posterior().tolist()))


def judge(docs: DataFrame) -> DataFrame:
    """Counts, base verdict, posterior and final verdict of every row."""
    names = list(rules())
    told = saved(counted(docs), "counts").withColumns({f"vote_{k}": v for k, v in rules().items()})
    pattern = F.concat_ws(",", *(F.col(f"vote_{k}") for k in names))
    told = told.withColumn("pattern", pattern)
    seen = {tuple(map(int, r["pattern"].split(","))): r["c"] for r in told.groupBy("pattern").agg(F.count("*").alias("c")).collect()}
    _, share, posterior = fit_votes(seen)
    # At most 3^rules entries.
    rows = [(",".join(map(str, k)), v) for k, v in posterior.items()]
    model = docs.sparkSession.createDataFrame(rows, "pattern string, quality_probability double")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    judged = told.join(F.broadcast(model), "pattern", "left").withColumn("base_failed", failed)
    return judged.select(
        "doc_id", *COUNTS[:5], "base_failed",
        (~F.col("base_failed") & (F.coalesce("quality_probability", F.lit(share)) >= 0.5)).alias("kept"), "quality_probability",
    )


@register("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
