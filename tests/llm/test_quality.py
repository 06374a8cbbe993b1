"""Importance resampling and weak supervision."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from pricelake.llm import quality_resampling as resampling
from pricelake.llm import quality_rules as rules
from tests.llm.edge import WORD, documents, edge_docs, no_docs


def corpus(seed=1, n=160):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in "rstn"]
    rows, good = [], {}
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(60)) + "."
        if i % 5 == 0:
            text = " ".join(f"{w}###" if k % 2 else f"{w}$$$" for k, w in enumerate(text.split()))
        rows.append((i, text))
        good[i] = i % 5 != 0
    return rows, good


def labels(spark, good, part=lambda i: True):
    return spark.createDataFrame([(i, int(g), 0) for i, g in good.items() if part(i)] or [], "doc_id long, quality int, toxic int")


def test_resampling_rejects_what_is_unlike_the_target(spark):
    rows, good = corpus()
    docs = documents(spark, rows)
    told = labels(spark, good, lambda i: i % 2 == 0 or i % 3 == 0)
    got = {r["doc_id"]: r["kept"] for r in resampling.resample(docs, told).collect()}
    assert len(got) == len(rows)
    assert not any(got[i] for i in got if not good[i])
    assert sum(not got[i] for i in got if good[i]) <= 2
    kept = resampling.keep_sampled(docs, told)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i]}


def test_resampling_edge_cases(spark):
    docs = edge_docs(spark)
    none = labels(spark, {})
    assert [r["kept"] for r in resampling.resample(docs, none).collect()] == [True] * docs.count()
    assert resampling.resample(no_docs(spark), none).collect() == []
    some = labels(spark, {4: True, 5: True, 6: True, 7: False})
    assert resampling.resample(docs, some).count() == docs.count()
    assert resampling.resample(no_docs(spark), some).collect() == []


def test_cut_is_the_kth_largest(spark):
    rng = random.Random(3)
    values = [rng.randrange(-2**40, 2**40) for _ in range(300)] + [5] * 20
    frame = spark.createDataFrame([(v,) for v in values], "key long")
    for k in (1, 7, 150, 320):
        assert resampling._cut(frame, "key", k) == sorted(values, reverse=True)[k - 1]
    assert resampling._cut(frame, "key", 321) is None


def test_gumbel_draw_follows_the_weights(spark):
    """The largest of (log weight + Gumbel noise) falls on a row in proportion to its weight."""
    from pyspark.sql import functions as F

    frame = spark.range(20_000).select(F.explode(F.array(*(F.struct((F.col("id") * 3 + k).alias("doc_id"), F.lit(float(np.log(w))).alias("weight"), F.lit(0).cast("long").alias("text_hash"), F.col("id").alias("draw")) for k, w in enumerate((1, 2, 5))))).alias("r")).select("r.*")
    keyed = frame.withColumn("key", resampling.gumbel_key(F.col("weight"), 1, 1.0))
    wins = Counter(r["m"]["w"] for r in keyed.groupBy("draw").agg(F.max(F.struct("key", F.col("weight").alias("w"))).alias("m")).collect())
    shares = sorted(v / 20_000 for v in wins.values())
    assert np.allclose(shares, [0.125, 0.25, 0.625], atol=0.015)


def test_significant_buckets_only():
    raw = np.array([1000.0, 1000, 1000, 3, 0] + [900] * 40)
    target = np.array([500.0, 500, 5, 0, 0] + [450] * 40)
    ratio = resampling.log_ratios(raw, target)
    assert ratio[2] < -3 and ratio[0] == ratio[1] == ratio[3] == ratio[4] == 0


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def test_base_counts_equal_plain_counting(spark):
    rng = random.Random(2)
    rows = [(1000 + i, " ".join(rng.choice("ab c# d\n e é |x".split(" ")) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows += [(2000, "x y z a b c d e\nx y z a b c d e\nx y z a b c d e"), (2001, "same\n\nsame\n same")]
    docs = documents(spark, rows).unionByName(edge_docs(spark))
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], r["text"])
    for r in rules.judge(docs).collect():
        want = plain_counts(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want
        assert r["base_failed"] == (want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_rules_reject_junk_and_keep_prose(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bdfglmnrst") + rng.choice("aeiou") for _ in range(2))
    prose = lambda: " ".join(f"{word().title()} " + " ".join(word() for _ in range(8)) + "." for _ in range(6))
    rows = [(i, prose()) for i in range(60)]
    rows += [(100 + i, " ".join(f"{word()}***" for _ in range(50))) for i in range(6)]
    rows += [(200 + i, " ".join(f"{word().upper()}!!" for _ in range(50))) for i in range(6)]
    got = {r["doc_id"]: r["kept"] for r in rules.judge(documents(spark, rows)).collect()}
    assert all(got[i] for i in range(60)) and not any(got[i] for i in got if i >= 100)
    assert rules.judge(no_docs(spark)).collect() == []


def test_expectation_maximisation_finds_the_accuracies():
    rng = random.Random(9)
    patterns, truth = Counter(), [0.95, 0.8, 0.75]
    for _ in range(20_000):
        good = 1 if rng.random() < 0.8 else -1
        patterns[tuple(0 if rng.random() < 0.2 else good if rng.random() < a else -good for a in truth)] += 1
    accuracy, share, posterior = rules.fit_votes(dict(patterns), 200)
    assert np.allclose(accuracy, truth, atol=0.05) and abs(share - 0.8) < 0.05
    assert posterior[(1, 1, 1)] > 0.95 and posterior[(-1, -1, -1)] < 0.2
