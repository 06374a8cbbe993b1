"""Language identification."""

from __future__ import annotations

import zlib

import numpy as np

from pricelake.llm.common import table
from pricelake.llm.language_id import fit_ftrl, fit_temperature, identify
from tests.llm.edge import edge_docs, no_docs


def test_held_out_accuracy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    langs = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = identify(docs).collect()
    assert len(got) == len(langs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_edge_cases(spark, sf_dir):
    learnt = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    odd = edge_docs(spark).selectExpr("-coalesce(doc_id, 99) as doc_id", "text", "lang")
    got = {r["doc_id"]: r for r in identify(learnt.unionByName(odd)).filter("doc_id < 0").collect()}
    assert {got[-i]["lang_pred"] for i in (1, 2, 3, 8)} == {"und"} and got[-1]["score"] == 0
    assert identify(no_docs(spark)).collect() == []
    assert {r["lang_pred"] for r in identify(odd.withColumn("lang", odd["lang"].substr(9, 1)).selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def test_penalty_makes_weights_sparse_and_temperature_lowers_the_loss():
    rng = np.random.default_rng(5)
    rows = [(np.array([int(rng.integers(0, 3)) * 2 + y, 10 + int(rng.integers(0, 50))]), np.array([1.0, 0.3]), y) for y in (0, 1) for _ in range(200)]
    weights = fit_ftrl(rows, 2, 64, l1=0.5)
    assert (weights[10:60] == 0).mean() > 0.5 and (weights[:6] != 0).all()
    logits = np.where(rng.random((500, 1)) < 0.8, [[8.0, 0.0]], [[0.0, 8.0]])
    t = fit_temperature(logits, np.zeros(500, int))
    loss = lambda s: float((np.log(np.exp(s).sum(1)) - s[:, 0]).mean())
    assert t > 2 and loss(logits / t) < loss(logits)


def test_rare_languages_are_learnt_from_a_small_sample(spark):
    common = [(i, f"the quick brown fox and the number {i} of them" if i % 2 else f"der schnelle braune fuchs und die nummer {i}", "en" if i % 2 else "de") for i in range(1500)]
    rare = [(5000 + i, f"быстрая лиса и собака {i}", "ru") for i in range(10)]
    docs = spark.createDataFrame(common + rare * 2, "doc_id long, text string, lang string")
    first, again = (sorted(map(tuple, identify(docs.repartition(n), max_fit=30).collect())) for n in (2, 5))
    assert {r[2] for r in first if r[0] >= 5000} == {"ru"} and first == again
