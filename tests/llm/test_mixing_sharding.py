"""Budgets, prefixes and shards."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from fractions import Fraction

import pytest

from pricelake.llm import mixing
from pricelake.llm.sharding import shard_by_bytes
from tests.llm.edge import WORD, documents, edge_docs, no_docs


def water(given, children):
    """name -> budget: fill the poorest children, divide the rest by weight (exact arithmetic)."""
    left, out = dict(children), {}
    while left:
        total = sum(w for _, w in left.values())
        full = [k for k, (s, w) in left.items() if s * total <= given * w]
        if not full:
            out |= {k: int(Fraction(given) * w / total) for k, (_, w) in left.items()}
            break
        k = min(full, key=lambda k: (Fraction(left[k][0], left[k][1]), k))
        out[k] = left.pop(k)[0]
        given -= out[k]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_shortages_go_to_siblings_first(spark, seed):
    rng = random.Random(seed)
    leaves = [(f"d{a}", f"l{b}", f"s{c}", rng.choice([0, 5, 100, 4000]) + rng.randint(0, 50), 3) for a in range(3) for b in range(3) for c in range(4)]
    weights = {"domain": {"d0": 70, "d1": 20}, "lang": {"l0": 5}, "source": {"s0": 1, "s3": 40}}
    frame = spark.createDataFrame(leaves, "domain string, lang string, source string, n_tokens long, n_rows long")
    budget = sum(x[3] for x in leaves)
    got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in mixing.leaf_budgets(frame, mixing.TREE, weights, budget, 2).collect()}
    supply = defaultdict(int)
    for a, b, c, n, _ in leaves:
        for key in ((a,), (a, b), (a, b, c)):
            supply[key] += 2 * n
    given = {(): budget}
    for depth, name in enumerate(mixing.TREE):
        nxt = {}
        for parent, amount in given.items():
            kids = {k: (supply[k], weights[name].get(k[-1], 10)) for k in supply if len(k) == depth + 1 and k[:depth] == parent}
            nxt |= water(amount, kids)
        given = nxt
    assert got == given


def test_prefixes_stay_inside_their_budget_and_slices_do_not_matter(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), "en" if i % 3 else "de", f"src{i % 4 if i % 2 else 0}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("domain", mixing.domain(mixing.F.col("source")))
    run = lambda: mixing.mix(docs, budget_percent=80)
    rough = sorted((r["doc_id"], r["epoch"]) for r in run().collect())
    monkeypatch.setattr(mixing, "ROWS_PER_SLICE", 7)
    assert sorted((r["doc_id"], r["epoch"]) for r in run().collect()) == rough
    assert len(set(rough)) == len(rough)
    spent = sum(len(WORD.findall(rows[i][1])) for i, _ in rough)
    total = sum(len(WORD.findall(t)) for _, t, _, _ in rows)
    assert 0.7 * total <= spent <= 0.8 * total


def test_mixing_edge_cases(spark):
    docs = edge_docs(spark).withColumn("domain", mixing.domain(mixing.F.col("source")))
    out = mixing.mix(docs, budget_percent=1000, max_epochs=2)
    assert out.columns == [*docs.columns, "n_tokens", "epoch"]
    counts = defaultdict(int)
    for r in out.collect():
        counts[r["doc_id"]] += 1
        assert r["n_tokens"] == len(WORD.findall(r["text"] or ""))
    assert counts[6] == 4 and counts[5] == 2 and counts[None] == 2
    empty = no_docs(spark).withColumn("domain", mixing.domain(mixing.F.col("source")))
    assert mixing.mix(empty).collect() == []


def test_shards_equal_one_global_prefix_sum(spark):
    rng = random.Random(6)
    rows = [(rng.randint(0, 300), "é" * rng.randint(0, 400)) for _ in range(500)] + [(77, "same")] * 200
    docs = documents(spark, rows)
    out = shard_by_bytes(docs, 13)
    assert out.columns == [c for c in docs.columns if c != "shard"] + ["size", "text_crc32", "shard", "slot"]
    got = sorted((r["doc_id"], r["text_crc32"], r["size"], r["shard"], r["slot"]) for r in out.collect())
    order = sorted((i, zlib.crc32(t.encode()), len(t.encode()) + 16) for i, t in rows)
    total, at, want, slots = sum(x[2] for x in order), 0, [], defaultdict(int)
    for i, c, s in order:
        at += s
        shard = min(12, (2 * at - s) * 13 // (2 * total))
        want.append((i, c, s, shard, slots[shard]))
        slots[shard] += 1
    assert got == sorted(want)
    sums = defaultdict(int)
    for _, _, s, shard, _ in got:
        sums[shard] += s
    assert max(sums.values()) - min(sums.values()) <= 2 * max(x[2] for x in order)


def test_sharding_edge_cases(spark):
    out = shard_by_bytes(edge_docs(spark), 3).collect()
    assert len(out) == 11
    nulls = [r for r in out if r["text"] is None]
    assert [(r["size"], r["text_crc32"]) for r in nulls] == [(16, 0)]
    for shard in range(3):
        slots = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert shard_by_bytes(no_docs(spark), 3).collect() == []
