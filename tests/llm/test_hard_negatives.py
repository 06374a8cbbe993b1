"""Hard negatives against a plain loop; packed products against whole numbers."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from pricelake.llm import hard_negatives as H

SCHEMA = "id long, vector array<double>, label int, chosen boolean, block string, place string"


def brute_force(rows, positives=5, negatives=10):
    good = [
        (i, [math.floor(256 * x) for x in v], label, chosen) for i, v, label, chosen in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for at, (a_id, a, a_label, chosen) in enumerate(good):
        if not chosen or a_id is None:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), math.inf if i is None else i, label == a_label) for k, (i, v, label, _) in enumerate(good) if k != at]
        scored.sort(key=lambda s: s[:2])
        for p, p_id, _ in [s for s in scored if s[2]][:positives]:
            near = [s for s in scored if not s[2] and 30 * -p <= 100 * -s[0] <= 90 * -p][:negatives]
            out.update((a_id, p_id if p_id < math.inf else None, rank, n_id if n_id < math.inf else None, -p, -n) for rank, (n, n_id, _) in enumerate(near, 1))
    return out


def mined(spark, rows):
    frame = spark.createDataFrame([(*r, "b", "p") for r in rows], SCHEMA)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in H.mine(frame, "id", "vector", "label", "chosen").select(*names).collect())


def some_rows(n, seed=1, dim=6):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0.3, 0.6) for _ in range(dim)], draw.randrange(3), i % 9 == 0) for i in range(n)]


def test_rows_equal_a_plain_loop_over_several_cells(spark, monkeypatch):
    for name, value in (("BLOCK", 32), ("ANCHORS", 11), ("SLICE", 2), ("_STRIP", 4)):
        monkeypatch.setattr(H, name, value)
    rows = some_rows(400)
    assert mined(spark, rows) == brute_force(rows)


def test_ties_repeated_rows_nulls_and_lengths(spark):
    rows = [(i, [1.0, 0.5, 0.25][:1 + i % 3], i % 2, i % 4 == 0) for i in range(40)] * 2
    rows += [
        (100, None, 1, True), (101, [1.0, None], 1, True), (102, [float("nan")], 1, True), (103, [float("inf")], 0, False), (104, [1.0], None, True),
        (None, [1.0, 0.5], 0, True), (None, [0.5], 1, False), (105, [], 1, True), (106, [-1.0, -2.0], 7, True),
    ]
    assert mined(spark, rows) == brute_force(rows)


def test_one_label_holds_nearly_all_rows(spark):
    rows = [(i, v, 0 if i % 50 else 1, chosen) for i, v, _, chosen in some_rows(300, 4)]
    assert mined(spark, rows) == brute_force(rows)


def test_empty_table(spark):
    assert mined(spark, []) == Counter()


@pytest.mark.parametrize("scale", [1, 3, 700, 200_000])
def test_packed_products_are_exact(scale):
    draw = np.random.default_rng(scale)
    for n, m, dim in ((1, 1, 1), (7, 3, 64), (100, 10, 33), (5, 4, 0)):
        a, b = draw.integers(-scale, scale + 1, (n, dim)), draw.integers(-scale, scale + 1, (m, dim))
        assert np.array_equal(H.packed_products(a, b), b @ a.T)


def test_too_large_components_are_refused(spark):
    with pytest.raises(ArithmeticError):
        H.packed_products(np.array([[1 << 40]]), np.array([[1 << 40]]))
