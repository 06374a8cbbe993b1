"""As-of joins and gap filling against plain loops, and their plans."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from pricelake.operators.timeline import asof_join, fill_gaps
from pricelake.plans.catalog import QUERIES

START = datetime(2023, 11, 20)


def looked_up(lefts, rights):
    out = []
    for i, k, t in lefts:
        before = [(rt, v) for rk, rt, v in rights if rk == k and rt is not None and t is not None and k is not None and rt <= t]
        out.append((i, *max(before, default=(None, None))))
    return sorted(out)


def joined(spark, lefts, rights, **more):
    left = spark.createDataFrame(lefts, "i int, k string, t timestamp")
    right = spark.createDataFrame(rights, "k string, rt timestamp, v int")
    rows = asof_join(left, right, keys=["k"], time="t", right_time="rt", columns=["v"], **more).collect()
    return sorted((r["i"], r["rt"], r["v"]) for r in rows)


def test_asof_equals_a_plain_loop_over_bucket_edges_and_long_gaps(spark):
    draw = random.Random(2)
    moment = lambda: START + timedelta(hours=draw.randrange(24 * 400))
    rights = [(draw.choice("abc"), moment(), draw.randrange(9)) for _ in range(40)]
    lefts = [(i, draw.choice("abcd"), moment()) for i in range(300)]
    lefts += [(300 + i, k, t) for i, (k, t, _) in enumerate(rights)]  # equal times match
    for bucket in ("month", "day", "year"):
        assert joined(spark, lefts, rights, bucket=bucket) == looked_up(lefts, rights)


def test_asof_edge_cases(spark):
    first = datetime(2024, 1, 1)
    rights = [("a", first, 1), ("a", first, 7), (None, first, 3), ("b", None, 4)]
    lefts = [(1, "a", first), (1, "a", first), (2, "a", first - timedelta(seconds=1)), (3, None, first), (4, "a", None), (5, "b", first)]
    assert joined(spark, lefts, rights) == looked_up(lefts, rights)
    assert joined(spark, lefts, []) == sorted((i, None, None) for i, _, _ in lefts)
    assert joined(spark, [], rights) == []


def test_asof_needs_no_inequality_join_and_no_window_over_the_left_rows(spark, sf_dir):
    plan = QUERIES["r4_prices_asof_rate"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Window" in plan and "currency" in plan and "__bucket" in plan


def test_gaps_are_filled_on_a_line_over_months(spark):
    day = date(2024, 1, 30)
    rows = [("a", day, 1.0), ("a", day + timedelta(2), 3.0), ("a", day + timedelta(3), None), ("a", day + timedelta(102), 103.0), ("b", day, 5.0), (None, day, 1.0), (None, day + timedelta(1), 2.0)]
    got = fill_gaps(spark.createDataFrame(rows, "k string, d date, v double"), keys=["k"], date="d", value="v").collect()
    a = sorted((r["d"], r["v"], r["is_filled"]) for r in got if r["k"] == "a")
    assert a == [(day + timedelta(n), 1.0 + n, n not in (0, 2, 102)) for n in range(103)]
    assert [(r["d"], r["v"], r["is_filled"]) for r in got if r["k"] == "b"] == [(day, 5.0, False)]
    assert sorted(r["v"] for r in got if r["k"] is None) == [1.0, 2.0]
    assert fill_gaps(spark.createDataFrame([], "k string, d date, v double"), keys=["k"], date="d", value="v").collect() == []
