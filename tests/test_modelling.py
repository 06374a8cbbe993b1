"""Model input against plain loops: treated outliers, changes, seasonal parts, correlations, labels, split export."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta
from statistics import fmean

import pandas as pd
import pytest

from pricelake.operators.modelling import (
    correlation_matrix, date_split, decompose, export_split, next_move, period_changes, read_split, treat_outliers,
)

DAY = date(2024, 1, 1)


def near(got, wanted):
    return got is None and wanted is None or got is not None and wanted is not None and math.isclose(got, wanted, abs_tol=1e-9)


def monthly(spark, series):
    rows = [(k, n // 12, n % 12 + 1, v) for k, values in series.items() for n, v in values.items()]
    return spark.createDataFrame(rows, "commodity string, year int, month int, avg_price double")


def drawn(seed):
    draw = random.Random(seed)
    full = {n: 50 + n / 3 + 8 * math.sin(n) + draw.random() for n in range(24_000, 24_050)}
    gappy = {n: draw.random() for n in range(24_000, 24_060) if n not in (24_010, 24_031, 24_032)}
    missing = {**{n: draw.random() for n in range(24_000, 24_040)}, 24_020: None}
    return {"full": full, "gappy": gappy, "missing": missing, "short": {24_003: 1.0, 24_004: 2.0}, None: {n: float(n % 5) for n in range(24_000, 24_030)}}


def parts(values):
    trend = {}
    for n in values:
        around = [values.get(n + d) for d in range(-6, 7)]
        trend[n] = None if None in around else (sum(around[1:-1]) + (around[0] + around[-1]) / 2) / 12
    apart = {}
    for n, v in values.items():
        if v is not None and trend[n] is not None:
            apart.setdefault(n % 12, []).append(v - trend[n])
    effect = {m: fmean(x) for m, x in apart.items()}
    centre = fmean(effect.values()) if effect else 0
    return {n: (trend[n], effect[n % 12] - centre if n % 12 in effect else None) for n in values}


def test_decomposition_equals_plain_loops_over_gaps_and_missing_values(spark):
    series = drawn(3)
    got = {(r["commodity"], r["year"] * 12 + r["month"] - 1): r for r in decompose(monthly(spark, series)).collect()}
    assert len(got) == sum(map(len, series.values()))
    for k, values in series.items():
        for n, (trend, seasonal) in parts(values).items():
            row, value = got[k, n], values[n]
            assert near(row["trend"], trend) and near(row["seasonal"], seasonal), (k, n)
            whole = None if None in (value, trend, seasonal) else value - trend - seasonal
            assert near(row["residual"], whole), (k, n)
    effects = {r["month"]: r["seasonal"] for (k, _), r in got.items() if k == "full"}
    assert abs(sum(effects.values())) < 1e-9 and len(effects) == 12
    assert decompose(monthly(spark, {})).collect() == []


def test_changes_compare_with_the_calendar_month(spark):
    series = drawn(4)
    got = period_changes(monthly(spark, series)).collect()
    for r in got:
        values, n = series[r["commodity"]], r["year"] * 12 + r["month"] - 1
        for name, back in (("mom_change_pct", 1), ("yoy_change_pct", 12)):
            now, then = values[n], values.get(n - back)
            assert near(r[name], None if now is None or not then else (now - then) / then * 100)
    assert len(got) == sum(map(len, series.values()))


def test_building_monthly_plans_starts_no_job(spark):
    rows = monthly(spark, drawn(5))
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    decompose(rows), period_changes(rows), treat_outliers(rows, column="avg_price")
    assert set(tracker.getJobIdsForGroup(None)) == before


def test_matrix_equals_pairwise_complete_correlation(spark):
    draw = random.Random(6)
    rows = [(DAY + timedelta(draw.randrange(40)), draw.choice("abcdx"), draw.gauss(10, 3)) for _ in range(400)]
    rows += [(DAY, "a", None), (None, "a", 1.0), (None, "b", 4.0), (DAY, None, 2.0), (DAY, "still", 1.0), (DAY + timedelta(1), "still", 1.0), (DAY, "once", 1.0)]
    rows += rows[:50]
    names = ["b", "a", "d", "still", "once", "absent"]
    got = correlation_matrix(spark.createDataFrame(rows, "date date, market string, close_price double"), names)
    assert got.columns == ["market", *names]
    cells = pd.DataFrame(rows, columns=["date", "market", "x"]).groupby(["date", "market"], dropna=False)["x"].mean().unstack()
    wanted = cells.reindex(columns=names).astype(float).corr(min_periods=2)
    told = {r["market"]: r for r in got.collect()}
    assert set(told) == set(names)
    for a in names:
        for b in names:
            wish = wanted.loc[a, b]
            assert near(told[a][b], None if math.isnan(wish) else wish), (a, b)


def test_matrix_joins_no_facts(spark):
    facts = spark.createDataFrame([(DAY, "a", 1.0)], "date date, market string, close_price double")
    plan = correlation_matrix(facts, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1  # the listed names with the finished matrix


def test_winsorised_values_are_the_fences(spark):
    draw = random.Random(7)
    rows = [(i, k, draw.gauss(0, 1) * (30 if i % 9 == 0 else 1)) for i in range(200) for k in ("a", "b", None)]
    rows += [(900, "a", None), (901, "empty", None), (902, "one", 5.0)] + rows[:30]
    df = spark.createDataFrame(rows, "i int, k string, v double")
    for keys in (["k"], []):
        got = sorted((r["i"], r["k"] or "", r["is_treated"], r["v"] is None, r["v"] or 0.0) for r in treat_outliers(df, column="v", keys=keys).collect())
        wanted = []
        for i, k, v in rows:
            group = sorted(x for _, g, x in rows if x is not None and (not keys or g == k))
            if v is None:
                wanted.append((i, k or "", False, True, 0.0))
                continue
            q1, q3 = group[len(group) // 4], group[len(group) * 3 // 4]
            low, high = q1 - (q3 - q1) * 1.5, q3 + (q3 - q1) * 1.5
            wanted.append((i, k or "", not low <= v <= high, False, min(max(v, low), high)))
        for one, other in zip(got, sorted(wanted), strict=True):
            assert one[:4] == other[:4] and near(one[4], other[4])
        assert {r["is_treated"] for r in treat_outliers(df, column="v", keys=keys).collect()} == {True, False}
    empty = treat_outliers(df.filter("i < 0"), column="v")
    assert empty.collect() == [] and empty.columns == ["i", "k", "v", "is_treated"]


def labelled(spark, rows):
    df = spark.createDataFrame(rows, "k string, date date, close_price double")
    return next_move(df, keys=["k"], order_by=["date"])


def test_labels_look_one_row_ahead_over_long_gaps(spark):
    draw = random.Random(8)
    days = sorted(draw.sample(range(900), 60))
    rows = [(k, DAY + timedelta(d), draw.choice([0.0, 1.0, 2.0, None])) for k in ("a", "b") for d in days]
    got = {(r["k"], r["date"]): r for r in labelled(spark, rows).collect()}
    for at, (k, day, price) in enumerate(rows):
        after = rows[at + 1] if at + 1 < len(rows) and rows[at + 1][0] == k else (k, None, None)
        row, nothing = got[k, day], after[2] is None or price is None
        assert row["label_date"] == after[1]
        assert row["direction"] == (None if nothing else (after[2] > price) - (after[2] < price))
        assert near(row["next_return_pct"], None if nothing or price == 0 else (after[2] - price) / price * 100)


def test_no_label_crosses_its_split_and_the_export_reads_back(spark, tmp_path):
    rows = [("a", DAY + timedelta(3 * n), float(n)) for n in range(30)] + [("b", DAY + timedelta(80 * n), float(n)) for n in range(3)] + [("c", None, 1.0)]
    edges = [("train", "2024-01-05"), ("validation", "2024-02-01"), ("test", "2024-03-01")]
    told = date_split(labelled(spark, rows), edges)
    firsts = [date(2024, 1, 5), date(2024, 2, 1), date(2024, 3, 1), date(9999, 1, 1)]
    wanted = set()
    for k in "abc":
        line = [d for g, d, _ in rows if g == k and d]
        for day, known in zip(line, line[1:]):
            for (name, _), first, end in zip(edges, firsts, firsts[1:]):
                if first <= day < end and known < end:
                    wanted.add((k, day, name))
    assert {(r["k"], r["date"], r["split"]) for r in told.collect()} == wanted and {n for *_, n in wanted} == {"train", "validation", "test"}
    export_split(told, str(tmp_path / "out"))
    back = {(r["k"], r["date"], r["split"]) for r in read_split(str(tmp_path / "out"), spark).collect()}
    assert back == wanted
    one = read_split(str(tmp_path / "out"), spark, name="test")
    assert {f.split("split=")[1].split("/")[0] for f in one.inputFiles()} >= {"test"} and one.count() == sum(n == "test" for *_, n in wanted)
    assert "PartitionFilters: [isnotnull(split" in one._jdf.queryExecution().executedPlan().toString()
    for wrong in ([], [("a", "2024-02-01"), ("b", "2024-01-01")], [("a", "2024-01-01"), ("b", "2024-01-01")]):
        with pytest.raises(ValueError):
            date_split(told.drop("split"), wrong)
