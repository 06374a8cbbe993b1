"""Series functions through the split path must equal the plain window and brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pricelake.operators import cleaning, enrich, features, quality, views
from pricelake.operators.series import carry_last, over_series, with_group_stats, with_position

SPLIT = {"plain_limit": 0, "chunk_rows": 16}


@pytest.fixture(scope="module")
def rows(spark):
    """One series with a third of all rows, some short ones, one NULL key; some prices missing."""
    rng = random.Random(7)
    data = []
    for key, size in (("hot", 240), ("a", 200), ("b", 35), ("c", 1), (None, 40), ("d", 90)):
        for i in range(size):
            price = None if rng.random() < 0.2 else round(rng.uniform(0, 50), 2)
            data.append((key, i // 3, i, price, float(rng.randint(0, 9))))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, day int, seq int, price double, volume double").cache()


def as_dict(df, value):
    return {(r["k"], r["seq"]): r[value] for r in df.collect()}


def series(rows):
    out: dict = {}
    for r in rows.collect():
        out.setdefault(r["k"], []).append(r)
    return {k: sorted(v, key=lambda r: (r["day"], r["seq"])) for k, v in out.items()}


def test_positions_are_dense(rows):
    placed = as_dict(with_position(rows, ["k"], ["day", "seq"], "p", blocks=7), "p")
    for key, items in series(rows).items():
        assert [placed[(key, r["seq"])] for r in items] == list(range(len(items)))


def test_lag_and_lead_split(rows):
    def build(w):
        return {"before": F.lag("seq", 5).over(w), "after": F.lead("seq", 3).over(w)}

    out = over_series(rows, ["k"], ["day", "seq"], build, before=5, after=3, plain_limit=0, chunk_rows=10)
    assert out.count() == rows.count()
    before, after = as_dict(out, "before"), as_dict(out, "after")
    for key, items in series(rows).items():
        for i, r in enumerate(items):
            assert before[(key, r["seq"])] == (items[i - 5]["seq"] if i >= 5 else None)
            assert after[(key, r["seq"])] == (items[i + 3]["seq"] if i + 3 < len(items) else None)


@pytest.mark.parametrize("include_current", [True, False])
def test_carry_last_split(rows, include_current):
    out = carry_last(
        rows, ["k"], ["day", "seq"], {"seen": "price"}, include_current=include_current, **SPLIT
    )
    seen = as_dict(out, "seen")
    assert len(seen) == rows.count()
    for key, items in series(rows).items():
        last = None
        for r in items:
            if include_current and r["price"] is not None:
                last = r["price"]
            assert seen[(key, r["seq"])] == last
            if r["price"] is not None:
                last = r["price"]


def test_one_series_without_keys(rows):
    only = rows.filter("k = 'hot'")
    out = over_series(
        only, [], ["seq"], lambda w: {"p": F.lag("seq", 1).over(w)}, before=1, single_series=True, **SPLIT
    )
    assert {r["seq"]: r["p"] for r in out.collect()} == {i: (i - 1 if i else None) for i in range(240)}
    with pytest.raises(ValueError):
        over_series(only, [], ["seq"], lambda w: {}, before=1)
    with pytest.raises(ValueError):
        over_series(only, ["k"], [], lambda w: {}, before=1)


FEATURES = {
    "lag": lambda d, **o: features.lag_features(d, price="price", **o),
    "rolling": lambda d, **o: features.rolling_features(d, price="price", windows=[3, 20], **o),
    "momentum": lambda d, **o: features.momentum_features(d, price="price", **o),
    "rsi": lambda d, **o: features.rsi_feature(d, price="price", **o),
    "macd": lambda d, **o: features.macd_feature(d, price="price", **o),
    "changes": lambda d, **o: enrich.add_price_changes(d, price="price", **o),
    "fill": lambda d, **o: cleaning.forward_fill(d, columns=["price"], **o),
    "trends": lambda d, **o: views.price_trends(d, price="price", **o),
    "volume": lambda d, **o: views.volume_analysis(d, **o),
    "spikes": lambda d, **o: quality.price_spikes(d, price="price", rows=5, threshold=1.5, **o),
}


@pytest.mark.parametrize("name", sorted(FEATURES))
def test_split_equals_plain(rows, name):
    options = {"keys": ["k"], "order_by": ["day", "seq"]}
    plain = FEATURES[name](rows, series_rows=1, **options)
    split = FEATURES[name](rows, **options, **SPLIT)
    assert sorted(plain.columns) == sorted(split.columns)
    key = lambda r: (str(r["k"]), r["seq"])
    left = sorted(plain.select(*sorted(plain.columns)).collect(), key=key)
    right = sorted(split.select(*sorted(plain.columns)).collect(), key=key)
    assert len(left) == len(right)
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and y == pytest.approx(x, abs=1e-7)), (a, b)


def test_macd_against_direct_sums(spark):
    prices = [10 + (i * 37 % 23) / 7 for i in range(1500)]
    df = spark.createDataFrame([("x", i, p) for i, p in enumerate(prices)], "k string, seq int, price double")
    out = features.macd_feature(df, keys=["k"], order_by=["seq"], price="price", series_rows=1)
    got = {r["seq"]: r["momentum_macd"] for r in out.collect()}

    def ema(i, span):
        keep = 1 - 2 / (span + 1)
        ages = range(i + 1)
        return sum(prices[i - a] * keep**a for a in ages) / sum(keep**a for a in ages)

    for i in (0, 1, 50, 129, 130, 1020, 1023, 1024, 1100, 1499):
        assert got[i] == pytest.approx(ema(i, 12) - ema(i, 26), abs=1e-9)


def test_quartiles_by_rank_both_paths(spark):
    rng = random.Random(3)
    groups = {"hot": 301, "x": 4, "y": 1, None: 9}
    data = [(k, float(rng.randint(0, 40))) for k, n in groups.items() for _ in range(n)]
    data += [("hot", 20.0)] * 150 + [("x", None), ("z", None)]
    df = spark.createDataFrame(data, "k string, v double")
    for limit in (None, 0):
        got = {
            r["k"]: (r["q1"], r["q3"])
            for r in cleaning.quartile_bounds(df, column="v", keys=["k"], plain_limit=limit, blocks=5).collect()
        }
        for key in groups:
            ordered = sorted(v for k, v in data if k == key and v is not None)
            assert got[key] == (ordered[len(ordered) // 4], ordered[3 * len(ordered) // 4]), (key, limit)
        assert "z" not in got
        whole = cleaning.quartile_bounds(df, column="v", plain_limit=limit, blocks=5).first()
        ordered = sorted(v for _, v in data if v is not None)
        assert (whole["q1"], whole["q3"]) == (ordered[len(ordered) // 4], ordered[3 * len(ordered) // 4])


def test_group_stats_keep_null_keys(rows):
    out = with_group_stats(rows, ["k"], n=F.count(F.lit(1)))
    assert {r["k"]: r["n"] for r in out.collect()} == {
        "hot": 240, "a": 200, "b": 35, "c": 1, None: 40, "d": 90
    }
    total = with_group_stats(rows, [], n=F.count(F.lit(1)), top=F.max("seq")).first()
    assert (total["n"], total["top"]) == (rows.count(), 239)


@pytest.fixture(scope="module")
def days(spark):
    """As `rows`, by date: crowded days, months without rows, a NULL date and a NULL key."""
    rng = random.Random(11)
    data = []
    for key, size in (("hot", 300), ("a", 120), ("b", 9), ("c", 1), (None, 60)):
        day = 0
        for i in range(size):
            day += rng.choice((0, 0, 0, 1, 2, 9, 40, 100))
            price = None if rng.random() < 0.4 else round(rng.uniform(0, 50), 2)
            data.append((key, None if i == 0 and key == "a" else day, i, price, float(rng.randint(0, 9))))
    rng.shuffle(data)
    made = spark.createDataFrame(data, "k string, n int, seq int, price double, volume double")
    return made.select("k", F.date_add(F.lit("2020-01-15").cast("date"), F.col("n")).alias("day"), "seq", "price", "volume").cache()


def jobs_of(spark, group, make):
    """(result of make, number of jobs that ran meanwhile)."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        return make(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("bucket", ["day", "month", "year"])
@pytest.mark.parametrize("name", sorted(FEATURES))
def test_calendar_buckets_equal_plain(spark, days, name, bucket):
    options = {"keys": ["k"], "order_by": ["day", "seq"]}
    plain = FEATURES[name](days, series_rows=1, **options)
    split, jobs = jobs_of(spark, f"{name}-{bucket}", lambda: FEATURES[name](days, bucket=bucket, **options))
    assert jobs == 0  # the plan is made without looking at the rows
    assert sorted(plain.columns) == sorted(split.columns)
    key = lambda r: (str(r["k"]), r["seq"])
    left = sorted(plain.select(*sorted(plain.columns)).collect(), key=key)
    right = sorted(split.select(*sorted(plain.columns)).collect(), key=key)
    assert len(left) == len(right)
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and y == pytest.approx(x, abs=1e-7)), (a, b)


def test_calendar_frames_ahead(days):
    options = {"keys": ["k"], "order_by": ["day", "seq"], "before": 4, "after": 7}
    build = lambda w: {"b": F.lag("seq", 4).over(w), "a": F.lead("seq", 7).over(w), "s": F.sum("seq").over(w.rowsBetween(-4, 7))}
    plain, split = over_series(days, build=build, series_rows=1, **options), over_series(days, build=build, bucket="day", **options)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    with pytest.raises(ValueError):
        over_series(days, ["k"], ["seq"], build, before=1, bucket="day")


def test_order_statistics_of_any_double(spark):
    rng = random.Random(5)
    import struct

    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), float("-inf"), 1.0, 0.9999999999999999, 1.0000000000000002, 2.0**53, 8.0, 7.999999999999999]
    while len(values) < 400:
        (v,) = struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))
        if v == v:
            values.append(v)
    df = spark.createDataFrame([("k", v) for v in values] + [("nan", float("nan")), ("nan", 1.0)], "k string, v double")
    bits = df.filter("k = 'k'").select("v", cleaning.sortable_bits(F.col("v")).alias("b")).collect()
    assert [r["v"] for r in sorted(bits, key=lambda r: r["b"])] == sorted(values)
    assert len({r["b"] for r in bits}) == len(set(values))
    ranks = {f"r{i}": F.lit(i) for i in (0, 1, 17, 200, 399)}
    ordered = sorted(values)
    out, jobs = jobs_of(spark, "ranks", lambda: cleaning.order_statistics(df, column="v", keys=["k"], ranks=ranks))
    got = {r["k"]: r for r in out.collect()}
    assert jobs == 0 and all(got["k"][f"r{i}"] == ordered[i] for i in (0, 1, 17, 200, 399))
    assert got["nan"]["r0"] == 1.0 and got["nan"]["r1"] != got["nan"]["r1"] and got["nan"]["r17"] is None


def test_macd_over_gaps_of_several_cycles(spark):
    """Prices in rows 0-99, at the end of one cycle and the start of the next, then a gap of more than two cycles."""
    priced = [*range(100), *range(2040, 2050), 5000, 5001]
    prices = [10 + (i * 37 % 23) / 7 if i in set(priced) else None for i in range(5200)]
    df = spark.createDataFrame([("x", i, p) for i, p in enumerate(prices)], "k string, seq int, price double")
    out = features.macd_feature(df, keys=["k"], order_by=["seq"], price="price", series_rows=5200)
    got = {r["seq"]: r["momentum_macd"] for r in out.collect()}

    def ema(i, span):
        keep = 1 - 2 / (span + 1)
        seen = [a for a in priced if a <= i]
        return sum(prices[a] * keep ** (seen[-1] - a) for a in seen) / sum(keep ** (seen[-1] - a) for a in seen)

    for i in (0, 99, 100, 1500, 2039, 2040, 2047, 2048, 2049, 2050, 3000, 3500, 4800, 4999, 5000, 5001, 5100, 5199):
        assert got[i] == pytest.approx(ema(i, 12) - ema(i, 26), abs=1e-9), i
