"""Dimensions, history, fact load, refresh, snapshots, views and the whole chain."""

from __future__ import annotations

from datetime import date
from pathlib import Path
from statistics import mean, pvariance
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from pricelake.operators import views, warehouse
from pricelake.plans import medallion
from pricelake.schemas import TABLES, create_tables
from pricelake.session import FREED_SHUFFLES, checkpoint_dir
from pricelake.sources.canonical import PRICE_ORDER, prices



def day(text):
    return F.lit(text).cast("date")


LAYOUT = "k int, name string, unit string, effective_date date, end_date date, is_current boolean, version int"


def versions(df):
    return sorted((r["k"] or 0, r["version"], r["name"], r["end_date"], r["is_current"]) for r in df.collect())


def test_scd2_three_loads(spark):
    empty = spark.createDataFrame([], LAYOUT)
    rows = lambda *data: spark.createDataFrame(data, "k int, name string, unit string")
    options = {"tracked": ["name"], "order_by": ["unit"]}
    one = warehouse.scd2_merge(empty, rows((1, "Wheat", "t"), (2, None, "t")), ["k"], effective=day("2024-06-01"), **options)
    assert versions(one) == [(1, 1, "Wheat", None, True), (2, 1, None, None, True)]
    two = warehouse.scd2_merge(
        one, rows((1, "Wheat 2", "a"), (1, "Wheat 3", "b"), (2, None, "kg"), (None, "new", "t")), ["k"],
        effective=day("2024-07-01"), **options,
    )
    closed = date(2024, 7, 1)
    assert versions(two) == [
        (0, 1, "new", None, True), (1, 1, "Wheat", closed, False), (1, 2, "Wheat 3", None, True), (2, 1, None, None, True)
    ]
    three = warehouse.scd2_merge(two, rows((2, "Corn", "t")), ["k"], effective=day("2024-08-01"), **options)
    assert (2, 2, "Corn", None, True) in versions(three) and (1, 1, "Wheat", closed, False) in versions(three)
    then = warehouse.point_in_time(three, day("2024-06-15"))
    assert sorted(r["name"] or "" for r in then.collect()) == ["", "Wheat"]
    current = three.filter("is_current").groupBy("k").count().filter("count > 1")
    assert current.count() == 0


def test_insert_upsert_statistics(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "B1"), (2, "B2"), (3, "c"), (None, "n")], "k int, v string")
    inserted = warehouse.insert_missing(old, new, ["k"], order_by=["v"])
    assert sorted((r["k"] or 0, r["v"]) for r in inserted.collect()) == [(0, "n"), (1, "a"), (2, "b"), (3, "c")]
    merged = warehouse.upsert(old, new, ["k"], order_by=["v"])
    assert sorted((r["k"] or 0, r["v"]) for r in merged.collect()) == [(0, "n"), (1, "a"), (2, "B2"), (3, "c")]
    stats = warehouse.load_statistics(warehouse.classify(old, new, ["k"], order_by=["v"]))
    assert {r["action"]: r["row_count"] for r in stats.collect()} == {"inserted": 1, "updated": 1, "unchanged": 1, "kept": 1}


def test_seeds_and_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS gold_test LOCATION '{tmp_path}'")
    assert len(create_tables(spark, "gold_test")) == 9
    seeds = warehouse.seed_dimensions(spark)
    assert {n: f.count() for n, f in seeds.items()} == {
        "dim_currency": 3, "dim_commodity": 5, "dim_market": 3, "dim_source": 4
    }
    for name, frame in seeds.items():
        assert frame.columns == spark.table(f"gold_test.{name}").columns
        frame.write.insertInto(f"gold_test.{name}")
    assert spark.table("gold_test.dim_commodity").filter("commodity_name = 'Corn' and is_current").count() == 1
    assert set(TABLES) >= {"dim_date", "commodity_prices_fact"}
    spark.sql("DROP DATABASE gold_test CASCADE")


def test_surrogate_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a"), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(warehouse.surrogate_key(["x", "y"])).collect()]
    assert len(set(keys)) == 4
    assert warehouse.surrogate_collisions(df, ["x", "y"]).count() == 0


def test_snapshots(spark, tmp_path):
    base = str(tmp_path / "dim")
    with pytest.raises(FileNotFoundError):
        warehouse.read_snapshot(spark, base)
    warehouse.write_snapshot(spark.range(3), base)
    warehouse.write_snapshot(warehouse.read_snapshot(spark, base).filter("id > 0"), base)
    (tmp_path / "dim" / "v=00000003").mkdir()  # unfinished: no success marker
    assert warehouse.read_snapshot(spark, base).count() == 2


@pytest.fixture(scope="module")
def dims(spark):
    return {
        "dim_date": warehouse.date_dimension(spark, "2024-01-01", "2024-01-31"),
        **warehouse.seed_dimensions(spark),
    }


RAW = "date string, commodity string, market string, source string, currency string, unit string, open_price double, high_price double, low_price double, close_price double, volume double, id int"


def raw_rows(spark, *extra):
    base = [
        (f"{d:02d}.01.2024", c, "Chicago CBOT", s, "USD", "ton", p, p + 1, p - 1, p, 10.0, i)
        for i, (d, c, s, p) in enumerate(
            [(2, "wheat", "yfinance", 200.0), (2, "Wheat", "currency", 204.0), (3, " WHEAT", "yfinance", 202.0),
             (2, "corn", "yfinance", 100.0), (3, "corn", "yfinance", 101.0), (4, "corn", "yfinance", 99.0)]
        )
    ]
    return spark.createDataFrame([*base, *extra], RAW)


def test_whole_chain(spark, dims, tmp_path):
    raw = raw_rows(
        spark,
        ("2024-01-02", "corn", "Chicago CBOT", "yfinance", "USD", "ton", 100.0, 101.0, 99.0, 100.0, 10.0, 3),  # repeat of id 3
        ("2024/01/05", "corn", "Nowhere", "yfinance", "USD", "kg", 100.0, 101.0, 99.0, 100.0, 1000.0, 20),  # unknown market
        ("2024-1-5", "corn", "Kyiv Exchange", "yfinance", "EUR", "ton", 90.0, 91.0, 89.0, 91.0, 1.0, 21),
        ("2024-01-05", "corn", "Kyiv Exchange", "yfinance", "USD", "ton", None, None, None, None, 1.0, 22),  # no price
    )
    silver = medallion.to_silver(raw, keys=["id"], order_by=["date", "id"], outlier_threshold=50.0)
    rows = {r["id"]: r for r in silver.collect()}
    assert sorted(rows) == [0, 1, 2, 3, 4, 5, 20, 21]
    assert rows[2]["commodity"] == "Wheat" and rows[2]["price_change"] == -2.0
    assert rows[20]["volume"] == pytest.approx(1.0) and rows[20]["volume_unit"] == "ton"
    assert rows[21]["close_price"] == pytest.approx(100.1) and rows[21]["currency"] == "USD"
    assert rows[0]["commodity_category"] == "cereals" and rows[0]["date_key"] == 20240102
    paths = medallion.load_gold(spark, silver, dims, str(tmp_path), natural_key=["id"], grain="month")
    fact = spark.read.parquet(paths["fact"])
    assert fact.count() == 7
    daily = spark.read.parquet(paths["daily_price_summary"])
    wheat = daily.filter("date_key = 20240102 and commodity_key = 1").first()
    assert (float(wheat["high_price"]), float(wheat["low_price"]), wheat["record_count"], wheat["source_count"]) == (204.0, 200.0, 2, 2)
    monthly = spark.read.parquet(paths["monthly_commodity_summary"]).filter("commodity_key = 2").first()
    assert (monthly["year"], monthly["month"], float(monthly["min_price"])) == (2024, 1, 99.0)
    weekly = spark.read.parquet(paths["weekly_commodity_summary"])
    assert {(r["year"], r["week_of_year"]) for r in weekly.collect()} == {(2024, 1)}
    checks = warehouse.verify_warehouse(fact, dims)
    assert checks.filter("not passed").count() == 0
    star = views.star_facts(fact, dims["dim_date"], dims["dim_commodity"], dims["dim_market"], dims["dim_source"])
    assert star.count() == 7
    names = views.register_views(spark, star, order_by=["date", "price_id"])
    assert len(names) == 6 and all(spark.table(n).count() > 0 for n in names if n not in ("v_correlation", "v_yoy_comparison"))


def test_incremental_refresh_equals_full(spark, dims, tmp_path):
    def fact_of(*ids):
        rows = raw_rows(spark).filter(F.col("id").isin(*ids)).withColumn("date", F.to_date("date", "dd.MM.yyyy"))
        named = rows.withColumn("commodity", F.initcap(F.trim("commodity")))
        return warehouse.fact_rows(warehouse.resolve_fact_keys(named, dims), natural_key=["id"])

    order = ["date_key", "price_id"]
    parts, whole = str(tmp_path / "parts"), str(tmp_path / "whole")
    warehouse.write_fact(fact_of(0, 1, 3), f"{parts}/fact")
    warehouse.refresh_summaries(spark, f"{parts}/fact", parts, order_by=order)
    late = fact_of(2, 4, 5)
    warehouse.write_fact(late, f"{parts}/fact")
    warehouse.refresh_summaries(spark, f"{parts}/fact", parts, order_by=order, touched=late)
    warehouse.write_fact(fact_of(0, 1, 2, 3, 4, 5), f"{whole}/fact")
    warehouse.refresh_summaries(spark, f"{whole}/fact", whole, order_by=order)
    for name in ("daily_price_summary", "weekly_commodity_summary", "monthly_commodity_summary"):
        a, b = (spark.read.parquet(f"{p}/{name}") for p in (parts, whole))
        assert a.count() == b.count() > 0
        assert a.select(*b.columns).exceptAll(b).count() == 0


def test_late_rows_of_a_loaded_day_keep_what_is_there(spark, dims, tmp_path):
    def load(*rows):
        raw = spark.createDataFrame([(d, c, m, "yfinance", "USD", "ton", p, p, p, p, 10.0, i) for i, (d, c, m, p) in rows], RAW)
        known = None
        if any((tmp_path / "silver").glob("*")):
            stored = spark.read.parquet(str(tmp_path / "silver"))
            days = sorted(r[1][0] for r in rows)
            known = medallion.known_prices(stored, days[0], days[-1], keys=["id"], order_by=["date", "id"])
        silver = medallion.to_silver(raw, keys=["id"], order_by=["date", "id"], outlier_threshold=50.0, known=known)
        return medallion.load_gold(spark, silver, dims, str(tmp_path), natural_key=["id"], grow_dimensions=True)

    first = load((1, ("2024-01-02", "corn", "Chicago CBOT", 100.0)), (2, ("2024-01-09", "corn", "Chicago CBOT", 104.0)))
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("*/date_key=20240109/*.parquet")}
    assert len(before) == 3
    paths = load(
        (3, ("2024-01-02", "corn", "Chicago CBOT", 102.0)), (4, ("2024-01-03", "soap", "Moon", 7.0)),
        (5, ("2024-01-03", "corn", "Chicago CBOT", 1.5e8)),
    )
    assert paths == first
    fact = spark.read.parquet(paths["fact"])
    assert fact.count() == 4 and fact.filter("close_price is null").count() == 0
    silver = {r["id"]: r["price_change"] for r in spark.read.parquet(paths["silver"]).collect()}
    assert sorted(silver) == [1, 2, 3, 4, 5] and silver[3] == 2.0
    day = spark.read.parquet(paths["daily_price_summary"]).filter("date_key = 20240102").collect()
    assert [(float(r["low_price"]), float(r["high_price"]), r["record_count"]) for r in day] == [(100.0, 102.0, 2)]
    names = {r["commodity_name"] for r in warehouse.read_snapshot(spark, paths["dim_commodity"]).collect()}
    assert {"Corn", "soap"} <= names
    assert {p: p.stat().st_mtime_ns for p in before} == before


def test_correlation_with_missing_and_repeated_prices(spark):
    data = [
        (1, "m", "a", 1.0), (1, "m", "a", 3.0), (1, "m", "b", 2.0), (2, "m", "a", 5.0), (2, "m", "b", 6.0),
        (2, "m", "b", 7.0), (3, "m", "a", None), (3, "m", "b", 9.0), (4, "m", "a", 2.0), (4, "n", "b", 9.0),
    ]
    df = spark.createDataFrame(data, "date int, market string, commodity string, close_price double")
    fast, slow = views.correlation(df).first(), views.correlation_by_rows(df).first()
    assert fast["overlap_days"] == slow["overlap_days"] == 5
    assert fast["price_correlation"] == pytest.approx(slow["price_correlation"])


def test_correlation_by_rows_of_large_and_constant_cells(spark):
    """Cells of 100,000 rows would make 10^10 row pairs; a constant price has no correlation."""
    rows = spark.range(200_000).selectExpr("cast(id % 2 as int) as date", "'m' as market", "id % 977 + id % 2 * 500 as p")
    both = rows.selectExpr("date", "market", "'a' as commodity", "cast(p as double) as close_price").unionByName(
        rows.selectExpr("date", "market", "'b' as commodity", "cast(3 * p + 1e6 as double) as close_price")
    ).unionByName(rows.selectExpr("date", "market", "'c' as commodity", "0.1D as close_price"))
    out = {(r["commodity_1"], r["commodity_2"]): r for r in views.correlation_by_rows(both).collect()}
    assert {r["overlap_days"] for r in out.values()} == {2 * 100_000**2}
    values = [i % 977 + i % 2 * 500 for i in range(200_000)]
    # every row meets every row of the day: only the two days' means vary together
    between = (mean(values[1::2]) - mean(values[::2])) ** 2 / 4
    assert out["a", "b"]["price_correlation"] == pytest.approx(between / pvariance(values), abs=1e-12)
    assert out["a", "c"]["price_correlation"] is None and out["b", "c"]["price_correlation"] is None


def test_view_order(spark):
    df = spark.createDataFrame([("b", 2024, 1), ("a", 2023, 1), ("a", 2024, 1), ("a", 2024, 2)], "commodity string, year int, month int")
    rows = views.in_view_order("volatility", df).collect()
    assert [tuple(r) for r in rows] == [("a", 2024, 2), ("a", 2024, 1), ("a", 2023, 1), ("b", 2024, 1)]


def test_price_order_is_total(spark, sf_dir):
    facts = prices(spark, sf_dir)
    assert facts.count() == facts.select(*PRICE_ORDER).distinct().count()


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = views.volatility(prices(spark, sf_dir))._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "l_shipdate" in line)
    assert "l_returnflag" not in scan and "l_orderkey" not in scan


def test_dedup_is_cut_before_the_shuffle(spark, sf_dir):
    from pricelake.plans.catalog import QUERIES

    plan = QUERIES["c1_dedup_first"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan




def test_a_key_that_comes_twice_in_one_batch_is_loaded_once(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "id long, day int, version int, price double"
    load = lambda *rows, **more: warehouse.merge_partitions(spark.createDataFrame(list(rows), schema), path, keys=["id"], part="day", **more)
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(path).select("id", "day", "version", "price").collect())
    load((1, 1, 1, 5.0), (1, 1, 2, 6.0), (1, 1, 2, 6.0), (2, 1, 1, 7.0), order_by=["version"])
    assert read() == [(1, 1, 2, 6.0), (2, 1, 1, 7.0)]
    load((2, 1, 2, 8.0), (2, 1, 2, 8.0), (3, 2, 1, 9.0))
    assert read() == [(1, 1, 2, 6.0), (2, 1, 2, 8.0), (3, 2, 1, 9.0)]
    rows = [(4, 1, v, float(v)) for v in range(5)]
    load(*rows)
    kept = read()
    load(*reversed(rows))
    assert read() == kept and sum(r[0] == 4 for r in kept) == 1


def test_a_load_rewrites_only_partitions_with_replaced_rows_and_leaves_no_copies(spark, dims, tmp_path):
    path, schema = f"{tmp_path}/t", "id long, day int, price double"
    scratch = lambda: {p.name for p in Path(urlparse(checkpoint_dir(spark)).path).glob("*-*") if p.name.startswith(("fresh", "batch"))}
    load = lambda *rows, layout=schema: warehouse.merge_partitions(spark.createDataFrame(list(rows), layout), path, keys=["id"], part="day")
    read = lambda: sorted((tuple(r) for r in spark.read.parquet(path).select("id", "day", "price").collect()), key=str)
    files = lambda day: {p.name for p in (tmp_path / "t").glob(f"day={day}/*.parquet")}
    before = scratch()
    load((1, 1, 5.0), (2, 2, 6.0), (None, None, 7.0), (5, None, 7.5))
    first = {day: files(day) for day in (1, 2)}
    load((3, 1, 8.0), (2, 2, 9.0), (None, None, 10.0))
    assert read() == sorted([(1, 1, 5.0), (3, 1, 8.0), (2, 2, 9.0), (None, None, 10.0), (5, None, 7.5)], key=str)
    assert first[1] < files(1) and not first[2] & files(2)
    # another type of the key is compared by value
    load((1, 1, 11.0), layout="id int, day int, price double")
    assert read() == sorted([(1, 1, 11.0), (3, 1, 8.0), (2, 2, 9.0), (None, None, 10.0), (5, None, 7.5)], key=str)
    silver = medallion.to_silver(raw_rows(spark), keys=["id"], order_by=["date", "id"], outlier_threshold=50.0)
    for _ in range(2):
        medallion.load_gold(spark, silver, dims, f"{tmp_path}/gold", natural_key=["id"], grain="month")
    assert scratch() == before and spark.conf.get(FREED_SHUFFLES, None) in (None, "false")
    facts = spark.read.parquet(f"{tmp_path}/gold/commodity_prices_fact")
    assert facts.count() == facts.select("price_id").distinct().count() > 0
