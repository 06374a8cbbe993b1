"""Cleaning, normalisation, enrichment and quality on small hand-built frames."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from pricelake.operators import aggregates, cleaning, enrich, features, normalize, quality, reports


def values(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_dedup_null_keys_are_equal_and_order_decides(spark):
    df = spark.createDataFrame(
        [(1, None, 3), (1, None, 1), (None, None, 5), (None, None, 4), (2, "x", 9)], "a int, b string, seq int"
    )
    first = cleaning.drop_duplicates(df, keys=["a", "b"], order_by=["seq"])
    last = cleaning.drop_duplicates(df, keys=["a", "b"], order_by=["seq"], keep="last")
    assert sorted(r["seq"] for r in first.collect()) == [1, 4, 9]
    assert sorted(r["seq"] for r in last.collect()) == [3, 5, 9]
    with pytest.raises(ValueError):
        cleaning.drop_duplicates(df, keys=["a"], order_by=[])


def test_missing_strategies(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, 5.0), ("a", 3, None), ("b", 1, None), ("b", 2, float("nan"))],
        "k string, seq int, v double",
    )
    assert cleaning.handle_missing(df).count() == 2
    filled = cleaning.handle_missing(df, strategy="fill", fill_value=0)
    assert [r["v"] for r in filled.orderBy("k", "seq").collect()][:4] == [0.0, 5.0, 0.0, 0.0]
    ahead = cleaning.handle_missing(df, strategy="forward_fill", keys=["k"], order_by=["seq"], columns=["v"])
    assert [r["v"] for r in ahead.orderBy("k", "seq").collect()][:4] == [None, 5.0, 5.0, None]
    text = spark.createDataFrame([(None, None)], "s string, n int")
    assert cleaning.fill_missing(text, "x").first().asDict() == {"s": "x", "n": None}
    with pytest.raises(ValueError):
        cleaning.handle_missing(df, strategy="guess")


def test_standard_names(spark):
    from pricelake.reference_values import COMMODITY_NAMES

    names = [" WHEAT ", "corn", "seed", "bar", "", "  ", None, "gold", "u"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, commodity string")
    out = cleaning.standardize_names(df, mapping=COMMODITY_NAMES).orderBy("i").collect()
    # fuzzy: the first entry whose standard name contains the text; 'u' is only in USD
    assert [r["commodity"] for r in out] == ["Wheat", "Corn", "Rapeseed", "Barley", "", "  ", None, "gold", "USD"]
    many = {f"raw{i}": f"Name {i}" for i in range(300)} | COMMODITY_NAMES
    wide = cleaning.standardize_names(df, mapping=many).orderBy("i").collect()
    assert [r["commodity"] for r in wide][:2] == ["Wheat", "Corn"]


def test_outliers(spark):
    df = spark.createDataFrame([("k", v) for v in (1.0, 2.0, 3.0, 4.0, 100.0, None)], "k string, v double")
    kept = cleaning.remove_outliers(df, column="v", keys=["k"])
    assert sorted([r["v"] for r in kept.collect()], key=lambda v: (v is None, v)) == [1.0, 2.0, 3.0, 4.0, None]
    scored = cleaning.flag_outliers(df, column="v", method="zscore", threshold=1.9)
    assert [r["v"] for r in scored.filter("is_outlier").collect()] == [100.0]
    flat = spark.createDataFrame([("k", 5.0)] * 3, "k string, v double")
    assert cleaning.flag_outliers(flat, column="v", keys=["k"], method="zscore").filter("is_outlier").count() == 0
    empty = df.filter("false")
    assert cleaning.flag_outliers(empty, column="v", keys=["k"]).count() == 0
    assert cleaning.flag_outliers(df.filter("v is null"), column="v").count() == 1


def test_prices_and_units(spark):
    df = spark.createDataFrame(
        [(10.0, "USD", 2.0, "TON"), (10.0, "EUR", 2.0, "bushel"), (10.0, "XXX", 2.0, "sack"), (10.0, None, 2.0, None)],
        "price double, currency string, quantity double, unit string",
    )
    usd = values(normalize.normalize_prices(df), "price", "price_base_currency")
    assert usd == [(10.0, None), (pytest.approx(11.0), "USD"), (10.0, "USD"), (10.0, None)]
    eur = values(normalize.normalize_prices(df, base="EUR"), "price")
    assert eur[0][0] == pytest.approx(10 / 1.10) and eur[1][0] == 10.0
    tons = values(normalize.normalize_units(df), "quantity", "unit")
    assert tons == [(2.0, "TON"), (pytest.approx(0.054431), "ton"), (2.0, "ton"), (2.0, None)]
    kilos = values(normalize.normalize_units(df, target="kg"), "quantity")
    assert kilos[0][0] == pytest.approx(2000.0)


def test_timestamps(spark):
    texts = ["2025-1-2", "2025/01/02", "02-01-2025", "02.01.2025", "garbage", "2025-13-40", None, "2025-01-02 10:00"]
    df = spark.createDataFrame([(t,) for t in texts], "date string")
    out = [r["date"] for r in normalize.normalize_timestamps(df).collect()]
    assert out == ["2025-01-02"] * 4 + ["garbage", "2025-13-40", None, "2025-01-02 10:00"]
    typed = spark.createDataFrame([(datetime(2025, 1, 2, 5),)], "date timestamp")
    assert normalize.normalize_timestamps(typed).first()["date"] == "2025-01-02"


def test_calendar(spark):
    df = spark.createDataFrame([("2024-12-30",), ("2025-07-04",), ("2025-12-27",), ("oops",)], "date string")
    out = enrich.add_trading_flags(enrich.add_date_dimensions(df)).collect()
    assert [r["week_of_year"] for r in out] == [1, 27, 52, None]
    assert [r["day_of_week"] for r in out] == ["Monday", "Friday", "Saturday", None]
    assert [r["is_weekend"] for r in out] == [False, False, True, None]
    assert [r["is_holiday"] for r in out] == [False, True, False, False]
    assert [r["trading_status"] for r in out] == ["active", "halted", "active", "active"]


def test_price_changes(spark):
    df = spark.createDataFrame(
        [("k", 1, 10.0), ("k", 2, None), ("k", 3, 12.0), ("k", 4, 0.0), ("k", 5, 3.0)], "k string, d int, price double"
    )
    out = enrich.add_price_changes(df, keys=["k"], order_by=["d"]).orderBy("d")
    assert values(out, "price_change", "price_change_pct") == [
        (None, None), (None, None), (2.0, 20.0), (-12.0, -100.0), (3.0, 0.0)
    ]


def test_attributes(spark):
    df = spark.createDataFrame([("Wheat",), ("Rapeseed",), ("wheat",)], "commodity string")
    out = enrich.add_commodity_attributes(df)
    assert values(out, "commodity_type", "commodity_category", "commodity_unit") == [
        ("grain", "cereals", "ton"), ("oil_crop", "oil_seeds", "ton"), (None, None, None)
    ]


def test_daily_summary_edges(spark):
    day = date(2024, 12, 30)
    df = spark.createDataFrame(
        [(day, "a", "m", 1, 5.0, 2.0), (day, "a", "m", 2, 9.0, None), (day, "a", "m", 3, None, 1.0),
         (day, "b", "m", 1, 7.0, 1.0), (day, "z", "m", 1, 0.0, 1.0), (day, "z", "m", 2, 4.0, 1.0),
         (day, "n", "m", 1, None, None)],
        "date date, commodity string, market string, seq int, close_price double, volume double",
    )
    daily = aggregates.daily_summary(df, order_by=["seq"])
    got = {r["commodity"]: r for r in daily.collect()}
    a = got["a"]
    assert (a["open_price"], a["high_price"], a["low_price"], a["close_price"]) == (5.0, 9.0, 5.0, 9.0)
    assert (a["volume"], a["record_count"], a["price_change"], a["price_change_pct"]) == (3.0, 2, 4.0, 80.0)
    assert (got["b"]["price_change"], got["b"]["record_count"]) == (None, 1)
    assert got["z"]["price_change_pct"] is None
    assert (got["n"]["volume"], got["n"]["open_price"], got["n"]["record_count"]) == (0.0, None, 0)
    week = aggregates.weekly_summary(daily).filter("commodity = 'a'").first()
    assert (week["year"], week["week"]) == (2024, 1)
    month = aggregates.monthly_summary(daily).filter("commodity = 'a'").first()
    assert month["price_volatility"] is None


def test_structure_features(spark):
    df = spark.createDataFrame(
        [(1.0, 4.0, 2.0, 3.0), (1.0, 2.0, 2.0, 2.0), (None, 4.0, 2.0, 3.0)],
        "open_price double, high_price double, low_price double, close_price double",
    )
    out = features.market_structure_features(df).collect()
    assert [r["market_close_position"] for r in out] == [0.5, None, None]
    assert out[0]["market_typical_price"] == 3.0


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0), (1, "a", None), (2, None, 50.0), (2, None, -1.0)], "id int, name string, v double"
    )


def test_checks(spark, dirty):
    report = quality.quality_report(
        quality.union_checks(
            [
                quality.check_row_count(dirty, minimum=4),
                quality.check_missing_values(dirty, required=["name", "v", "ghost"]),
                quality.check_duplicates(dirty, keys=["id", "name"]),
                quality.check_range(dirty, column="v", low=0, high=10),
            ]
        ),
        source="s",
    ).first()
    assert (report["checks_passed"], report["checks_failed"], report["overall_status"]) == (1, 3, "FAILED")
    assert {c["name"]: c["nulls"] for c in report["failed_checks"]} == {
        "missing_values": 7, "duplicates": 2, "anomalies_v": 2
    }
    assert [c["error"] for c in report["failed_checks"] if c["name"] == "duplicates"] == ["Found 2 duplicate records"]


def test_empty_input(spark, dirty):
    empty = dirty.filter("false")
    assert quality.check_row_count(empty, minimum=1).first()["error_message"] == "Expected min 1 rows, got 0"
    assert quality.check_duplicates(empty, keys=["id"]).first()["passed"]
    assert [r["issue"] for r in quality.schema_errors(empty, {"id": {"type": "integer"}}).collect()] == ["Data is empty"]
    assert quality.range_violations(empty, rules={"v": {"min": 0}}, row_key=["id"]).count() == 0


def test_schema_and_ranges(spark, dirty):
    errors = quality.schema_errors(
        dirty, {"id": {"type": "integer"}, "name": {"type": "date"}, "v": {"nullable": True}, "gone": {"nullable": True}}
    )
    assert {(r["column_name"], r["issue"], r["violations"]) for r in errors.collect()} == {
        ("name", "Non-nullable column is null", 2), ("name", "Not a date", 2), ("gone", "Missing required column", 1)
    }
    found = quality.range_violations(dirty, rules={"v": {"min": 0, "max": 10}, "ghost": {"min": 1}}, row_key=["id"])
    assert {(r["id"], r["value"], r["issue"]) for r in found.collect()} == {
        (2, 50.0, "above_maximum"), (2, -1.0, "below_minimum")
    }


def test_freshness_and_backfill(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 2)), ("b", datetime(2024, 1, 1))], "source string, ts timestamp")
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "source string")
    as_of = F.lit("2024-01-02 12:00:00").cast("timestamp")
    fresh = quality.check_freshness(df, source="source", timestamp="ts", as_of=as_of, expected=expected)
    assert {r["source"]: r["is_fresh"] for r in fresh.collect()} == {"a": True, "b": False, "c": False}
    days = spark.createDataFrame([("k", date(2024, 1, 1)), ("k", date(2024, 1, 3))], "k string, d date")
    start, end = (F.lit(d).cast("date") for d in ("2024-01-01", "2024-01-04"))
    gaps = quality.missing_dates(days, keys=["k"], date="d", start=start, end=end)
    assert sorted(r["date"].day for r in gaps.collect()) == [2, 4]


def test_observed_report(spark, dirty):
    seen, observation = reports.observed(dirty, "in", missing=F.count_if(F.col("v").isNull()))
    seen.write.format("noop").mode("overwrite").save()
    report = reports.observed_report([("load", observation)])
    assert report == {"operations_count": 1, "operations": [{"operation": "load", "rows": 4, "missing": 1}]}
