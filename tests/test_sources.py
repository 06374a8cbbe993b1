"""Payloads, quotes, web pages and the landing zone."""

from __future__ import annotations

import json
import tracemalloc
from datetime import date, datetime, timezone

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelake import reference_values as ref
from pricelake.functions.scalars import price_text, safe_number
from pricelake.operators import oplog
from pricelake.sources import landing, payloads, web_tables

AT = datetime(2026, 4, 7, 7, 51, 20, 901077, tzinfo=timezone.utc)


def test_golden_quotes(spark):
    quotes = [("ZW=F", 590.5), ("ZC=F", 452.75), ("ZS=F", 1168.75), ("ZO=F", 346.0), ("ZR=F", 1108.0), ("WEAT", 22.85)]
    df = spark.createDataFrame([("t", k, v) for k, v in quotes], "extracted_at string, ticker string, raw_price double")
    got = {r["ticker"]: r for r in payloads.futures_prices(df).collect()}
    assert len(got) == 9
    wanted = {
        "ZW=F": (5.905, 216.9719461336371), "ZC=F": (4.5275, 178.23961072705225),
        "ZS=F": (11.6875, 429.44278076831216), "ZO=F": (3.46, 238.37409576300377),
        "ZR=F": (11.08, 244.27218650084436), "WEAT": (22.85, None),
    }
    for ticker, (dollars, per_ton) in wanted.items():
        assert got[ticker]["price_in_dollars"] == dollars
        assert got[ticker]["usd_per_ton"] == (None if per_ton is None else pytest.approx(per_ton, rel=1e-15))
    assert got["DBA"]["note"] == "price_unavailable" and got["DBA"]["price_in_dollars"] is None


def test_latest_close_and_spikes(spark):
    closes = {"ZR=F": [10, 10, 11, 10, 30], "ZW=F": [10, 10, 11, 10, 30], "X": [7]}
    rows = [(t, i, float(c)) for t, cs in closes.items() for i, c in enumerate(cs)]
    df = spark.createDataFrame(rows, "ticker string, date int, close double")
    assert {r["ticker"]: r["close"] for r in payloads.latest_close(df).collect()} == {"ZR=F": 10.0, "ZW=F": 30.0, "X": 7.0}
    fixed = payloads.replace_spikes(df, series_rows=5)
    assert {r["ticker"]: r["close"] for r in fixed.filter("date = 4").collect()} == {"ZR=F": 10.0, "ZW=F": 30.0}


def fx(spark, *rows):
    df = spark.createDataFrame([(p, "e", body, "t") for p, body in rows], "provider string, source_endpoint string, payload string, extracted_at string")
    return payloads.fx_rates(df).collect()


def test_official_list(spark):
    body = json.dumps([{"cc": "EUR", "rate": 41.5, "exchangedate": "07.04.2026"}, {"cc": "USD"}, {"rate": 1}, 5, "x", None])
    rows = fx(spark, ("NBU", body))
    assert [(r["base_currency"], r["quote_currency"], r["rate"], r["rate_type"], r["source_timestamp"], r["note"]) for r in rows] == [
        ("EUR", "UAH", 41.5, "official", "07.04.2026", "ok")
    ]


def test_cash_list(spark):
    body = json.dumps(
        [{"ccy": "USD", "base_ccy": "UAH", "buy": "40.0", "sale": "42.0"}, {"ccy": "EUR", "base_ccy": "UAH", "buy": "x", "sale": "45"},
         {"ccy": "", "base_ccy": "UAH", "buy": "1", "sale": "1"}, {"ccy": "GBP", "base_ccy": "UAH"}]
    )
    rows = fx(spark, ("PrivatBank", body))
    assert [(r["base_currency"], r["rate"], r["buy_rate"], r["sell_rate"]) for r in rows] == [
        ("USD", 41.0, 40.0, 42.0), ("EUR", None, None, 45.0)
    ]


def test_rate_map_and_placeholders(spark):
    rows = fx(
        spark, ("ExchangeRateAPI", json.dumps({"date": "2026-04-07", "rates": {"UAH": 41.2, "BAD": "n/a"}})),
        ("ExchangeRateAPI", json.dumps({"rates": [1]})), ("NBU", None), ("NBU", '{"cc": "EUR", "rate": 1}'),
        ("NBU", "not json"), ("Other", "[]"), ("PrivatBank", "[]"),
    )
    assert [(r["base_currency"], r["quote_currency"], r["rate"]) for r in rows if r["note"] == "ok"] == [("USD", "UAH", 41.2)]
    assert [r["note"] for r in rows[1:]] == [
        "no_rows_after_normalization", "provider_unavailable", "no_rows_after_normalization",
        "no_rows_after_normalization", "unsupported_provider", "no_rows_after_normalization",
    ]


def test_numbers_and_price_text(spark):
    texts = ["1", " 1.5 ", "-2e3", "1d", "1f", "", "abc", None, ".5", "5.", "0x1", "1,5", " 7 "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = [r["v"] for r in df.select("i", safe_number(F.col("t")).alias("v")).orderBy("i").collect()]
    assert out == [1.0, 1.5, -2000.0, None, None, None, None, None, 0.5, 5.0, None, None, 7.0]
    raws = ["10 250,5 грн", "1,234.50", "", "10 250 USD/т ", "від 99 грн", "free", None, "10 250 грн", "12."]
    value, currency = price_text(F.col("t"))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(raws)], "i int, t string")
    got = [(r["v"], r["c"]) for r in df.select("i", value.alias("v"), currency.alias("c")).orderBy("i").collect()]
    assert got == [
        (10250.5, "грн"), (None, None), (None, None), (10250.0, "USD/т"), (99.0, "грн"), (None, None), (None, None),
        (None, "грн"), (12.0, None),
    ]


OFFERS = """
<!-- <table class="items"><tr><td>no</td></tr></table> --><script>var t = "<table>";</script>
<table class="grid items"><thead><tr><th>Date</th></tr></thead><tbody>
<tr><td><a href="/o/1">07.04<br>2026</a></td><td>A &amp; B <b>Ltd</b></td><td>sell</td><td>Corn</td><td>100</td>
<td>10&nbsp;250,5 грн</td><td>FCA</td><td>EXW</td><td>Odesa</td></tr>
<tr><td><a href="http://x/2">d</a></td><td>c</td><td>buy</td><td>w</td><td>1</td><td>ask</td><td>t</td><td>b</td></tr>
<tr><td>short</td></tr></tbody></table>
<table class="items"><tr><td>second</td></tr></table>
"""


def test_offers(spark):
    pages = spark.createDataFrame(
        [(1, OFFERS, "t"), (2, "", "t"), (3, None, "t"), (4, "<p>none</p>", "t")], "page int, html string, extracted_at string"
    )
    details = web_tables.detail_texts(
        spark.createDataFrame(
            [(ref.OFFER_SITE + "/o/1", '<div class="x addInfoTextView"><p>One</p><p></p><p>two <b>three</b></p></div><p>out</p>')],
            "detail_url string, html string",
        )
    )
    rows = web_tables.offer_rows(pages, details).orderBy("page", "offer_date").collect()
    assert [r["note"] for r in rows] == ["ok", "ok", "page_unavailable", "page_unavailable", "page_without_offers"]
    a, b = rows[0], rows[1]
    assert (a["offer_date"], a["company"], a["offer_type"], a["location"]) == ("07.04 2026", "A & B Ltd", "SELL", "Odesa")
    assert (a["price_value"], a["currency"], a["details"]) == (10250.5, "грн", "One two three")
    assert (b["detail_url"], b["location"], b["price_value"], b["details"]) == ("http://x/2", None, None, "")
    assert rows[2]["details"] is None and rows[2]["source_url"].endswith("Ad_page=2")


MATRIX = """
<table><tr><th>Порт</th><th>Регіон</th><th>Кукурудза</th><th>Новинка</th></tr>
<tr><td><b>Odesa</b><p>South</p></td><td>10 250,5</td><td>-</td></tr>
<tr><td>plain</td><td></td><td>abc</td><td>1</td></tr><tr><td>one</td></tr></table>
<table><tr><th>Елеватор</th><td>x</td><td>Соя</td></tr><tr><td><b>E</b></td><td>7</td><td>8</td></tr></table>
<table><tr><th>Інше</th><th>a</th></tr><tr><td>b</td><td>1</td></tr></table><table></table>
"""


def test_price_matrix(spark):
    pages = spark.createDataFrame([("kernel", "Кернел", MATRIX, "t")], "company_slug string, company_name string, html string, extracted_at string")
    cells = lambda df: [
        (r["storage_type"], r["storage_location"], r["address_region"], r["culture_ua"], r["category_name"], r["price"], r["price_uah_per_ton"])
        for r in df.collect()
    ]
    assert cells(web_tables.elevator_rows(pages)) == [
        ("Порт", "Odesa", "South", "Кукурудза", "Corn", "10250,5", 10250.5),
        ("Порт", "", "", "Новинка", "Новинка", "abc", None),
        ("Елеватор", "E", "", "Соя", "Soybeans", "7", 7.0),
    ]
    aligned = cells(web_tables.elevator_rows(pages, header_offset=0))
    assert ("Порт", "Odesa", "South", "Регіон", "Регіон", "10250,5", 10250.5) in aligned
    full = web_tables.with_expected(
        web_tables.elevator_rows(pages), web_tables.expected_companies(spark), keys=["company_slug"], note=ref.NOTE_COMPANY_EMPTY
    )
    assert full.filter(F.col("note") == ref.NOTE_COMPANY_EMPTY).count() == 23


def test_table_cells(spark):
    pages = spark.createDataFrame([(1, MATRIX)], "id int, html string")
    cells = web_tables.table_cells(pages, key="id")
    assert cells.filter("table_no = 0 and row_no = 1").orderBy("col_no").select("text").collect()[0]["text"] == "Odesa South"
    assert cells.filter("tag = 'th'").count() == 7


def test_staging_columns(spark):
    df = spark.createDataFrame([(1, "mine")], "id int, _source string")
    row = landing.add_staging_metadata(df, source="yfinance", extraction_time=AT).first()
    assert row["_staging_timestamp"] == "2026-04-07T07:51:20.901077+00:00"
    assert row["_staging_id"] == "yfinance_1775548280.901077"
    assert row["_source"] == "mine"


def test_save_results_inputs(spark, tmp_path):
    base = str(tmp_path)
    assert landing.save_results(spark, [], base, source="s") is None
    assert landing.save_results(spark, pd.DataFrame(), base, source="s") is None
    assert landing.save_results(spark, spark.range(0), base, source="s") is None
    landing.save_results(spark, [{"id": 1}], base, source="list", extraction_time=AT)
    landing.save_results(spark, pd.DataFrame({"id": [1, 2]}), base, source="frame", extraction_time=AT, file_format="parquet")
    assert landing.scan_landed(spark, base, "id long, _source string", source="list").first()["_source"] == "list"
    assert landing.scan_landed(spark, base, "id long", source="frame", file_format="parquet").count() == 2
    with pytest.raises(TypeError):
        landing.save_results(spark, 5, base, source="s")
    with pytest.raises(ValueError):
        landing.save_results(spark, [{"id": 1}], base, source="s", file_format="xml")


def test_scan_json_array_files(spark, tmp_path):
    folder = tmp_path / "yfinance"
    folder.mkdir()
    (folder / "yfinance_20260407_075120.json").write_text(json.dumps([{"ticker": "ZW=F", "raw_price": 590.5}, {"ticker": "DBA"}], indent=2))
    rows = landing.scan_landed(spark, str(tmp_path), "ticker string, raw_price double", multi_line=True).collect()
    assert sorted((r["ticker"], r["raw_price"]) for r in rows) == [("DBA", None), ("ZW=F", 590.5)]
    assert rows[0]["_file"].endswith("yfinance_20260407_075120.json")


def test_status_and_consolidation(spark, tmp_path):
    base = str(tmp_path)
    (tmp_path / "empty").mkdir()
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    staged = landing.add_staging_metadata(rows, source="fx", extraction_time=AT)
    landing.land(staged, base, source="fx", extraction_time=AT)
    landing.land(staged.limit(1), base, source="fx", extraction_time=AT.replace(day=8))
    names = ["fx", "empty", "none"]
    status = landing.staging_status(spark, base, names)
    got = {r["source"]: r for r in status.collect()}
    assert {k: v["status"] for k, v in got.items()} == {"fx": "active", "empty": "no_files", "none": "no_data"}
    assert (got["fx"]["file_count"], got["fx"]["latest_row_count"]) == (2, 1)
    results = landing.batch_results(spark, staged, names, storage_type="minio", staged_paths={"fx": "p"})
    first = {r["source"]: r.asDict() for r in results.collect()}
    assert first["fx"] == {"status": "success", "source": "fx", "record_count": 2, "storage_type": "minio", "staged_path": "p"}
    assert first["none"] == {"status": "no_data", "source": "none", "record_count": 0, "storage_type": "minio", "staged_path": None}
    total = landing.consolidation_summary(landing.consolidate(results, status)).first()
    assert (total["status"], total["active_staged_sources"], total["source_count"]) == ("staged", 1, 3)
    volumes = landing.file_volumes(landing.scan_landed(spark, base, "id int", source="fx"), name="fx")
    grown = oplog.volume_growth(volumes).first()
    assert grown["row_count"] == 3 and grown["total_bytes"] == grown["byte_count"] > 0
    nothing = landing.staging_status(spark, base, ["none"])
    assert nothing.first()["latest_file"] is None


def test_backfill_ranges(spark, tmp_path):
    assert landing.month_range(2024, 12) == (date(2024, 12, 1), date(2024, 12, 31))
    assert landing.month_range(2024, 2)[1] == date(2024, 2, 29)
    assert landing.last_days(7, date(2024, 3, 3)) == (date(2024, 2, 25), date(2024, 3, 3))
    df = spark.createDataFrame([(date(2024, 1, d), "a" if d % 2 else "b") for d in range(1, 11)], "date date, source string")
    path = landing.write_silver(df, str(tmp_path / "silver"))
    picked = landing.backfill_range(landing.scan_silver(spark, path), "2024-01-03", date(2024, 1, 6), sources=["a"])
    assert sorted(r["date_key"] for r in picked.collect()) == [20240103, 20240105]
    assert "PartitionFilters: [isnotnull(date_key" in picked._jdf.queryExecution().toString()


def test_tables_of_a_batch_are_not_held_as_objects_at_one_time():
    cells = "".join(f"<td>{i} <b>x</b></td>" for i in range(20))
    pages = pa.array([f"<table class='items'>{''.join(f'<tr>{cells}</tr>' for _ in range(3))}</table>"] * 4_000)
    tracemalloc.start()
    out = web_tables.tables_of.func(pages)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 4_000 and len(out[3_999][0]["cells"]) == 3
    assert peak < 40e6  # 240,000 cells as objects take more than 100 MB


def test_offers_without_a_link_are_spread_over_the_tasks_of_the_join(spark):
    row = "<tr>" + "".join(f"<td>{c}</td>" for c in "abcdefgh") + "</tr>"
    html = f"<table class='items'><tr><th>h</th></tr>{row}{row}</table>"
    pages = spark.range(400).select(F.col("id").cast("int").alias("page"), F.lit(html).alias("html"), F.lit("d").alias("extracted_at"))
    known = spark.createDataFrame([("/o/1", "one"), (None, "none")], "detail_url string, details string")
    options = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        joined = web_tables.offer_rows(pages, known)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 800 and len(sizes) > 1 and max(sizes) < 500
    assert {r["details"] for r in joined.collect()} == {""}
