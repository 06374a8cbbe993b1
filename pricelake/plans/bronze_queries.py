"""Registered landing and payload queries; payload texts are built from the given tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from pricelake import reference_values as ref
from pricelake.functions.scalars import price_text, safe_number
from pricelake.plans.registry import WITH_PRICES, register, sql_stable, stabled
from pricelake.session import scratch_path, spread
from pricelake.sources import landing, payloads, web_tables
from pricelake.sources.canonical import prices, table

BATCH_TIME = datetime(2024, 2, 1, 6, 30, 15, 250000, tzinfo=timezone.utc)

# ---------------------------------------------------------------- landing

ORDER_LANDED = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
STAGED_SQL = """select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  '2024-02-01T06:30:15.250000+00:00' as _staging_timestamp, 'orders' as _source,
  'orders_1706769015.25' as _staging_id from orders"""
STAGED_SCHEMA = ORDER_LANDED + ", _staging_timestamp string, _source string, _staging_id string"


def landed_orders(spark, sf_dir, file_format: str):
    base = scratch_path(spark, "bronze")
    rows = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    landing.save_results(
        spark, rows, base, source="orders", file_format=file_format, extraction_time=BATCH_TIME
    )
    found = landing.scan_landed(spark, base, STAGED_SCHEMA, source="orders", file_format=file_format)
    return found.drop("_file", "_file_size", "_file_time")


@register("b1_json_landing", STAGED_SQL)
def b1_json_landing(spark, sf_dir):
    return landed_orders(spark, sf_dir, "json")


@register("b2_csv_landing", STAGED_SQL)
def b2_csv_landing(spark, sf_dir):
    return landed_orders(spark, sf_dir, "csv")


@register("b2_parquet_landing", STAGED_SQL)
def b2_parquet_landing(spark, sf_dir):
    return landed_orders(spark, sf_dir, "parquet")


@register(
    "b3_raw_scan",
    "select 'orders_20240201_063015.json' as batch, count(*) as row_count, sum(o_custkey)::bigint as customers from orders",
)
def b3_raw_scan(spark, sf_dir):
    base = scratch_path(spark, "bronze")
    landing.save_results(
        spark, table(spark, sf_dir, "orders").select(*ORDER_COLUMNS), base, source="orders", extraction_time=BATCH_TIME
    )
    rows = landing.scan_landed(spark, base, STAGED_SCHEMA)
    return rows.groupBy(F.regexp_extract("_file", "([^/]+)/[^/]+$", 1).alias("batch")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_custkey").alias("customers")
    )


@register("b4_staging_metadata", STAGED_SQL.replace("'orders' as _source", "o_orderpriority as _source")
          .replace("o_totalprice,", "o_totalprice, ", 1))
def b4_staging_metadata(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS, F.col("o_orderpriority").alias("_source"))
    return landing.add_staging_metadata(rows, source="orders", extraction_time=BATCH_TIME)


@register(
    "b5_staging_status",
    """select 'events' as source, 'active' as status, 'events_20240202_063015.json' as latest_file,
         cast(2 as bigint) as file_count, count(*) filter (event_type <> 'error') as latest_row_count from events
       union all select 'orders', 'active', 'orders_20240201_063015.json', 1, count(*) from orders
       union all select 'quotes', 'no_data', null, null, null""",
)
def b5_staging_status(spark, sf_dir):
    base = scratch_path(spark, "bronze")
    orders = landing.add_staging_metadata(table(spark, sf_dir, "orders"), source="orders", extraction_time=BATCH_TIME)
    landing.land(orders, base, source="orders", extraction_time=BATCH_TIME)
    events = table(spark, sf_dir, "events")
    for moment, rows in (
        (BATCH_TIME, events.filter("event_type = 'error'")),
        (BATCH_TIME.replace(day=2), events.filter("event_type <> 'error'")),
    ):
        staged = landing.add_staging_metadata(rows, source="events", extraction_time=moment)
        landing.land(staged, base, source="events", extraction_time=moment)
    status = landing.staging_status(spark, base, ["orders", "events", "quotes"])
    return status.select(
        "source", "status", F.regexp_extract("latest_file", "[^/]+$", 0).alias("latest_file"),
        "file_count", "latest_row_count",
    ).withColumn("latest_file", F.nullif("latest_file", F.lit("")))


def two_sources(spark, sf_dir):
    return landing.union_sources(
        {
            "orders": table(spark, sf_dir, "orders").select(
                "o_orderkey", F.when(F.col("o_orderstatus") == "P", "price_unavailable").otherwise("ok").alias("note")
            ),
            "events": table(spark, sf_dir, "events").select("event_id", F.lit("ok").alias("note")),
        }
    )


@register(
    "b6_union_sources",
    """select 'orders' as _source, o_orderkey, cast(null as bigint) as event_id,
         case when o_orderstatus = 'P' then 'price_unavailable' else 'ok' end as note from orders
       union all select 'events', null, event_id, 'ok' from events""",
)
def b6_union_sources(spark, sf_dir):
    return two_sources(spark, sf_dir)


@register(
    "b6_source_counts",
    """select 'orders' as _source, count(*) as record_count, count(*) filter (o_orderstatus <> 'P') as ok_count from orders
       union all select 'events', count(*), count(*) from events""",
)
def b6_source_counts(spark, sf_dir):
    return landing.source_counts(two_sources(spark, sf_dir))


@register(
    "b7_batch_results",
    """select 'success' as status, 'orders' as source, count(*) as record_count, 'local' as storage_type,
         'bronze/orders' as staged_path from orders
       union all select 'success', 'events', count(*), 'local', null from events
       union all select 'no_data', 'quotes', 0, 'local', null""",
)
def b7_batch_results(spark, sf_dir):
    return landing.batch_results(
        spark, two_sources(spark, sf_dir), ["orders", "events", "quotes"],
        staged_paths={"orders": "bronze/orders", "quotes": "bronze/quotes"},
    )


@register(
    "b6_consolidation",
    """select 'staged' as status, (select count(*) from orders) + (select count(*) from events) as total_record_count,
       cast(1 as bigint) as active_staged_sources, cast(3 as bigint) as source_count""",
)
def b6_consolidation(spark, sf_dir):
    base = scratch_path(spark, "bronze")
    orders = landing.add_staging_metadata(table(spark, sf_dir, "orders"), source="orders", extraction_time=BATCH_TIME)
    landing.land(orders, base, source="orders", extraction_time=BATCH_TIME)
    names = ["orders", "events", "quotes"]
    results = landing.batch_results(spark, two_sources(spark, sf_dir), names)
    return landing.consolidation_summary(landing.consolidate(results, landing.staging_status(spark, base, names)))


SILVER_COLUMNS = ["order_id", "part_id", "supplier_id", "line_no", "date", "source", "close_price", "volume"]


def silver(spark, sf_dir):
    path = scratch_path(spark, "silver")
    rows = prices(spark, sf_dir).select(*SILVER_COLUMNS)
    landing.write_silver(rows.withColumn("date_key", F.date_format("date", "yyyyMM").cast("int") * 100 + 1), path)
    return landing.scan_silver(spark, path)


@register(
    "b8_silver_roundtrip",
    WITH_PRICES + f"""select {", ".join(SILVER_COLUMNS)},
      cast(strftime(date, '%Y%m01') as int) as date_key from prices""",
)
def b8_silver_roundtrip(spark, sf_dir):
    return silver(spark, sf_dir)


@register(
    "b9_backfill_range",
    WITH_PRICES + f"""select {", ".join(SILVER_COLUMNS)}, cast(strftime(date, '%Y%m01') as int) as date_key
      from prices where date between date '1997-02-01' and date '1997-02-28' and source in ('A', 'R')""",
)
def b9_backfill_range(spark, sf_dir):
    start, end = landing.month_range(1997, 2)
    return landing.backfill_range(silver(spark, sf_dir), start, end, sources=["A", "R"])


# ---------------------------------------------------------------- exchange rates

PROVIDER_SQL = "case o_orderkey % 5 when 0 then 'NBU' when 1 then 'PrivatBank' when 2 then 'ExchangeRateAPI' when 3 then 'Other' else 'NBU' end"


def fx_payloads(spark, sf_dir):
    """One payload per order: three list items or a rate map, some empty, some missing."""
    orders = table(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 5
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "dd.MM.yyyy")
    nbu = F.to_json(
        F.array(
            F.struct(status.alias("cc"), price.alias("rate"), day.alias("exchangedate")),
            F.struct(F.lit("EUR").alias("cc"), F.lit(None).cast("double").alias("rate"), day.alias("exchangedate")),
            F.struct(F.lit(None).cast("string").alias("cc"), price.alias("rate"), day.alias("exchangedate")),
        )
    )
    privat = F.to_json(
        F.array(
            F.struct(
                status.alias("ccy"), F.lit("UAH").alias("base_ccy"),
                price.cast("string").alias("buy"), (price * 2).cast("string").alias("sale"),
            ),
            F.struct(
                F.lit("EUR").alias("ccy"), F.lit("UAH").alias("base_ccy"),
                F.lit("n/a").alias("buy"), price.cast("string").alias("sale"),
            ),
            F.struct(
                F.lit("").alias("ccy"), F.lit("UAH").alias("base_ccy"),
                price.cast("string").alias("buy"), price.cast("string").alias("sale"),
            ),
        )
    )
    rate_map = F.to_json(
        F.struct(
            F.when(status != "F", "EUR").alias("base"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            F.create_map(
                F.lit("UAH"), price.cast("string"), F.lit("GBP"), F.lit("1d"), F.lit("PLN"), F.lit(" 4.5 ")
            ).alias("rates"),
        )
    )
    body = (
        F.when(kind == 4, F.lit(None))
        .when(F.col("o_orderkey") % 7 == 0, "[]")
        .when(kind == 0, nbu).when(kind == 1, privat).otherwise(rate_map)
    )
    provider = (
        F.when(kind == 1, "PrivatBank").when(kind == 2, "ExchangeRateAPI").when(kind == 3, "Other").otherwise("NBU")
    )
    return orders.select(
        provider.alias("provider"), F.col("o_orderkey").cast("string").alias("source_endpoint"),
        body.alias("payload"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("extracted_at"),
    )


def fx_sql(kind: int, base: str, quote: str, rate: str, buy: str, sell: str, label: str, stamp: str, where: str) -> str:
    return f"""select {PROVIDER_SQL} as provider, cast(o_orderkey as varchar) as source_endpoint,
      {base} as base_currency, {quote} as quote_currency, cast({rate} as double) as rate,
      cast({buy} as double) as buy_rate, cast({sell} as double) as sell_rate, '{label}' as rate_type,
      {stamp} as source_timestamp, 'ok' as note, strftime(o_orderdate, '%Y-%m-%d') as extracted_at
      from orders where o_orderkey % 7 <> 0 and o_orderkey % 5 = {kind} and {where}"""


NBU_SQL = fx_sql(0, "o_orderstatus", "'UAH'", "o_totalprice", "null", "null", "official",
                 "strftime(o_orderdate, '%d.%m.%Y')", "true")
PRIVAT_SQL = (
    fx_sql(1, "o_orderstatus", "'UAH'", "(o_totalprice + o_totalprice * 2) / 2", "o_totalprice", "o_totalprice * 2",
           "cash_market", "cast(null as varchar)", "true")
    + " union all "
    + fx_sql(1, "'EUR'", "'UAH'", "null", "null", "o_totalprice", "cash_market", "cast(null as varchar)", "true")
)
MAP_BASE = "case when o_orderstatus <> 'F' then 'EUR' else 'USD' end"
MAP_SQL = (
    fx_sql(2, MAP_BASE, "'UAH'", "o_totalprice", "null", "null", "daily_reference",
           "strftime(o_orderdate, '%Y-%m-%d')", "true")
    + " union all "
    + fx_sql(2, MAP_BASE, "'PLN'", "4.5", "null", "null", "daily_reference",
             "strftime(o_orderdate, '%Y-%m-%d')", "true")
)


@register("n1_official_rates", NBU_SQL)
def n1_official_rates(spark, sf_dir):
    return payloads.fx_rates_of(fx_payloads(spark, sf_dir), "NBU")


@register("n2_cash_rates", PRIVAT_SQL)
def n2_cash_rates(spark, sf_dir):
    return payloads.fx_rates_of(fx_payloads(spark, sf_dir), "PrivatBank")


@register("n3_rate_map", MAP_SQL)
def n3_rate_map(spark, sf_dir):
    return payloads.fx_rates_of(fx_payloads(spark, sf_dir), "ExchangeRateAPI")


@register(
    "n4_all_providers",
    f"""{NBU_SQL} union all {PRIVAT_SQL} union all {MAP_SQL}
    union all select {PROVIDER_SQL}, cast(o_orderkey as varchar), null, null, null, null, null, null, null,
      case when o_orderkey % 5 = 4 then 'provider_unavailable' when o_orderkey % 5 = 3 then 'unsupported_provider'
        else 'no_rows_after_normalization' end, strftime(o_orderdate, '%Y-%m-%d')
    from orders where o_orderkey % 5 in (3, 4) or o_orderkey % 7 = 0""",
)
def n4_all_providers(spark, sf_dir):
    return payloads.fx_rates(fx_payloads(spark, sf_dir))


# ---------------------------------------------------------------- futures

TICKERS = [i[1] for i in ref.INSTRUMENTS]
QUOTES_SQL = f"""quotes as (
  select strftime(l_shipdate, '%Y-%m-%d') as extracted_at,
    coalesce([{", ".join(f"'{t}'" for t in TICKERS)}][cast(l_partkey % 11 as int) + 1], 'NONE') as ticker,
    max(l_extendedprice) as raw_price
  from lineitem group by 1, 2)"""


def quotes(spark, sf_dir):
    """Best price per day and instrument; two of eleven part groups have no instrument."""
    names = F.array(*[F.lit(t) for t in TICKERS])
    ticker = F.coalesce(F.get(names, (F.col("l_partkey") % 11).cast("int")), F.lit("NONE"))
    return table(spark, sf_dir, "lineitem").groupBy(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("extracted_at"), ticker.alias("ticker")
    ).agg(F.max("l_extendedprice").alias("raw_price"))


INSTRUMENT_VALUES = ", ".join(
    "(" + ", ".join("null" if v is None else f"'{v}'" if isinstance(v, str) else repr(v) for v in row) + ")"
    for row in ref.INSTRUMENTS
)


@register(
    "n5_futures_prices",
    f"""with {QUOTES_SQL}, instruments as (select * from (values {INSTRUMENT_VALUES})
      t(name, ticker, unit, kg, scale, category, description))
    select name, i.ticker, category, unit, description, raw_price, raw_price / cast(scale as double) as price_in_dollars,
      {sql_stable("raw_price / cast(scale as double) * (1000.0 / cast(kg as double))", 6)} as usd_per_ton,
      case when raw_price is null then 'price_unavailable' else 'ok' end as note, d.extracted_at
    from (select distinct extracted_at from quotes) d cross join instruments i
    left join quotes q on q.extracted_at = d.extracted_at and q.ticker = i.ticker""",
)
def n5_futures_prices(spark, sf_dir):
    return stabled(payloads.futures_prices(quotes(spark, sf_dir)), "usd_per_ton", digits=6)


CLOSE_SQL = f"""with {QUOTES_SQL}, spiked as (
  select ticker, extracted_at as date, raw_price as close,
    avg(raw_price) over (w rows between 4 preceding and 1 preceding) as m, lag(raw_price) over w as p
  from quotes window w as (partition by ticker order by extracted_at)),
replaced as (
  select ticker, date, case when {{checked}} and abs(close - m) / nullif(m, 0) > 0.5 then p else close end as close
  from spiked)"""


def history(spark, sf_dir):
    return quotes(spark, sf_dir).select(
        "ticker", F.col("extracted_at").alias("date"), F.col("raw_price").alias("close")
    )


@register(
    "n6_latest_close",
    CLOSE_SQL.format(checked="ticker = 'ZR=F'") + "select ticker, max(date) as date, arg_max(close, date) as close from replaced group by ticker",
)
def n6_latest_close(spark, sf_dir):
    return payloads.latest_close(history(spark, sf_dir))


@register("n7_spike_replacement", CLOSE_SQL.format(checked="true") + "select ticker, date, close from replaced")
def n7_spike_replacement(spark, sf_dir):
    # one close per calendar day and ticker bounds the series
    return payloads.replace_spikes(history(spark, sf_dir), instruments=None, series_rows=150_000)


# ---------------------------------------------------------------- web pages


def offer_pages(spark, sf_dir):
    """One list page per order with a nine-cell, an eight-cell and a short row; some pages are empty."""
    key = F.col("o_orderkey").cast("string")
    thousands = F.floor(F.col("o_totalprice") / 1000).cast("string")
    price = F.concat(thousands, F.lit("\u00a0250,5 \u0433\u0440\u043d"))
    full = F.concat(
        F.lit("<tr><td><a href='/offer/"), key, F.lit("'>"), F.date_format("o_orderdate", "dd.MM.yyyy"),
        F.lit("</a></td><td> Firm <b>"), F.col("o_custkey").cast("string"), F.lit("</b></td><td>sell</td><td>"),
        F.col("o_orderpriority"), F.lit("</td><td>100</td><td>"), price,
        F.lit("</td><td>FCA</td><td>port &amp; rail</td><td>Odesa</td></tr>"),
    )
    short = F.concat(
        F.lit("<tr><td>today</td><td>Firm</td><td>buy</td><td>"), F.col("o_orderstatus"),
        F.lit("</td><td>5</td><td>ask</td><td>DAP</td><td>road</td></tr><tr><td>x</td><td>y</td></tr>"),
    )
    page = F.concat(
        F.lit("<html><table class='menu'><tr><td>m</td></tr></table><table class='list items'><tr><th>Date</th></tr>"),
        full, short, F.lit("</table></html>"),
    )
    html = (
        F.when(F.col("o_orderkey") % 10 == 3, F.lit(None))
        .when(F.col("o_orderkey") % 10 == 6, "<html><p>nothing</p></html>").otherwise(page)
    )
    # the columns are spread, not the pages made of them
    orders = spread(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    ))
    return orders.select(
        F.col("o_orderkey").cast("int").alias("page"), html.alias("html"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("extracted_at"),
    )


OFFERS_SQL = """
with o as (select *, cast(o_orderkey as int) as page, o_orderkey % 10 as k,
  'https://graintrade.com.ua/birzha?Ad_page=' || o_orderkey as source_url,
  strftime(o_orderdate, '%Y-%m-%d') as extracted_at from orders)
select source_url, page, strftime(o_orderdate, '%d.%m.%Y') as offer_date, 'Firm ' || o_custkey as company,
  'SELL' as offer_type, o_orderpriority as crop, '100' as volume_tons,
  cast(floor(o_totalprice / 1000) as bigint) || chr(160) || '250,5 грн' as price_raw,
  cast(cast(floor(o_totalprice / 1000) as bigint) || '250.5' as double) as price_value, 'грн' as currency,
  'FCA' as delivery_term, 'port & rail' as basis, 'Odesa' as location,
  'https://graintrade.com.ua/offer/' || o_orderkey as detail_url, 'ok' as note, extracted_at,
  {details} as details
from o where k not in (3, 6)
union all select source_url, page, 'today', 'Firm', 'BUY', o_orderstatus, '5', 'ask', null, null, 'DAP', 'road',
  null, null, 'ok', extracted_at, '' from o where k not in (3, 6)
union all select source_url, page, null, null, null, null, null, null, null, null, null, null, null, null,
  case k when 3 then 'page_unavailable' else 'page_without_offers' end, extracted_at, null from o where k in (3, 6)"""


@register("n8_offer_rows", OFFERS_SQL.replace("{details}", "''"))
def n8_offer_rows(spark, sf_dir):
    return web_tables.offer_rows(offer_pages(spark, sf_dir))


@register(
    "n10_offer_details",
    OFFERS_SQL.replace("{details}", "case when o_orderstatus = 'F' then 'First Second line' else '' end"),
)
def n10_offer_details(spark, sf_dir):
    pages = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(
        F.concat(F.lit(ref.OFFER_SITE + "/offer/"), F.col("o_orderkey").cast("string")).alias("detail_url"),
        F.lit(
            "<p>no</p><div class='addInfoTextView'><p>First</p><p> </p><div><p>Second <i>line</i></p></div></div><p>no</p>"
        ).alias("html"),
    )
    return web_tables.offer_rows(offer_pages(spark, sf_dir), web_tables.detail_texts(pages))


@register(
    "n8_landed_pages",
    """select 'https://graintrade.com.ua/birzha?Ad_page=' || page_id as source_url, cast(page_id as int) as page,
       'page_without_offers' as note, url as extracted_at from pages""",
)
def n8_landed_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("page"), "html", F.col("url").alias("extracted_at")
    )
    return web_tables.offer_rows(spread(rows)).select("source_url", "page", "note", "extracted_at")


@register(
    "n9_price_text",
    """select o_orderkey, case when o_orderkey % 3 < 2
         then cast(cast(floor(o_totalprice / 1000) as bigint) || '250.5' as double) end as price_value,
       case o_orderkey % 3 when 0 then 'грн/т' when 1 then 'USD' end as currency from orders""",
)
def n9_price_text(spark, sf_dir):
    kind, thousands = F.col("o_orderkey") % 3, F.floor(F.col("o_totalprice") / 1000).cast("string")
    raw = (
        F.when(kind == 0, F.concat(F.lit("\u0432\u0456\u0434 "), thousands, F.lit(" 250,5 \u0433\u0440\u043d/\u0442 ")))
        .when(kind == 1, F.concat(thousands, F.lit("\u00a0250.5 USD")))
        .otherwise("negotiable")
    )
    value, currency = price_text(raw)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", value.alias("price_value"), currency.alias("currency")
    )


CROP_CELLS = ["\u041a\u0443\u043a\u0443\u0440\u0443\u0434\u0437\u0430", "\u0421\u043e\u044f", "\u041d\u043e\u0432\u0438\u043d\u043a\u0430"]


def company_pages(spark, sf_dir):
    """One page per customer with a port and an unknown table; slugs cycle over some companies."""
    slugs = list(ref.COMPANIES)[:10]
    slug = F.get(F.array(*[F.lit(s) for s in slugs]), (F.col("c_custkey") % 10).cast("int"))
    amount = F.col("c_acctbal")
    matrix = F.concat(
        F.lit("<tr><th>"), F.lit(ref.STORAGE_TYPES[0]), F.lit("</th><th>Region</th><th>"),
        F.lit("</th><th>".join(CROP_CELLS)), F.lit("</th></tr><tr><td><b>Port "), F.col("c_nationkey").cast("string"),
        F.lit("</b><p>South</p></td><td>"), F.floor(amount).cast("string"), F.lit(" 000,5</td><td>-</td><td> 7,25 </td></tr>"),
        F.lit("<tr><td>bare</td><td></td><td>abc</td></tr><tr><td>one</td></tr>"),
    )
    page = F.concat(F.lit("<table>"), matrix, F.lit("</table><table><tr><th>Other</th><th>a</th></tr><tr><td>b</td><td>1</td></tr></table>"))
    customers = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_name"))
    return customers.select(
        slug.alias("company_slug"), F.col("c_name").alias("company_name"), page.alias("html"),
        F.col("c_custkey").cast("string").alias("extracted_at"),
    )


SLUG_SQL = f"[{', '.join(repr(s) for s in list(ref.COMPANIES)[:10])}][cast(c_custkey % 10 as int) + 1]"
MATRIX_SQL = f"""
with c as (select *, {SLUG_SQL} as company_slug, 'https://tripoli.land/ua/companies/' || {SLUG_SQL} as source_url,
  cast(floor(c_acctbal) as bigint) || '000' as whole from customer)
select company_slug, c_name as company_name, 'Порт' as storage_type, 'Port ' || c_nationkey as storage_location,
  'South' as address_region, 'Кукурудза' as culture_ua, 'Corn' as category_name, whole || ',5' as price,
  cast(whole || '.5' as double) as price_uah_per_ton, source_url, 'ok' as note, cast(c_custkey as varchar) as extracted_at
from c
union all select company_slug, c_name, 'Порт', 'Port ' || c_nationkey, 'South', 'Новинка', 'Новинка', '7,25', 7.25,
  source_url, 'ok', cast(c_custkey as varchar) from c
union all select company_slug, c_name, 'Порт', '', '', 'Соя', 'Soybeans', 'abc', null,
  source_url, 'ok', cast(c_custkey as varchar) from c"""


@register("n11_price_matrix", MATRIX_SQL)
def n11_price_matrix(spark, sf_dir):
    return web_tables.elevator_rows(company_pages(spark, sf_dir))


@register(
    "n12_crop_names",
    """select c_custkey, case c_custkey % 3 when 0 then 'Corn' when 1 then 'Soybeans' else c_mktsegment end as category_name
       from customer""",
)
def n12_crop_names(spark, sf_dir):
    kind = F.col("c_custkey") % 3
    local = F.when(kind == 0, CROP_CELLS[0]).when(kind == 1, CROP_CELLS[1]).otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", web_tables.crop_name(local).alias("category_name"))


@register(
    "n13_expected_companies",
    f"""select company_slug, note, count(*) as row_count from ({MATRIX_SQL}) t group by 1, 2
    union all select unnest([{', '.join(repr(s) for s in list(ref.COMPANIES)[10:])}]), 'company_unavailable_or_empty', 1""",
)
def n13_expected_companies(spark, sf_dir):
    rows = web_tables.with_expected(
        web_tables.elevator_rows(company_pages(spark, sf_dir)), web_tables.expected_companies(spark),
        keys=["company_slug"], note=ref.NOTE_COMPANY_EMPTY,
    )
    return rows.groupBy("company_slug", "note").agg(F.count(F.lit(1)).alias("row_count"))


@register(
    "n14_safe_number",
    """select o_orderkey, case o_orderkey % 4 when 0 then o_totalprice when 3 then -1500.0 end as number from orders""",
)
def n14_safe_number(spark, sf_dir):
    kind, price = F.col("o_orderkey") % 4, F.col("o_totalprice")
    text = (
        F.when(kind == 0, F.concat(F.lit(" "), price.cast("string"), F.lit("\u00a0")))
        .when(kind == 1, F.concat(price.cast("string"), F.lit("d"))).when(kind == 2, "12 500").otherwise("-1.5e3")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", safe_number(text).alias("number"))
