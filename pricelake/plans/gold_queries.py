"""Registered warehouse queries: dimensions, history, fact load, refresh and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.operators import oplog, warehouse
from pricelake.plans.registry import ORDER_SQL, PRICES_SQL, WITH_PRICES, register
from pricelake.schemas import create_tables
from pricelake.session import scratch_path
from pricelake.plans import medallion
from pricelake.sources.canonical import PRICE_ORDER, TIE_BREAK, prices, table

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def old_customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0").select(*CUSTOMER)


SECOND = "c_custkey % 2 = 0"
#: Those and all that are not old: old and new customers together are the whole table.
REST = "(c_custkey % 2 = 0 or c_custkey % 3 = 0)"


def new_customers(spark, sf_dir, which=SECOND):
    """Every second customer (or the rest as well) twice; every fourth one with a changed segment."""
    rows = table(spark, sf_dir, "customer").filter(which).select(*CUSTOMER)
    changed = rows.withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 4 == 0, F.lit("CHANGED")).otherwise(F.col("c_mktsegment"))
    )
    return changed.unionByName(
        rows.withColumns({"c_acctbal": F.col("c_acctbal") - 1, "c_mktsegment": F.lit("STALE")})
    )


OLD_NEW_SQL = """with old as (select * from customer where c_custkey % 3 <> 0),
new as (select * replace (case when c_custkey % 4 = 0 then 'CHANGED' else c_mktsegment end as c_mktsegment)
  from customer where c_custkey % 2 = 0),
firsts as (select * replace (c_acctbal - 1 as c_acctbal, 'STALE' as c_mktsegment) from customer where c_custkey % 2 = 0)
"""
CUSTOMER_SQL = ", ".join(CUSTOMER)


@register(
    "w2_reference_load",
    """select r_name as market_name, 'region' as exchange from region
       union all select * from (values ('Chicago CBOT', 'CBOT'), ('ICE London', 'ICE'), ('Kyiv Exchange', 'ICEECX')) t""",
)
def w2_reference_load(spark, sf_dir):
    known = table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 10).alias("market_key"), F.col("r_name").alias("market_name"),
        F.lit("region").alias("exchange"),
    )
    seeds = warehouse.seed_dimensions(spark)["dim_market"].select("market_key", "market_name", "exchange")
    once = warehouse.insert_missing(known, seeds, ["market_name"], order_by=["market_key"])
    twice = warehouse.insert_missing(once, seeds, ["market_name"], order_by=["market_key"])
    return twice.select("market_name", "exchange")


@register(
    "w3_date_dimension",
    """select cast(strftime(d, '%Y%m%d') as int) as date_key, cast(d as date) as calendar_date,
      cast(year(d) as int) as year, cast(quarter(d) as int) as quarter, cast(month(d) as int) as month,
      cast(day(d) as int) as day, cast(weekofyear(d) as int) as week_of_year, dayname(d) as day_of_week,
      isodow(d) >= 6 as is_weekend, strftime(d, '%Y-%m-%d') in ('1996-01-01', '1996-07-04') as is_holiday,
      case when strftime(d, '%Y-%m-%d') in ('1996-01-01', '1996-07-04') then 'halted' else 'active' end as trading_status
    from (select unnest(generate_series(min(l_shipdate), max(l_shipdate), interval 1 day)) as d from lineitem) t""",
)
def w3_date_dimension(spark, sf_dir):
    days = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    return warehouse.date_dimension(
        spark, days.agg(F.min("d")).scalar(), days.agg(F.max("d")).scalar(), ["1996-01-01", "1996-07-04"]
    )


@register(
    "w4_insert_new",
    OLD_NEW_SQL + f"select {CUSTOMER_SQL} from old union all select {CUSTOMER_SQL} from firsts where c_custkey % 3 = 0",
)
def w4_insert_new(spark, sf_dir):
    return warehouse.insert_missing(
        old_customers(spark, sf_dir), new_customers(spark, sf_dir), ["c_custkey"], order_by=["c_acctbal"]
    )


@register(
    "w5_upsert",
    OLD_NEW_SQL + f"""select {CUSTOMER_SQL} from new
      union all select {CUSTOMER_SQL} from old where c_custkey not in (select c_custkey from new)""",
)
def w5_upsert(spark, sf_dir):
    return warehouse.upsert(
        old_customers(spark, sf_dir), new_customers(spark, sf_dir), ["c_custkey"], order_by=["c_acctbal"]
    )


TRACKED = ["c_name", "c_nationkey", "c_mktsegment"]


def history(spark, sf_dir):
    return old_customers(spark, sf_dir).withColumns(
        {
            "effective_date": F.lit("2024-01-01").cast("date"), "end_date": F.lit(None).cast("date"),
            "is_current": F.lit(True), "version": F.lit(1),
        }
    )


HISTORY_SQL = OLD_NEW_SQL + f""",
history as (
  select {CUSTOMER_SQL}, date '2024-01-01' as effective_date,
    case when c_custkey % 4 = 0 and c_mktsegment <> 'CHANGED' then date '2024-06-01' end as end_date,
    not (c_custkey % 4 = 0 and c_mktsegment <> 'CHANGED') as is_current, 1 as version from old
  union all
  select {CUSTOMER_SQL}, date '2024-06-01', null, true, case when c_custkey % 3 = 0 then 1 else 2 end
  from new where c_custkey % 4 = 0 or c_custkey % 3 = 0)"""


def merged_history(spark, sf_dir):
    return warehouse.scd2_merge(
        history(spark, sf_dir), new_customers(spark, sf_dir), ["c_custkey"], tracked=TRACKED,
        order_by=["c_acctbal"], effective=F.lit("2024-06-01").cast("date"),
    )


@register("w6_scd2_merge", HISTORY_SQL + "select * from history")
def w6_scd2_merge(spark, sf_dir):
    return merged_history(spark, sf_dir)


@register(
    "w6_scd2_point_in_time",
    HISTORY_SQL + """select * from history where effective_date <= date '2024-03-01'
      and (end_date is null or end_date > date '2024-03-01')""",
)
def w6_scd2_point_in_time(spark, sf_dir):
    return warehouse.point_in_time(merged_history(spark, sf_dir), F.lit("2024-03-01").cast("date"))


@register(
    "w7_load_statistics",
    OLD_NEW_SQL + """, actions as (
      select case when o.c_custkey is null then 'inserted' when n.c_custkey is null then 'kept'
        when o.c_mktsegment = n.c_mktsegment then 'unchanged' else 'updated' end as action
      from old o full join new n on o.c_custkey = n.c_custkey)
    select action, count(*) as row_count from actions group by action""",
)
def w7_load_statistics(spark, sf_dir):
    return warehouse.load_statistics(
        warehouse.scd2_classify(
            history(spark, sf_dir), new_customers(spark, sf_dir), ["c_custkey"], tracked=TRACKED,
            order_by=["c_acctbal"],
        )
    )


# The same operators over all customers: who is not old comes with the new ones.

ALL_SQL = OLD_NEW_SQL.replace(SECOND, REST)
ALL_HISTORY_SQL = HISTORY_SQL.replace(SECOND, REST)


def all_history(spark, sf_dir):
    return warehouse.scd2_merge(
        history(spark, sf_dir), new_customers(spark, sf_dir, REST), ["c_custkey"], tracked=TRACKED,
        order_by=["c_acctbal"], effective=F.lit("2024-06-01").cast("date"),
    )


@register(
    "w4_insert_all",
    ALL_SQL + f"select {CUSTOMER_SQL} from old union all select {CUSTOMER_SQL} from firsts where c_custkey % 3 = 0",
)
def w4_insert_all(spark, sf_dir):
    return warehouse.insert_missing(
        old_customers(spark, sf_dir), new_customers(spark, sf_dir, REST), ["c_custkey"], order_by=["c_acctbal"]
    )


@register(
    "w5_upsert_all",
    ALL_SQL + f"""select {CUSTOMER_SQL} from new
      union all select {CUSTOMER_SQL} from old where c_custkey not in (select c_custkey from new)""",
)
def w5_upsert_all(spark, sf_dir):
    return warehouse.upsert(
        old_customers(spark, sf_dir), new_customers(spark, sf_dir, REST), ["c_custkey"], order_by=["c_acctbal"]
    )


@register("w6_scd2_merge_all", ALL_HISTORY_SQL + "select * from history")
def w6_scd2_merge_all(spark, sf_dir):
    return all_history(spark, sf_dir)


@register(
    "w6_scd2_point_in_time_all",
    ALL_HISTORY_SQL + """select * from history where effective_date <= date '2024-07-01'
      and (end_date is null or end_date > date '2024-07-01')""",
)
def w6_scd2_point_in_time_all(spark, sf_dir):
    return warehouse.point_in_time(all_history(spark, sf_dir), F.lit("2024-07-01").cast("date"))


@register(
    "w7_load_statistics_all",
    ALL_SQL + """, actions as (
      select case when o.c_custkey is null then 'inserted' when n.c_custkey is null then 'kept'
        when o.c_mktsegment = n.c_mktsegment then 'unchanged' else 'updated' end as action
      from old o full join new n on o.c_custkey = n.c_custkey)
    select action, count(*) as row_count from actions group by action""",
)
def w7_load_statistics_all(spark, sf_dir):
    return warehouse.load_statistics(
        warehouse.scd2_classify(
            history(spark, sf_dir), new_customers(spark, sf_dir, REST), ["c_custkey"], tracked=TRACKED,
            order_by=["c_acctbal"],
        )
    )


def dimensions(spark, sf_dir):
    """Dimensions derived from the tables; one commodity and the last year are left out."""
    parts = table(spark, sf_dir, "part")
    sources = table(spark, sf_dir, "lineitem").select("l_returnflag").distinct()
    return {
        "dim_date": warehouse.date_dimension(spark, "1994-01-01", "2000-12-31"),
        "dim_commodity": parts.filter("p_type <> 'PROMO'").groupBy(F.col("p_type").alias("commodity_name")).agg(
            F.min("p_partkey").cast("int").alias("commodity_key")
        ),
        "dim_market": table(spark, sf_dir, "region").select(
            F.col("r_name").alias("market_name"), F.col("r_regionkey").alias("market_key")
        ),
        "dim_source": sources.select(
            F.col("l_returnflag").alias("source_name"), F.ascii("l_returnflag").alias("source_key")
        ),
        "dim_currency": warehouse.seed_dimensions(spark)["dim_currency"],
    }


RESOLVED_SQL = WITH_PRICES + """, resolved as (
  select p.*, case when date <= date '2000-12-31' then cast(strftime(date, '%Y%m%d') as int) end as date_key,
    c.commodity_key, r_regionkey as market_key, ascii(source) as source_key,
    case currency when 'USD' then 1 when 'EUR' then 2 else 3 end as currency_key
  from prices p join region on r_name = market
  left join (select p_type, cast(min(p_partkey) as int) as commodity_key from part where p_type <> 'PROMO' group by 1) c
    on p_type = commodity),
fact as (select * from resolved where date_key is not null and commodity_key is not null)"""


def resolved(spark, sf_dir):
    return warehouse.resolve_fact_keys(prices(spark, sf_dir), dimensions(spark, sf_dir))


@register(
    "w8_fact_rows",
    RESOLVED_SQL + """select date_key, commodity_key, market_key, source_key, currency_key,
      cast(close_price as decimal(10,2)) as close_price, cast(volume as decimal(15,2)) as volume from fact""",
)
def w8_fact_rows(spark, sf_dir):
    return warehouse.fact_rows(resolved(spark, sf_dir), natural_key=PRICE_ORDER).select(
        *warehouse.FACT_KEYS, "close_price", "volume"
    )


@register(
    "w8_fact_statistics",
    RESOLVED_SQL + """select (select count(*) from fact) as inserted,
      (select count(*) from resolved) - (select count(*) from fact) as skipped, cast(0 as bigint) as rejected""",
)
def w8_fact_statistics(spark, sf_dir):
    return warehouse.fact_statistics(resolved(spark, sf_dir))


@register(
    "w9_surrogate_collisions",
    "select cast(0 as bigint) as surrogate_key, '' as first_key, '' as last_key from lineitem where false",
)
def w9_surrogate_collisions(spark, sf_dir):
    return warehouse.surrogate_collisions(prices(spark, sf_dir), PRICE_ORDER)


@register("w9_surrogate_keys")
def w9_surrogate_keys(spark, sf_dir):
    return prices(spark, sf_dir).select(warehouse.surrogate_key(PRICE_ORDER).alias("price_id"), *TIE_BREAK, "date")


def monthly_fact(spark, sf_dir):
    """Fact rows with their ordering columns."""
    complete = resolved(spark, sf_dir).filter("date_key IS NOT NULL AND commodity_key IS NOT NULL")
    return complete.select(
        warehouse.surrogate_key(PRICE_ORDER).alias("price_id"), *warehouse.FACT_KEYS, *TIE_BREAK,
        F.col("close_price").cast("decimal(10,2)").alias("close_price"),
    )


def refreshed(spark, sf_dir):
    """Two loads: everything but the last year with a full refresh, then that year for its dates only."""
    base = scratch_path(spark, "gold")
    fact, path = monthly_fact(spark, sf_dir), f"{base}/commodity_prices_fact"
    order = ["date_key", *TIE_BREAK]
    warehouse.write_fact(fact.filter("date_key < 20000101"), path, grain="month")
    warehouse.refresh_summaries(spark, path, base, order_by=order, grain="month")
    late = fact.filter("date_key >= 20000101")
    warehouse.write_fact(late, path, grain="month")
    warehouse.refresh_summaries(
        spark, path, base, order_by=order, touched=late.select("date_key"), grain="month"
    )
    return base


W10_DAILY_SQL = RESOLVED_SQL + f""", summary as (
  select date_key, commodity_key, market_key,
    cast(arg_min(close_price, row({ORDER_SQL})) as decimal(10,2)) as open_price,
    cast(max(close_price) as decimal(10,2)) as high_price, cast(min(close_price) as decimal(10,2)) as low_price,
    cast(arg_max(close_price, row({ORDER_SQL})) as decimal(10,2)) as close_price,
    cast(sum(volume) as decimal(15,2)) as volume, cast(count(distinct source_key) as int) as source_count,
    cast(count(*) as int) as record_count
  from fact group by 1, 2, 3)"""


@register("w10_refresh_daily", W10_DAILY_SQL + "select * from summary")
def w10_refresh_daily(spark, sf_dir):
    return spark.read.parquet(refreshed(spark, sf_dir) + "/daily_price_summary").select(
        "date_key", "commodity_key", "market_key", "open_price", "high_price", "low_price", "close_price",
        "volume", "source_count", "record_count",
    )


@register(
    "w10_refresh_monthly",
    W10_DAILY_SQL + """select cast(date_key // 10000 as int) as year, cast(date_key // 100 % 100 as int) as month, commodity_key,
      min(close_price) as min_price, max(close_price) as max_price, cast(sum(volume) as decimal(15,2)) as total_volume
      from summary group by 1, 2, 3""",
)
def w10_refresh_monthly(spark, sf_dir):
    return spark.read.parquet(refreshed(spark, sf_dir) + "/monthly_commodity_summary").select(
        "year", "month", "commodity_key", "min_price", "max_price", "total_volume"
    )


@register(
    "w11_verify_warehouse",
    RESOLVED_SQL + """, n as (select count(*) as rows, count(*) filter (date_key is null) as d,
        count(*) filter (commodity_key is null) as c from resolved)
    select 'row_count' as check_name, true as passed, rows as row_count, cast(0 as bigint) as null_count,
      cast(null as varchar) as error_message from n
    union all select 'missing_values', d + c = 0, rows, d + c,
      case when d + c > 0 then 'Found ' || (d + c) || ' null values in required columns' end from n
    union all select 'fk_date_key', d = 0, rows, d, case when d > 0 then 'Found ' || d || ' rows without a match for date_key' end from n
    union all select 'fk_commodity_key', c = 0, rows, c,
      case when c > 0 then 'Found ' || c || ' rows without a match for commodity_key' end from n
    union all select unnest(['fk_market_key', 'fk_source_key', 'fk_currency_key']), true, rows, 0, null from n""",
)
def w11_verify_warehouse(spark, sf_dir):
    return warehouse.verify_warehouse(resolved(spark, sf_dir), dimensions(spark, sf_dir))


@register("w5_snapshot_roundtrip", OLD_NEW_SQL + f"""select {CUSTOMER_SQL} from new
      union all select {CUSTOMER_SQL} from old where c_custkey not in (select c_custkey from new)""")
def w5_snapshot_roundtrip(spark, sf_dir):
    base = scratch_path(spark, "dim_customer")
    warehouse.write_snapshot(old_customers(spark, sf_dir), base)
    merged = warehouse.upsert(
        warehouse.read_snapshot(spark, base), new_customers(spark, sf_dir), ["c_custkey"], order_by=["c_acctbal"]
    )
    warehouse.write_snapshot(merged, base)
    return warehouse.read_snapshot(spark, base)


@register(
    "w1_table_definitions",
    """select r_regionkey as market_key, r_name as market_name, cast(null as varchar) as exchange, true as is_active
       from region""",
)
def w1_table_definitions(spark, sf_dir):
    """Creates every gold table and loads one of them."""
    base = scratch_path(spark, "warehouse")
    database = "gold_" + base.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}'")
    create_tables(spark, database)
    rows = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("market_key"), F.col("r_name").alias("market_name"), F.lit(True).alias("is_active")
    )
    target = spark.table(f"{database}.dim_market")
    missing = {f.name: F.lit(None).cast(f.dataType) for f in target.schema.fields if f.name not in rows.columns}
    rows.withColumns(missing).select(*target.columns).write.insertInto(f"{database}.dim_market")
    return spark.table(f"{database}.dim_market").select("market_key", "market_name", "exchange", "is_active")


@register(
    "w12_load_report",
    """select ts as timestamp, 'warehouse_load_' || event_type as operation, cast(user_id as varchar) as inserted
       from events order by ts desc limit 100""",
)
def w12_load_report(spark, sf_dir):
    loads = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("table"),
        F.col("user_id").alias("records_inserted"), F.lit(0).alias("records_updated"),
        F.col("value").alias("duration_seconds"), F.lit("completed").alias("status"),
    )
    return oplog.load_report(oplog.load_log(loads)).select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "operation",
        F.try_element_at("details", F.lit("records_inserted")).alias("inserted"),
    )


CHAIN_SQL = f"""with {PRICES_SQL}, loaded as (
    select cast(strftime(date, '%Y%m%d') as int) as date_key, commodity, market, source, close_price, volume
    from prices where part_id % 97 <> 0)"""


def chain_two_loads(spark, sf_dir):
    """Paths after two loads: the second brings late rows of loaded days and one new commodity.

    Both hold prices too large for the fact table.
    """
    rows = prices(spark, sf_dir).withColumn("date_key", F.date_format("date", "yyyyMMdd").cast("int"))
    rows = rows.withColumn("close_price", F.when(F.col("part_id") % 97 == 0, F.lit(1.5e8)).otherwise(F.col("close_price")))
    late = (F.col("order_id") % 7 == 0) | (F.col("commodity") == "PROMO")
    seeds = warehouse.seed_dimensions(spark)
    dims = {**seeds, "dim_date": warehouse.date_dimension(spark, "1994-01-01", "1994-01-31")}
    base = scratch_path(spark, "chain")
    paths = {}
    for batch in (rows.filter(~late), rows.filter(late)):
        paths = medallion.load_gold(
            spark, batch, dims, base, natural_key=PRICE_ORDER, grain="month", grow_dimensions=True
        )
        dims = {name: warehouse.read_snapshot(spark, paths[name]) for name in dims}
    return paths


@register(
    "w13_chain_two_loads",
    CHAIN_SQL + """select date_key, commodity, market, cast(max(close_price) as decimal(10,2)) as high_price,
      cast(min(close_price) as decimal(10,2)) as low_price, cast(sum(volume) as decimal(15,2)) as volume,
      cast(count(distinct source) as int) as source_count, cast(count(*) as int) as record_count
    from loaded group by 1, 2, 3""",
)
def w13_chain_two_loads(spark, sf_dir):
    paths = chain_two_loads(spark, sf_dir)
    commodity, market = (
        warehouse.read_snapshot(spark, paths[f"dim_{n}"]).select(f"{n}_key", F.col(f"{n}_name").alias(n)) for n in ("commodity", "market")
    )
    daily = spark.read.parquet(paths["daily_price_summary"]).join(commodity, "commodity_key").join(market, "market_key")
    return daily.select("date_key", "commodity", "market", "high_price", "low_price", "volume", "source_count", "record_count")


@register(
    "w10_refresh_weekly",
    W10_DAILY_SQL + """select cast(year(d) as int) as year, cast(weekofyear(d) as int) as week_of_year, commodity_key, min(close_price) as min_price,
      max(close_price) as max_price, cast(sum(volume) as decimal(15,2)) as total_volume
      from (select *, cast(strptime(cast(date_key as varchar), '%Y%m%d') as date) as d from summary) group by 1, 2, 3""",
)
def w10_refresh_weekly(spark, sf_dir):
    return spark.read.parquet(refreshed(spark, sf_dir) + "/weekly_commodity_summary").select(
        "year", "week_of_year", "commodity_key", "min_price", "max_price", "total_volume"
    )
