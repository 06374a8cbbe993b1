"""Registered queries along time: rates as of a date, gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import normalize, timeline
from pricelake.plans.registry import WITH_PRICES, register, sql_stable, stabled
from pricelake.sources.canonical import prices, table


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(currency, rate_date, rate): the last order of a currency's customers on a day sets the day's rate."""
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    region = F.col("n_regionkey") % 3
    code = F.when(region == 0, "USD").when(region == 1, "EUR").otherwise("UAH")
    return orders.groupBy(code.alias("currency"), F.col("o_orderdate").cast("date").alias("rate_date")).agg(
        (F.max_by("o_totalprice", "o_orderkey") / 100_000).alias("rate")
    )


RATES_SQL = """
rates as (
  select case n_regionkey % 3 when 0 then 'USD' when 1 then 'EUR' else 'UAH' end as currency, cast(o_orderdate as date) as rate_date,
    arg_max(o_totalprice, o_orderkey) / 100000 as rate
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2
)"""


@register(
    "r4_prices_asof_rate",
    WITH_PRICES + f""", {RATES_SQL}
    select p.order_id, p.line_no, p.part_id, p.supplier_id, p.date, p.currency, r.rate_date, {sql_stable("r.rate", 6)} as rate,
      {sql_stable("case when p.currency <> 'USD' then p.close_price * r.rate else p.close_price end")} as close_price,
      case when p.currency <> 'USD' and r.rate is not null then 'USD' end as close_price_base_currency
    from prices p asof left join rates r on p.currency = r.currency and p.date >= r.rate_date""",
)
def r4_prices_asof_rate(spark, sf_dir):
    told = normalize.normalize_prices_asof(prices(spark, sf_dir), daily_rates(spark, sf_dir), price="close_price")
    told = stabled(stabled(told, "close_price"), "rate", digits=6)
    return told.select(
        "order_id", "line_no", "part_id", "supplier_id", "date", "currency", "rate_date", "rate", "close_price", "close_price_base_currency"
    )


@register(
    "asof_last_order",
    """select l_orderkey, l_linenumber, cast(l_shipdate as date) as date, o_orderkey as last_order, cast(o_orderdate as date) as ordered
       from lineitem asof left join (select o_orderdate, max(o_orderkey) as o_orderkey from orders group by 1) on l_shipdate >= o_orderdate""",
)
def asof_last_order(spark, sf_dir):
    """Line items with the newest order of anyone at their ship time: one key, no column to cut by but time."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", F.lit(1).alias("all"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("last_order"), "o_orderdate", F.lit(1).alias("all"))
    told = timeline.asof_join(lines, orders, keys=["all"], time="l_shipdate", right_time="o_orderdate", columns=["last_order"])
    return told.select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("date"), "last_order", F.col("o_orderdate").cast("date").alias("ordered")
    )


@register(
    "r1_gap_fill",
    WITH_PRICES + f""",
    known as (select market, source, date, max(close_price) as price from prices group by all),
    told as (select *, lead(date) over w as next_date, lead(price) over w as next_price from known window w as (partition by market, source order by date)),
    spread as (select *, unnest(generate_series(0, coalesce(next_date - date, 1) - 1)) as step from told)
    select market, source, cast(date + cast(step as integer) as date) as date, step > 0 as is_filled,
      {sql_stable("case when step = 0 then price else price + (next_price - price) * step / (next_date - date) end")} as price
    from spread""",
)
def r1_gap_fill(spark, sf_dir):
    known = prices(spark, sf_dir).groupBy("market", "source", "date").agg(F.max("close_price").alias("price"))
    return stabled(timeline.fill_gaps(known, keys=["market", "source"], date="date", value="price"), "price")
