"""Registered summaries, views and features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import aggregates, features, reports, views
from pricelake.plans.registry import (
    ORDER_SQL, TIE_SQL, WITH_DAILY, WITH_PRICES, register, sql_stable, stabled,
)
from pricelake.sources.canonical import PRICE_ORDER, TIE_BREAK, prices, table

SERIES = ["commodity", "market"]
# A daily summary holds one row per date in each (commodity, market) series, so a series
# can never be longer than the calendar: four centuries of days is a safe upper bound.
CALENDAR_ROWS = 150_000


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.daily_summary(prices(spark, sf_dir), order_by=PRICE_ORDER, source="source")


@register(
    "a1_daily_summary",
    WITH_DAILY + f"""
    select date, commodity, market, open_price, high_price, low_price, close_price, volume, record_count,
      source_count,
      {sql_stable("case when record_count > 1 then close_price - open_price end")} as price_change,
      {sql_stable("case when record_count > 1 then (close_price - open_price) / nullif(open_price, 0) * 100 end")}
        as price_change_pct
    from daily""",
)
def a1_daily_summary(spark, sf_dir):
    return stabled(daily(spark, sf_dir), "price_change", "price_change_pct")


@register(
    "a2_weekly_summary",
    WITH_DAILY + f"""
    select cast(year(date) as int) as year, cast(weekofyear(date) as int) as week, commodity,
      {sql_stable("avg(close_price)")} as avg_price, min(close_price) as min_price,
      max(close_price) as max_price, coalesce(sum(volume), 0) as total_volume,
      count(close_price) as record_count
    from daily group by 1, 2, 3""",
)
def a2_weekly_summary(spark, sf_dir):
    return stabled(aggregates.weekly_summary(daily(spark, sf_dir)), "avg_price")


@register(
    "a3_monthly_summary",
    WITH_DAILY + f"""
    select cast(year(date) as int) as year, cast(month(date) as int) as month, commodity,
      {sql_stable("avg(close_price)")} as avg_price, min(close_price) as min_price,
      max(close_price) as max_price, coalesce(sum(volume), 0) as total_volume,
      {sql_stable("case when count(close_price) > 1 then stddev_pop(close_price) end")} as price_volatility,
      count(close_price) as record_count
    from daily group by 1, 2, 3""",
)
def a3_monthly_summary(spark, sf_dir):
    return stabled(aggregates.monthly_summary(daily(spark, sf_dir)), "avg_price", "price_volatility")


@register(
    "a5_rows_in_range",
    """select count(*) as row_count from lineitem
       where cast(l_shipdate as date) between date '1996-01-01' and date '1996-12-31'""",
)
def a5_rows_in_range(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    start, end = (F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in ("1996-01-01", "1996-12-31"))
    return aggregates.rows_in_range(lines, column="l_shipdate", start=start, end=end)


@register(
    "a5_distinct_keys",
    WITH_PRICES + "select distinct commodity, market from prices order by commodity, market limit 10",
)
def a5_distinct_keys(spark, sf_dir):
    return aggregates.distinct_keys(prices(spark, sf_dir), columns=SERIES, limit=10)


@register(
    "v1_price_trends",
    WITH_PRICES + f""", lagged as (
      select *, lag(close_price) over (partition by commodity order by {ORDER_SQL}) as prev_price from prices)
    select date, commodity, market, order_id, line_no, close_price, volume, prev_price,
      {sql_stable("close_price - prev_price")} as price_change,
      {sql_stable("100 * (close_price - prev_price) / nullif(prev_price, 0)", 2)} as price_change_pct
    from lagged""",
)
def v1_price_trends(spark, sf_dir):
    out = views.price_trends(prices(spark, sf_dir), order_by=PRICE_ORDER)
    change = (F.col("close_price") - F.col("prev_price")) * 100
    return stabled(
        out.withColumn("price_change_pct", F.try_divide(change, F.col("prev_price"))).select(
            "date", "commodity", "market", "order_id", "line_no", "close_price", "volume", "prev_price",
            "price_change", "price_change_pct",
        ),
        "price_change",
    ).transform(lambda d: stabled(d, "price_change_pct", digits=2))


@register(
    "v2_volatility",
    WITH_PRICES + f"""
    select commodity, cast(year(date) as int) as year, cast(month(date) as int) as month,
      {sql_stable("stddev_samp(close_price)")} as price_volatility, {sql_stable("avg(volume)")} as avg_volume,
      {sql_stable("max(high_price) - min(low_price)")} as price_range
    from prices group by 1, 2, 3""",
)
def v2_volatility(spark, sf_dir):
    return stabled(views.volatility(prices(spark, sf_dir)), "price_volatility", "avg_volume", "price_range")


@register(
    "v3_source_comparison",
    WITH_PRICES + """
    select date, commodity, source, close_price, volume,
      count(*) over (partition by date, commodity) as sources_count
    from prices""",
)
def v3_source_comparison(spark, sf_dir):
    out = views.source_comparison(prices(spark, sf_dir))
    return out.select("date", "commodity", "source", "close_price", "volume", "sources_count")


CORRELATION_SQL = WITH_PRICES + f"""
    select a.commodity as commodity_1, b.commodity as commodity_2,
      {sql_stable("corr(a.close_price, b.close_price)", 6)} as price_correlation, count(*) as overlap_days
    from prices a join prices b on a.date = b.date and a.market = b.market and a.commodity < b.commodity
    group by 1, 2"""


@register("v4_correlation", CORRELATION_SQL)
def v4_correlation(spark, sf_dir):
    return stabled(views.correlation(prices(spark, sf_dir)), "price_correlation", digits=6)


@register(
    "v5_year_over_year",
    WITH_PRICES + f""", months as (
      select commodity, year(date) as year, month(date) as month, avg(close_price) as avg_price
      from prices group by 1, 2, 3)
    select cast(c.month as int) as month, c.commodity, cast(c.year as int) as current_year,
      {sql_stable("c.avg_price")} as current_year_avg_price, cast(p.year as int) as previous_year,
      {sql_stable("p.avg_price")} as previous_year_avg_price,
      {sql_stable("100 * (c.avg_price - p.avg_price) / nullif(p.avg_price, 0)", 2)} as yoy_change_pct
    from months c join months p on c.commodity = p.commodity and c.month = p.month and c.year = p.year + 1""",
)
def v5_year_over_year(spark, sf_dir):
    out = views.year_over_year(prices(spark, sf_dir))
    return stabled(out, "current_year_avg_price", "previous_year_avg_price").transform(
        lambda d: stabled(d, "yoy_change_pct", digits=2)
    )


@register(
    "v6_volume_analysis",
    WITH_PRICES + f""", averaged as (
      select *, avg(volume) over (partition by commodity order by {ORDER_SQL}
        rows between 29 preceding and current row) as a from prices)
    select date, commodity, market, order_id, line_no, volume, {sql_stable("a")} as volume_30d_avg,
      {sql_stable("volume / nullif(a, 0)", 6)} as volume_ratio_to_avg
    from averaged""",
)
def v6_volume_analysis(spark, sf_dir):
    out = views.volume_analysis(prices(spark, sf_dir), order_by=PRICE_ORDER).select(
        "date", "commodity", "market", "order_id", "line_no", "volume", "volume_30d_avg", "volume_ratio_to_avg"
    )
    return stabled(stabled(out, "volume_30d_avg"), "volume_ratio_to_avg", digits=6)


@register(
    "v7_view_registry",
    WITH_PRICES + """
    select source, cast(max(n) as bigint) as most_rows, count(*) as row_count from (
      select source, count(*) over (partition by date, commodity) as n from prices) t
    group by source""",
)
def v7_view_registry(spark, sf_dir):
    views.register_views(spark, prices(spark, sf_dir), order_by=PRICE_ORDER)
    return spark.sql(
        "SELECT source, max(sources_count) AS most_rows, count(*) AS row_count "
        "FROM v_source_comparison GROUP BY source"
    )


SERIES_WINDOW = "partition by commodity, market order by date"
DAILY_COLUMNS = ["date", "commodity", "market", "close_price"]


def feature_input(spark, sf_dir):
    return daily(spark, sf_dir).select(*DAILY_COLUMNS)


@register(
    "f1_lag_features",
    WITH_DAILY + "select date, commodity, market, close_price, "
    + ", ".join(f"lag(close_price, {n}) over ({SERIES_WINDOW}) as price_lag_{n}d" for n in (1, 7, 30))
    + " from daily",
)
def f1_lag_features(spark, sf_dir):
    return features.lag_features(
        feature_input(spark, sf_dir), keys=SERIES, order_by=["date"], series_rows=CALENDAR_ROWS
    )


def rolling_sql() -> str:
    columns = []
    for w in (7, 30, 90):
        over = f"over ({SERIES_WINDOW} rows between {w} preceding and 1 preceding)"
        for label, fn in (("ma", "avg"), ("std", "stddev_pop"), ("min", "min"), ("max", "max")):
            value = f"case when count(*) {over} = {w} then {fn}(close_price) {over} end"
            columns.append(f"{sql_stable(value)} as price_{label}_{w}d")
    return WITH_DAILY + f"select date, commodity, market, close_price, {', '.join(columns)} from daily"


@register("f2_rolling_features", rolling_sql())
def f2_rolling_features(spark, sf_dir):
    out = features.rolling_features(
        feature_input(spark, sf_dir), keys=SERIES, order_by=["date"], series_rows=CALENDAR_ROWS
    )
    return stabled(out, *[c for c in out.columns if c.startswith("price_")])


@register(
    "f3_momentum",
    WITH_DAILY + "select date, commodity, market, close_price, " + ", ".join(
        sql_stable(
            f"(close_price - lag(close_price, {n}) over w) / nullif(lag(close_price, {n}) over w, 0) * 100"
        ) + f" as momentum_roc_{n}d" for n in (7, 30)
    ) + f" from daily window w as ({SERIES_WINDOW})",
)
def f3_momentum(spark, sf_dir):
    out = features.momentum_features(
        feature_input(spark, sf_dir), keys=SERIES, order_by=["date"], series_rows=CALENDAR_ROWS
    )
    return stabled(out, "momentum_roc_7d", "momentum_roc_30d")


@register(
    "f4_rsi",
    WITH_DAILY + f""", changes as (
      select date, commodity, market, close_price,
        close_price - lag(close_price) over ({SERIES_WINDOW}) as d from daily),
    means as (
      select *, avg(greatest(d, 0)) over w as gain, avg(greatest(-d, 0)) over w as loss, count(d) over w as n
      from changes window w as ({SERIES_WINDOW} rows between 13 preceding and current row))
    select date, commodity, market, close_price,
      {sql_stable("case when n = 14 then case when loss = 0 then 100.0 else 100 - 100 / (1 + gain / loss) end end")}
        as momentum_rsi_14d
    from means""",
)
def f4_rsi(spark, sf_dir):
    out = features.rsi_feature(
        feature_input(spark, sf_dir), keys=SERIES, order_by=["date"], series_rows=CALENDAR_ROWS
    )
    return stabled(out, "momentum_rsi_14d")


def macd_sql() -> str:
    def ema(span: int) -> str:
        weight = f"pow({1 - 2 / (span + 1)!r}, len(tail) - i)"
        return (
            f"list_sum(list_transform(range(1, len(tail) + 1), lambda i: tail[i] * {weight}))"
            f" / list_sum(list_transform(range(1, len(tail) + 1), lambda i: {weight}))"
        )

    value = sql_stable(f"{ema(12)} - {ema(26)}")
    return WITH_DAILY + f""", tails as (
      select date, commodity, market, close_price, list(close_price) over ({SERIES_WINDOW}
        rows between unbounded preceding and current row) as tail from daily)
    select date, commodity, market, close_price, {value} as momentum_macd from tails"""


@register("f4_macd", macd_sql())
def f4_macd(spark, sf_dir):
    out = features.macd_feature(
        feature_input(spark, sf_dir), keys=SERIES, order_by=["date"], series_rows=CALENDAR_ROWS
    )
    return stabled(out, "momentum_macd")


@register(
    "f5_seasonal",
    WITH_DAILY + f"""
    select date, commodity, market, close_price,
      {sql_stable("sin(2 * pi() * month(date) / 12)", 7)} as seasonal_month_sin,
      {sql_stable("cos(2 * pi() * month(date) / 12)", 7)} as seasonal_month_cos,
      cast(quarter(date) as int) as seasonal_quarter, month(date) in (9, 10, 11) as seasonal_is_harvest
    from daily""",
)
def f5_seasonal(spark, sf_dir):
    out = features.seasonal_features(feature_input(spark, sf_dir))
    return stabled(out, "seasonal_month_sin", "seasonal_month_cos", digits=7)


@register(
    "f6_market_structure",
    WITH_PRICES + f"""
    select order_id, part_id, supplier_id, line_no, date, close_price,
      {sql_stable("(high_price + low_price + close_price) / 3")} as market_typical_price,
      {sql_stable("high_price - low_price")} as market_price_range,
      {sql_stable("case when high_price - low_price > 0 then (close_price - low_price) / (high_price - low_price) end")}
        as market_close_position
    from prices""",
)
def f6_market_structure(spark, sf_dir):
    out = features.market_structure_features(prices(spark, sf_dir)).select(
        "order_id", "part_id", "supplier_id", "line_no", "date", "close_price",
        "market_typical_price", "market_price_range", "market_close_position",
    )
    return stabled(out, "market_typical_price", "market_price_range", "market_close_position")


@register(
    "a4_aggregation_report",
    WITH_DAILY + """, counts as (
      select (select count(*) from prices) as p, (select count(*) from daily) as d,
        (select count(*) from (select distinct year(date), weekofyear(date), commodity from daily) t) as w)
    select 0 as step, 'build_daily_summary' as operation, p as rows_in, d as rows_out, p - d as rows_removed from counts
    union all select 1, 'build_weekly_summary', d, w, d - w from counts""",
)
def a4_aggregation_report(spark, sf_dir):
    rows, days = prices(spark, sf_dir), daily(spark, sf_dir)
    return reports.operation_report(
        [
            ("build_daily_summary", rows, days),
            ("build_weekly_summary", days, aggregates.weekly_summary(days)),
        ]
    )


@register(
    "f7_feature_report",
    WITH_DAILY + """select 0 as step, 'create_lag_features' as operation, count(*) as rows_in, count(*) as rows_out,
      cast(0 as bigint) as rows_removed from daily""",
)
def f7_feature_report(spark, sf_dir):
    rows = feature_input(spark, sf_dir)
    lagged = features.lag_features(rows, keys=SERIES, order_by=["date"], series_rows=CALENDAR_ROWS)
    return reports.operation_report([("create_lag_features", rows, lagged)])


@register("v4_correlation_by_rows", CORRELATION_SQL)
def v4_correlation_by_rows(spark, sf_dir):
    return stabled(views.correlation_by_rows(prices(spark, sf_dir)), "price_correlation", digits=6)
