"""Registered queries from price series to model input."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelake.operators import aggregates, cleaning, features, modelling
from pricelake.plans.analytics_queries import CALENDAR_ROWS, SERIES, daily
from pricelake.plans.registry import WITH_DAILY, WITH_PRICES, register, sql_stable, stabled
from pricelake.plans.silver_queries import GAPPY_SQL, ID, ID_SQL, RANKED_SQL, gappy
from pricelake.session import scratch_path
from pricelake.sources.canonical import prices

MARKETS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
EDGES = [("train", "1900-01-01"), ("validation", "1996-01-01"), ("test", "1997-07-01")]

MONTHLY_SQL = """
monthly as (
  select cast(year(date) as int) as year, cast(month(date) as int) as month, commodity, avg(close_price) as avg_price
  from daily where date is not null group by 1, 2, 3
)"""


@register(
    "r2_treated_outliers",
    RANKED_SQL.format(t="0.5") + f"""
    select {ID_SQL}, date, g.commodity,
      {sql_stable("case when close_price is not null then least(greatest(close_price, lower_bound), upper_bound) end")} as close_price,
      coalesce(close_price < lower_bound or close_price > upper_bound, false) as is_treated
    from gappy g join bounds b on g.commodity = b.commodity""",
)
def r2_treated_outliers(spark, sf_dir):
    rows = gappy(spark, sf_dir).select(*ID, "date", "commodity", "close_price")
    return stabled(modelling.treat_outliers(rows, column="close_price", keys=["commodity"], threshold=0.5), "close_price")


@register(
    "r3_period_changes",
    WITH_DAILY + f""", {MONTHLY_SQL}
    select m.commodity, m.year, m.month, {sql_stable("m.avg_price")} as avg_price,
      {sql_stable("(m.avg_price - p.avg_price) / nullif(p.avg_price, 0) * 100")} as mom_change_pct,
      {sql_stable("(m.avg_price - y.avg_price) / nullif(y.avg_price, 0) * 100")} as yoy_change_pct
    from monthly m left join monthly p on m.commodity = p.commodity and m.year * 12 + m.month = p.year * 12 + p.month + 1
    left join monthly y on m.commodity = y.commodity and m.month = y.month and m.year = y.year + 1""",
)
def r3_period_changes(spark, sf_dir):
    told = modelling.period_changes(aggregates.monthly_summary(daily(spark, sf_dir)))
    told = told.select("commodity", "year", "month", "avg_price", "mom_change_pct", "yoy_change_pct")
    return stabled(told, "avg_price", "mom_change_pct", "yoy_change_pct")


@register(
    "r5_correlation_matrix",
    WITH_PRICES + """, means as (select date, market, avg(close_price) as x from prices group by 1, 2),
    pairs as (select a.market as market, b.market as other, corr(a.x, b.x) as r from means a join means b on a.date = b.date group by 1, 2)
    select market, """ + ", ".join(sql_stable(f"max(case when other = '{m}' then r end)") + f' as "{m}"' for m in MARKETS) + " from pairs group by market",
)
def r5_correlation_matrix(spark, sf_dir):
    return stabled(modelling.correlation_matrix(prices(spark, sf_dir), MARKETS), *MARKETS)


LABELS_SQL = """
told as (
  select commodity, market, date, close_price, lead(date) over w as label_date, lead(close_price) over w as next_price,
    lag(close_price) over w as price_lag_1d, lag(close_price, 7) over w as price_lag_7d
  from daily window w as (partition by commodity, market order by date)
), stats as (select commodity, market, avg(close_price) as m, stddev_pop(close_price) as s from daily group by 1, 2)"""
LABEL_COLUMNS_SQL = f"""t.commodity, t.market, date, close_price, label_date,
      {sql_stable("(next_price - close_price) / nullif(close_price, 0) * 100")} as next_return_pct, cast(sign(next_price - close_price) as int) as direction"""


@register(
    "r6_labels",
    WITH_DAILY + f""", {LABELS_SQL}
    select {LABEL_COLUMNS_SQL}, coalesce(abs(close_price - m) / nullif(s, 0) > 1.5, false) as is_outlier
    from told t join stats on t.commodity = stats.commodity and t.market = stats.market""",
)
def r6_labels(spark, sf_dir):
    rows = daily(spark, sf_dir).select(*SERIES, "date", "close_price")
    told = modelling.next_move(rows, keys=SERIES, order_by=["date"], series_rows=CALENDAR_ROWS)
    told = cleaning.flag_outliers(told, column="close_price", keys=SERIES, method="zscore", threshold=1.5)
    return stabled(told, "next_return_pct")


@register(
    "r7_decomposition",
    WITH_DAILY + f""", {MONTHLY_SQL}, wide as (
      select *, count(avg_price) over w as n, sum(avg_price) over w + sum(avg_price) over v as twice_a_year
      from (select *, year * 12 + month as month_no from monthly)
      window w as (partition by commodity order by month_no range between 6 preceding and 6 following),
        v as (partition by commodity order by month_no range between 5 preceding and 5 following)
    ), trended as (select commodity, year, month, avg_price, case when n = 13 then twice_a_year / 24 end as trend from wide),
    effects as (select commodity, month, avg(avg_price - trend) as effect from trended group by 1, 2),
    seasons as (select commodity, month, effect - avg(effect) over (partition by commodity) as seasonal from effects)
    select t.commodity, t.year, t.month, {sql_stable("avg_price")} as avg_price, {sql_stable("trend")} as trend, {sql_stable("seasonal")} as seasonal,
      {sql_stable("avg_price - trend - seasonal")} as residual
    from trended t join seasons s on t.commodity = s.commodity and t.month = s.month""",
)
def r7_decomposition(spark, sf_dir):
    monthly = aggregates.monthly_summary(daily(spark, sf_dir)).select("commodity", "year", "month", "avg_price")
    return stabled(modelling.decompose(monthly), "avg_price", "trend", "seasonal", "residual")


@register(
    "r8_training_export",
    WITH_DAILY + f""", {LABELS_SQL}
    select {LABEL_COLUMNS_SQL}, price_lag_1d, price_lag_7d,
      case when date < date '1996-01-01' then 'train' when date < date '1997-07-01' then 'validation' else 'test' end as split
    from told t where label_date is not null and not (date < date '1996-01-01' and label_date >= date '1996-01-01')
      and not (date < date '1997-07-01' and label_date >= date '1997-07-01')""",
)
def r8_training_export(spark, sf_dir):
    """Features and labels, split by date without rows whose label lies behind their split, written per split and read back."""
    rows = daily(spark, sf_dir).select(*SERIES, "date", "close_price")
    told = modelling.next_move(rows, keys=SERIES, order_by=["date"], series_rows=CALENDAR_ROWS)
    told = features.lag_features(told, keys=SERIES, order_by=["date"], lags=(1, 7), series_rows=CALENDAR_ROWS)
    path = scratch_path(spark, "training")
    modelling.export_split(stabled(modelling.date_split(told, EDGES), "next_return_pct"), path)
    return modelling.read_split(path, spark).withColumn("split", F.col("split").cast("string"))
