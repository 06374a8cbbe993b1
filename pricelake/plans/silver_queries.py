"""Registered cleaning, normalisation, enrichment and quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import cleaning, enrich, normalize, quality, reports
from pricelake.plans.analytics_queries import CALENDAR_ROWS, SERIES, daily
from pricelake.plans.registry import (
    ORDER_SQL, WITH_DAILY, WITH_PRICES, register, sql_stable, stabled,
)
from pricelake.sources.canonical import PRICE_ORDER, prices, table

ID = ["order_id", "part_id", "supplier_id", "line_no"]
ID_SQL = "order_id, part_id, supplier_id, line_no"


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price facts in which every seventh line has no price."""
    return prices(spark, sf_dir).withColumn(
        "close_price", F.when(F.col("line_no") % 7 != 0, F.col("close_price"))
    )


GAPPY_SQL = WITH_PRICES + """, gappy as (
  select * replace (case when line_no % 7 <> 0 then close_price end as close_price) from prices)"""


def order_lines(spark, sf_dir):
    return prices(spark, sf_dir).select(*PRICE_ORDER, "commodity", "market", "source", "close_price")


FIRST_SQL = WITH_PRICES + """
  select * exclude (rn) from (
    select {cols}, row_number() over (partition by order_id, line_no order by {order}) as rn from prices) t
  where rn = 1"""


@register(
    "c1_dedup_first",
    FIRST_SQL.format(cols=ORDER_SQL + ", commodity, market, source, close_price", order=ORDER_SQL),
)
def c1_dedup_first(spark, sf_dir):
    return cleaning.drop_duplicates(order_lines(spark, sf_dir), keys=["order_id", "line_no"], order_by=PRICE_ORDER)


@register(
    "c2_dedup_latest",
    FIRST_SQL.format(
        cols=ORDER_SQL + ", commodity, market, source, close_price",
        order=", ".join(f"{c.strip()} desc" for c in ORDER_SQL.split(",")),
    ),
)
def c2_dedup_latest(spark, sf_dir):
    return cleaning.drop_duplicates(
        order_lines(spark, sf_dir), keys=["order_id", "line_no"], order_by=PRICE_ORDER, keep="last"
    )


@register("c3_drop_missing", GAPPY_SQL + f"select {ID_SQL}, date, close_price from gappy where close_price is not null")
def c3_drop_missing(spark, sf_dir):
    return cleaning.handle_missing(gappy(spark, sf_dir).select(*ID, "date", "close_price"), strategy="drop")


@register("c4_fill_missing", GAPPY_SQL + f"select {ID_SQL}, date, coalesce(close_price, 0.0) as close_price from gappy")
def c4_fill_missing(spark, sf_dir):
    return cleaning.handle_missing(
        gappy(spark, sf_dir).select(*ID, "date", "close_price"), strategy="fill", fill_value=0.0
    )


@register(
    "c5_forward_fill",
    GAPPY_SQL + f"""
    select {ID_SQL}, date, commodity, market, last_value(close_price ignore nulls) over (
      partition by commodity, market order by {ORDER_SQL}
      rows between unbounded preceding and current row) as close_price
    from gappy""",
)
def c5_forward_fill(spark, sf_dir):
    filled = cleaning.handle_missing(
        gappy(spark, sf_dir).select(*PRICE_ORDER, *SERIES, "close_price"),
        strategy="forward_fill", keys=SERIES, order_by=PRICE_ORDER, columns=["close_price"],
    )
    return filled.select(*ID, "date", *SERIES, "close_price")


NAME_MAP = {"economy": "Economy", "std": "Standard grade", "promo": "Promo line", "large": "Large lot"}


@register(
    "c6_standard_names",
    """
    with named as (
      select p_partkey, case p_partkey % 4 when 0 then '  ' || p_type when 1 then lower(p_type)
        when 2 then substr(p_type, 1, 4) else chr(9) || p_type || chr(160) || chr(10) end as commodity from part),
    keyed as (select *, lower(trim(commodity, ' ' || chr(9) || chr(10) || chr(160))) as k from named),
    m as (select * from (values (1, 'economy', 'Economy'), (2, 'std', 'Standard grade'),
      (3, 'promo', 'Promo line'), (4, 'large', 'Large lot')) t(ord, raw, std))
    select p_partkey, coalesce(
      (select min(std) from m where raw = k),
      (select arg_min(std, ord) from m where contains(lower(std), k)), commodity) as commodity
    from keyed""",
)
def c6_standard_names(spark, sf_dir):
    kind, number = F.col("p_type"), F.col("p_partkey") % 4
    named = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(number == 0, F.concat(F.lit("  "), kind)).when(number == 1, F.lower(kind))
        .when(number == 2, F.substring(kind, 1, 4)).otherwise(F.concat(F.lit("\t"), kind, F.lit("\u00a0\n"))).alias("commodity"),
    )
    return cleaning.standardize_names(named, mapping=NAME_MAP)


RANKED_SQL = GAPPY_SQL + """, ranked as (
  select commodity, close_price, row_number() over (partition by commodity order by close_price) as rn,
    count(*) over (partition by commodity) as n from gappy where close_price is not null),
bounds as (
  select commodity, q1, q3, q1 - (q3 - q1) * {t} as lower_bound, q3 + (q3 - q1) * {t} as upper_bound from (
    select commodity, max(case when rn = n // 4 + 1 then close_price end) as q1,
      max(case when rn = 3 * n // 4 + 1 then close_price end) as q3 from ranked group by commodity) t)"""


@register("c7_iqr_bounds", RANKED_SQL.format(t="1.5") + "select * from bounds")
def c7_iqr_bounds(spark, sf_dir):
    return cleaning.quartile_bounds(gappy(spark, sf_dir), column="close_price", keys=["commodity"])


@register(
    "c7_iqr_outliers",
    RANKED_SQL.format(t="0.5") + f"""
    select {ID_SQL}, date, g.commodity, close_price,
      coalesce(close_price < lower_bound or close_price > upper_bound, false) as is_outlier
    from gappy g join bounds b on g.commodity = b.commodity""",
)
def c7_iqr_outliers(spark, sf_dir):
    return cleaning.flag_outliers(
        gappy(spark, sf_dir).select(*ID, "date", "commodity", "close_price"),
        column="close_price", keys=["commodity"], threshold=0.5,
    )


@register(
    "c8_zscore_outliers",
    GAPPY_SQL + f""", stats as (
      select commodity, avg(close_price) as m, stddev_pop(close_price) as s from gappy group by commodity)
    select {ID_SQL}, date, g.commodity, close_price,
      coalesce(abs(close_price - m) / nullif(s, 0) > 1.5, false) as is_outlier
    from gappy g join stats on g.commodity = stats.commodity""",
)
def c8_zscore_outliers(spark, sf_dir):
    return cleaning.flag_outliers(
        gappy(spark, sf_dir).select(*ID, "date", "commodity", "close_price"),
        column="close_price", keys=["commodity"], method="zscore", threshold=1.5,
    )


@register(
    "c9_cleaning_report",
    GAPPY_SQL + """, counts as (
      select (select count(*) from gappy) as a,
        (select count(distinct row(order_id, line_no)) from gappy) as b,
        (select count(*) from gappy where close_price is not null) as c)
    select 0 as step, 'remove_duplicates' as operation, a as rows_in, b as rows_out, a - b as rows_removed from counts
    union all select 1, 'drop_missing', a, c, a - c from counts""",
)
def c9_cleaning_report(spark, sf_dir):
    rows = gappy(spark, sf_dir)
    deduped = cleaning.drop_duplicates(rows, keys=["order_id", "line_no"], order_by=PRICE_ORDER)
    present = cleaning.drop_missing(rows, ["close_price"])
    return reports.operation_report([("remove_duplicates", rows, deduped), ("drop_missing", rows, present)])


@register(
    "e5_enrichment_report",
    """select 0 as step, 'add_date_dimensions' as operation, count(*) as rows_in, count(*) as rows_out,
         cast(0 as bigint) as rows_removed from orders
       union all select 1, 'add_trading_flags', count(*), count(*), 0 from orders""",
)
def e5_enrichment_report(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    dated = enrich.add_date_dimensions(rows)
    return reports.operation_report(
        [("add_date_dimensions", rows, dated), ("add_trading_flags", dated, enrich.add_trading_flags(dated))]
    )


CONVERT_SQL = "case currency when 'USD' then 1.0 when 'EUR' then 1.10 when 'UAH' then 0.027 else 1.0 end"


@register(
    "m1_currency_conversion",
    WITH_PRICES + f"""
    select {ID_SQL}, date, currency,
      {sql_stable(f"case when currency <> 'USD' then close_price * cast({CONVERT_SQL} as double) else close_price end", 6)}
        as close_price,
      case when currency <> 'USD' then 'USD' end as close_price_base_currency
    from prices""",
)
def m1_currency_conversion(spark, sf_dir):
    rows = prices(spark, sf_dir).select(*ID, "date", "currency", "close_price")
    return stabled(normalize.normalize_prices(rows, price="close_price"), "close_price", digits=6)


@register(
    "m1_currency_table",
    WITH_PRICES + f"""
    select {ID_SQL}, date, currency,
      {sql_stable(f"case when currency <> 'EUR' then close_price * cast({CONVERT_SQL} as double) / 1.10 else close_price end", 6)}
        as close_price,
      case when currency <> 'EUR' then 'EUR' end as close_price_base_currency
    from prices""",
)
def m1_currency_table(spark, sf_dir):
    rates = spark.createDataFrame([("USD", 1.0), ("EUR", 1.10), ("UAH", 0.027)], "currency string, rate double")
    rows = prices(spark, sf_dir).select(*ID, "date", "currency", "close_price")
    out = normalize.normalize_prices_by_table(rows, rates, price="close_price", base="EUR")
    return stabled(out, "close_price", digits=6)


@register(
    "m2_unit_conversion",
    WITH_PRICES + f"""
    select {ID_SQL}, date, case when lower(unit) <> 'ton' then 'ton' else unit end as unit,
      {sql_stable("volume * cast(case lower(unit) when 'bushel' then 0.0272155 when 'kg' then 0.001 when 'lb' then 0.000453592 else 1.0 end as double)", 6)}
        as volume
    from prices""",
)
def m2_unit_conversion(spark, sf_dir):
    rows = prices(spark, sf_dir).select(*ID, "date", "unit", "volume")
    return stabled(normalize.normalize_units(rows, quantity="volume"), "volume", digits=6)


DATE_TEXT_SQL = """case l_linenumber % 5 when 0 then strftime(l_shipdate, '%Y-%-m-%-d')
  when 1 then strftime(l_shipdate, '%Y/%m/%d') when 2 then strftime(l_shipdate, '%d-%m-%Y')
  when 3 then strftime(l_shipdate, '%d.%m.%Y') else 'on ' || strftime(l_shipdate, '%Y-%m-%d') end"""


def dated_text(spark, sf_dir):
    ship, kind = F.col("l_shipdate"), F.col("l_linenumber") % 5
    text = (
        F.when(kind == 0, F.date_format(ship, "yyyy-M-d"))
        .when(kind == 1, F.date_format(ship, "yyyy/MM/dd"))
        .when(kind == 2, F.date_format(ship, "dd-MM-yyyy"))
        .when(kind == 3, F.date_format(ship, "dd.MM.yyyy"))
        .otherwise(F.concat(F.lit("on "), F.date_format(ship, "yyyy-MM-dd")))
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("date"))


@register(
    "m3_timestamps",
    f"""select l_orderkey, l_linenumber, coalesce(strftime(try_strptime({DATE_TEXT_SQL},
      ['%Y-%m-%d', '%Y/%m/%d', '%d-%m-%Y', '%d.%m.%Y']), '%Y-%m-%d'), {DATE_TEXT_SQL}) as date
    from lineitem""",
)
def m3_timestamps(spark, sf_dir):
    return normalize.normalize_timestamps(dated_text(spark, sf_dir))


@register(
    "m4_rounding",
    WITH_PRICES + f"select {ID_SQL}, date, round(volume, 2) as volume, round(close_price, 2) as close_price from prices",
)
def m4_rounding(spark, sf_dir):
    rows = prices(spark, sf_dir).select(*ID, "date", "volume", "close_price")
    return normalize.round_values(rows, columns=["volume", "close_price"])


@register(
    "m5_normalization_report",
    WITH_PRICES + f""", counts as (
      select count(*) as rows, count(*) filter (currency <> 'USD') as a, count(*) filter (lower(unit) <> 'ton') as b,
        count(*) filter (line_no % 5 = 4) as c from prices)
    select rows, 'normalize_prices' as operation, a as affected from counts
    union all select rows, 'normalize_units', b from counts
    union all select rows, 'normalize_timestamps', c from counts""",
)
def m5_normalization_report(spark, sf_dir):
    rows = prices(spark, sf_dir).withColumn(
        "date",
        F.when(F.col("line_no") % 5 == 4, F.lit("unknown")).otherwise(F.date_format("date", "dd.MM.yyyy")),
    )
    return normalize.normalization_report(rows)


@register(
    "e1_date_dimensions",
    """select o_orderkey, cast(o_orderdate as date) as date, cast(year(o_orderdate) as int) as year,
      cast(month(o_orderdate) as int) as month, cast(quarter(o_orderdate) as int) as quarter,
      dayname(o_orderdate) as day_of_week, cast(weekofyear(o_orderdate) as int) as week_of_year,
      isodow(o_orderdate) >= 6 as is_weekend from orders""",
)
def e1_date_dimensions(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return enrich.add_date_dimensions(rows)


@register(
    "e2_trading_flags",
    """select o_orderkey, cast(o_orderdate as date) as date,
      strftime(o_orderdate, '%m-%d') in ('01-01', '07-04', '12-25') and year(o_orderdate) between 1996 and 1998
        as is_holiday,
      case when strftime(o_orderdate, '%m-%d') in ('01-01', '07-04', '12-25')
        and year(o_orderdate) between 1996 and 1998 then 'halted' else 'active' end as trading_status
    from orders""",
)
def e2_trading_flags(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    closed = [f"{y}-{d}" for y in (1996, 1997, 1998) for d in ("01-01", "07-04", "12-25")]
    return enrich.add_trading_flags(rows, holidays=closed)


@register(
    "e3_price_changes",
    GAPPY_SQL + f""", seen as (
      select *, last_value(close_price ignore nulls) over (partition by commodity, market order by {ORDER_SQL}
        rows between unbounded preceding and 1 preceding) as p from gappy)
    select {ID_SQL}, date, commodity, market, close_price, {sql_stable("close_price - p")} as price_change,
      {sql_stable("case when p = 0 then 0 else (close_price - p) / p * 100 end", 2)} as price_change_pct
    from seen""",
)
def e3_price_changes(spark, sf_dir):
    rows = gappy(spark, sf_dir).select(*PRICE_ORDER, *SERIES, "close_price")
    out = enrich.add_price_changes(rows, keys=SERIES, order_by=PRICE_ORDER, price="close_price")
    return stabled(out.select(*ID, "date", *SERIES, "close_price", "price_change", "price_change_pct"), "price_change").transform(
        lambda d: stabled(d, "price_change_pct", digits=2)
    )


PART_ATTRIBUTES = {
    "ECONOMY": {"type": "grain", "category": "cereals", "unit": "ton"},
    "STANDARD": {"type": "grain", "category": "cereals", "unit": "ton"},
    "PROMO": {"type": "oil_crop", "category": "legumes", "unit": "ton"},
    "LARGE": {"type": "oil_crop", "category": "oil_seeds", "unit": "kg"},
}
PART_SQL = """
    select p_partkey, p_type as commodity,
      case when p_type in ('ECONOMY', 'STANDARD') then 'grain' when p_type in ('PROMO', 'LARGE') then 'oil_crop' end
        as commodity_type,
      case when p_type in ('ECONOMY', 'STANDARD') then 'cereals' when p_type = 'PROMO' then 'legumes'
        when p_type = 'LARGE' then 'oil_seeds' end as commodity_category,
      case when p_type in ('ECONOMY', 'STANDARD', 'PROMO') then 'ton' when p_type = 'LARGE' then 'kg' end
        as commodity_unit
    from part"""


@register("e4_commodity_attributes", PART_SQL)
def e4_commodity_attributes(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("commodity"))
    return enrich.add_commodity_attributes(rows, attributes=PART_ATTRIBUTES)


@register("e4_commodity_attributes_table", PART_SQL)
def e4_commodity_attributes_table(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("commodity"))
    entries = [(k, v["type"], v["category"], v["unit"]) for k, v in PART_ATTRIBUTES.items()]
    attributes = spark.createDataFrame(entries, "commodity string, type string, category string, unit string")
    return enrich.add_commodity_attributes_by_table(rows, attributes)


# ---------------------------------------------------------------- quality


def check_sql(name: str, bad: str, rows: str, message: str, source: str, passed: str | None = None) -> str:
    passed = passed or f"({bad}) = 0"
    return (
        f"select {name} as check_name, {passed} as passed, cast({rows} as bigint) as row_count, "
        f"cast({bad} as bigint) as null_count, case when not ({passed}) then {message} end as error_message "
        f"from {source}"
    )


@register(
    "q1_row_count",
    check_sql("'row_count'", "0", "n", "'Expected min 1000000000 rows, got ' || n",
              "(select count(*) as n from lineitem) t", "n >= 1000000000"),
)
def q1_row_count(spark, sf_dir):
    return quality.check_row_count(table(spark, sf_dir, "lineitem"), minimum=1_000_000_000)


MISSING_SQL = check_sql(
    "'missing_values'", "bad", "n", "'Found ' || bad || ' null values in required columns'",
    "(select count(*) as n, count(*) filter (close_price is null) + count(*) filter (market is null) + count(*) as bad"
    " from gappy) t",
)


@register("q2_missing_values", GAPPY_SQL + MISSING_SQL)
def q2_missing_values(spark, sf_dir):
    return quality.check_missing_values(gappy(spark, sf_dir), required=["close_price", "market", "grade"])


DUPLICATE_SQL = check_sql(
    "'duplicates'", "bad", "n", "'Found ' || bad || ' duplicate records'",
    "(select count(*) as n, count(*) - count(distinct row(l_orderkey, l_linenumber)) as bad from lineitem) t",
)


@register("q3_duplicates", DUPLICATE_SQL)
def q3_duplicates(spark, sf_dir):
    return quality.check_duplicates(table(spark, sf_dir, "lineitem"), keys=["l_orderkey", "l_linenumber"])


RANGE_SQL = check_sql(
    "'anomalies_close_price'", "bad", "n", "'Found ' || bad || ' anomalies in close_price'",
    "(select count(*) as n, count(*) filter (close_price < 100 or close_price > 5000) as bad from gappy) t",
)


@register("q4_range", GAPPY_SQL + RANGE_SQL)
def q4_range(spark, sf_dir):
    return quality.check_range(gappy(spark, sf_dir), column="close_price", low=100, high=5000)


STD_SQL = check_sql(
    "'anomalies_close_price'", "bad", "n", "'Found ' || bad || ' anomalies in close_price'",
    "(select count(*) as n, count(*) filter (abs(close_price - m) / nullif(s, 0) > 2) as bad from gappy g join ("
    "select commodity, avg(close_price) as m, stddev_pop(close_price) as s from gappy group by 1) k"
    " on g.commodity = k.commodity) t",
)


@register("q5_std_dev", GAPPY_SQL + STD_SQL)
def q5_std_dev(spark, sf_dir):
    return quality.check_std_dev(gappy(spark, sf_dir), column="close_price", keys=["commodity"], threshold=2.0)


@register(
    "q5_std_dev_overall",
    GAPPY_SQL + check_sql(
        "'anomalies_close_price'", "bad", "n", "'Found ' || bad || ' anomalies in close_price'",
        "(select count(*) as n, count(*) filter (abs(close_price - m) / nullif(s, 0) > 2) as bad from gappy, ("
        "select avg(close_price) as m, stddev_pop(close_price) as s from gappy) k) t",
    ),
)
def q5_std_dev_overall(spark, sf_dir):
    return quality.check_std_dev(gappy(spark, sf_dir), column="close_price", threshold=2.0)


def sample_checks(spark, sf_dir):
    rows = gappy(spark, sf_dir)
    return [
        quality.check_row_count(rows, minimum=1),
        quality.check_missing_values(rows, required=["close_price", "market", "grade"]),
        quality.check_duplicates(table(spark, sf_dir, "lineitem"), keys=["l_orderkey", "l_linenumber"]),
        quality.check_range(rows, column="close_price", low=100, high=5000),
    ]


CHECKS_SQL = GAPPY_SQL + ", checks as (" + " union all ".join([
    check_sql("'row_count'", "0", "n", "'Expected min 1 rows, got ' || n", "(select count(*) as n from gappy) t", "n >= 1"),
    MISSING_SQL, DUPLICATE_SQL, RANGE_SQL,
]) + ")"


@register(
    "q6_quality_report",
    CHECKS_SQL + """
    select 'prices' as source, count(*) filter (passed) as checks_passed, count(*) filter (not passed) as checks_failed,
      case when bool_and(passed) then 'PASSED' else 'FAILED' end as overall_status,
      string_agg(check_name, ',' order by check_name) filter (passed) as passed_names,
      string_agg(check_name || ':' || null_count, ',' order by check_name) filter (not passed) as failed_names
    from checks""",
)
def q6_quality_report(spark, sf_dir):
    report = quality.quality_report(quality.union_checks(sample_checks(spark, sf_dir)), source="prices")
    return report.select(
        "source", "checks_passed", "checks_failed", "overall_status",
        F.array_join(F.transform("passed_checks", lambda c: c["name"]), ",").alias("passed_names"),
        F.array_join(
            F.transform("failed_checks", lambda c: F.concat(c["name"], F.lit(":"), c["nulls"].cast("string"))), ","
        ).alias("failed_names"),
    )


@register(
    "q7_schema_errors",
    GAPPY_SQL + """, n as (select count(*) as rows, count(*) filter (close_price is null) as p,
      count(*) filter (commodity is not null) as c from gappy)
    select 'grade' as column_name, 'Missing required column' as issue, cast(1 as bigint) as violations from n where rows > 0
    union all select 'grade', 'Non-nullable column is missing', rows from n where rows > 0
    union all select 'close_price', 'Non-nullable column is null', p from n where p > 0
    union all select 'commodity', 'Not a float', c from n where c > 0""",
)
def q7_schema_errors(spark, sf_dir):
    schema = {
        "date": {"type": "date"}, "close_price": {"type": "float"}, "grade": {"type": "string"},
        "commodity": {"type": "float"}, "currency": {"type": "string", "nullable": True},
    }
    return quality.schema_errors(gappy(spark, sf_dir), schema)


@register(
    "q8_range_violations",
    GAPPY_SQL + f"""
    select {ID_SQL}, 'close_price' as "column", close_price as value, cast(150 as double) as min_allowed,
      cast(null as double) as max_allowed, 'below_minimum' as issue from gappy where close_price < 150
    union all select {ID_SQL}, 'close_price', close_price, null, 9000, 'above_maximum' from gappy where close_price > 9000
    union all select {ID_SQL}, 'volume', volume, null, 45, 'above_maximum' from gappy where volume > 45""",
)
def q8_range_violations(spark, sf_dir):
    rules = {"close_price": {"min": 150, "max": 9000}, "volume": {"max": 45}}
    return quality.range_violations(gappy(spark, sf_dir), rules=rules, row_key=ID)


@register(
    "q9_freshness",
    """select event_type as source, max(ts) as last_seen, max(ts) >= timestamp '2024-01-30 20:00:00' as is_fresh
       from events group by event_type""",
)
def q9_freshness(spark, sf_dir):
    as_of = F.lit("2024-01-31 20:00:00").cast("timestamp_ntz")
    return quality.check_freshness(table(spark, sf_dir, "events"), source="event_type", timestamp="ts", as_of=as_of)


@register(
    "q10_completeness",
    GAPPY_SQL + ", t as (select count(*) as n, count(*) filter (close_price is null) as bad from gappy) "
    + check_sql("'missing_values'", "bad", "n", "'Found ' || bad || ' null values in required columns'", "t")
    + " union all "
    + check_sql("'expected_market'", "bad", "n", "'Missing ' || bad || ' expected values of market'",
                "(select count(*) as n, count(*) filter (r_name not in (select market from gappy)) as bad from region) r"),
)
def q10_completeness(spark, sf_dir):
    markets = table(spark, sf_dir, "region").select(F.col("r_name").alias("market"))
    return quality.check_completeness(
        gappy(spark, sf_dir), required=["close_price"], expected={"market": markets}
    )


@register(
    "q11_duplicate_keys",
    """select l_orderkey, l_linenumber, count(*) as row_count from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1""",
)
def q11_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), keys=["l_orderkey", "l_linenumber"])


def fk_sql(column: str, fact: str, dim: str, key: str) -> str:
    return check_sql(
        f"'fk_{column}'", "bad", "n", f"'Found ' || bad || ' rows without a match for {column}'",
        f"(select count(*) as n, count(*) filter ({column} is null or {column} not in (select {key} from {dim})) as bad"
        f" from {fact}) t_{column}",
    )


@register(
    "q12_referential",
    " union all ".join([
        fk_sql("l_orderkey", "lineitem", "(select * from orders where o_orderstatus <> 'P')", "o_orderkey"),
        fk_sql("l_partkey", "lineitem", "part", "p_partkey"),
        fk_sql("l_suppkey", "lineitem", "supplier", "s_suppkey"),
    ]),
)
def q12_referential(spark, sf_dir):
    return quality.referential_orphans(
        table(spark, sf_dir, "lineitem"),
        {
            "l_orderkey": (table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'"), "o_orderkey"),
            "l_partkey": (table(spark, sf_dir, "part"), "p_partkey"),
            "l_suppkey": (table(spark, sf_dir, "supplier"), "s_suppkey"),
        },
    )


SPIKE_WINDOW = "partition by commodity, market order by date rows between 30 preceding and 1 preceding"


@register(
    "q13_price_spikes",
    WITH_DAILY + f""", moved as (
      select date, commodity, market, close_price, volume,
        (close_price - lag(close_price) over s) / nullif(lag(close_price) over s, 0) * 100 as price_change_pct
      from daily window s as (partition by commodity, market order by date)),
    scored as (
      select *, stddev_pop(price_change_pct) over w as volatility,
        case when count(price_change_pct) over w = 30 then (price_change_pct - avg(price_change_pct) over w)
          / nullif(stddev_pop(price_change_pct) over w, 0) end as price_zscore,
        case when count(volume) over w = 30 then (volume - avg(volume) over w)
          / nullif(stddev_pop(volume) over w, 0) end as volume_zscore
      from moved window w as ({SPIKE_WINDOW}))
    select date, commodity, market, close_price, volume, {sql_stable("price_change_pct")} as price_change_pct,
      {sql_stable("volatility")} as volatility, {sql_stable("price_zscore")} as price_zscore,
      {sql_stable("volume_zscore")} as volume_zscore, coalesce(abs(price_zscore) > 3, false) as is_price_spike,
      coalesce(abs(volume_zscore) > 3, false) as is_volume_spike
    from scored""",
)
def q13_price_spikes(spark, sf_dir):
    rows = daily(spark, sf_dir).select("date", *SERIES, "close_price", "volume")
    out = quality.price_spikes(rows, keys=SERIES, order_by=["date"], series_rows=CALENDAR_ROWS)
    return stabled(out, "price_change_pct", "volatility", "price_zscore", "volume_zscore")


@register(
    "q14_data_ranges",
    GAPPY_SQL + ", n as (select count(*) as rows, count(*) filter (close_price <= 0) as a,"
    " count(*) filter (volume < 0 or volume > 45) as b from gappy) "
    + check_sql("'range_close_price'", "a", "rows", "'Found ' || a || ' values out of range in close_price'", "n")
    + " union all "
    + check_sql("'range_volume'", "b", "rows", "'Found ' || b || ' values out of range in volume'", "n"),
)
def q14_data_ranges(spark, sf_dir):
    return quality.check_ranges(
        gappy(spark, sf_dir), rules={"close_price": {"above": 0}, "volume": {"min": 0, "max": 45}}
    )


@register(
    "q15_daily_report",
    CHECKS_SQL + """
    select count(*) as checks, count(*) filter (not passed) as failed,
      case when bool_and(passed) then 'PASSED' else 'FAILED' end as overall_status,
      not bool_and(passed) as alert_needed from checks""",
)
def q15_daily_report(spark, sf_dir):
    return quality.daily_quality_report(sample_checks(spark, sf_dir))


@register(
    "q16_integrity_checks",
    """select 'no_orphan_parts' as check_name, cast(n as varchar) as actual, '0' as expected, n = 0 as passed
       from (select count(*) as n from lineitem where l_partkey not in (select p_partkey from part)) t
       union all select 'regions', cast(n as varchar), '4', n = 4 from (select count(*) as n from region) r
       union all select 'broken', null, '0', false""",
)
def q16_integrity_checks(spark, sf_dir):
    for name in ("lineitem", "part", "region"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return quality.run_integrity_checks(
        spark,
        [
            {
                "name": "no_orphan_parts",
                "query": "SELECT count(*) FROM lineitem LEFT ANTI JOIN part ON l_partkey = p_partkey",
                "expected": 0,
            },
            {"name": "regions", "query": "SELECT count(*) FROM region", "expected": 4},
            {"name": "broken", "query": "SELECT count(*) FROM nowhere", "expected": 0},
        ],
    )


@register(
    "q17_missing_dates",
    WITH_PRICES + """, days as (
      select cast(unnest(generate_series(date '1996-01-01', date '1996-12-31', interval 1 day)) as date) as date),
    series as (select distinct commodity, market from prices)
    select commodity, market, days.date from series, days
    where not exists (select 1 from prices p where p.commodity = series.commodity and p.market = series.market
      and p.date = days.date)""",
)
def q17_missing_dates(spark, sf_dir):
    start, end = (F.lit(d).cast("date") for d in ("1996-01-01", "1996-12-31"))
    return quality.missing_dates(prices(spark, sf_dir), keys=SERIES, date="date", start=start, end=end)


@register(
    "q17_backfill_summary",
    WITH_PRICES + """, series as (select distinct commodity, market from prices union all values ('NONE YET', 'ASIA'))
    select s.commodity, s.market, count(p.date) as row_count, count(distinct p.date) as days_present,
      366 - count(distinct p.date) as days_missing
    from series s left join prices p on s.commodity = p.commodity and s.market = p.market
      and p.date between date '1996-01-01' and date '1996-12-31' group by 1, 2""",
)
def q17_backfill_summary(spark, sf_dir):
    start, end = (F.lit(d).cast("date") for d in ("1996-01-01", "1996-12-31"))
    rows = prices(spark, sf_dir)
    awaited = spark.createDataFrame([("NONE YET", "ASIA")], "commodity string, market string")
    expected = rows.select(*SERIES).distinct().unionByName(awaited)
    return quality.backfill_summary(rows, keys=SERIES, date="date", start=start, end=end, expected=expected)
