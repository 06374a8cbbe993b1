"""Registry of named queries with the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def half(digits: int) -> float:
    return 0.5 + 1e-9 * 10.0**digits


def stable(value: Column | str, digits: int = 4) -> Column:
    """Round for comparison with the same three operations in both engines.

    The hair above one half keeps exact ties from depending on summation order.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.floor(column * 10.0**digits + half(digits)) / 10.0**digits


def stabled(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: stable(n, digits) for n in names})


def sql_stable(expression: str, digits: int = 4) -> str:
    return f"floor(cast({expression} as double) * 1e{digits} + {half(digits)!r}) / 1e{digits}"


# Price facts as SQL, column for column what pricelake.sources.canonical.prices builds.
PRICES_SQL = """
prices as (
  select cast(l_shipdate as date) as date, p_type as commodity, r_name as market, l_returnflag as source,
    case r_regionkey % 3 when 0 then 'USD' when 1 then 'EUR' else 'UAH' end as currency,
    case p_size % 5 when 0 then 'ton' when 1 then 'TONNE' when 2 then 'bushel' when 3 then 'kg'
      else 'sack' end as unit,
    floor(floor(l_extendedprice * 100 + 0.5) / l_quantity) / 100 as close_price,
    floor(floor(l_extendedprice * 100 + 0.5) / l_quantity) / 100 * (1 + l_tax) as high_price,
    floor(floor(l_extendedprice * 100 + 0.5) / l_quantity) / 100 * (1 - l_discount) as low_price,
    floor(floor(l_extendedprice * 100 + 0.5) / l_quantity) / 100 * (1 + l_tax / 2) as open_price,
    l_quantity as volume, l_orderkey as order_id, l_partkey as part_id, l_suppkey as supplier_id,
    l_linenumber as line_no, l_extendedprice as amount
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
)"""
ORDER_SQL = "date, order_id, part_id, supplier_id, line_no, volume, amount"
TIE_SQL = "order_id, part_id, supplier_id, line_no, volume, amount"

DAILY_SQL = f"""
daily as (
  select date, commodity, market,
    arg_min(close_price, row({ORDER_SQL})) as open_price, max(close_price) as high_price,
    min(close_price) as low_price, arg_max(close_price, row({ORDER_SQL})) as close_price,
    coalesce(sum(volume), 0) as volume, count(close_price) as record_count,
    count(distinct source) as source_count
  from prices group by date, commodity, market
)"""
WITH_PRICES = f"with {PRICES_SQL}"
WITH_DAILY = f"with {PRICES_SQL}, {DAILY_SQL}"
