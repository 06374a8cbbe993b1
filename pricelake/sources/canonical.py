"""The driver's relational tables seen as commodity price data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Total order of price rows inside a day: the date plus every identifying column.
PRICE_ORDER = ["date", "order_id", "part_id", "supplier_id", "line_no", "volume", "amount"]
TIE_BREAK = PRICE_ORDER[1:]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price facts: line items with their part (commodity) and supplier region (market)."""
    # one dimension at a time, so that each table's own size decides how it is joined
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    region = F.col("r_regionkey") % 3
    size = F.col("p_size") % 5
    close = F.floor(F.floor(F.col("l_extendedprice") * 100 + 0.5) / F.col("l_quantity")) / 100
    return lines.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("p_type").alias("commodity"),
        F.col("r_name").alias("market"),
        F.col("l_returnflag").alias("source"),
        F.when(region == 0, "USD").when(region == 1, "EUR").otherwise("UAH").alias("currency"),
        F.when(size == 0, "ton").when(size == 1, "TONNE").when(size == 2, "bushel")
        .when(size == 3, "kg").otherwise("sack").alias("unit"),
        close.alias("close_price"),
        (close * (1 + F.col("l_tax"))).alias("high_price"),
        (close * (1 - F.col("l_discount"))).alias("low_price"),
        (close * (1 + F.col("l_tax") / 2)).alias("open_price"),
        F.col("l_quantity").alias("volume"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_extendedprice").alias("amount"),
    )
