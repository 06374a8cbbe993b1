"""Contiguous shards of near-equal bytes.

Rows get one global order and are dealt into ranges of it; per-range byte totals give each range the bytes that
lie before it, a running sum inside the range gives each row's global offset, and the offsets are cut at equal
targets. DataFrame operations only.

The order is doc_id, then CRC-32 and size of the text, then the row's position in the input, so a doc_id or a
text that a large share of the rows has is spread over ranges like any other.

Edge cases: null text counts as no bytes (size 16) and has CRC-32 0; a null doc_id comes first. Equal rows lie
side by side, in an order without consequence for the result. An empty table gives an empty result; with fewer
rows than shards some shards stay empty. A row lies in the shard in which its middle byte falls, so one huge
row fills its shard alone. Columns named like those added here are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.llm.common import saved, table
from pricelake.plans.registry import register

SHARDS = 40
ROW_BYTES = 16


def measured(docs: DataFrame, row_bytes: int = ROW_BYTES) -> DataFrame:
    return docs.withColumn("size", (F.coalesce(F.octet_length("text"), F.lit(0)) + row_bytes).cast("long")).withColumn(
        "text_crc32", F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long")
    )


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, row_bytes: int = ROW_BYTES, is_measured: bool = False) -> DataFrame:
    """The rows with size, text_crc32, shard and slot (gapless from 0 inside each shard).

    Rows that are measured already need no text and move without it.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sized_rows = docs if is_measured else measured(docs, row_bytes)
    others = [c for c in sized_rows.columns if c not in ("size", "text_crc32", "shard", "slot")]
    placed = sized_rows.select(
        F.struct(*others).alias("row"), F.col("doc_id").alias("id"), "text_crc32", "size", F.monotonically_increasing_id().alias("row_place")
    )
    order = ["id", "text_crc32", "size", "row_place"]
    dealt = saved(placed.repartitionByRange(ranges, *order).withColumn("range_no", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("range_no").agg(F.sum("size").alias("bytes"))
    ahead = W.orderBy("range_no").rowsBetween(W.unboundedPreceding, -1)
    # One row per range: their number is a setting, not a property of the data.
    before = totals.select("range_no", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("before"), F.sum("bytes").over(W.partitionBy()).alias("total"))
    before = saved(before, "before")
    # The cuts need no texts: a narrow copy counts the rows of each shard in each range.
    inside = W.partitionBy("range_no").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)

    def cut(rows: DataFrame) -> DataFrame:
        told = rows.join(F.broadcast(before), "range_no").withColumn("end", F.col("before") + F.sum("size").over(inside))
        return told.withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"cast((2 * end - size) * {shards} div (2 * total) as int)")))

    # Per range and shard one row: at most shards + ranges of them hold rows.
    counts = cut(dealt.select("range_no", *order)).groupBy("range_no", "shard").agg(F.count("*").alias("n"))
    ahead = W.partitionBy("shard").orderBy("range_no").rowsBetween(W.unboundedPreceding, -1)
    starts = saved(counts.select("range_no", "shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start")), "starts")
    own = W.partitionBy("range_no", "shard").orderBy(*order)
    ranked = cut(dealt).withColumn("rank_here", F.row_number().over(own) - 1)
    return ranked.join(F.broadcast(starts), ["range_no", "shard"]).select(
        "row.*", "size", "text_crc32", "shard", (F.col("start") + F.col("rank_here")).cast("long").alias("slot")
    )


@register("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measured(table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32")
    return shard_by_bytes(rows, is_measured=True).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
