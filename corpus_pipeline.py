"""From raw documents to sharded training text: five stages, each on all that the one before it kept.

All stages decide by row and carry a row's columns as one struct, so a column of any name comes through unchanged. Null
and empty texts have no n-grams, words or windows: they are kept unless their weight is below the cut of the first stage.
Null doc_ids and repeated rows are taken (near_duplicates keeps one row of equal texts with words, ties by doc_id, then
hash of the text, then of the row). An empty table stays empty. Texts are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import free_name, saved, table, whole_row
from pricelake.llm.decontaminate import keep_clean
from pricelake.llm.jaccard_join import keep_one
from pricelake.llm.mixing import WEIGHTS, domain, mix
from pricelake.llm.quality_resampling import keep_sampled
from pricelake.llm.sharding import shard_by_bytes


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps; without labelled good rows all stay."""
    return keep_sampled(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; texts without words have none."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; an empty benchmark removes none."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' seeded prefixes under the target weights; a single epoch, so that no document comes twice.

    A null language or source is a leaf of its own; texts without words are taken with what lies beside them.
    """
    told = docs.select(whole_row(docs).alias("row"), "doc_id", "text", "lang", "source", domain(F.col("source")).alias("domain"))
    return mix(told, ("domain", "lang", "source"), WEIGHTS, max_epochs=1).select("row.*")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with size, text_crc32, shard and slot; a name that a document has itself gets an underscore behind it."""
    told = shard_by_bytes(docs.select(whole_row(docs).alias("row"), "doc_id", "text"))
    added = [F.col(c).alias(free_name(c, docs.columns)) for c in ("size", "text_crc32", "shard", "slot")]
    return told.select("row.*", *added)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mixed),
    ("shard", shards),
]

#: The draw of the first stage rests on hashes and logarithms that SQL engines do not share.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
