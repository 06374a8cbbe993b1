"""Registered queries against SQL, and the pipeline's stages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import pricelake.llm.queries  # noqa: F401
from pricelake.plans.registry import ORACLES, QUERIES
from tests.oracle import connect, duck_rows, spark_rows, type_mismatches

OPERATORS = sorted(n for n in QUERIES if n.startswith("op") and n[2:3].isdigit())


def test_there_is_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in OPERATORS) == list(range(1, len(OPERATORS) + 1))


@pytest.mark.parametrize("name", [n for n in OPERATORS if n in ORACLES])
def test_query_equals_sql(spark, sf_dir, name):
    duck = connect(sf_dir)
    frame = QUERIES[name](spark, sf_dir)
    columns, rows = spark_rows(frame)
    assert (columns, rows) == duck_rows(duck, ORACLES[name])
    assert type_mismatches(frame, duck, ORACLES[name]) == []


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "shard"]
    seen, columns = {r["doc_id"] for r in docs.collect()}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.saved(stage(spark, docs, sf_dir), name)
        ids = [r["doc_id"] for r in out.select("doc_id").collect()]
        assert ids and len(ids) == len(set(ids)) and set(ids) <= seen
        if name != "shard":
            assert out.columns == columns
            assert name == "mix" or len(ids) >= 0.8 * len(seen)
        seen, docs = set(ids), out
    assert corpus_pipeline.run(spark, sf_dir).count() == len(seen)


def test_pipeline_takes_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id is null")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []


def test_pipeline_carries_any_column_nulls_and_repeated_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = ["__id", "__text", "__gone_id", "__domain", "n_tokens", "epoch", "size", "text_crc32", "shard", "slot", "row", "key", "text_hash", "d.x", "domain"]
    told = docs.unionByName(docs.limit(30)).unionByName(docs.limit(10).withColumn("doc_id", F.lit(None).cast("long")))
    told = told.unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string")))
    told = told.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in extra})
    columns, told = told.columns, corpus_pipeline.saved(told, "told")
    known = {tuple(r) for r in told.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, told, sf_dir)
        assert out.columns[:len(columns)] == columns and (name == "shard" or out.columns == columns)
        told = corpus_pipeline.saved(out, name)
        rows = [tuple(r)[:len(columns)] for r in told.collect()]
        assert rows and set(rows) <= known
        known = set(rows)
    assert told.columns[len(columns):] == ["size_", "text_crc32_", "shard_", "slot_"]
