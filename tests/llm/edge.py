"""Awkward documents that every operator has to take, and small reference helpers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, weight double, row string, shard int, key string, gone long"

LONG = " ".join(f"w{i % 997}" for i in range(60_000))


def edge_rows() -> list[tuple]:
    texts = [
        (1, None, None), (2, "", "en"), (3, " \t\n ", "en"), (4, "one", "en"), (5, LONG, "en"), (6, "one two three four five six", None),
        (6, "one two three four five six", None), (7, "one two three four five six", "de"), (None, "a text without an id", "en"),
        (8, "1234 5678", "fr"), (9, "émigré ñandú 漢字 😀 naïve", "fr"),
    ]
    return [(i, t, lang, None if i == 4 else "src1", None, 1, 0.5, "r", 3, "k", 9) for i, t, lang in texts]


def edge_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(edge_rows(), SCHEMA)


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession, rows: list[tuple[int, str | None]]) -> DataFrame:
    return spark.createDataFrame([(i, t, "en", "src0", None, 1, 0.5, "r", 3, "k", 9) for i, t in rows], SCHEMA)
