"""Array helpers against plain loops."""

from __future__ import annotations

import itertools
import random

from pyspark.sql import functions as F

from pricelake.llm.common import cut_out, free_name, running_sums


def test_running_sums(spark):
    rows = [list(range(n)) for n in (0, 1, 2, 3, 4, 5, 31, 32, 33, 1000)] + [[5, -7, 2**40]]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v array<long>").select("i", running_sums(F.col("v")).alias("s"))
    assert {r["i"]: r["s"] for r in frame.collect()} == {i: list(itertools.accumulate(r)) for i, r in enumerate(rows)}
    none = spark.createDataFrame([(None,)], "v array<long>").select(running_sums(F.col("v")).alias("s")).first()
    assert none["s"] is None


def test_cut_out_over_blocks(spark):
    draw = random.Random(1)
    text = "".join(draw.choice("ab\n é漢😀") for _ in range(20_000))
    spans = [(draw.randrange(19_000), draw.randrange(9_000)) for _ in range(60)] + [(0, 20_000), (4095, 2), (4096, 1), (19_999, 1), (20_000, 0), (8192, 4096)]
    frame = spark.createDataFrame([(text, spans)], "t string, s array<struct<start: int, length: int>>")
    assert frame.select(cut_out(F.col("t"), F.col("s")).alias("c")).first()["c"] == [text[a:a + n] for a, n in spans]


def test_free_name():
    assert free_name("size", ["Size", "size_"]) == "size__" and free_name("size", []) == "size"
