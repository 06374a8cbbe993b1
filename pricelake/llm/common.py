"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.session import checkpoint_dir, checkpointed, scratch_path

__all__ = [
    "BROADCAST_ROWS", "WORD", "SPACE", "checkpointed", "checkpoint_dir", "cut_out", "free_name", "running_sums", "scratch_path", "saved", "sha_hex", "shipped", "sized", "table",
    "whole_row", "without_rows",
]

WORD = r"[^\x20\x09-\x0D]+"
#: Most rows of one or two numbers that are sent to every executor (some 32 MB).
BROADCAST_ROWS = 1_000_000
SPACE = r"[\x20\x09-\x0D]+"


def shipped(module: str) -> None:
    """Pickle the functions of a module by value, so executors need no copy of this package."""
    for name in (__name__, module, "pricelake.llm.textops"):
        if name in sys.modules:
            cloudpickle.register_pickle_by_value(sys.modules[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(side: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written side of a join with the fitting hint: broadcast up to so many rows, shuffled beyond."""
    return side.hint("broadcast" if side.count() <= most else "merge")


def sha_hex(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, so that no name of theirs meets a name used here."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns))


def without_rows(docs: DataFrame, gone: DataFrame, text_hash: Column) -> DataFrame:
    """The rows of docs, all columns untouched, whose (doc_id, text_hash) is not among those of a written frame."""
    keyed = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_hash.alias("text_hash")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.text_hash") == F.col("g.text_hash"))
    return keyed.join(sized(gone).alias("g"), same, "left_anti").select("row.*")


def free_name(name: str, taken: list[str]) -> str:
    """The name, with underscores behind it while it is taken (in any case of its letters)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def running_sums(values: Column) -> Column:
    """Sums up to each place of an array of whole numbers, by doubling the reach: n log n steps, not n squared."""

    def reach(sums: Column, step: Column) -> Column:
        by = F.least(F.pow(F.lit(2), step).cast("int"), F.size(sums))
        shifted = F.concat(F.array_repeat(F.lit(0).cast("long"), by), F.slice(sums, 1, F.size(sums) - by))
        return F.zip_with(sums, shifted, lambda a, b: a + b)

    longs = F.transform(values, lambda v: v.cast("long"))
    steps = F.sequence(F.lit(0), F.length(F.bin(F.size(values).cast("long"))) - 1)
    return F.when(F.size(values) > 1, F.aggregate(steps, longs, reach)).otherwise(longs)


_BLOCK = 4096


def cut_out(text: Column, spans: Column, body: Callable[[Column], Column] = lambda x: x) -> Column:
    """body(text under the span) for each struct<start, length> in code points.

    The text is cut into blocks once, so a span walks over its own blocks and not over all that lies before it.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))

    def one(own: Column, s: Column) -> Column:
        first, last = F.floor(s["start"] / _BLOCK), F.floor((s["start"] + F.greatest(s["length"], F.lit(1)) - 1) / _BLOCK)
        part = F.array_join(F.slice(own, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
        return F.when(s["length"] > 0, F.substr(part, (s["start"] % _BLOCK + 1).cast("int"), s["length"].cast("int"))).otherwise(F.lit(""))

    return F.element_at(F.transform(F.array(blocks), lambda own: F.transform(spans, lambda s: body(one(own, s)))), 1)
