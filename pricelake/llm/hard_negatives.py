"""Hard negatives by Kronecker-packed products.

Vectors become integers. Several candidates' components, biased to be non-negative, lie in separated fields of one 64-bit
integer, so one multiplication by an anchor's component serves all of them, and the sum over the components holds their
inner products side by side. Fields are as wide as the largest product in sight can be (by the norms of the vectors at
hand), so nothing runs over and the scores that are unpacked are exact.

The work is a grid: anchors are dealt into groups of ANCHORS, candidates into blocks of BLOCK rows and blocks into slices of
SLICE; a cell holds one group and one slice, whatever the labels. A first pass keeps each anchor's best rows of its label
per cell, a second one the best rows of other labels inside each positive's band of scores; both are merged by rank.

Edge cases: rows with a null label, vector, or component, or a component that is not finite, take no part. Shorter vectors
count as padded with zeros; an empty vector scores 0 with all. Rows count by place, not by vec_id: a repeated row is another
row with the same vec_id, and a repeated anchor returns its rows again. A null vec_id is no anchor and comes last among
ties. An anchor without positives, or a positive without negatives, returns nothing. Scores have to stay under 2^50 in
size (ArithmeticError beyond). Extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.llm.common import saved, shipped, table
from pricelake.plans.registry import register

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score between which a negative's lies.
LOW, HIGH = 30, 90
BLOCK, ANCHORS, SLICE = 2048, 4096, 16
#: Anchors that meet a block together.
_STRIP = 128
_NONE = np.iinfo(np.int64).min

BLOCKS = "block long, dim int, ids array<long>, labels array<long>, anchors array<boolean>, components binary"
ANCHOR = "struct<block:long,place:int,id:long,label:long,vector:array<long>>"


def packed_products(candidates: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """(anchors x candidates) exact inner products of integer rows.

    A field is `width` bits: a biased candidate times an anchor sums to less than 2^(width-1) in size. Adding that much to
    each field after the sum makes all fields non-negative, so they can be cut apart; the bias is taken off again.
    """
    if not candidates.size or not anchors.size:
        return np.zeros((len(anchors), len(candidates)), np.int64)
    bias = int(candidates.min())
    raised = candidates - bias
    top, most = int(raised.max()), int(np.abs(anchors).max())
    left, right, plain = (float(np.sqrt((x.astype(float) ** 2).sum(1).max())) for x in (raised, anchors, candidates))
    bound = int(min(left * right, float(raised.shape[1]) * top * most) * (1 + 1e-9)) + 2  # no inner product is larger
    if max(bound, plain * right) >= 1 << 50:
        raise ArithmeticError("components are too large for exact scores in 64 bits")
    width = bound.bit_length() + 1
    fields = 64 // width
    words = -(-len(candidates) // fields)
    padded = np.zeros((fields * words, candidates.shape[1]), np.uint64)
    padded[:len(candidates)] = raised
    packed = np.zeros((candidates.shape[1], words), np.uint64)
    for k in range(fields):
        packed |= padded[k * words:(k + 1) * words].T << np.uint64(k * width)
    sums = np.full((len(anchors), words), sum((1 << (width - 1)) << (k * width) for k in range(fields)), np.uint64)
    factors = anchors.astype(np.int64).view(np.uint64)
    for d in range(candidates.shape[1]):
        sums += factors[:, d:d + 1] * packed[d]  # all fields at once, modulo 2^64
    mask = np.uint64((1 << width) - 1)
    out = np.concatenate([(sums >> np.uint64(k * width)) & mask for k in range(fields)], 1)[:, :len(candidates)].astype(np.int64)
    return out - (1 << (width - 1)) + bias * anchors.sum(1)[:, None]


def _packer(scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of BLOCKS: at most BLOCK usable rows each, ordered by vec_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                ids, labels, vectors, anchors = (part.column(n) for n in ("vec_id", "label", "vector", "anchor"))
                sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)  # nulls become NaN
                owner = np.repeat(np.arange(len(sizes)), sizes)
                broken = np.bincount(owner, weights=~np.isfinite(flat), minlength=len(sizes)) > 0
                good = ~broken & vectors.is_valid().to_numpy(zero_copy_only=False) & labels.is_valid().to_numpy(zero_copy_only=False)
                dim = int(sizes[good].max()) if good.any() else 0
                dense = np.zeros((len(sizes), dim), np.int64)
                some = good[owner]
                place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                whole = np.floor(flat[some] * scale)
                if len(whole) and np.abs(whole).max() >= 2.0**50:
                    raise ArithmeticError("components are too large for exact scores in 64 bits")
                dense[owner[some], place[some]] = whole.astype(np.int64)
                order = np.lexsort((ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)))
                order = order[good[order]]
                if len(order):
                    take = pa.array(order)
                    rows = ([x] for x in (dim, ids.take(take).to_pylist(), labels.take(take).to_pylist(), anchors.take(take).to_pylist(), dense[order].tobytes()))
                    types = (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary())
                    yield pa.record_batch([pa.array(x, t) for x, t in zip(rows, types)], names=["dim", "ids", "labels", "anchors", "components"])

    return run


def _fit(matrix: np.ndarray, dim: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, dim - matrix.shape[1])))


def _met(left: pa.Table, right: pa.Table) -> Iterator[tuple]:
    """(anchor structs, their vectors, block, candidate ids, labels, components) of a cell, strip by strip."""
    for group in left.column("anchors").to_pylist():
        for row in range(right.num_rows):
            own = {n: right.column(n)[row].as_py() for n in ("block", "dim", "ids", "components")}
            labels = np.array(right.column("labels")[row].as_py(), np.int64)
            values = np.frombuffer(own["components"], np.int64).reshape(len(labels), own["dim"])
            for at in range(0, len(group), _STRIP):
                strip = group[at:at + _STRIP]
                dim = max([own["dim"], *(len(a["vector"]) for a in strip)])
                vectors = np.zeros((len(strip), dim), np.int64)
                for i, a in enumerate(strip):
                    vectors[i, :len(a["vector"])] = a["vector"]
                yield strip, vectors, own["block"], own["ids"], labels, _fit(values, dim)


def _ranked(strip: list[dict], vectors: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Scores times BLOCK, plus the more the smaller the vec_id: one number to rank by."""
    return packed_products(values, vectors) * BLOCK + (BLOCK - 1 - np.arange(len(values)))


def _positives(most: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for strip, vectors, block, ids, labels, values in _met(left, right):
            keys = _ranked(strip, vectors, values)
            keys[labels[None, :] != np.array([a["label"] for a in strip])[:, None]] = _NONE
            for i, a in enumerate(strip):
                if a["block"] == block:
                    keys[i, a["place"]] = _NONE  # the anchor itself
            few = -np.sort(-np.partition(keys, -most, 1)[:, -most:] if keys.shape[1] > most else -keys, 1)
            for a, own in zip(strip, few.tolist()):
                out += [(a["block"], a["place"], ids[BLOCK - 1 - k % BLOCK], k // BLOCK) for k in own if k != _NONE]
        return _table(out, ["block", "place", "positive_id", "positive_score"])

    return run


def _negatives(most: int, low: int, high: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for strip, vectors, _, ids, labels, values in _met(left, right):
            keys = _ranked(strip, vectors, values)
            keys[labels[None, :] == np.array([a["label"] for a in strip])[:, None]] = _NONE
            keys.sort(1)
            for a, row in zip(strip, keys):
                for place, score in enumerate(a["positives"], 1):
                    least, top = -(-low * score // 100), high * score // 100
                    end = int(np.searchsorted(row, (top + 1) * BLOCK))
                    begin = max(end - most, int(np.searchsorted(row, max(least * BLOCK, _NONE + 1))))
                    out += [(a["block"], a["place"], place, ids[BLOCK - 1 - k % BLOCK], k // BLOCK) for k in row[begin:end].tolist()]
        return _table(out, ["block", "place", "positive", "negative_id", "negative_score"])

    return run


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def mine(
    embeddings: DataFrame, id_column: str, vector: str, label: str, anchor: str, scale: int = SCALE, positives: int = POSITIVES,
    negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """(anchor_id, positive_id, positive, rank, negative_id, positive_score, negative_score) of the rows whose anchor is true.

    `positive` numbers an anchor's positives from 1.
    """
    shipped(__name__)
    told = embeddings.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"), (F.col(anchor) & F.col(id_column).isNotNull()).alias("anchor"),
    )
    blocks = told.mapInArrow(_packer(scale), BLOCKS.removeprefix("block long, ")).withColumn("block", F.monotonically_increasing_id())
    blocks = saved(blocks.select("block", "dim", "ids", "labels", "anchors", "components"), "blocks")

    counted = blocks.agg(F.count("*").alias("blocks"), F.sum(F.size(F.filter("anchors", lambda a: a))).alias("anchors")).first()
    groups, slices = max(1, -(-(counted["anchors"] or 0) // ANCHORS)), max(1, -(-counted["blocks"] // SLICE))
    vectors = blocks.select("block", "ids", "labels", "dim", "components", "anchors").mapInArrow(_anchor_rows, f"a {ANCHOR}").select("a.*")
    chosen = saved(vectors.withColumn("group", F.pmod(F.xxhash64("block", "place"), F.lit(groups)).cast("int")), "anchors")
    held = blocks.select(
        "block", "dim", "ids", "labels", "components", F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int").alias("slice"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
    )

    def cells(rows: DataFrame, *extra: str) -> DataFrame:
        packed = rows.groupBy("group").agg(F.collect_list(F.struct("block", "place", "id", "label", "vector", *extra)).alias("anchors"))
        return packed.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))

    def over(rows: DataFrame, fn: Callable, schema: str, *extra: str) -> DataFrame:
        return cells(rows, *extra).groupBy("group", "slice").cogroup(held.groupBy("group", "slice")).applyInArrow(fn, schema)

    key = ["block", "place"]
    found = over(chosen, _positives(positives), "block long, place long, positive_id long, positive_score long")
    order = W.partitionBy(*key).orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    best = saved(found.withColumn("positive", F.row_number().over(order)).filter(F.col("positive") <= positives), "positives")
    scores = best.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("positive", "positive_score"))).alias("p"))
    wanted = chosen.join(scores, key).withColumn("positives", F.col("p.positive_score")).drop("p")
    near = over(
        wanted, _negatives(negatives, low, high), "block long, place long, positive long, negative_id long, negative_score long", "positives"
    )
    order = W.partitionBy(*key, "positive").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.join(best, [*key, "positive"]).join(chosen.select(*key, F.col("id").alias("anchor_id")), key).select(
        "anchor_id", "positive_id", "positive", "rank", "negative_id", "positive_score", "negative_score"
    )


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            values = np.frombuffer(r["components"], np.int64).reshape(len(r["ids"]), r["dim"])
            out = [
                {"block": r["block"], "place": i, "id": r["ids"][i], "label": r["labels"][i], "vector": values[i].tolist()}
                for i, chosen in enumerate(r["anchors"]) if chosen
            ]
            if out:
                kind = pa.struct([("block", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.int64()))])
                yield pa.record_batch([pa.array(out, kind)], names=["a"])


SQL = """
with good as (
  select row_number() over () as row, vec_id,
    case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as v
  from embeddings
  where label is not null and embedding is not null and not list_contains(list_transform(embedding, lambda x: coalesce(not isfinite(x), true)), true)
), scored as (
  select a.row as anchor, a.vec_id as anchor_id, b.row as other, b.vec_id as other_id, a.label = b.label as same,
    cast(list_inner_product(a.v, b.v) as bigint) as score
  from good a join good b on a.row <> b.row where a.vec_id % 100 = 0
), positives as (
  select * from scored where same
  qualify row_number() over (partition by anchor order by score desc, other_id, other) <= 5
)
select p.anchor_id, p.other_id as positive_id,
  cast(row_number() over (partition by p.anchor, p.other order by n.score desc, n.other_id, n.other) as integer) as rank,
  n.other_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scored n on p.anchor = n.anchor and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify row_number() over (partition by p.anchor, p.other order by n.score desc, n.other_id, n.other) <= 10
"""


@register("op12_hard_negatives", SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        (F.col("vec_id") % 100 == 0).alias("anchor"),
    )
    return mine(told, "vec_id", "embedding", "label", "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
