"""N-gram Jaccard join by vertical partitioning.

Documents are sets of lower-cased word shingles. All shingles have one global order (ordinary ones by hash,
very frequent ones last), and the order is cut into fragments. A pair's overlap is counted in each fragment
separately and the partial counts are summed per pair.

Candidate pairs come from a prefix filter in two steps, both exact. A linked pair shares all but K of each
set, K = n - ceil(t n). Step one keeps the first p = K + m shingles of the global order; a linked pair shares
at least m of those. Step two orders the kept shingles by their document frequency and keeps the first
p - m + 1, so shingles that no other text has come first and drop whole texts from the search. Then the shingles
that no other remaining text has are counted exactly: they bound the overlap of a text with any partner, and so
the partner's size.

Groups of copies are not expanded into all pairs: each round tests few partners per text and contracts what
is linked; only what is still apart afterwards is compared pair by pair, so no link between two components
is lost.

Edge cases: null or empty text, or text without words: empty set, linked with nothing, own component.
Fewer words than the shingle size: one shingle of all words. Repeated rows and equal texts are one node of
the search. A null doc_id gets a null component unless its group has a doc_id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.llm.common import saved, shipped, sized, table, whole_row, without_rows
from pricelake.llm.textops import chunks, mix, shingles
from pricelake.plans.registry import register

SIZE = 5
PERCENT = 75
FRAGMENTS = 8
#: Shingles of more documents than this come last in the global order, and their lists are dealt in parts of about this size.
FREQUENT = 4096
#: Rounds of few partners per text before the rest is compared pair by pair.
ROUNDS = 2

_SKETCH_BITS = 18
_LOW = (1 << 48) - 1


def _least_common(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shingles that a set of n shares at least with any set it links to."""
    return -(-n * percent // 100)


def _margin(n: np.ndarray | int) -> np.ndarray | int:
    """Shingles of the first prefix beyond those a linked set may lack."""
    return 1 + -(-n // 12)


def _digests(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (0, node, n, hash of the set) per text and, per task, (1, bucket, count, 0) of a shingle count sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        sketch = np.zeros(1 << _SKETCH_BITS, np.int64)
        for batch in batches:
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            counts, kinds = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
            for first, raws in chunks(batch.column(1)):
                sets = shingles(raws, size)
                kinds[first:first + len(sets)] = [int(mix(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                counts[first:first + len(sets)] = [len(s) for s in sets]
                every = np.concatenate(sets)
                sketch += np.bincount((every >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
            yield pa.record_batch([pa.array(np.zeros(len(nodes), np.int8)), pa.array(nodes), pa.array(counts), pa.array(kinds)], names=["kind", "a", "b", "c"])
        used = np.flatnonzero(sketch)
        yield pa.record_batch([pa.array(np.ones(len(used), np.int8)), pa.array(used), pa.array(sketch[used]), pa.array(np.zeros(len(used), np.int64))], names=["kind", "a", "b", "c"])

    return run


def _parts(hashes: np.ndarray, frequent: dict[int, int]) -> np.ndarray:
    """In how many parts the list of each shingle is dealt: 0 for an ordinary shingle."""
    buckets = (hashes >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64)
    keys = np.fromiter(sorted(frequent), np.int64, len(frequent))
    if not len(keys):
        return np.zeros(len(hashes), np.int64)
    values = np.array([frequent[int(k)] for k in keys])
    at = np.minimum(np.searchsorted(keys, buckets), len(keys) - 1)
    return np.where(keys[at] == buckets, values[at], 0)


def _prefixes(size: int, percent: int, frequent: dict[int, int]) -> Callable:
    """Rows (shingle, node) of the first prefix; the part of a frequent shingle's list is in the upper 16 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        met: set[int] = set()
        for batch in batches:
            batch = _unmet(batch, met)
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            for first, raws in chunks(batch.column(1)):
                tokens, owners = [], []
                for i, own in enumerate(shingles(raws, size)):
                    n = len(own)
                    if not n:
                        continue
                    node, parts = nodes[first + i], _parts(own, frequent)
                    low = (own & np.uint64(_LOW)).astype(np.int64)
                    take = n - _least_common(n, percent) + _margin(_least_common(n, percent))
                    order = np.lexsort((low, parts > 0))[:take]
                    part = np.where(parts > 0, 1 + (node % np.maximum(parts, 1)), 0)
                    tokens.append((low | (np.minimum(part, 32767) << 48))[order])
                    owners.append(np.full(len(order), node, np.int64))
                if tokens:
                    yield pa.record_batch([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(owners))], names=["token", "node"])

    return run


def _fragments(size: int, fragments: int, frequent: dict[int, int]) -> Callable:
    """Rows (node, shingles by fragment): the global order cut into ranges, the frequent shingles being the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        met: set[int] = set()
        for batch in batches:
            batch = _unmet(batch, met)
            for first, raws in chunks(batch.column(1)):
                cuts, values = [0], []
                for own in shingles(raws, size):
                    place = ((own & np.uint64(_LOW)) >> np.uint64(40)).astype(np.int64) * (fragments - 1) >> 8
                    place[_parts(own, frequent) > 0] = fragments - 1
                    order = np.argsort(place, kind="stable")
                    values.append(own[order].astype(np.int64))
                    cuts.extend(cuts[-1] + np.cumsum(np.bincount(place, minlength=fragments)))
                inner = pa.ListArray.from_arrays(np.array(cuts, np.int32), pa.array(np.concatenate(values)))
                outer = pa.ListArray.from_arrays(np.arange(len(raws) + 1, dtype=np.int32) * fragments, inner)
                yield pa.record_batch([batch.column(0).slice(first, len(raws)), outer], names=["node", "grams"])

    return run


def _whole(size: int) -> Callable:
    """Rows (shingle, node) of whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        met: set[int] = set()
        for batch in batches:
            batch = _unmet(batch, met)
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            for first, raws in chunks(batch.column(1)):
                sets = shingles(raws, size)
                owners = np.repeat(nodes[first:first + len(sets)], [len(s) for s in sets])
                tokens = (np.concatenate(sets) & np.uint64(_LOW)).astype(np.int64)
                yield pa.record_batch([pa.array(tokens), pa.array(owners)], names=["token", "node"])

    return run


def _unmet(batch: pa.RecordBatch, met: set[int]) -> pa.RecordBatch:
    """The rows whose text this task has not had; other tasks' copies are dropped after the shuffle."""
    fresh = []
    for node in batch.column(0).to_pylist():
        fresh.append(node not in met)
        met.add(node)
    return batch.filter(pa.array(fresh))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node that they reach.

    Labels spread to neighbours, then jump to their label's label, so long chains take few turns.
    """
    both = saved(edges.union(edges.select("b", "a")).toDF("src", "dst").distinct(), "edges")
    labels = both.groupBy(F.col("src").alias("node")).agg(F.least(F.col("src"), F.min("dst")).alias("component"))
    while True:
        labels = saved(labels, "labels")
        offered = both.join(labels, both.src == labels.node).groupBy("dst").agg(F.min("component").alias("offer"))
        lower = labels.join(offered, labels.node == offered.dst).select(
            "node", "component", F.least("component", "offer").alias("best")
        )
        target = labels.select(F.col("node").alias("at"), F.col("component").alias("jump"))
        moved = saved(lower.join(target, lower.best == target["at"]).select(
            "node", F.least("best", "jump").alias("next"), "component"
        ), "moved")
        if moved.filter("next != component").isEmpty():
            return labels
        labels = moved.select("node", F.col("next").alias("component"))


def _joined(labels: DataFrame, fresh: DataFrame) -> DataFrame:
    """Labels after the links (a, b); the search for components runs on the components so far."""
    other = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    ends = fresh.join(labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a").join(other, "b")
    merged = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("low"))
    return saved(labels.join(merged, "component", "left").select("node", F.coalesce("low", "component").alias("component")), "labels")


def _compatible(a: str, b: str, percent: int):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _verified(pairs: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that link: overlaps counted per fragment, summed per pair."""
    left = pairs.join(grams.hint("merge"), pairs.a == grams.node).select("a", "b", "na", "nb", F.col("grams").alias("own"))
    both = left.join(grams.hint("merge"), left.b == grams.node)
    partial = both.select("a", "b", "na", "nb", F.explode(F.arrays_zip("own", "grams")).alias("fragment")).select(
        "a", "b", "na", "nb", F.size(F.array_intersect("fragment.own", "fragment.grams")).alias("common")
    )
    return partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common")).filter(
        F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * percent
    ).select("a", "b")


def _shingle():
    """The shingle of a list, whichever part of a frequent shingle's list it is."""
    return F.col("token").bitwiseAND(F.lit(_LOW))


def _apart(lists: DataFrame) -> DataFrame:
    """The places in lists with texts of two components at least, and with a text that is small enough as a partner."""
    ends = lists.groupBy(_shingle().alias("shingle")).agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("n").alias("least")
    )
    kept = lists.join(ends.filter("lo != hi").select("shingle", "least"), _shingle() == F.col("shingle"))
    return kept.filter(F.col("most") >= F.col("least")).select(*lists.columns)


def _fits(n: str, most: str, other_n: str, other_most: str, percent: int):
    return _compatible(n, other_n, percent) & (F.col(most) >= F.col(other_n)) & (F.col(other_most) >= F.col(n))


def _few_partners(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """For each text the partner of another component that most of its lists offer: a list's first, or the one before.

    In the first turn the first of a list is the text with the fewest shingles of its own, such as the source of copies.
    """
    order = [(F.col("n") - F.col("most")) / F.col("n"), "node"] if turn == 0 else [F.xxhash64("node", F.lit(turn))]
    inside = W.partitionBy("token").orderBy(*order)
    kept = F.struct("node", "n", "most", "component")
    met = lists.select(
        "node", "n", "most", "component", F.lag(kept).over(inside).alias("before"), F.first(kept).over(inside).alias("first")
    )
    offers = met.select("node", "n", "most", "component", F.explode(F.array_distinct(F.array("before", "first"))).alias("p")).filter(
        (F.col("p.component") != F.col("component")) & _fits("n", "most", "p.n", "p.most", percent)
    )
    counted = offers.groupBy("node", "n", F.col("p.node").alias("partner"), F.col("p.n").alias("pn")).agg(F.count("*").alias("c"))
    best = counted.groupBy("node", "n").agg(F.max(F.struct("c", "partner", "pn")).alias("m")).select("node", "n", "m.partner", "m.pn")
    low = F.col("node") < F.col("partner")
    return best.select(
        F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b"),
        F.when(low, F.col("n")).otherwise(F.col("pn")).alias("na"), F.when(low, F.col("pn")).otherwise(F.col("n")).alias("nb"),
    ).distinct()


def _rest(lists: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """Every pair of two components that may still link.

    The whole sets of the texts that are left are put in one order, rare shingles first. A linked pair's first common
    shingle is among the first n - ceil(t n) + 1 of both, and behind it both have as many shingles as must be shared.
    """
    nodes = lists.select("node", "n", "component").distinct()
    held = saved(
        nodes.join(grams.hint("merge"), "node").select("node", "n", "component", F.explode(F.flatten("grams")).alias("gram")), "held"
    )
    counts = held.groupBy("gram").agg(F.count("*").alias("df"), (F.min("component") != F.max("component")).alias("shared"))
    place = F.row_number().over(W.partitionBy("node").orderBy("df", "gram")) - 1
    prefix = held.join(counts, "gram").withColumn("place", place).filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100))
    prefix = saved(prefix.filter("shared").drop("df", "shared"), "prefix")
    other = prefix.select("gram", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "component", "place")))
    both = F.col("n") + F.col("n_b")
    enough = ((F.col("n") - F.col("place")) * (100 + percent) >= both * percent) & ((F.col("n_b") - F.col("place_b")) * (100 + percent) >= both * percent)
    return (
        prefix.join(other, "gram")
        .filter((F.col("node") < F.col("node_b")) & (F.col("component") != F.col("component_b")) & _compatible("n", "n_b", percent) & enough)
        .select(F.col("node").alias("a"), F.col("node_b").alias("b"), F.col("n").alias("na"), F.col("n_b").alias("nb")).distinct()
    )


def grouped_rows(docs: DataFrame, text: str, doc_id: str, size: int, percent: int, fragments: int, frequent: int, rounds: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, group) per row; rows without shingles have the group of the empty set."""
    shipped(__name__)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.withColumn("node", F.xxhash64("text"))
    found = saved(texts.select("node", "text").mapInArrow(_digests(size), "kind byte, a long, b long, c long"), "digests")
    # Texts with equal sets are one: the smallest node stands for them.
    kinds = found.filter("kind = 0").groupBy("c", "b").agg(F.min("a").alias("node"))
    sizes = saved(kinds.select("node", F.col("b").alias("n"), F.col("c").alias("set_hash")), "sizes")
    twins = found.filter("kind = 0").select(F.col("a").alias("text_node"), F.col("b").alias("n"), F.col("c").alias("set_hash")).distinct()

    # At most (all shingles / frequent) buckets and never more than the sketch has: bounded, so shipped with the tasks.
    sketch = saved(found.filter("kind = 1").groupBy("a").agg(F.sum("b").alias("c")), "sketch")
    load = sketch.agg(F.sum("c")).first()[0] or 0
    least = max(frequent, 4 * load >> _SKETCH_BITS)
    often = {r["a"]: -(-r["c"] // least) for r in sketch.filter(F.col("c") > least).collect()}

    first = texts.select("node", "text").mapInArrow(_prefixes(size, percent, often), "token long, node long")
    first = first.repartition("token").distinct()
    shared = first.withColumn("df", F.count("*").over(W.partitionBy("token"))).filter(f"df > 1 or token > {_LOW}")
    rank = F.when(F.col("token") > _LOW, F.lit(1 << 40)).otherwise(F.col("df"))
    by_node = W.partitionBy("node").orderBy(rank, _shingle())
    least_common = F.ceil(F.col("n") * percent / 100)
    need = 1 + F.ceil(F.ceil(least_common * percent / 100) / 12)
    length = F.col("n") - least_common + 1 + F.ceil(least_common / 12)
    lists = (
        shared.join(sizes.select("node", "n"), "node")
        .withColumn("place", F.row_number().over(by_node)).withColumn("known", F.count("*").over(W.partitionBy("node")))
        .filter(F.col("place") + (length - F.col("known")) <= length - need + 1)
        .select("token", "node", "n", F.col("node").alias("component"), F.floor(F.col("n") * 100 / percent).alias("most"))
    )
    lists = saved(_apart(saved(lists, "lists")), "lists")
    nodes = saved(lists.select("node").distinct(), "nodes")

    # A set with u shingles of its own shares n - u at most, which bounds the partner's size.
    whole = texts.select("node", "text").join(sized(nodes), "node", "left_semi").mapInArrow(_whole(size), "token long, node long")
    own = whole.groupBy("token").agg(F.min("node").alias("node"), F.max("node").alias("last")).filter("node = last")
    own = saved(own.groupBy("node").agg(F.count("*").alias("own")), "own")
    most = F.floor((100 + percent) * (F.col("n") - F.coalesce("own", F.lit(0))) / percent) - F.col("n")
    lists = lists.drop("most").join(own, "node", "left").withColumn("most", most).drop("own").filter(F.col("most") * 100 >= F.col("n") * percent)
    lists = saved(_apart(saved(lists, "lists")), "lists")
    nodes = saved(lists.select("node").distinct(), "nodes")

    wanted = texts.select("node", "text").join(sized(nodes), "node", "left_semi")
    grams = (
        wanted.mapInArrow(_fragments(size, fragments, often), "node long, grams array<array<long>>")
        .repartition(_shuffles(docs.sparkSession), "node").dropDuplicates(["node"]).persist(StorageLevel.DISK_ONLY)
    )
    grams.count()  # its partitioning is known to the joins once it is there
    labels = nodes.select("node", F.col("node").alias("component"))
    for turn in range(rounds + 1):
        pairs = _few_partners(lists, turn, percent) if turn < rounds else _rest(lists, grams, percent)
        fresh = saved(_verified(pairs, grams, percent), "links")
        if not fresh.isEmpty():
            labels = _joined(labels, fresh)
            lists = saved(_apart(lists.drop("component").join(labels, "node")), "lists")
    grams.unpersist()

    named = sizes.join(labels, "node", "left").select("n", "set_hash", F.coalesce("component", "node").alias("group"))
    groups = saved(twins.join(named, ["n", "set_hash"]).select("text_node", "n", "group"), "groups")
    rows = texts.select("doc_id", F.col("node").alias("text_node")).join(groups, "text_node")
    return saved(rows.select("doc_id", F.col("text_node").alias("text_hash"), F.col("n").alias("n_shingles"), "group"), "rows")


def jaccard_components(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SIZE, percent: int = PERCENT,
    fragments: int = FRAGMENTS, frequent: int = FREQUENT, rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: component_id is the smallest doc_id that links reach."""
    rows = grouped_rows(docs, text, doc_id, size, percent, fragments, frequent, rounds)
    lowest = rows.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    single = F.col("n_shingles") == 0
    return (
        rows.join(lowest, "group")
        .select("doc_id", "n_shingles", F.when(single, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    )


def _shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group stays, with all its columns: the smallest doc_id (null last), then text hash.

    Of rows that are equal in both, the one with the smallest hash of all columns stays. Rows without words have no
    near copies, and all of them stay.
    """
    rows = grouped_rows(docs, "text", "doc_id", SIZE, PERCENT, FRAGMENTS, FREQUENT, ROUNDS).filter("n_shingles > 0")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    first = rows.groupBy("group").agg(F.min(rank).alias("first"))
    # Each (doc_id, text_hash) once, with the number of its rows.
    each = rows.groupBy("group", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    told = saved(each.join(first, "group").withColumn("stays", F.col("first") == rank).filter("not stays or copies > 1"), "told")

    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    alone = without_rows(docs, saved(told.select("doc_id", "text_hash"), "marked"), text_hash)
    many = saved(told.filter("stays").select("doc_id", "text_hash"), "repeated")
    keyed = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_hash.alias("text_hash")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.text_hash") == F.col("m.text_hash"))
    once = keyed.join(sized(many).alias("m"), same, "left_semi").groupBy("doc_id", "text_hash").agg(
        F.min_by("row", F.xxhash64(*(F.col("row")[c] for c in docs.columns))).alias("row")
    )
    return alone.unionByName(once.select("row.*"))


@register("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
