"""Language-model scores by online logistic context mixing.

A text is the stream of its lower-cased words, one space between two and a line feed as the end. Each byte is a path through
a Huffman tree of the training bytes, so it is a handful of binary decisions. Several predictors look up how a decision fell
in their context (the three bytes before; the word so far; the word so far and the word before it), each in a hashed table of
2^BITS slots. Their log odds are combined by weights that a gate selects (the node of the tree and which word contexts
are known), and the mixed probability is refined by an adaptive map from (node, predicted log odds) to what really happened.

Learning takes three passes over all training texts and none is sampled: byte counts, decision counts per slot, and then
weights and map, learnt online in small steps while each text is predicted without its own decision (one is taken off the
counts). Tasks run their own online descent, and weights are averaged by the number of decisions behind them. The
model has a fixed size (PREDICTORS * 2^BITS counts, 256 * 4 weight sets), so it can be sent to every task; what is gathered
for it, and the word counts of the base score, grow with the corpus.

The base score is a unigram model with add-one smoothing over the same tokens (words and one end). Words that make up at least
1 / HEAD of all training tokens (so at most HEAD words) are broadcast with their counts; all others are joined by a shuffle in
which no word can hold more than that share of the rows. The base gives every unknown word the mass of a single one, so it
is no distribution over unknown words; the model spells them out, which costs more on texts with many of them.

Edge cases: null and empty texts, or texts without words, are the end alone (one token). A row whose doc_id is null is not
learnt from and not held out. Repeated rows are scored one by one, and each training row counts. Ties cannot occur.
Very long texts are read whole, decisions PART_BYTES bytes at a time. An empty table gives an empty result; without
training texts all decisions are even. Words and contexts are 64 and 32 bit hashes. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import saved, shipped, table
from pricelake.llm.textops import blank, chunks, word_hashes, word_spans
from pricelake.plans.registry import register

BITS = 20
PREDICTORS = 3
#: Most words whose counts are broadcast.
HEAD = 100_000
#: Bytes of an online step.
BLOCK_BYTES = 1 << 15
#: Bytes whose decisions are worked on together; with their slots they stay near the processor.
PART_BYTES = 1 << 13
#: Bytes whose equal pairs of context and byte are counted together.
PAIR_BYTES = 1 << 20
#: Counts that are shuffled and summed together (two per slot).
BLOCK_COUNTS = 1 << 10
_KINDS = {1: np.uint8, 2: np.uint16, 4: np.int32}
#: Size of an online step, smoothing of counts, step of stored log odds, and buckets of the adaptive map (half a unit of log odds each).
RATE, SMOOTH, STEP, BUCKETS = 0.02, 0.4, 0.1, 64
#: How many hits the map's prior, the mixed probability itself, is worth.
PRIOR = 32
FOLDS, HELD_OUT = 7, 2

_R = np.uint32(0x01000193)
_R_INVERSE = np.uint32(pow(0x01000193, -1, 1 << 32))
_NODE, _SPREAD = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_END, _GAP = 10, 32
_POWERS: dict[int, np.ndarray] = {}
_LEAST, _MOST = np.float32(2.0**-20), np.float32(1 - 2.0**-20)


def taken(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """values[at] for places that are known to lie inside, which saves numpy the test of each."""
    return values.take(at, mode="wrap")


@dataclass
class Code:
    """A binary code of the bytes: where each byte's decisions begin, how many, and the node and bit of each decision."""

    start: np.ndarray
    size: np.ndarray
    node: np.ndarray
    bit: np.ndarray


def huffman(counts: np.ndarray) -> Code:
    """Huffman code of 256 symbols; every symbol gets one."""
    heap = [(int(n) + 1, i, i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    for k in range(255):
        (n, _, a), (m, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a], parent[b] = (256 + k, 0), (256 + k, 1)
        heapq.heappush(heap, (n + m, 256 + k, 256 + k))
    paths = []
    for symbol in range(256):
        at, path = symbol, []
        while at in parent:
            at, bit = parent[at]
            path.append((at - 256, bit))
        paths.append(path[::-1])
    size = np.array([len(p) for p in paths])
    flat = np.array([step for p in paths for step in p])
    return Code(np.cumsum(size) - size, size, flat[:, 0].copy(), flat[:, 1].astype(np.int8))


def stream(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the token streams of all texts, text of each byte)."""
    data, _, ends, rows = word_spans(raws, lower=True)
    data, keep, bounds = data.copy(), ~blank(data), np.cumsum([len(r) + 1 for r in raws])
    gaps = ends[:-1][rows[1:] == rows[:-1]]
    data[gaps], keep[gaps] = _GAP, True
    data[bounds - 1], keep[bounds - 1] = _END, True
    kept = np.flatnonzero(keep)
    owner = np.repeat(np.arange(len(raws), dtype=np.int32), np.diff(np.searchsorted(kept, bounds), prepend=0))
    return taken(data, kept), owner


def _powers(of: np.uint32, n: int) -> np.ndarray:
    """Powers 0 to n, modulo 2^32; kept for the next texts."""
    known = _POWERS.get(int(of))
    if known is None or len(known) <= n:
        known = _POWERS[int(of)] = np.cumprod(np.concatenate(([np.uint32(1)], np.full(max(n, 1 << 18), of, np.uint32))), dtype=np.uint32)
    return known


def contexts(data: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Per predictor a hash of what stands before each byte in its text."""
    n = len(data)
    begins = np.flatnonzero(np.concatenate((np.ones(min(n, 1), bool), owner[1:] != owner[:-1])))
    low = data.astype(np.uint32)
    low += np.uint32(1)
    three = np.zeros(n, np.uint32)
    for k in range(1, 4):
        three[k:] |= low[:-k] << np.uint32(9 * k - 9)
    for near in range(3):  # nothing stands before a text
        at = begins + near
        three[at[at < n]] &= np.uint32((1 << 9 * near) - 1)
    opens, starts = np.empty(n, bool), np.zeros(n, bool)
    starts[begins] = True
    opens[1:] = data[:-1] == _GAP
    opens[begins] = True
    at = np.flatnonzero(opens)
    powers, inverse = _powers(_R, n), _powers(_R_INVERSE, n)
    sums = np.zeros(n + 1, np.uint32)
    np.cumsum(low * powers[:n], dtype=np.uint32, out=sums[1:])
    last = np.append(at[1:], n) - 1  # the space or end behind each word
    whole = (sums[last] - sums[at]) * inverse[at] * _SPREAD + np.uint32(7)
    former = np.concatenate(([np.uint32(0)], whole[:-1]))
    former[starts[at]] = 0
    passed, scale, word = _spread([sums[at], inverse[at], former], np.diff(at, append=n))
    part = (sums[:-1] - passed) * scale
    pair = part * _NODE ^ word
    return [_mixed(x, i) for i, x in enumerate((three, part, pair))]


def _spread(columns: list[np.ndarray], times: np.ndarray) -> list[np.ndarray]:
    """Up to four columns of 32-bit numbers, each place repeated so many times; all are copied at once as 16 bytes."""
    packed = np.zeros((len(times), 4), np.uint32)
    for i, column in enumerate(columns):
        packed[:, i] = column
    wide = np.repeat(packed.view(np.complex128).ravel(), times).view(np.uint32).reshape(-1, 4)
    return [wide[:, i] for i in range(len(columns))]


def _mixed(value: np.ndarray, salt: int) -> np.ndarray:
    value = value + np.uint32(salt * 0x51ED27)
    value *= _SPREAD
    value ^= value >> np.uint32(15)
    value *= np.uint32(0xC2B2AE35)
    return value


def pieces(data: np.ndarray, own: list[np.ndarray]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Bytes and contexts, PART_BYTES at a time."""
    for first in range(0, len(data), PART_BYTES):
        part = slice(first, first + PART_BYTES)
        yield data[part], [c[part] for c in own]


def reaches(data: np.ndarray, code: Code) -> tuple[np.ndarray, list[int]]:
    """(bytes by falling length of their codes, how many of these have a first, second, ... decision)."""
    size = taken(code.size, data)
    order = np.argsort((255 - size).astype(np.uint8), kind="stable")
    longer = np.cumsum(np.bincount(size, minlength=1)[::-1])[::-1]
    return order, longer[1:].tolist()


def along(column: np.ndarray, order: np.ndarray, reach: list[int]) -> np.ndarray:
    """A column of the bytes, repeated for the decisions of each: all first ones, all second ones and so on."""
    ordered = taken(column, order)
    return np.concatenate([ordered[:n] for n in reach])


def decisions(data: np.ndarray, own: list[np.ndarray], code: Code, bits: int) -> tuple[np.ndarray, np.ndarray, Iterator[np.ndarray], tuple[np.ndarray, list[int]]]:
    """(node, bit, slot of each predictor) of each binary decision, and their order as told by `reaches`; slots are made when asked for."""
    order, reach = reaches(data, code)
    start = taken(code.start, taken(data, order))
    flat = np.concatenate([start[:n] + k for k, n in enumerate(reach)])
    node, bit = taken(code.node, flat), taken(code.bit, flat)
    salt = node.astype(np.uint32)
    salt *= _NODE

    def slots() -> Iterator[np.ndarray]:
        for context in own:
            h = along(context, order, reach)
            h ^= salt
            h *= _SPREAD
            h >>= np.uint32(32 - bits)
            yield h.astype(np.int64)

    return node, bit, slots(), (order, reach)


@dataclass
class Model:
    """The learnt model; `odds` holds the log odds of a one per slot of each predictor."""

    code: Code
    odds: list[np.ndarray]
    weights: np.ndarray
    refined: np.ndarray
    bits: int = BITS


def log_odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log odds of a one in steps of STEP, one byte each, so that a table stays near the processor."""
    return np.clip(np.rint((np.log(ones + SMOOTH) - np.log(zeros + SMOOTH)) / STEP), -127, 127).astype(np.int8)


def without_one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log odds with a zero (lower byte) or a one (upper byte) taken off the counts of each slot."""
    lower, upper = log_odds(np.maximum(zeros - 1, 0), ones), log_odds(zeros, np.maximum(ones - 1, 0))
    return lower.view(np.uint8).astype(np.int16) | upper.astype(np.int16) << np.int16(8)


def inputs(slots: Iterable[np.ndarray], tables: list[np.ndarray], node: np.ndarray, bit: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """(log odds of each predictor, weight set); given the bits, from the tables of `without_one`."""
    out = [taken(own, slot) for slot, own in zip(slots, tables)]
    if bit is not None:
        upper = bit.astype(np.int16) * np.int16(8)
        out = [(x >> upper).astype(np.int8) for x in out]
    gate = node * 4
    gate += (out[-2] != 0).view(np.int8) + (out[-1] != 0).view(np.int8) * np.int8(2)
    return [x.astype(np.float32) * np.float32(STEP) for x in out], gate


def mixed(x: list[np.ndarray], gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log odds after mixing; `weights` has a row per predictor and one for the bias, a column per set."""
    total = taken(weights[-1], gate)
    for own, row in zip(x, weights):
        total += own * taken(row, gate)
    return np.clip(total, np.float32(-15), np.float32(15), out=total)


def squashed(odds: np.ndarray) -> np.ndarray:
    return np.float32(1) / (np.float32(1) + np.exp(-odds))


def cell(node: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Cell of the adaptive map."""
    at = node * BUCKETS
    at += (odds * 2 + np.float32(BUCKETS / 2)).astype(np.int32)
    return at


def refine(node: np.ndarray, odds: np.ndarray, refined: np.ndarray) -> np.ndarray:
    """Probability of a one: mean of the mixed one and what followed such predictions; `refined` is (share of ones, share of the prior) per cell."""
    p, at = squashed(odds), cell(node, odds)
    told = taken(refined[0], at) + taken(refined[1], at) * p
    return np.clip((p + told) * np.float32(0.5), _LEAST, _MOST)


def score_texts(raws: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(log10 probability, bytes of the stream) of each text."""
    data, owner = stream(raws)
    own, total = contexts(data, owner), np.zeros(len(raws))
    for part, (text, *some) in pieces(data, [owner, *own]):
        node, bit, slots, (order, reach) = decisions(part, some, model.code, model.bits)
        x, gate = inputs(slots, model.odds, node)
        p = refine(node, mixed(x, gate, model.weights), model.refined)
        logs, sums = np.log(np.abs(p - (1 - bit).astype(np.float32))), np.zeros(len(order))
        for n, end in zip(reach, np.cumsum(reach)):
            sums[:n] += logs[end - n:end]
        total += np.bincount(taken(text, order), weights=sums, minlength=len(raws))
    return total / np.log(10), np.bincount(owner, minlength=len(raws))


def _keep_memory() -> None:
    """Free one large array, after which the C library keeps freed memory of up to that size instead of faulting each page in again."""
    np.empty(31 << 20, np.uint8)


def _blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    for _, raws in chunks(texts):
        data, owner = stream(raws)
        own = contexts(data, owner)
        for first in range(0, len(data), BLOCK_BYTES):
            part = slice(first, first + BLOCK_BYTES)
            yield data[part], [c[part] for c in own]


def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(256, np.int64)
    for batch in batches:
        for _, raws in chunks(batch.column(0)):
            total += np.bincount(stream(raws)[0], minlength=256)
    yield pa.record_batch([pa.array(np.arange(256)), pa.array(total)], names=["byte", "n"])


def _pairs(data: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(byte, context, how often) of each different pair."""
    key = data.astype(np.uint64)
    key <<= np.uint64(32)
    key |= context
    key.sort()
    first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
    n = np.diff(first, append=len(key)).astype(np.int32)
    key = taken(key, first)
    return (key >> np.uint64(32)).astype(np.uint8), key.astype(np.uint32), n


def _slot_counts(code: Code, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (block over all tables, counts of its slots, zero and one in turn) of the texts of a task, in the fewest bytes a count.

    A byte behind the same context falls into the same slots, so equal pairs of up to PAIR_BYTES bytes are added up first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_memory()
        counts = np.zeros((PREDICTORS, 2 << bits), np.int32)

        def add(blocks: list[tuple[np.ndarray, list[np.ndarray]]]) -> None:
            data = np.concatenate([d for d, _ in blocks])
            for i in range(PREDICTORS):
                byte, context, n = _pairs(data, np.concatenate([own[i] for _, own in blocks]))
                for part, (some, times) in pieces(byte, [context, n]):
                    _, bit, (slot,), at = decisions(part, [some], code, bits)
                    slot *= 2
                    slot += bit
                    np.add.at(counts[i], slot, along(times, *at))

        held, size = [], 0
        for batch in batches:
            for data, own in _blocks(batch.column(0)):
                held.append((data, own))
                size += len(data)
                if size >= PAIR_BYTES:
                    add(held)
                    held, size = [], 0
        if held:
            add(held)
        whole = counts.reshape(-1, BLOCK_COUNTS)
        for block in np.flatnonzero(whole.any(1)):
            own = whole[block]
            narrow = next(kind for kind in (np.uint8, np.uint16, np.int32) if own.max() <= np.iinfo(kind).max)
            yield pa.record_batch([pa.array([block], pa.int32()), pa.array([own.astype(narrow).tobytes()])], names=["block", "counts"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the counts of each block, as 64-bit numbers; a task holds its blocks once, however many rows come."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
            one = np.frombuffer(counts, _KINDS[len(counts) // BLOCK_COUNTS])
            sums[block] = sums[block] + one if block in sums else one.astype(np.int64)
    for block, own in sums.items():
        yield pa.record_batch([pa.array([block], pa.int32()), pa.array([own.tobytes()])], names=["block", "counts"])


def online(blocks: Iterator[tuple[np.ndarray, list[np.ndarray]]], code: Code, without: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, decisions of each set, hits and cases of the map) after online descent over the blocks; see `without_one`."""
    weights = np.full((PREDICTORS + 1, 1024), 1 / PREDICTORS, np.float32)
    weights[-1] = 0
    slopes, seen, fell = np.full(weights.shape, 1e-3), np.zeros(1024), np.zeros(2 * 256 * BUCKETS, np.int64)
    for data, own in blocks:
        slope, cells = np.zeros(weights.shape), []
        for part, some in pieces(data, own):
            node, bit, slots, _ = decisions(part, some, code, bits)
            x, gate = inputs(slots, without, node, bit)
            odds = mixed(x, gate, weights)
            error, at = bit.astype(np.float32) - squashed(odds), cell(node, odds)
            at *= 2
            at += bit
            cells.append(at)
            seen += np.bincount(gate, minlength=1024)
            for i in range(PREDICTORS + 1):
                slope[i] += np.bincount(gate, weights=error * x[i] if i < PREDICTORS else error, minlength=1024)
        fell += np.bincount(np.concatenate(cells), minlength=len(fell))
        slopes += slope * slope
        weights += RATE * slope / np.sqrt(slopes)
    fell = fell.reshape(-1, 2)
    return weights, seen, np.stack([fell[:, 1], fell.sum(1)]).astype(np.float64)


def _fit(code: Code, shared: object, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (kind, at, value, n): summed weights and decisions per weight, hits and cases per cell of the map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_memory()
        weights, seen, refined = online((b for batch in batches for b in _blocks(batch.column(0))), code, shared.value, bits)
        every = np.broadcast_to(seen, weights.shape).ravel()
        for kind, value, n in ((0, weights.ravel() * every, every), (1, refined[0], refined[1])):
            at = np.flatnonzero(n)
            yield pa.record_batch([pa.array(np.full(len(at), kind, np.int32)), pa.array(at), pa.array(value[at]), pa.array(n[at])], names=["kind", "at", "value", "n"])

    return run


def learn(texts: DataFrame, bits: int = BITS) -> Model:
    """The model of one column of texts."""
    spark = texts.sparkSession
    counts = np.zeros(256, np.int64)
    for r in texts.mapInArrow(_byte_counts, "byte long, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():
        counts[r["byte"]] = r["n"]
    code = huffman(counts)
    blocks = "block int, counts binary"
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), (PREDICTORS << bits + 1) // BLOCK_COUNTS)
    told = texts.mapInArrow(_slot_counts(code, bits), blocks).repartition(parts, "block").mapInArrow(_summed, blocks).toArrow()  # PREDICTORS * 2^bits slots at most
    counted = np.zeros(((PREDICTORS << bits + 1) // BLOCK_COUNTS, BLOCK_COUNTS), np.int64)
    for block, counts in zip(told.column("block").to_pylist(), told.column("counts").to_pylist()):
        counted[block] = np.frombuffer(counts, np.int64)
    zeros, ones = np.moveaxis(counted.reshape(PREDICTORS, -1, 2), 2, 0)
    shared = spark.sparkContext.broadcast([without_one(*x) for x in zip(zeros, ones)])
    learnt = texts.mapInArrow(_fit(code, shared, bits), "kind int, at long, value double, n double").groupBy("kind", "at").agg(
        F.sum("value").alias("value"), F.sum("n").alias("n")
    ).toArrow()  # one row per weight and cell
    kind, at, value, n = (learnt.column(c).to_numpy() for c in ("kind", "at", "value", "n"))
    weights = np.full((PREDICTORS + 1) * 1024, 1 / PREDICTORS, np.float32)
    weights[-1024:] = 0
    weights[at[kind == 0]] = (value / n)[kind == 0]
    cases = np.zeros((2, 256 * BUCKETS))
    cases[:, at[kind == 1]] = value[kind == 1], n[kind == 1]
    return Model(code, [log_odds(*x) for x in zip(zeros, ones)], weights.reshape(PREDICTORS + 1, 1024), adaptive(*cases), bits)


def adaptive(hits: np.ndarray, cases: np.ndarray) -> np.ndarray:
    """(share of ones, share of the prior) per cell of the map, from the ones among its cases."""
    return (np.stack([hits, np.full(len(cases), PRIOR)]) / (cases + PRIOR)).astype(np.float32)


SCORED = "doc_id long, held_out boolean, n_tokens long, score double, bits_per_byte double, tokens array<struct<word: long, n: long>>"


def _scorer(shared: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of SCORED: the model's score, and the distinct words with their counts for the base score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _keep_memory()
        code, *rest = shared.value
        model = Model(Code(*code), *rest)
        for batch in batches:
            for first, raws in chunks(batch.column("text")):
                scores, sizes = score_texts(raws, model)
                data, starts, ends, rows = word_spans(raws, lower=True)
                hashes = word_hashes(data, starts, ends).astype(np.int64)
                cuts = np.searchsorted(rows, np.arange(len(raws) + 1))
                each = [np.unique(np.append(hashes[a:b], _END), return_counts=True) for a, b in zip(cuts, cuts[1:])]
                offsets = np.concatenate(([0], np.cumsum([len(w) for w, _ in each]))).astype(np.int32)
                words, counts = (pa.array(np.concatenate(x)) for x in zip(*each))
                tokens = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([words, counts], ["word", "n"]))
                yield pa.record_batch([
                    batch.column("doc_id").slice(first, len(raws)), batch.column("held_out").slice(first, len(raws)), pa.array(np.diff(cuts) + 1),
                    pa.array(scores), pa.array(-scores * np.log2(10) / sizes), tokens,
                ], names=["doc_id", "held_out", "n_tokens", "score", "bits_per_byte", "tokens"])

    return run


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; null for a null doc_id."""
    return F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT


def scored(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row."""
    shipped(__name__)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    model = learn(rows.filter(~F.col("held_out")).select("text"), bits)
    code = model.code
    # Plain arrays: a broadcast value is unpickled where the package need not be.
    shared = docs.sparkSession.sparkContext.broadcast(((code.start, code.size, code.node, code.bit), model.odds, model.weights, model.refined, bits))
    told = saved(rows.mapInArrow(_scorer(shared), SCORED).withColumn("row", F.monotonically_increasing_id()), "scored")
    return _with_base(told)


def _links(rows: DataFrame) -> DataFrame:
    """(row, word, n) of each distinct token of a text."""
    return rows.select("row", F.inline("tokens"))


def _with_base(rows: DataFrame) -> DataFrame:
    vocabulary = saved(_links(rows.filter(~F.col("held_out"))).groupBy("word").agg(F.sum("n").alias("c")), "vocabulary")
    all_of = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count("*").alias("words")).first()
    frequent = F.col("c") * HEAD >= all_of["tokens"]
    head = F.broadcast(vocabulary.filter(frequent).withColumnRenamed("c", "often"))  # at most HEAD words
    split = _links(rows).join(head, "word", "left")

    def summed(links: DataFrame, count: str) -> DataFrame:
        return links.groupBy("row").agg(F.sum("n").alias("known"), F.sum(F.col("n") * F.log10(F.col(count) + 1)).alias("logs"))

    many = summed(split.filter("often is not null"), "often")
    few = summed(split.filter("often is null").select("row", "word", "n").join(vocabulary.filter(~frequent), "word"), "c")
    sums = many.unionByName(few).groupBy("row").agg(F.sum("known").alias("known"), F.sum("logs").alias("logs"))
    whole = F.log10(F.lit(float(all_of["tokens"] + all_of["words"] + 1)))
    return rows.drop("tokens").join(sums, "row", "left").select(
        "doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "n_tokens", F.coalesce("known", F.lit(0)).alias("n_known"),
        F.lit(all_of["tokens"]).cast("long").alias("train_tokens"),
        (F.coalesce("logs", F.lit(0.0)) - F.col("n_tokens") * whole).alias("base_score"), "score", "bits_per_byte",
    )


@register("op13_lm_scoring")
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
