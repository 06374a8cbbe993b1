"""Alignment of two tokenizers over the same texts.

Each text is encoded by a byte-level vocabulary (A) and by a piece model (B). Tokens tile the bytes of space + text, so
a token is known by its byte range. `pandas.merge_asof`, per batch and keyed by document, finds for each token start
the token of the other side that covers it; the union of both directions is every overlapping pair. Overlapping pairs
that end at one byte are links, and the ends of links cut both sides into groups.

How often a pair of ids is linked is counted over the whole corpus. Of two linked tokens one is the tail of the other,
so there are no more pairs of ids than bytes in both vocabularies together: that bounds the table of pair counts that
is broadcast back, whatever the size of the corpus.

A is read from its vocabulary file and encoded by `tiktoken` with the vocabulary's own split pattern, which gives the ids
of the `tokenizers` library at a third of the time (a test compares the two over every code point).

Edge cases: null and empty texts have no tokens, nor have texts that a tokenizer does not give back byte for byte
(counts are zero, the digest is an empty string). Repeated rows are aligned one by one and each counts. A null doc_id
stays null. Empty tables give an empty result. Texts are read whole; texts are aligned together up to CHUNK_BYTES, a
longer text alone. Ties of counts are all best. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import saved, shipped, table
from pricelake.plans.registry import register

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Folder of the vocabulary files; every executor has to reach it.
TOKENIZERS = "/opt/tokenizers"
BYTE_VOCABULARY, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Fixed value: how the byte-level vocabulary splits a text before it merges bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK_BYTES = 1 << 20

Encoder = Callable[[list[str]], list[np.ndarray]]


def byte_side(path: str) -> tuple[Encoder, list[bytes]]:
    """(encoder of space + text, bytes of each id) of a byte-level vocabulary file."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {t["id"] for t in told["added_tokens"]}
    vocabulary = {bytes(byte_of[c] for c in token): i for token, i in told["model"]["vocab"].items() if i not in special}
    encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
    entries = [b""] * (max([*vocabulary.values(), *special]) + 1)
    for token, i in vocabulary.items():
        entries[i] = token

    def one(text: str) -> np.ndarray:
        try:
            ids = encoding.encode_to_numpy(text, disallowed_special=())
        except ValueError:  # a run of white space beyond the stack of its split pattern
            ids = _plain_encoder(path).encode(text, add_special_tokens=False).ids
        return np.asarray(ids, np.int64)

    return lambda texts: [one(" " + t) for t in texts], entries


def _plain_encoder(path: str) -> Tokenizer:
    """The vocabulary in the library that its file is written for."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    return plain


def piece_side(path: str) -> tuple[Encoder, list[bytes]]:
    """(encoder of the text, which adds the space itself; bytes of each id) of a piece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        entries.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(ids, np.int64) for ids in model.encode(texts, num_threads=1)]

    return encode, entries


def _whole(text: str | None, a: np.ndarray, b: np.ndarray, entries: tuple[list[bytes], list[bytes]]) -> bool:
    raw = b" " + text.encode("utf-8", "surrogatepass")
    return all(b"".join([own[i] for i in ids.tolist()]) == raw for ids, own in zip((a, b), entries))


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(token of a, token of b) of all overlapping pairs; frames of (at, doc, token), tokens tile each doc on both sides."""
    left, right = a.rename(columns={"token": "a"}), b.rename(columns={"token": "b"})
    forth = pd.merge_asof(left, right, on="at", by="doc")
    back = pd.merge_asof(right, left.assign(start=left["at"]), on="at", by="doc")
    back = back[back["start"] != back["at"]]  # equal starts are in both directions
    return np.concatenate([forth["a"], back["a"]]), np.concatenate([forth["b"], back["b"]])


def _side(ids: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pd.DataFrame]:
    """(ids, doc, end, frame of starts) of the tokens of all texts, laid one text after the other."""
    every = np.concatenate([*ids, np.empty(0, np.int64)])
    doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    ends = np.cumsum(sizes[every])
    return every, doc, ends, pd.DataFrame({"at": ends - sizes[every], "doc": doc, "token": np.arange(len(every))})


def _digits(n: int) -> np.ndarray:
    """Decimal digits of each id, one row each, zero bytes behind."""
    text = np.arange(n).astype(f"S{len(str(n))}")
    return text.view(np.uint8).reshape(n, -1)


def _group_texts(sides: list[tuple[np.ndarray, np.ndarray, np.ndarray]], digits: list[np.ndarray], n: int) -> list[bytes]:
    """Per text `a1,a2|b1;a3|b2,b3`; a side is (ids, doc, whether the token ends a group)."""
    (ids_a, doc_a, cut_a), (ids_b, doc_b, cut_b) = sides
    group_a, group_b = (np.cumsum(cut) - cut for cut in (cut_a, cut_b))
    place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, "left")
    place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
    width = max(d.shape[1] for d in digits)
    marks = np.zeros((len(ids_a) + len(ids_b), width + 1), np.uint8)
    owner = np.empty(len(marks), np.int64)
    for place, ids, cut, doc, own, end in ((place_a, ids_a, cut_a, doc_a, digits[0], b"|"), (place_b, ids_b, cut_b, doc_b, digits[1], b";")):
        marks[place, :own.shape[1]] = own[ids]
        marks[place, width] = np.where(cut, end[0], ord(","))
        owner[place] = doc
    last = np.flatnonzero(np.diff(owner, append=n))
    marks[last, width] = 0  # nothing behind the last group of a text
    used = marks != 0
    lengths = np.bincount(owner, weights=used.sum(1), minlength=n).astype(np.int64)
    flat, bounds = marks[used].tobytes(), np.concatenate(([0], np.cumsum(lengths)))
    return [flat[bounds[i]:bounds[i + 1]] for i in range(n)]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """(first, beyond the last) of runs of texts that are aligned together."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text or "") > CHUNK_BYTES:
            yield first, i
            first, size = i, 0
        size += len(text or "")
    if first < len(texts):
        yield first, len(texts)


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, counts array<int>"


def _aligner(folder: str, byte_name: str, piece_name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of ALIGNED per document; a pair of ids is a * (ids of B) + b, pairs are distinct and sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (encode_a, bytes_a), (encode_b, bytes_b) = byte_side(f"{folder}/{byte_name}"), piece_side(f"{folder}/{piece_name}")
        sizes = [np.array([len(x) for x in own]) for own in (bytes_a, bytes_b)]
        digits = [_digits(len(own)) for own in (bytes_a, bytes_b)]
        none = np.empty(0, np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, beyond in _chunks(texts):
                own, n = texts[first:beyond], beyond - first
                some = [i for i, t in enumerate(own) if t]
                tokens = [[none] * n, [none] * n]
                for i, a, b in zip(some, encode_a([own[i] for i in some]), encode_b([own[i] for i in some])):
                    if _whole(own[i], a, b, (bytes_a, bytes_b)):
                        tokens[0][i], tokens[1][i] = a, b
                (ids_a, doc_a, end_a, starts_a), (ids_b, doc_b, end_b, starts_b) = (_side(t, s) for t, s in zip(tokens, sizes))
                a, b = overlaps(starts_a, starts_b) if len(ids_a) else (none, none)
                linked = end_a[a] == end_b[b]
                a, b = a[linked], b[linked]
                cut_a, cut_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
                cut_a[a], cut_b[b] = True, True
                shown = _group_texts([(ids_a, doc_a, cut_a), (ids_b, doc_b, cut_b)], digits, n)
                limit = len(bytes_a) * len(bytes_b)
                keys, counts = np.unique(doc_a[a] * limit + ids_a[a] * len(bytes_b) + ids_b[b], return_counts=True)
                cuts = np.searchsorted(keys, np.arange(n + 1) * limit).astype(np.int32)
                groups = np.bincount(doc_a[cut_a], minlength=n)
                yield pa.record_batch([
                    batch.column("doc_id").slice(first, n), pa.array([len(x) for x in tokens[0]], pa.int64()), pa.array([len(x) for x in tokens[1]], pa.int64()),
                    pa.array(groups), pa.array(np.bincount(doc_a[a], minlength=n)),
                    pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in shown], pa.string()),
                    pa.ListArray.from_arrays(cuts, pa.array(keys % limit)), pa.ListArray.from_arrays(cuts, pa.array(counts.astype(np.int32))),
                ], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "counts"])

    return run


def align(docs: DataFrame, folder: str = TOKENIZERS, byte_name: str = BYTE_VOCABULARY, piece_name: str = PIECE_MODEL) -> tuple[DataFrame, DataFrame]:
    """(one row per document with its distinct linked pairs, corpus counts of the pairs with `best`), both written."""
    shipped(__name__)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(_aligner(folder, byte_name, piece_name), ALIGNED)
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")
    pieces = len(piece_side(f"{folder}/{piece_name}")[1])
    totals = _links(rows).groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair") % pieces)
    totals = saved(totals, "pairs")
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    counted = totals.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    return rows, saved(counted, "pair_counts")


def _links(rows: DataFrame) -> DataFrame:
    """(row, pair, n) of each distinct linked pair of a document."""
    both = rows.select("row", F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    return both.select("row", F.col("x.pairs").alias("pair"), F.col("x.counts").cast("long").alias("n"))


def alignment_summary(rows: DataFrame, pair_counts: DataFrame) -> DataFrame:
    """Per document its token, group and link counts, and how its links stand among those of the corpus."""
    # No more pairs than bytes in both vocabularies (see above), whatever the corpus.
    told = _links(rows).join(F.broadcast(pair_counts), "pair")
    sums = told.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum")
    )
    none = F.lit(0).cast("long")
    return rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )


@register("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_summary(*align(table(spark, sf_dir, "documents")))
