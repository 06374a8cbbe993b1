"""Alignment of two tokenizers against a plain loop over the reference encoders."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import sentencepiece
from tokenizers import Tokenizer

from pricelake.llm import token_alignment as T
from tests.llm.edge import documents, edge_docs, no_docs

BYTES, PIECES = f"{T.TOKENIZERS}/{T.BYTE_VOCABULARY}", f"{T.TOKENIZERS}/{T.PIECE_MODEL}"


def brute_force(rows):
    """Rows of op11 by character loops; the byte vocabulary is read by the library its file is written for."""
    plain = Tokenizer.from_file(BYTES)
    plain.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    _, bytes_a = T.byte_side(BYTES)
    told, pairs = [], Counter()
    for doc, text in rows:
        raw, a, b = b" " + (text or "").encode(), [], []
        if text:
            a, b = plain.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
            own = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in map(model.id_to_piece, b)]
            if b"".join(bytes_a[i] for i in a) != raw or b"".join(own) != raw:
                a, b = [], []
        ends_a, ends_b, at = {}, {}, 0
        for i in a:
            at += len(bytes_a[i])
            ends_a[at] = i
        at = 0
        for i, piece in zip(b, own if b else []):
            at += len(piece)
            ends_b[at] = i
        both = sorted(set(ends_a) & set(ends_b))
        groups, own_ends = [([], []) for _ in both], set(both)
        for side, ends in enumerate((ends_a, ends_b)):
            k = 0
            for end in sorted(ends):
                groups[k][side].append(str(ends[end]))
                k += end in own_ends
        text_of = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        links = [(ends_a[e], ends_b[e]) for e in both]
        pairs.update(links)
        told.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(text_of.encode()).hexdigest() if a else ""))
    most = defaultdict(int)
    for (_, b), n in pairs.items():
        most[b] = max(most[b], n)
    return Counter(
        (doc, n_a, n_b, groups, len(links), sum(pairs[x] == most[x[1]] for x in links), sum(pairs[x] for x in links), sha)
        for doc, n_a, n_b, groups, links, sha in told
    )


def aligned(docs):
    return Counter(tuple(r) for r in T.alignment_summary(*T.align(docs)).collect())


AWKWARD = [
    None, "", " ", "a", "  two  spaces\n\n\tand tabs ", "<s> [INST] <|endoftext|> </s>", "▁ piece mark", "émigré 漢字 \U0001f600 naïve", "it's 1234567 o'clock!!!",
    "same text", "same text", "\x00\x01\x7f", "  　x", "word " * 3000, "﻿bom", "ﬁ ligature Å é",
]


def test_awkward_texts_equal_a_plain_loop(spark):
    rows = [(i, t) for i, t in enumerate(AWKWARD)]
    assert aligned(documents(spark, rows)) == brute_force(rows)


def test_documents_equal_a_plain_loop(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert aligned(docs) == brute_force([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_edge_documents_and_empty_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs(spark).collect()]
    assert aligned(edge_docs(spark)) == brute_force(rows)
    assert aligned(no_docs(spark)) == Counter()


def test_both_readers_of_the_byte_vocabulary_agree():
    plain = Tokenizer.from_file(BYTES)
    plain.encode_special_tokens = True
    encode, _ = T.byte_side(BYTES)
    points = random.Random(3).sample([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], 30_000)
    texts = [f"a{c}a 1{c}1 !{c}! {c}{c}  {c}x'{c}" for c in map(chr, points)] + [" " * 300_000 + "x", "\n" * 300_000, "a" * 300_000]
    for i in range(0, len(texts), 1000):
        own = texts[i:i + 1000]
        assert [e.ids for e in plain.encode_batch([" " + t for t in own], add_special_tokens=False)] == [x.tolist() for x in encode(own)]


def test_pairs_of_ids_are_fewer_than_bytes_of_the_vocabularies(spark, sf_dir):
    _, counted = T.align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    (_, bytes_a), (_, bytes_b) = T.byte_side(BYTES), T.piece_side(PIECES)
    assert counted.count() <= sum(map(len, bytes_a)) + sum(map(len, bytes_b))
    for r in counted.select("pair").distinct().limit(2000).collect():
        a, b = bytes_a[r["pair"] // len(bytes_b)], bytes_b[r["pair"] % len(bytes_b)]
        assert a.endswith(b) or b.endswith(a)
