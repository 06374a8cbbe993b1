"""Context mixing and the unigram base against plain loops."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pricelake.llm import lm_scoring as L
from tests.llm.edge import LONG, WORD, documents, edge_docs, no_docs

M32 = (1 << 32) - 1


def tokens(text):
    return [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in WORD.findall(text or "")] + ["\n"]


def stream(text):
    words = tokens(text)[:-1]
    return " ".join(words).encode() + b"\n"


def is_held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def is_learnt(doc):
    return doc is not None and not is_held_out(doc)


def base_rows(rows):
    counts = Counter(t for doc, text in rows if is_learnt(doc) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc, text in rows:
        own = tokens(text)
        out.append((doc, is_held_out(doc), len(own), sum(counts[t] > 0 for t in own), n, round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own), 6)))
    return Counter(out)


def hashes(text):
    """Per byte of the stream the hash of each predictor's context, by plain integers."""
    raw, out, words, part, power = stream(text), [], [0], 0, 1
    mix = lambda x, salt: ((y := (x + salt * 0x51ED27) * 0x85EBCA6B & M32) ^ y >> 15) * 0xC2B2AE35 & M32
    for i, byte in enumerate(raw):
        low = [raw[i - k] + 1 if i >= k else 0 for k in (1, 2, 3)]
        three = low[0] | low[1] << 9 | (low[2] << 18)
        out.append([mix(x & M32, k) for k, x in enumerate((three, part, part * 0x9E3779B1 & M32 ^ words[-1]))])
        if byte == 32:
            words.append((part * 0x85EBCA6B + 7) & M32)
            part, power = 0, 1
        else:
            part, power = (part + (byte + 1) * power) & M32, power * 0x01000193 & M32
    return raw, out


def steps(text, code, bits):
    """(node, bit, slots) of each decision."""
    raw, contexts = hashes(text)
    for byte, own in zip(raw, contexts):
        for k in range(code.start[byte], code.start[byte] + code.size[byte]):
            node = int(code.node[k])
            yield node, int(code.bit[k]), [((c ^ node * 0x9E3779B1 & M32) * 0x85EBCA6B & M32) >> (32 - bits) for c in own]


def slow_score(text, model):
    total = 0.0
    for node, bit, slots in steps(text, model.code, model.bits):
        x = [float(table[s]) * L.STEP for table, s in zip(model.odds, slots)]
        gate = node * 4 + (x[-2] != 0) + 2 * (x[-1] != 0)
        odds = max(-15.0, min(15.0, sum(w * v for w, v in zip(model.weights[:, gate], x)) + float(model.weights[-1, gate])))
        p = 1 / (1 + math.exp(-odds))
        cell = node * L.BUCKETS + int(odds * 2 + L.BUCKETS / 2)
        p = min(max((p + float(model.refined[0, cell]) + float(model.refined[1, cell]) * p) / 2, 2.0**-20), 1 - 2.0**-20)
        total += math.log10(p if bit else 1 - p)
    return total


TEXTS = ["The cat sat on the mat.", "the  CAT\n\nsat on\tthe hat", "", None, "émigré 漢字 a", "x", " \n ", LONG[:3000], "the cat sat on the mat."] + [f"word{i % 7} item{i % 5} the end" for i in range(40)]


@pytest.fixture(scope="module")
def small(spark):
    docs = documents(spark, list(enumerate(TEXTS)))
    return docs, L.learn(docs.select("text"), bits=12)


def test_counts_are_those_of_all_texts(small):
    _, model = small
    zeros, ones = np.zeros((2, L.PREDICTORS, 1 << 12), np.int64)
    for text in TEXTS:
        for _, bit, slots in steps(text, model.code, 12):
            for i, s in enumerate(slots):
                (ones if bit else zeros)[i, s] += 1
    assert all(np.array_equal(L.log_odds(z, o), own) for z, o, own in zip(zeros, ones, model.odds))


def test_scores_equal_a_plain_loop(small):
    _, model = small
    raws = [(t or "").encode() for t in TEXTS]
    scores, sizes = L.score_texts(raws, model)
    assert sizes.tolist() == [len(stream(t)) for t in TEXTS]
    assert scores == pytest.approx([slow_score(t, model) for t in TEXTS], rel=1e-4)
    alone = [L.score_texts([r], model)[0][0] for r in raws]
    assert scores == pytest.approx(alone, rel=1e-9)  # neighbours in a batch do not matter


def test_probabilities_of_all_next_bytes_sum_to_one(small):
    _, model = small
    whole = sum(10 ** (slow_score_of_byte(b, model)) for b in range(256))
    assert whole == pytest.approx(1, abs=1e-4)


def slow_score_of_byte(byte, model):
    """log10 probability of one byte at the start of a text."""
    node, bit, slots, _ = L.decisions(np.array([byte], np.uint8), [c[:1] for c in L.contexts(np.array([10], np.uint8), np.zeros(1, np.int32))], model.code, model.bits)
    x, gate = L.inputs(slots, model.odds, node)
    p = L.refine(node, L.mixed(x, gate, model.weights), model.refined)
    return float(np.log10(np.where(bit, p, 1 - p)).sum())


def test_code_is_a_prefix_code_and_short_for_frequent_bytes():
    code = L.huffman(np.array([1000 if b == 97 else b % 3 for b in range(256)]))
    assert sum(2.0 ** -int(n) for n in code.size) == pytest.approx(1) and code.size[97] == code.size.min()


def test_base_equals_a_plain_loop(spark, sf_dir, monkeypatch):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), edge_docs(spark)):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        for head in (20, 100_000):
            monkeypatch.setattr(L, "HEAD", head)
            got = L.scored(docs, bits=12).select(*names).collect()
            assert Counter((*r[:5], round(r[5], 6)) for r in got) == base_rows(rows)


def test_held_out_texts_of_known_words_are_predicted_better_than_by_words_alone(spark, sf_dir):
    """The base gives every unknown word the mass of one, the model spells it out; so only known words compare."""
    got = [r for r in L.scored(spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")).collect() if r["held_out"]]
    known = [r for r in got if r["n_known"] == r["n_tokens"]]
    assert len(known) > 10 and sum(r["score"] for r in known) > sum(r["base_score"] for r in known)
    assert sum(r["bits_per_byte"] for r in got) / len(got) < 2.6  # a code of single bytes takes 4.4


def test_empty_table_and_nothing_to_learn_from(spark):
    assert L.scored(no_docs(spark), bits=10).collect() == []
    held = next(i for i in range(100) if is_held_out(i))
    (row,) = L.scored(documents(spark, [(held, "some words")]), bits=10).collect()
    assert row["held_out"] and row["n_known"] == 0 and row["train_tokens"] == 0 and math.isfinite(row["score"])


def test_equal_bytes_behind_equal_contexts_are_counted_together(monkeypatch):
    texts = TEXTS * 20
    code, given, whole = L.huffman(np.ones(256)), [], L.decisions
    monkeypatch.setattr(L, "decisions", lambda data, own, *rest: given.append(len(data) * len(own)) or whole(data, own, *rest))

    def counts():
        given.clear()
        rows = [r for b in L._slot_counts(code, 12)(iter([pa.record_batch([pa.array(texts)], names=["text"])])) for r in b.to_pylist()]
        return {r["block"]: np.frombuffer(r["counts"], L._KINDS[len(r["counts"]) // L.BLOCK_COUNTS]).tolist() for r in rows}

    together = counts()
    assert sum(given) < L.PREDICTORS * sum(len(stream(t)) for t in TEXTS)  # of 20 times as many bytes
    plain = np.zeros((L.PREDICTORS, 2 << 12), np.int64)
    for text in texts:
        for _, bit, slots in steps(text, code, 12):
            for i, s in enumerate(slots):
                plain[i, 2 * s + bit] += 1
    assert together == {b: own.tolist() for b, own in enumerate(plain.reshape(-1, L.BLOCK_COUNTS)) if own.any()}
    for size in (64, 5000):
        monkeypatch.setattr(L, "PAIR_BYTES", size)
        monkeypatch.setattr(L, "PART_BYTES", size // 3)
        assert counts() == together


def test_scores_do_not_depend_on_the_parts_worked_on(small, monkeypatch):
    _, model = small
    raws = [(t or "").encode() for t in TEXTS]
    whole = L.score_texts(raws, model)[0]
    monkeypatch.setattr(L, "PART_BYTES", 37)
    assert L.score_texts(raws, model)[0] == pytest.approx(whole, rel=1e-9)
