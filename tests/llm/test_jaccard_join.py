"""Components against brute force over all pairs."""

from __future__ import annotations

import random

import pytest

from pricelake.llm.jaccard_join import jaccard_components, keep_one
from tests.llm.edge import WORD, documents, edge_docs, no_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def expected(rows):
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    return sorted(((rows[i][0], len(sets[i]), min((d for d in groups[find(i)] if d is not None), default=None)) for i in range(len(rows))), key=repr)


def near_copies(seed, groups, copies, words, edits):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        if g % 3 == 0:
            base[10:10] = passage
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = text[: int(len(text) * rng.uniform(0.7, 1))]
            rows.append((len(rows) + 10, " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("frequent", [4096, 4])
def test_components_equal_brute_force(spark, frequent):
    rows = near_copies(3, 9, 14, 90, 5) + [(1000 + i, t) for i, t in enumerate(["a b c d e f", "A B c d e f", "a b c", "a  b\tc", "a b"])]
    got = jaccard_components(documents(spark, rows), frequent=frequent).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_edge_cases(spark):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs(spark).collect()]
    assert sorted(map(tuple, jaccard_components(edge_docs(spark)).collect()), key=repr) == expected(rows)
    assert jaccard_components(no_docs(spark)).collect() == []


def test_keep_one_keeps_the_smallest_of_each_group_and_all_columns(spark):
    rows = near_copies(5, 4, 6, 60, 2)
    docs = documents(spark, rows)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in expected(rows)}


def test_keep_one_counts_rows_not_ids(spark):
    a, b = "one two three four five six seven", "other words that nobody else has in his text"
    c = "a third text without an id that comes twice"
    rows = [(1, a), (1, a), (2, a), (2, b), (None, a), (None, c), (None, c), (5, None), (5, None)]
    kept = [(r["doc_id"], r["text"]) for r in keep_one(documents(spark, rows)).collect()]
    assert sorted(kept, key=repr) == sorted([(1, a), (2, b), (None, c), (5, None), (5, None)], key=repr)
