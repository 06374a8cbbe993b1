"""Template windows and slots."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from pricelake.llm import decontaminate
from pricelake.llm.common import table
from pricelake.llm.decontaminate import contaminated, keep_clean, run_hashes, slot_words, template_words, text_windows, window_hits
from tests.llm.edge import documents, edge_docs, no_docs

QUESTION = "A farmer called Anna sells 12 kg of apples for 3 dollars and then Anna buys 12 kg of pears from her neighbour"


def items(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def found(spark, rows, *texts):
    return sorted((r["doc_id"], r["item_id"]) for r in contaminated(documents(spark, rows), items(spark, *texts)).collect())


def test_other_numbers_and_names_are_caught_and_inconsistent_slots_are_not(spark):
    same = QUESTION.replace("Anna", "Peter").replace("12", "47")
    mixed = QUESTION.replace("Anna", "Peter", 1).replace("12", "47", 1)
    two_for_one = "A farmer called Zoe sells 9 kg of apples for 9 dollars and then Zoe buys 9 kg of pears from her neighbour"
    rows = [(1, "Here it is: " + QUESTION + " and more."), (2, "Well. " + same), (3, mixed), (4, two_for_one), (5, "nothing of that kind here at all, only other words"), (6, QUESTION.upper().lower())]
    assert found(spark, rows, QUESTION)[:2] == [(1, 0), (2, 0)]
    assert {3, 4, 5} & {d for d, _ in found(spark, rows, QUESTION)} == set()


def test_words_and_slots_share_places(spark):
    texts = [QUESTION, "In 3.5 km, see Bob; 7% of 1,000 hours. x9 9x Ünder ß 漢字 5.", "", "12:30 12/4/99 end.5 a.b"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(template_words(F.col("t")).alias("a"), slot_words(F.col("t")).alias("b"))
    for r in frame.collect():
        assert len(r["a"]) == len(r["b"])
        assert all(x == y[0] if x[0] in "\x01\x02\x03" else x == y.lower() for x, y in zip(r["a"], r["b"]))


def test_planted_passages_are_all_found_and_clean_documents_are_left(spark, sf_dir):
    benchmark = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    docs = table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: " ".join((r["text"] or "").split()) for r in docs.collect()}
    whole = {(d, i) for d, t in texts.items() for i, b in benchmark if " ".join(b.split()) in t}
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, table(spark, sf_dir, "benchmark")).collect()}
    assert whole and whole <= got
    for d, i in got - whole:  # the rest shares a long run of words with its item
        words = dict(benchmark)[i].lower().split()
        assert any(" ".join(words[k:k + 8]) in texts[d].lower() for k in range(len(words)))


def test_edge_cases(spark):
    odd = edge_docs(spark)
    texts = ["one two three four five six", "", "7 8 9", "one two three four five six"]
    got = contaminated(odd, items(spark, *texts).unionByName(spark.createDataFrame([(9, None)], "item_id long, text string"))).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(6, 0), (6, 3), (7, 0), (7, 3)]
    assert contaminated(no_docs(spark), items(spark, QUESTION)).collect() == []
    assert contaminated(odd, items(spark)).collect() == []
    kept = keep_clean(odd, items(spark, *texts))
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3


def test_copies_word_for_word_are_found_whatever_became_a_placeholder(spark):
    short, capitals = "What is 17 plus 25?", "NAME THE LARGEST CITY OF THE NORTH BY AREA"
    rows = [
        (1, QUESTION.upper().lower()), (2, "so: what is 17 plus 25 then"), (3, "What is 18 plus 25?"), (4, capitals.title()),
        (5, QUESTION.upper()), (6, "what is plus 17 25"), (7, None), (8, "It reads: " + short),
    ]
    assert found(spark, rows, QUESTION, short, capitals) == [(1, 0), (2, 1), (4, 2), (5, 0), (8, 1)]


def test_new_values_may_coincide_and_names_may_begin_sentences(spark):
    shop = "A shop sells 12 kg of rice for 3 dollars and 7 bags of salt for 5 dollars before noon each day"
    tom = "Tom has 3 red apples today. Tom buys 5 green pears more. Tom eats 2 of them now. Tom counts the rest again."
    rows = [
        (1, shop.replace("12", "9").replace(" 3 ", " 9 ")), (2, tom.replace("Tom", "Ines").replace("3", "8")), (3, "Well, " + tom),
        (4, shop.replace("12", "9").replace("3", "9").replace("7", "9").replace("5", "9")), (5, "He has 3 red apples today."),
    ]
    assert found(spark, rows, shop, tom) == [(1, 0), (2, 1), (3, 1)]


def test_keep_clean_removes_rows_not_ids(spark):
    rows = [(1, QUESTION), (1, "a clean text of the same id"), (None, "no id " + QUESTION), (None, "a clean text without an id")]
    kept = keep_clean(documents(spark, rows), items(spark, QUESTION))
    assert sorted(r["text"] for r in kept.collect()) == ["a clean text of the same id", "a clean text without an id"]


def test_short_questions_with_other_values_are_found_by_their_template(spark):
    short, bare = "What is 17 plus 25?", "Paris 1999"
    rows = [
        (1, "What is 31 plus 48?"), (2, "Well. What is 4 plus 9 then"), (3, "What is 31 minus 48?"), (4, "What is plus 31 48?"), (5, "Rome 2001"),
        (6, "paris 1999"), (7, "What is 8 plus 8?"),
    ]
    got = contaminated(documents(spark, rows), items(spark, short, bare), short_literal=2).collect()
    assert sorted((r["doc_id"], r["item_id"], r["by_template"], r["by_words"]) for r in got) == [(1, 0, True, False), (2, 0, True, False), (6, 1, False, True)]


def test_run_hashes_are_equal_exactly_for_equal_runs(spark):
    words = [random.Random(5).choice("abc") for _ in range(60)]
    for length in range(1, 10):
        frame = spark.createDataFrame([(words,)], "w array<string>").select(run_hashes(F.transform("w", lambda w: F.xxhash64(w)), length).alias("h"))
        got, runs = frame.first()["h"], [tuple(words[i:i + length]) for i in range(len(words) - length + 1)]
        assert len(got) == len(runs) and len(set(zip(got, runs))) == len(set(got)) == len(set(runs))
    short = spark.createDataFrame([(["a", "b"],), ([],)], "w array<string>").select(run_hashes(F.transform("w", lambda w: F.xxhash64(w)), 3).alias("h"))
    assert [r["h"] for r in short.collect()] == [None, None]


def test_items_with_new_values_are_found_by_the_template_alone(spark, sf_dir):
    """Benchmark items with numbers and names drawn anew, planted into the given documents."""
    draw, names = random.Random(11), ["Ada", "Boris", "Chen", "Dalia", "Emeka", "Farah"]
    questions = [
        f"{draw.choice(['A baker', 'One farmer', 'Our shop', 'The school'])} called {a} {draw.choice(['sells', 'orders', 'packs'])} {n} kg of {x} for {m} dollars and later "
        f"{a} {draw.choice(['brings', 'sends'])} {k} boxes of {y} to {b} before the {z} market opens again"
        for n, m, k, a, b, x, y, z in (
            (draw.randrange(10, 99), draw.randrange(100, 999), draw.randrange(2, 9), *draw.sample(names, 2), *draw.sample(["plums", "rice", "beans", "wool", "tea", "salt", "corn", "figs"], 3))
            for _ in range(20)
        )
    ]

    def redrawn(text):
        other, swapped = dict(zip(names, ["Gil", "Hana", "Ivo", "Jana", "Kofi", "Lena"])), {}
        return re.sub(r"\d+", lambda m: swapped.setdefault(m[0], str(1000 + len(swapped) * 7)), re.sub("|".join(names), lambda m: other[m[0]], text))

    docs = table(spark, sf_dir, "documents").select("doc_id", "text").filter("text is not null")
    hosts = {r["doc_id"]: r["text"] for r in docs.orderBy("doc_id").limit(40).collect()}
    planted = {d: i for i, d in enumerate(sorted(hosts)[:20])}
    rows = [(d, f"{t} {redrawn(questions[planted[d]])} {t}" if d in planted else t) for d, t in hosts.items()]
    got = contaminated(documents(spark, rows), items(spark, *questions)).collect()
    assert {(d, i) for d, i in planted.items()} <= {(r["doc_id"], r["item_id"]) for r in got}
    assert {r["doc_id"] for r in got} == set(planted) and not any(r["by_words"] for r in got)


def test_clashing_columns_survive(spark):
    docs = documents(spark, [(1, QUESTION), (2, "a clean text")])
    for name in ("__gone_id", "text_hash", "row", "d.x", "kind"):
        docs = docs.withColumn(name, F.lit(7)) if name not in docs.columns else docs
    kept = keep_clean(docs, items(spark, QUESTION))
    assert kept.columns == docs.columns and [r.asDict() for r in kept.collect()] == [r.asDict() for r in docs.filter("doc_id = 2").collect()]


def test_windows_are_looked_up_by_one_number_and_kind_and_length_are_compared(spark):
    found = spark.createDataFrame([(1, k, n, at, w) for at, (k, n, w) in enumerate([(0, 8, 5), (1, 8, 5), (0, 7, 5), (0, 8, 6), (0, 8, 5)])],
                                  "doc_id long, kind int, length int, at int, window long")
    index = spark.createDataFrame([(0, 77, 8, 3, 5), (0, 78, 8, 0, 5), (1, 79, 8, 1, 5), (0, 80, 8, 2, 9)], "kind int, template long, length int, place int, window long")
    hits = window_hits(found, index)
    assert sorted((r["at"], r["template"], r["shift"]) for r in hits.collect()) == [(0, 77, -3), (0, 78, 0), (1, 79, 0), (4, 77, 1), (4, 78, 4)]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin \[window#\d+L\], \[own_window#\d+L\]", plan)


def test_windows_of_texts_are_those_of_the_index_across_blocks(spark, monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["one", "Two", "the", "12", "x. Anna"]) for _ in range(n)) for n in (0, 1, 2, 3, 7, 8, 9, 40)]
    lengths = [(0, 3), (0, 8), (1, 1), (1, 2), (1, 8)]
    rows = documents(spark, list(enumerate(texts))).withColumn("text_hash", F.xxhash64("text"))
    one = {0: [decontaminate.template_words, decontaminate.wild_words], 1: [decontaminate.plain_words]}
    want = set()
    for kind, n in lengths:
        for words in one[kind]:
            hashed = run_hashes(F.transform(words(F.col("text")), lambda w: F.xxhash64(w)), n)
            want |= {(r["doc_id"], kind, n, r["at"], r["window"]) for r in rows.select("doc_id", F.posexplode(hashed).alias("at", "window")).collect()}
    for block in (1, 5, 4096):
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        got = [(r["doc_id"], r["kind"], r["length"], r["at"], r["window"]) for r in text_windows(rows, lengths).collect()]
        assert set(got) == want and len(got) == sum(max(0, r["n"] - n + 1) for kind, n in lengths for words in one[kind] for r in rows.select(F.size(words(F.col("text"))).alias("n")).collect())
