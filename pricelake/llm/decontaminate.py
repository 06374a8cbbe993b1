"""Benchmark decontamination by template canonicalisation.

Numbers, units after numbers and names (capitalised words inside a sentence) become typed placeholders, other
words are lower-cased and punctuation goes. Windows of template words are hashed and joined with the windows of
the benchmark; runs of matches on one alignment are evidence, and an alignment counts only if its slots agree:
one benchmark value always stands for one document value. Two benchmark values may come to the same document value,
but not all values of a kind. So a question with other numbers or names is caught, and a mere form with the same
words is not. A capitalised word that begins a sentence may be a name: windows in which such words are wild (any
capitalised word will do, and no slot is compared) are hashed beside the others. DataFrame operations only.

Beside that, every item is searched for by windows of its lower-cased words with their values kept, so a copy word for
word is found in any case and whatever became a placeholder: all windows of a short item, four fifths of a long one.

An item of fewer words than a window is one window of its own. Windows need `least_literal` words that are no placeholders;
with `short_literal`, a template that has fewer needs all it has (`What is 17 plus 25?`: three), and at least that many.
Templates with fewer still are searched for word for word only: a form such as `<name> <number>` is in half of all texts.

Edge cases: null and empty texts have no windows. Equal items are one template and all of them are reported;
repeated documents are reported once per (doc_id, item_id). A null doc_id is reported as null. Empty tables
give an empty result. Texts are read whole. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import saved, sized, table, without_rows
from pricelake.plans.registry import register

WINDOW = 8
#: Windows of an item on one alignment that are evidence; all but one if the item has fewer (its first word may be
#: a capitalised word inside a sentence elsewhere).
EVIDENCE = 5
LEAST_LITERAL = 4
#: Literal words that a template of fewer than LEAST_LITERAL has to have at least: below, its form says nothing.
SHORT_LITERAL = 2
#: Share of an item's windows, in percent, that a copy word for word has on one alignment (and EVIDENCE of them).
VERBATIM = 80
#: Places of a text whose windows are spread out together.
BLOCK = 4096

_NAME, _NUMBER, _UNIT = "\u0001", "\u0002", "\u0003"
_MARKS = "\u0001-\u0003"
_VALUE = r"[\p{L}\p{M}\p{N}.,:/]*"
# Units that may follow a number.
UNITS = (
    "mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "l", "s", "min", "h", "hours", "hour", "minutes", "minute", "seconds", "days", "day", "weeks",
    "week", "years", "year", "meters", "metres", "miles", "feet", "inches", "grams", "kilograms", "pounds", "litres", "liters", "dollars", "cents",
    "euros", "percent", "degrees", "mph", "kmh", "watts", "volts", "hz",
)


def marked(text: Column) -> Column:
    """The text with a mark before each name, number and unit."""
    bare = F.regexp_replace(text, f"[{_MARKS}]", " ")
    named = F.regexp_replace(bare, r"\p{Lu}(?<=[\p{L},;:]\s\p{Lu})\p{L}*", _NAME + "$0")
    numbered = F.regexp_replace(named, r"\d(?<![\p{L}\p{N}]\d)\d*(?:[.,:/]\d+)*", _NUMBER + "$0")
    units = F.regexp_replace(numbered, rf"({_NUMBER}[\d.,:/]+)\s*(?:{_NAME})?((?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])|[%$€£°])", f"$1 {_UNIT}$2")
    return F.when(numbered.contains(_NUMBER), units).otherwise(numbered)


def _cased_words(text: Column) -> Column:
    bare = F.regexp_replace(marked(text), f"([{_MARKS}]){_VALUE}", "$1")
    return F.array_remove(F.split(bare, rf"[^\p{{L}}\p{{M}}\p{{N}}{_MARKS}]+"), "")


def template_words(text: Column) -> Column:
    """Lower-cased words and placeholders."""
    return F.transform(_cased_words(text), F.lower)


def wild_words(text: Column) -> Column:
    """The same words, those that still have a capital (they begin a sentence) as names."""
    return F.transform(_cased_words(text), lambda w: F.when(F.lower(w) == w, w).otherwise(F.lit(_NAME)))


def slot_words(text: Column) -> Column:
    """The same words in the same places, placeholders with their values."""
    return F.regexp_extract_all(marked(text), F.lit(rf"[{_MARKS}]{_VALUE}|[\p{{L}}\p{{M}}\p{{N}}]+"), F.lit(0))


def plain_words(text: Column) -> Column:
    """Words in one case (`ß` as `ss`), nothing replaced."""
    return F.array_remove(F.split(F.lower(F.upper(text)), r"[^\p{L}\p{M}\p{N}]+"), "")


def _runs(hashed: Column, length: int) -> Column:
    """array<struct<x0, x1, ..>>: each word's hash and those behind it, null past the end."""
    return F.arrays_zip(*(F.slice(hashed, k + 1, F.greatest(F.size(hashed) - k, F.lit(0))).alias(f"x{k}") for k in range(length)))


def run_hashes(hashed: Column, length: int) -> Column:
    """Hash of the run of so many words at each place; null if there are fewer words."""
    whole = F.size(hashed) - length + 1
    runs = F.slice(_runs(hashed, length), 1, F.greatest(whole, F.lit(1)))
    return F.when(whole > 0, F.transform(runs, lambda x: F.xxhash64(*(x[f"x{k}"] for k in range(length)))))


def text_windows(texts: DataFrame, lengths: list[tuple[int, int]]) -> DataFrame:
    """(doc_id, text_hash, kind, length, at, window): the `run_hashes` of the words of texts, for (kind, length) pairs.

    Template words are hashed once more with wild words. Words are hashed in arrays, runs of them after these are exploded, where
    Spark generates code; arrays are cut into blocks of BLOCK places before, so a long text is spread out in pieces.
    """
    told = texts.select("doc_id", "text_hash", _cased_words(F.col("text")).alias("cased"), plain_words(F.col("text")).alias("plain"))
    told = told.select(
        "doc_id", "text_hash", F.transform("cased", lambda w: F.xxhash64(F.lower(w))).alias("lowered"),
        F.transform("cased", lambda w: F.when(F.lower(w) == w, F.xxhash64(w)).otherwise(F.xxhash64(F.lit(_NAME)))).alias("wild"),
        F.transform("plain", lambda w: F.xxhash64(w)).alias("plain"),
    )
    most, least = max(n for _, n in lengths), min(n for _, n in lengths)

    def block(kind: int, length: int, first: Column, words: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(length).alias("length"), first.alias("first"), words.alias("words"))

    def blocks(kind: int, length: int, hashed: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.size(hashed), F.lit(BLOCK))
        cut = F.transform(firsts, lambda at: block(kind, length, at, F.slice(hashed, at + 1, F.lit(BLOCK + most - 1))))
        return F.when(F.size(hashed) <= BLOCK, F.array(block(kind, length, F.lit(0), hashed))).otherwise(cut)

    forms = [blocks(kind, n, F.col(form)) for kind, n in lengths for form in (("lowered", "wild") if kind == TEMPLATE else ("plain",))]
    parts = told.select("doc_id", "text_hash", F.explode(F.concat(*forms)).alias("b")).select("doc_id", "text_hash", "b.*")
    whole = F.least(F.greatest(F.size("words") - F.col("length") + 1, F.lit(0)), F.lit(BLOCK))
    runs = parts.select("doc_id", "text_hash", "kind", "length", "first", F.posexplode(F.slice(_runs(F.col("words"), most), 1, whole)).alias("at", "x"))
    own = [F.col("x")[f"x{k}"] if k < least else F.when(F.col("length") > k, F.col("x")[f"x{k}"]) for k in range(most)]  # a null leaves a hash as it is
    return runs.select("doc_id", "text_hash", "kind", "length", (F.col("first") + F.col("at")).alias("at"), F.xxhash64(*own).alias("window"))


def _literal(words: Column) -> Column:
    return F.size(F.filter(words, lambda w: ~w.isin(_NAME, _NUMBER, _UNIT)))


TEMPLATE, PLAIN = 0, 1


def benchmark_index(items: DataFrame, size: int, least_literal: int, short_literal: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(windows of the distinct templates and plain texts, the items with theirs); kind tells the two apart.

    With `short_literal`, a template whose literal words are fewer than `least_literal` needs only as many as it has, and
    at least `short_literal`.
    """
    told = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    forms = F.array(*(
        F.struct(F.lit(kind).alias("kind"), words(F.col("text")).alias("words"), wild(F.col("text")).alias("wild"), F.lit(least).alias("least"))
        for kind, words, wild, least in ((TEMPLATE, template_words, wild_words, least_literal), (PLAIN, plain_words, plain_words, 1))
    ))
    told = told.select("item_id", "text", F.explode(forms).alias("form")).select("item_id", "text", "form.*").withColumn("template", F.xxhash64("words", "kind"))
    if short_literal is not None:
        own = F.greatest(F.least(F.col("least"), _literal(F.col("words"))), F.lit(short_literal))
        told = told.withColumn("least", F.when(F.col("kind") == TEMPLATE, own).otherwise(F.col("least")))
    told = saved(told.withColumn("length", F.least(F.lit(size), F.size("words"))).filter(_literal(F.col("words")) >= F.col("least")), "items")
    one = told.groupBy("kind", "template", "least").agg(F.collect_set(F.struct("words", "wild", "length")).alias("all"))
    forms = F.flatten(F.transform("all", lambda x: F.array(x["words"], x["wild"])))
    one = one.select("kind", "template", "least", F.col("all")[0]["length"].alias("length"), F.explode(F.array_distinct(forms)).alias("words"))
    hashed = F.transform("words", lambda w: F.xxhash64(w))
    runs = F.element_at(F.array(*(run_hashes(hashed, n) for n in range(1, size + 1))), F.col("length").cast("int"))
    spread = one.select("*", F.posexplode(runs).alias("place", "window"))
    index = spread.filter(_literal(F.slice("words", F.col("place") + 1, F.col("length"))) >= F.col("least")).select(
        "kind", "template", "length", "place", "window"
    )
    return saved(index.distinct(), "index"), told


def window_hits(found: DataFrame, index: DataFrame) -> DataFrame:
    """The windows of texts that are in the index, with the shift of their alignment.

    The 64-bit hash alone is the join key, for which Spark keeps a table of plain numbers; kind and length are compared
    where it matches, as differences, which Spark does not take for further keys.
    """
    own = sized(index).withColumnsRenamed({"kind": "own_kind", "length": "own_length", "window": "own_window"})
    same = (F.col("window") == F.col("own_window")) & (F.col("kind") - F.col("own_kind") == 0) & (F.col("length") - F.col("own_length") == 0)
    return found.join(own, same).drop("own_kind", "own_length", "own_window").withColumn("shift", F.col("at") - F.col("place"))


def evidence_rows(
    docs: DataFrame, items: DataFrame, size: int, evidence: int, least_literal: int, short_literal: int | None = None,
) -> DataFrame:
    """(doc_id, text_hash, item_id, kind, n_windows, n_slots): the texts that hold an item, and how it was found."""
    index, told = benchmark_index(items, size, least_literal, short_literal)
    lengths = sorted((r["kind"], r["length"]) for r in index.select("kind", "length").distinct().collect())  # at most `size` of each kind
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").filter("text is not null")
    if not lengths:
        return docs.sparkSession.createDataFrame([], "doc_id long, text_hash long, item_id long, kind int, n_windows long, n_slots long")
    hits = window_hits(text_windows(texts, lengths), index)
    total = index.groupBy("template").agg(F.count_distinct("place").alias("windows"))
    runs = hits.groupBy("doc_id", "text_hash", "kind", "template", "length", "shift").agg(
        F.count_distinct("place").alias("n_windows"), F.min("place").alias("low"), F.max("place").alias("high")
    )
    few = F.least(F.greatest(F.col("windows") - 1, F.lit(1)), F.lit(evidence))
    most = F.greatest(F.least(F.col("windows"), F.lit(evidence)), F.ceil(F.col("windows") * VERBATIM / 100))
    runs = runs.join(total, "template").filter(F.col("n_windows") >= F.when(F.col("kind") == PLAIN, most).otherwise(few))
    every_run = saved(runs, "runs")
    runs = every_run.filter(F.col("kind") == TEMPLATE)

    # Slots of the documents and items that are left.
    left = runs.select("doc_id", "text_hash").distinct()
    again = texts.alias("a").join(
        sized(saved(left, "left")).alias("b"), (F.col("a.text_hash") == F.col("b.text_hash")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")), "left_semi"
    )
    doc_slots = _slots(again.select("doc_id", "text_hash", "text"), ["doc_id", "text_hash"]).distinct()
    item_slots = _slots(told.filter(F.col("kind") == TEMPLATE).dropDuplicates(["template"]).select("template", "text"), ["template"])
    wanted = runs.join(item_slots, "template").filter((F.col("place") >= F.col("low")) & (F.col("place") < F.col("high") + F.col("length")))
    wanted = wanted.select("doc_id", "text_hash", "template", "shift", "mark", F.col("value").alias("item_value"), (F.col("place") + F.col("shift")).alias("place"))
    on = (F.col("i.text_hash") == F.col("d.text_hash")) & F.col("i.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("i.place") == F.col("d.place")) & (F.col("i.mark") == F.col("d.mark"))
    pairs = wanted.alias("i").join(doc_slots.alias("d"), on).select("i.doc_id", "i.text_hash", "template", "shift", "i.mark", "item_value", F.col("d.value").alias("doc_value"))
    key = ["doc_id", "text_hash", "template", "shift"]
    ends = [f(F.col("doc_value")).alias(n) for f, n in ((F.min, "least_value"), (F.max, "most_value"))]
    forth = pairs.groupBy(*key, "mark", "item_value").agg(F.count("*").alias("n"), *ends)
    # A kind whose several item values all became one value says nothing; fewer coincidences are left to chance.
    merged = (F.count("*") > 1) & (F.min("least_value") == F.max("most_value"))
    checked = forth.groupBy(*key, "mark").agg(
        F.sum("n").alias("n"), (F.max(F.col("least_value") != F.col("most_value")) | merged).alias("split")
    ).groupBy(*key).agg(F.sum("n").alias("n_slots"), F.max("split").alias("split"))
    agreed = runs.alias("r").join(
        checked.alias("c"), (F.col("r.text_hash") == F.col("c.text_hash")) & F.col("r.doc_id").eqNullSafe(F.col("c.doc_id"))
        & (F.col("r.template") == F.col("c.template")) & (F.col("r.shift") == F.col("c.shift")), "left"
    ).filter(~F.coalesce("split", F.lit(False))).select("r.doc_id", "r.text_hash", "r.template", "kind", "n_windows", F.coalesce("n_slots", F.lit(0)).alias("n_slots"))
    plain = every_run.filter(F.col("kind") == PLAIN).select("doc_id", "text_hash", "template", "kind", "n_windows", F.lit(0).cast("long").alias("n_slots"))
    best = agreed.unionByName(plain).groupBy("doc_id", "text_hash", "template", "kind").agg(F.max(F.struct("n_windows", "n_slots")).alias("m"))
    return best.join(told.select("template", "item_id").distinct(), "template").select("doc_id", "text_hash", "item_id", "kind", "m.n_windows", "m.n_slots")


def contaminated(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, evidence: int = EVIDENCE, least_literal: int = LEAST_LITERAL,
    short_literal: int | None = None,
) -> DataFrame:
    """(doc_id, item_id, n_windows, n_slots, by_template, by_words): documents that hold an item, with the windows and slots that show it."""
    rows = evidence_rows(docs, items, size, evidence, least_literal, short_literal)
    best = rows.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("n_windows", "n_slots")).alias("m"), F.max(F.col("kind") == TEMPLATE).alias("by_template"), F.max(F.col("kind") == PLAIN).alias("by_words")
    )
    return best.select("doc_id", "item_id", "m.n_windows", "m.n_slots", "by_template", "by_words")


def _slots(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, place, mark, value) of the placeholders."""
    spread = rows.select(*key, F.posexplode(slot_words(F.col("text"))).alias("place", "word"))
    mark = F.substring("word", 1, 1)
    return spread.filter(mark.isin(_NAME, _NUMBER, _UNIT)).select(
        *key, "place", mark.alias("mark"), F.lower(F.regexp_replace(F.substr("word", F.lit(2)), r"[.,:/]+$", "")).alias("value")
    )


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows whose text holds no item, with all their columns."""
    rows = evidence_rows(docs, items, WINDOW, EVIDENCE, LEAST_LITERAL, SHORT_LITERAL)
    gone = saved(rows.select("doc_id", "text_hash").distinct(), "gone")
    return without_rows(docs, gone, F.xxhash64("text"))


@register("op4_decontamination")
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short_literal=SHORT_LITERAL)
