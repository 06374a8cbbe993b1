"""Secret scans over an incremental ledger of blobs.

Every historical version of a text is a blob named by its SHA-256. The ledger says which rule version has
scanned which blob; a run scans only the pairs it has not had, each distinct text once however many paths hold
it, adds what it finds, and joins all findings back to all paths. DataFrame operations only.

Positions: a text is split at the matches of a rule, so a match starts after the parts and matches before it.
All positions are code points, the end exclusive. Matches are leftmost and do not overlap within a rule;
those that fail the rule's length test are dropped afterwards.

Edge cases: null text is the empty blob. Equal texts share a blob and get equal findings, repeated rows stay
repeated. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import running_sums, saved, sha_hex, table
from pricelake.plans.registry import register


@dataclass(frozen=True)
class Rule:
    """A pattern whose group must have a least length in code points; kinds are listed in this order."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", 0, 20),
    # Of a run of hexadecimal digits only those of 24 or more count, so shorter runs need no match.
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)

LEDGER = "blob string, kind string, version int, spans array<struct<start: int, end: int>>"


def blobs(history: DataFrame, path: str = "doc_id", text: str = "text") -> DataFrame:
    """(path, blob, text) of every version."""
    content = F.coalesce(F.col(text), F.lit(""))
    return history.select(F.col(path).alias("path"), sha_hex(content).alias("blob"), content.alias("text"))


def rule_spans(text: Column, rule: Rule) -> Column:
    """The spans of a rule's matches, array<struct<start, end>>."""
    pattern = F.lit(rule.pattern)
    lengths = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    matched = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length)
    tested = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length)
    pairs = F.arrays_zip(F.slice(lengths, 1, F.size(matched)).alias("gap"), matched.alias("length"), tested.alias("tested"))
    span = "struct<start: int, end: int>"
    ends = running_sums(F.transform(pairs, lambda x: x["gap"] + x["length"]))
    told = F.zip_with(pairs, ends, lambda x, end: F.struct(x["tested"].alias("tested"), (end - x["length"]).alias("start"), end.alias("end")))
    good = F.filter(told, lambda x: x["tested"] >= rule.least)
    found = F.transform(good, lambda x: F.struct(x["start"].cast("int").alias("start"), x["end"].cast("int").alias("end")))
    return F.when(text.rlike(rule.pattern), found).otherwise(F.array().cast(f"array<{span}>"))


def scan_unseen(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows: the blobs of these versions under the rule versions that have not scanned them."""
    distinct = versions.groupBy("blob").agg(F.first("text").alias("text"))
    seen = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "kind", "version")).alias("seen"))
    todo = distinct.join(seen, "blob", "left")
    fresh = F.array(*(
        F.when(
            ~F.coalesce(F.array_contains("seen", f"{r.kind}:{r.version}"), F.lit(False)),
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), rule_spans(F.col("text"), r).alias("spans")),
        ) for r in rules
    ))
    return todo.select("blob", F.explode(fresh).alias("f")).filter("f is not null").select("blob", "f.*")


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, blob, found): all spans of a version's blob under the given rules, by start and then by kind as listed."""
    current = reduce(lambda a, b: a | b, ((F.col("kind") == r.kind) & (F.col("version") == r.version) for r in rules))
    rank = F.element_at(F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i)))), F.col("kind"))
    told = ledger.filter(current).filter(F.size("spans") > 0).select(
        "blob", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"), F.col("kind").alias("kind"))).alias("own")
    )
    # At most one row per rule and blob.
    by_blob = told.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("own"))).alias("found"))
    return versions.select("path", "blob").join(by_blob, "blob", "left")


def span_text(found: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","), F.lit(""))


def scan(history: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(findings of every version, ledger with what this run has added); the added rows are written once."""
    ledger = history.sparkSession.createDataFrame([], LEDGER) if ledger is None else ledger
    versions = blobs(history)
    added = saved(scan_unseen(versions, ledger, rules), "ledger")
    whole = ledger.unionByName(added)
    return findings(versions, whole, rules), whole


@register("op7_secret_scan", r"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
rules(kind, rank, pattern, grp, least) as (values
  ('assign', 0, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  ('access', 1, '(AKIA[A-Z0-9]+)()', 1, 20), ('hex', 2, '([0-9a-f]+)()', 1, 24)),
matched as (
  select doc_id, kind, rank, least,
    case kind when 'assign' then string_split_regex(text, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)')
      when 'access' then string_split_regex(text, 'AKIA[A-Z0-9]+') else string_split_regex(text, '[0-9a-f]+') end as parts,
    case kind when 'assign' then regexp_extract_all(text, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)
      when 'access' then regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0) else regexp_extract_all(text, '[0-9a-f]+', 0) end as whole,
    case kind when 'assign' then regexp_extract_all(text, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
      when 'access' then regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0) else regexp_extract_all(text, '[0-9a-f]+', 0) end as tested
  from texts, rules),
items as (
  select doc_id, kind, rank, least, unnest(range(1, len(whole) + 1)) as i, unnest(list_transform(parts[:len(whole)], lambda x: length(x))) as gap,
    unnest(list_transform(whole, lambda x: length(x))) as size, unnest(list_transform(tested, lambda x: length(x))) as tested
  from matched),
placed as (
  select *, sum(gap + size) over (partition by doc_id, kind order by i) as ending from items),
spans as (select doc_id, kind, rank, ending - size as start, ending from placed where tested >= least),
told as (
  select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || cast(start as bigint) || ':' || cast(ending as bigint), ',' order by start, rank) as spans
  from spans group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join told using (doc_id)
""")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    spans = span_text(F.col("found"))
    return found.select(
        F.col("path").alias("doc_id"),
        *(F.when(F.col("found").isNull(), 0).otherwise(count(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        sha_hex(spans).alias("base_sha256"), spans.alias("spans"),
    )
