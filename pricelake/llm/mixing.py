"""Mixing sources to target weights by hierarchical budgeting.

Leaves are the ends of a tree such as domain, language, source. A token budget is handed down the tree: children
share their parent's budget by weight, a child never gets more than the leaves below it can supply, and what it
cannot use goes to its siblings. Since a parent passes on all that its own leaves can supply, a shortage is made
good among siblings first and reaches the parent's siblings only when the whole branch is short. Each leaf then
takes a prefix of its tokens from a seeded shuffle, epoch after epoch up to `max_epochs`.

All quantities are whole numbers; what integer division leaves over stays unspent (below one token per child).
A document belongs to the prefix if it starts inside it and ends at or before its end, so a leaf stays within its
budget and misses it by less than one document.

A leaf may hold any share of all rows: token sums are taken per slice of the shuffle order, only the slice that
holds a prefix's end is searched row by row, and the slices grow in number with the rows of the leaf.

Edge cases: null keys of the tree are the key ''. Null and empty texts have no tokens and are taken with what lies
beside them; a leaf without tokens is taken once. Equal rows lie side by side in the shuffle. Keys without a weight get
`other_weight`. A budget above the supply takes all epochs of all leaves; an empty table gives an empty result.
Columns named like those added here are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pricelake.llm.common import SPACE, saved, sized, table
from pricelake.plans.registry import register

SEED = 7
ROWS_PER_SLICE = 5_000
#: Production weights of the registered query; the domain of a source is its number modulo three.
WEIGHTS = {
    "domain": {"web": 50, "books": 30, "forum": 20},
    "lang": {"en": 60, "de": 15, "fr": 15, "es": 10},
    "source": {},
}
TREE = ("domain", "lang", "source")
BUDGET_PERCENT = 70
MAX_EPOCHS = 2


def tokens(text: Column) -> Column:
    """Words of a text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, SPACE, -1))).cast("long")


def domain(source: Column) -> Column:
    number = F.coalesce(F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d+)$", 1).try_cast("long"), F.lit(0)) % 3
    return F.when(number == 0, "web").when(number == 1, "books").otherwise("forum")


def _weight(name: str, weights: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for key, value in weights.items():
        out = F.when(F.col(name) == key, value).otherwise(out)
    return out.cast("long")


def share_out(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Adds `budget` per child: the parent's `given` by `weight`, no child above its `supply`, the rest to siblings.

    Children are taken by supply per weight; the first ones are filled as long as their supply is below their
    share of what is left, the others divide the rest by weight.
    """
    order = W.partitionBy(*parents).orderBy(F.try_divide(F.col("supply").cast("double"), F.col("weight")), name)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    told = children.filter("weight > 0").withColumns({
        "place": F.row_number().over(order),
        "left": F.col("given") - F.coalesce(F.sum("supply").over(before), F.lit(0)),
        "open": F.sum("weight").over(W.partitionBy(*parents)) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    }).withColumn("full", F.col("supply") * F.col("open") <= F.col("left") * F.col("weight"))
    # Filled children form a prefix of the order; the first that is not sets what the rest divide.
    first = F.min(F.when(~F.col("full"), F.struct("place", "left", "open"))).over(W.partitionBy(*parents))
    told = told.withColumn("first", first)
    rest = F.expr("first.left * weight div first.open")
    return told.withColumn("budget", F.when(F.col("first").isNull() | (F.col("place") < F.col("first.place")), F.col("supply")).otherwise(rest)).drop(
        "left", "open", "full", "place", "first"
    )


def leaf_budgets(
    leaves: DataFrame, tree: tuple[str, ...], weights: dict[str, dict[str, int]], budget: int, max_epochs: int, other_weight: int = 10,
) -> DataFrame:
    """(tree keys, n_tokens, n_rows, budget) per leaf."""
    level = leaves.withColumn("supply", F.col("n_tokens") * max_epochs)
    given = None
    for depth, name in enumerate(tree):
        parents = list(tree[:depth])
        children = level.groupBy(*tree[: depth + 1]).agg(F.sum("supply").alias("supply")).withColumn("weight", _weight(name, weights.get(name, {}), other_weight))
        children = children.withColumn("given", F.lit(budget).cast("long")) if given is None else children.join(given, parents)
        given = share_out(children, parents, name).select(*tree[: depth + 1], F.col("budget").alias("given"))
    return leaves.join(given, list(tree)).withColumnRenamed("given", "budget")


def mix(
    docs: DataFrame, tree: tuple[str, ...] = TREE, weights: dict[str, dict[str, int]] = WEIGHTS, budget: int | None = None,
    budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
) -> DataFrame:
    """The selected rows with epoch (from 0) and n_tokens, once per epoch that selects them.

    Without a budget in tokens it is a percentage of the tokens there are.
    """
    keys = [f"key_{k}" for k in tree]
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(
        F.struct(*(c for c in docs.columns if c not in ("n_tokens", "epoch"))).alias("row"), *(F.coalesce(F.col(k), F.lit("")).alias(f"key_{k}") for k in tree),
        tokens(F.col("text")).alias("n_tokens"), F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text)).alias("spin"),
    )
    leaves = keyed.groupBy(*keys).agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_rows"))
    leaves = saved(leaves.toDF(*tree, "n_tokens", "n_rows"), "leaves")
    if budget is None:
        budget = (leaves.agg(F.sum("n_tokens")).first()[0] or 0) * budget_percent // 100
    budgets = saved(leaf_budgets(leaves, tree, weights, budget, max_epochs), "budgets").toDF(*keys, "leaf_tokens", "leaf_rows", "budget")
    return _prefixes(keyed, budgets, keys, max_epochs, seed).select("row.*", "n_tokens", "epoch")


def _prefixes(keyed: DataFrame, budgets: DataFrame, keys: list[str], max_epochs: int, seed: int) -> DataFrame:
    """Rows of each leaf's prefix; whole epochs need no search, the last epoch is cut where the budget ends."""
    told = keyed.join(sized(budgets), keys).withColumn("whole", F.when(F.col("leaf_tokens") > 0, F.expr("budget div leaf_tokens")).otherwise(1))
    epochs = F.filter(F.sequence(F.lit(0), F.lit(max_epochs - 1)), lambda e: e <= F.col("whole"))
    each = told.withColumn("epoch", F.explode(epochs)).withColumn("room", F.col("budget") - F.col("whole") * F.col("leaf_tokens"))
    whole = each.filter("epoch < whole")
    # The order inside an epoch: a hash of seed, epoch and id.
    last = each.filter("epoch = whole and room > 0").withColumn("turn", F.md5(F.concat_ws(":", F.lit(seed), F.col("epoch"), F.col("spin"))))
    slices = F.expr(f"leaf_rows div {ROWS_PER_SLICE} + 1")
    last = last.withColumn("slice", (F.conv(F.substring("turn", 1, 8), 16, 10).cast("long") * slices / F.lit(float(1 << 32))).cast("long"))
    sums = last.groupBy(*keys, "slice").agg(F.sum("n_tokens").alias("t"), F.first("room").alias("room"))
    ahead = W.partitionBy(*keys).orderBy("slice")
    sums = sums.withColumn("upto", F.sum("t").over(ahead)).select(*keys, "slice", F.col("upto"), (F.col("upto") - F.col("t")).alias("from_"))
    placed = last.join(sized(saved(sums, "slices")), [*keys, "slice"])
    inside = placed.filter("upto <= room")
    cut = placed.filter("upto > room and from_ <= room")
    order = W.partitionBy(*keys).orderBy("turn")
    cut = cut.withColumn("end", F.col("from_") + F.sum("n_tokens").over(order.rowsBetween(W.unboundedPreceding, 0))).filter("end <= room").drop("end")
    drop = ["leaf_tokens", "leaf_rows", "budget", "whole", "room", "turn", "slice", "upto", "from_"]
    return whole.drop(*drop).unionByName(inside.drop(*drop)).unionByName(cut.drop(*drop))


def _level_sql(depth: int, tree: tuple[str, ...], weights: dict[str, dict[str, int]], budget: str, max_epochs: int) -> str:
    """share_out of one level in SQL; `given{depth}` has the budgets."""
    name, keys, parents = tree[depth], ", ".join(tree[: depth + 1]), ", ".join(tree[:depth])
    cases = " ".join(f"when '{k}' then {v}" for k, v in weights.get(name, {}).items())
    weight = f"case {name} {cases} else 10 end" if cases else "10"
    part = f"partition by {parents}" if parents else ""
    source = f"(select *, {budget} as given from c{depth})" if not depth else f"c{depth} join given{depth - 1} using ({parents})"
    return f"""
c{depth} as (select {keys}, cast(sum(n_tokens) * {max_epochs} as hugeint) as supply, cast({weight} as hugeint) as weight from leaves group by {keys}),
o{depth} as (select *, row_number() over w as place, given - coalesce(sum(supply) over (w rows between unbounded preceding and 1 preceding), 0) as rest,
    sum(weight) over ({part}) - coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0) as free
  from {source} window w as ({part} order by supply::double / weight, {name})),
f{depth} as (select *, min(case when supply * free > rest * weight then place end) over ({part}) as first from o{depth}),
given{depth} as (select {keys}, case when first is null or place < first then supply
    else max(case when place = first then rest end) over ({part}) * weight // max(case when place = first then free end) over ({part}) end as given from f{depth})"""


def oracle(tree: tuple[str, ...] = TREE, weights: dict[str, dict[str, int]] = WEIGHTS, percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    levels = ",".join(_level_sql(d, tree, weights, f"(select sum(n_tokens) * {percent} // 100 from leaves)", max_epochs) for d in range(len(tree)))
    keys = ", ".join(tree)
    return rf"""
with d as (
  select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n_tokens,
    case coalesce(try_cast(regexp_extract(coalesce(source, ''), '(\d+)$', 1) as bigint), 0) % 3 when 0 then 'web' when 1 then 'books' else 'forum' end as domain,
    coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, '')) as spin from documents),
leaves as (select {keys}, sum(n_tokens) as n_tokens from d group by {keys}),{levels},
told as (
  select d.*, l.n_tokens as leaf, given, case when l.n_tokens > 0 then given // l.n_tokens else 1 end as whole
  from d join leaves l using ({keys}) join given{len(tree) - 1} using ({keys})),
each as (select told.*, e as epoch, given - whole * leaf as room from told, range({max_epochs}) t(e) where e <= whole),
run as (select *, sum(n_tokens) over (partition by {keys}, epoch order by md5('{seed}:' || epoch || ':' || spin) rows unbounded preceding) as ending from each)
select doc_id, domain, lang, source, n_tokens, cast(epoch as integer) as epoch from run where epoch < whole or (room > 0 and ending <= room)
"""


@register("op5_mixing", oracle())
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("domain", domain(F.col("source")))
    return mix(docs).select(
        "doc_id", "domain", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "n_tokens", "epoch"
    )
