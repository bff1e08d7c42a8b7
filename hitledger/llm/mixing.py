"""Mixing sources to target weights over a domain, language, source tree.

Weights flow down the tree. At each node the children share the node's budget by
weight, none above what its leaves can supply in ``max_epochs`` passes; what a child
cannot supply goes to its siblings, and only what no sibling can take rises to the
parent's siblings. A leaf with an allotment of several passes takes whole seeded epochs
and then the prefix of one more, in an order drawn anew for each epoch.

All arithmetic is on whole numbers. The prefix needs no sort of a leaf: token sums of
ranges of the hash find the one range in which the prefix ends, and only the digests of its rows are put in
order. The digest is of id and text, so the selection does not depend on how rows are dealt. DataFrame functions only.

Null levels are a level of their own (``(none)``), null or empty texts have no tokens:
they come along with whole epochs and with a prefix that reaches them. Repeated rows
are rows like others; where the prefix ends among rows with one id and text, as many of them are taken as fit. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from hitledger.llm.common import small, stored, whole_text

LEVELS = ("domain", "language", "leaf")
#: Ranges of the hash of a leaf, 65,536 at most; the selection does not depend on their number.
BUCKETS = 4096


def spaced_tokens(column: str = "text") -> Column:
    """Pieces between spaces; none in a null or empty text."""
    text = F.col(column)
    return F.when(F.length(text) > 0, F.length(text) - F.length(F.replace(text, F.lit(" "))) + 1).otherwise(0).cast("long")


@dataclass(frozen=True)
class Mix:
    """Target weights per level (1 for what is not named), the budget as a share of all tokens, passes and seed."""

    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    share: tuple[int, int] = (1, 2)
    max_epochs: int = 2
    seed: int = 0
    #: SQL over the columns of the documents.
    domain: str = "'all'"
    language: str = "lang"
    leaf: str = "source"

    def weight(self, level: str) -> Column:
        named = self.weights.get(level, {})
        if any(not isinstance(w, int) or w < 1 for w in named.values()):
            raise ValueError("weights are whole numbers from 1")
        out = F.lit(1).cast("long")
        for value, weight in named.items():
            out = F.when(F.col(level) == value, F.lit(weight).cast("long")).otherwise(out)
        return out


def _share_out(nodes: DataFrame, parent: list[str], level: str, mix: Mix) -> DataFrame:
    """``allotted`` per node: ``budget`` of its parent by weight, no node above its ``supply``."""
    nodes = nodes.withColumn("weight", mix.weight(level))
    within = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    rising = within.orderBy(F.col("supply") / F.col("weight"), level)
    nodes = nodes.withColumns(
        {
            "before": F.coalesce(F.sum("supply").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "open": F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)),
        }
    )
    nodes = nodes.withColumn("full", F.col("supply") * F.col("open") <= F.col("weight") * (F.col("budget") - F.col("before")))
    nodes = nodes.withColumns(
        {
            "taken": F.sum(F.when(F.col("full"), F.col("supply")).otherwise(0)).over(within),
            "left": F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(within),
        }
    )
    allotted = F.when(F.col("full"), F.col("supply")).otherwise(F.expr("(weight * (budget - taken)) div nullif(`left`, 0)"))
    return nodes.withColumn("allotted", allotted.cast("long")).drop("weight", "before", "open", "full", "taken", "left", "budget")


def allot(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (levels, ``tokens``) with ``allotted`` tokens each."""
    num, den = mix.share
    leaves = leaves.withColumn("supply", F.col("tokens") * mix.max_epochs)
    total = leaves.agg(F.expr(f"coalesce(sum(tokens), 0) * {num} div {den}").alias("wanted"), F.sum("supply").alias("most"))
    budget = total.select(F.least("wanted", "most").alias("budget"))
    parents: list[str] = []
    for level in LEVELS:
        nodes = leaves.groupBy(*parents, level).agg(F.sum("supply").alias("supply"))
        # one row at the top, then one row per parent
        nodes = nodes.join(budget, parents) if parents else nodes.join(budget, F.lit(True))
        shared = _share_out(nodes, parents, level, mix)
        parents = [*parents, level]
        budget = shared.select(*parents, F.col("allotted").alias("budget"))
    return leaves.join(budget.withColumnRenamed("budget", "allotted"), parents)


def select_mix(docs: DataFrame, mix: Mix, buckets: int = BUCKETS) -> DataFrame:
    """Chosen rows: ``row`` (all columns of ``docs``), the levels, ``epoch`` and ``n_tokens``; one row per epoch."""
    none = F.lit("(none)")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").alias("id"),
        F.coalesce(F.expr(mix.domain).cast("string"), none).alias("domain"),
        F.coalesce(F.expr(mix.language).cast("string"), none).alias("language"),
        F.coalesce(F.expr(mix.leaf).cast("string"), none).alias("leaf"),
        spaced_tokens().alias("n_tokens"),
        F.md5(whole_text()).alias("seal"),
    )
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    leaves = allot(stored(leaves, "leaves"), mix)
    tokens = F.expr("nullif(tokens, 0)")
    leaves = leaves.select(
        *LEVELS,
        F.coalesce(F.expr("allotted div nullif(tokens, 0)"), F.lit(0)).cast("int").alias("whole"),
        F.coalesce(F.col("allotted") % tokens, F.lit(0)).alias("rest"),
    )
    leaves = small(stored(leaves, "allotted"))
    # by id and text: rows that share it are alike, and rows without an id are spread
    digest = F.md5(F.concat_ws("|", F.lit(str(mix.seed)), F.col("whole"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("seal")))
    rows = rows.join(leaves, [*LEVELS]).withColumn("digest", digest)
    rows = rows.withColumn("bucket", F.floor(F.conv(F.substring("digest", 1, 4), 16, 10).cast("long") * buckets / 65_536).cast("int"))
    up_to = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
    over = F.col("before") + F.col("n") > F.col("rest")
    cuts = sums.groupBy(*LEVELS).agg(
        F.coalesce(F.min(F.when(over, F.col("bucket"))), F.lit(buckets)).alias("cut"),
        F.min(F.when(over, F.col("before"))).alias("before"),
    )
    cuts = small(stored(cuts, "cuts"))
    rows = rows.join(cuts, [*LEVELS])
    # Within the bucket that is cut, digests with their sums are put in order, not rows.
    in_order = Window.partitionBy(*LEVELS).orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    kinds = rows.filter(F.col("bucket") == F.col("cut")).groupBy(*LEVELS, "digest").agg(
        F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("copies"), F.first("rest").alias("rest"), F.first("before").alias("before")
    )
    kinds = kinds.withColumn("upto", F.col("before") + F.sum("n").over(in_order)).filter("upto > rest")
    edges = kinds.groupBy(*LEVELS).agg(F.min(F.struct("digest", "upto", "n", "copies", "rest")).alias("e"))
    edges = edges.select(*LEVELS, F.col("e.digest").alias("edge"), F.expr("(e.rest - e.upto + e.n) div nullif(e.n div e.copies, 0)").alias("some"))
    rows = rows.join(small(stored(edges, "edges")), [*LEVELS], "left")
    out = ["row", "id", *LEVELS, "epoch", "n_tokens"]
    before_edge = F.col("edge").isNull() | (F.col("digest") < F.col("edge"))
    once_more = (F.col("bucket") < F.col("cut")) | ((F.col("bucket") == F.col("cut")) & before_edge)
    epochs = F.sequence(F.lit(0), F.when(once_more, F.col("whole")).otherwise(F.col("whole") - 1))
    whole = rows.filter((F.col("whole") > 0) | once_more).withColumn("epoch", F.explode(epochs)).select(*out)
    # of alike rows at the edge, as many as fit
    alike = rows.filter((F.col("bucket") == F.col("cut")) & (F.col("digest") == F.col("edge")) & (F.col("some") > 0))
    turn = F.row_number().over(Window.partitionBy(*LEVELS, "digest").orderBy("id"))
    at_edge = alike.withColumn("turn", turn).filter("turn <= some").withColumn("epoch", F.col("whole")).select(*out)
    return whole.unionByName(at_edge)


def mix_sql(mix: Mix, table: str = "documents") -> str:
    """The same selection as SQL: windows over whole leaves in place of buckets."""

    def weight(level: str) -> str:
        cases = "".join(f" when {level} = '{k}' then {w}" for k, w in mix.weights.get(level, {}).items())
        return f"(case{cases} else 1 end)" if cases else "1"

    num, den = mix.share
    steps, parents, above = [], [], "top"
    for k, level in enumerate(LEVELS):
        key = ", ".join([*parents, level])
        using = f"using ({', '.join(parents)})" if parents else "on true"
        part = f"partition by {', '.join(parents)}" if parents else ""
        steps.append(f"""n{k} as (select {key}, any_value(budget) as budget, cast(sum(supply) as bigint) as supply, {weight(level)} as weight
  from supplies join {above} {using} group by {key}),
w{k} as (select *, cast(coalesce(sum(supply) over ({part} order by supply / weight, {level} rows between unbounded preceding and 1 preceding), 0) as bigint) as before,
  cast(sum(weight) over ({part} order by supply / weight, {level} rows between current row and unbounded following) as bigint) as open from n{k}),
f{k} as (select *, supply * open <= weight * (budget - before) as is_full from w{k}),
s{k} as (select *, cast(sum(case when is_full then supply else 0 end) over ({part}) as bigint) as taken,
  cast(sum(case when is_full then 0 else weight end) over ({part}) as bigint) as rest_weight from f{k}),
b{k} as (select {key}, case when is_full then supply else (weight * (budget - taken)) // rest_weight end as budget from s{k})""")
        parents.append(level)
        above = f"b{k}"
    tree = ",\n".join(steps)
    levels = ", ".join(LEVELS)
    return f"""with rows_ as (select *, coalesce(cast({mix.domain} as varchar), '(none)') as domain,
  coalesce(cast({mix.language} as varchar), '(none)') as language, coalesce(cast({mix.leaf} as varchar), '(none)') as leaf,
  case when length(text) > 0 then length(text) - length(replace(text, ' ', '')) + 1 else 0 end as n_tokens from {table}),
supplies as (select {levels}, cast(sum(n_tokens) as bigint) as tokens, cast(sum(n_tokens) as bigint) * {mix.max_epochs} as supply from rows_ group by all),
top as (select least(cast(sum(tokens) as bigint) * {num} // {den}, cast(sum(supply) as bigint)) as budget from supplies),
{tree},
shares as (select {levels}, coalesce(budget // nullif(tokens, 0), 0) as whole, coalesce(budget % nullif(tokens, 0), 0) as rest
  from supplies join b2 using ({levels})),
keyed as (select rows_.*, whole, rest, md5(concat_ws('|', '{mix.seed}', whole, coalesce(cast(doc_id as varchar), ''), md5(coalesce(text, '')))) as digest
  from rows_ join shares using ({levels})),
summed as (select *, sum(n_tokens) over (partition by {levels} order by digest rows unbounded preceding) as upto from keyed),
chosen as (select *, unnest(range(whole + case when upto <= rest then 1 else 0 end)) as epoch from summed)"""
