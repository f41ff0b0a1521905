"""Mixing sources to target weights by hierarchical budgeting, with DataFrame operations only.

Leaves are the paths of a tree (domain, language, source).  A token budget goes
down from the root: each node's share is split among its children by weight.  A
child whose subtree cannot supply its share (all its tokens times ``max_epochs``)
gives all it has, and what it lacks goes to its siblings by weight; only what a
whole family lacks reaches the siblings of its parent.  Filling each family to a
common level (tokens for each unit of weight) against the children's supplies
does this in one window over the nodes, without iterating.

A leaf takes whole epochs and then a prefix of one more.  An epoch's order is
md5(seed:epoch:id), and the prefix ends before the first document that would
exceed the budget.  The prefix is found from token sums of hash ranges, so only
the documents of one range per leaf are ever sorted, and the documents themselves
stay where they are.

Tokens are a text's words, one at least (also for null or empty texts).  A null
level value is the node ``(none)``.  A value without a weight has
``default_weight``; weight 0 takes nothing.  Rows with one id are taken together.
An empty table gives an empty result.  Shares are rounded down to whole tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlens.llm.common import drop_clashes, materialize, text_or_empty
from demandlens.llm.quality_rules import words_of

#: Leaves up to which the leaf table (about 200 bytes a row) is broadcast; else it is a shuffle join.
MAX_BROADCAST_LEAVES = 50_000
#: Hex digits of the order key that name a hash range: 4,096 ranges in each leaf.
RANGE_DIGITS = 3
NONE = "(none)"


def tokens_of(text_col: str = "text") -> Column:
    return F.greatest(F.size(words_of(text_or_empty(text_col))), F.lit(1)).cast("long")


def weight_of(level: str, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for value, weight in weights.items():
        out = F.when(F.col(level) == value, weight).otherwise(out)
    return out.cast("long")


def fill_level(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """``allotted`` tokens for each node from its family's ``budget``, ``weight`` and ``supply``."""
    family = Window.partitionBy(*parents)
    order = family.orderBy(F.col("supply") / F.col("weight"), "node")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    wide = "decimal(38,0)"
    first = nodes.where("weight > 0").withColumns({
        "s0": F.coalesce(F.sum("supply").over(before), F.lit(0)).cast(wide),
        "w0": F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "w": F.sum("weight").over(family)})
    # everything it has: its level (supply / weight) would not use up the budget
    level = F.col("s0") * F.col("weight") + F.col("supply").cast(wide) * (F.col("w") - F.col("w0"))
    full = first.withColumn("full", level <= F.col("budget").cast(wide) * F.col("weight"))
    rest = full.withColumns({
        "left": F.col("budget") - F.sum(F.when(F.col("full"), F.col("supply")).otherwise(0)).over(family),
        "open": F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(family)})
    share = F.floor(F.col("left").cast(wide) * F.col("weight") / F.greatest("open", F.lit(1))).cast("long")
    return (rest.withColumn("allotted", F.when(F.col("full"), F.col("supply")).otherwise(share))
            .select(*[c for c in nodes.columns if c != "budget"], "allotted"))


def allot(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: int,
          max_epochs: int, default_weight: int = 1) -> DataFrame:
    """``leaves`` (levels, tokens) with ``allotted``, filled from the root down."""
    leaves = leaves.withColumn("supply", F.col("tokens") * max_epochs)
    for level in levels:
        leaves = leaves.withColumn(f"__w_{level}", weight_of(level, weights.get(level, {}), default_weight))
    budgets = None
    for depth, level in enumerate(levels):
        parents, path = levels[:depth], levels[:depth + 1]
        # what weight 0 shuts off below a node is no supply of the node
        open_ = leaves
        for below in levels[depth:]:
            open_ = open_.where(F.col(f"__w_{below}") > 0)
        nodes = open_.groupBy(*path).agg(F.sum("supply").alias("supply"), F.first(f"__w_{level}").alias("weight"))
        nodes = nodes.withColumn("node", F.col(level))
        if budgets is None:
            nodes, family = nodes.withColumns({"budget": F.lit(budget), "root": F.lit(0)}), ["root"]
        else:
            nodes, family = nodes.join(budgets, parents), parents
        filled = fill_level(nodes, family)
        budgets = filled.select(*path, F.col("allotted").alias("budget"))
    return (leaves.join(budgets, levels, "left")
            .select(*levels, "tokens", F.coalesce("budget", F.lit(0)).cast("long").alias("allotted")))


def order_key(seed: int, epoch: Column, id_col: str) -> Column:
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), ident))


def prefix_cuts(rows: DataFrame, plan: DataFrame, levels: list[str], seed: int) -> DataFrame:
    """Per leaf with a part epoch: the hash range and the key at which its prefix ends."""
    part = plan.where("rest > 0").select(*levels, "epochs", "rest")
    keyed = (rows.join(small(part), levels)
             .withColumn("key", order_key(seed, F.col("epochs"), "doc_id"))
             .withColumn("range", F.substring("key", 1, RANGE_DIGITS)))
    sums = keyed.groupBy(*levels, "range").agg(F.sum("tokens").alias("range_tokens"), F.first("rest").alias("rest"))
    up_to = Window.partitionBy(*levels).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ends = (sums.withColumn("upto", F.sum("range_tokens").over(up_to))
            .where("upto > rest").groupBy(*levels)
            .agg(F.min(F.struct("range", (F.col("upto") - F.col("range_tokens")).alias("below"))).alias("end"))
            .select(*levels, F.col("end.range").alias("range"), F.col("end.below").alias("below")))
    ends = materialize(ends, "mix-ends")
    peers = Window.partitionBy(*levels).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    inside = (keyed.join(small(ends), [*levels, "range"])
              .withColumn("upto", F.col("below") + F.sum("tokens").over(peers)).where("upto <= rest")
              .groupBy(*levels).agg(F.max("key").alias("last_key")))
    return ends.select(*levels, F.col("range").alias("end_range")).join(inside, levels, "left")


def small(table: DataFrame) -> DataFrame:
    """Marked for broadcast if its counted rows are within the bound."""
    return F.broadcast(table) if table.count() <= MAX_BROADCAST_LEAVES else table


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]],
        share: tuple[int, int] = (1, 2), max_epochs: int = 2, seed: int = 7, default_weight: int = 1,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the level columns, ``tokens`` and ``epoch``: one row for each use of a document.

    The budget is ``share`` (numerator, denominator) of all tokens.  A level column
    that the input has under the same name is replaced by its text form.
    """
    names = list(levels)
    values = {n: F.coalesce(c.cast("string"), F.lit(NONE)) for n, c in levels.items()}
    docs = drop_clashes(docs, [*({"tokens", "epoch"} - set(names)), "epochs", "end_range", "last_key", "__key"])
    docs = docs.withColumns(values).withColumn("tokens", tokens_of(text_col))
    rows = materialize(docs.select(*names, F.col(id_col).alias("doc_id"), "tokens"), "mix-rows")
    leaves = materialize(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    budget = total * share[0] // share[1]
    plan = allot(leaves, names, weights, budget, max_epochs, default_weight)
    plan = materialize(plan.withColumns({"epochs": F.expr("allotted div tokens"),
                                         "rest": F.expr("allotted % tokens")}), "mix-plan")
    cuts = prefix_cuts(rows, plan, names, seed)
    uses = materialize(plan.join(cuts, names, "left").drop("tokens", "allotted"), "mix-uses")
    key = order_key(seed, F.col("epochs"), id_col)
    taken = ((F.col("rest") > 0) & ((F.substring("__key", 1, RANGE_DIGITS) < F.col("end_range"))
                                    | F.coalesce(F.col("__key") <= F.col("last_key"), F.lit(False))))
    counted = (docs.join(small(uses), names)
               .withColumn("__key", F.when(F.col("rest") > 0, key))
               .withColumn("__uses", F.col("epochs") + F.coalesce(taken, F.lit(False)).cast("long"))
               .where("__uses > 0"))
    epoch = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__uses") - 1))
    return counted.withColumn("epoch", epoch).drop("__key", "__uses", "epochs", "rest", "end_range", "last_key")
