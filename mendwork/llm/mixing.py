"""Mixing sources to target weights by hierarchical budgets, with DataFrame operations only.

The tree is domain, language, source. A budget of tokens is split from the root down by weight. A child
can hold its subtree's tokens times ``max_epochs``; what it can't hold goes to its siblings by their weights,
and only what all of them together can't hold is left to the level above, as the parent's own capacity
counts there. All amounts are whole numbers, so the result does not depend on the order of rows.

A leaf's amount is whole epochs plus a token-prefix of one more epoch, in an order seeded per epoch. The
prefix's end is found by token sums of hash ranges; only the range that holds the end is ordered by rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendwork.session import materialise

LEVELS = ["domain", "language", "origin"]
WORDS = r"[^\x20\x09-\x0D]+"
# Leading hexadecimal digits of the order key: 16 ** 4 ranges per leaf.
RANGE_DIGITS = 4


def word_count(column: str = "text") -> Column:
    """Words between ASCII white space; none for a missing text."""
    return F.coalesce(F.regexp_count(F.col(f"`{column}`"), F.lit(WORDS)), F.lit(0)).cast("long")


def domain_of(source: Column, domains: int = 4) -> Column:
    """A source's domain: its trailing number modulo ``domains``; "unknown" without a number."""
    number = F.regexp_extract(source, r"([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("domain"), F.pmod(number.cast("long"), F.lit(domains)))).otherwise("unknown")


def tree(docs: DataFrame, levels: list[Column]) -> list[Column]:
    """The columns of a row's path; a missing name is "unknown"."""
    return [F.coalesce(c.cast("string"), F.lit("unknown")).alias(name) for name, c in zip(LEVELS, levels, strict=True)]


def split_budget(children: DataFrame, parents: list[str]) -> DataFrame:
    """Split each parent's ``budget`` among its rows by ``weight`` without exceeding their ``capacity``.

    Ordered by capacity per weight, a row is full if its share of what is left by the rows before it reaches
    its capacity; the others share the rest by weight, rounded down. One window over the nodes of the tree.
    """
    order = Window.partitionBy(*parents).orderBy((F.col("capacity") / F.col("weight")), "node")
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    whole = Window.partitionBy(*parents)
    marked = children.withColumn("full", F.col("capacity") * weight_left <= F.col("weight") * (F.col("budget") - before))
    held = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(whole), F.lit(0))
    weights = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    marked = marked.withColumn("_held", held).withColumn("_weights", weights)
    amount = F.expr("case when full then capacity else (weight * (budget - _held)) div _weights end")
    return marked.withColumn("amount", amount).drop("_held", "_weights", "full")


def leaf_amounts(
    leaves: DataFrame, weights: dict[str, dict[str, int]], budget: int | None, max_epochs: int
) -> DataFrame:
    """(path, tokens, amount) per leaf from (path, tokens); ``budget`` defaults to all tokens.

    ``weights`` gives whole numbers per level and name; a name that is not in it weighs 1.
    """
    if budget is None:
        budget = leaves.agg(F.sum("tokens")).first()[0] or 0
    def weight(level: str) -> Column:
        out = F.lit(1).cast("long")
        for name, value in weights.get(level, {}).items():
            out = F.when(F.col(level) == name, F.lit(int(value)).cast("long")).otherwise(out)
        return out

    # What lies below a node of weight 0 gets nothing, so it adds nothing to a parent's capacity.
    for level in LEVELS:
        leaves = leaves.where(weight(level) > 0)
    budgets = None
    for depth, level in enumerate(LEVELS):
        path, parents = LEVELS[: depth + 1], LEVELS[:depth]
        nodes = leaves.groupBy(*path).agg(F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", weight(level)).withColumn("capacity", F.col("tokens") * max_epochs).withColumn("node", F.col(level))
        nodes = nodes.join(budgets, parents) if parents else nodes.withColumn("budget", F.lit(int(budget)).cast("long"))
        amounts = split_budget(nodes, parents)
        budgets = amounts.select(*path, F.col("amount").alias("budget"))
    return leaves.join(budgets.withColumnRenamed("budget", "amount"), LEVELS)


def order_key(seed: int, epoch: Column, id_column: str) -> Column:
    """The place of a document in an epoch: md5 of seed, epoch and id. Rows with the same id stand together."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.col(f"`{id_column}`").cast("string")))


def mix(
    docs: DataFrame,
    levels: list[Column] | None = None,
    weights: dict[str, dict[str, int]] | None = None,
    budget: int | None = None,
    max_epochs: int = 2,
    seed: int = 9,
    tokens: Column | None = None,
    id_column: str = "doc_id",
) -> DataFrame:
    """The selected rows of ``docs``, once per epoch that has them, with the columns of the path and ``epoch``.

    Whole epochs of a leaf come first; of the next one the documents in seeded order whose running sum of
    tokens, this one included, stays within the leaf's amount. Documents without tokens follow the same
    order. Rows that share an id (or have none) are taken or left together. Weights of 0 leave a node out.
    An empty table gives no rows. Columns of ``docs`` are kept unless they have a name of the path's.
    """
    levels = levels or [domain_of(F.col("source")), F.col("lang"), F.col("source")]
    tokens = word_count() if tokens is None else tokens
    kept = [c for c in docs.columns if c.lower() not in (*LEVELS, "epoch")]
    placed = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), *tree(docs, levels))
    narrow = materialise(
        docs.select(F.col(f"`{id_column}`").alias("_id"), *tree(docs, levels), tokens.alias("tokens")), "mixing-rows"
    )
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    amounts = leaf_amounts(leaves, weights or {}, budget, max_epochs).select(
        *LEVELS,
        F.expr("if(tokens = 0, 1, amount div tokens)").alias("whole_epochs"),
        F.expr("if(tokens = 0, 0, amount % tokens)").alias("rest"),
    )
    amounts = materialise(amounts, "mixing-amounts")

    key = order_key(seed, F.col("whole_epochs"), "_id")
    keyed = narrow.join(amounts, LEVELS).withColumn("key", key).withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    sums = keyed.groupBy(*LEVELS, "range").agg(F.sum("tokens").alias("sum"), F.first("rest").alias("rest"))
    running = Window.partitionBy(*LEVELS).orderBy("range")
    sums = sums.withColumn("until", F.sum("sum").over(running))
    ends = sums.where("until > rest").groupBy(*LEVELS).agg(
        F.min(F.struct("range", (F.col("until") - F.col("sum")).alias("before"))).alias("end")
    )
    ends = materialise(ends.select(*LEVELS, F.col("end.range").alias("end_range"), F.col("end.before").alias("before")), "mixing-ends")
    # Rows of the one range per leaf that holds the prefix's end; equal keys are taken or left together.
    inside = keyed.join(ends, LEVELS).where("range = end_range")
    by_key = Window.partitionBy(*LEVELS).orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("until", F.col("before") + F.sum("tokens").over(by_key)).where("until <= rest")
    cuts = inside.groupBy(*LEVELS).agg(F.max("key").alias("cut"))
    plan = materialise(
        amounts.join(ends, LEVELS, "left").select(*LEVELS, "whole_epochs", "rest", "end_range").join(cuts, LEVELS, "left"), "mixing-plan"
    )

    # A key is taken if its range lies before the end, or if it is not beyond the last key that fits.
    key = order_key(seed, F.col("whole_epochs"), f"row`.`{id_column}")
    final = placed.join(plan, LEVELS).withColumn("key", key)
    early = F.substring("key", 1, RANGE_DIGITS) < F.col("end_range")
    more = F.col("end_range").isNull() | early | F.coalesce(F.col("key") <= F.col("cut"), F.lit(False))
    more = more & (F.col("rest") > 0)
    last = F.col("whole_epochs") - 1 + more.cast("long")
    epochs = F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last)).otherwise(F.array().cast("array<bigint>"))
    return final.select("row.*", *LEVELS, F.explode(epochs).alias("epoch"))
