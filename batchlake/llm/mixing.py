"""Mixing sources to target weights by hierarchical budgeting, with DataFrame functions only.

Leaves are the different values of the level columns (such as domain, language, source). A token
budget is handed down the tree: at each node it is shared among the children by weight, but no
child gets more than its leaves can supply over all epochs, and what one child cannot use goes to
its siblings by weight. Since a child's limit is the supply of all its leaves, a shortage is made
up by siblings as long as these have anything left, and reaches an ancestor's siblings only then.

A leaf's allocation is a number of full epochs and a rest. An epoch is an order of the leaf's
documents by md5 of seed, epoch and id; the rest is a prefix of the next epoch, as many documents as
fit whole. The prefix is found by buckets of that order (the first hex digits): sums per leaf and
bucket are combined before they are shuffled, buckets below the rest are taken as they are, and only
the documents of the one bucket that holds the border are put in order. So a leaf that holds
most of all rows is neither sorted nor gathered.

All amounts are integers, rounded down, so at most one token per child is lost to rounding. Since
only whole documents are taken, a prefix can stop up to a document short of its allocation. What prefixes
leave over is handed on (``refill``): below each parent the left-overs make a pool, from which leaves
get the one document that ended their prefix, the shortest first, as long as the pool lasts; what remains
goes up to the next ancestor and its leaves, up to the root. Each level is one step over a row per
leaf, however many leaves there are. What is left of the whole budget in the end is less than the
document that some leaf would take next. Without ``refill`` the left-overs stay unused.

Defined results: a null level counts as an empty string; a null text has no tokens; a document
without tokens is in every epoch whose prefix reaches it. Weights that are not given are 1; a
weight of 0 takes nothing, so its documents are left out. Rows that repeat an id are ordered by
the hash of their text; rows equal in both are taken together or not at all. Other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlake.session import materialize

#: Hex digits that make a bucket of an epoch's order.
DIGITS = 3
_BIG = "decimal(38,0)"


def words(text: Column) -> Column:
    """Tokens counted as words."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _weight(weights: dict[tuple[str, ...], int], path: list[Column]) -> Column:
    """Weight of a node by its path; the dictionary is written by hand, so it is small."""
    here = [(k, w) for k, w in weights.items() if len(k) == len(path)]
    if not here:
        return F.lit(1).cast(_BIG)
    out = F.lit(1)
    for key, weight in here:
        same = F.lit(True)
        for column, value in zip(path, key, strict=True):
            same = same & (column == F.lit(value))
        out = F.when(same, F.lit(weight)).otherwise(out)
    return out.cast(_BIG)


def share_out(children: DataFrame, parents: list[str], node: str) -> DataFrame:
    """Adds ``given``: ``budget`` (one per parent) shared by ``weight`` under the limits ``supply``.

    Children are ordered by supply per weight. One is full if filling it and all before it, and
    giving the others as much per weight, stays within the budget; the others share the rest.
    Windows hold a row per node, not per document.
    """
    rate = F.when(F.col("weight") > 0, F.col("supply").cast("double") / F.col("weight").cast("double")).otherwise(F.lit(float("inf")))
    by_rate = Window.partitionBy(*parents).orderBy("rate", node).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*parents)
    rows = (
        children.withColumn("rate", rate)
        .withColumn("filled", F.sum("supply").over(by_rate).cast(_BIG))
        .withColumn("after", (F.sum("weight").over(whole) - F.sum("weight").over(by_rate)).cast(_BIG))
        .withColumn(
            "full",
            (F.col("weight") > 0)
            & (F.col("filled") * F.col("weight") + F.col("supply") * F.col("after") <= F.col("budget") * F.col("weight")),
        )
        .withColumn("used", F.sum(F.when(F.col("full"), F.col("supply")).otherwise(0)).over(whole).cast(_BIG))
        .withColumn("open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole).cast(_BIG))
    )
    left = (F.col("budget") - F.col("used")) * F.col("weight")
    # The whole part of a quotient of integers, by the remainder, so nothing is rounded.
    part = (left - left % F.greatest("open", F.lit(1).cast(_BIG))) / F.greatest("open", F.lit(1).cast(_BIG))
    given = F.when(F.col("full"), F.col("supply")).otherwise(
        F.least(F.col("supply"), F.round(part, 0).cast(_BIG))
    )
    return rows.withColumn("given", given.cast(_BIG)).drop("rate", "filled", "after", "full", "used", "open")


def allocate(leaves: DataFrame, levels: list[str], weights: dict, budget: Column) -> DataFrame:
    """Adds ``given`` (tokens) to ``leaves(levels..., supply)``."""
    nodes = leaves
    for depth in range(1, len(levels) + 1):
        here = levels[:depth]
        if depth < len(levels):
            total = leaves.groupBy(*here).agg(F.sum("supply").cast(_BIG).alias("supply"))
        else:
            total = leaves
        total = total.withColumn("weight", _weight(weights, [F.col(c) for c in here]))
        if depth == 1:
            total = total.withColumn("budget", budget.cast(_BIG))
            parents = [F.lit(1)]
        else:
            total = total.join(nodes.select(*levels[: depth - 1], F.col("given").alias("budget")), levels[: depth - 1])
            parents = levels[: depth - 1]
        nodes = share_out(total, parents, levels[depth - 1])
    return nodes.drop("weight", "budget")


def _refilled(ends: DataFrame, names: list[str], weights: dict) -> DataFrame:
    """``ends`` with ``more``: whether the document after a leaf's prefix is taken as well, out of what
    prefixes leave over. Siblings come first, then the leaves below each ancestor."""
    paths = [_weight(weights, [F.col(c) for c in names[:depth]]) for depth in range(1, len(names) + 1)]
    state = ends.withColumns(
        {
            "_open": (F.least(*paths, F.lit(1).cast(_BIG)) > 0) & (F.col("given") > 0) & F.col("next").isNotNull(),
            "left": (F.col("given") - F.col("used")).cast(_BIG),
            "more": F.lit(False),
        }
    )
    for depth in range(len(names) - 1, -1, -1):
        parents = names[:depth] or [F.lit(1)]
        whole = Window.partitionBy(*parents)
        asks = F.col("_open") & ~F.col("more") & (F.col("next") <= F.col("_pool"))
        shortest = whole.orderBy(F.desc("_asks"), "next", *names).rowsBetween(Window.unboundedPreceding, 0)
        wanted = F.when(F.col("_asks"), F.col("next")).otherwise(0)
        gets = F.col("_asks") & (F.sum(wanted).over(shortest) <= F.col("_pool"))
        spent = F.sum(F.when(F.col("_gets"), F.col("next")).otherwise(0)).over(whole)
        # The rest of a pool waits at its first leaf; only the sum counts.
        first = F.row_number().over(whole.orderBy(*names)) == 1
        state = (
            state.withColumn("_pool", F.sum("left").over(whole).cast(_BIG))
            .withColumn("_asks", asks)
            .withColumn("_gets", gets)
            .withColumn("left", F.when(first, F.col("_pool") - spent).otherwise(0).cast(_BIG))
            .withColumn("more", F.col("more") | F.col("_gets"))
            .drop("_pool", "_asks", "_gets")
        )
    return state.drop("_open", "left")


def mix(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[tuple[str, ...], int],
    share: tuple[int, int],
    epochs: int = 1,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    tokens: Column | None = None,
    refill: bool = True,
) -> DataFrame:
    """The chosen rows of ``docs``, all columns in ``row``, with ``leaf`` (levels), ``tokens`` and
    ``epoch``.

    ``levels``: name and column of each level from the root down. ``weights``: by path of values.
    ``share``: the budget as a fraction of one epoch of all documents. ``refill``: hand on what
    prefixes leave over.
    """
    names = [f"_level{k}" for k in range(len(levels))]
    count = words(F.col(text)) if tokens is None else tokens
    rows = docs.select(
        F.struct("*").alias("row"),
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(names, levels.values(), strict=True)],
        count.alias("tokens"),
        F.col(doc_id).cast("string").alias("_id"),
        F.xxhash64(text).alias("_mark"),
    )
    slim = materialize(rows.select(*names, "tokens", "_id", "_mark"), "mix-sizes")
    leaves = slim.groupBy(*names).agg(F.sum("tokens").cast(_BIG).alias("one"))
    leaves = materialize(leaves, "mix-leaves").withColumn("supply", (F.col("one") * epochs).cast(_BIG))
    total = leaves.agg(F.sum("one").alias("t")).first()["t"] or 0
    budget = F.lit(str(int(total) * share[0] // share[1]))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full").cast("string"), F.coalesce("_id", F.lit(""))).cast("binary"))

    def prefixes(given: DataFrame) -> DataFrame:
        """``given`` (levels..., one, given) with the number of full epochs ``full``, the first
        document after the prefix ``_stop``, its tokens ``next`` and the tokens ``used`` before it."""
        rest = F.col("given") % F.greatest("one", F.lit(1).cast(_BIG))
        plan = materialize(
            given.select(
                *names,
                "one",
                "given",
                ((F.col("given") - rest) / F.greatest("one", F.lit(1).cast(_BIG))).cast("int").alias("full"),
                rest.cast(_BIG).alias("rest"),
            ),
            "mix-plan",
        )
        # With the plan of the row's leaf, and its place in the epoch that is taken in part.
        placed = slim.join(plan, names).withColumn("_place", key).withColumn("_bucket", F.substring("_place", 1, DIGITS))
        sums = placed.groupBy(*names, "_bucket", "rest").agg(F.sum("tokens").cast(_BIG).alias("sum"))
        order = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
        # At most 16**DIGITS rows per leaf.
        sums = sums.withColumn("upto", F.sum("sum").over(order).cast(_BIG))
        border = materialize(
            sums.where("upto > rest")
            .groupBy(*names)
            .agg(F.min(F.struct("_bucket", (F.col("rest") - F.col("upto") + F.col("sum")).alias("room"))).alias("b"))
            .select(*names, F.col("b._bucket").alias("_bucket"), F.col("b.room").alias("room")),
            "mix-borders",
        )
        # Equal rows count together.
        inside = Window.partitionBy(*names).orderBy("_place", "_id", "_mark").rangeBetween(Window.unboundedPreceding, 0)
        alike = Window.partitionBy(*names, "_place", "_id", "_mark")
        # The first document of the border bucket that does not fit ends the prefix.
        over = (
            placed.join(border, [*names, "_bucket"])
            .withColumn("upto", F.sum("tokens").over(inside))
            .withColumn("tokens", F.sum("tokens").over(alike))
            .where("upto > room")
            .groupBy(*names)
            .agg(
                F.min(F.struct("_place", "_id", "_mark")).alias("_stop"),
                F.min(
                    F.struct("_place", "_id", "_mark", "tokens", (F.col("room") - F.col("upto") + F.col("tokens")).alias("left"))
                ).alias("_at"),
            )
        )
        left = F.coalesce("_at.left", F.lit(0)).cast(_BIG)
        return materialize(
            plan.join(over, names, "left").select(
                *names,
                "given",
                "full",
                "_stop",
                F.when(F.col("full") < epochs, F.col("_at.tokens")).cast(_BIG).alias("next"),
                F.when(F.col("full") < epochs, F.col("given") - left).otherwise(F.col("given")).cast(_BIG).alias("used"),
            ),
            "mix-ends",
        )

    ends = prefixes(allocate(leaves, names, weights, budget))
    ends = materialize(_refilled(ends, names, weights), "mix-refilled") if refill else ends.withColumn("more", F.lit(False))
    here = F.struct(key.alias("_place"), F.col("_id").alias("_id"), F.col("_mark").alias("_mark"))
    reached = F.col("_stop").isNull() | (here < F.col("_stop")) | (F.col("more") & (here == F.col("_stop")))
    partly = (F.col("full") < epochs) & (F.col("given") > 0) & reached
    taken = F.when(partly, F.col("full") + 1).otherwise(F.col("full"))
    return (
        rows.join(ends.select(*names, "given", "full", "_stop", "more"), names)
        .withColumn("taken", taken)
        .where("taken > 0")
        .select("row", F.array(*names).alias("leaf"), "tokens", F.explode(F.sequence(F.lit(0), F.col("taken") - 1)).alias("epoch"))
    )
