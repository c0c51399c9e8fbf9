"""Merkle manifest of a table, kept as a postorder append log.

A table's leaves stand in one tree per group (here: language), in order of their key; the roots of the
groups, in order of the groups, stand in a tree of their own. A node is the digest of its one
or two children, so a tree of n leaves has ceil(n / 2**l) nodes on level l.

The log of a tree holds its nodes in the order in which they are complete. Before leaf p lie exactly the
nodes whose leaves all come before p, which are ``2 * p - bit_count(p)``; the subtree of node i on
level l begins at leaf ``i << l`` and ends with the node. So ``position`` needs no index, and a proof
finds its siblings by arithmetic.

Builders are aligned: builder b of a tree takes leaves ``b << SPAN`` and on, at most ``1 << SPAN`` of
them, and writes one unbroken run of the log. The roots of the runs are the leaves of the next
round, so n leaves take log(n) / SPAN rounds, and no task sees more than ``1 << SPAN`` leaves.

Leaves get their places by a range shuffle of slim rows (key and digest) and the number of rows
per partition before theirs; a group may hold any share of the rows.

Defined results: a null field is ``-``; a null group is a group, the first one; within a group null
keys come first and rows of equal keys are ordered by leaf digest; an empty table has no rows.
Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlake.llm.arrow import ship
from batchlake.session import materialize

#: Levels of a builder: it takes at most ``1 << SPAN`` leaves.
SPAN = 12


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(leaves: int) -> int:
    """The level of the root of a tree."""
    return (leaves - 1).bit_length()


def width(leaves: int, level: int) -> int:
    """Nodes of a tree on a level."""
    return -(-leaves >> level)


def position(level: int, node: int, leaves: int) -> int:
    """Where the log of a tree has a node."""
    begin = node << level
    own = min(1 << level, leaves - begin)
    return 2 * begin - begin.bit_count() + sum(width(own, j) for j in range(level + 1)) - 1


def siblings(leaf: int, leaves: int, top: int) -> Iterator[tuple[int, int]]:
    """Level and number of the siblings that a leaf's path to level ``top`` meets."""
    for level in range(top):
        other = leaf >> level ^ 1
        if other < width(leaves, level):
            yield level, other


def append(leaves: list[str], top: int) -> list[str]:
    """The log of a builder: its nodes up to level ``top`` in the order of completion."""
    log: list[str] = []
    open_: list[tuple[int, str]] = []  # level and digest of nodes that wait for their sibling
    for leaf in leaves:
        level, node = 0, leaf
        log.append(node)
        while level < top and open_ and open_[-1][0] == level:
            level, node = level + 1, digest(open_.pop()[1], node)
            log.append(node)
        open_.append((level, node))
    # The last run of a level is short: its nodes are completed by what there is.
    level, node = open_.pop()
    while level < top:
        if open_ and open_[-1][0] == level:
            node = digest(open_.pop()[1], node)
        else:
            node = digest(node)
        level += 1
        log.append(node)
    return log


def _field(column: Column) -> Column:
    value = column.cast("string")
    whole = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
    return F.when(column.isNull(), "-").otherwise(whole)


def leaf_digest(*columns: Column) -> Column:
    """The digest of a row's fields, each with its length."""
    return F.sha2(F.concat(*[_field(c) for c in columns]), 256)


def place(leaves: DataFrame, group: str, key: str) -> DataFrame:
    """``leaves(group, key, leaf, ...)`` with ``tree`` (number of the group), ``trees``, ``n`` (leaves of
    the tree) and ``pos`` (place in it), stored."""
    order = [F.col(group).asc_nulls_first(), F.col(key).asc_nulls_first(), F.col("leaf")]
    # Stored, so that finding the ranges does not read the fields a second time.
    dealt = materialize(leaves, "merkle-digests").repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = materialize(
        dealt.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_row", 33)),
        "merkle-leaves",
    )
    # One row per group and partition. Ranges are ordered, so these are no more than partitions and groups.
    parts = numbered.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_in")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first")
    )
    before = Window.partitionBy("_group").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_group")
    trees = parts.groupBy("_group").agg(F.sum("_rows").alias("n"))
    trees = trees.select(
        F.col("_group").alias("_tree"),
        (F.row_number().over(Window.orderBy(F.col("_group").asc_nulls_first())) - 1).cast("bigint").alias("tree"),  # a row per group
        F.count(F.lit(1)).over(Window.partitionBy()).alias("trees"),
    )
    parts = parts.withColumns(
        {"_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "n": F.sum("_rows").over(whole)}
    )
    parts = materialize(parts.join(trees, F.col("_group").eqNullSafe(F.col("_tree"))).drop("_tree"), "merkle-parts")
    placed = numbered.join(parts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_in")))
    return materialize(
        placed.withColumn("pos", F.col("_row") - F.col("_first") + F.col("_before")).drop(
            "_row", "_part", "_in", "_rows", "_first", "_before", "_group"
        ),
        "merkle-placed",
    )


def _runs(nodes: DataFrame, span: int) -> DataFrame:
    """The runs that the builders of ``nodes(tree, n, pos, digest)`` write."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        leaves = table.sort_by("pos")
        n = leaves.column("n")[0].as_py()
        log = append(leaves.column("digest").to_pylist(), min(span, height(n)))
        builder = key[1].as_py()
        first = 2 * (builder << span) - (builder << span).bit_count()
        return pa.table(
            {"tree": [key[0].as_py()], "n": [n], "builder": [builder], "first": [first], "root": [log[-1]], "log": [log]}
        )

    shape = "tree bigint, n bigint, builder bigint, first bigint, root string, log array<string>"
    return nodes.groupBy("tree", F.shiftright("pos", span).alias("builder")).applyInArrow(run, shape)


def _paths(nodes: DataFrame, runs: DataFrame, span: int, kept: list[str]) -> DataFrame:
    """``nodes`` with ``path``: the digests of their siblings in their builder's run, then ``above``, the
    path of the run's root, which ``runs`` brings along with ``top``, the root of all."""
    fields = {f.name: f for f in nodes.schema.fields}
    shape = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in kept)

    def run(key: tuple, rows: pa.Table, run: pa.Table) -> pa.Table:
        log, n, above = (run.column(c)[0].as_py() for c in ("log", "n", "above"))
        begin = key[1].as_py() << span
        own, top = min(1 << span, n - begin), min(span, height(n))
        paths = [
            "".join(log[position(level, other, own)] for level, other in siblings(p - begin, own, top)) + above
            for p in rows.column("pos").to_pylist()
        ]
        ends = {c: pa.array([run.column(c)[0].as_py()] * len(paths), pa.string()) for c in ("subroot", "top")}
        return pa.table({**{c: rows.column(c) for c in kept}, "path": pa.array(paths, pa.string()), **ends})

    builder = F.shiftright("pos", span)
    return (
        nodes.withColumn("builder", builder)
        .groupBy("tree", "builder")
        .cogroup(runs.groupBy("tree", "builder"))
        .applyInArrow(run, f"{shape}, path string, subroot string, top string")
    )


class Manifest:
    """The logs of a placed table (``place``), and proofs from them.

    ``rounds`` holds the runs of the group trees, lowest first, and ``roof`` those of the tree over
    the groups. Each is a stored table: ``tree``, ``n``, ``builder``, ``first`` (where the run begins in
    its round's log), ``root`` and ``log``.
    """

    def __init__(self, placed: DataFrame, span: int = SPAN):
        ship(placed.sparkSession)
        self.placed, self.span = placed, span
        largest = placed.agg(F.max("n")).first()[0] or 0
        nodes = placed.select("tree", "n", "pos", F.col("leaf").alias("digest"))
        self.rounds = self._build(nodes, largest)
        over = self._roots(self.rounds).crossJoin(F.broadcast(placed.select("trees").limit(1)))  # one row
        self.over = over.select(
            F.lit(0).cast("bigint").alias("tree"),
            F.col("trees").alias("n"),
            F.col("tree").alias("pos"),
            F.col("root").alias("digest"),
        )
        groups = (placed.select("trees").first() or [0])[0]
        self.roof = self._build(self.over, groups)

    def _build(self, nodes: DataFrame, largest: int) -> list[DataFrame]:
        rounds = []
        while True:
            rounds.append(materialize(_runs(nodes, self.span), "merkle-runs"))
            if largest <= 1 << self.span:
                return rounds
            largest = width(largest, self.span)
            nodes = self._next(rounds[-1])

    def _next(self, runs: DataFrame) -> DataFrame:
        """The roots of a round's runs as leaves of the next one."""
        n = F.shiftright(F.col("n") + (1 << self.span) - 1, self.span)
        return runs.select("tree", n.alias("n"), F.col("builder").alias("pos"), F.col("root").alias("digest"))

    def _roots(self, rounds: list[DataFrame]) -> DataFrame:
        return rounds[-1].select("tree", "root")

    def _descend(self, rounds: list[DataFrame], above: DataFrame, nodes: DataFrame, kept: list[str]) -> DataFrame:
        """Paths of ``nodes`` from those of the trees, ``above(tree, above, subroot, top)``, through all rounds."""
        keyed = rounds[-1].join(above, "tree")
        for below in reversed(rounds[:-1]):
            up = _paths(self._next(below), keyed, self.span, ["tree", "pos"])
            up = up.withColumnsRenamed({"tree": "_tree", "path": "above"})
            keyed = below.join(up, (F.col("tree") == F.col("_tree")) & (F.col("builder") == F.col("pos"))).drop("_tree", "pos")
        return _paths(nodes, keyed, self.span, kept)

    def root(self) -> str | None:
        row = self.roof[-1].select("root").first()
        return row[0] if row else None

    def proofs(self) -> DataFrame:
        """``placed`` with ``path`` (the siblings' digests, from the leaf up, through the group's root to
        the root of all, as one string), ``subroot`` and ``top``."""
        none, roots = F.lit(""), self._roots(self.rounds)
        roof = self._roots(self.roof).select("tree", none.alias("above"), none.alias("subroot"), F.col("root").alias("top"))
        groups = self._descend(self.roof, roof, self.over, ["pos"]).select(
            F.col("pos").alias("_tree"), F.col("path").alias("above"), "top"
        )
        above = materialize(
            roots.join(groups, F.col("tree") == F.col("_tree")).select("tree", "above", F.col("root").alias("subroot"), "top"),
            "merkle-groups",
        )
        return self._descend(self.rounds, above, self.placed, self.placed.columns)


def fold(node: str, pos: int, n: int, path: str, at: int = 0) -> tuple[str, int]:
    """The root that a node and its siblings' digests give, and how much of the path is used."""
    for level in range(height(n)):
        here = pos >> level
        if here ^ 1 >= width(n, level):
            node = digest(node)
            continue
        other, at = path[at : at + 64], at + 64
        node = digest(other, node) if here & 1 else digest(node, other)
    return node, at


def verify(proofs: DataFrame, leaf: str, folded: str = "folded_root") -> DataFrame:
    """``proofs`` with the root that each row's ``leaf`` gives with the row's path."""
    ship(proofs.sparkSession)
    names = proofs.columns
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in proofs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (leaf, "pos", "n", "tree", "trees", "path")]
            roots = []
            for node, pos, n, tree, trees, path in zip(*columns, strict=True):
                node, at = fold(node, pos, n, path)
                roots.append(fold(node, tree, trees, path, at)[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.string())], [*names, folded])

    return proofs.mapInArrow(run, f"{shape}, `{folded}` string")
