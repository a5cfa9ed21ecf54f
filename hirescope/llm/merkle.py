"""Merkle manifest of a dataset, with checkpoint-and-recompute proofs.

Rows are leaves.  Every group of rows is a tree of its own, its leaves in the
order of a column; the trees' tops are the leaves of one more tree, whose top
is the root.  Every run of ``fanout`` nodes next to each other becomes their
hash (the last run may be shorter, down to one node), until one node is left.

Only every ``levels``-th level is stored.  An aligned subtree between two
stored levels has at most ``fanout ** levels`` nodes at its lower end, so one
task rebuilds it in memory: once to find its top, and again, from the stored
nodes, when proofs are drawn; the nodes between are never written.  Proofs run
downwards: a subtree meets the path from its top to the root and hands each of
its nodes that path with its own siblings before it.  A tree of any size, one
that holds all rows included, is many subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirescope.llm.common import materialize

#: nodes that are hashed together
FANOUT = 2
#: levels from one stored level to the next
LEVELS = 10
PROOF = "array<struct<at:int,others:array<string>>>"


def leaf_hash(*fields: Column) -> Column:
    """SHA-256 of the fields as text: ``-`` for null, else UTF-8 byte count, colon, value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text)).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and the siblings of its proof lead to."""

    def up(own: Column, step: Column) -> Column:
        left, right = F.slice(step["others"], F.lit(1), step["at"]), F.slice(step["others"], step["at"] + 1, F.size(step["others"]) - step["at"])
        return F.sha2(F.concat(F.concat_ws("", left), own, F.concat_ws("", right)).cast("binary"), 256)

    return F.aggregate(proof, leaf, up)


def siblings(proof: Column) -> Column:
    """All siblings of a proof, from the leaf's to the root's, left to right."""
    return F.flatten(F.transform(proof, lambda step: step["others"]))


@dataclass(frozen=True)
class Shape:
    """Nodes that are hashed together, and levels from one stored level to the next."""

    fanout: int = FANOUT
    levels: int = LEVELS

    def parents(self, nodes: list[str]) -> list[str]:
        return [hashlib.sha256("".join(nodes[i : i + self.fanout]).encode()).hexdigest() for i in range(0, len(nodes), self.fanout)]

    def subtree(self, table: pa.Table) -> tuple[pa.Table, list[list[str]], int]:
        """The stored nodes of one subtree in order, its levels from them to
        its top, and how many nodes the whole tree has at the top's level."""
        table = table.sort_by("idx")
        n, levels = table["n"][0].as_py(), [table["node"].to_pylist()]
        while n > 1 and len(levels) <= self.levels:
            n = -(-n // self.fanout)
            levels.append(self.parents(levels[-1]))
        return table, levels, n

    def top(self, table: pa.Table) -> pa.Table:
        table, levels, n = self.subtree(table)
        first = table.slice(0, 1)
        return pa.table({"tree": first["tree"], "n": pa.array([n], pa.int64()), "idx": first["subtree"], "node": pa.array(levels[-1], pa.string())})

    def proofs(self, nodes: pa.Table, paths: pa.Table) -> pa.Table:
        """The nodes of one subtree, each with its siblings up to the
        subtree's top, then the path of the top."""
        table, levels, _ = self.subtree(nodes)
        above, top = paths["proof"][0].as_py(), paths["top"][0].as_py()
        at, others, counts = [], [], []
        for place in range(table.num_rows):
            for level in levels[:-1]:
                start = place - place % self.fanout
                run = level[start : start + self.fanout]
                at.append(place - start)
                del run[place - start]
                others += run
                counts.append(len(run))
                place //= self.fanout
            for step in above:
                at.append(step["at"])
                others += step["others"]
                counts.append(len(step["others"]))
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        steps = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.ListArray.from_arrays(ends, pa.array(others, pa.string()))], ["at", "others"])
        each = np.arange(table.num_rows + 1, dtype=np.int32) * (len(levels) - 1 + len(above))
        return table.drop(["subtree"]).append_column("proof", pa.ListArray.from_arrays(each, steps)).append_column("top", pa.array([top] * table.num_rows, pa.string()))

    def below(self, nodes: DataFrame) -> DataFrame:
        """``nodes`` with the number of the subtree that each is in."""
        return nodes.withColumn("subtree", F.expr(f"idx DIV {self.fanout**self.levels}"))


def _placed(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` (stored) with ``idx``, the place of each row in its ``tree``,
    and ``n``, the tree's rows: places in a range sort, less where the tree
    begins.  Trees of any size are spread over the sort's partitions."""
    keys = [F.col("tree"), *order]
    placed = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()), name)
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    runs = placed.groupBy("tree", part.alias("part")).agg(F.count("*").alias("rows"), F.min(place).alias("first"))
    of_tree = Window.partitionBy("tree")  # one row for each partition of the sort that holds the tree
    before = F.coalesce(F.sum("rows").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select("tree", "part", (before - F.col("first")).alias("__shift"), F.sum("rows").over(of_tree).alias("n"))
    # as many rows as partitions and trees: broadcast only if measured to be small
    return placed.withColumn("part", part).join(starts, ["tree", "part"]).withColumn("idx", place + F.col("__shift")).drop("part", "__at", "__shift")


@dataclass
class Tree:
    """Stored levels (leaves first, then every so many) of one tree for each
    ``tree``: (tree, n nodes of the level, idx, node), and more on leaves."""

    levels: list[DataFrame]
    shape: Shape

    @property
    def tops(self) -> DataFrame:
        return self.levels[-1].select("tree", "node")

    def proofs(self, paths: DataFrame) -> DataFrame:
        """The leaves with ``proof`` and ``top``, given those of each tree's
        top (tree, idx 0, proof, top)."""
        for stored in reversed(self.levels[:-1]):
            fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema.fields]
            met = self.shape.below(stored).groupBy("tree", "subtree").cogroup(paths.select("tree", "idx", "proof", "top").groupBy("tree", "idx"))
            shape = self.shape
            paths = met.applyInArrow(lambda nodes, above: shape.proofs(nodes, above), ", ".join([*fields, f"proof {PROOF}", "top string"]))
        return paths


def _tree(leaves: DataFrame, shape: Shape, name: str) -> Tree:
    """Store levels until every tree is one node (at least one level above the leaves)."""
    levels = [leaves]
    while True:
        nodes = shape.below(levels[-1].select("tree", "n", "idx", "node"))
        levels.append(materialize(nodes.groupBy("tree", "subtree").applyInArrow(lambda table: shape.top(table), "tree string, n long, idx long, node string"), name))
        if (levels[-1].agg(F.max("n")).first()[0] or 1) == 1:
            return Tree(levels, shape)


@dataclass
class Manifest:
    """The trees of the groups, the tree over their tops, and the root (none of an empty table)."""

    groups: Tree
    over: Tree
    root: str | None


def manifest(df: DataFrame, fields: Sequence[str], group_col: str = "lang", order_col: str = "doc_id", extra: dict[str, Column] | None = None, shape: Shape = Shape()) -> Manifest:
    """The stored manifest of ``df``: a leaf for every row, hashed over
    ``fields`` in the order given.

    Groups are the values of ``group_col`` as text, null first, then in the
    order of their UTF-8 bytes; leaves of a group ascend by ``order_col``
    (null first).  Rows that agree in both, repeated rows included, are leaves
    of their own, in the order of their hashes.  Null fields differ from empty
    ones; texts of any length are hashed whole.  Leaves keep ``order_col`` and
    the columns of ``extra``; other columns are not read.  An empty table has
    no root and no proofs.
    """
    group = F.col(group_col).cast("string")
    leaves = df.select(
        F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group)).alias("tree"),
        leaf_hash(*(F.col(f) for f in fields)).alias("node"),
        F.col(order_col).alias("order"),
        *(c.alias(name) for name, c in (extra or {}).items()),
        F.monotonically_increasing_id().alias("row"),
    )
    # hashed once, before the range sort samples them; the row's number divides even a row repeated without end
    order = [F.col(c).asc_nulls_first() for c in ("order", "node", "row")]
    groups = _tree(_placed(materialize(leaves, "merkle-leaves"), order, "merkle-sorted").drop("row"), shape, "merkle-level")
    tops = groups.tops.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "node")
    over = _tree(_placed(materialize(tops, "merkle-tops"), [F.col("group")], "merkle-groups"), shape, "merkle-over")
    root = over.tops.first()
    return Manifest(groups, over, root and root["node"])


def proofs(made: Manifest) -> DataFrame:
    """Every leaf (``order``, ``node`` and the extra columns) with its
    ``subroot`` and ``proof``: for each level, through the group's top to the
    root, the leaf's place ``at`` in its run and the run's ``others``."""
    over = made.over.proofs(made.over.levels[-1].select("tree", "idx", F.expr(f"CAST(array() AS {PROOF})").alias("proof"), F.col("node").alias("top")))
    of_groups = over.select(F.col("group").alias("tree"), F.lit(0).cast("long").alias("idx"), "proof", F.col("node").alias("top"))
    return made.groups.proofs(of_groups).withColumnRenamed("top", "subroot").drop("tree", "n", "idx")
