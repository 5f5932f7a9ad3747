"""A Merkle manifest: per group a tree of row digests, over the groups' roots one tree more.

Rows become leaves; a group's leaves stand in the order of their ids. Every level joins nodes
with their siblings by index: the first node of each run of ``fan`` (slot zero) computes the
indices of its siblings, an equijoin fetches their digests, and the run emits its parent. Runs
are staged level by level, so a lost executor costs one level. Proofs come down the same runs:
a node's path is its siblings to the left and right, then the path of its parent.

No join has a key of more than ``fan`` rows, whatever the share of one group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.session import staged

FAN = 16
_PATH = "array<struct<left:string,right:string>>"


def digest_of(*fields: Column) -> Column:
    """Lowercase hex sha256 of the fields, each as byte count, ``:`` and value; null is ``-``.

    The byte counts keep rows of different fields apart: no two give one input.
    """
    framed = []
    for field in fields:
        text = field.cast("string")
        count = F.octet_length(text).cast("string")
        framed.append(F.coalesce(F.concat(count, F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*framed), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to through the siblings in ``path``."""
    return F.aggregate(
        path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256)
    )


def siblings(path: Column) -> Column:
    """All digests of a path as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def in_order(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` plus ``at``, the place in their group's order from 0, and ``n``, its size.

    Ranges of (group, order) are counted first; only the rows of one range are sorted
    together, so a group of any size spreads over many tasks. ``order`` must tell all rows
    apart, or a range may hold all copies of one row.
    """
    dealt = rows.repartitionByRange(group, *order).withColumn("__range", F.spark_partition_id())
    dealt = staged(dealt, "ranges")
    whole = Window.partitionBy(group)
    before = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(group, "__range").agg(F.count("*").alias("__rows"))
    starts = counts.select(
        group,
        "__range",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
        F.sum("__rows").over(whole).alias("n"),
    )
    inside = Window.partitionBy(group, "__range").orderBy(*order)
    return (
        dealt.join(starts, [group, "__range"])
        .withColumn("at", F.col("__start") + F.row_number().over(inside) - 1)
        .drop("__range", "__start")
    )


def runs_of(nodes: DataFrame, fan: int) -> DataFrame:
    """The runs of nodes (tree, at, n, hash) in trees that have several.

    One row per run: tree, at (the run's number, its parent's place), n (parents in the
    tree), children (digests in order) and hash (the parent's).
    """
    many = nodes.filter("n > 1")
    zero = many.filter(F.col("at") % fan == 0)
    last = F.least(F.lit(fan), F.col("n") - F.col("at")) - 1
    asked = zero.select(
        "tree",
        F.expr(f"at div {fan}").alias("run"),
        F.ceil(F.col("n") / fan).alias("parents"),
        F.posexplode(F.sequence(F.col("at"), F.col("at") + last)).alias("slot", "at"),
    )
    met = asked.join(many.select("tree", "at", "hash"), ["tree", "at"])
    found = met.groupBy("tree", "run", "parents").agg(
        F.sort_array(F.collect_list(F.struct("slot", "hash"))).alias("met")
    )
    children = F.transform("met", lambda child: child["hash"])
    return found.select(
        "tree",
        F.col("run").alias("at"),
        F.col("parents").alias("n"),
        children.alias("children"),
        F.sha2(F.array_join(children, ""), 256).alias("hash"),
    )


@dataclass
class Trees:
    """Trees over the leaves (tree, at, n, hash): the runs of each level, lowest first."""

    leaves: DataFrame
    levels: list[DataFrame]

    @classmethod
    def grow(cls, leaves: DataFrame, fan: int) -> Trees:
        nodes, levels = leaves, []
        most = leaves.agg(F.max("n")).first()[0] or 0
        while most > 1:
            levels.append(staged(runs_of(nodes, fan), f"level{len(levels)}"))
            nodes, most = levels[-1], -(-most // fan)
        return cls(leaves, levels)

    def tops(self) -> DataFrame:
        """(tree, hash) of each tree's root."""
        found = self.leaves.filter("n = 1").select("tree", "hash")
        for level in self.levels:
            found = found.unionByName(level.filter("n = 1").select("tree", "hash"))
        return found

    def paths(self, above: DataFrame, carried: list[str], fan: int) -> DataFrame:
        """The leaves' columns plus ``path`` and ``carried``.

        ``above`` has (tree, path, *carried): where the path of a tree's root goes on.
        """
        upper = None  # (tree, at, path, *carried) of the nodes one level higher
        for level in reversed(self.levels):
            known = level.filter("n = 1").select("tree", "at").join(above, "tree")
            upper = known if upper is None else known.unionByName(upper)
            runs = level.select("tree", "at", "children").join(upper, ["tree", "at"])
            upper = self._down(
                runs.select("*", F.posexplode("children").alias("slot", "hash")), fan
            ).select("tree", "place", "path", *carried).withColumnRenamed("place", "at")
            lowest = runs
        alone = self.leaves.filter("n = 1").join(above, "tree")
        if not self.levels:
            return alone
        found = (
            self.leaves.filter("n > 1")
            .withColumn("slot", (F.col("at") % fan).cast("int"))
            .withColumn("place", F.col("at"))
            .withColumn("at", F.expr(f"at div {fan}"))
            .join(lowest, ["tree", "at"])
        )
        found = self._down(found, fan, keep_place=True)
        return alone.unionByName(found.select(*alone.columns))

    @staticmethod
    def _down(rows: DataFrame, fan: int, keep_place: bool = False) -> DataFrame:
        """``path`` grows by the siblings of ``slot``; ``place`` is the node's own index."""
        left = F.array_join(F.slice("children", 1, F.col("slot")), "")
        right = F.array_join(F.slice("children", F.col("slot") + 2, fan), "")
        step = F.array(F.struct(left.alias("left"), right.alias("right"))).cast(_PATH)
        rows = rows.withColumn("path", F.concat(step, "path"))
        if keep_place:
            return rows.drop("at").withColumnRenamed("place", "at")
        return rows.withColumn("place", F.col("at") * fan + F.col("slot"))


@dataclass
class Manifest:
    """``groups``: trees over rows; ``whole``: the tree over the groups; ``root``: its root, or
    None where there are no rows."""

    groups: Trees
    whole: Trees
    root: str | None
    fan: int

    def nodes(self) -> DataFrame:
        """The manifest itself: level, group (null in the tree over the groups too), whole
        (true there), at, hash and children of every inner node."""
        found = None
        for over_groups, trees in ((False, self.groups), (True, self.whole)):
            for number, level in enumerate(trees.levels, 1):
                group = F.when(F.col("tree") != "-", F.expr("substring(tree, 2)"))
                part = level.select(
                    F.lit(over_groups).alias("whole"), group.alias("group"),
                    F.lit(number).alias("level"), "at", "hash", "children",
                )
                found = part if found is None else found.unionByName(part)
        if found is None:
            spark = self.groups.leaves.sparkSession
            return spark.createDataFrame(
                [], "whole boolean, group string, level int, at long, hash string, children array<string>"
            )
        return found

    def proofs(self) -> DataFrame:
        """The columns given to ``build_manifest`` plus leaf, subroot and path, which replace
        columns of those names."""
        start = self.whole.tops().select("tree", F.array().cast(_PATH).alias("path"))
        roots = self.whole.paths(start, [], self.fan)
        above = roots.select(F.col("group").alias("tree"), F.col("hash").alias("subroot"), "path")
        found = self.groups.paths(staged(above, "above"), ["subroot"], self.fan)
        made = ["leaf", "subroot", "path"]
        kept = [c for c in found.schema["row"].dataType.names if c not in made]
        return found.withColumnRenamed("hash", "leaf").select(
            *[F.col("row")[c].alias(c) for c in kept], *made
        )


def build_manifest(
    rows: DataFrame, digest: Column, group_column: str, id_column: str, fan: int = FAN
) -> Manifest:
    """The manifest of ``rows``, of which ``digest`` makes the leaves.

    Groups are the values of ``group_column``, null first and then bytewise. Leaves ascend by
    ``id_column``, null first, rows of one id by their digests; rows equal in both are
    interchangeable. All columns of ``rows`` travel with the leaves, whatever their names:
    select what the proofs shall carry. No rows give no root; null, empty and very long
    fields are what ``digest`` makes of them.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_column).cast("string")), F.lit("-"))
    leaves = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
        tree.alias("tree"),
        F.col(id_column).alias("id"),
        digest.alias("hash"),
        F.monotonically_increasing_id().alias("tie"),
    )
    leaves = in_order(staged(leaves, "leaves"), "tree", ["id", "hash", "tie"])
    groups = Trees.grow(staged(leaves, "ordered"), fan)
    tops = groups.tops().select(F.lit("-").alias("tree"), F.col("tree").alias("group"), "hash")
    whole = Trees.grow(staged(in_order(tops, "tree", ["group"]), "tops"), fan)
    root = whole.tops().first()
    return Manifest(groups, whole, root["hash"] if root else None, fan)
