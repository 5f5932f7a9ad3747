"""Approximate nearest neighbours: a neighbour graph by NN-descent, greedy graph search.

The graph starts from blocks of vectors that lie close along random trees, then improves by
joins of neighbours of neighbours: every node brings its links together, each pair among them
is measured, and the better ones replace the worst links of both ends. Queries walk the graph
from the nearest of some entry points, always expanding the closest nodes not yet expanded.
Equal vectors are one node, so a vector that a third of the rows share costs one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgermill.session import staged

LINKS = 20  # links per node
SAMPLED = 10  # links per node and direction that one join brings together
PROPOSED = 6  # best partners that a join proposes to each of its members
ENOUGH = 0.002  # stop when fewer links than this share were replaced
TREES = 3
BLOCK = 64
SAMPLE_ROWS = 4096  # least size of the sample that trees and entry points are fitted on
LEAF_SAMPLE = 16  # rows of the sample per leaf
MOST_DEPTH = 12  # bounds the sample at 65,536 rows
ENTRIES = 512
BEAM = 400  # the same for every table, so that a query's walk does not grow with it
EXPANDED = 50  # nodes that a query expands at once


def tree_depth(nodes: int) -> int:
    """The depth at which a leaf holds about one block."""
    return min(MOST_DEPTH, max(1, round(np.log2(max(1, nodes) / BLOCK))))


def _distances(xs: pa.Array, ys: pa.Array) -> pa.Array:
    apart = _matrix(xs) - _matrix(ys)
    return pa.array(np.einsum("nd,nd->n", apart, apart))


def _distance(x: str, y: str) -> Column:
    """Squared Euclidean distance in double precision."""
    return F.arrow_udf(_distances, returnType="double")(x, y)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the rows that take part: not null, empty, zero, or holding null or
    non-finite components, and of the commonest length (the shorter on a tie)."""
    x = F.col("vector")
    inf = float("inf")
    sound = (
        F.coalesce(F.size(x), F.lit(0)) > 0
    ) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf)) & F.exists(
        x, lambda v: v != 0
    )
    kind = "float" if dict(vectors.dtypes)[vector_column] == "array<float>" else "double"
    rows = vectors.select(
        F.col(id_column).alias("id"), F.col(vector_column).cast(f"array<{kind}>").alias("vector")
    ).filter(F.col("id").isNotNull() & sound)
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (length.n if length else 0))


def _trees(sample: np.ndarray, seed: int, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per tree, directions and thresholds of its inner nodes in heap order."""
    generator, out = np.random.default_rng(seed), []
    size = (1 << depth) - 1
    for _ in range(TREES):
        directions = np.zeros((size, sample.shape[1]))
        thresholds = np.zeros(size)
        members = {0: np.arange(len(sample))}
        for node in range(size):
            own = members.pop(node, np.empty(0, int))
            if len(own) >= 2:
                one, two = sample[generator.choice(own, 2, replace=False)]
                directions[node] = one - two
                along = sample[own] @ directions[node]
                thresholds[node] = np.median(along)
                right = along > thresholds[node]
                members[2 * node + 1], members[2 * node + 2] = own[~right], own[right]
        out.append((directions, thresholds))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if not len(column):
        return np.empty((0, 1))
    return flat.astype(np.float64).reshape(len(column), -1)


def _leaves(trees, depth: int):
    def leaves(vectors: pa.Array) -> pa.Array:
        x = _matrix(vectors)
        leaf_columns, along_columns = [], []
        for directions, thresholds in trees.value:
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                along = np.einsum("nd,nd->n", x, directions[at])
                at = 2 * at + 1 + (along > thresholds[at])
            leaf_columns.append(at)
            along_columns.append(x @ directions[1 % len(directions)] if len(x) else np.empty(0))
        return pa.StructArray.from_arrays(
            [pa.array(np.stack(leaf_columns, 1).tolist(), pa.list_(pa.int64()))]
            + [pa.array(np.stack(along_columns, 1).tolist(), pa.list_(pa.float64()))],
            names=["leaf", "along"],
        )

    return F.arrow_udf(leaves, returnType="struct<leaf:array<long>,along:array<double>>")


def _entries(points):
    def entries(vectors: pa.Array) -> pa.Array:
        ids, x = points.value
        asked, near = _matrix(vectors), []
        if not len(ids):
            return pa.array([[]] * len(asked), pa.list_(pa.int64()))
        for at in range(0, len(asked), 256):
            part = asked[at : at + 256]
            apart = (part**2).sum(1)[:, None] + (x**2).sum(1) - 2 * part @ x.T
            near += ids[np.argsort(apart, axis=1, kind="stable")[:, :EXPANDED]].tolist()
        return pa.array(near, pa.list_(pa.int64()))

    return F.arrow_udf(entries, returnType="array<long>")


def _best_in_group(ids, x, fresh, bars, wanted):
    """(a, b, squared distance) of each member's nearest others that beat its bar."""
    norms = np.einsum("nd,nd->n", x, x)
    rough = norms[:, None] + norms[None, :] - 2 * (x @ x.T)
    useful = fresh[:, None] | fresh[None, :]
    np.fill_diagonal(useful, False)
    rough[~useful] = np.inf
    wanted = min(wanted, len(ids) - 1)
    if wanted < 1:
        return None
    near = np.argpartition(rough, wanted - 1, axis=1)[:, :wanted]
    a, b = np.repeat(np.arange(len(ids)), wanted), near.ravel()
    ok = useful[a, b] & (ids[a] != ids[b])
    a, b = a[ok], b[ok]
    apart = x[a] - x[b]
    exact = np.einsum("nd,nd->n", apart, apart)
    ok = exact < bars[a]
    return ids[a[ok]], ids[b[ok]], exact[ok]


def _edges(found: list) -> pa.RecordBatch:
    parts = [np.concatenate(x) for x in zip(*found, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=["a", "b", "d"])


def _block_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each run of BLOCK sorted rows joins within itself."""
    held_ids, held = np.empty(0, np.int64), None

    def join(ids, x):
        return _best_in_group(
            ids, x, np.ones(len(ids), bool), np.full(len(ids), np.inf), LINKS
        )

    for batch in batches:
        ids = np.concatenate([held_ids, batch.column(0).to_numpy(zero_copy_only=False)])
        x = _matrix(batch.column(1))
        x = x if held is None or not len(held) else np.concatenate([held, x])
        whole = len(ids) // BLOCK * BLOCK
        found = [join(ids[i : i + BLOCK], x[i : i + BLOCK]) for i in range(0, whole, BLOCK)]
        held_ids, held = ids[whole:], x[whole:]
        if found:
            yield _edges(found)
    if len(held_ids) > 1 and (last := join(held_ids, held)):
        yield _edges([last])


def _local_joins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node with the list of its links' ids, vectors, bars and freshness."""
    for batch in batches:
        lists = batch.column(0)
        offsets = lists.offsets.to_numpy()
        fields = lists.flatten()
        ids, fresh, bars = (
            fields.field(n).to_numpy(zero_copy_only=False) for n in ("u", "fresh", "bar")
        )
        x = _matrix(fields.field("vector"))
        base, found = offsets[0], []
        for start, end in zip(offsets[:-1] - base, offsets[1:] - base, strict=True):
            group, first = np.unique(ids[start:end], return_index=True)
            at = start + first
            if len(group) > 1 and fresh[at].any():
                found.append(_best_in_group(group, x[at], fresh[at], bars[at], PROPOSED))
        found = [f for f in found if f]
        if found:
            yield _edges(found)


def _nearest(rows: DataFrame, key: str, order: list, limit: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("__place", place).filter(F.col("__place") <= limit).drop("__place")


def _best_links(edges: DataFrame) -> DataFrame:
    """The LINKS nearest of each node; a link that was known before is not fresh."""
    known = edges.groupBy("a", "b").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
    return _nearest(known, "a", ["d", "b"], LINKS)


def _descent_round(nodes: DataFrame, graph: DataFrame, number: int) -> DataFrame:
    """One join of neighbours of neighbours; ``graph`` has a, b, d, fresh."""
    ways = graph.select(F.col("a").alias("v"), F.col("b").alias("u"), "fresh").withColumn("way", F.lit(0))
    ways = ways.unionAll(
        graph.select(F.col("b").alias("v"), F.col("a").alias("u"), "fresh", F.lit(1).alias("way"))
    )
    turn = F.xxhash64("v", "u", F.lit(number))
    place = F.row_number().over(
        Window.partitionBy("v", "way").orderBy(F.desc("fresh"), turn)
    )
    sampled = ways.withColumn("place", place).filter(f"place <= {SAMPLED}")
    bars = graph.groupBy("a").agg(F.max("d").alias("far"), F.count("*").alias("links"))
    known = nodes.join(bars, nodes.node == bars.a, "left").select(
        F.col("node").alias("u"),
        "vector",
        F.when(F.col("links") >= LINKS, F.col("far")).otherwise(F.lit(float("inf"))).alias("bar"),
    )
    lists = (
        sampled.select("v", "u", "fresh")
        .join(known, "u")
        .groupBy("v")
        .agg(F.collect_list(F.struct("u", "fresh", "bar", "vector")).alias("links"))
    )  # at most twice SAMPLED entries each
    proposed = lists.select("links").mapInArrow(_local_joins, "a long, b long, d double")
    tried = sampled.filter("way = 0").select(
        F.col("v").alias("a"), F.col("u").alias("b"), F.lit(True).alias("tried")
    )
    old = graph.join(tried, ["a", "b"], "left").select(
        "a", "b", "d", (F.col("fresh") & F.col("tried").isNull()).alias("fresh")
    )
    return _best_links(
        old.unionByName(proposed.withColumn("fresh", F.lit(True))).repartition("a")
    )


def _walked(seen: DataFrame, beam: int) -> tuple[DataFrame, int]:
    """The nodes of ``seen`` (q, node, d, done) that a walk goes on from: the ``beam`` nearest of
    each query, of which ``front`` marks the next ones to expand. And the number of these.

    A node that fell out stays out when it is reached again, as the beam only gets nearer.
    """
    order = Window.partitionBy("q").orderBy("d", "node")
    waiting = F.count_if(~F.col("done")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    front = (~F.col("done") & (waiting <= EXPANDED)).alias("front")
    marked = _nearest(seen, "q", ["d", "node"], beam).select("*", front)
    fronts = Observation()
    written = staged(marked.observe(fronts, F.count_if("front").alias("number")), "walked")
    return written, fronts.get["number"]


class NeighbourIndex:
    """A neighbour graph over the distinct usable vectors of a table.

    Rows that take no part: see ``usable``; an empty table gives an empty index. ``keep`` ids
    of equal vectors are remembered, the smallest ones, enough for ``keep`` - 1 neighbours.
    """

    def __init__(
        self, vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
        keep: int = 11, seed: int = 0,
    ):
        self.spark, self.keep = vectors.sparkSession, keep
        self.rows = staged(usable(vectors, id_column, vector_column), "vectors")
        keyed = self.rows.withColumn("key", F.xxhash64("vector"))
        first = _nearest(keyed.withColumn("k", F.struct("key", "vector")), "k", ["id"], keep)
        grouped = first.groupBy("k").agg(
            F.min("id").alias("node"), F.array_sort(F.collect_list("id")).alias("ids")
        )
        self.nodes = staged(grouped.select("node", "ids", F.col("k.vector").alias("vector")), "nodes")
        self.count = self.nodes.count()
        wanted = max(SAMPLE_ROWS, LEAF_SAMPLE << tree_depth(self.count))
        sample = (
            self.nodes.orderBy(F.xxhash64("node"), "node").limit(wanted).select("node", "vector")
        ).toArrow()
        self.sample = sample
        self.graph = self._build(seed)

    def _points(self, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and vectors of the first rows of the bounded sample."""
        rows = self.sample.slice(0, limit).combine_chunks()
        if not rows.num_rows:
            return np.empty(0, np.int64), np.empty((0, 1))
        ids, vectors = (rows.column(n).combine_chunks() for n in ("node", "vector"))
        return ids.to_numpy(zero_copy_only=False).astype(np.int64), _matrix(vectors)

    def _build(self, seed: int) -> DataFrame:
        points, depth = self._points(self.sample.num_rows)[1], tree_depth(self.count)
        trees = self.spark.sparkContext.broadcast(_trees(points, seed, depth))
        placed = staged(
            self.nodes.select("node", "vector", _leaves(trees, depth)("vector").alias("place")),
            "leaves",
        )
        starts = None
        for tree in range(TREES):
            order = [F.col("place.leaf")[tree], F.col("place.along")[tree], F.col("node")]
            parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            edges = (
                placed.select("node", "vector", order[0].alias("leaf"), order[1].alias("along"))
                .repartitionByRange(parts, "leaf", "along", "node")
                .sortWithinPartitions("leaf", "along", "node")
                .select("node", "vector")
                .mapInArrow(_block_edges, "a long, b long, d double")
            )
            starts = edges if starts is None else starts.unionAll(edges)
        vectors = self.nodes.select("node", "vector")
        graph = staged(_best_links(starts.withColumn("fresh", F.lit(True)).repartition("a")), "graph")
        for number in count():  # ends: links only get nearer, and each is tried once
            links = Observation()  # counted as they are written
            graph = staged(
                _descent_round(vectors, graph, number).observe(
                    links, F.count_if("fresh").alias("fresh"), F.count("*").alias("all")
                ),
                "graph",
            )
            if links.get["fresh"] <= ENOUGH * links.get["all"]:
                return graph

    def _walkable(self) -> DataFrame:
        """Links in both directions, the nearest twice LINKS of each node."""
        links = self.graph.select("a", "b", "d")
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
        near = _nearest(both.groupBy("a", "b").agg(F.min("d").alias("d")), "a", ["d", "b"], 2 * LINKS)
        return staged(near.select("a", "b"), "walk")

    def search(self, queries: DataFrame, k: int = 10) -> DataFrame:
        """(query_id, rank, vec_id, score) of the ``k`` nearest rows found per query.

        ``queries`` has id and vector as ``usable`` gives them. A row with the id of the query
        is never its own neighbour; equal scores go to the smaller id. Scores are Euclidean
        distances of the original vectors in double precision. ``k`` is less than the index's
        ``keep``: of vectors that more rows share, only so many ids are known.
        """
        if k >= self.keep:
            raise ValueError(f"build the index with keep={k + 1} or more for {k} neighbours")
        asked = staged(queries.select(F.col("id").alias("q"), F.col("vector").alias("qv")), "queries")
        walk, nodes = self._walkable(), self.nodes.select(F.col("node"), "vector")
        entry = F.explode(_entries(self.spark.sparkContext.broadcast(self._points(ENTRIES)))("qv"))
        near = asked.select("q", "qv", entry.alias("node")).join(nodes, "node").select(
            "q", "node", _distance("qv", "vector").alias("d")
        )
        # the node of an equal vector, however many rows share it
        kind = dict(nodes.dtypes)["vector"]
        own = asked.join(nodes, F.col("qv").cast(kind) == F.col("vector")).select(
            "q", "node", _distance("qv", "vector").alias("d")
        )
        start = near.unionByName(own).groupBy("q", "node").agg(F.min("d").alias("d"))
        beam = max(BEAM, 2 * k + 2)
        seen, fronts = _walked(start.withColumn("done", F.lit(False)), beam)
        while fronts:  # ends: every round expands nodes that were not
            reached = (
                seen.filter("front")
                .select("q", F.col("node").alias("a"))
                .join(walk, "a")
                .select("q", F.col("b").alias("node"))
                .distinct()
                .join(seen.select("q", "node"), ["q", "node"], "left_anti")
                .join(nodes, "node")
                .join(asked, "q")
                .select("q", "node", _distance("qv", "vector").alias("d"))
                .withColumn("done", F.lit(False))
            )
            kept = seen.select("q", "node", "d", (F.col("done") | F.col("front")).alias("done"))
            seen, fronts = _walked(kept.unionByName(reached), beam)
        closest = _nearest(seen, "q", ["d", "node"], k + 1)
        found = closest.join(self.nodes.select("node", F.explode("ids").alias("id")), "node")
        scored = found.filter("id <> q").select(
            F.col("q").alias("query_id"), F.col("id").alias("vec_id"), F.sqrt("d").alias("score")
        )
        place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return (
            scored.withColumn("rank", place)
            .filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        )
