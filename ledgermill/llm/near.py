"""Near copies: all links of an n-gram Jaccard join, by PartEnum signatures.

Two sets with Jaccard similarity of 3/4 or more differ in at most a third of the smaller
one's size. So when the feature domain is dealt into enough partitions, they agree exactly on
some combination of partitions; a hash of the features there is a signature that both share.
Signatures depend on a size level, so that only sets of like size meet.

Steps:

1. Every text becomes its set of shingles; texts with equal sets are one node.
2. Signatures are shuffled and sorted; each bucket links its members to its first one.
3. One such candidate per node is verified on the sets; components of the links follow.
4. In one of ``PROBE`` buckets, dealt into chunks of bounded size, the closest other component
   of every component is tried. This joins groups whose copies differ from their first one.
5. Where buckets hold several components, the closest pair of every two is verified, then all
   pairs of those components that had such a pair and are still apart.

Sizes and parity sketches rule out pairs before that, and both tests lose nothing. Dense
groups of copies cost a few verifications per member, not one per pair. The probe only joins
early what the last step would join too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.components import components
from ledgermill.llm.text import (
    MIX,
    bound_batches,
    if_small,
    mixed,
    plain_words,
    raw,
    shingles,
    signed,
    tidy,
    word_hashes,
)
from ledgermill.session import staged

SHINGLE_WORDS = 5
LEVEL_RATIO = 16 / 9
SLACK = 1.2  # more partitions than the bound needs, so that empty ones are never needed
SUBSETS_UP_TO = 256  # sets up to this size use pairs out of three partitions
FIRST_SIZE = 3  # distinct smaller sets cannot reach 3/4
PROBE = 8  # one of so many buckets is probed for near components
CHUNK = 512  # members of a bucket that are probed together
SIDE = 4096  # comparisons of a larger bucket than SIDE x SIDE are dealt into chunk pairs
PER_TASK = 50_000  # rows of one component's buckets that are sent to one task
PER_SALT = 4096  # candidates of one node that are verified in one group


def _level_ends() -> np.ndarray:
    ends, size = [], float(FIRST_SIZE + 1)
    while size < 2**40:
        ends.append(int(size))
        size = max(size + 1, size * LEVEL_RATIO)
    return np.array(ends)


LEVEL_ENDS = _level_ends()


def level_of(smaller: int) -> int:
    """The level that handles pairs whose smaller set has this size."""
    return int(np.searchsorted(LEVEL_ENDS, smaller))


def level_shape(level: int) -> tuple[int, int, int]:
    """(groups, partitions per group, partitions that may differ in a group).

    Pairs of the level differ in at most ``k`` features; with ``groups`` times
    (``may_differ`` + 1) above ``k`` some group has at most ``may_differ`` differing ones.
    """
    k = int(LEVEL_ENDS[level]) // 3
    each, may_differ = (3, 1) if LEVEL_ENDS[level] <= SUBSETS_UP_TO else (1, 0)
    groups = int(np.ceil(SLACK * (k + 1) / (may_differ + 1))) + 1
    return groups, each, may_differ


@lru_cache(maxsize=None)
def _combinations(level: int) -> list[tuple[tuple[int, ...], np.ndarray]]:
    """The partitions that may agree within a group, and a tag per group for each choice."""
    groups, each, may_differ = level_shape(level)
    return [
        (chosen, mixed(np.arange(groups, dtype=np.uint64) * np.uint64(1 << 16) + np.uint64(level * 64 + k)))
        for k, chosen in enumerate(combinations(range(each), each - may_differ))
    ]


def _left_out(contents: np.ndarray, most: int) -> np.ndarray:
    """The sums of ``contents`` with each choice of up to ``most`` of them left out."""
    total = contents.sum(dtype=np.uint64)
    sums = [np.array([total])]
    for number in range(1, most + 1):
        chosen = np.array(list(combinations(range(len(contents)), number)))
        sums.append(total - contents[chosen].sum(1, dtype=np.uint64))
    return np.concatenate(sums)


def _shared_parts(content_of: np.ndarray, level: int, differing: int) -> np.ndarray:
    """Signatures of a small or uneven set: features dealt into parts, each part signed with
    up to so many features left out, never all of them.

    A pair that differs in at most ``differing`` features meets: it shares features in all
    parts but some number ``r``, and of the other parts one holds no more than an even share
    of the differing features. The features in the ``r`` parts all differ, so ``r`` parts with
    the fewest features bound that share from either set's own view.
    """
    k = int(LEVEL_ENDS[level]) // 3
    parts = 1 if k <= 2 else k // 2 + 1
    place = (content_of % np.uint64(parts)).astype(np.int64)
    spent = np.cumsum(np.concatenate([[0], np.sort(np.bincount(place, minlength=parts))[:-1]]))
    spare = (differing - spent) // (parts - np.arange(parts))
    lost = len(content_of) // 4 if len(content_of) <= LEVEL_ENDS[level] else differing
    most = min(lost, int(spare[spent <= differing].max()))
    out = []
    for part in range(parts):
        own = content_of[place == part]
        if len(own):
            tag = mixed(np.array([(part << 16) + level * 64 + 63], np.uint64))
            out.append(mixed(_left_out(own, min(most, len(own) - 1)) ^ tag))
    return np.concatenate(out)


def signatures(features: np.ndarray) -> np.ndarray:
    """The signatures of a set of distinct 64-bit features, which are evenly spread hashes.

    The set takes part in its own level and, as the larger of a pair, in the lower levels
    that it can meet. Combinations without any feature are left out: when enough groups hold
    more than ``may_differ`` filled partitions, one of those agrees, and not by being empty.
    One set of a pair with that property is enough; sets without it, mostly small ones, also
    sign parts with some features left out, so two of them meet there.
    """
    size = len(features)
    if size < FIRST_SIZE:
        return np.empty(0, np.uint64)
    content_of = mixed(features + MIX)
    out = []
    lowest = max(FIRST_SIZE, -(-3 * size // 4))
    for level in range(level_of(lowest), level_of(size) + 1):
        groups, each, may_differ = level_shape(level)
        parts = groups * each
        place = (features % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.int64)
        number = np.bincount(place, minlength=parts)
        filled = np.flatnonzero(number)
        starts = (np.cumsum(number) - number)[filled]
        content = np.zeros(parts, np.uint64)
        content[filled] = np.add.reduceat(content_of[np.argsort(place, kind="stable")], starts)
        content, number = content.reshape(groups, each), number.reshape(groups, each)
        end = int(LEVEL_ENDS[level])
        differing = size // 3 if size <= end else (size + end) // 7
        sound = ((number > 0).sum(1) > may_differ).sum()
        for chosen, tags in _combinations(level):
            total, count = content[:, chosen[0]], number[:, chosen[0]]
            for column in chosen[1:]:
                total, count = total + content[:, column], count + number[:, column]
            found = total ^ tags
            out.append(mixed(found[count > 0]))
        if sound * (may_differ + 1) <= differing:
            out.append(_shared_parts(content_of, level, differing))
    return np.concatenate(out)


def set_key(features: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed integer; equal sets are taken to be one node."""
    total = features.sum(dtype=np.uint64) ^ np.uint64(len(features))
    return int(signed(mixed(np.array([total], np.uint64)))[0])


def sketch(features: np.ndarray) -> bytes:
    """Parities of the features per hash bucket, about two buckets per feature.

    Each feature that only one of two sets has flips one bit, so the number of differing bits
    never exceeds the number of differing features. Halves can be folded onto each other.
    """
    width = 1 << max(6, int(2 * len(features) - 1).bit_length())
    spots = ((features >> np.uint64(20)) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(spots, minlength=width) & 1).astype(np.uint8).tobytes()


def folded(data: bytes, width: int) -> np.ndarray:
    """A sketch brought down to ``width`` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(data, np.uint8).reshape(-1, width), axis=0)


def text_sets(array: pa.Array, n: int) -> Iterator[np.ndarray]:
    return (shingles(word_hashes(plain_words(text)), n) for text in raw(array))


def _node_rows(n: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = list(text_sets(part.column(1), n))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) for s in sets], pa.int64()),
                        pa.array([sketch(s) for s in sets], pa.binary()),
                    ],
                    names=["id", "n_shingles", "node", "sketch"],
                )

    return rows


def _signature_rows(n: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()  # copies within a task sign once
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                found, nodes = [], []
                for features in text_sets(batch.column(0).slice(at, 500), n):
                    node = set_key(features)
                    if node in seen or len(features) < FIRST_SIZE:
                        continue
                    if len(seen) >= 2_000_000:
                        seen.clear()
                    seen.add(node)
                    made = signatures(features)
                    found.append(made)
                    nodes.append(np.full(len(made), node, np.int64))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(np.concatenate(found))), pa.array(np.concatenate(nodes))],
                        names=["sig", "node"],
                    )

    return rows


def _leader_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (sig, node) rows to (sig, lead, node, many): each further node of a bucket once.

    ``many`` marks buckets of three nodes or more. The last row of a batch waits for the next
    one to tell.
    """
    last_sig = last_lead = last_node = None
    many_sig = None  # the last bucket, once it is known to have three nodes
    held = [np.empty(0, np.int64)] * 3

    def batch_of(sig, lead, node, many):
        columns = [pa.array(x) for x in (sig, lead, node, many)]
        return pa.RecordBatch.from_arrays(columns, names=["sig", "lead", "node", "many"])

    for batch in batches:
        sig, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(sig):
            continue
        starts = np.concatenate([[True], sig[1:] != sig[:-1]])
        new_node = starts | np.concatenate([[True], node[1:] != node[:-1]])
        goes_on = last_sig is not None and sig[0] == last_sig
        if goes_on:
            new_node[0] = node[0] != last_node
        begin = np.maximum.accumulate(np.where(starts, np.arange(len(sig)), 0))
        lead = node[begin]
        if goes_on:
            lead = np.where(begin == 0, last_lead, lead)
        kept = new_node & (node != lead)
        last_sig, last_lead, last_node = sig[-1], lead[-1], node[-1]
        rows = [np.concatenate([h, x[kept]]) for h, x in zip(held, (sig, lead, node), strict=True)]
        if not len(rows[0]):
            continue
        same = rows[0][1:] == rows[0][:-1]
        many = np.concatenate([[rows[0][0] == many_sig], same]) | np.concatenate([same, [False]])
        if many[-1] or rows[0][-1] != last_sig:
            many_sig = rows[0][-1] if many[-1] else None
            held = [x[:0] for x in rows]
            yield batch_of(*rows, many)
        else:
            many_sig = None
            held = [x[-1:] for x in rows]
            if len(many) > 1:
                yield batch_of(*(x[:-1] for x in rows), many[:-1])
    if len(held[0]):
        yield batch_of(*held, np.array([False]))


def _set_rows(n: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                sets = list(text_sets(batch.column(0).slice(at, 500), n))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_key(s) for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["node", "features"],
                )

    return rows


def _plausible(
    size_a: pa.Array, sketch_a: pa.Array, size_b: pa.Array, sketch_b: pa.Array
) -> pa.Array:
    """False only for pairs that sizes or sketches rule out."""
    found = []
    for m, x, n, y in zip(*(c.to_pylist() for c in (size_a, sketch_a, size_b, sketch_b)), strict=True):
        ok = 4 * min(m, n) >= 3 * max(m, n)
        if ok:
            width = min(len(x), len(y))
            ok = 7 * int(np.bitwise_count(folded(x, width) ^ folded(y, width)).sum()) <= m + n
        found.append(ok)
    return pa.array(found, pa.bool_())


def _linked(percent: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by (a, salt, kind): the set of ``a``, then those it is compared with."""
        group, own = None, None
        for batch in batches:
            a, salt, kind, node, features = (batch.column(i) for i in range(5))
            left, right = [], []
            for i in range(batch.num_rows):
                values = np.frombuffer(features[i].as_buffer(), np.uint64)
                if kind[i].as_py() == 0:
                    group, own = (a[i].as_py(), salt[i].as_py()), values
                    continue
                if group != (a[i].as_py(), salt[i].as_py()):
                    continue
                spots = np.minimum(np.searchsorted(own, values), len(own) - 1)
                both = int((own[spots] == values).sum())
                if 100 * both >= percent * (len(own) + len(values) - both):
                    left.append(group[0])
                    right.append(node[i].as_py())
            if left:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
                )

    return linked


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. Each pair moves one set; a node with
    many partners is dealt out in salted groups."""
    partners = pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_SALT).cast("int").alias("salts"))
    own = partners.select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    ).withColumn("kind", F.lit(0))
    others = pairs.join(partners, "a").select(
        "a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), "b", F.lit(1).alias("kind")
    )
    rows = own.withColumn("b", F.col("a")).unionByName(others)
    return (
        rows.join(sets.withColumnRenamed("node", "b"), "b")
        .select("a", "salt", "kind", "b", "features")
        .repartition("a", "salt")
        .sortWithinPartitions("a", "salt", "kind")
        .mapInArrow(tidy(_linked(percent)), "a long, b long")
        .distinct()
    )


def _bucket_pairs(members: list[tuple]) -> np.ndarray:
    """Pairs of members of different components that may be similar, as rows
    (smaller node, larger node, differing sketch bits, smaller label, larger label)."""
    if len(members) < 2:
        return np.empty((0, 5), np.int64)
    members.sort(key=lambda m: m[1])
    nodes, sizes, labels = (np.array([m[i] for m in members], np.int64) for i in range(3))
    width = min(len(m[3]) for m in members)
    bits = np.stack([folded(m[3], width) for m in members]).view(np.uint64)
    starts = np.searchsorted(sizes, -(-3 * sizes // 4))
    ends = np.searchsorted(sizes, 4 * sizes // 3, side="right")
    names, number = np.unique(labels, return_counts=True)
    main = labels == names[number.argmax()]  # only the others look for partners
    found = []
    for i in np.flatnonzero(~main):
        j = np.arange(starts[i], ends[i])
        j = j[(labels[j] != labels[i]) & (main[j] | (j > i))]
        if len(j):
            apart = np.bitwise_count(bits[j] ^ bits[i]).sum(1, dtype=np.int64)
            ok = 7 * apart <= sizes[i] + sizes[j]
            if ok.any():
                found.append(np.stack([np.full(int(ok.sum()), i), j[ok], apart[ok]]))
    if not found:
        return np.empty((0, 5), np.int64)
    i, j, apart = np.concatenate(found, axis=1)
    x, y, p, q = nodes[i], nodes[j], labels[i], labels[j]
    ends = np.minimum(x, y), np.maximum(x, y), apart, np.minimum(p, q), np.maximum(p, q)
    return np.stack(ends, 1)


def _closest(pairs: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """The rows of ``pairs`` with the fewest differing bits for each combination of ``keys``."""
    order = np.lexsort((pairs[:, 1], pairs[:, 0], pairs[:, 2], *keys))
    ends = np.stack(keys, 1)[order]
    first = np.concatenate([[True], (ends[1:] != ends[:-1]).any(1)])
    return pairs[order[first]]


def _nearest(pairs: np.ndarray) -> np.ndarray:
    """For each component the closest pair with any other one."""
    if not len(pairs):
        return pairs
    ends = np.concatenate([pairs[:, 3], pairs[:, 4]])
    return _every(_closest(np.concatenate([pairs, pairs]), ends))


def _best(pairs: np.ndarray) -> np.ndarray:
    """For every two components their closest pair."""
    return _closest(pairs, pairs[:, 3], pairs[:, 4]) if len(pairs) else pairs


def _every(pairs: np.ndarray) -> np.ndarray:
    return np.unique(pairs, axis=0)


def _cross_pairs(keep: Callable, chunk: int | None = None):
    """Rows sorted by sig and part (sig, part, node, size, label, sketch) to pairs
    (a, b, apart, x, y). Members with the same sig and part are compared.

    ``keep`` picks pairs from those of a bucket and again from those of many buckets;
    ``chunk`` cuts buckets into parts of that size.
    """

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found):
            columns = [pa.array(np.ascontiguousarray(c)) for c in found.T]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b", "apart", "x", "y"])

        group, members, found = None, [], np.empty((0, 5), np.int64)
        fresh, held = [], 0

        def gather():
            nonlocal found, fresh, held
            found, fresh, held = keep(np.concatenate([found, *fresh])), [], 0

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != group or len(members) == chunk:
                    fresh.append(keep(_bucket_pairs(members)))
                    held += len(fresh[-1])
                    group, members = row[:2], []
                    if held > 250_000 or len(fresh) > 10_000:
                        gather()
                        if len(found) > 250_000:  # little was repeated
                            yield batch_of(found)
                            found = found[:0]
                members.append(row[2:])
        fresh.append(keep(_bucket_pairs(members)))
        gather()
        if len(found):
            yield batch_of(found)

    return cross


def near_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    n: int = SHINGLE_WORDS, percent: int = 75,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when 100 times the intersection of their shingle sets is at least
    ``percent`` (75 or more) times the union. ``component_id`` is the smallest id that links
    reach. Texts of fewer than ``n`` words have one shingle; null and empty texts have none,
    link to nothing and keep their own id. Repeated rows are copies of each other; null ids
    count as larger than all others. Other columns are ignored.
    """
    if percent < 75:
        raise ValueError("the signatures are laid out for a similarity of 0.75 or more")
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    id_type = dict(texts.dtypes)["id"]
    rows = staged(
        texts.mapInArrow(
            tidy(_node_rows(n)), f"id {id_type}, n_shingles long, node long, sketch binary"
        ),
        "rows",
    )
    nodes = staged(
        rows.filter("n_shingles > 0")
        .groupBy("node")
        .agg(
            F.min("id").alias("id"),
            F.first("n_shingles").alias("size"),
            F.first("sketch").alias("sketch"),
        ),
        "nodes",
    )
    signed_rows = texts.select("text").mapInArrow(tidy(_signature_rows(n)), "sig long, node long")
    buckets = staged(
        signed_rows.repartition("sig")
        .sortWithinPartitions("sig", "node")
        .mapInArrow(tidy(_leader_rows), "sig long, lead long, node long, many boolean"),
        "buckets",
    )

    def sketched(pairs: DataFrame, column: str, name: str) -> DataFrame:
        own = nodes.select(
            F.col("node").alias(column),
            F.struct("size", "sketch").alias(name),
        )
        return pairs.join(own, column)

    def sets_of(pairs: DataFrame) -> DataFrame:
        """The sets of all nodes of ``pairs``, from the text of one document of each."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        ids = nodes.select("node", "id").join(wanted, "node", "left_semi").select("id")
        chosen = if_small(staged(ids, "chosen")).withColumnRenamed("id", "__id")
        picked = texts.join(chosen, F.col("id").eqNullSafe(F.col("__id")), "left_semi")
        return staged(
            picked.select("text").mapInArrow(tidy(_set_rows(n)), "node long, features binary"), "sets"
        )

    test = F.arrow_udf(_plausible, returnType="boolean")
    starred = buckets.select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    plausible = staged(
        sketched(sketched(starred, "a", "x"), "b", "y")
        .filter(test("x.size", "x.sketch", "y.size", "y.sketch"))
        .select("a", "b"),
        "plausible",
    )
    # buckets of two are done with their one pair
    larger = staged(buckets.filter("many").select("sig", "lead", "node"), "larger")
    first = staged(plausible.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs")
    labels = staged(components(verified(if_small(first), sets_of(first), percent)), "labels")

    def labelled(df: DataFrame, column: str, name: str) -> DataFrame:
        found = labels.select(F.col("node").alias(column), F.col("component").alias(name))
        return df.join(found, column, "left").withColumn(name, F.coalesce(name, column))

    def crossing(
        buckets: DataFrame, keep: Callable, chunk: int | None = None, among: DataFrame | None = None
    ) -> DataFrame:
        """Candidates (a, b, apart, x, y) between components x and y that share a bucket.

        Buckets led by one component share tasks, as many as their rows need, so that a pair
        which meets in many buckets is rarely sent on twice. A large bucket is dealt into chunks,
        and every two of them are a part with a task of its own. ``among`` lists the components
        (column label) to look at; all of them if it is None.
        """
        both = staged(
            labelled(labelled(buckets, "node", "label"), "lead", "lead_label"), "labelled"
        )
        size, strangers = F.count("*").cast("double"), F.count_if(F.expr("label <> lead_label"))
        chunks = F.ceil(F.greatest(F.sqrt(size * strangers) / SIDE, size / PER_TASK))
        split = both.groupBy("sig").agg(  # all rows of a bucket have the same lead
            F.min("lead").alias("node"),
            F.min("lead_label").alias("lead_label"),
            strangers.alias("strangers"),
            (chunks if chunk is None else F.lit(1)).cast("long").alias("chunks"),
        )
        split = staged(split.filter("strangers > 0").drop("strangers"), "split")
        members = (
            both.drop("lead_label")
            .join(split.drop("node"), "sig")
            .select("sig", "node", "label", "lead_label", "chunks")
            .unionAll(split.select("sig", "node", F.col("lead_label").alias("label"), "lead_label", "chunks"))
        )
        if among is not None:
            members = members.join(among, "label", "left_semi")
        tasks = members.groupBy("lead_label").agg(F.ceil(F.count("*") / PER_TASK).alias("tasks"))
        tasks = if_small(staged(tasks.filter("tasks > 1"), "tasks"))  # all others fill one
        turn = F.pmod(F.xxhash64("sig"), F.coalesce("tasks", F.lit(1)))
        # with one chunk more than the work asks for, two of them hold no more than that
        pairs = F.expr(
            "if(chunks = 1, array(0L), transform(filter(sequence(0L, chunks), k -> k <> chunk), "
            "k -> least(k, chunk) * (chunks + 1) + greatest(k, chunk)))"
        )
        spread = (
            members.join(tasks, "lead_label", "left")
            .withColumn("chunk", F.pmod(F.xxhash64("node", "sig"), F.col("chunks") + 1))
            .withColumn("part", F.explode(pairs))
            .withColumn(
                "task",
                F.when(F.col("chunks") > 1, F.xxhash64("sig", "part")).otherwise(
                    F.xxhash64("lead_label", turn)
                ),
            )
            .drop("chunks", "chunk", "tasks")
        )
        return (
            sketched(spread, "node", "x")
            .repartition("task")
            .sortWithinPartitions("sig", "part", F.xxhash64("sig", "node"))
            .select("sig", "part", "node", "x.size", "label", "x.sketch")
            .mapInArrow(tidy(_cross_pairs(keep, chunk)), "a long, b long, apart long, x long, y long")
        )

    def open_pairs() -> DataFrame:
        """The pairs of step 2 that still lie between components."""
        found = labelled(labelled(plausible, "a", "x"), "b", "y").filter("x <> y")
        return found.select(
            F.least("a", "b").alias("a"),
            F.greatest("a", "b").alias("b"),
            F.lit(2**40).alias("apart"),
            F.least("x", "y").alias("x"),
            F.greatest("x", "y").alias("y"),
        )

    def join_components(pairs: DataFrame) -> None:
        """Verify pairs (a, b) and join the components that they link."""
        nonlocal labels
        more = staged(verified(if_small(pairs), sets_of(pairs), percent), "links")
        if not more.isEmpty():
            known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
            labels = staged(components(known.unionAll(more)), "labels")

    probe = larger.filter(F.pmod(F.xxhash64("sig"), F.lit(PROBE)) == 0)
    nearest = staged(crossing(probe, _nearest, CHUNK).select("a", "b").distinct(), "pairs")
    if not nearest.isEmpty():
        join_components(nearest)
    closest = crossing(larger, _best).unionByName(open_pairs())
    closest = closest.groupBy("x", "y").agg(F.min(F.struct("apart", "a", "b")).alias("p"))
    closest = staged(closest.select("x", "y", "p.a", "p.b"), "pairs")
    if not closest.isEmpty():
        join_components(closest.select("a", "b"))
        # components without such a pair have no candidates at all, and joins add none
        apart = labelled(labelled(closest, "x", "p"), "y", "q").filter("p <> q")
        among = staged(apart.select(F.explode(F.array("p", "q")).alias("label")).distinct(), "apart")
        every = crossing(larger, _every, among=if_small(among)).unionByName(open_pairs())
        every = staged(every.select("a", "b").distinct(), "pairs")
        if not every.isEmpty():
            join_components(every)
    final = labels.withColumnRenamed("component", "found")
    found = nodes.select("node", F.col("id").alias("least")).join(final, "node", "left")
    found = found.withColumn("found", F.coalesce("found", "node"))
    groups = found.groupBy("found").agg(F.min("least").alias("component_id"))
    named = found.join(groups, "found").select("node", "component_id")
    full = rows.filter("n_shingles > 0").join(named, "node")
    empty = rows.filter("n_shingles = 0").withColumn("component_id", F.col("id"))
    return full.unionByName(empty).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id"
    )
