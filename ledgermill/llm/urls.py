"""URL rules by a sort-merge range join.

A host with its labels reversed (``org.example.``) turns "this host and all its subdomains"
into a prefix, and a prefix into one interval of the sorted keys. Pages and rules are dealt
out by ranges of the key, a rule to every range that its interval meets; each range is swept
in order with a stack of the rules whose intervals are open. Ranges are cut by key, path and
row number, so a host with a third of all pages, or one repeated URL, spreads over many tasks.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_RANGE = 60  # keys sampled per range to place the cuts
_LAST = chr(0x10FFFF)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(host: Column) -> Column:
    return F.translate(host, _UPPER, _LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = _lowered(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class OpenRules:
    """The stack of rules whose host intervals hold the current key.

    Each entry keeps the path prefixes of one rule host. Memory holds the rules of one chain
    of hosts, not the rule table.
    """

    def __init__(self):
        self.stack: list[tuple[str, dict[str, tuple], list[int]]] = []

    def move_to(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, host: str, path: str, verdict: str) -> None:
        self.move_to(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        _, paths, lengths = self.stack[-1]
        rank = (len(host) + len(path), len(host), verdict == "block")
        if path not in paths or paths[path][0] < rank:
            paths[path] = (rank, host + path, verdict)
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def best(self, path: str) -> tuple[str, str] | None:
        found = None
        for _, paths, lengths in self.stack:
            for n in lengths:
                rule = paths.get(path[:n]) if n <= len(path) else None
                if rule:
                    if found is None or rule[0] > found[0]:
                        found = rule
                    break
        return found and found[1:]


def _sweep(default: str):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, last = OpenRules(), None
        for batch in batches:
            keys, hosts, paths, verdicts = (
                batch.column(n).to_pylist() for n in ("key", "host", "path", "verdict")
            )
            kinds = batch.column("kind").to_pylist()
            named, judged, pages = [], [], []
            for i, key in enumerate(keys):
                if kinds[i] == 0:
                    rules.open(key, hosts[i], paths[i], verdicts[i])
                    continue
                if key != last:
                    rules.move_to(key)
                    last = key
                name, verdict = rules.best(paths[i]) or (None, default)
                named.append(name)
                judged.append(verdict)
                pages.append(i)
            picked = batch.take(pa.array(pages, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [picked.column(n) for n in ("host", "path", "page")]
                + [pa.array(named, pa.string()), pa.array(judged, pa.string())],
                names=["host", "path", "page", "rule", "verdict"],
            )

    return sweep


def _cuts(pages: DataFrame, ranges: int) -> list[tuple[str, str, int]]:
    """The lower ends of all ranges but the first, from a bounded sample of keys."""
    size = ranges * SAMPLE_PER_RANGE
    sample = pages.orderBy(F.xxhash64("key", "path", "row")).limit(size)
    found = sorted((r.key, r.path, r.row) for r in sample.select("key", "path", "row").collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def judge_urls(
    pages: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` plus host, path, rule (null if none fits) and verdict.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all
    subdomains where the page's path starts with its path. The longest rule wins; of equally
    long ones the one with the longer host, then block over allow. Without a rule the verdict
    is ``default``. Rules with a null in any column are ignored. Null URLs and URLs without
    ``://`` have an empty host and path; repeated rows are all kept; columns of ``pages`` with
    the names of results are replaced.
    """
    spark = pages.sparkSession
    results = ("host", "path", "rule", "verdict")
    host, path = url_parts(F.col(url_column))
    carried = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c not in results])
    keyed = pages.select(carried.alias("page"), host.alias("host"), path.alias("path")).select(
        host_key(F.col("host")).alias("key"),
        "host",
        "path",
        F.monotonically_increasing_id().alias("row"),
        "page",
    )
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = _cuts(keyed.drop("page", "host"), ranges)

    def range_of(keys: pa.Array, paths: pa.Array, rows: pa.Array) -> pa.Array:
        places = zip(keys.to_pylist(), paths.to_pylist(), rows.to_pylist(), strict=True)
        return pa.array([bisect_right(cuts, place) for place in places], pa.int32())

    def ranges_of(keys: pa.Array) -> pa.Array:
        spans = (
            range(bisect_right(cuts, (k,)), bisect_right(cuts, (k + _LAST,)) + 1)
            for k in keys.to_pylist()
        )
        return pa.array([list(s) for s in spans], pa.list_(pa.int32()))

    page_range = F.arrow_udf(range_of, returnType="int")
    rule_ranges = F.arrow_udf(ranges_of, returnType="array<int>")
    clean = rules.select("host", "path", "verdict").dropna().distinct()
    opened = (
        clean.withColumn("host", _lowered(F.col("host")))
        .withColumn("key", host_key(F.col("host")))
        .withColumn("part", F.explode(rule_ranges("key")))
        .withColumn("kind", F.lit(0))
        .withColumn("row", F.lit(0).cast("long"))
    )
    judged = keyed.withColumn("part", page_range("key", "path", "row")).withColumn("kind", F.lit(1))
    both = judged.unionByName(opened, allowMissingColumns=True)
    page_type = keyed.schema["page"].dataType.simpleString()
    swept = (
        both.repartitionById(len(cuts) + 1, F.col("part"))
        .sortWithinPartitions("key", "kind", "path", "row")
        .select("key", "kind", "host", "path", "verdict", "page")
        .mapInArrow(
            _sweep(default),
            f"host string, path string, page {page_type}, rule string, verdict string",
        )
    )
    return swept.select("page.*", *results)
