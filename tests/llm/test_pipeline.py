"""The stages of the corpus pipeline and the whole of it against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as H

import corpus_pipeline as P
from ledgermill.llm import tables
from ledgermill.llm.mixing import BLOCK_WORDS, MAX_REPEATS, plan_sources
from ledgermill.llm.quality import score_quality
from ledgermill.session import staged
from tests.llm.test_operators import DOCS, SF_DIR, brute_components

chance = random.Random(11)
WORDS = [f"w{i}" for i in range(500)]
A, B, C, D, E, F = (" ".join(chance.choices(WORDS, k=n)) for n in (30, 41, 52, 63, 74, 85))
# (id, text): copies with and without ids, ids on two texts, rows without words
ROWS = [
    (3, A), (None, A + " more"), (None, B), (None, None), (None, ""), (None, C), (None, C + " end"),
    (7, A + " x"), (7, D), (9, D + " y"), (9, E), (4, ""), (4, ""), (4, " "), (5, F), (5, F),
]


def frame(spark, rows):
    sources = itertools.cycle(["a", "b", None, "a"])
    return spark.createDataFrame(
        [(i, t, "en", s, len(t or "")) for (i, t), s in zip(rows, sources)], DOCS
    )


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def content_keys(spark, rows):
    """(id, text, source) to what orders rows by content: the hashes of their columns."""
    docs = frame(spark, rows)
    hashes = docs.select("*", H.xxhash64(*docs.columns).alias("x"), H.xxhash64(H.lit(1), *docs.columns).alias("y"))
    return {(r.doc_id, r.text, r.source): (r.x, r.y) for r in hashes.collect()}


def with_sources(rows):
    return [(i, t, s) for (i, t), s in zip(rows, itertools.cycle(["a", "b", None, "a"]))]


def without_copies(rows, keys):
    """Of rows (id, text, source) those that stay; the least content of those with equal ids."""
    found = brute_components({k: text for k, (_, text, _) in enumerate(rows)})
    kept, groups = [], {}
    for k, (doc_id, text, _) in enumerate(rows):
        size, component = found[k]
        group = component if size else ("blank", doc_id, text) if doc_id is not None else ("row", k)
        groups.setdefault(group, []).append((doc_id is None, doc_id or 0, keys[rows[k]], k))
    for members in groups.values():
        kept.append(rows[min(members)[3]])
    return kept


def mixed(rows, keys):
    """Rows of (id, text, source) as often as the mix takes them; ids and sizes tell them apart."""
    own: dict[str | None, list] = {}
    for doc_id, text, source in rows:
        size = len((text or "").encode().split())
        name = "null" if doc_id is None else str(doc_id)
        order = hashlib.md5(f"0/{name}/{size}".encode()).hexdigest()
        own.setdefault(source, []).append(((order, keys[doc_id, text, source]), doc_id, text, size))
    totals = [(s, sum(x[3] for x in members)) for s, members in own.items()]
    taken = Counter()
    for plan in plan_sources(totals, 40, BLOCK_WORDS, MAX_REPEATS):
        quota = min(plan.blocks * BLOCK_WORDS, MAX_REPEATS * plan.words)
        passes, rest = divmod(quota, plan.words) if plan.words else (0, 0)
        for _, doc_id, text, size in sorted(own[plan.source], key=lambda x: x[0]):
            if size:
                words = size * passes + max(0, min(size, rest))
                taken[doc_id, text] += int(words / size + 0.5)
            rest -= size
    return +taken


@pytest.mark.parametrize("written", [True, False])
def test_one_row_of_each_group_of_copies_stays(spark, written):
    docs = frame(spark, ROWS)
    docs = staged(docs.repartition(3), "docs") if written else docs
    kept = P.near_duplicates(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    found = pairs(kept)
    stay = without_copies(with_sources(ROWS), content_keys(spark, ROWS))
    assert found == Counter((i, t) for i, t, _ in stay)
    assert found[None, B] == found[None, None] == found[None, ""] == found[7, D] == found[5, F] == 1
    assert found[None, A + " more"] == found[7, A + " x"] == found[9, D + " y"] == 0


def test_rows_are_mixed_each_by_itself(spark):
    rows = [(None, A), (None, B), (None, C), (7, D), (7, E), (8, F), (2, "one two"), (1, ""), (1, None)]
    docs = staged(frame(spark, rows), "docs")
    expected = mixed(with_sources(rows), content_keys(spark, rows))
    assert len({n for (i, _), n in expected.items() if i is None}) > 1
    assert pairs(P.mixture(spark, docs, SF_DIR)) == expected


PASSAGE = " ".join(chance.choices(WORDS, k=14))


def without_passages(rows, passages):
    """Rows that share no ten words in a row with a passage; all words are lower-case letters."""
    windows = {tuple(p.split()[k : k + 10]) for p in passages for k in range(len(p.split()) - 9)}

    def hit(text):
        words = (text or "").split()
        return any(tuple(words[k : k + 10]) in windows for k in range(len(words) - 9))

    return [r for r in rows if not hit(r[1])]


@pytest.fixture
def folder(spark, tmp_path):
    rows = [*ROWS, (11, f"{D} {PASSAGE[:-3]}"), (None, f"start {PASSAGE}"), (12, A[:60])]
    frame(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(None, PASSAGE), (1, "not in any text")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), rows


def test_passages_of_items_without_an_id_go(spark, folder):
    path, rows = folder
    docs = tables.read(spark, path, "documents")
    expected = Counter(without_passages(rows, [PASSAGE, "not in any text"]))
    assert len(rows) - expected.total() == 2
    assert pairs(P.decontamination(spark, docs, path)) == expected


def test_quality_keeps_what_the_classifier_accepts(spark):
    docs = tables.read(spark, SF_DIR, "documents").unionByName(frame(spark, ROWS))
    docs = staged(docs, "docs")
    scored = score_quality(docs, tables.read(spark, SF_DIR, "labels")).collect()
    kept = pairs(P.quality(spark, docs, SF_DIR))
    assert kept == Counter((r.doc_id, r.text) for r in scored if r.predicted == 1)
    assert 0 < kept.total() < len(scored)


def test_the_whole_pipeline(spark, folder, monkeypatch):
    from tokenizers import Tokenizer

    path, rows = folder
    monkeypatch.setattr(P, "STAGES", [("quality", lambda s, d, f: d), *P.STAGES[1:]])
    keys, listed = content_keys(spark, rows), with_sources(rows)
    clean = set(without_passages([(i, t) for i, t, _ in listed], [PASSAGE]))
    kept = [r for r in without_copies(listed, keys) if r[:2] in clean]
    whole, expected = Tokenizer.from_file(tables.tokenizer("byte_bpe_50k.json")), Counter()
    for (doc_id, text), copies in mixed(kept, keys).items():
        ids = [*whole.encode(text, add_special_tokens=False).ids, 2]
        expected[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += copies
    found = P.run(spark, path).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == expected
    ends = sorted((r.start, r.start + r.n_tokens) for r in found)
    assert all(a[1] == b[0] for a, b in itertools.pairwise(ends))


def test_reruns_agree_on_rows_staged_anew(spark):
    """Near copies without an id and on a repeated id, written three times in other orders."""
    rows = [(None, f"{A} tail{k}") for k in range(6)] + [(7, f"{B} x{k}") for k in range(4)] + ROWS
    found = set()
    for parts in (1, 3, 5):
        docs = staged(frame(spark, rows).repartition(parts, H.rand(parts)), "docs")
        kept = staged(P.near_duplicates(spark, docs, SF_DIR), "kept")
        mix = P.mixture(spark, kept, SF_DIR)
        found.add((frozenset(pairs(kept).items()), frozenset(pairs(mix).items())))
    assert len(found) == 1


def test_stages_of_an_empty_table_and_of_extra_columns(spark):
    docs = frame(spark, ROWS).withColumns({"size": H.lit(1), "place": H.lit("p"), "group": H.lit(2), "score": H.lit(3)})
    for name, stage in P.STAGES[1:4]:
        made = stage(spark, staged(docs, "docs"), SF_DIR)
        assert made.columns == docs.columns and made.count() > 0, name
        assert stage(spark, staged(docs.limit(0), "docs"), SF_DIR).count() == 0, name
