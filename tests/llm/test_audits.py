"""Source divergence, toxicity and the Merkle manifest against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from check import bag
from ledgermill.llm import divergence, toxicity
from ledgermill.llm import queries as Q
from ledgermill.llm.divergence import audit_sources, frequent_terms
from ledgermill.llm.merkle import build_manifest, digest_of, fold, siblings
from ledgermill.llm.toxicity import Features, Isotonic, fit_trees, score_toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# source divergence


def plain_audit(rows, least):
    """Rows of (lang, source, part, item, value, rank) as the contract words them."""
    docs = [(lang or "", source or "", re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().lower()))
            for _, text, lang, source, _ in rows]
    found = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        frequency = Counter(t for _, _, words in mine for t in set(words))
        kept = [t for t, n in frequency.items() if n >= least]
        counts, whole = defaultdict(Counter), Counter()
        for _, source, words in mine:
            counts[source].update(w for w in words if frequency[w] >= least)
            whole.update(w for w in words if frequency[w] >= least)

        def shares(counter, kept=kept):
            total = sum(counter.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (counter[t] + 5) // total for t in kept}

        every, usual = {s: shares(counts[s]) for s in {d[1] for d in mine}}, shares(whole)
        for source, own in every.items():
            pairs = [(-sum(abs(own[t] - p[t]) for t in kept), other) for other, p in every.items() if other != source]
            for rank, (value, other) in enumerate(sorted(pairs, key=lambda p: (p[0], p[1].encode())), 1):
                found.append((lang, source, "pair", other, -value, rank))
            lifted = [(usual[t] - own[t], t) for t in kept if counts[source][t] and own[t] > usual[t]]
            for rank, (value, term) in enumerate(sorted(lifted)[:50], 1):
                found.append((lang, source, "term", term.decode(), -value, rank))
    return sorted(found)


def audited(audit):
    pairs = audit.distances().withColumn("part", F.lit("pair")).withColumnRenamed("other", "item")
    from pyspark.sql import Window

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = audit.lifted().withColumn("part", F.lit("term")).withColumnRenamed("term", "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in pairs.select(columns).unionByName(terms.select(columns)).collect())


def audit_rows(seed, n=120):
    chance = random.Random(seed)
    vocabulary = ["a", "the", "thesis", "theses", "Ärger", "ÄRGER", "straße", "donaudampfschifffahrt",
                  "donaudampfschiff", "x" * 300, "x" * 301, "é", "un"]
    rows = []
    for i in range(n):
        words = chance.choices(vocabulary, k=chance.randint(0, 12))
        source = chance.choice(["s0", "s0", "s0", "s1", None, "", "ß"])
        rows.append((i, chance.choice([" ", "-", "1"]).join(words), chance.choice(["en", "de", None]), source, 1))
    rows += [(None, None, "en", "alone", None), (7, "", "xx", "only", 0), (7, "", "xx", "two", 0)]
    return rows + rows[:5] + [(900, "the " * 50_000, "en", "s1", 1)]


@pytest.mark.parametrize("least", [3, 30])
def test_divergence_equals_plain_python(spark, least):
    rows = audit_rows(least)
    docs = spark.createDataFrame(rows, DOCS).withColumns({"number": F.lit(1), "term": F.lit("x"), "key": F.lit("k")})
    assert audited(audit_sources(docs, least=least)) == plain_audit(rows, least)


def test_divergence_in_slices_and_blocks(spark, monkeypatch):
    """Small bounds: several slices of prefixes, blocks of two sources, chunks of two terms."""
    for name, value in (("KEPT_BYTES", 300), ("BLOCK", 2), ("CHUNK", 2), ("HELD_KEYS", 3), ("HELD_OCCURRENCES", 5)):
        monkeypatch.setattr(divergence, name, value)
    rows = audit_rows(5, 60)
    assert audited(audit_sources(spark.createDataFrame(rows, DOCS), least=2)) == plain_audit(rows, 2)


def test_short_terms_and_terms_of_rare_beginnings_are_not_looked_up(monkeypatch):
    looked_up, find = [], divergence._Prefixes.__missing__
    monkeypatch.setattr(
        divergence._Prefixes, "__missing__", lambda self, term: looked_up.append(term) or find(self, term)
    )
    rows = [("en", "Brief termination, termini.\x00terminal"), ("en\x00", "terminations"), ("en", ""), ("de", "x")]
    langs, texts = (pa.array(column, pa.string()) for column in zip(*rows, strict=True))
    batches = [pa.RecordBatch.from_arrays([langs, texts], names=["lang", "text"])]
    shared = SimpleNamespace(value={"en": {b"terminat": 0}, "en\x00": {b"terminat": 0}})
    found = [r for b in divergence._document_counts(shared, 16, 8)(batches) for r in b.to_pylist()]
    assert [(r["lang"], r["key"], r["docs"]) for r in found] == [
        ("en", b"termination", 1),
        ("en\x00", b"terminations", 1),
    ]
    assert looked_up == [b"termination", b"terminations"]


def test_divergence_of_nothing(spark):
    audit = audit_sources(spark.createDataFrame([], DOCS))
    assert audited(audit) == [] and audit.terms.count() == 0


def test_terms_keep_prefixes_that_are_terms(spark):
    rows = [("en", "thesis theses the"), ("en", "the theses"), ("en", "thesis")]
    found = frequent_terms(spark.createDataFrame(rows, "lang string, text string"), least=2, first=3)
    assert sorted((bytes(r.term), r.docs) for r in found.collect()) == [(b"the", 2), (b"theses", 2), (b"thesis", 2)]


# toxicity


def test_curve_is_the_isotonic_fit():
    chance = np.random.default_rng(0)
    margins = np.round(chance.normal(size=200), 1)
    labels = (chance.random(200) < 1 / (1 + np.exp(-2 * margins))).astype(float)
    curve = Isotonic.fit(margins, labels)
    assert (np.diff(curve.of(np.linspace(-4, 4, 500))) >= 0).all()
    # the pooled mean of every block is the max-min mean of plain isotonic regression
    order = np.argsort(margins, kind="stable")
    x, y = margins[order], labels[order]
    starts = [0, *(np.flatnonzero(np.diff(x)) + 1)]
    ends = [*starts[1:], len(x)]
    plain = [max(min(y[a:b].mean() for b in ends[i:]) for a in starts[: i + 1]) for i in range(len(starts))]
    values = sorted({round(v, 9) for v in plain})
    assert len(values) == len(curve.value)
    assert np.allclose(values, curve.value, atol=0.5)


def test_trees_find_a_split_and_an_interaction():
    chance = np.random.default_rng(1)
    rows = chance.random((2000, 4))
    labels = ((rows[:, 1] > 0.3) ^ (rows[:, 2] > 0.6)).astype(float)
    trees = fit_trees(rows[:1500], labels[:1500])
    assert ((trees.margin(rows[1500:]) > 0) == (labels[1500:] == 1)).mean() > 0.97
    constant = fit_trees(np.zeros((50, 3)), np.repeat([0.0, 1.0], 25))
    assert np.allclose(constant.margin(np.zeros((3, 3))), 0)


def test_first_tree_takes_the_best_cut():
    """Depth one against every cut of every feature."""
    chance = np.random.default_rng(3)
    rows = chance.integers(0, 12, (80, 3)).astype(float)
    labels = (rows[:, 2] + chance.normal(size=80) > 6).astype(float)
    tree = fit_trees(rows, labels, rounds=1, depth=1, bins=200, least=1)
    p = (labels.sum() + 1) / 82
    slope, curve = labels - p, np.full(80, p * (1 - p))

    def gain(side):
        return slope[side].sum() ** 2 / (curve[side].sum() + 1)

    every = {(f, c): gain(rows[:, f] <= c) + gain(rows[:, f] > c)
             for f in range(3) for c in np.unique(rows[:, f])[:-1]}
    assert every[(int(tree.features[0, 0]), tree.cuts[0, 0])] == pytest.approx(max(every.values()))


def test_features_see_disguise_neighbours_and_windows():
    features = Features({b"idiot ": 3.0, b"lowei": 2.0})
    named = lambda text: dict(zip(toxicity.NAMES, features.of(text.encode()), strict=True))
    plain = named("You are such an idiot, really!")
    assert plain["hit_density"] == pytest.approx(1 / 6) and plain["near_density"] == pytest.approx(1 / 6)
    assert named("an idiotic person")["hits"] == 0 and named("Loweisch")["heaviest"] == 2.0
    assert named("an id1ot here")["disguised_hits"] > 0 and named("an i.d.i.o.t here")["disguised_hits"] > 0
    far = named("you " + "word " * 20 + "idiot")
    assert far["near_hits"] == 0 and far["person_density"] > 0
    assert named("x " * 200 + "idiot idiot")["densest"] == pytest.approx(2 / 50)
    assert features.of(b"") == [0.0] * len(toxicity.NAMES)


def toxic_rows(n=700, seed=2):
    chance = random.Random(seed)
    syllables = ["an", "be", "ko", "lu", "mi", "or", "sa", "te"]
    word = lambda: "".join(chance.choices(syllables, k=chance.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words, toxic = [word() for _ in range(chance.randint(3, 120))], int(chance.random() < 0.2)
        if toxic:
            for _ in range(max(2, len(words) // 15)):
                words.insert(chance.randrange(len(words)), "zwarg" + word())
        rows.append((i, " ".join(words), None, None, None))
        labels.append((i, 1, toxic))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = toxic_rows()
    awkward = [(None, None, None, None, None), (5000, "", None, None, None), (5001, "zwargan " * 20_000, "x", None, 0)]
    docs = spark.createDataFrame(rows + awkward, DOCS).withColumns({"score": F.lit("x"), "fold": F.lit(3), "id": F.lit(1)})
    marks = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in score_toxicity(docs, marks).collect()}
    held_out = [x for x in labels if x[0] % 3 == 0]
    right = sum(found[i].predicted == toxic for i, _, toxic in held_out)
    assert right / len(held_out) >= 0.97
    assert found[5001].predicted == 1 and found[5000].predicted == 0 and found[None].score == found[5000].score
    assert all(0 <= r.score <= 1 for r in found.values()) and found[5000].fold == 3


def test_toxicity_without_classes(spark):
    docs = spark.createDataFrame([(1, "a b", None, None, None), (2, None, None, None, None)], DOCS)
    schema = "doc_id long, quality int, toxic int"
    for marks, expected in (([], 0.5), ([(1, 0, 0), (2, 0, None)], 1 / 3), ([(1, 1, 1), (1, 1, 0)], 0.5)):
        scores = [r.score for r in score_toxicity(docs, spark.createDataFrame(marks, schema)).collect()]
        assert scores == pytest.approx([expected] * 2)
    assert score_toxicity(docs.limit(0), spark.createDataFrame([], schema)).count() == 0


def test_lexicons_leave_their_fold_out(spark):
    rows, labels = toxic_rows(200)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    picked = toxicity.labelled_rows(spark.createDataFrame(rows, DOCS), marks, "doc_id", "text", "toxic", 10_000)
    lexicons, sizes = toxicity.learn_lexicons(picked)
    assert sizes.sum() == 200
    plain = picked.collect()
    for without, lexicon in zip([*range(toxicity.FOLDS), None], lexicons, strict=True):
        toxic, clean = Counter(), Counter()
        kept = [r for r in plain if r.fold != without]
        for r in kept:
            (toxic if r.label else clean).update(
                {s for w in toxicity.words_of(r.text.encode()) for s in toxicity.stems_of(w)}
            )
        n_toxic = sum(r.label for r in kept)
        entries = sorted(toxic)
        found = toxicity.weights(
            np.array([toxic[e] for e in entries]), np.array([clean[e] for e in entries]), n_toxic, len(kept) - n_toxic
        )
        assert lexicon == pytest.approx({e: w for e, w in zip(entries, found, strict=True) if w > 0})


# the manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves, fan):
    """The root and, per leaf, its siblings level by level."""
    nodes, owners, paths = list(leaves), [[i] for i in range(len(leaves))], [[] for _ in leaves]
    while len(nodes) > 1:
        runs = [list(range(i, min(i + fan, len(nodes)))) for i in range(0, len(nodes), fan)]
        for run in runs:
            for i in run:
                for leaf in owners[i]:
                    paths[leaf] += [nodes[j] for j in run if j != i]
        owners = [[leaf for i in run for leaf in owners[i]] for run in runs]
        nodes = [sha(*[nodes[i] for i in run]) for run in runs]
    return nodes[0], paths


def plain_leaf(row):
    fields = [None if v is None else str(v) for v in row]
    return sha(*["-" if v is None else f"{len(v.encode())}:{v}" for v in fields])


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_manifest_equals_plain_python(spark, fan):
    chance = random.Random(fan)
    rows = [(chance.choice([None, *range(60)]), chance.choice([None, "", "é", "Text " * chance.randint(0, 9)]),
             None, chance.choice([None, "", "-", "=a", "hot", "hot", "hot", "hot"]), chance.choice([None, 1]))
            for _ in range(150)] + [(1, "alone", "en", "one", 5), (2, "x" * 400_000, None, "hot", 0)]
    rows += rows[:30]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"tree": F.lit(1), "path": F.lit(2), "hash": F.lit(3)})
    leaf = digest_of(*map(F.col, ("doc_id", "source", "lang", "n_chars", "text")))
    made = build_manifest(docs, leaf, "source", "doc_id", fan)
    proofs = made.proofs()
    folded = proofs.withColumn("folded", fold(F.col("leaf"), F.col("path")))
    found = Counter(
        (r.source, r.leaf, r.subroot, r.proof, r.folded)
        for r in folded.withColumn("proof", siblings(F.col("path"))).collect()
    )
    groups = defaultdict(list)
    for i, text, lang, source, n in rows:
        groups[source].append(((i is not None, i or 0), plain_leaf((i, source, lang, n, text))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([h for _, h in sorted(groups[s])], fan) for s in order}
    root, above = plain_tree([trees[s][0] for s in order], fan)
    expected = Counter()
    for place, s in enumerate(order):
        for (_, h), path in zip(sorted(groups[s]), trees[s][1], strict=True):
            expected[(s, h, trees[s][0], "".join(path + above[place]), root)] += 1
    assert made.root == root and found == expected
    assert "tree" in proofs.columns and proofs.first()["hash"] == 3
    tops = made.nodes().filter("whole").orderBy(F.desc("level")).first()
    assert tops["hash"] == root and made.nodes().filter("not whole and group = 'hot'").count() > 0


def test_manifest_of_few_rows(spark):
    leaf = digest_of(F.col("doc_id"), F.col("text"))
    nothing = build_manifest(spark.createDataFrame([], DOCS), leaf, "source", "doc_id")
    assert nothing.root is None and nothing.proofs().count() == 0 and nothing.nodes().count() == 0
    one = build_manifest(spark.createDataFrame([(1, "a", None, None, 1)], DOCS), leaf, "source", "doc_id")
    row = one.proofs().first()
    assert row.leaf == row.subroot == one.root == sha("1:11:a") and row.path == []


def test_manifest_tampering_is_found(spark, tmp_path):
    rows = [(i, "Capital" if i % 2 else "small", "en", f"s{i % 3}", i) for i in range(100)] + [(None, "A", None, None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in Q.manifest(spark, str(tmp_path)).collect()}
    for i, text, *_ in rows:
        tampered = i is not None and zlib.crc32(str(i).encode()) % 5 == 0 and text != text.lower()
        assert found[i].verified == (not tampered)


# the registered queries beside their SQL, on awkward rows


@pytest.mark.parametrize("name", ["op11_divergence", "op13_manifest"])
def test_sql_agrees_on_awkward_rows(spark, tmp_path, name):
    import duckdb

    rows = audit_rows(11) if name == "op11_divergence" else audit_rows(12, 60)
    rows += [(50_000 + i, f"common Words{i % 2} ß", "en", "s9", i) for i in range(40)]
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    df = Q.QUERIES[name](spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    result = db.execute(Q.SQL[name])
    assert bag([d[0] for d in result.description], result.fetchall()) == bag(df.columns, df.collect())


def test_prefix_keys_are_plain_slices():
    level = divergence._Prefixes({b"abc": 0}, 6, 3)
    assert level[b"abcdefg"] == b"abcdef" and level[b"abcd"] == b"abcd" and level[b"abd"] is None
    assert level[b"abc" + b"x" * 500] == b"abcxxx" and len(level) == 3
