"""The training-data operators against brute force, and on awkward rows."""

from __future__ import annotations

import glob
import itertools
import os
import random
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from check import bag
from ledgermill.llm import queries as Q
from ledgermill.llm import extract, tables
from ledgermill.llm.counts import (
    CountOnlyViterbi,
    WordCounts,
    count_tokens,
    sentencepiece_vocabulary,
    unpacked,
)
from ledgermill.llm.decontaminate import find_contamination, without_documents, without_spans
from ledgermill.llm.extract import extract_main_text, main_text
from ledgermill.llm.mixing import apportion, capped_targets, mix_sources
from ledgermill.llm.near import near_copies, signatures, sketch
from ledgermill.llm.neighbours import NeighbourIndex
from ledgermill.llm.quality import score_quality
from ledgermill.llm.shards import assign_shards
from ledgermill.llm.text import plain_words, shingles, word_hashes
from ledgermill.llm.tokens import EliasFano, Encoder, read_documents, write_tokens
from ledgermill.llm.urls import judge_urls
from ledgermill.session import stage_path

SF_DIR = "/root/testdata/sf0.001"
BPE = tables.tokenizer("byte_bpe_50k.json")
PIECES = tables.tokenizer("piece_bpe_32k.model")
AWKWARD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", None, 3),
    (4, "one two three four five six seven eight nine ten eleven", "en", "b", 1),
    (4, "one two three four five six seven eight nine ten eleven", "en", "b", 1),
    (5, "ONE two", None, "b", None),
    (6, "wörter " * 3000, "de", "a", 9),
    (None, "no id here", "en", None, 1),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCS)


# token files


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], [1, 2, 900, 40000], list(range(3000))])
def test_elias_fano_round_trip(values):
    values = np.array(values, np.int64)
    universe = int(values.max(initial=0))
    copy = EliasFano.from_bytes(EliasFano.encode(values, universe).to_bytes())
    assert copy.select(np.arange(len(values))).tolist() == values.tolist()
    assert copy.select(np.arange(len(values))[::-7]).tolist() == values[::-7].tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(0).integers(1, 1000, 20_000))
    size = len(EliasFano.encode(values, int(values[-1])).to_bytes())
    assert size < 2 * len(values)  # 8 bytes each as 64-bit offsets


def test_encoder_equals_whole_text_encoding():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BPE)
    whole.encode_special_tokens = True
    chance = random.Random(7)
    parts = [" ", "  ", "\n", "\n\n", "\t", "a", "don't", "É", "12", "!?", "<|endoftext|>", "\u00a0",
             "\x1c", "日本", "x.\nY", " \n ", "é́"]
    texts = ["".join(chance.choices(parts, k=chance.randint(0, 12))) for _ in range(3000)]
    found = Encoder(BPE, limit=50).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        expected = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u2").tolist() == expected, repr(text)


def test_library_sees_a_word_once_whatever_mark_follows(monkeypatch):
    from tokenizers import Tokenizer

    whole, own, asked = Tokenizer.from_file(BPE), Encoder(BPE), []
    make = own._encode_words
    monkeypatch.setattr(own, "_encode_words", lambda words, prefix: asked.extend(words) or make(words, prefix))
    texts = ["On blend, blend. blend\nOn été. été, ɏÀ, x2, 2, don't, 's. é\u0301, ,", "On blend. ɐ, ɐ", ""]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert (asked.count("blend"), asked.count("été"), asked.count("ɏÀ")) == (1, 1, 1)
    assert not {"blend,", "blend.", "été.", "été,", "ɏÀ,"} & {*asked}


def test_texts_are_encoded_in_bounded_parts(monkeypatch):
    from ledgermill.llm import tokens

    monkeypatch.setattr(tokens, "BATCH_BYTES", 10)
    texts = ["a" * 4, None, "b" * 6, "c", "d" * 30, "", "e"]
    batch = pa.record_batch({"doc_id": pa.array(range(7)), "text": pa.array(texts)})
    assert [x.column(0).to_pylist() for x in tokens.bounded(batch)] == [[0, 1, 2], [3], [4], [5, 6]]
    assert list(tokens.bounded(batch.slice(0, 0))) == []


def test_workers_give_memory_back_after_a_task(monkeypatch):
    from ledgermill.llm import text

    given = []
    monkeypatch.setattr(text, "give_back", lambda: given.append(1))
    rows = text.tidy(lambda batches: (b for b in batches))
    assert (list(rows(iter([1, 2]))), len(given)) == ([1, 2], 1)
    broken = rows(iter([1, 2]))
    next(broken)
    broken.close()
    assert len(given) == 2


def test_idle_worker_drops_its_encoder(monkeypatch):
    from ledgermill.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_SECONDS", 0.5)
    with tokens.encoder(BPE) as first:
        pass
    with tokens.encoder(BPE) as second:
        time.sleep(1)  # a task that takes longer
        assert second is first and BPE in tokens._ENCODERS
    time.sleep(1.5)
    assert BPE not in tokens._ENCODERS


def test_token_files(spark, awkward):
    from tokenizers import Tokenizer

    path = stage_path(spark, "tokens")
    write_tokens(awkward, path, BPE, end_id=2, block_ids=50)
    rows = read_documents(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 4, 5, 6]
    whole, at = Tokenizer.from_file(BPE), 0
    texts = {d: t for d, t, *_ in AWKWARD}
    for row in rows:
        ids = [*whole.encode(texts[row.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (row.start, row.n_tokens) == (at, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_special_tokens_as_the_library_has_them(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BPE)
    texts = ["one<|endoftext|>two", "<|endoftext|>", "a  <|endoftext|>\n b", "plain text", ""]
    for text, ids in zip(texts, Encoder(BPE, special=True).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = stage_path(spark, "tokens")
    write_tokens(docs, path, BPE, end_id=2)
    rows = read_documents(spark, path).orderBy("start").collect()
    sizes = [len(whole.encode(t, add_special_tokens=False).ids) + 1 for t in texts]
    assert [r.n_tokens for r in rows] == sizes


def test_token_files_of_nothing(spark, nothing):
    path = stage_path(spark, "tokens")
    write_tokens(nothing, path, BPE, end_id=2)
    assert read_documents(spark, path).count() == 0


# token counts


def reference_unigram(vocabulary):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace()]
    )
    return tokenizer


def test_counts_equal_the_tokenizer(spark, awkward):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").unionByName(awkward)
    whole = reference_unigram(sentencepiece_vocabulary(PIECES))
    for row in count_tokens(docs, PIECES).collect():
        assert row.n_tokens == len(whole.encode(row.text or "", add_special_tokens=False).ids)


def test_counts_on_ties_and_unknown_characters():
    vocabulary = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.5)]
    whole, own = reference_unigram(vocabulary), CountOnlyViterbi(vocabulary)
    for n in range(1, 6):
        for letters in itertools.product("abx", repeat=n):
            word = "".join(letters)
            assert own.count("▁" + word)[0] == len(whole.encode(word).ids), word


def test_remembered_counts_equal_fresh_ones():
    rng = random.Random(5)
    viterbi = CountOnlyViterbi([("<unk>", 0.0), ("▁", -2.0), ("a", -1.0), ("ab", -2.0), ("▁b", -3.0)])
    counter = WordCounts(viterbi, limit=7)
    for _ in range(2000):
        word = "".join(rng.choice("ab☃") for _ in range(rng.randint(1, 5)))
        assert unpacked(counter[word]) == viterbi.count("▁" + word)
        assert len(counter) <= 7 and len(counter.before) <= 7


def test_counts_of_nothing(nothing):
    assert count_tokens(nothing, PIECES).count() == 0


# benchmark passages


def test_decontamination_rules(spark, awkward):
    items = [(7, "zero One TWO three four five six seven eight nine ten"), (8, "two"), (9, ""),
             (10, None), (None, "wörter"), (8, "ten eleven")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = awkward.withColumn("items", F.lit("mine")).withColumn("n_words", F.lit(-1))
    for slice_words in (500_000, 3):
        found = find_contamination(docs, benchmark, slice_words=slice_words)
        rows = {r.doc_id: r for r in found.collect()}
        assert found.count() == len(AWKWARD)
        assert rows[4].hit_words == list(range(11)) and rows[4].items == ["7", "8"]
        assert rows[5].hit_words == [1] and rows[5].items == ["8"]
        assert rows[6].n_words == 3000 and not rows[6].contaminated
        assert rows[1].n_words == 0 and rows[1].n_items == 0
    assert {r.doc_id for r in without_documents(found).collect()} == {1, 2, 3, 6, None}
    assert {r.doc_id: r.text for r in without_spans(found).collect()}[5] == "ONE "


def test_decontamination_of_nothing(spark, awkward, nothing):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert find_contamination(awkward, empty).filter("contaminated").count() == 0
    assert find_contamination(nothing, empty).count() == 0


def test_items_without_an_id_hit_without_a_name(spark, awkward):
    items = [(8, "two"), (None, "wörter")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for slice_words in (500_000, 1):
        found = find_contamination(awkward, benchmark, slice_words=slice_words, nameless=True)
        rows = {r.doc_id: r for r in found.collect()}
        assert rows[6].contaminated and len(rows[6].hit_words) == 3000
        assert rows[6].items == [] and rows[6].n_items == 0
        assert rows[5].items == ["8"] and not rows[1].contaminated


# URL rules


def test_url_rules_against_all_pairs(spark):
    chance = random.Random(3)
    hosts = ["a.com", "b.a.com", "ab.com", "com", "x.b.a.com", "A.Com", "a..com", ""]
    paths = ["", "/", "/p", "/p/q", "/pq", "/z?x=/p", "/p#f"]
    urls = [f"http://{chance.choice(hosts)}{chance.choice(paths)}" for _ in range(200)]
    urls += [None, "", "no scheme", "://", "x://h/p://y"]
    rules = [("com", "/", "allow"), ("a.com", "/p", "block"), ("a.com", "/p/", "allow"),
             ("b.a.com", "", "block"), ("com", "/p", "allow"), ("a.com", "/p", "allow"),
             (None, "/", "block")]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    for row in judge_urls(pages, table).collect():
        fits = [
            (len(h) + len(p), len(h), v == "block", h + p, v)
            for h, p, v in rules
            if h is not None
            and (row.host == h or row.host.endswith("." + h))
            and row.path.startswith(p)
        ]
        best = max(fits, default=(0, 0, 0, None, "allow"))
        assert (row.rule, row.verdict) == best[3:], row


def test_url_rules_on_one_hot_host(spark):
    pages = spark.range(5000).select(
        F.col("id").alias("page_id"), F.lit("https://x.a.com/same").alias("url")
    )
    rules = spark.createDataFrame([("a.com", "/s", "block")], "host string, path string, verdict string")
    found = judge_urls(pages, rules)
    assert found.filter("verdict = 'block'").count() == 5000
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert judge_urls(pages, rules.limit(0)).filter("rule is null").count() == 5000


# shards and mixtures


def test_shards_match_the_mixture(spark):
    docs = spark.range(1000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 400, "big").when(F.col("id") < 990, (F.col("id") % 7 + 10).cast("string")).alias("source"),
        F.lit("mine").alias("slot"),
    )
    rows = assign_shards(docs, 7).collect()
    by_shard = {s: [r for r in rows if r.shard == s] for s in range(7)}
    assert sorted(len(x) for x in by_shard.values()) == [142, 143, 143, 143, 143, 143, 143]
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.source == "big" for r in own) - 400 / 7) < 2.5


def test_shards_of_awkward_rows(awkward, nothing):
    rows = assign_shards(awkward, 40).collect()
    assert len(rows) == len(AWKWARD) and {r.slot for r in rows} == {0}
    assert assign_shards(nothing, 40).count() == 0


def highest_quotients(targets, seats):
    found = sorted(
        ((-t / (2 * j + 1), i) for i, t in enumerate(targets) if t for j in range(seats))
    )[:seats]
    return [sum(i == k for _, i in found) for k in range(len(targets))]


@pytest.mark.parametrize("seats", [0, 1, 2, 5, 17, 100])
@pytest.mark.parametrize("targets", [[1.0], [3.0, 1.0, 1.0], [0.0, 5.5, 2.25, 100.0], [2.0] * 6])
def test_apportionment(targets, seats):
    assert apportion(targets, seats) == highest_quotients(targets, seats)


def test_targets_share_what_is_over():
    assert capped_targets([100, 1, 0], [1, 2, 3], 3) == [98.0, 3.0, 0.0]
    assert capped_targets([], [], 3) == []


def test_mix_starts_no_python_workers(spark, awkward, monkeypatch):
    from pyspark import RDD

    expected = sorted(mix_sources(awkward).collect(), key=repr)
    monkeypatch.setattr(RDD, "_to_java_object_rdd", lambda self: pytest.fail("rows went through Python workers"))
    assert sorted(mix_sources(awkward).collect(), key=repr) == expected


def test_mix_of_awkward_rows(awkward, nothing):
    rows = mix_sources(awkward, n_shards=2, block_words=4).collect()
    assert len(rows) == len(AWKWARD)
    assert all(r.taken <= 3 * r.size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 4
    assert mix_sources(nothing).count() == 0


# near copies


def brute_components(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, text in texts.items():
        words = plain_words((text or "").encode())
        n = min(5, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
    least = {i: i for i in texts}
    changed = True
    links = [
        (a, b)
        for a, b in itertools.combinations(texts, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return {i: (len(sets[i]), least[i]) for i in texts}


def test_near_copies_against_all_pairs(spark):
    chance = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    texts: dict[int, str | None] = {0: None, 1: "", 2: "a b", 3: "A  b", 4: "a b c"}
    for base in range(12):
        text = chance.choices(words, k=chance.choice([5, 8, 9, 20, 60, 300]))
        for _ in range(12):
            copy = list(text)
            for _ in range(chance.randint(0, max(1, len(text) // 18))):
                copy[chance.randrange(len(copy))] = chance.choice(words)
            texts[len(texts)] = " ".join(copy)
            if chance.random() < 0.5:
                text = copy  # chains as well as stars
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()],
                                 "doc_id long, text string, component_id string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies(docs).collect()}
    assert found == brute_components(texts)


def test_similar_sets_share_a_signature():
    generator = np.random.default_rng(1)
    for size in (3, 4, 5, 7, 12, 40, 130, 260, 700, 3000):
        for _ in range(15):
            # the most features that may differ: shared, then own features of both sides
            shared = generator.integers(0, 2**64, -(-6 * size // 7), np.uint64)
            rest = (2 * size - 2 * len(shared)) if len(shared) * 7 >= 3 * 2 * size else 0
            left = generator.integers(0, 2**64, rest // 2, np.uint64)
            right = generator.integers(0, 2**64, rest - rest // 2, np.uint64)
            a, b = np.unique(np.append(shared, left)), np.unique(np.append(shared, right))
            c = np.unique(shared)
            for x, y in ((a, b), (a, c), (c, b)):
                both = len(np.intersect1d(x, y))
                if len(x) >= 3 and 4 * both >= 3 * (len(x) + len(y) - both) and both < max(len(x), len(y)):
                    assert len(np.intersect1d(signatures(x), signatures(y))), (len(x), len(y))


@pytest.mark.parametrize("size", [3, 4, 5, 6, 7, 8, 10, 12, 13, 17, 22, 23, 30])
def test_small_sets_share_exact_signatures(size):
    generator = np.random.default_rng(size)
    seen: dict[int, int] = {}
    for _ in range(400):
        a = np.unique(generator.integers(0, 2**64, size, np.uint64))
        for s in set(signatures(a).tolist()):
            seen[s] = seen.get(s, 0) + 1
        # every way to stay at 3/4 or more: lose some features, gain others
        for lost in range(size // 4 + 1):
            most = (4 * (size - lost)) // 3 - size
            gained = generator.integers(0, most + 1) if most > 0 else 0
            for new in {0, int(gained), max(0, most)}:
                kept = generator.permutation(a)[lost:]
                b = np.unique(np.append(kept, generator.integers(0, 2**64, new, np.uint64)))
                if len(b) >= 3 and 4 * len(kept) >= 3 * (size + new):
                    assert len(np.intersect1d(signatures(a), signatures(b))), (size, lost, new)
    assert max(seen.values()) <= 2  # distinct random sets do not meet


def test_large_buckets_are_dealt_into_chunk_pairs(spark, monkeypatch):
    from ledgermill.llm import near

    dealt, write = [], near.staged

    def noted(df, label):
        out = write(df, label)
        if label == "large":
            dealt.append(out.count())
        return out

    monkeypatch.setattr(near, "SIDE", 2)
    monkeypatch.setattr(near, "staged", noted)
    chance = random.Random(8)
    head = [f"h{i}" for i in range(12)]
    texts = {i: " ".join([*head, *(f"t{chance.randrange(10**6)}" for _ in range(6))]) for i in range(60)}
    for i in range(60, 80):
        texts[i] = texts[chance.randrange(40)] + " end"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies(docs).collect()}
    assert found == brute_components(texts) and max(dealt) > 0


def test_sketches_never_overstate():
    generator = np.random.default_rng(2)
    a = np.unique(generator.integers(0, 2**64, 500, np.uint64))
    b = np.append(a[:450], generator.integers(0, 2**64, 30, np.uint64))
    x, y = (np.frombuffer(sketch(np.unique(s)), np.uint8) for s in (a, b))
    assert int(np.bitwise_count(x ^ y).sum()) <= 80


def test_near_copies_of_nothing(nothing):
    assert near_copies(nothing).count() == 0


# extraction


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("no markup at all but some words", "no markup at all but some words"),
        ("<p>a &lt;b&gt; &amp;&nbsp;c<br>d</p><script>if (1<2) x()</script>", "a <b> & c d"),
        ("<nav><a href=x>home</a></nav><article><h1>T</h1><p>one<p>two</article><footer>f</footer>",
         "T\none\ntwo"),
        ("<article><p>one</p><div class='share-bar ad'>buy</div><p>two</p></article>"
         "<section id=comments><p>first!</p></section>", "one\ntwo"),
        ("<body><div class=cookie-notice><p>We use the cookies of this and that for you.</p></div>"
         "<main><p><b>open <p>next</main>", "open\nnext"),
        ("<article><form><p>mail</p><input></form><p>kept 1 < 2</p></article>", "kept 1 < 2"),
        ("<article><p>a<!-- <p>x</p> --> b", "a b"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


SENTENCE = "This is the text of the page and it is as long as it has to be for all of them."


@pytest.mark.parametrize(
    "page, text",
    [
        ("<svg width='1' /><article><p>one</p></article><svg><text>x</text></svg>", "one"),
        ("<article><svg viewBox='0 0 1 1'/><p>one</p></article>", "one"),
        ("<article><svg viewBox='0 0 1 1'><p>one</p></article>", "one"),
        ("<div class='page has-sidebar'><article><p>one</p></article></div>", "one"),
        ("<div class='page sidebar-left'><article><p>one</p><p class=share>x</p></article></div>", "one"),
        ("<div id='content' class='no-nav with-comments'><article><p>one</p></article></div>", "one"),
        ("<div class='comments-open'><article><p>one</p></article></div>", "one"),
        ("<form><nav>home<main><p>one</p></main></form>", "one"),
        ("<article><p>one</p></article><div class=related><article><p>two</p></article></div>", "one"),
        ("<article><p>one</p><article class=comment><p>me!</p></article></article>", "one"),
        ("<article><p>one</p><aside><article><p>ad</p></article></aside><p>two</p></article>", "one\ntwo"),
        ("<div hidden><article><p>old</p></article></div><article><p>one</p></article>", "one"),
        ("<article><p>See <a href=x>the list of all the parts</a>.</p><p><a href=y>next</a></p></article>",
         "See the list of all the parts."),
        (f"<div class='has-sidebar'><p>{SENTENCE * 3}</p></div>", SENTENCE * 3),
    ],
)
def test_articles_are_not_lost(page, text):
    assert main_text(page) == text


def test_blocks_without_article_take_their_neighbours_verdict():
    long = "The end of the day is as good as it was for all of them and that is what they had. " * 4
    links = "<ul>" + "".join(f"<li><a href=/{i}>topic {i}</a></li>" for i in range(9)) + "</ul>"
    page = f"<div>{links}</div><div><p>{long}</p><p>Short one.</p><p>{long}</p></div><div>{links}</div>"
    assert main_text(page).split("\n") == [long.strip(), "Short one.", long.strip()]


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>a <button>Buy</button> b</p>", "a b"),
        ("<article><p>a <span class='ad'>buy now</span><span hidden>x</span>b</p></article>", "a b"),
        ("<article><p>a <object>fallback</object>b</p></article>", "a b"),
        ("<article><p>one<button>x<p>two</article>", "one\ntwo"),
        ("<article><p>a <math><mi>x</mi></math> b</p></article>", "a x b"),
        ("<article><span class=ad><div>buy</div></span><p>one</p></article>", "one"),
        (f"<article><h2>More</h2></article><div><p>{SENTENCE * 3}</p></div>", SENTENCE * 3),
        (f"<main><h1>Title</h1></main><div><p>{SENTENCE * 3}</p></div>", "Title\n" + SENTENCE * 3),
        (f"<article class='post promo'><p>{SENTENCE * 3}</p></article>", SENTENCE * 3),
        (f"<article id='story-reply'><p>{SENTENCE * 3}</p></article>", SENTENCE * 3),
        (f"<div class='legal-text'><p>{SENTENCE * 3}</p></div>", SENTENCE * 3),
        (f"<form id=aspnet><nav>home</nav><p>{SENTENCE * 3}</p></form>", SENTENCE * 3),
        (f"<div class='cookie-notice'><p>{SENTENCE * 3}</p></div>", ""),
        ("<form><p>Your name</p><p>Your mail</p></form>", ""),
        ("<p>Wczoraj wieczorem pociąg spóźnił się znacznie, bowiem silna burza zerwała przewody.</p>"
         "<p>Dzisiaj kolejarze naprawili uszkodzenia, pasażerowie spokojnie wrócili swoimi drogami.</p>",
         "Wczoraj wieczorem pociąg spóźnił się znacznie, bowiem silna burza zerwała przewody.\n"
         "Dzisiaj kolejarze naprawili uszkodzenia, pasażerowie spokojnie wrócili swoimi drogami."),
    ],
)
def test_pieces_go_and_doubtful_text_stays(page, text):
    wanted = "\n".join(line.strip() for line in text.split("\n"))
    assert main_text(page).replace("More\n", "") == wanted


@pytest.mark.parametrize("unit", ["<svg>", "<svg a=1>t", "<!x ", "<a ", "<b", "<?x ", "<textarea>", "<i><p>"])
def test_markup_without_ends_takes_linear_time(unit):
    def seconds(size):
        page = unit * (size // len(unit))
        best = []
        for _ in range(2):
            began = time.perf_counter()
            main_text(page)
            best.append(time.perf_counter() - began)
        return min(best)

    assert seconds(800_000) < 8 * seconds(200_000) + 0.5


def planted_page(rng):
    """A page without an article element: paragraphs to keep, and menus, lists and notices."""
    stops = "the of and to in is that it for was on are with as this".split()
    rare = [f"w{rng.randrange(10**6):06d}x".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(400)]

    def prose(words):
        return " ".join(rng.choice(stops if rng.random() < 0.4 else rare) for _ in range(words)) + "."

    kept = [prose(rng.randrange(45, 160)) for _ in range(rng.randrange(3, 9))]
    lead = [prose(rng.randrange(4, 8)) for _ in kept]  # a short line before each paragraph
    menu = "".join(f"<li><a href=/{i}>{rng.choice(rare)}</a></li>" for i in range(12))
    tags = "<div>" + " ".join(rng.sample(rare, 14)) + "</div>"  # words without stop words
    body = "".join(f"<h2>{a}</h2><p>{b}</p>" for a, b in zip(lead, kept, strict=True))
    page = f"<ul>{menu}</ul>{tags}{tags}<div>{body}</div>{tags}{tags}<ul>{menu}</ul><div class=ads>{prose(60)}</div>"
    return page, "\n".join(x for pair in zip(lead, kept, strict=True) for x in pair)


def test_planted_text_by_density_rules(monkeypatch):
    rng = random.Random(5)
    pages = [planted_page(rng) for _ in range(60)]
    assert [main_text(page) for page, _ in pages] == [text for _, text in pages]
    monkeypatch.setattr(extract, "STOP_LOW", 0)  # without the rules the lists stay
    assert all(main_text(page) != text for page, text in pages)


def test_extraction_of_awkward_pages(spark):
    pages = spark.createDataFrame(
        [(1, None, "mine"), (1, "", "mine"), (2, "<p>" + "long words " * 20000, "mine")],
        "page_id long, html string, text string",
    )
    assert sorted(r.n_chars for r in extract_main_text(pages).collect()) == [0, 0, 219999]


# quality


def test_quality_on_held_out_rows(spark):
    found = Q.quality(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    joined = found.filter("held_out").join(labels, "doc_id")
    right, rows = joined.agg(F.count_if(F.expr("predicted = quality")), F.count("*")).first()
    assert right >= 0.95 * rows > 0


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (4, 1), (4, 0), (5, None), (None, 1), (6, 7)], "doc_id long, quality int"
    )
    rows = score_quality(awkward.withColumn("score", F.lit("mine")), labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    none = labels.limit(0)
    assert {r.score for r in score_quality(awkward, none).collect()} == {0.5}
    assert score_quality(nothing, none).count() == 0


# neighbours


def test_neighbours(spark):
    generator = np.random.default_rng(4)
    points = generator.normal(size=(400, 8)).round(2)
    points[50:90] = points[50]  # equal vectors
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    bad = [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [float("nan")] * 8), (1004, [1.0, 2.0]),
           (1005, [None] * 8), (None, [1.0] * 8), (1006, [float("inf")] * 8)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    index = NeighbourIndex(table)
    found = index.search(index.rows.filter("id % 20 = 0"), k=10).collect()
    hits = total = 0
    for query in range(0, 400, 20):
        own = sorted((r for r in found if r.query_id == query), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11))
        apart = np.sqrt(((points - points[query]) ** 2).sum(1))
        expected = sorted((d, i) for i, d in enumerate(apart) if i != query)[:10]
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        assert all(abs(r.score - apart[r.vec_id]) < 1e-9 for r in own)
        hits += len({i for _, i in expected} & {r.vec_id for r in own})
        total += 10
    assert hits >= 0.9 * total
    assert [r.vec_id for r in sorted((r for r in found if r.query_id == 60), key=lambda r: r.rank)] == [
        *range(50, 60)
    ]


def test_neighbours_of_many_rows(spark):
    points = np.random.default_rng(1).normal(size=(20_000, 64)).astype(np.float32)
    points /= np.linalg.norm(points, axis=1)[:, None]
    table = spark.createDataFrame(
        pa.table({"vec_id": np.arange(len(points)), "embedding": pa.array(list(points))})
    )
    index = NeighbourIndex(table)
    found = index.search(index.rows.filter("id % 200 = 0"), k=10).collect()
    asked = np.arange(0, len(points), 200)
    exact = points.astype(np.float64)
    hits = 0
    for block in np.split(asked, 10):
        apart = ((exact[block][:, None, :8] - exact[:, :8]) ** 2).sum(2)
        for at in range(8, 64, 8):
            apart += ((exact[block][:, None, at : at + 8] - exact[:, at : at + 8]) ** 2).sum(2)
        apart[np.arange(len(block)), block] = np.inf
        for query, near in zip(block, np.argsort(apart, axis=1)[:, :10], strict=True):
            hits += len(set(near.tolist()) & {r.vec_id for r in found if r.query_id == query})
    assert hits >= 0.9 * 10 * len(asked)


def test_queries_start_from_an_equal_vector(spark, monkeypatch):
    from ledgermill.llm import neighbours

    monkeypatch.setattr(neighbours, "ENTRIES", 0)  # nothing else leads to it
    points = np.random.default_rng(6).normal(size=(200, 8))
    points[20:60] = points[20]
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)],
                                  "vec_id long, embedding array<double>")
    index = NeighbourIndex(table)
    queries = index.rows.filter("id = 55").unionByName(
        spark.createDataFrame([(-1, points[20].tolist())], "id long, vector array<double>")
    )
    found = index.search(queries, k=10).collect()
    for query in (55, -1):
        own = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == query)
        assert own == [(i + 1, 20 + i, 0.0) for i in range(10)]


def test_a_walk_keeps_no_more_than_its_beam(spark, monkeypatch):
    from ledgermill.llm import neighbours

    walked, write = [], neighbours.staged

    def noted(df, label):
        out = write(df, label)
        if label == "walked":
            walked.append(out.groupBy("q").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(neighbours, "BEAM", 40)
    monkeypatch.setattr(neighbours, "staged", noted)
    generator = np.random.default_rng(5)
    vectors = generator.standard_normal((1500, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = NeighbourIndex(table)
    queries = index.rows.filter("id % 100 = 0")
    found = {(r.query_id, r.vec_id) for r in index.search(queries).collect()}
    wanted = set()
    for q in range(0, 1500, 100):
        apart = ((vectors - vectors[q]) ** 2).sum(1)
        apart[q] = np.inf
        wanted |= {(q, int(i)) for i in np.argsort(apart)[:10]}
    assert len(found & wanted) >= 0.9 * len(wanted)
    assert len(walked) > 1 and max(walked) <= 40


def test_more_neighbours_than_the_index_keeps_are_refused(spark):
    """Forty equal vectors: with ids enough, all are found at distance 0."""
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(100 + i, [float(i), -1.0]) for i in range(10)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="keep=31"):
        NeighbourIndex(table).search(spark.createDataFrame([(0, [1.0, 2.0])], "id long, vector array<double>"), k=30)
    index = NeighbourIndex(table, keep=31)
    found = index.search(index.rows.filter("id = 0"), k=30).collect()
    assert len(found) == 30 and all(r.score == 0 for r in found)


def test_neighbours_of_nothing(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    index = NeighbourIndex(table)
    assert index.search(index.rows).count() == 0


# registered queries


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_its_sql(spark, db, name):
    df = Q.QUERIES[name](spark, SF_DIR)
    result = db.execute(Q.SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag(df.columns, df.collect()) == bag(columns, result.fetchall())


def test_no_python_in_the_native_plan(spark):
    plan = Q.shards(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Join Cross"))


def test_shingles_of_short_texts():
    assert len(shingles(word_hashes([b"a", b"b"]), 5)) == 1
    assert len(shingles(word_hashes([]), 5)) == 0


def test_bucket_leaders_in_any_batches():
    import pyarrow as pa

    from ledgermill.llm.near import _leader_rows

    chance = random.Random(9)
    rows = sorted((chance.randint(0, 12), chance.randint(0, 5)) for _ in range(90))
    expected = []
    for sig, group in itertools.groupby(rows, key=lambda r: r[0]):
        nodes = sorted({n for _, n in group})
        expected += [(sig, nodes[0], n, len(nodes) > 2) for n in nodes[1:]]
    for size in (1, 2, 3, 7, 90):
        batches = (
            pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows[at : at + size]], pa.int64()) for i in (0, 1)],
                names=["sig", "node"],
            )
            for at in range(0, len(rows), size)
        )
        found = [tuple(r.values()) for b in _leader_rows(batches) for r in b.to_pylist()]
        assert found == expected, size
