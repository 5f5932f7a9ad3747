"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.llm import tables
from ledgermill.llm.counts import count_tokens
from ledgermill.llm.decontaminate import find_contamination
from ledgermill.llm.divergence import audit_sources
from ledgermill.llm.extract import extract_main_text
from ledgermill.llm.merkle import build_manifest, digest_of, fold, siblings
from ledgermill.llm.mixing import mix_sources
from ledgermill.llm.near import near_copies
from ledgermill.llm.neighbours import NeighbourIndex
from ledgermill.llm.quality import score_quality
from ledgermill.llm.shards import assign_shards
from ledgermill.llm.tokens import read_documents, write_tokens
from ledgermill.llm.toxicity import score_toxicity
from ledgermill.llm.urls import judge_urls
from ledgermill.session import stage_path

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
SHARDS = 40


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = NeighbourIndex(tables.read(spark, sf_dir, "embeddings"))
    return index.search(index.rows.filter("id % 100 = 0"), k=10)


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "tokens")
    docs = tables.read(spark, sf_dir, "documents")
    write_tokens(docs, path, tables.tokenizer("byte_bpe_50k.json"), end_id=2)
    return read_documents(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, tables.tokenizer("piece_bpe_32k.model")).drop("text")


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, tables.read(spark, sf_dir, "benchmark"), nameless=True)
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.read(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules).drop("url")


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return assign_shards(docs, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(tables.read(spark, sf_dir, "documents"))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.read(spark, sf_dir, "pages")
    return extract_main_text(pages).select("page_id", "url", "text", "n_chars")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of rows whose checksum leaves 0 by 5 are never seen."""
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    held_out = checksum % 5 == 0
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = tables.read(spark, sf_dir, "labels").filter(~held_out)
    return score_quality(docs, labels).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    return mix_sources(docs, SHARDS).select("doc_id", "size", "source_size", "target", "taken")


def divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = audit_sources(tables.read(spark, sf_dir, "documents"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    pairs = audit.distances().select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value",
        F.row_number().over(order).alias("rank"),
    )
    terms = audit.lifted().select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )
    return pairs.unionByName(terms)


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of rows whose checksum leaves 0 by 5 are never seen."""
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    held_out = checksum % 5 == 0
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = tables.read(spark, sf_dir, "labels").filter(~held_out)
    return score_toxicity(docs, labels).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate("text", capitals, capitals.lower())
    leaf, changed = (digest_of(*map(F.col, ("doc_id", "source", "lang", "n_chars")), text)
                     for text in (F.col("text"), lowered))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = docs.select("doc_id", "source", leaf.alias("leaf"), F.when(tampered, changed).alias("tampered"))
    made = build_manifest(rows, F.col("leaf"), "source", "doc_id")
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return made.proofs().select(
        "doc_id",
        "leaf",
        "subroot",
        F.lit(made.root).alias("root"),
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


DECONTAMINATE_SQL = r"""
with words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), items as (
  select cast(item_id as varchar) as item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null
), windows as (
  select distinct item, least(10, len(w)) as n,
    array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') as gram
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i
        from items where len(w) > 0)
), places as (
  select d.doc_id, d.i, s.n, array_to_string(list_slice(d.w, d.i, d.i + s.n - 1), ' ') as gram
  from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from words) d
  join (select distinct n from windows) s on d.i + s.n - 1 <= len(d.w)
), hits as (
  select p.doc_id, p.i, p.n, x.item from places p join windows x using (n, gram)
), hit_words as (
  select doc_id, count(distinct word) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as word from hits) group by doc_id
), hit_items as (
  select doc_id, list_sort(list(distinct item) filter (where item is not null)) as items
  from hits group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(len(items), 0) as n_items,
  sha256(array_to_string(coalesce(items, []), ',')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from words left join hit_words using (doc_id) left join hit_items using (doc_id)
"""

URL_SQL = r"""
with rules(host, path, verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), rest as (
  select page_id,
    case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as r
  from pages
), parts as (
  select page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path
  from rest
), fits as (
  select p.page_id, x.host || x.path as rule, x.verdict, row_number() over (
    partition by p.page_id order by length(x.host || x.path) desc, length(x.host) desc) as k
  from parts p join rules x
    on (p.host = x.host or ends_with(p.host, '.' || x.host)) and starts_with(p.path, x.path)
)
select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from parts p left join fits f on p.page_id = f.page_id and f.k = 1
"""

SHARDS_SQL = r"""
with bytes as (
  select doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 as size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda x: cast('0x' || x as bigint)) as b
  from documents
), crc_table as (
  select list(v order by i) as t from (
    select i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from range(256) r(i))
), rows as (
  select doc_id, size, coalesce('=' || source, 'null') as src,
    xor(list_reduce(list_prepend(4294967295::bigint, b),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as text_crc32
  from bytes, crc_table
), ranked as (
  select *, row_number() over (partition by src
      order by md5('0/' || coalesce(cast(doc_id as varchar), 'null') || '/' || src)) - 1 as r,
    count(*) over (partition by src) as n,
    cast('0x' || substr(md5(src), 1, 8) as bigint) / cast(4294967296 as double) as u
  from rows
), placed as (
  select *, row_number() over (order by (r + u) / n, src) - 1 as place, count(*) over () as total
  from ranked
)
select doc_id, cast(size as bigint) as size, text_crc32, 'rows' as law,
  cast(place * 40 // total as integer) as shard,
  cast(place - (cast(place * 40 // total as bigint) * total + 39) // 40 as bigint) as slot,
  cast(null as integer) as grown_shard
from placed
"""

MIX_SQL = r"""
with rows as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''),
    '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size,
    row_number() over (order by source is null, encode(coalesce(source, ''))) - 1 as place
  from rows group by source
), weighted as (
  select *, 1 + place % 3 as weight, 3 * source_size / cast(1 + place % 3 as double) as full_at
  from sources where source_size > 0
), levels as (
  -- if the sources before this one in order of full_at are full, the others share the rest
  select *, cast(sum(source_size) over () as double) - coalesce(sum(3 * source_size) over before, 0)
      as remains,
    sum(weight) over () - coalesce(sum(weight) over before, 0) as open_weight
  from weighted
  window before as (order by full_at, place rows between unbounded preceding and 1 preceding)
), settled as (
  select remains, open_weight from levels
  where remains * weight / open_weight <= 3 * source_size order by full_at, place limit 1
), targets as (
  select w.source, w.source_size, w.place,
    case when s.remains * w.weight / s.open_weight > 3 * w.source_size
      then cast(3 * w.source_size as double) else s.remains * w.weight / s.open_weight end as target
  from weighted w, settled s
), house as (
  select cast(round_even(sum(source_size) / 16, 0) as bigint) as seats from targets
), seats as (
  select place, count(*) as blocks from (
    select place, row_number() over (order by target / (2 * j + 1) desc, place) as k
    from (select place, target, unnest(range(seats + 1)) as j from targets, house))
  where k <= (select seats from house) group by place
), quotas as (
  select t.*, least(coalesce(blocks, 0) * 16, 3 * source_size) as quota
  from targets t left join seats using (place)
), placed as (
  select r.doc_id, r.size, s.source_size, coalesce(q.target, 0) as target,
    coalesce(q.quota, 0) as quota,
    coalesce(sum(r.size) over (partition by r.source
      order by md5('0/' || coalesce(cast(r.doc_id as varchar), 'null') || '/' || r.size), r.doc_id
      rows between unbounded preceding and 1 preceding), 0) as start
  from rows r join sources s on r.source is not distinct from s.source
  left join quotas q on q.place = s.place
)
select doc_id, size, source_size, target, cast(case when source_size = 0 then 0 else
    size * (quota // source_size) + greatest(0, least(size, quota % source_size - start)) end
  as bigint) as taken
from placed
"""

DIVERGENCE_SQL = r"""
with docs as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), words as (
  select d, lang, source, unnest(w) as term from docs
), kept as (
  select lang, term from words group by lang, term having count(distinct d) >= 30
), groups as (
  select distinct lang, source from docs
), sizes as (
  select lang, count(*) as v from kept group by lang
), counts as (
  select lang, source, term, count(*) as n from words semi join kept using (lang, term)
  group by lang, source, term
), totals as (
  select g.lang, g.source, coalesce(s.v, 0) as v, coalesce(sum(c.n), 0) as total
  from groups g left join sizes s using (lang) left join counts c using (lang, source)
  group by g.lang, g.source, s.v
), shares as (
  select t.lang, t.source, k.term, coalesce(c.n, 0) as n,
    1 + 1000000000::hugeint * (coalesce(c.n, 0) + 5) // (t.total + 5 * t.v)::hugeint as p
  from totals t join kept k using (lang) left join counts c using (lang, source, term)
), usual as (
  select lang, term,
    1 + 1000000000::hugeint * (sum(n) + 5) // (sum(sum(n)) over (partition by lang)
      + 5 * count(*) over (partition by lang))::hugeint as q
  from shares group by lang, term
), pairs as (
  select a.lang, a.source, b.source as item, (
    select coalesce(sum(abs(x.p - y.p)), 0) from shares x join shares y using (lang, term)
    where x.lang = a.lang and x.source = a.source and y.source = b.source) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
), terms as (
  select s.lang, s.source, s.term as item, s.p - u.q as value
  from shares s join usual u using (lang, term) where s.n > 0 and s.p > u.q
), ranked as (
  select *, 'pair' as part from pairs union all by name select *, 'term' as part from terms
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from (select *, row_number() over (
  partition by lang, source, part order by value desc, item) as rank from ranked)
where part = 'pair' or rank <= 50
"""

MANIFEST_SQL = r"""
with recursive crc_table as (
  select list(v order by i) as t from (
    select i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from range(256) r(i))
), rows as (
  select *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered,
    coalesce('=' || source, '-') as tree,
    coalesce(octet_length(encode(cast(doc_id as varchar))) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
      || coalesce(octet_length(encode(cast(n_chars as varchar))) || ':' || n_chars, '-') as head,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
        regexp_extract_all(hex(encode(cast(doc_id as varchar))), '..'),
        lambda x: cast('0x' || x as bigint))),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 5 = 0 as tampered
  from documents, crc_table
), leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place
  from (
    select doc_id, tree, coalesce(tampered, false) as tampered,
      sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) as leaf,
      sha256(head || coalesce(octet_length(encode(lowered)) || ':' || lowered, '-')) as changed
    from rows)
), levels(tree, level, nodes) as (
  select tree, 0, list(leaf order by place) from leaves group by tree
  union all
  select tree, level + 1, list_transform(range((len(nodes) + 15) // 16),
    lambda i: sha256(array_to_string(nodes[i * 16 + 1 : i * 16 + 16], '')))
  from levels where len(nodes) > 1
), subroots as (
  select tree, nodes[1] as subroot, row_number() over (order by tree) - 1 as turn
  from levels where len(nodes) = 1
), tops(level, nodes) as (
  select 0, list(subroot order by turn) from subroots
  union all
  select level + 1, list_transform(range((len(nodes) + 15) // 16),
    lambda i: sha256(array_to_string(nodes[i * 16 + 1 : i * 16 + 16], '')))
  from tops where len(nodes) > 1
), steps as (
  select l.tree, l.place, v.level, v.nodes, l.place // cast(pow(16, v.level) as bigint) as own
  from leaves l join levels v on l.tree = v.tree and len(v.nodes) > 1
  union all
  select l.tree, l.place, 1000 + t.level, t.nodes, s.turn // cast(pow(16, t.level) as bigint)
  from leaves l join subroots s using (tree) join tops t on len(t.nodes) > 1
), paths as (
  select tree, place, list(step order by level) as path from (
    select tree, place, level,
      array_to_string(nodes[own // 16 * 16 + 1 : own], '') || '|'
        || array_to_string(nodes[own + 2 : own // 16 * 16 + 16], '') as step
    from steps)
  group by tree, place
), proofs as (
  select l.doc_id, l.leaf, s.subroot,
    (select nodes[1] from tops where len(nodes) = 1) as root,
    sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) as proof_sha256,
    list_reduce(list_prepend(case when tampered then changed else leaf end, coalesce(path, [])),
      lambda node, step: sha256(split_part(step, '|', 1) || node || split_part(step, '|', 2)))
      as folded_root
  from leaves l join subroots s using (tree) left join paths p using (tree, place)
)
select *, folded_root = root as verified from proofs
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": neighbours,
    "op2_token_files": token_files,
    "op3_token_counts": token_counts,
    "op4_decontaminate": decontaminate,
    "op5_url_rules": url_rules,
    "op6_shards": shards,
    "op7_near_copies": near,
    "op8_main_text": main_text,
    "op9_quality": quality,
    "op10_mix": mix,
    "op11_divergence": divergence,
    "op12_toxicity": toxicity,
    "op13_manifest": manifest,
    "pipeline": pipeline,
}
SQL: dict[str, str] = {
    "op4_decontaminate": DECONTAMINATE_SQL,
    "op5_url_rules": URL_SQL,
    "op6_shards": SHARDS_SQL,
    "op10_mix": MIX_SQL,
    "op11_divergence": DIVERGENCE_SQL,
    "op13_manifest": MANIFEST_SQL,
}
