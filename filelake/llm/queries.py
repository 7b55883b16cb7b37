"""The registered queries of the operators, with the SQL that checks them where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelake.llm import (
    cover_tree, html_extract, itq, line_dedup, mixing, packing, pii, presence, simhash, substring_dedup, toxicity, url_filter, whitening,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# Fixed values of the checks.
URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]
FOLDS = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed_lines", F.lit(0), lambda n, x: n + x.e - x.s + 1)
    return found.select("doc_id", "text", F.coalesce(removed, F.lit(0)).alias("n_removed"))


# All runs written out: the text of every shortest run of enough words, its copies found by comparing texts.
OP1_SQL = r"""
with physical as (
  select doc_id, p, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as t from (
    select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as p
    from (select doc_id, string_split(text, chr(10)) as lines from documents))
), owned as (
  select *, cast(sum((t <> '')::int) over (partition by doc_id order by p) as bigint) as i from physical
), lines as (
  select doc_id, i, t, length(t) - length(replace(t, ' ', '')) + 1 as words from owned where t <> ''
), places as (
  select *, sum(words) over (partition by doc_id order by i) as end_,
    sum(words) over (partition by doc_id) as total from lines
), lists as (
  select doc_id, list(t order by i) as ts from lines group by doc_id
), sized as (
  select *, end_ - words as start_,
    count(*) over (partition by doc_id order by end_ - words range between 1 following and 49 following) + 1 as ahead,
    count(*) over (partition by doc_id order by end_ range between 49 preceding and 1 preceding) + 1 as back
  from places
), runs as (
  select doc_id, i as s, ahead as h from sized where total - start_ >= 50
  union select doc_id, i - back + 1 as s, back as h from sized where end_ >= 50
), copies as (
  select r.doc_id, r.s, r.h, row_number() over (
    partition by list_slice(l.ts, r.s, r.s + r.h - 1) order by r.doc_id, r.s) as n
  from runs r join lists l using (doc_id)
), gone as (
  select distinct doc_id, unnest(range(s, s + h)) as i from copies where n > 1
), kept as (
  select o.doc_id, string_agg(o.line, chr(10) order by o.p) filter (where g.i is null) as text,
    count(distinct g.i) as n_removed
  from owned o left join gone g using (doc_id, i) group by o.doc_id
)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
  cast(coalesce(k.n_removed, 0) as int) as n_removed
from documents d left join kept k using (doc_id)
"""


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(_table(spark, sf_dir, "embeddings"))


# Production parameters of the mixture: small sources at most four times, entropy near that of equal sources.
MIX_ENTROPY = 0.98
MIX_REPETITION = 4.0


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), target_entropy=MIX_ENTROPY, max_repetition=MIX_REPETITION)
    return mixed.select("doc_id", "source", "pass", "place")


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _table(spark, sf_dir, "embeddings").select("vec_id", cover_tree.scaled(F.col("embedding")).alias("v"))
    points = points.filter("v is not null and vec_id is not null")
    queries = points.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return cover_tree.top_k(points, queries, 5)


OP5_SQL = """
with points as (
  select vec_id, [floor(256 * x::double) for x in embedding] as v from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select q.vec_id as query_id, p.vec_id, cast(list_dot_product(q.v, p.v) as bigint) as score
  from points q join points p on q.vec_id <> p.vec_id where q.vec_id % 50 = 0
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


def op6_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


# Stands for a key from the user's own store of secrets.
PSEUDONYM_KEY = "a key that only the owner of the data knows"


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = pii.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)
    return renamed.select("doc_id", "text", F.size("pseudonyms").alias("n_pseudonyms"), "pseudonyms")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = """
with parts as (
  select page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), rules as (
  select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
    ('org', '/fr/', 'allow')) as r(rule_host, rule_path, verdict)
), fits as (
  select p.page_id, p.host, p.path, r.rule_host || r.rule_path as rule, r.verdict,
    row_number() over (partition by p.page_id, p.host, p.path order by length(rule_host) desc, length(rule_path) desc) as n
  from parts p left join rules r
    on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where n = 1
"""


def fold(id_col: str = "doc_id"):
    """Number of the fold of an id; fold 0 is held out."""
    return F.crc32(F.col(id_col).cast("string")) % FOLDS


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").filter(fold() != 0)
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted", "sentences")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components_long(_table(spark, sf_dir, "embeddings"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


# Every window written out as its text.
OP12_SQL = r"""
with parts as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), windows as (
  select r, p, array_to_string(list_slice(ws, p, p + 34), ' ') as w
  from (select r, ws, unnest(generate_series(1, len(ws) - 34)) as p from parts)
), repeated as (
  select r, p from (select r, p, count(*) over (partition by w) as n from windows) where n > 1
), gone as (
  select distinct r, unnest(generate_series(p, p + 34)) as p from repeated
), words as (
  select r, unnest(ws) as word, generate_subscripts(ws, 1) as p from parts
), kept as (
  select w.r, string_agg(w.word, ' ' order by w.p) as text, count(*) as n
  from words w left join gone g using (r, p) where g.p is null group by w.r
)
select d.doc_id, cast(len(d.ws) as bigint) as n_words, cast(len(d.ws) - coalesce(k.n, 0) as bigint) as n_removed,
  sha256(coalesce(k.text, '')) as kept_sha256
from parts d left join kept k using (r)
"""


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presence.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 20)


OP13_SQL = r"""
with terms as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from documents
), asked as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark
), lengths as (
  select doc_id, count(*) as n from terms group by doc_id
), totals as (
  select count(*) as nn, cast(sum(n) as bigint) as ll from lengths
), counted as (
  select doc_id, t, count(*) as tf from terms group by doc_id, t
), weights as (
  select t, cast(floor(1000 * ln((2 * any_value(nn) + 2)::double / (2 * count(*) + 1))) as bigint) as w from counted, totals group by t
), gains as (
  select c.doc_id, c.t, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))) as gain
  from counted c join weights using (t) join lengths using (doc_id), totals
), scored as (
  select item_id, doc_id, cast(sum(gain) as bigint) as score from asked join gains using (t) group by item_id, doc_id
), ranked as (
  select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_html_extract": op2_html_extract,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_mix_sources": op4_mix_sources,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_pack_sequences": op6_pack_sequences,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_pseudonyms": op8_pseudonyms,
    "op9_url_filter": op9_url_filter,
    "op10_toxicity": op10_toxicity,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_ranked_search": op13_ranked_search,
}
ORACLES = {
    "op1_line_dedup": OP1_SQL, "op5_exact_top_k": OP5_SQL, "op9_url_filter": OP9_SQL, "op12_substring_dedup": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}
