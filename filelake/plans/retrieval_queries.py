"""Queries over vectors, the text index, imports and combined retrieval."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from filelake import constants as C
from filelake.functions import text as X
from filelake.operators import ann, imports, leaf_tree, retrieve, text, vectors
from filelake.operators.embed import EmbedJob
from filelake.operators.index import IndexJob
from filelake.plans import inputs as I
from filelake.plans.registry import query
from filelake.session import new_folder, stage


def _rank(df):
    return df.withColumn("rank", F.col("rank").cast("bigint"))


# --- queries and vectors -----------------------------------------------------------------------


@query("query_batch", "select query_id, text, k from queries")
def query_batch(spark, sf):
    return I.queries(spark, sf)


@query("encode_text", "select query_id, bucket, round(weight, 6) as weight from query_weights")
def encode_text(spark, sf):
    w = vectors.text_weights(I.queries(spark, sf), "query_id", "text", I.DIM)
    return w.select("query_id", "bucket", F.round("weight", 6).alias("weight"))


@query("encode_batch", f"""
select cast(doc_id as varchar) as file_id, bucket, round(n / sqrt(sum(n * n) over (partition by doc_id)), 4) as weight
from (select doc_id, cast('0x' || substr(md5(term), 1, 8) as bigint) % {I.DIM} as bucket, cast(count(*) as double) as n
  from doc_terms group by all)""")
def encode_batch(spark, sf):
    contents = I.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("file_id"), F.lit("r0").alias("rev"),
        F.encode("text", "UTF-8").alias("content"),
    )
    dim = I.DIM
    done = vectors.encode_batch(contents, lambda: vectors.hashing_encoder(dim), dim)
    cells = done.where(F.col("error").isNull()).select("file_id", F.posexplode("feature_vector").alias("bucket", "w"))
    return cells.where(F.col("w") != 0).select(
        "file_id", F.col("bucket").cast("bigint").alias("bucket"),
        F.round(F.col("w").cast("double"), 4).alias("weight"),
    )


@query("vector_valid", f"""
select vec_id as datapoint_id, len(embedding) as n from embeddings
where len(embedding) = {I.DIM} and len(list_filter(embedding, lambda x: x is null or isnan(x))) = 0""")
def vector_valid(spark, sf):
    d = I.datapoints(spark, sf).where(vectors.valid_vector(F.col("feature_vector"), I.DIM))
    return d.select("datapoint_id", F.size("feature_vector").cast("bigint").alias("n"))


def _tagged(spark, sf):
    """Datapoints with their tag: the label decides the category."""
    tag = F.when(F.col("label") % 2 == 0, "images").otherwise("docs")
    restricts = F.array(F.struct(F.lit("category").alias("namespace"), F.array(tag).alias("allow_list")))
    return I.datapoints(spark, sf).withColumn("restricts", restricts)


@query("datapoint_restricts", """
select vec_id as datapoint_id, 'category' as namespace, 'images' as token from embeddings""")
def datapoint_restricts(spark, sf):
    d = I.datapoints(spark, sf).withColumn("restricts", vectors.category_restrict())
    return d.select("datapoint_id", F.inline("restricts")).select(
        "datapoint_id", "namespace", F.explode("allow_list").alias("token")
    )


@query("vector_topk", "select query_id, datapoint_id, distance, rank from neighbors")
def vector_topk(spark, sf):
    return _rank(vectors.topk(I.query_vectors(spark, sf), I.datapoints(spark, sf), I.DIM))


@query("vector_topk_blocks", "select query_id, datapoint_id, distance, rank from neighbors")
def vector_topk_blocks(spark, sf):
    """The same answer by the block grid that serves query sets too large to send."""
    return _rank(vectors.topk(I.query_vectors(spark, sf), I.datapoints(spark, sf), I.DIM, max_sent=16))


@query("restricted_topk", f"""
select query_id, datapoint_id, distance, rank from (
  select *, row_number() over (partition by query_id order by distance desc, datapoint_id) as rank from (
    select query_id, vec_id as datapoint_id, round(sum(weight * x), {C.SCORE_DIGITS}) + 0.0 as distance
    from query_weights join components using (bucket)
    where vec_id in (select vec_id from embeddings where label % 2 = 0) group by all))
where rank <= {C.COMBINED_TOP_K}""")
def restricted_topk(spark, sf):
    allowed = _tagged(spark, sf).where(vectors.allows(F.col("restricts"), "category", "images"))
    return _rank(vectors.topk(I.query_vectors(spark, sf), allowed, I.DIM))


@query("vector_ann")
def vector_ann(spark, sf):
    """Leaves of about 100 vectors, so that also small tables have several; a tenth is searched."""
    index = ann.build(I.datapoints(spark, sf), I.DIM, leaf_size=100)
    return _rank(ann.search(I.query_vectors(spark, sf), index))


@query("vector_ann_all_leaves", "select query_id, datapoint_id, distance, rank from neighbors")
def vector_ann_all_leaves(spark, sf):
    """Searching all leaves must give the exact answer."""
    index = ann.build(I.datapoints(spark, sf), I.DIM, leaf_size=100)
    return _rank(ann.search(I.query_vectors(spark, sf), index, probes=len(index.centroids)))


def _stored_tree(spark, sf):
    """Leaves of about 50 vectors in groups, written and read again."""
    path = new_folder(spark, "leaf-tree")
    leaf_tree.write(leaf_tree.build(I.datapoints(spark, sf), I.DIM, leaf_size=50), path)
    return leaf_tree.read(spark, path, I.DIM)


@query("vector_tree")
def vector_tree(spark, sf):
    """Search of a stored tree of two levels; a tenth of its leaves is searched."""
    return _rank(leaf_tree.search(I.query_vectors(spark, sf), _stored_tree(spark, sf)))


@query("vector_tree_members", "select vec_id as datapoint_id, cast(1 as bigint) as n from embeddings")
def vector_tree_members(spark, sf):
    """Every vector is in one leaf, and that leaf has a centroid."""
    tree = _stored_tree(spark, sf)
    return tree.table.join(tree.leaves, ["group", "leaf"]).groupBy("datapoint_id").agg(F.count(F.lit(1)).alias("n"))


@query("vector_tree_all_leaves", "select query_id, datapoint_id, distance, rank from neighbors")
def vector_tree_all_leaves(spark, sf):
    """Pairs of all leaves and queries must give the exact answer; a fraction just below 1 takes the way by leaves."""
    return _rank(leaf_tree.search(I.query_vectors(spark, sf), _stored_tree(spark, sf), fraction=1 - 1e-9))


@query("vector_ann_blocks", "select query_id, cast(0 as bigint) as differing from queries")
def vector_ann_blocks(spark, sf):
    """Queries sent 16 at a time get the answers of queries sent all at once: pairs that only one has."""
    index = ann.build(I.datapoints(spark, sf), I.DIM, leaf_size=100)
    asked, pair = I.query_vectors(spark, sf), ["query_id", "datapoint_id", "rank"]
    few, all_ = (
        ann.search(asked, index, max_sent=n).select(*pair, F.lit(sign).alias("sign")) for n, sign in ((16, 1), (4096, -1))
    )
    odd = few.unionAll(all_).groupBy(*pair).agg(F.sum("sign").alias("sum")).where(F.col("sum") != 0)
    odd = odd.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    return I.queries(spark, sf).join(odd, "query_id", "left").select("query_id", F.coalesce("n", F.lit(0)).alias("differing"))


@query("embed_plan", f"""
select coalesce(i.file_id, s.file_id) as file_id, coalesce(i.rev, s.rev) as rev, case
  when i.file_id is null then 'removed' when i.rev = s.rev then 'skipped'
  when i.size > {C.MAX_IMAGE_BYTES} then 'skipped_size' else 'embedded' end as action
from images i full join emb_state s on i.file_id = s.file_id""")
def embed_plan(spark, sf):
    return vectors.embed_plan(I.images(spark, sf), I.emb_state(spark, sf))


@query("embed_outcomes", f"""
select case when i.file_id is null then 'removed' when i.rev = s.rev then 'skipped'
  when i.size > {C.MAX_IMAGE_BYTES} then 'skipped' else 'embedded' end as outcome, count(*) as n
from images i full join emb_state s on i.file_id = s.file_id group by 1""")
def embed_outcomes(spark, sf):
    plan = vectors.embed_plan(I.images(spark, sf), I.emb_state(spark, sf))
    outcome = F.when(F.col("action") == "skipped_size", "skipped").otherwise(F.col("action"))
    return plan.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def _embed_job(spark, sf):
    """Run over the images with the documents as their contents; an eighth of them, by digest, cannot be read."""
    dim = I.DIM

    def make():
        encode = vectors.hashing_encoder(dim)

        def run(content):
            if hashlib.md5(content).hexdigest()[0] in "01":
                raise OSError("unreadable")
            return encode(content)

        return run

    job = EmbedJob(spark, new_folder(spark, "embed"), make, dim)
    text_id = F.col("file_id").cast("string").alias("file_id")
    job.state.write(0, I.emb_state(spark, sf).select(text_id, "rev"), full=True)
    contents = I.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("file_id"), F.encode("text", "UTF-8").alias("content")
    )
    return job, job.run(I.images(spark, sf).select(text_id, "rev", "size"), contents)


_EMBED_JOB = f"""(select coalesce(i.file_id, s.file_id) as file_id, i.rev as new_rev, s.rev as old_rev, case
  when i.file_id is null then 'removed' when i.rev = s.rev or i.size > {C.MAX_IMAGE_BYTES} then 'skipped'
  when substr(md5(d.text), 1, 1) > '1' then 'embedded' else 'errors' end as outcome
from images i full join emb_state s on i.file_id = s.file_id left join documents d on i.file_id = d.doc_id)"""


@query("embed_job", f"select outcome, count(*) as n from {_EMBED_JOB} j group by outcome")
def embed_job(spark, sf):
    return _embed_job(spark, sf)[1]


@query("embed_job_state", f"""
select cast(file_id as varchar) as file_id, case when outcome = 'embedded' then new_rev else old_rev end as rev
from {_EMBED_JOB} j where outcome = 'embedded' or outcome <> 'removed' and old_rev is not null""")
def embed_job_state(spark, sf):
    return _embed_job(spark, sf)[0].state.read()


@query("embed_pending", """
select file_id, rev from images i where not exists (
  select 1 from emb_state s where s.file_id = i.file_id and s.rev = i.rev)""")
def embed_pending(spark, sf):
    return vectors.pending(I.images(spark, sf), I.emb_state(spark, sf)).select("file_id", "rev")


@query("embed_stale", "select file_id, rev from emb_state where file_id not in (select file_id from images)")
def embed_stale(spark, sf):
    return vectors.stale(I.emb_state(spark, sf), I.images(spark, sf))


def _new_points(spark, sf):
    """New vectors for the labelled ids: the hashed text of the document of that id."""
    known = I.table(spark, sf, "labels").select("doc_id").distinct()
    texts = I.docs(spark, sf).join(known, "doc_id", "left_semi").select("doc_id", "text")
    v = vectors.text_vectors(texts, "doc_id", "text", I.DIM)
    return v.select(F.col("doc_id").alias("datapoint_id"), F.col("vector").cast("array<float>").alias("feature_vector"))


@query("vector_upsert", f"""
with cells as (select doc_id, bucket, n / sqrt(sum(n * n) over (partition by doc_id)) as weight from (
    select doc_id, cast('0x' || substr(md5(term), 1, 8) as bigint) % {I.DIM} as bucket, cast(count(*) as double) as n
    from doc_terms where doc_id in (select doc_id from labels) group by all)),
  points as (select vec_id as datapoint_id, bucket, x from components where vec_id not in (select doc_id from labels)
    union all select doc_id, bucket, weight from cells)
select datapoint_id, bucket, round(x, 4) as x from points where x <> 0""")
def vector_upsert(spark, sf):
    old = I.datapoints(spark, sf).select("datapoint_id", "feature_vector")
    merged = vectors.upsert(old, _new_points(spark, sf))
    cells = merged.select("datapoint_id", F.posexplode("feature_vector").alias("bucket", "x"))
    return cells.where(F.col("x") != 0).select(
        "datapoint_id", F.col("bucket").cast("bigint").alias("bucket"), F.round(F.col("x").cast("double"), 4).alias("x")
    )


@query("vector_remove", "select vec_id as datapoint_id, label from embeddings where vec_id not in (select doc_id from labels)")
def vector_remove(spark, sf):
    gone = I.table(spark, sf, "labels").select(F.col("doc_id").alias("datapoint_id"))
    return vectors.remove(I.datapoints(spark, sf), gone).select("datapoint_id", "label")


# --- text --------------------------------------------------------------------------------------


@query("tokenize", """
select s.doc_id, cast(s.dl as bigint) as n_tokens, count(distinct t.term) as n_terms
from doc_stats s left join doc_terms t on s.doc_id = t.doc_id group by all""")
def tokenize(spark, sf):
    t = text.tokenized(I.docs(spark, sf))
    return t.select("doc_id", F.col("dl").alias("n_tokens"), F.size(F.array_distinct("toks")).cast("bigint").alias("n_terms"))


@query("postings", "select term, doc_id, tf, cast(dl as bigint) as dl from postings")
def postings(spark, sf):
    return text.postings(I.docs(spark, sf))


@query("bm25_topk", "select query_id, doc_id, score, rank from page")
def bm25_topk(spark, sf):
    q = I.queries(spark, sf)
    return _rank(text.page(q, I.docs(spark, sf)))


@query("bm25_index", "select query_id, doc_id, score, rank from page")
def bm25_index(spark, sf):
    """The same search over a stored index instead of the texts."""
    index = IndexJob(spark, new_folder(spark, "index"))
    index.run(I.docs(spark, sf))
    return _rank(index.page(I.queries(spark, sf)))


def _imported(spark, sf):
    """Index after three imports: titles in place of all texts, with pages that leave again; then the
    labelled documents; then all others."""
    docs = I.docs(spark, sf)
    labelled = I.table(spark, sf, "labels").select("doc_id").distinct()
    pages = I.table(spark, sf, "pages").select((-1 - F.col("page_id")).alias("doc_id"), F.col("html").alias("text"))
    index = IndexJob(spark, new_folder(spark, "index"))
    index.run(docs.select("doc_id", F.col("title").alias("text")).unionByName(pages))
    index.run(docs.join(labelled, "doc_id", "left_semi"), pages)
    index.run(docs.join(labelled, "doc_id", "left_anti"))
    return index


@query("index_job", "select query_id, doc_id, score, rank from page")
def index_job(spark, sf):
    """An index kept over imports answers as one built from the final documents."""
    return _rank(_imported(spark, sf).page(I.queries(spark, sf)))


@query("index_total", """
select query_id, count(doc_id) as total_size from queries left join scored using (query_id) group by query_id""")
def index_total(spark, sf):
    return _imported(spark, sf).matching(I.queries(spark, sf))


@query("index_combined", """
select query_id, rank, doc_id, title, link, snippet from page join docs using (doc_id) join snippets using (query_id, doc_id)""")
def index_combined(spark, sf):
    """Ranked results with title, link and snippet, found in the stored index."""
    hits = retrieve.document_page(I.queries(spark, sf), I.docs(spark, sf), _imported(spark, sf))
    return _rank(hits).select("query_id", "rank", "doc_id", "title", "link", "snippet")


@query("search_total", """
select query_id, count(doc_id) as total_size from queries left join scored using (query_id) group by query_id""")
def search_total(spark, sf):
    q = I.queries(spark, sf)
    return text.matching(q, I.docs(spark, sf))


def _hits(spark, sf):
    return retrieve.document_page(I.queries(spark, sf), I.docs(spark, sf))


@query("snippets", "select query_id, doc_id, snippet from snippets")
def snippets(spark, sf):
    return _hits(spark, sf).select("query_id", "doc_id", "snippet")


@query("ranked_results", """
select query_id, rank, doc_id, title, link, snippet from page join docs using (doc_id) join snippets using (query_id, doc_id)""")
def ranked_results(spark, sf):
    return _rank(_hits(spark, sf)).select("query_id", "rank", "doc_id", "title", "link", "snippet")


@query("titles_links", r"""
select page_id, coalesce(nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), ''),
  cast(page_id as varchar)) as title, url as link from pages""")
def titles_links(spark, sf):
    p = I.table(spark, sf, "pages")
    return p.select(
        "page_id", F.coalesce(X.html_title(F.col("html")), F.col("page_id").cast("string")).alias("title"),
        F.col("url").alias("link"),
    )


@query("index_upsert", r"""
with changed as (select doc_id, string_agg(p.html, ' ') as text from labels join pages p on labels.doc_id = p.page_id group by doc_id),
  fresh as (select doc_id, len(toks) as dl, unnest(toks) as term from (
    select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as toks from changed))
select term, doc_id, tf, cast(dl as bigint) as dl from postings where doc_id not in (select doc_id from changed)
union all select term, doc_id, count(*), cast(dl as bigint) from fresh group by term, doc_id, dl""")
def index_upsert(spark, sf):
    """Labelled documents that have a page take the page's source as their new text."""
    known = I.table(spark, sf, "labels").select("doc_id").distinct()
    pages = I.table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    changed = pages.join(known, "doc_id", "left_semi")
    return text.upsert_index(text.postings(I.docs(spark, sf)), changed).select("term", "doc_id", "tf", "dl")


# --- imports -----------------------------------------------------------------------------------


@query("import_manifest", r"""
select id, mime_type, uri, '{"id":"' || id || '","content":{"mimeType":"' || mime_type || '","uri":"' || uri || '"}}' as line
from (select regexp_extract(split_part(uri, '/', -1), '(?s)\A(.*?[^./][^/]*)(\.[^./]*)\z', 1) as id,
  coalesce(mime, 'application/octet-stream') as mime_type, uri
  from doc_uris left join ext_dim on lower(regexp_extract(uri, '(\.[^./]*)$', 1)) = ext)""")
def import_manifest(spark, sf):
    return imports.manifest(I.doc_uris(spark, sf))


@query("import_batches", f"""
select cast((row_number() over (order by uri) - 1) // {C.IMPORT_BATCH} as bigint) as batch_id, uri, 'INCREMENTAL' as mode,
  cast((row_number() over (order by uri) - 1) % {C.IMPORT_BATCH} + 1 as bigint) as place from doc_uris""")
def import_batches(spark, sf):
    b = imports.batches(I.doc_uris(spark, sf))
    return b.select("batch_id", F.posexplode("uris").alias("p", "uri"), "mode").select(
        "batch_id", "uri", "mode", (F.col("p") + 1).cast("bigint").alias("place")
    )


@query("import_result", "select op_id, cast(success as bigint) as success, cast(failed as bigint) as failed from import_counts")
def import_result(spark, sf):
    return imports.normalize(I.import_results(spark, sf))


@query("import_totals", """
select cast(sum(success) as bigint) as success, cast(sum(failed) as bigint) as failed from import_counts""")
def import_totals(spark, sf):
    return imports.import_totals(imports.normalize(I.import_results(spark, sf)))


# --- combined retrieval ------------------------------------------------------------------------


@query("combined_search")
def combined_search(spark, sf):
    """Flagship: nearest images and best documents of every query in one row."""
    return retrieve.search(I.queries(spark, sf), I.docs(spark, sf), I.datapoints(spark, sf), I.DIM)


@query("combined_flat", """
select query_id, 'image' as side, rank, cast(datapoint_id as varchar) as id, distance, '' as title, '' as link, '' as snippet
from neighbors
union all
select query_id, 'document', rank, cast(doc_id as varchar), 0.0, title, link, snippet
from page join docs using (doc_id) join snippets using (query_id, doc_id)""")
def combined_flat(spark, sf):
    r = stage(combined_search(spark, sf), "combined")
    none = F.lit("")
    images = r.select("query_id", F.posexplode("image_matches").alias("p", "m")).select(
        "query_id", F.lit("image").alias("side"), (F.col("p") + 1).cast("bigint").alias("rank"),
        F.col("m.file_id").alias("id"), "m.distance", none.alias("title"), none.alias("link"), none.alias("snippet"),
    )
    found = r.select("query_id", F.posexplode("document_matches").alias("p", "m")).select(
        "query_id", F.lit("document").alias("side"), (F.col("p") + 1).cast("bigint").alias("rank"),
        F.col("m.document_id").alias("id"), F.lit(0.0).alias("distance"), "m.title", "m.link", "m.snippet",
    )
    return images.unionAll(found)


@query("combined_json")
def combined_json(spark, sf):
    return retrieve.as_json(combined_search(spark, sf))


# --- flattening of nested answers --------------------------------------------------------------

_NEIGHBOR_ROWS = """
select event_id as query_id, cast(1 as bigint) as rank, cast(user_id as varchar) as file_id, value as distance
from events where event_type in ('click', 'signup')
union all select event_id, 2, '', value from events where event_type = 'click'
union all select event_id, 2, cast(user_id + 1 as varchar), 0.0 from events where event_type = 'signup'"""


@query("flatten_neighbors", _NEIGHBOR_ROWS)
def flatten_neighbors(spark, sf):
    """Answers made from the events: full, without an id, without a distance, with empty lists."""
    e = I.table(spark, sf, "events")
    full = F.format_string(
        '{"datapoint":{"datapointId":"%s"},"distance":%s}', F.col("user_id").cast("string"), F.col("value").cast("string")
    )
    bare = F.concat(F.lit('{"distance":'), F.col("value").cast("string"), F.lit("}"))
    undated = F.concat(F.lit('{"datapoint":{"datapointId":"'), (F.col("user_id") + 1).cast("string"), F.lit('"}}'))

    def answer(*cells):
        listed = F.concat_ws(",", *cells)
        return F.concat(F.lit('{"nearestNeighbors":[{"neighbors":['), listed, F.lit(']},{"neighbors":['), bare, F.lit("]}]}"))

    body = (
        F.when(F.col("event_type") == "click", answer(full, bare))
        .when(F.col("event_type") == "signup", answer(full, undated))
        .when(F.col("event_type") == "view", '{"nearestNeighbors":[]}')
        .when(F.col("event_type") == "purchase", '{"nearestNeighbors":[{}]}')
        .otherwise("{}")
    )
    return retrieve.flatten_neighbors(e.select(F.col("event_id").alias("query_id"), body.alias("body")))


@query("flatten_results", """
select d.doc_id as query_id, cast(1 as bigint) as rank, cast(d.doc_id as varchar) as document_id,
  case when d.lang = 'en' then d.source else '' end as title, case when d.lang <> 'fr' then 'l' || d.doc_id else '' end as link,
  case when l.quality = 1 then d.text else '' end as snippet, d.n_chars as total_size
from documents d left join labels l on d.doc_id = l.doc_id where d.lang <> 'de'""")
def flatten_results(spark, sf):
    """Answers made from the documents, whose fields are missing by language and label."""
    d = I.table(spark, sf, "documents").join(I.table(spark, sf, "labels"), "doc_id", "left")
    snippet = F.when(F.col("quality") == 1, F.array(F.struct(F.col("text").alias("snippet"))))
    derived = F.struct(
        F.when(F.col("lang") == "en", F.col("source")).alias("title"),
        F.when(F.col("lang") != "fr", F.concat(F.lit("l"), F.col("doc_id").cast("string"))).alias("link"),
        snippet.alias("snippets"),
    )
    document = F.struct(F.col("doc_id").cast("string").alias("id"), derived.alias("derivedStructData"))
    results = F.when(F.col("lang") != "de", F.array(F.struct(document.alias("document"))))
    body = F.to_json(F.struct(results.alias("results"), F.col("n_chars").alias("totalSize")))
    return retrieve.flatten_results(d.select(F.col("doc_id").alias("query_id"), body.alias("body")))
