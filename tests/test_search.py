import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from filelake.operators import ann, retrieve, text, vectors
from filelake.operators.embed import EmbedJob

DIM = 8


def points(spark, matrix, ids=None):
    rows = [((ids[n] if ids else n), [float(x) for x in v]) for n, v in enumerate(matrix)]
    kind = "string" if ids else "bigint"
    return spark.createDataFrame(rows, f"datapoint_id {kind}, feature_vector array<float>")


def asked(spark, matrix, k=5):
    rows = [(n, [float(x) for x in v], k + n % 2) for n, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "query_id bigint, vector array<double>, k bigint")


def ranked(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.datapoint_id, r.distance))
    return out


def brute(queries, vectors_, ids, k):
    out = {}
    for n, q in enumerate(queries):
        scores = np.round(np.float32(vectors_).astype(float) @ q, 6)
        order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))
        out[n] = [(ids[i], float(scores[i])) for i in order[: k + n % 2]]
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(700, DIM))
    # A third of all rows are copies of one vector.
    v[::3] = v[0]
    return np.float32(v), rng.normal(size=(9, DIM))


@pytest.mark.parametrize("max_sent", [4096, 4])
def test_topk_with_many_equal_vectors(spark, data, max_sent):
    v, q = data
    got = vectors.topk(asked(spark, q), points(spark, v).repartition(5), DIM, max_sent)
    assert ranked(got) == brute(q, v, list(range(len(v))), 5)


def test_topk_string_ids_and_bad_vectors(spark, data):
    v, q = data
    ids = [f"id{n % 97:03d}-{n}" for n in range(len(v))]
    bad = spark.sql("select 'zz' as datapoint_id, array(cast(1 as float)) as feature_vector union all "
                    "select 'yy', transform(sequence(1, 8), x -> cast('nan' as float))")
    got = vectors.topk(asked(spark, q), points(spark, v, ids).unionAll(bad), DIM)
    assert ranked(got) == brute(q, v, ids, 5)


def test_topk_smaller_than_k_and_without_queries(spark, data):
    v, q = data
    assert len(ranked(vectors.topk(asked(spark, q[:1]), points(spark, v[:3]), DIM))[0]) == 3
    assert vectors.topk(asked(spark, q).limit(0), points(spark, v), DIM).count() == 0


def test_ann_over_all_leaves_is_exact_and_partial_is_a_subset_of_leaves(spark, data, tmp_path):
    v, q = data
    index = ann.build(points(spark, v), DIM, leaf_size=100)
    assert len(index.centroids) == 7
    ann.write(index, str(tmp_path / "ivf"))
    index = ann.read(spark, str(tmp_path / "ivf"))
    truth = vectors.topk(asked(spark, q), points(spark, v), DIM)
    assert ranked(ann.search(asked(spark, q), index, probes=7)) == ranked(truth)
    near = ann.search(asked(spark, q), index, probes=3)
    share = ann.recall(near, truth).agg(F.avg("recall")).first()[0]
    assert 0.3 < share <= 1.0
    # The number of queries that can be sent at once changes nothing.
    assert ranked(ann.search(asked(spark, q), index, probes=3, max_sent=4)) == ranked(near)
    leaves = index.table.select("datapoint_id", "leaf")
    assert near.join(leaves, "datapoint_id").groupBy("query_id").agg(
        F.count_distinct("leaf").alias("n")).where("n > 3").count() == 0
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*leaf", plan)


def test_encoder_agrees_with_the_column_form_and_isolates_failures(spark):
    texts = [("a", "Été 2024: the the cat_dog"), ("b", "..."), ("c", "x" * 3)]
    df = spark.createDataFrame(texts, "file_id string, text string")
    native = {r.file_id: list(r.vector) for r in vectors.text_vectors(df, "file_id", "text", 16).collect()}

    def make():
        encode = vectors.hashing_encoder(16)

        def run(content):
            if content == b"xxx":
                raise OSError("unreadable")
            return encode(content)

        return run

    objects = df.select("file_id", F.lit("r").alias("rev"), F.encode("text", "UTF-8").alias("content"))
    rows = {r.file_id: r for r in vectors.encode_batch(objects, make, 16).collect()}
    assert rows["a"].feature_vector == pytest.approx(native["a"], abs=1e-6)
    assert "empty vector" in rows["b"].error and "unreadable" in rows["c"].error
    assert native["b"] == [0.0] * 16


def test_embed_plan_keeps_the_vector_of_an_outgrown_image(spark):
    images = spark.sql("select 'A' as file_id, 'r2' as rev, 20971521 as size union all select 'B', 'r1', 20971520")
    state = spark.sql("select 'A' as file_id, 'r1' as rev union all select 'C', 'r1'")
    plan = {r.file_id: r.action for r in vectors.embed_plan(images, state).collect()}
    assert plan == {"A": "skipped_size", "B": "embedded", "C": "removed"}


def test_embed_job_repeats_failures_and_removes_stale_vectors(spark, tmp_path):
    broken = tmp_path / "broken"
    broken.mkdir()

    def make():
        encode = vectors.hashing_encoder(16)

        def run(content):
            if content == b"bad" and (broken / "on").exists():
                raise OSError("unreadable")
            return encode(content)

        return run

    def counts(df):
        return {r.outcome: r.n for r in df.collect()}

    images = spark.createDataFrame([("A", "r1", 5), ("B", "r1", 5), ("C", "r1", 20971521), ("D", "r1", None)],
                                   "file_id string, rev string, size bigint")
    contents = spark.createDataFrame([("A", b"one"), ("B", b"bad"), ("C", b"big")], "file_id string, content binary")
    job = EmbedJob(spark, str(tmp_path / "job"), make, 16)
    (broken / "on").write_text("")
    assert counts(job.run(images, contents)) == {"embedded": 1, "errors": 2, "skipped": 1}
    assert [tuple(r) for r in job.state.read().collect()] == [("A", "r1")]
    (broken / "on").rename(broken / "off")
    assert counts(job.run(images, contents)) == {"embedded": 1, "errors": 1, "skipped": 2}
    assert counts(job.run(images.where("file_id <> 'A'"), contents)) == {"errors": 1, "skipped": 2, "removed": 1}
    points = job.points.read().collect()
    assert [(p.datapoint_id, p.restricts[0].allow_list) for p in points] == [("B", ["images"])]


def test_embedding_opens_pending_objects_only(spark, tmp_path):
    """Only the pending image has a file: opening any other one would be an error."""
    (tmp_path / "C.png").write_bytes(b"new picture")
    job = EmbedJob(spark, str(tmp_path / "job"), lambda: vectors.hashing_encoder(16), 16, compact_after=1)
    job.state.write(0, spark.createDataFrame([("A", "r1"), ("B", "r1")], "file_id string, rev string"), full=True)
    images = spark.createDataFrame([("A", "r1", 1), ("B", "r1", 1), ("C", "r1", 1)], "file_id string, rev string, size bigint")
    uris = images.select("file_id", F.concat(F.lit(f"{tmp_path}/"), "file_id", F.lit(".png")).alias("uri"))
    assert {r.outcome: r.n for r in job.run(images, uris).collect()} == {"embedded": 1, "skipped": 2}
    assert [p.datapoint_id for p in job.points.read().collect()] == ["C"]
    assert job.state.versions()[-1] == (1, True)


DOCS = [(1, "The cat sat on the mat."), (2, "the the the dog"), (3, "Cats and dogs"), (4, ""), (5, "ÉTÉ été 42"),
        (6, "a cat, a DOG; it's \"quoted\"")]
QUERIES = [(1, "the cat", 2), (2, "été", 5), (3, "zebra", 5), (4, "it's \"quoted\" '); drop", 5), (5, "", 5)]


def bm25(docs, query):
    toks = {d: re.findall(r"[^\W_]+", t.lower()) for d, t in docs}
    n, avg = len(docs), sum(map(len, toks.values())) / len(docs)
    scores = {}
    for term in set(re.findall(r"[^\W_]+", query.lower())):
        df = sum(term in t for t in toks.values())
        for d, t in toks.items():
            tf = Counter(t)[term]
            if tf:
                idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                scores[d] = scores.get(d, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / avg))
    return sorted(((round(-s, 6), d) for d, s in scores.items()))


def test_bm25(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    queries = spark.createDataFrame(QUERIES, "query_id bigint, text string, k bigint")
    scores = text.match(queries, docs)
    page = text.first_page(scores, queries)
    pages = sorted(map(tuple, page.select("query_id", "rank", "doc_id", "score").collect()))
    for most in (4096, 1):
        monkeypatch.setattr(text, "MAX_QUERIES", most)
        monkeypatch.setattr(text, "MAX_CELLS", 3 * most)
        direct = text.page(queries, docs).select("query_id", "rank", "doc_id", "score")
        assert sorted(map(tuple, direct.collect())) == pages
        assert sorted(map(tuple, text.matching(queries, docs).collect())) == sorted(map(tuple, text.totals(scores, queries).collect()))
    got = {}
    for r in page.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    want = {q: [(d, -s) for s, d in bm25(DOCS, t)][:k] for q, t, k in QUERIES}
    assert got == {q: hits for q, hits in want.items() if hits}
    totals = {r.query_id: r.total_size for r in text.totals(scores, queries).collect()}
    assert totals == {q: len(bm25(DOCS, t)) for q, t, _ in QUERIES}


def test_one_search_shuffles_scores_by_query_only(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    queries = spark.createDataFrame(QUERIES, "query_id bigint, text string, k bigint")
    plan = text.first_page(text.match(queries, docs), queries)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id" in plan and "WindowGroupLimit" in plan
    assert not re.search(r"hashpartitioning\(query_id#\d+L, doc_id", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_page_reads_the_texts_once_and_shuffles_the_best_only(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    queries = spark.createDataFrame(QUERIES, "query_id bigint, text string, k bigint")
    plan = text.page(queries, docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "WindowGroupLimit" in plan and "regexp_extract_all" not in plan
    assert "HashAggregate" not in plan and "Generate" not in plan


def test_index_upsert_equals_rebuild(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    changed = spark.createDataFrame([(2, "a new cat"), (9, "added")], "doc_id bigint, text string")
    merged = docs.join(changed, "doc_id", "left_anti").unionByName(changed)
    once = text.upsert_index(text.postings(docs), changed)
    cols = ["doc_id", "term", "tf", "dl"]
    want = sorted(tuple(r) for r in text.postings(merged).select(*cols).collect())
    assert sorted(tuple(r) for r in once.select(*cols).collect()) == want
    # A full re-import changes nothing.
    assert sorted(tuple(r) for r in text.upsert_index(once, merged).select(*cols).collect()) == want


def test_combined_keeps_empty_lists(spark):
    queries = spark.createDataFrame(QUERIES, "query_id bigint, text string, k bigint")
    images = spark.sql("select 1L as query_id, 2 as rank, 7L as datapoint_id, 0.5D as distance union all select 1L, 1, 8L, 0.6D")
    hits = spark.sql("select 2L as query_id, 1 as rank, 5L as doc_id, cast(null as string) as title, 'l' as link, 's' as snippet")
    rows = {r.query_id: r for r in retrieve.combined(queries, images, hits).collect()}
    assert [m.file_id for m in rows[1].image_matches] == ["8", "7"] and rows[1].document_matches == []
    assert rows[2].document_matches[0].title == "" and rows[3].image_matches == []
    assert rows[4]["query"] == QUERIES[3][1]


def test_flattening_of_partial_answers(spark):
    bodies = [(1, '{"nearestNeighbors":[]}'), (2, "{}"), (3, '{"nearestNeighbors":[{"neighbors":[{}]}]}'), (4, "not json")]
    df = spark.createDataFrame(bodies, "query_id bigint, body string")
    assert [tuple(r) for r in retrieve.flatten_neighbors(df).collect()] == [(3, 1, "", 0.0)]
    body = '{"results":[{"document":{"id":"d1","derivedStructData":{"snippets":[]}}},{}]}'
    one = spark.createDataFrame([(1, body)], "query_id bigint, body string")
    assert [tuple(r) for r in retrieve.flatten_results(one, title_from_id=True).collect()] == [
        (1, 1, "d1", "d1", "", "", 0), (1, 2, "", "", "", "", 0)
    ]
