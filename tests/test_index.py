import random
import re

import pytest
from pyspark.sql import functions as F
from test_search import DOCS, QUERIES, bm25

from filelake import session
from filelake.functions import text as X
from filelake.operators import index as stored
from filelake.operators import retrieve, text
from filelake.operators.index import IndexJob

DOC = "doc_id bigint, text string"


@pytest.fixture()
def job(spark, tmp_path):
    return IndexJob(spark, str(tmp_path / "index"), block_docs=4)


def queries(spark, rows=QUERIES):
    return spark.createDataFrame(rows, "query_id bigint, text string, k bigint")


def found(page):
    out = {}
    for r in page.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.doc_id, r.score))
    return out


def wanted(docs, asked=QUERIES):
    want = {q: [(d, -s) for s, d in bm25(docs, t)][:k] for q, t, k in asked}
    return {q: hits for q, hits in want.items() if hits}


def holds(job, docs, asked=QUERIES):
    """The index answers as the documents themselves do."""
    q = queries(job.spark, asked)
    assert found(job.page(q)) == wanted(docs, asked)
    assert {r.query_id: r.total_size for r in job.matching(q).collect()} == {i: len(bm25(docs, t)) for i, t, _ in asked}
    assert sum(s.n_docs - s.n_gone for s in job.segments()) == len(docs)
    words = sum(len(re.findall(r"[^\W_]+", t)) for _, t in docs)
    assert sum(s.sum_dl - s.gone_dl for s in job.segments()) == words


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    return [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(60)], k=rng.randrange(0, 40)))) for i in range(n)]


ASKED = [(1, "w0 w1", 3), (2, "w7 w30 w55", 5), (3, "none", 4), (4, "w59", 2), (5, "", 3)]


def test_empty_index(spark, job):
    assert job.page(queries(spark)).count() == 0
    assert {r.total_size for r in job.matching(queries(spark)).collect()} == {0}
    job.run(spark.createDataFrame([], DOC))
    assert job.segments() == [] and job.page(queries(spark)).count() == 0
    job.run(spark.createDataFrame(DOCS, DOC))
    assert job.page(queries(spark, [])).count() == 0


def test_imports_replace_and_remove(spark, job):
    job.run(spark.createDataFrame([(1, "zebra"), (2, "the zebra"), (3, "Cats and dogs"), (8, "gone cat")], DOC))
    job.run(spark.createDataFrame([d for d in DOCS if d[0] != 3], DOC))
    job.run(spark.createDataFrame([(7, None), (None, "the cat")], DOC), spark.createDataFrame([(8,), (99,)], "doc_id bigint"))
    holds(job, DOCS + [(7, "")])
    # What is repeated replaces itself; a document that is removed and brought is stored.
    job.run(spark.createDataFrame(DOCS, DOC), spark.createDataFrame([(1,), (7,)], "doc_id bigint"))
    holds(job, DOCS)
    # Everything goes.
    job.run(spark.createDataFrame([], DOC), spark.createDataFrame([(d,) for d, _ in DOCS], "doc_id bigint"))
    assert job.segments() == [] and job.page(queries(spark)).count() == 0


def test_longest_of_repeated_rows_counts(spark, job):
    job.run(spark.createDataFrame([(1, "cat"), (1, "the cat sat"), (1, "the cat sat"), (2, "dog")], "doc_id bigint, text string"))
    holds(job, [(1, "the cat sat"), (2, "dog")])


def test_many_imports_keep_few_segments(spark, job, monkeypatch):
    monkeypatch.setattr(stored, "GONE_VERSIONS", 3)
    docs = dict(corpus(90))
    job.run(spark.createDataFrame(sorted(docs.items()), DOC))
    for n in range(4):
        new = {i: t for i, t in corpus(100, seed=n + 2) if i % 17 == n or i >= 98}
        docs.update(new)
        job.run(spark.createDataFrame(sorted(new.items()), DOC))
        assert len(job.segments()) <= 3
    holds(job, sorted(docs.items()), ASKED)


def test_import_that_broke_off_is_repeated(spark, job, monkeypatch):
    job.run(spark.createDataFrame(DOCS[:3], DOC))
    with monkeypatch.context() as m:
        m.setattr(IndexJob, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            job.run(spark.createDataFrame([(1, "other"), (5, "half")], DOC))
    holds(job, DOCS[:3])
    job.run(spark.createDataFrame(DOCS[3:], DOC))
    holds(job, DOCS)


def test_blocks_below_the_kth_score_are_skipped(spark, tmp_path, monkeypatch):
    # The rare word stands often in short documents, once in long ones.
    docs = [(i, "rare rare rare" if i < 4 else "rare " + "common " * (10 + i // 4)) for i in range(400)]
    job = IndexJob(spark, str(tmp_path / "index"), block_docs=4)
    job.run(spark.createDataFrame(docs, DOC))
    asked = queries(spark, [(1, "rare", 3)])
    monkeypatch.setattr(stored, "SEED_BLOCKS", 1)
    assert job._blocks(job.segments()).count() >= 100
    assert job.needed_blocks(asked).count() == 1
    assert found(job.page(asked)) == wanted(docs, [(1, "rare", 3)])
    # No block without a term of the query is scored, and none is skipped while fewer than k are found.
    assert job.needed_blocks(queries(spark, [(1, "zebra", 3)])).count() == 0
    assert found(job.page(queries(spark, [(1, "common", 1000)]))) == wanted(docs, [(1, "common", 1000)])


def test_ties_go_to_the_lower_id_across_blocks(spark, job):
    docs = [(i, "same text") for i in range(50, 0, -1)]
    job.run(spark.createDataFrame(docs, DOC))
    assert [d for d, _ in found(job.page(queries(spark, [(1, "same", 4)])))[1]] == [1, 2, 3, 4]


def test_only_the_blocks_needed_are_decoded(spark, job):
    job.run(spark.createDataFrame(corpus(60), DOC))
    plan = job.page(queries(spark, ASKED))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.index("LeftSemi") > plan.index("MapInArrow") and "WindowGroupLimit" in plan
    headers = job._blocks(job.segments()).select("block", "terms", "max_tf", "min_dl")
    assert "docs" not in headers._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_string_ids_and_the_combined_search(spark, tmp_path):
    docs = spark.createDataFrame([(f"d{d}", t, f"t{d}", "") for d, t in DOCS], "doc_id string, text string, title string, link string")
    job = IndexJob(spark, str(tmp_path / "index"), id_type="string")
    job.run(docs)
    q = queries(spark)
    rows = retrieve.document_page(q, docs, job)
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, retrieve.document_page(q, docs).collect()))


def blocks_of(job):
    return job._blocks(job.segments()).select("block", "docs.doc_id").collect()


def test_split_terms_are_the_tokens(spark):
    rng = random.Random(3)
    signs = "aZ09 \t\n\x00\x1f_-.'\x7fäÖßéİIıſKΣςσǅ你好٣½²ⅷ́  ​–€😀𝔸𐐀𝟗"
    texts = ["", " ", "A", "İstanbul ΟΔΟΣ", "no-Break here"] + ["".join(rng.choices(signs, k=rng.randrange(1, 40))) for _ in range(500)]
    texts += ["".join(rng.choices([chr(c) for c in range(128)], k=60)) for _ in range(100)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], DOC).coalesce(1)
    # Bytes that are no UTF-8 are read as Java reads them.
    rows = rows.unionByName(spark.sql("select -1L as doc_id, cast(x'41ff42c320c3a4e4' as string) as text"))
    got = rows.select("doc_id", X.plain(F.col("text")).alias("text"), X.tokens(F.col("text")).alias("toks")).toArrow().combine_chunks()
    got = got.slice(1)
    assert text.split_terms(got["text"].chunk(0)).to_pylist() == got["toks"].to_pylist()


def test_large_import_makes_its_blocks_where_it_reads(spark, job, monkeypatch):
    # A tenth of the terms of a task are gathered at once; a block still has documents of similar length.
    monkeypatch.setattr(session, "SPREAD_BYTES_PER_CORE", 0)
    monkeypatch.setattr(stored, "GATHERED_TERMS", 500)
    monkeypatch.setattr(IndexJob, "_write", lambda *_: 1 / 0)
    docs = corpus(400)
    job.run(spark.createDataFrame(docs, DOC).coalesce(2))
    holds(job, docs, ASKED)
    found_ = blocks_of(job)
    assert len({b.block for b in found_}) == len(found_) < 130


def test_large_import_with_repeated_and_null_rows(spark, job, monkeypatch):
    monkeypatch.setattr(session, "SPREAD_BYTES_PER_CORE", 0)
    rows = [(1, "cat"), (1, "the cat sat"), (None, "the cat"), (1, "the cat sat"), (2, None), (2, "dog")]
    job.run(spark.createDataFrame(rows, DOC))
    holds(job, [(1, "the cat sat"), (2, "dog")])


def test_merging_copies_whole_blocks(spark, job, monkeypatch):
    job.run(spark.createDataFrame([(i, f"old w{i} " + "x " * (i // 8)) for i in range(40)], DOC))
    decoded = []
    documents = IndexJob._documents
    monkeypatch.setattr(IndexJob, "_documents", lambda self, blocks: decoded.append(blocks.select(F.explode("docs.doc_id")).count()) or documents(self, blocks))
    new = [(i, f"new w{i} " + "x " * (i // 8)) for i in range(39, 100)]
    job.run(spark.createDataFrame(new, DOC))
    # Only the block that has lost a document and those that are not full are taken apart.
    assert len(job.segments()) == 1 and len(decoded) == 1 and decoded[0] <= 12
    docs = [(i, f"old w{i} " + "x " * (i // 8)) for i in range(39)] + new
    holds(job, docs, [(1, "old w3 w77", 5), (2, "new x", 90), (3, "w39", 2)])
    found_ = blocks_of(job)
    assert len({b.block for b in found_}) == len(found_)
    assert sorted(d for b in found_ for d in b.doc_id) == [i for i, _ in docs]
    # Blocks that were copied lose documents like others.
    job.run(spark.createDataFrame([], DOC), spark.createDataFrame([(i,) for i in range(0, 100, 3)], "doc_id bigint"))
    holds(job, [d for d in docs if d[0] % 3], [(1, "old w3 w77", 5), (2, "new x", 90), (3, "w39", 2)])


def test_ended_documents_do_not_repeat_their_block(spark, job):
    """A block goes once to the step that takes documents out of it, not once for each of them."""
    job.run(spark.createDataFrame(corpus(60), DOC))
    gone = job._places(job.segments(), job._next(), spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id bigint"))
    plan = gone._jdf.queryExecution().executedPlan().toString()
    assert "transform(" not in plan and plan.index("MapInArrow") < plan.index("Join")
    want = {i: sorted(set(t.split())) for i, t in corpus(60) if i % 2 == 0}
    assert {r.doc_id: sorted(r.terms) for r in gone.collect()} == want


def test_counts_and_terms_of_any_width(spark, job):
    # Counts beyond one and two bytes, more terms in a block than one byte can number, and an empty document.
    docs = [(1, "cat " * 70_000 + "dog"), (2, "cat " * 300), (3, " ".join(f"w{i}" for i in range(70_000))), (4, ""), (5, "dog w69999")]
    job.run(spark.createDataFrame(docs, DOC))
    job.run(spark.createDataFrame([], DOC), spark.createDataFrame([(2,)], "doc_id bigint"))
    holds(job, [d for d in docs if d[0] != 2], [(1, "cat dog", 5), (2, "w255 w256 w65536 w69999", 5)])
    assert sorted(r.n for r in job._blocks(job.segments()).select(F.inline("docs")).collect() if r.doc_id in (1, 3, 4)) == [0, 2, 70_000]
