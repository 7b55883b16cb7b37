"""The pipeline's stages against plain versions, and the queries' SQL."""

import check
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from filelake.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The table after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((docs.collect(), stage(spark, docs, SF)))
        out[-1][1].write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[-1] = (out[-1][0], docs.collect(), docs.columns)
    return dict(zip([n for n, _ in corpus_pipeline.STAGES], out))


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_columns(stages):
    assert list(stages) == ["toxicity", "line_dedup", "simhash_dedup", "mixing", "packing"]
    assert all(stages[n][2] == COLUMNS for n in list(stages)[:-1])


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after, _ = stages["toxicity"]
    assert all(by_id(before)[i] == r for i, r in by_id(after).items())
    # The smallest tables hold 11 toxic labels, too few to learn from.
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = by_id(corpus_pipeline.remove_toxic(spark, docs, sf).collect())
    clean, toxic = ([i for i, y in labels.items() if y == wanted] for wanted in (0, 1))
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)
    assert sum(i not in kept for i in toxic) >= 0.75 * len(toxic)


def test_lines(stages):
    from test_line_dedup import brute

    before, after, _ = stages["line_dedup"]
    wanted = dict(brute([(r["doc_id"], r["text"]) for r in before], 50))
    assert {r["doc_id"]: r["text"] for r in after} == wanted
    old = by_id(before)
    for r in after:
        assert r["n_chars"] == (old[r["doc_id"]]["n_chars"] if r["text"] == old[r["doc_id"]]["text"] else len(r["text"]))


def test_one_of_each_group(stages):
    from test_simhash import brute_groups

    before, after, _ = stages["simhash_dedup"]
    wanted = {c for _, _, c in brute_groups([(r["doc_id"], r["text"]) for r in before])}
    assert set(by_id(after)) == wanted and len(after) == len(wanted)
    assert all(by_id(before)[r["doc_id"]] == r for r in after)


def test_mixture_leaves_nothing_out(stages):
    before, after, _ = stages["mixing"]
    assert set(by_id(after)) == set(by_id(before))
    assert all(by_id(before)[r["doc_id"]] == r for r in after)
    assert len(after) <= 2 * len(before)


def test_packing_round_trip(spark, stages):
    from test_packing import check_packing

    before, after, _ = stages["packing"]
    n, total = check_packing([(r["doc_id"], r["text"]) for r in before], after, 4096)
    assert n <= -(-total // 4096) + 1
    # The registered query makes the same pieces in one call.
    made = [(r["doc_id"], r["piece"], r["ids_crc32"]) for r in entry.queries()["pipeline"](spark, SF).collect()]
    assert sorted(made) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in after)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_sql(spark, name):
    con = check.connect(SF)
    assert check.compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], SF) is None


def test_every_operator_is_registered():
    numbers = [int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op")]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()


SHAPES = {
    "op2_html_extract": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op3_embedding_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op5_exact_top_k": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op6_pack_sequences": {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
        "sequence_id": "bigint", "offset": "bigint",
    },
    "op7_simhash_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op9_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op10_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op11_embedding_whitening": {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double",
        "identity_error": "double",
    },
    "op12_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op13_ranked_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
}


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_columns_of_the_queries(spark, name):
    df = queries.QUERIES[name](spark, SF)
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in SHAPES[name]} == SHAPES[name]
    assert df.count() > 0


def test_simhash_query_on_all_documents(spark):
    from test_simhash import brute_groups

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    wanted = {(i, f"{p:016x}", c) for i, p, c in brute_groups(docs)}
    assert {tuple(r) for r in queries.op7_simhash_dedup(spark, SF).collect()} == wanted


def test_held_out_fold_is_that_of_crc32(spark):
    import zlib

    rows = queries.op10_toxicity(spark, SF).select("doc_id", "held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
