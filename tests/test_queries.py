"""Every registered query against its SQL, on the smallest data set."""

import check
import pytest

import __spark_entry__ as e

SF = "/root/testdata/sf0.001"
# Without rows on 200 documents and one archive: these run on the next larger data set.
LARGER = "/root/testdata/sf0.01"
EMPTY_AT_THIS_SCALE = {"stream_archives", "stream_archive_update", "embed_stale", "archive_expand", "member_meta", "archive_meta", "member_collisions"}
ROWS_ONLY = sorted(set(e.queries()) - set(e.oracle_sql()) - set(e.LLM_QUERIES))


@pytest.fixture(scope="module")
def connections():
    return {sf: check.connect(sf) for sf in (SF, LARGER)}


# Those of the training-data operators are in tests/llm.
@pytest.mark.parametrize("name", sorted(set(e.oracle_sql()) - set(e.LLM_QUERIES)))
def test_matches_sql(spark, connections, name):
    sf = LARGER if name in EMPTY_AT_THIS_SCALE else SF
    assert check.compare(spark, connections[sf], name, e.queries()[name], e.oracle_sql()[name], sf) is None


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_runs(spark, name):
    assert e.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = e.entry(spark)
    assert df.columns == ["query_id", "query", "image_matches", "document_matches"]
    assert df.count() == 40
