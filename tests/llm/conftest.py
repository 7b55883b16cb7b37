"""Small tables with every awkward case, for the operators of ``filelake.llm``."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a table like ``documents``, with columns whose names the operators use themselves."""

    def make(rows, source="s"):
        full = [(i, t, None, source if len(r) < 3 else r[2], None if t is None else len(t)) for r in rows for i, t in [r[:2]]]
        df = spark.createDataFrame(full, SCHEMA)
        clash = ("fp", "rep", "key", "_id", "_text", "i", "words", "rank", "size", "u", "v", "id", "label", "y", "group", "h")
        return df.selectExpr("*", *[f"'{c}' as {c}" for c in clash])

    return make
