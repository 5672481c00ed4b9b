import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Makes a table of documents from (doc_id, text, lang, source) rows; a column name clashes on purpose."""
    def make(rows, extra=True):
        rows = [(*r, None, None, None)[:4] for r in rows]
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        frame = frame.selectExpr("*", "cast(length(text) as bigint) as n_chars")
        return frame.selectExpr("*", "'x' as size", "1 as kept", "'y' as node", "2 as h", "3 as n", "4 as file", "5 as run") if extra else frame
    return make


@pytest.fixture(scope="session")
def sf():
    assert os.path.isdir(SF)
    return SF
