"""The session for these tests: texts reach Python in small batches, so that several batches are seen."""

import pytest


@pytest.fixture(scope="session")
def llm(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    yield spark
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.fixture
def documents(llm):
    """A table of documents from (doc_id, text) pairs, with columns whose names clash with results."""

    def make(rows, lang="en"):
        full = [(i, t, lang, "src", len(t or ""), "x", 1, "y") for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, rank int, component_id string"
        return llm.createDataFrame(full, schema)

    return make
