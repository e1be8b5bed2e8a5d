"""Small frames of documents for the text operators."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Rows of (doc_id, text) as a documents table."""

    def make(rows):
        full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def clash(spark):
    """A documents table with further columns whose names operators use inside."""

    def make(rows, **columns):
        names = list(columns)
        full = [(i, t, "en", "src", None if t is None else len(t), *columns.values()) for i, t in rows]
        return spark.createDataFrame(full, DOCS + "".join(f", `{n}` string" for n in names))

    return make
