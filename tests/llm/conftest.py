import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Make a ``documents`` table of (doc_id, text, source) rows; a language and further columns may follow."""

    def make(rows, lang="en"):
        full = [(i, t, lang, s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
