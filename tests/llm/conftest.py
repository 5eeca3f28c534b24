import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs; extra columns carry names the operators use themselves."""

    def make(rows, parts=3):
        full = [(i, t, "en", "s", None if t is None else len(t), "x", "y", 7) for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", digest string, kept string, start int").repartition(parts)

    return make
