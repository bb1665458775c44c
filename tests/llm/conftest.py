import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with a clashing column of any name."""

    def make(rows, *clashing):
        schema = DOCS + "".join(f", {c} string" for c in clashing)
        return spark.createDataFrame([(i, t, "en", "src", len(t or ""), *["x"] * len(clashing)) for i, t in rows], schema)

    return make
