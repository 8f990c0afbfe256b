import pytest


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with a clashing extra column."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_shingles string"
        full = [(i, t, "en", "s", None if t is None else len(t), "own", "own") for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
