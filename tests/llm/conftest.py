import pytest

from tests.conftest import spark  # noqa: F401


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="session")
def make_docs(spark):  # noqa: F811
    """documents-like rows (doc_id, text[, lang, source]) with extra columns
    whose names clash with those the operators use."""
    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), 7, 8, "x") for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, key long, size long, n_shingles string")
    return make
