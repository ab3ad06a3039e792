import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns that clash with results."""

    def make(pairs):
        data = [(i, t, "en", "s", None if t is None else len(t), 1, 2) for i, t in pairs]
        return spark.createDataFrame(data, DOCS + ", shard int, score int")

    return make
