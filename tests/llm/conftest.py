import pytest


@pytest.fixture
def docs(spark):
    """Documents from texts, with columns whose names operators use inside."""

    def make(texts, ids=None):
        rows = [(i, t, "en", "web", "x", "y", 7) for i, t in zip(ids or range(len(texts)), texts, strict=True)]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, digest string, row string, n bigint"
        )

    return make


@pytest.fixture
def by_id():
    def run(df):
        return {r.doc_id: r for r in df.collect()}

    return run
