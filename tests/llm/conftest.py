import pytest

from orderflow.llm.workers import importable


@pytest.fixture(autouse=True)
def workers(spark):
    return importable(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with columns whose names clash with what operators add."""

    def make(rows, **more):
        frame = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], DOCS)
        for name, value in more.items():
            frame = frame.selectExpr("*", f"{value!r} as {name}")
        return frame

    return make
