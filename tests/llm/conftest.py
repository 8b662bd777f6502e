import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from dimforge.llm.common import ship

    ship(spark)


@pytest.fixture
def docs(spark):
    """A frame of documents with a column whose name clashes with results of operators."""

    def make(rows, extra="kept"):
        return spark.createDataFrame(
            [(i, t, lang, src, extra) for i, t, lang, src in rows],
            "doc_id long, text string, lang string, source string, n_tokens string",
        )

    return make
