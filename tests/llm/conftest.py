import pytest

from paymart.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """A table with the shapes every operator must take: nulls, empty, blank and long texts, repeated rows, clashing names."""

    def build(texts, ids=None):
        rows = [(i if ids is None else ids[i], t, "en", f"src{i % 3}", len(t or ""), i, "x", 1) for i, t in enumerate(texts)]
        names = "doc_id long, text string, lang string, source string, n_chars long, node long, shard string, spans int"
        return spark.createDataFrame(rows, names)

    return build
