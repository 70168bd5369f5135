import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from rillmark.llm.registry import with_package

    return with_package(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples, with columns that clash with inner names."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1]), 1, "x", "y") for r in rows]
        kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, n int, component_id string, key string"
        return spark.createDataFrame(full, kind).repartition(partitions)

    return make
