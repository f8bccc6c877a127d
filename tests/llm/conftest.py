import pytest

from tessera.llm.common import workers_find_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    workers_find_package(spark)


@pytest.fixture
def docs(spark):
    """A table of documents out of (doc_id, text) or longer rows, with clashing columns."""

    def build(rows, parts=3):
        full = [(*r, *(None,) * (5 - len(r))) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in ("block", "part", "node", "size", "label", "n_tokens", "text_key", "copy"):
            df = df.selectExpr("*", f"'own' as {name}")
        return df.repartition(parts)

    return build


@pytest.fixture
def rows_of():
    return lambda df: sorted(map(tuple, df.collect()), key=repr)
