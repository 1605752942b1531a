import pytest

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
SCHEMA = "doc_id long, text string, row int, key string, ids int, label int, n long, bad string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    twin = "the quick brown fox jumps over the lazy dog again and again " * 12
    rows = [(None, None), (None, "no id"), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, LONG),
            (6, twin), (7, twin), (7, twin), (8, twin.upper()), (9, "naïve Ωmega 漢字 \U0001f600")]
    return spark.createDataFrame([(i, t, 1, None, 2, 3, None, "x") for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts(spark):
    from tests.conftest import SF_SMALL
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture(scope="session")
def small(spark):
    from tests.conftest import SF_SMALL
    return lambda name: spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
