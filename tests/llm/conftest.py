import pytest

from catalog_sync.llm.shared import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank int, `key` string, component string"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source), with columns of clashing names."""
    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, 7, "k", "c") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make
