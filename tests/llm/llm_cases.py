"""Cases and fixtures that the operators' tests share; test modules import them by name."""

import pytest

from ledgerweave.llm.common import ship

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD_TEXTS = [None, "", " \t\n", "!!! 123 ...", "é", "a", "word " * 30_000, "same text here", "same text here"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text[, lang]) tuples, with the columns of the table."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
