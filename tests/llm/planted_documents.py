"""A fixture that the tests of this folder share."""

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from (doc_id, text, lang, source), with extra columns of names that the operators use."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string"
        full = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        return spark.createDataFrame(full, schema).selectExpr(
            "*", "1 AS id", "2L AS h", "'x' AS n", "3 AS size", "'k' AS key", "0 AS _salt", "'y' AS root"
        )

    return make
