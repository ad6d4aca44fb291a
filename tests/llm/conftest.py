import pytest


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns that operators must not trip over."""

    def make(rows, schema="doc_id long, text string, n long, w long, id long, score double"):
        width = len(schema.split(",")) - 2
        return spark.createDataFrame([(*r, *[None] * width) for r in rows], schema)

    return make
