"""Helpers of the tests of the training-data operators."""

import pytest


@pytest.fixture
def frame(spark):
    """Build a DataFrame from rows and a schema string."""

    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)

    return make
