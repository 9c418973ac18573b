from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame from rows and a DDL schema, in two partitions."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(2)

    return build
