from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from auditlens import get_spark
    s = get_spark("local[4]", app="auditlens-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def mk(spark):
    """Build a bronze DataFrame from literal rows."""
    from auditlens.sources.bronze import BRONZE_SCHEMA, normalize_bronze

    def build(rows):
        return normalize_bronze(spark.createDataFrame(rows, BRONZE_SCHEMA))
    return build
