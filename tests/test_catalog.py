"""Every registered query against its DuckDB SQL on the smallest data folder."""
import os

import pytest

from compare import connect, differences
from tidemark.catalog import oracles
from tidemark.catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(oracles.FINAL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(spark, duck, FOLDER, name) == []


def test_no_python_on_the_data_path(spark):
    for name, build in QUERIES.items():
        plan = build(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "MapInPandas" not in plan, name
