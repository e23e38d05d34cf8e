"""Every registered query against its SQL counterpart, over whole tables."""

import importlib.util
from pathlib import Path

import pytest

from workload.compare import connect, differences
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == ""


def test_entry_points(spark):
    path = Path(__file__).resolve().parent.parent / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(module.queries())
    assert set(module.oracle_sql()) <= set(module.queries())
    assert module.entry(spark).count() > 0
