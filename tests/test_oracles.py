"""Every registered query: its plan, and its rows against DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
import compare
import plans
from hourgrid.plans import oracles, queries

# what no plan may hold: cross joins, Python workers, stages of one task
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "SinglePartition"]

# these unpack archives, which takes Python workers
UNPACKING = {"src1_archive_members", "src12_first_member", "e1_archive_to_nodal_curves"}

ORACLES = oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert sorted(queries()) == sorted(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    text = plans.plan_text(df)
    allowed = {"MapInPandas"} if name in UNPACKING else set()
    assert [f for f in FORBIDDEN if f in text and f not in allowed] == []
    assert compare.compare(spark, con, name, lambda *_: df, ORACLES[name], sf_dir) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["scenario_id", "elementName", "elementType"] and df.count() == 100
