"""Queries as a cluster runs them: a shared folder whose file system is not named, runs larger than a task may be."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare
from test_skew import no_broadcast  # noqa: F401  (a fixture)

from hourgrid import session
from hourgrid.operators import curves
from hourgrid.plans import oracles, queries

# small tables of the schema that the queries read; keys repeat across the rows of the facts
TABLES = {
    "region": "SELECT i::INTEGER AS r_regionkey, 'R' || i AS r_name FROM range(5) t(i)",
    "nation": "SELECT i::INTEGER AS n_nationkey, 'N' || i AS n_name, (i % 5)::INTEGER AS n_regionkey FROM range(25) t(i)",
    "customer": """SELECT i AS c_custkey, 'C' || i AS c_name, (i % 25)::INTEGER AS c_nationkey, i * 1.5::DOUBLE AS c_acctbal,
        'M' || i % 3 AS c_mktsegment FROM range(20) t(i)""",
    "supplier": "SELECT i AS s_suppkey, 'S' || i AS s_name, (i % 25)::INTEGER AS s_nationkey, i * 2.5::DOUBLE AS s_acctbal FROM range(40) t(i)",
    "part": """SELECT i AS p_partkey, 'part ' || i AS p_name, 'Brand#' || (10 + i % 20) AS p_brand, 'T' || i % 4 AS p_type,
        (1 + i % 50)::INTEGER AS p_size, 900.0::DOUBLE + i AS p_retailprice FROM range(60) t(i)""",
    "orders": """SELECT i AS o_orderkey, i % 20 AS o_custkey, ['F', 'O', 'P'][1 + i % 3] AS o_orderstatus, 1000.0::DOUBLE + i AS o_totalprice,
        TIMESTAMP '1995-01-01' + to_days((i * 7 % 900)::INTEGER) AS o_orderdate, (1 + i % 5) || '-X' AS o_orderpriority FROM range(300) t(i)""",
    "lineitem": """SELECT i // 4 AS l_orderkey, i * 13 % 60 AS l_partkey, i * 7 % 40 AS l_suppkey, (1 + i % 4)::INTEGER AS l_linenumber,
        (1 + i * 31 % 50)::DOUBLE AS l_quantity, (900 + i * 37 % 5000)::DOUBLE AS l_extendedprice, 0.05::DOUBLE AS l_discount,
        0.02::DOUBLE AS l_tax, ['A', 'N', 'R'][1 + i * 11 % 3] AS l_returnflag, ['F', 'O'][1 + i // 40 % 2] AS l_linestatus,
        TIMESTAMP '1995-01-01' + to_days((i * 17 % 700)::INTEGER) AS l_shipdate FROM range(1200) t(i)""",
    "events": """SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_minutes(i * 53 % 43000) AS ts, i * 3 % 29 AS user_id,
        ['view', 'click', 'purchase', 'signup', 'error'][1 + i % 5] AS event_type, (i * 19 % 400)::DOUBLE AS value, '{}' AS props
        FROM range(900) t(i)""",
}


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    for name, sql in TABLES.items():
        duckdb.sql(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def con(tables):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return con


# these write below spark.checkpoint.dir
WRITING = [
    "c11_on_bucketed_flows",
    "c12_link_overload",
    "e1_archive_to_nodal_curves",
    "e2_balanced_gas_stage",
    "o1_sorted_sink",
    "p10_header_names",
    "q_electricity_offenders",
    "q_electricity_runs",
    "q_gas_hours",
    "q_gas_offenders",
    "q_overload_networks",
    "q_overload_offenders",
    "q_profile_hours",
    "q_profile_offenders",
    "snk1_csv_and_src2_read",
    "snk1_partitioned_table",
    "snk1_wide_files_per_run",
    "snk2_dataset_per_carrier",
    "snk2_packed_archives",
    "src10_message_batches",
    "src11_discovered_designs",
    "src11_keys_from_folders",
]


@pytest.mark.parametrize("name", WRITING)
def test_a_folder_without_a_scheme_serves(spark, con, tables, monkeypatch, name):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert folder.startswith("/")
    monkeypatch.setattr(session, "_one_machine", lambda master: False)
    monkeypatch.setattr(session, "_SHARED", set(), raising=False)
    assert compare.compare(spark, con, name, queries()[name], oracles()[name], tables) is None
    assert session._SHARED == {(spark.sparkContext.applicationId, folder)}


# these cut both sources of a run to the shorter one
CUTTING = [
    "a14_any_and_all",
    "a8_net_power",
    "c17_discountability",
    "c4_discount",
    "c4_discount_without_exceptions",
    "d_undistributable",
    "d_undistributable_area_only",
    "j9_discount_per_cell",
    "u1_union_of_sources",
]


@pytest.mark.parametrize("name", CUTTING)
def test_a_run_that_is_cut_goes_to_many_tasks(spark, con, tables, no_broadcast, monkeypatch, name):  # noqa: F811
    cut, seen = curves.cut_to, []
    monkeypatch.setattr(curves, "cut_to", lambda *args: seen.append(cut(*args)) or seen[-1])
    df = queries()[name](spark, tables)
    assert len(seen) == 2  # market and sites
    for part in seen:
        per_task = [r["count"] for r in part.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) > 1000 and max(per_task) < 0.4 * sum(per_task)
    assert compare.compare(spark, con, name, lambda *_: df, oracles()[name], tables) is None
