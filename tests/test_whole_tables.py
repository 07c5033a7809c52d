"""The queries that write files of their own take all rows of their tables along, in many files of bounded size."""

import csv
import io
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pytest
from conftest import rows

from hourgrid.plans import queries, sources

SCENARIO = "l_linestatus"


@pytest.fixture
def small_files(monkeypatch):
    monkeypatch.setattr(sources, "ARCHIVE_ROWS", 500)
    monkeypatch.setattr(sources, "PRICE_ROWS", 100)
    monkeypatch.setattr(sources, "WIDE_SITES", {"F": 4, "O": 3})


@pytest.fixture(scope="module")
def lines(sf_dir):
    return pd.read_parquet(f"{sf_dir}/lineitem.parquet")


def run(spark, sf_dir, name):
    return queries()[name](spark, sf_dir)


def test_all_members_are_archived(spark, sf_dir, lines, small_files):
    got = run(spark, sf_dir, "src1_archive_members").toPandas()
    assert len(got) == len(lines)
    want = lines.groupby([SCENARIO, "l_partkey"])["l_extendedprice"].agg(["size", "sum"])
    want.index = [(s, f"M{k}") for s, k in want.index]
    have = got.groupby(["scenario_id", "member"])["mw"].agg(["size", "sum"])
    assert have["size"].to_dict() == want["size"].to_dict()
    assert have["sum"].round(1).to_dict() == want["sum"].round(1).to_dict()


def test_the_first_member_of_many_archives(spark, sf_dir, lines, small_files):
    named = lines[lines["l_partkey"].astype(str).str.startswith("1")]
    named = named.assign(pos=named["l_partkey"] * 7919 % 1000003)
    want = []
    for scenario, group in named.groupby(SCENARIO):
        first = group[group["pos"] == group["pos"].min()]
        want.append((scenario, f"M{first['l_partkey'].iloc[0]}", len(first)))
    assert rows(run(spark, sf_dir, "src12_first_member"), "scenario_id", "member", "n") == sorted(want)


def test_many_archives_give_the_curves_of_few(spark, sf_dir, monkeypatch):
    few = rows(run(spark, sf_dir, "e1_archive_to_nodal_curves"))
    monkeypatch.setattr(sources, "ARCHIVE_ROWS", 500)
    assert rows(run(spark, sf_dir, "e1_archive_to_nodal_curves")) == few and len(few) > 1000


def test_the_lines_of_an_archive_are_made_at_once(monkeypatch):
    made, csv_lines = [], sources._csv_lines
    monkeypatch.setattr(sources, "_csv_lines", lambda group, columns: made.append(columns) or csv_lines(group, columns))
    given = [
        # member, member_pos, row_idx and two fields; a member's rows need not lie together, nor have a place
        ("M2", 5, 3, "a,b", 1.5e9), ("M1", 5, 2, 'q"x', None), ("M2", 5, 1, None, 0.1), (None, 5, 0, "z", 1.0), ("M1", 5, None, "line\nend", None),
        ("M3", 9, 1, None, 7.0), ("M4", 2, 8, "é", 1e-7),
    ]
    order = ["member_pos", "row_idx"]
    columns = ["member", *order, "name", "mw"]
    group = pa.table({"scenario_id": ["F"] * 7, "block": [0] * 7, **dict(zip(columns, map(list, zip(*given))))})
    got = [(name, list(csv.reader(io.StringIO(data.decode(), newline="")))) for name, data in sources._members(group, "member", order)]
    assert [(name, read[0], [r[1:] if "mw" not in read[0] else [*r[1:-1], float(r[-1])] for r in read[1:]]) for name, read in got] == [
        ("M4", ["", "name", "mw"], [["é", 1e-7]]), ("M2", ["", "name", "mw"], [["", 0.1], ["a,b", 1.5e9]]),
        ("M1", ["", "name"], [['q"x'], ["line\nend"]]), ("M3", ["", "mw"], [[7.0]]),
    ]
    assert made == [["name", "mw"], ["name"], ["mw"]]  # once for each set of columns, however many members have it
    assert list(sources._members(group.slice(3, 1), "member", order)) == []


def test_few_folders_hold_all_archives(spark, sf_dir, lines, small_files):
    folder = Path(sources._written(spark, sf_dir).removeprefix("file:"))
    found = list(folder.rglob("*.tar.gz"))
    assert len(found) > 10 and {p.parent for p in found} == set(folder.iterdir())
    assert sorted(p.name for p in folder.iterdir()) == sorted(lines[SCENARIO].unique())


def test_all_sites_are_written_wide(spark, sf_dir, lines, small_files):
    lines = lines.assign(hour=(pd.to_datetime(lines["l_shipdate"]) - pd.Timestamp("1995-01-01")).dt.days)
    lines["net"] = lines["l_quantity"].where(lines["l_returnflag"] != "R", -lines["l_quantity"])
    want = {(s, h, str(k)): round(v, 4) for (s, h, k), v in lines.groupby([SCENARIO, "hour", "l_suppkey"])["net"].sum().items()}
    got = run(spark, sf_dir, "src2_wide_files").collect()
    assert {(r.scenario_id, r.hour, r.site): round(r.mw, 4) for r in got} == want and len(got) == len(want)
    hours = lines.groupby(SCENARIO)["hour"].nunique()
    assert rows(run(spark, sf_dir, "o1_sorted_sink"), "scenario_id", "n", "in_order") == [(s, n, True) for s, n in sorted(hours.items())]


def test_all_orders_have_a_price(spark, sf_dir, small_files):
    orders = pd.read_parquet(f"{sf_dir}/orders.parquet").sort_values("o_orderkey")
    want = [(s, h, round(p * f, 4)) for s, f in (("F", 1.0), ("O", 2.0)) for h, p in enumerate(orders["o_totalprice"])]
    got = [(s, h, round(p, 4)) for s, h, p in rows(run(spark, sf_dir, "src9_price_files"), "scenario_id", "hour", "price")]
    assert got == want


def test_no_prefix_of_orders_is_cut_off(spark, tmp_path):
    orders = [(k * 1000, float(k)) for k in range(1, 300)]
    spark.createDataFrame(orders, "o_orderkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    assert run(spark, str(tmp_path), "src9_price_files").count() == 2 * len(orders)
