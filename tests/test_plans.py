"""Shape of the plans: what must reach the scan, and how often a scan runs."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import pytest

import __spark_entry__ as entry
import plans


def final(spark, sf_dir, name):
    """The executed plan, with broadcasts off: the shape that large lookups give."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plans.final_plan_text(entry.queries()[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plans.plan_text(entry.queries()["c9_mv_substation_flow"](spark, sf_dir))
    line = next(t for t in text.splitlines() if "FileScan" in t and "l_suppkey" in t)
    read = line[line.index("ReadSchema"):]
    assert "l_extendedprice" not in read and "l_orderkey" not in read


def test_facts_are_read_twice_at_most(spark, sf_dir):
    """Once for the values, once for two columns that give the length; all else starts from shuffled sums."""
    text = plans.final_plan_text(entry.queries()["c5_nodal_power"](spark, sf_dir))
    assert text.count("lineitem.parquet") <= 2 and text.count("events.parquet") <= 2


def test_filters_reach_the_scan(spark, sf_dir):
    text = plans.plan_text(entry.queries()["a15_first_row_per_group"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)]" in text


@pytest.mark.parametrize(("name", "scans"), [("c1_export_site_curves", 1), ("j16_align_to_first_series", 2), ("c7_balance_on_slack", 2), ("c10_substation_overload", 1)])
def test_facts_are_scanned_seldom(spark, sf_dir, name, scans):
    text = plans.final_plan_text(entry.queries()[name](spark, sf_dir))
    assert text.count("lineitem.parquet") <= scans


@pytest.mark.parametrize("name", ["c1_export_site_curves", "w6_row_position_as_hour"])
def test_routing_hashes_and_numbers_in_one_shuffle(spark, sf_dir, name):
    text = final(spark, sf_dir, name)
    assert "SortAggregate" not in text
    # the rows' own shuffle; what else is shuffled are the limits and names they are joined with
    assert text.count("BroadcastNestedLoop") == 0 and text.count("hashpartitioning(scenario_id") <= 8


def test_balance_needs_no_join(spark, sf_dir):
    text = final(spark, sf_dir, "c7_balance_on_slack")
    assert "Join" not in text and text.count("hashpartitioning(") <= 3


def test_plans_share_one_evaluation(spark, sf_dir):
    """Facts are scanned and summed as often for all plans as for the networks alone."""
    once, all_plans = (plans.final_plan_text(entry.queries()[n](spark, sf_dir)) for n in ("c11_network_overload", "c15_overload_per_plan"))
    assert all_plans.count("lineitem.parquet") <= once.count("lineitem.parquet")


def test_plans_evaluated_one_by_one_give_the_same(spark, sf_dir):
    from conftest import rows
    from pyspark.sql import functions as F

    from hourgrid.operators import overload, scenarios
    from hourgrid.plans import overload as bound
    from hourgrid.plans import views as v

    flows, lines, trafos, buses = (t(spark, sf_dir) for t in (v.element_flow, v.line, v.trafo, v.bus))
    calls = []

    def evaluate(runs):
        calls.append(runs.count())
        return overload.network_overload(flows.join(runs, list(v.NETWORK), "left_semi"), lines, trafos, buses, by=v.NETWORK)

    assigned = bound.plan_runs(spark, sf_dir)
    columns = ["plan", "plan_year", "scenario_id", "network_id", "element_id", "elementType", "overloadFreq"]
    got = rows(scenarios.evaluate_once(assigned, evaluate, v.NETWORK), *columns)
    assert calls == [2] and assigned.count() == 30
    some = assigned.where(F.col("plan_year").isin(2025, 2040)).orderBy("plan", "plan_year").limit(4).collect()
    for use in some:
        mine = assigned.where((F.col("plan") == use.plan) & (F.col("plan_year") == use.plan_year))
        want = rows(scenarios.evaluate_once(mine, evaluate, v.NETWORK), *columns)
        assert want and want == [r for r in got if r[:2] == (use.plan, use.plan_year)]


def test_discovery_opens_no_file(spark, tmp_path):
    from conftest import rows

    from hourgrid.sources import tables

    spark.range(10).write.parquet(f"{tmp_path}/run=a/design=1")
    spark.range(0).write.parquet(f"{tmp_path}/run=a/design=2")
    for file in tmp_path.rglob("*.parquet"):
        file.write_bytes(b"not parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    found = tables.discover(spark, str(tmp_path), {"run": "run=([^/]+)", "design": "design=([^/]+)"})
    text = plans.plan_text(found)
    assert "content" not in text[text.index("ReadSchema") :].splitlines()[0]
    assert rows(found, "run", "design") == [("a", "1"), ("a", "2")]


def test_bucketed_flows_are_not_shuffled_again(spark, sf_dir):
    """Without broadcasts the elements come to the flows: no exchange lies above the scan of the flows."""
    from hourgrid.operators import overload
    from hourgrid.plans import overload as bound
    from hourgrid.plans import views as v

    flows = bound.bucketed_flows(spark, sf_dir)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        elements = overload.line_elements(v.line(spark, sf_dir), v.bus(spark, sf_dir), v.NETWORK)
        elements = elements.unionByName(overload.trafo_elements(v.trafo(spark, sf_dir), v.NETWORK))
        text = plans.final_plan_text(overload.element_excess(flows, elements, v.NETWORK).groupBy("scenario_id", *bound.ELEMENT).agg({"excess": "sum"}))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    scan = next(k for k, line in enumerate(lines) if "flows_" in line or "mva" in line and "FileScan" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :|+-*"))
    level, above = depth(lines[scan]), []
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    assert "Bucketed: true" in lines[scan] and not [a for a in above if "Exchange" in a] and "SortMergeJoin" in text


def test_checks_add_no_scan(spark, sf_dir, monkeypatch):
    """With checks each source is scanned as often as without: once for its keys, once for its values; the power is the same."""
    from hourgrid.operators import discount, quality
    from hourgrid.plans import views as v

    scans = {"lineitem.parquet": 0, "events.parquet": 0}

    def count(df):
        text = plans.final_plan_text(df)
        for name in scans:
            scans[name] += text.count(name)

    written = quality._written
    monkeypatch.setattr(quality, "_written", lambda df: (count(df), written(df))[1])
    market, sites = v.market_curve(spark, sf_dir), v.site_curve(spark, sf_dir)
    args = (market, sites, v.categories(spark, sf_dir), v.weights(spark, sf_dir), v.site(spark, sf_dir))
    power, bad = quality.checked_nodal_power(*args, by=v.SCENARIO)
    count(power)
    plain = plans.final_plan_text(discount.nodal_power(*args, by=v.SCENARIO))
    assert all(0 < n <= plain.count(name) for name, n in scans.items())
    good = {r[0] for r in sites.select("scenario_id").distinct().collect()} - {r["scenario_id"] for r in bad.collect()}
    want = discount.nodal_power(*args, by=v.SCENARIO)
    key = lambda df: sorted((r.scenario_id, r.hour, r.node, round(r.power, 6)) for r in df.collect() if r.scenario_id in good)
    assert key(power) == key(want)


def test_flows_get_as_many_buckets_as_a_shuffle_has_partitions(spark, sf_dir):
    from hourgrid.plans import overload as bound

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert len(bound.bucketed_flows(spark, sf_dir).inputFiles()) == 13
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
