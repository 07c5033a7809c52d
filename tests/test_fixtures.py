"""Worked examples with results derived by hand."""

import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from hourgrid.functions import text, time
from hourgrid.operators import checks, curves, discount, export, gas, overload, profiles, quality, scenarios

S = ("scenario_id",)


def test_reduced_capacity(spark):
    stations = spark.createDataFrame([("a", 90.0, 3), ("b", 30.0, 1), ("c", 10.0, 0)], "substation string, capacity double, trafos int")
    assert rows(overload.reduced_capacity(stations, 0), "substation", "nx_capacity") == [("a", 90.0), ("b", 30.0), ("c", None)]
    assert rows(overload.reduced_capacity(stations, 1), "substation", "nx_capacity") == [("a", 90.0), ("b", 0.0), ("c", None)]
    assert rows(overload.reduced_capacity(stations, 1, "n_minus_x"), "substation", "nx_capacity") == [
        ("a", pytest.approx(60.0)), ("b", 0.0), ("c", None)]


def test_substation_overload_is_signed(spark):
    flow = spark.createDataFrame(
        [("s", 0, "A", 5.0), ("s", 1, "A", -7.0), ("s", 2, "A", 1.0), ("s", 0, "B", 1.0), ("s", 0, "X", 99.0)],
        "scenario_id string, hour int, substation string, mw double")
    stations = spark.createDataFrame(
        [("s", "A", 4.0, 1), ("s", "B", 4.0, 1), ("s", "C", 4.0, 1)], "scenario_id string, substation string, capacity double, trafos int")
    got = {r["elementName"]: r for r in overload.substation_overload(flow, stations, by=S).collect()}
    a = got["A"]
    assert (a["overloadVolume"], a["overloadMedian"], a["overloadFreq"]) == (-2.0, -1.0, 2)
    assert a["overloadScore"] == pytest.approx(-2 / 8760) and a["overloadCalculated"] == pytest.approx(-26.6 / 8760)
    assert a["weighFactor"] == 13.3 and a["elementType"] == "substation"
    # without overload, without flow, without substation: all zeros
    assert sorted(got) == ["A", "B", "C", "X"]
    for name in "BCX":
        assert (got[name]["overloadVolume"], got[name]["overloadFreq"], got[name]["overloadCalculated"]) == (0.0, 0, 0.0)
    assert got["X"]["elementCapacity"] == 0.0


def test_element_overload(spark):
    flows = spark.createDataFrame(
        [("s", "n", "line", 1, h, m) for h, m in enumerate([12.0, -15.0, 9.0, 10.0])] + [("s", "n", "trafo", 1, 0, 3.0)],
        "scenario_id string, network_id string, element_type string, element_id bigint, hour int, mva double")
    elements = spark.createDataFrame(
        [("n", "line", 1, "one", 10.0, 1.0), ("n", "line", 2, "one", 10.0, 1.0)],
        "network_id string, element_type string, element_id bigint, name string, capacity double, factor double")
    by = ("scenario_id", "network_id")
    one, two = sorted(overload.element_overload(flows, elements, by).collect(), key=lambda r: r["element_id"])
    assert (one["overloadVolume"], one["overloadMedian"], one["overloadFreq"]) == (7.0, 3.5, 2)
    assert one["overloadScore"] == pytest.approx(7 / 8760)
    assert two["elementName"] == "one" and two["overloadFreq"] == 0 and two["overloadVolume"] == 0.0


def test_line_capacity_takes_the_other_side(spark):
    buses = spark.createDataFrame([("n", 1, 150.0)], "network_id string, bus_id bigint, vn_kv double")
    lines = spark.createDataFrame(
        [("n", 1, "x", 1, 9, 2.0, 0.5), ("n", 2, "y", 9, 1, 2.0, 0.5), ("n", 3, "z", 8, 9, 2.0, 0.5)],
        "network_id string, element_id bigint, name string, from_bus bigint, to_bus bigint, length_km double, max_i_ka double")
    got = dict(rows(overload.line_elements(lines, buses, ("network_id",)), "element_id", "capacity"))
    assert got[1] == got[2] == pytest.approx(129.9038, abs=1e-4)
    assert got[3] is None
    assert math.isclose(got[1], 150 * 0.5 * math.sqrt(3))


def test_link_overload(spark):
    flows = spark.createDataFrame(
        [("s", "a", 12.0, 10.0), ("s", "a", -5.0, 9.0), ("s", "b", 4.0, 1.0), ("s", None, 9.0, 1.0)],
        "scenario_id string, naam string, berekening double, voorwaarde double")
    factors = spark.createDataFrame([("s", "a", 3.0), ("s", "c", 7.0)], "scenario_id string, name string, length_km double")
    got = {r["elementName"]: r for r in overload.link_overload(flows, factors, S).collect()}
    assert sorted(got) == ["a", "b", "c"]
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["overloadVolume"], a["overloadMedian"], a["overloadFreq"]) == (-2.0, -1.0, 2)
    assert a["overloadCalculated"] == pytest.approx(-6 / 8760)
    assert (b["weighFactor"], b["overloadCalculated"], b["overloadVolume"], b["overloadFreq"]) == (0.0, 0.0, 3.0, 1)
    assert (c["weighFactor"], c["overloadVolume"], c["overloadFreq"]) == (7.0, 0.0, 0)


def test_sector_curve_nets_before_the_split(spark):
    curve = spark.createDataFrame([("s", 0, "p", 5.0), ("s", 0, "q", -2.0)], "scenario_id string, hour int, site string, mw double")
    sites = spark.createDataFrame(
        [("s", "p", "N25", "S"), ("s", "q", "N150", "S")], "scenario_id string, site string, substation string, sector string")
    got = rows(curves.nodal_sector_curves(curve, sites, by=S), "node", "sector", "product", "mw")
    assert got == [("N150", "S", "Demand", 3.0), ("N150", "S", "Supply", 0.0)]


def test_lift(spark):
    sites = spark.createDataFrame([("MVL25-3",), ("MVL150",), ("MVL380",)], "substation string").withColumn("site", F.lit("x"))
    assert [r[0] for r in rows(curves.lift_to_high_voltage(sites), "substation")] == ["MVL150", "MVL150", "MVL380"]
    renamed = spark.createDataFrame([("MVL", "ABC")], "station string, lifted_station string")
    assert [r[0] for r in rows(curves.lift_to_high_voltage(sites, renamed), "substation")] == ["ABC150", "MVL150", "MVL380"]


def _market(spark, cells):
    return spark.createDataFrame(
        [("s", h, n, p, s, m) for h, n, p, s, m in cells],
        "scenario_id string, hour int, node string, product string, sector string, mw double")


BALANCED = [
    (0, "A", "Supply", "s", 10.0), (0, "B", "Supply", "s", 30.0), (0, "C", "Supply", "s", 60.0),
    (0, "A", "Demand", "s", 20.0), (0, "B", "Demand", "s", 50.0), (0, "C", "Demand", "s", 50.0),
]
BALANCED_SITES = [(0, "X", "Supply", "s", 25.0), (0, "X", "Demand", "s", 40.0)]


def test_discount_balanced(spark):
    got = rows(discount.discount(_market(spark, BALANCED), _market(spark, BALANCED_SITES), "A", by=S), "node", "power")
    assert got == [("B", pytest.approx(-15.0)), ("C", pytest.approx(10.0)), ("X", pytest.approx(-15.0))]


def _imbalanced(hour):
    market = [(hour, n, "Supply", "s1", 0.0) for n in "ABC"] + [
        (hour, "A", "Supply", "s2", 0.0), (hour, "B", "Supply", "s2", 30.0), (hour, "C", "Supply", "s2", 10.0)]
    market += [(hour, n, "Demand", s, 0.0) for n in "ABC" for s in ("s1", "s2")]
    sites = [(hour, "X", "Supply", "s1", 12.0), (hour, "X", "Supply", "s2", 0.0)]
    sites += [(hour, "X", "Demand", s, 0.0) for s in ("s1", "s2")]
    return market, sites


def test_discount_imbalanced(spark):
    market, sites = _imbalanced(0)
    got = rows(discount.discount(_market(spark, market), _market(spark, sites), "A", by=S), "node", "power")
    assert got == [("B", pytest.approx(21.0)), ("C", pytest.approx(7.0)), ("X", pytest.approx(12.0))]


def test_one_imbalanced_hour_switches_its_chunk_only(spark):
    # hours 1 and 30 have market power in a sector that the sites have nothing of inside the area
    market, sites = _imbalanced(0)
    for h in (1, 30):
        market += [(h, "A", "Supply", "s3", 6.0), (h, "B", "Supply", "s2", 30.0), (h, "C", "Supply", "s2", 10.0)]
        sites += [(h, "X", "Supply", "s2", 0.0)]
    power = {(r["hour"], r["node"]): r["power"] for r in
             discount.discount(_market(spark, market), _market(spark, sites), "A", 24, S).collect()}
    # the 6 inside the area are lost in a balanced chunk and spread over B and C in an imbalanced one
    assert power[30, "B"] == pytest.approx(30.0) and power[30, "C"] == pytest.approx(10.0)
    assert power[1, "B"] == pytest.approx(34.5) and power[1, "C"] == pytest.approx(11.5)


def test_gas_balance(spark):
    def curve(values):
        sites = ["a", "b", "CH4Export_Per", "CH4Import_Wijngaarden"]
        return spark.createDataFrame(
            [("s", "methane", 0, site, m) for site, m in zip(sites, values)],
            "scenario_id string, carrier string, hour int, site string, mw double")

    up = dict(rows(gas.balance_on_slack(curve([4.0, 3.0, 1.0, -2.0]), by=S), "site", "mw"))
    assert up == {"a": 4.0, "b": 3.0, "CH4Export_Per": 1.0, "CH4Import_Wijngaarden": -8.0}
    down = dict(rows(gas.balance_on_slack(curve([-4.0, -3.0, -1.0, 2.0]), by=S), "site", "mw"))
    assert down == {"a": -4.0, "b": -3.0, "CH4Export_Per": 5.0, "CH4Import_Wijngaarden": 2.0}


def test_time_keys(spark):
    got = rows(gas.time_keys(spark.createDataFrame([(0,), (23,), (24,), (8759,)], "hour int")), "hour", "dag", "uur")
    assert got == [(0, 1, 1), (23, 1, 24), (24, 2, 1), (8759, 365, 24)]
    stamps = spark.createDataFrame([(0,), (8759,)], "hour int").select(time.profile_from(F.col("hour")), time.profile_to(F.col("hour")))
    assert [tuple(r) for r in stamps.collect()] == [
        (dt.datetime(2018, 12, 31, 23), dt.datetime(2019, 1, 1, 0)), (dt.datetime(2019, 12, 31, 22), dt.datetime(2019, 12, 31, 23))]


def test_profiles(spark):
    series = spark.createDataFrame(
        [("s", "p", 0, 0.0), ("s", "p", 1, 50.0), ("s", "p", 2, 100.0), ("s", "q", 0, 0.0)],
        "scenario_id string, profile string, hour int, mw double")
    got = rows(profiles.normalise(series, by=S), "profile", "hour", "value")
    assert got == [("p", 0, 0.0001), ("p", 1, pytest.approx(0.454545, abs=1e-6)), ("p", 2, pytest.approx(0.909091, abs=1e-6)), ("q", 0, None)]


def test_plant_classes_of_the_published_keys(spark):
    order = spark.createDataFrame(
        [("s", "energy_chp_supercritical_waste_mix.output (MW)", 0, 3.0), ("s", "industry_chp_wood_pellets.output (MW)", 0, 4.0),
         ("s", "energy_power_nuclear_gen3_uranium_oxide.output (MW)", 0, 5.0), ("s", "unlisted", 0, 9.0)],
        "scenario_id string, market_key string, hour int, mw double")
    got = rows(profiles.plant_profiles(order, by=S), "profile", "value")
    assert got == [("Power Plant Nuclear", pytest.approx(1 / 1.1)), ("Power Plant Other", pytest.approx(1 / 1.1))]


def test_padding_and_cut(spark):
    long = spark.range(8761).select(
        F.lit("s").alias("scenario_id"), F.lit("methane").alias("carrier"), F.col("id").cast("int").alias("hour"),
        F.lit("a").alias("site"), F.lit(7.0).alias("mw"))
    market = spark.createDataFrame([("s", "methane", 8760)], "scenario_id string, carrier string, market_hours int")
    fit = gas.fit_calendar(long.where("hour < 8758"), market, by=S)
    assert fit.count() == 8760 and rows(fit.where("hour >= 8757"), "hour", "mw") == [(8757, 7.0), (8758, 7.0), (8759, 7.0)]
    assert gas.fit_calendar(long, market, by=S).agg(F.max("hour")).first()[0] == 8759
    same = spark.createDataFrame([("s", "methane", 8758)], "scenario_id string, carrier string, market_hours int")
    assert gas.fit_calendar(long.where("hour < 8758"), same, by=S).count() == 8758


def test_balance_node_is_always_there(spark):
    curve = spark.createDataFrame([("s", "methane", h, "a", 2.0) for h in range(2)], "scenario_id string, carrier string, hour int, site string, mw double")
    sites = spark.createDataFrame([("s", "n", "methane", "a", "K")], "scenario_id string, network_id string, carrier string, site string, substation string")
    market = spark.createDataFrame([("s", "methane", 2)], "scenario_id string, carrier string, market_hours int")
    got = rows(gas.gas_model_input(curve, sites, market, 4, by=("scenario_id", "network_id")), "dag", "uur", "node", "power")
    assert got == [(1, 1, "BAL_M", 0.0), (1, 1, "K", -2.0), (1, 2, "BAL_M", 0.0), (1, 2, "K", -2.0)]


def test_weight_sums(spark):
    def sums(total):
        return checks.weight_sums(spark.createDataFrame([("a", "s", total - 0.5), ("b", "s", 0.5)], "node string, sector string, weight double"))

    assert rows(sums(0.9994)) == [("s", 0.999)] and rows(sums(0.9996)) == []


RAW = "scenario_id string, member string, row_idx bigint, assetName string, assetClass string, carrierId string, sector string, allocationPower double"


def test_routing(spark):
    raw = spark.createDataFrame([
        ("s", "e", 0, "Site", "EConnection", "EL", "x", 2e6), ("s", "e", 1, "Site", "Other", "EL", "x", 4e6),
        ("s", "g", 0, "Gas", "GConnection", "RTLH_ODO_x", "x", 1e6), ("s", "g", 1, "Gas", "GConnection", "H2_new", "x", 3e6),
        ("s", "i", 0, "LNGImport_MV", "Import", "c", "x", 5e6), ("s", "i", 1, "ImportH2_MV", "Import", "c", "x", 6e6),
        ("s", "h", 0, "ImportH2_MV", "Import", None, "x", 7e6),
        ("s", "n", 0, None, "EConnection", "c", "x", 8e6),
    ], RAW)
    got = rows(export.route(raw.withColumn("member_pos", F.ascii("member")), S), "carrier", "member", "row_idx", "mw")
    assert got == [
        ("electricity", "e", 0, 2.0), ("electricity", "e", 1, 4.0), ("hydrogen", "g", 1, 3.0), ("hydrogen", "h", 0, 7.0),
        ("methane", "g", 0, 1.0), ("methane", "i", 0, 5.0)]


def test_export_aligns_names_and_hours(spark):
    raw = spark.createDataFrame(
        [("s", "m1", i, "A", "EConnection", "EL", "x", 1e6 * i) for i in range(3)]
        + [("s", "m2", i, "B", "EConnection", "EL", "x", 1e6) for i in range(5)]
        + [("s", "m3", 0, "C", "EConnection", "EL", "x", 1e6), ("s", "m4", 0, "CH4Import_Wijngaarden", "Import", "c", "x", 1e6)], RAW)
    names = spark.createDataFrame([("A", "gA", 0), ("B", "old", 1), ("B", "gB", 2)], "raw_name string, grid_name string, row_idx int")
    raw = raw.withColumn("member_pos", F.substring("member", 2, 1).cast("int"))
    got = rows(export.export_site_curves(raw, names, by=S), "carrier", "asset", "site", "hour", "mw")
    # B is cut to the length of A; C has no name and stays, the unnamed gas site is dropped
    assert got == [
        ("electricity", "A", "gA", 0, 0.0), ("electricity", "A", "gA", 1, 1.0), ("electricity", "A", "gA", 2, 2.0),
        ("electricity", "B", "gB", 0, 1.0), ("electricity", "B", "gB", 1, 1.0), ("electricity", "B", "gB", 2, 1.0),
        ("electricity", "C", None, 0, 1.0)]


def test_gas_codes(spark):
    names = spark.createDataFrame([("Conn_RTLH_ODO_HTLG",), ("GM_GM",), ("HTLH_RTLG_ODO",), ("x",)], "n string")
    got = [r[0] for r in names.select(text.unify_gas_code(F.col("n"))).collect()]
    assert got == ["Conn_CH4_HTLG", "CH4_CH4", "HTLH_CH4", "x"]


def test_profile_assignment(spark):
    ports = spark.createDataFrame([
        ("s", "p1", 1, 0, "in", "C", "coal"), ("s", "p1", 1, 1, "out", "E", "Electricity"),
        ("s", "p2", 2, 0, "in", "C", "coal"), ("s", "p2", 2, 1, "out", "E", "Electricity"), ("s", "p2", 2, 2, "in", "W", "wood"),
        ("s", "p3", 3, 0, "in", "HTLH", "gas"), ("s", "p3", 3, 1, "in", "BM", "bio"), ("s", "p3", 3, 2, "out", "E", "Electricity"),
        ("s", "p4", 4, 0, "in", "Sun", "sun"), ("s", "p4", 4, 1, "out", "E", "Electricity"),
        ("s", "p5", 5, 0, "in", "C", "coal"), ("s", "p5", 5, 1, "out", "heat", "Heat"),
    ], "scenario_id string, asset_id string, asset_pos int, port_pos int, port_kind string, carrier_id string, carrier_name string")
    assert rows(profiles.assign_profiles(ports, by=S), "asset_id", "profile", "link") == [
        ("p1", "Power Plant Coal", "profile"), ("p2", "Power Plant Coal", "reference"), ("p3", "Power Plant Biomass", "profile")]


def test_upsert_keeps_what_is_not_overwritten(spark):
    table = spark.createDataFrame([(1, "keep", "old"), (2, "keep", "old")], "k int, a string, b string")
    updates = spark.createDataFrame([(1, "x", "new", 1), (3, "first", "p", 1), (3, "second", None, 2)], "k int, a string, b string, seq int")
    got = rows(scenarios.upsert(table, updates, ["k"], ["b"], ["seq"]))
    assert got == [(1, "keep", "new"), (2, "keep", "old"), (3, "first", None)]


def test_kick_off(spark):
    state = spark.createDataFrame(
        [(i, f"u{i // 2}", "free" if i != 5 else "busy") for i in range(8)], "scenarioId int, scenarioUuid string, calculationState string")
    chosen = scenarios.next_scenarios(state, "free", 3)
    assert rows(chosen, "scenarioId") == [(0,), (2,), (4,)]
    marked = scenarios.mark(state, chosen, "kickedOff")
    assert rows(marked.where("calculationState = 'kickedOff'"), "scenarioId") == [(i,) for i in range(6)]


def test_missing_run_keys_are_refused(spark):
    flow = spark.createDataFrame([("s", 0, "A", 5.0)], "scenario_id string, hour int, substation string, mw double")
    stations = spark.createDataFrame([("A", 4.0, 1)], "substation string, capacity double, trafos int")
    with pytest.raises(ValueError, match="run keys"):
        overload.substation_overload(flow, stations, by=S)


def test_require_and_quarantine(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2)], "scenario_id string, x int")
    bad = facts.where("x = 2")
    checks.require(bad.where("x > 2"), "never")
    with pytest.raises(checks.CheckFailed, match="too large"):
        checks.require(bad, "too large")
    assert rows(checks.quarantine(facts, bad, S)) == [("a", 1)]


def test_bad_runs_are_set_aside(spark):
    market = _market(spark, BALANCED).select("scenario_id", "hour", F.concat_ws("_", "product", "node").alias("market_key"), "mw")
    market = market.unionByName(market.withColumn("scenario_id", F.lit("t")))
    cats = market.select("market_key").distinct().select(
        "market_key", F.lit("Electricity").alias("carrier"), F.split("market_key", "_")[0].alias("product"), F.lit("s").alias("sector"))
    weights = spark.createDataFrame([("A", "s", 0.25), ("B", "s", 0.75)], "node string, sector string, weight double")
    curve = spark.createDataFrame([("s", 0, "x", 5.0), ("t", 0, "x", 5.0), ("t", 0, "unlisted", 1.0), ("t", 0, "idle", 0.0)],
                                  "scenario_id string, hour int, site string, mw double")
    sites = spark.createDataFrame([("s", "x", "N150", "s"), ("t", "x", "N150", "s")],
                                  "scenario_id string, site string, substation string, sector string")
    power, bad = quality.checked_nodal_power(market, curve, cats, weights, sites, exceptions="A", by=S)
    assert rows(bad) == [("t", "curve without site", "unlisted")]
    got = rows(power, "scenario_id", "node", "power")
    assert [(r[0], r[1]) for r in got] == [("s", "B"), ("s", "N150")]
    # supply 100: A had 25, the sites 0, so B keeps 75 + 25; demand 120: A had 30, the sites 5, so B keeps 90 + 25
    assert got[0][2] == pytest.approx(100 - 115) and got[1][2] == pytest.approx(-5)
    uneven = weights.where("node = 'A'")
    with pytest.raises(checks.CheckFailed, match="add up"):
        quality.checked_nodal_power(market, curve, cats, uneven, sites, by=S)


def test_merged_codes_follow_the_maps(spark):
    raw = spark.createDataFrame([("s", "m1", 0, "GM_1", "GConnection", "GM", "x", 1e6), ("s", "m2", 0, "HTLH_1", "GConnection", "HTLH", "x", 2e6)], RAW)
    raw = raw.withColumn("member_pos", F.substring("member", 2, 1).cast("int"))
    maps = [("electricity", "CH4_1", "g", 0), ("electricity", "GM_1", "e", 1), ("methane", "CH4_1", "g", 0), ("methane", "GM_1", "e", 1)]
    names = spark.createDataFrame(maps, "carrier string, raw_name string, grid_name string, row_idx int")
    assert rows(export.export_site_curves(raw, names, by=S), "asset", "site", "mw") == [("CH4_1", "g", 3.0)]
    # another methane map: nothing is merged, and the electricity names count for gas as well
    other = names.withColumn("grid_name", F.when(F.col("carrier") == "methane", F.lit("m")).otherwise(F.col("grid_name")))
    assert rows(export.export_site_curves(raw, other, by=S), "asset", "site", "mw") == [("GM_1", "e", 1.0)]


def test_profiles_keep_all_hours_and_checks_set_runs_aside(spark):
    curve = spark.range(9000).select(F.lit("long").alias("scenario_id"), F.col("id").cast("int").alias("hour"), F.lit("k").alias("market_key"), F.lit(1.0).alias("mw"))
    curve = curve.unionByName(curve.where("hour < 100").withColumn("scenario_id", F.lit("short")))
    curve = curve.unionByName(curve.where("scenario_id = 'long' and hour < 8760").withColumn("scenario_id", F.lit("full")))
    classes = spark.createDataFrame([("k", "Coal")], "market_key string, profile string")
    made = profiles.plant_profiles(curve, classes, S)
    assert rows(made.groupBy("scenario_id").count()) == [("full", 8760), ("long", 9000), ("short", 100)]
    good, bad = quality.checked_plant_profiles(curve, classes, by=S)
    assert rows(bad) == [("long", "series length", "9000"), ("short", "series length", "100")]
    assert rows(good.groupBy("scenario_id").count()) == [("full", 8760)]


def test_gas_runs_without_a_full_calendar_are_set_aside(spark):
    hour = spark.range(8760).select(F.col("id").cast("int").alias("hour"), F.lit("methane").alias("carrier"))
    curve = hour.select(F.lit("full").alias("scenario_id"), "carrier", "hour", F.lit("a").alias("site"), F.lit(1.0).alias("mw"))
    curve = curve.unionByName(curve.where("hour < 100").withColumn("scenario_id", F.lit("short")))
    market = hour.withColumn("scenario_id", F.lit("full")).unionByName(hour.where("hour < 100").withColumn("scenario_id", F.lit("short")))
    sites = spark.createDataFrame([("full", "methane", "a", "N"), ("short", "methane", "a", "N")], "scenario_id string, carrier string, site string, substation string")
    result, bad = quality.checked_gas_input(curve, sites, market, by=S)
    assert rows(bad) == [("short", "series length", "methane 100")]
    assert result.select("scenario_id").distinct().collect()[0][0] == "full" and result.where("node = 'N'").count() == 8760


def test_run_keys_are_strict(spark):
    facts = spark.createDataFrame([("s", "p", 0, "a", "methane", 1.0)], "scenario_id string, plan string, hour int, site string, carrier string, mw double")
    with pytest.raises(ValueError, match="told apart"):
        gas.hourly_balance(facts, S)
    with pytest.raises(ValueError, match="told apart"):
        gas.hourly_balance(facts.drop("scenario_id", "plan"), S)
    assert gas.hourly_balance(facts.drop("scenario_id", "plan"), ()).count() == 1
    assert gas.hourly_balance(facts, ("scenario_id", "plan")).count() == 1


def test_updates_without_an_order_must_be_single(spark):
    table = spark.createDataFrame([("k", "old")], "k string, b string")
    once = spark.createDataFrame([("k", "new")], "k string, b string")
    assert rows(scenarios.upsert(table, once, ["k"], ["b"])) == [("k", "new")]
    with pytest.raises(Exception, match="need an order"):
        scenarios.update_by_key(table, once.unionByName(once.withColumn("b", F.lit("x"))), ["k"], ["b"]).collect()


def test_station_exceptions_and_carriers_reach_the_checks(spark):
    market = spark.createDataFrame([("s", "d", h, 10.0) for h in range(2)] + [("s", "p", h, 10.0) for h in range(2)], "scenario_id string, market_key string, hour int, mw double")
    cats = spark.createDataFrame([("d", "Electricity", "Demand", "x"), ("p", "Electricity", "Supply", "x"), ("g", "Gas", "Demand", "gas only")],
                                 "market_key string, carrier string, product string, sector string")
    weights = spark.createDataFrame([("R1", "x", 1.0)], "node string, sector string, weight double")
    curve = spark.createDataFrame([("s", h, "w", 1.0) for h in range(2)], "scenario_id string, hour int, site string, mw double")
    sites = spark.createDataFrame([("s", "w", "A25", "x")], "scenario_id string, site string, substation string, sector string")
    buses = spark.createDataFrame([("B150",)], "short_name string")
    moved = spark.createDataFrame([("A", "B")], "station string, lifted_station string")
    power, bad = quality.checked_nodal_power(market, curve, cats, weights, sites, buses, station_exceptions=moved, by=S)
    assert rows(bad) == [] and rows(power.select("node").distinct()) == [("B150",), ("R1",)]
    power, bad = quality.checked_nodal_power(market, curve, cats, weights, sites, buses, exceptions="R9", by=S)
    assert rows(bad) == [("s", "exception node not in market", "R9"), ("s", "substation without bus", "A150")] and power.count() == 0
