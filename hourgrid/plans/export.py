"""Queries on routing raw asset series to carriers."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.fixed import CO2_CARRIERS, GAS_CODES, HYDROGEN_ASSETS, HYDROGEN_CARRIERS, METHANE_ASSETS, METHANE_CARRIERS
from hourgrid.functions import power, text
from hourgrid.operators import export
from hourgrid.plans import views as v
from hourgrid.plans.registry import query
from hourgrid.plans.views import SCENARIO, define


def _any(col: str, codes: list[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, '{c}')" for c in codes) + ")"


define("member_fact", f"""SELECT scenario_id, member, arg_min("assetClass", row_idx) AS member_class,
    bool_or({_any('"assetName"', METHANE_ASSETS)}) AS has_methane_asset FROM asset_row GROUP BY ALL""")
define("routed", " UNION ALL ".join(
    f"""SELECT a.scenario_id, a.member, member_pos, row_idx, "assetName", "carrierId", sector, "allocationPower" / 1e6 AS mw, '{carrier}' AS carrier
    FROM asset_row a JOIN member_fact m ON a.scenario_id = m.scenario_id AND a.member = m.member WHERE {rule}"""
    for carrier, rule in {
        "electricity": "contains(member_class, 'EConnection')",
        "methane": f"""(contains(member_class, 'GConnection') AND {_any('"carrierId"', METHANE_CARRIERS)})
            OR (NOT contains(member_class, 'GConnection') AND {_any('"assetName"', METHANE_ASSETS)})""",
        "hydrogen": f"""(contains(member_class, 'GConnection') AND {_any('"carrierId"', HYDROGEN_CARRIERS)})
            OR (NOT contains(member_class, 'GConnection') AND NOT has_methane_asset AND {_any('"assetName"', HYDROGEN_ASSETS)})""",
        "co2": f"""contains(member_class, 'GConnection') AND {_any('"carrierId"', CO2_CARRIERS)}""",
    }.items()))
define("numbered", """SELECT *, CAST(row_number() OVER (PARTITION BY scenario_id, carrier, member, "assetName", "carrierId" ORDER BY row_idx) - 1 AS INTEGER) AS hour
    FROM routed""")
define("first_length", """SELECT scenario_id, carrier, arg_min(n, rk) AS lim FROM (
    SELECT *, row_number() OVER (PARTITION BY scenario_id, carrier ORDER BY member_pos, first_idx) AS rk FROM (
    SELECT scenario_id, carrier, member, member_pos, "assetName", "carrierId", count(*) AS n, min(row_idx) AS first_idx FROM numbered GROUP BY ALL))
    GROUP BY ALL""")
define("aligned", """SELECT n.* FROM numbered n JOIN first_length f ON n.scenario_id = f.scenario_id AND n.carrier = f.carrier WHERE hour < lim""")
define("last_name", "SELECT raw_name, arg_max(grid_name, row_idx) AS grid_name FROM site_name GROUP BY ALL")


def unified(col: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({col}, '{c}') THEN replace({col}, '{c}', 'CH4')" for c in GAS_CODES) + f" ELSE {col} END"


@query("p4_route_carriers", """SELECT scenario_id, member, row_idx, "assetName", "carrierId", sector, round(mw, 4) + 0.0 AS mw, carrier FROM routed""")
def p4(spark, d):
    return export.route(v.asset_row(spark, d), SCENARIO).drop("member_pos")


@query("p32_member_class", """SELECT scenario_id, member, contains(member_class, 'EConnection') AS is_electricity,
    contains(member_class, 'GConnection') AS is_gas, has_methane_asset FROM member_fact""")
def p32(spark, d):
    return export.member_facts(v.asset_row(spark, d), SCENARIO)


@query("p1_watt_to_megawatt", """SELECT scenario_id, member, row_idx, round("allocationPower" / 1e6, 4) + 0.0 AS mw FROM asset_row""")
def p1(spark, d):
    return v.asset_row(spark, d).select("scenario_id", "member", "row_idx", power.watt_to_megawatt(F.col("allocationPower")).alias("mw"))


@query("p5_contains_any", f"""SELECT scenario_id, member, row_idx, {_any('"carrierId"', METHANE_CARRIERS)} AS methane FROM asset_row""")
def p5(spark, d):
    return v.asset_row(spark, d).select(
        "scenario_id", "member", "row_idx", text.contains_any(F.col("carrierId"), METHANE_CARRIERS).alias("methane")
    )


@query("p6_unify_gas_code", f"""SELECT DISTINCT "assetName", {unified('"assetName"')} AS unified FROM asset_row""")
def p6(spark, d):
    return v.asset_row(spark, d).select("assetName", text.unify_gas_code(F.col("assetName")).alias("unified")).distinct()


@query("w6_row_position_as_hour", """SELECT scenario_id, carrier, member, row_idx, "assetName", "carrierId", hour FROM numbered""")
def w6(spark, d):
    numbered = export.number_hours(export.targets(v.asset_row(spark, d), SCENARIO), SCENARIO)
    rows = export.one_row_per_carrier(numbered)
    return rows.select("scenario_id", "carrier", "member", "row_idx", "assetName", "carrierId", "hour")


def _series(spark, d):
    rows = export.targets(v.asset_row(spark, d), SCENARIO)
    return export.one_row_per_carrier(export.number_hours(rows, SCENARIO))


@query("j16_longer_than_first", """SELECT n.scenario_id, n.carrier, n.member, n."assetName", n."carrierId", count(*) - any_value(lim) AS rows_lost
    FROM numbered n JOIN first_length f ON n.scenario_id = f.scenario_id AND n.carrier = f.carrier GROUP BY n.scenario_id, n.carrier, n.member,
    n."assetName", n."carrierId" HAVING count(*) > any_value(lim)""")
def j16_cut(spark, d):
    return export.longer_than_first(_series(spark, d), SCENARIO)


@query("j16_align_to_first_series", """SELECT scenario_id, carrier, member, row_idx, "assetName", "carrierId", hour FROM aligned""")
def j16(spark, d):
    aligned = export.align_to_first(_series(spark, d), SCENARIO)
    return aligned.select("scenario_id", "carrier", "member", "row_idx", "assetName", "carrierId", "hour")


@query("c1_export_site_curves", """SELECT scenario_id, carrier, "assetName" AS asset, grid_name AS site, hour, round(mw, 4) + 0.0 AS mw
    FROM aligned a LEFT JOIN last_name n ON a."assetName" = n.raw_name
    WHERE carrier <> 'co2' AND (grid_name IS NOT NULL OR carrier = 'electricity')""")
def c1(spark, d):
    return export.export_site_curves(v.asset_row(spark, d), v.site_name(spark, d), by=SCENARIO)


@query("a2_sum_by_renamed_asset", f"""SELECT scenario_id, carrier, asset, grid_name AS site, hour, round(mw, 4) + 0.0 AS mw FROM (
    SELECT scenario_id, carrier, {unified('"assetName"')} AS asset, hour, sum(mw) AS mw FROM aligned WHERE carrier <> 'co2' GROUP BY ALL) a
    LEFT JOIN last_name n ON a.asset = n.raw_name WHERE grid_name IS NOT NULL OR carrier = 'electricity'""")
def a2(spark, d):
    return export.export_site_curves(v.asset_row(spark, d), v.site_name(spark, d), True, SCENARIO)


@query("p9_co2_streams", """SELECT scenario_id, member, row_idx, "assetName", sector, round(mw, 4) + 0.0 AS mw, stream FROM routed
    JOIN (VALUES ('CO2_F'), ('CO2_B'), ('CO2_P')) AS s(stream) ON contains("assetName", stream) WHERE carrier = 'co2'""")
def p9(spark, d):
    return export.co2_streams(v.asset_row(spark, d), SCENARIO)


@query("src5_latest_names", "SELECT raw_name, grid_name FROM last_name")
def src5(spark, d):
    return export.latest_names(v.site_name(spark, d), SCENARIO)


@query("a13_distinct_assets", """SELECT DISTINCT scenario_id, "assetName", "carrierId" FROM asset_row""")
def a13(spark, d):
    return v.asset_row(spark, d).select("scenario_id", "assetName", "carrierId").distinct()


@query("p7_name_sites", """SELECT scenario_id, member, row_idx, carrier, "assetName" AS asset, grid_name AS site FROM routed r
    LEFT JOIN last_name n ON r."assetName" = n.raw_name WHERE grid_name IS NOT NULL OR carrier = 'electricity'""")
def p7(spark, d):
    rows = p4(spark, d).select("scenario_id", "member", "row_idx", "carrier", F.col("assetName").alias("asset"))
    named = export.name_sites(rows, v.site_name(spark, d), SCENARIO)
    return named.select("scenario_id", "member", "row_idx", "carrier", "asset", "site")


@query("p8_unnamed_series", """SELECT scenario_id, carrier, CAST(count(*) AS BIGINT) AS n, CAST(count(grid_name) AS BIGINT) AS named
    FROM routed r LEFT JOIN last_name n ON r."assetName" = n.raw_name WHERE grid_name IS NOT NULL OR carrier = 'electricity' GROUP BY ALL""")
def p8(spark, d):
    return p7(spark, d).groupBy("scenario_id", "carrier").agg(F.count("*").alias("n"), F.count("site").alias("named"))


@query("o3_first_match", """SELECT scenario_id, member, min(row_idx) AS row_idx FROM asset_row
    WHERE contains("assetName", 'CO2_F') OR contains("assetName", 'GM') GROUP BY ALL""")
def o3(spark, d):
    found = v.asset_row(spark, d).where(text.contains_any(F.col("assetName"), ["CO2_F", "GM"]))
    return found.groupBy("scenario_id", "member").agg(F.min("row_idx").alias("row_idx"))
