"""Queries on plant and price profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.fixed import PLANT_CLASS_OF_CARRIER
from hourgrid.operators import profiles
from hourgrid.plans import views as v
from hourgrid.plans.registry import query
from hourgrid.plans.views import SCENARIO, define

# Market key of the test views -> plant class
CLASSES = {
    "view_0": "Power Plant Coal",
    "view_1": "Power Plant Coal",
    "click_0": "Power Plant Gas Large",
    "click_1": "Power Plant Gas Small",
    "purchase_0": "Power Plant Gas Small",
    "signup_0": "Power Plant Nuclear",
    "signup_1": "Power Plant Biomass",
    "error_0": "Power Plant Other",
}

define("plant_class", "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{c}')" for k, c in CLASSES.items()) + ") AS c(market_key, profile)")
define("plant_hour", """SELECT scenario_id, profile, hour, sum(mw) - 250 AS mw FROM market_curve m
    JOIN plant_class c ON m.market_key = c.market_key GROUP BY ALL""")
define("plant_share", """SELECT h.scenario_id, h.profile, h.hour,
    CASE WHEN peak = 0 THEN NULL WHEN mw / (peak * 1.1) = 0 THEN 0.0001 ELSE mw / (peak * 1.1) END AS value
    FROM plant_hour h JOIN (SELECT scenario_id, profile, max(mw) AS peak FROM plant_hour GROUP BY ALL) p
    ON h.scenario_id = p.scenario_id AND h.profile = p.profile""")
define("port_plant", """SELECT scenario_id, asset_id, min(asset_pos) AS asset_pos, arg_min(carrier_id, port_pos) AS first_carrier,
    min(CASE WHEN carrier_name = 'Electricity' THEN port_pos END) AS outlet FROM port GROUP BY ALL""")
define("carrier_class", "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{c}')" for k, c in PLANT_CLASS_OF_CARRIER.items()) + ") AS c(carrier_id, profile)")
define("port_class", """SELECT p.scenario_id, p.asset_id, p.asset_pos, i.carrier_id, c.profile FROM port_plant p
    JOIN (SELECT q.scenario_id, q.asset_id, arg_max(q.carrier_id, q.port_pos) AS carrier_id FROM port q
          JOIN port_plant o ON q.scenario_id = o.scenario_id AND q.asset_id = o.asset_id
          WHERE q.port_kind = 'in' AND q.port_pos <= o.outlet GROUP BY ALL) i
      ON p.scenario_id = i.scenario_id AND p.asset_id = i.asset_id
    JOIN carrier_class c ON i.carrier_id = c.carrier_id
    WHERE first_carrier IN (SELECT carrier_id FROM carrier_class) AND outlet IS NOT NULL""")


def _idle(spark, d):
    """Plant hours with the base load taken off, so that idle hours occur."""
    classes = profiles.lookup_table(spark, CLASSES, "market_key", "profile")
    sums = profiles.sum_by_class(v.market_curve(spark, d), classes, SCENARIO)
    return sums.withColumn("mw", F.col("mw") - 250)


@query("a1_sum_by_plant_class", "SELECT scenario_id, profile, hour, round(mw + 250, 4) + 0.0 AS mw FROM plant_hour")
def a1(spark, d):
    classes = profiles.lookup_table(spark, CLASSES, "market_key", "profile")
    return profiles.sum_by_class(v.market_curve(spark, d), classes, SCENARIO)


@query("a12_series_peak", "SELECT scenario_id, profile, round(max(mw), 4) + 0.0 AS peak FROM plant_hour GROUP BY ALL")
def a12(spark, d):
    return _idle(spark, d).groupBy("scenario_id", "profile").agg(F.max("mw").alias("peak"))


@query("w2_normalise", "SELECT scenario_id, profile, hour, round(value, 4) + 0.0 AS value FROM plant_share")
def w2(spark, d):
    return profiles.normalise(_idle(spark, d), by=SCENARIO)


_STAMP = "TIMESTAMP '2018-12-31 23:00:00' + to_hours(hour{}) AS {}"


@query("c13_plant_profiles", f"""SELECT h.scenario_id, h.profile, {_STAMP.format('', 'from_ts')}, {_STAMP.format(' + 1', 'to_ts')},
    round(CASE WHEN peak = 0 THEN NULL WHEN mw / (peak * 1.1) = 0 THEN 0.0001 ELSE mw / (peak * 1.1) END, 4) + 0.0 AS value
    FROM (SELECT scenario_id, profile, hour, mw + 250 AS mw FROM plant_hour) h
    JOIN (SELECT scenario_id, profile, max(mw) + 250 AS peak FROM plant_hour GROUP BY ALL) p
    ON h.scenario_id = p.scenario_id AND h.profile = p.profile""")
def c13(spark, d):
    classes = profiles.lookup_table(spark, CLASSES, "market_key", "profile")
    return profiles.plant_profiles(v.market_curve(spark, d), classes, SCENARIO)


@query("p26_profile_interval", f"SELECT scenario_id, hour, site, {_STAMP.format('', 'from_ts')}, {_STAMP.format(' + 1', 'to_ts')} FROM site_curve")
def p26(spark, d):
    from hourgrid.functions import time

    hour = F.col("hour")
    return v.site_curve(spark, d).select(
        "scenario_id", "hour", "site", time.profile_from(hour).alias("from_ts"), time.profile_to(hour).alias("to_ts")
    )


@query("c14_price_profile", f"""SELECT scenario_id, 'ElectricityPriceProfile' AS profile, {_STAMP.format('', 'from_ts')},
    {_STAMP.format(' + 1', 'to_ts')}, round(price, 4) + 0.0 AS value FROM price""")
def c14(spark, d):
    return profiles.price_profile(v.price(spark, d), SCENARIO)


@query("j14_assign_profiles", """SELECT a.scenario_id, a.asset_id, a.asset_pos, a.carrier_id, a.profile,
    CASE WHEN a.asset_pos = o.pos THEN 'profile' ELSE 'reference' END AS link FROM port_class a
    JOIN (SELECT scenario_id, profile, min(asset_pos) AS pos FROM port_class GROUP BY ALL) o
    ON a.scenario_id = o.scenario_id AND a.profile = o.profile""")
def j14(spark, d):
    return profiles.assign_profiles(v.port(spark, d), by=SCENARIO)


@query("w7_profile_owner", """SELECT scenario_id, profile, min(asset_pos) AS asset_pos, CAST(count(*) AS BIGINT) AS n_assets
    FROM port_class GROUP BY ALL""")
def w7(spark, d):
    links = j14(spark, d)
    owner = F.min(F.when(F.col("link") == "profile", F.col("asset_pos"))).alias("asset_pos")
    return links.groupBy("scenario_id", "profile").agg(owner, F.count("*").alias("n_assets"))


@query("snk6_nested_profile", """SELECT scenario_id, profile, CAST(count(*) AS INTEGER) AS n_elements,
    min(TIMESTAMP '2018-12-31 23:00:00' + to_hours(hour)) AS first_from, round(arg_min(price, hour), 4) + 0.0 AS first_value
    FROM (SELECT *, 'ElectricityPriceProfile' AS profile FROM price) GROUP BY ALL""")
def snk6(spark, d):
    nested = profiles.nest_profile(c14(spark, d), SCENARIO)
    first = F.col("elements")[0]
    return nested.select(
        "scenario_id", "profile", F.size("elements").alias("n_elements"), first["from_ts"].alias("first_from"),
        first["value"].alias("first_value"),
    )
