"""Queries on gas curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.operators import gas
from hourgrid.plans import views as v
from hourgrid.plans.registry import query
from hourgrid.plans.views import CALENDAR, NETWORK, SCENARIO, define

SLACK = """CASE WHEN carrier = 'methane' THEN CASE site WHEN 'CH4Export_Per' THEN -least(r, 0) WHEN 'CH4Import_Wijngaarden' THEN -greatest(r, 0) END
    ELSE CASE site WHEN 'ExportH2_Per' THEN -least(r, 0) WHEN 'ImportH2_MV' THEN -greatest(r, 0) END END"""

define("gas_hour", "SELECT scenario_id, carrier, hour, sum(mw) AS r FROM gas_curve GROUP BY ALL")
define("gas_balanced", f"""SELECT scenario_id, carrier, hour, site, sum(mw) AS mw FROM (
    SELECT scenario_id, carrier, hour, site, mw FROM gas_curve
    UNION ALL SELECT scenario_id, carrier, hour, site, {SLACK} FROM (
        SELECT g.*, s.site FROM gas_hour g JOIN (VALUES ('methane', 'CH4Export_Per'), ('methane', 'CH4Import_Wijngaarden'),
            ('hydrogen', 'ExportH2_Per'), ('hydrogen', 'ImportH2_MV')) AS s(c, site) ON g.carrier = s.c)) GROUP BY ALL""")
define("gas_length", f"SELECT scenario_id, carrier, max(hour) + 1 AS n FROM gas_curve WHERE hour < {CALENDAR} GROUP BY ALL")
define("gas_fitted", f"""SELECT scenario_id, carrier, site, hour, mw FROM gas_curve WHERE hour < {CALENDAR}
    UNION ALL SELECT c.scenario_id, c.carrier, site, CAST(h AS INTEGER), mw FROM gas_curve c
    JOIN gas_length l ON c.scenario_id = l.scenario_id AND c.carrier = l.carrier AND c.hour = l.n - 1
    JOIN market_length m ON c.scenario_id = m.scenario_id AND c.carrier = m.carrier
    JOIN range({CALENDAR}) AS k(h) ON h >= n WHERE n < market_hours AND n < {CALENDAR}""")
define("gas_listed", "SELECT * FROM gas_site WHERE substation IS NOT NULL")
define("gas_nodes", """SELECT c.scenario_id, network_id, c.carrier, hour, substation AS node, sum(mw) AS mw
    FROM gas_curve c JOIN gas_listed s ON c.scenario_id = s.scenario_id AND c.carrier = s.carrier AND c.site = s.site GROUP BY ALL""")
define("gas_folded", """SELECT scenario_id, network_id, carrier, hour, node, sum(mw) AS mw FROM (
    SELECT c.scenario_id, network_id, c.carrier, hour, substation AS node, mw
    FROM gas_fitted c JOIN gas_listed s ON c.scenario_id = s.scenario_id AND c.carrier = s.carrier AND c.site = s.site
    UNION ALL SELECT c.scenario_id, network_id, c.carrier, CAST(h AS INTEGER), CASE WHEN c.carrier = 'methane' THEN 'BAL_M' ELSE 'BAL_H' END, 0
    FROM (SELECT scenario_id, carrier, max(hour) + 1 AS n FROM gas_fitted GROUP BY ALL) c JOIN range(100000) AS k(h) ON h < n
    JOIN (SELECT DISTINCT scenario_id, network_id, carrier FROM gas_listed) s ON c.scenario_id = s.scenario_id AND c.carrier = s.carrier)
    GROUP BY ALL""")


@query("a9_hourly_balance", "SELECT scenario_id, carrier, hour, round(r, 4) + 0.0 AS residual FROM gas_hour")
def a9(spark, d):
    return gas.hourly_balance(v.gas_curve(spark, d), SCENARIO)


@query("c7_balance_on_slack", "SELECT scenario_id, carrier, hour, site, round(mw, 4) + 0.0 AS mw FROM gas_balanced")
def c7(spark, d):
    return gas.balance_on_slack(v.gas_curve(spark, d), by=SCENARIO)


@query("w4_fit_calendar", "SELECT scenario_id, carrier, site, hour, round(mw, 4) + 0.0 AS mw FROM gas_fitted")
def w4(spark, d):
    return gas.fit_calendar(v.gas_curve(spark, d), v.market_length(spark, d), CALENDAR, SCENARIO)


@query("w4_cut_to_calendar", "SELECT scenario_id, carrier, site, hour, round(mw, 4) + 0.0 AS mw FROM gas_curve WHERE hour < 2000")
def w4_cut(spark, d):
    """A calendar shorter than the data: hours beyond it are cut."""
    return gas.fit_calendar(v.gas_curve(spark, d), v.market_length(spark, d), 2000, SCENARIO)


@query("p15_clean_sites", "SELECT * FROM gas_listed")
def p15(spark, d):
    return gas.clean_sites(v.gas_site(spark, d))


@query("a5_gas_site_power", "SELECT scenario_id, network_id, carrier, hour, node, round(mw, 4) + 0.0 AS mw FROM gas_nodes")
def a5(spark, d):
    return gas.site_power(v.gas_curve(spark, d), gas.clean_sites(v.gas_site(spark, d)), NETWORK)


@query("a5_gas_demand_supply", """SELECT scenario_id, network_id, carrier, hour, node, round(greatest(mw, 0), 4) + 0.0 AS demand,
    round(greatest(-mw, 0), 4) + 0.0 AS supply FROM gas_nodes""")
def a5_products(spark, d):
    return gas.demand_supply(a5(spark, d))


@query("c6_nodal_power_gas", "SELECT scenario_id, network_id, carrier, hour, node, round(-mw, 4) + 0.0 AS power FROM gas_nodes")
def c6(spark, d):
    return gas.nodal_power_gas(v.gas_curve(spark, d), gas.clean_sites(v.gas_site(spark, d)), NETWORK)


@query("a10_fold_balance_sites", "SELECT scenario_id, network_id, carrier, hour, node, round(mw, 4) + 0.0 AS mw FROM gas_folded")
def a10(spark, d):
    lengths = gas.fitted_length(v.gas_curve(spark, d), v.market_length(spark, d), CALENDAR, SCENARIO)
    return gas.fold_balance_sites(w4(spark, d), gas.clean_sites(v.gas_site(spark, d)), lengths, by=NETWORK)


@query("c8_gas_model_input", """SELECT scenario_id, network_id, carrier, node, round(-mw, 4) + 0.0 AS power,
    CAST(hour // 24 + 1 AS INTEGER) AS dag, CAST(hour % 24 + 1 AS INTEGER) AS uur FROM gas_folded""")
def c8(spark, d):
    return gas.gas_model_input(
        v.gas_curve(spark, d), v.gas_site(spark, d), v.market_length(spark, d), CALENDAR, by=NETWORK
    )


@query("c8_balanced_gas_model_input", """SELECT c.scenario_id, network_id, c.carrier, substation AS node, round(-sum(mw), 4) + 0.0 AS power,
    CAST(hour // 24 + 1 AS INTEGER) AS dag, CAST(hour % 24 + 1 AS INTEGER) AS uur
    FROM gas_balanced c JOIN gas_listed s ON c.scenario_id = s.scenario_id AND c.carrier = s.carrier AND c.site = s.site GROUP BY ALL""")
def c8_balanced(spark, d):
    balanced = gas.balance_on_slack(v.gas_curve(spark, d), by=SCENARIO)
    return gas.time_keys(gas.nodal_power_gas(balanced, gas.clean_sites(v.gas_site(spark, d)), NETWORK)).drop("hour")


@query("p27_time_keys", """SELECT scenario_id, hour, site, CAST(hour // 24 + 1 AS INTEGER) AS dag, CAST(hour % 24 + 1 AS INTEGER) AS uur FROM site_curve""")
def p27(spark, d):
    return gas.time_keys(v.site_curve(spark, d).select("scenario_id", "hour", "site"))


@query("j12_gases_by_time_key", """SELECT scenario_id, hour, round(sum(CASE WHEN carrier = 'methane' THEN r END), 4) + 0.0 AS methane,
    round(sum(CASE WHEN carrier = 'hydrogen' THEN r END), 4) + 0.0 AS hydrogen FROM gas_hour GROUP BY ALL""")
def j12(spark, d):
    side = lambda c: F.sum(F.when(F.col("carrier") == c, F.col("residual"))).alias(c)
    return a9(spark, d).groupBy("scenario_id", "hour").agg(side("methane"), side("hydrogen"))
