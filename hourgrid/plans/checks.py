"""Queries of the data-quality checks; the inputs are chosen so that every check finds something."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.operators import checks, curves, profiles, quality
from hourgrid.plans import views as v
from hourgrid.plans.profiles import CLASSES
from hourgrid.plans.registry import query
from hourgrid.plans.views import NETWORK, SCENARIO, define

define("known_site", "SELECT scenario_id, CAST(s_suppkey + 3 AS VARCHAR) AS site FROM supplier, (VALUES ('F'), ('O')) AS sc(scenario_id)")
define("region_site", """SELECT scenario_id, CAST(s_suppkey AS VARCHAR) AS site, 'R' || s_nationkey AS substation,
    'Sector ' || (s_suppkey % 5) AS sector FROM supplier, (VALUES ('F'), ('O')) AS sc(scenario_id)""")
define("region_node", """SELECT DISTINCT c.scenario_id, substation AS node FROM site_curve c
    JOIN region_site s ON c.scenario_id = s.scenario_id AND c.site = s.site""")


def _shifted_sites(spark, d):
    return v.table(spark, d, "supplier").select(
        F.explode(F.array(*[F.lit(s) for s in v.SCENARIOS])).alias("scenario_id"), (F.col("s_suppkey") + 3).cast("string").alias("site")
    )


def _region_sites(spark, d):
    return v.table(spark, d, "supplier").select(
        F.explode(F.array(*[F.lit(s) for s in v.SCENARIOS])).alias("scenario_id"), F.col("s_suppkey").cast("string").alias("site"),
        F.concat(F.lit("R"), F.col("s_nationkey").cast("string")).alias("substation"),
        F.concat(F.lit("Sector "), (F.col("s_suppkey") % 5).cast("string")).alias("sector"),
    )


@query("v1_curve_mapping", """SELECT scenario_id, site, 'mapping' AS missing_in FROM
      (SELECT DISTINCT scenario_id, site FROM site_curve) c WHERE NOT EXISTS (SELECT 1 FROM known_site k WHERE k.scenario_id = c.scenario_id AND k.site = c.site)
    UNION ALL SELECT scenario_id, site, 'curves' FROM known_site k
      WHERE NOT EXISTS (SELECT 1 FROM site_curve c WHERE k.scenario_id = c.scenario_id AND k.site = c.site)""")
def v1(spark, d):
    return checks.curve_mapping(v.site_curve(spark, d), _shifted_sites(spark, d), "site", SCENARIO)


@query("v2_sectors_without_weights", """SELECT DISTINCT scenario_id, event_type AS sector FROM
    (SELECT CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'O' END AS scenario_id, event_type FROM events)
    WHERE event_type NOT IN ('view', 'click')""")
def v2(spark, d):
    curves_ = v.table(spark, d, "events").select(
        F.when(F.col("user_id") % 2 == 0, F.lit("F")).otherwise(F.lit("O")).alias("scenario_id"), F.col("event_type").alias("sector")
    )
    weights = v.table(spark, d, "region").select(F.explode(F.array(F.lit("view"), F.lit("click"))).alias("sector"), F.lit(0.2).alias("weight"))
    return checks.sectors_without_weights(curves_, weights, SCENARIO)


@query("v3_weight_sums", """SELECT 'Region ' || n_regionkey AS sector, round(sum(w), 3) + 0.0 AS total FROM
    (SELECT n_regionkey, 0.2::DOUBLE + CASE WHEN n_nationkey < 3 THEN 0.0004 * n_nationkey ELSE 0 END AS w FROM nation)
    GROUP BY ALL HAVING round(sum(w), 3) <> 1""")
def v3(spark, d):
    extra = F.when(F.col("n_nationkey") < 3, F.lit(0.0004) * F.col("n_nationkey")).otherwise(0.0)
    weights = v.table(spark, d, "nation").select(
        F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("sector"), (F.lit(0.2) + extra).alias("weight")
    )
    return checks.weight_sums(weights, SCENARIO)


@query("v4_element_mismatch", """SELECT coalesce(f.network_id, n.network_id) AS network_id, coalesce(f.element_type, n.element_type) AS element_type,
    coalesce(f.element_id, n.element_id) AS element_id, f.element_id IS NOT NULL AS in_flow, n.element_id IS NOT NULL AS in_network
    FROM (SELECT DISTINCT network_id, element_type, element_id FROM element_flow) f
    FULL OUTER JOIN (SELECT network_id, 'line' AS element_type, element_id + 5 AS element_id FROM line
        UNION ALL SELECT network_id, 'trafo', element_id + 7 FROM trafo) n
    ON f.network_id = n.network_id AND f.element_type = n.element_type AND f.element_id = n.element_id
    WHERE f.element_id IS NULL OR n.element_id IS NULL""")
def v4(spark, d):
    side = lambda table, kind, shift: table.select(
        "network_id", F.lit(kind).alias("element_type"), (F.col("element_id") + shift).alias("element_id")
    )
    elements = side(v.line(spark, d), "line", 5).unionByName(side(v.trafo(spark, d), "trafo", 7))
    return checks.element_mismatch(v.element_flow(spark, d), elements, NETWORK)


@query("v5_unknown_substations", """SELECT DISTINCT scenario_id, substation FROM site WHERE substation NOT IN (SELECT short_name FROM bus)""")
def v5(spark, d):
    return checks.unknown_substations(v.site(spark, d), v.bus(spark, d), SCENARIO)


@query("v6_unreadable_voltage", """SELECT scenario_id, site, substation FROM
    (SELECT scenario_id, site, CASE WHEN substation LIKE '%150' THEN substation ELSE left(substation, 2) END AS substation FROM site)
    WHERE regexp_extract(substation, '^([a-zA-Z]*)([0-9]*)(.*)$', 2) = ''""")
def v6(spark, d):
    short = F.when(F.col("substation").endswith("150"), F.col("substation")).otherwise(F.substring("substation", 1, 2))
    return checks.unreadable_voltage(v.site(spark, d).withColumn("substation", short), SCENARIO)


@query("v7_overlapping_nodes", """SELECT scenario_id, node FROM region_node WHERE node IN (SELECT node FROM weights) AND node <> 'R4'""")
def v7(spark, d):
    market = curves.regional_market_curves(v.market_curve(spark, d), v.categories(spark, d), v.weights(spark, d), by=SCENARIO)
    simulated = curves.net_by_sector(v.site_curve(spark, d), _region_sites(spark, d), SCENARIO)
    return checks.overlapping_nodes(market, simulated, ["R4"], SCENARIO)


@query("v8_unknown_exceptions", """SELECT scenario_id, node FROM (SELECT DISTINCT scenario_id FROM market_curve) s,
    (VALUES ('R4'), ('HICx'), ('R9')) AS e(node) WHERE node NOT IN (SELECT node FROM weights)""")
def v8(spark, d):
    market = curves.regional_market_curves(v.market_curve(spark, d), v.categories(spark, d), v.weights(spark, d), by=SCENARIO)
    return checks.unknown_exceptions(market, ["R4", "HICx", "R9"], SCENARIO)


@query("v9_hourly_totals", """SELECT e.scenario_id, e.hour, e.product, round(e.m, 4) + 0.0 AS market_mw, round(x.s, 4) + 0.0 AS simulated_mw,
    round(e.m - x.s, 9) >= 0 AS discountable
    FROM (SELECT scenario_id, hour, product, sum(mw) AS m FROM market_node GROUP BY ALL) e
    JOIN (SELECT scenario_id, hour, product, sum(mw) AS s FROM site_node GROUP BY ALL) x
      ON e.scenario_id = x.scenario_id AND e.hour = x.hour AND e.product = x.product""")
def v9(spark, d):
    market = curves.regional_market_curves(v.market_curve(spark, d), v.categories(spark, d), v.weights(spark, d), by=SCENARIO)
    return checks.hourly_totals(market, curves.nodal_sector_curves(v.site_curve(spark, d), v.site(spark, d), by=SCENARIO), SCENARIO)


@query("v10_sectors_not_in_market", """SELECT DISTINCT c.scenario_id, product, sector FROM site_curve c
    JOIN region_site s ON c.scenario_id = s.scenario_id AND c.site = s.site, (VALUES ('Demand'), ('Supply')) AS p(product)
    WHERE sector NOT IN (SELECT sector FROM categories)""")
def v10(spark, d):
    market = curves.categorise(v.market_curve(spark, d), v.categories(spark, d), by=SCENARIO)
    simulated = curves.split_products(curves.net_by_sector(v.site_curve(spark, d), _region_sites(spark, d), SCENARIO))
    return checks.sectors_not_in_market(market, simulated, SCENARIO)


@query("v11_series_length", """SELECT scenario_id, CAST(count(DISTINCT hour) AS BIGINT) AS n_hours FROM site_curve
    GROUP BY ALL HAVING count(DISTINCT hour) <> 8760""")
def v11(spark, d):
    return checks.series_length(v.site_curve(spark, d), by=SCENARIO)


@query("v12_scenarios_without_prices", """SELECT 'U' || (c_custkey + 20) AS scenario_id FROM customer
    WHERE c_custkey + 20 NOT IN (SELECT o_custkey FROM orders)""")
def v12(spark, d):
    ids = lambda t, key: v.table(spark, d, t).select(F.concat(F.lit("U"), key.cast("string")).alias("scenario_id"))
    return checks.scenarios_without_prices(
        ids("customer", F.col("c_custkey") + 20), ids("orders", F.col("o_custkey")), SCENARIO
    )


@query("v14_duplicate_site_hours", """SELECT l_linestatus AS scenario_id, 'L' || l_suppkey AS site,
    CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS hour, CAST(count(*) AS BIGINT) AS n_rows
    FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def v14(spark, d):
    rows = v.table(spark, d, "lineitem").select(
        F.col("l_linestatus").alias("scenario_id"), F.concat(F.lit("L"), F.col("l_suppkey").cast("string")).alias("site"),
        v._ship_day().alias("hour"),
    )
    return checks.duplicate_site_hours(rows, SCENARIO)


@query("v_quarantine", """SELECT "scenarioUuid", CAST(count(*) AS BIGINT) AS n FROM (SELECT 'U' || o_custkey AS "scenarioUuid", o_custkey FROM orders)
    WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) GROUP BY ALL""")
def quarantine(spark, d):
    orders = v.table(spark, d, "orders").select(
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("scenarioUuid"), "o_totalprice"
    )
    passed = checks.quarantine(orders, orders.where(F.col("o_totalprice") > 400000), ["scenarioUuid"])
    return passed.groupBy("scenarioUuid").agg(F.count("*").alias("n"))


@query("v_electricity_offenders", """SELECT scenario_id, 'market key without category' AS "check", market_key AS item FROM
        (SELECT DISTINCT scenario_id, market_key FROM market_curve) WHERE market_key NOT IN (SELECT market_key FROM categories WHERE category <> 'Flex')
    UNION ALL SELECT scenario_id, 'curve without site', site FROM (SELECT DISTINCT scenario_id, site FROM site_curve) c
        WHERE NOT EXISTS (SELECT 1 FROM shifted_site k WHERE k.scenario_id = c.scenario_id AND k.site = c.site)
    UNION ALL SELECT scenario_id, 'site without curve', site FROM shifted_site k
        WHERE NOT EXISTS (SELECT 1 FROM site_curve c WHERE k.scenario_id = c.scenario_id AND k.site = c.site)
    UNION ALL SELECT DISTINCT c.scenario_id, 'sector not in market', p.product || ' ' || sector FROM (SELECT DISTINCT scenario_id, site FROM site_curve) c
        JOIN (SELECT scenario_id, CAST(CAST(site AS BIGINT) + 3 AS VARCHAR) AS site, sector FROM site) k ON k.scenario_id = c.scenario_id AND k.site = c.site,
        (VALUES ('Demand'), ('Supply')) AS p(product)
        WHERE (p.product, sector) NOT IN (SELECT (product, sector) FROM categories WHERE category <> 'Flex')
    UNION ALL SELECT DISTINCT scenario_id, 'substation without bus', replace(substation, 'N', 'Q') FROM lifted_site""")
def electricity(spark, d):
    sites = v.site(spark, d).withColumns(
        {"site": (F.col("site").cast("bigint") + 3).cast("string"), "substation": F.replace("substation", F.lit("N"), F.lit("Q"))}
    )
    known = v.categories(spark, d).where(F.col("category") != "Flex")
    return quality.electricity_offenders(v.market_curve(spark, d), v.site_curve(spark, d), known, sites, v.bus(spark, d), by=SCENARIO)


define("shifted_site", "SELECT scenario_id, CAST(CAST(site AS BIGINT) + 3 AS VARCHAR) AS site FROM site")

# checked stages: scenario O passes, scenario F (network 0001) has faults put in


def _half_sites(spark, d):
    """Sites with one left out in scenario F."""
    return v.site(spark, d).where(~((F.col("scenario_id") == "F") & (F.col("site") == "7")))


def _full_categories(spark, d):
    """Categories in which every sector has both products."""
    return v.categories(spark, d).unionByName(
        v.categories(spark, d).where("market_key = 'click_0'").withColumns({"market_key": F.lit("error_2"), "product": F.lit("Supply")})
    )


def _checked_electricity(spark, d):
    market = v.market_curve(spark, d)
    extra = market.where("market_key = 'click_0'").withColumn("market_key", F.lit("error_2"))
    return quality.checked_nodal_power(
        market.unionByName(extra), v.site_curve(spark, d), _full_categories(spark, d), v.weights(spark, d), _half_sites(spark, d),
        exceptions="R4", by=SCENARIO,
    )


@query("q_electricity_offenders", """SELECT 'F' AS scenario_id, 'curve without site' AS "check", '7' AS item
    WHERE EXISTS (SELECT 1 FROM site_curve WHERE scenario_id = 'F' AND site = '7')""")
def q_electricity_offenders(spark, d):
    return _checked_electricity(spark, d)[1]


@query("q_electricity_runs", """SELECT DISTINCT scenario_id FROM site_curve
    WHERE scenario_id <> 'F' OR NOT EXISTS (SELECT 1 FROM site_curve WHERE scenario_id = 'F' AND site = '7')""")
def q_electricity_runs(spark, d):
    return _checked_electricity(spark, d)[0].select("scenario_id").distinct()


def _gas_market(spark, d):
    """Gas market curves: in scenario F the hydrogen market is as short as the sites', so nothing is padded."""
    hours = F.when(F.col("carrier") == "methane", F.col("market_hours")).otherwise(F.when(F.col("scenario_id") == "F", 10).otherwise(v.CALENDAR))
    return v.market_length(spark, d).select("scenario_id", "carrier", F.explode(F.sequence(F.lit(0), hours - 1)).alias("hour"))


define("gas_bad", f"""SELECT scenario_id, carrier, n FROM gas_length WHERE scenario_id = 'F' AND carrier = 'hydrogen' AND n <> {v.CALENDAR}""")


@query("q_gas_offenders", """SELECT scenario_id, 'series length' AS "check", 'hydrogen ' || n AS item FROM gas_bad""")
def q_gas_offenders(spark, d):
    return quality.checked_gas_input(v.gas_curve(spark, d), v.gas_site(spark, d), _gas_market(spark, d), v.CALENDAR, NETWORK)[1]


@query("q_gas_hours", f"""SELECT g.scenario_id, network_id, carrier, CAST({v.CALENDAR} AS BIGINT) AS n_hours FROM (SELECT DISTINCT scenario_id, carrier FROM gas_curve) g
    JOIN (SELECT DISTINCT network_id FROM gas_site) ON true WHERE scenario_id NOT IN (SELECT scenario_id FROM gas_bad)""")
def q_gas_hours(spark, d):
    result, _ = quality.checked_gas_input(v.gas_curve(spark, d), v.gas_site(spark, d), _gas_market(spark, d), v.CALENDAR, NETWORK)
    hours = result.groupBy("scenario_id", "network_id", "carrier").agg(F.count_distinct("dag", "uur").alias("n_hours"))
    return hours


def _flows(spark, d):
    """In network 0001 two elements are numbered out of the network."""
    out = (F.col("network_id") == "0001") & F.col("element_id").isin(3, 4) & (F.col("element_type") == "line")
    return v.element_flow(spark, d).withColumn("element_id", F.when(out, F.col("element_id") + 10**9).otherwise(F.col("element_id")))


def _with_flow(spark, d, kind, table):
    """Network elements that have a flow."""
    seen = v.element_flow(spark, d).where(F.col("element_type") == kind).select("network_id", "element_id").distinct()
    return table.join(seen, ["network_id", "element_id"], "left_semi")


def _checked_overload(spark, d):
    lines, trafos = _with_flow(spark, d, "line", v.line(spark, d)), _with_flow(spark, d, "trafo", v.trafo(spark, d))
    return quality.checked_network_overload(_flows(spark, d), lines, trafos, v.bus(spark, d), NETWORK)


define("moved_line", """SELECT DISTINCT f.element_id FROM element_flow f JOIN line l ON f.network_id = l.network_id AND f.element_id = l.element_id
    WHERE f.network_id = '0001' AND element_type = 'line' AND f.element_id IN (3, 4)""")


@query("q_overload_offenders", """SELECT CAST(NULL AS VARCHAR) AS scenario_id, '0001' AS network_id, 'element mismatch' AS "check",
    'line ' || (element_id + 1000000000) || ' not in network' AS item FROM moved_line
    UNION ALL SELECT NULL, '0001', 'element mismatch', 'line ' || element_id || ' without flow' FROM moved_line""")
def q_overload_offenders(spark, d):
    bad = _checked_overload(spark, d)[1]
    return bad.select(F.lit(None).cast("string").alias("scenario_id"), "network_id", "check", "item")


@query("q_overload_networks", """SELECT network_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT f.network_id, f.element_type, f.element_id FROM element_flow f
    JOIN (SELECT network_id, 'line' AS t, element_id FROM line UNION ALL SELECT network_id, 'trafo', element_id FROM trafo) e
    ON f.network_id = e.network_id AND f.element_type = e.t AND f.element_id = e.element_id)
    WHERE network_id <> '0001' OR NOT EXISTS (SELECT 1 FROM moved_line) GROUP BY ALL""")
def q_overload_networks(spark, d):
    scored = _checked_overload(spark, d)[0]
    return scored.groupBy("network_id").agg(F.count_distinct("elementType", "element_id").alias("n"))


def _checked_profiles(spark, d):
    """Market curves cut to the base hours; scenario F lacks the last of them."""
    short = (F.col("scenario_id") == "F") & (F.col("hour") == v.EVENT_HOURS - 1)
    market = v.market_curve(spark, d).where((F.col("hour") < v.EVENT_HOURS) & ~short)
    classes = profiles.lookup_table(spark, CLASSES, "market_key", "profile")
    return quality.checked_plant_profiles(market, classes, hours=v.EVENT_HOURS, by=SCENARIO)


@query("q_profile_offenders", f"""SELECT 'F' AS scenario_id, 'series length' AS "check", '{v.EVENT_HOURS - 1}' AS item""")
def q_profile_offenders(spark, d):
    return _checked_profiles(spark, d)[1]


@query("q_profile_hours", f"""SELECT 'O' AS scenario_id, profile, CAST({v.EVENT_HOURS} AS BIGINT) AS n FROM (SELECT DISTINCT profile FROM plant_class)""")
def q_profile_hours(spark, d):
    return _checked_profiles(spark, d)[0].groupBy("scenario_id", "profile").agg(F.count("*").alias("n"))
