"""Overload queries: substations, lines, transformers, gas links."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid import sinks
from hourgrid.fixed import HYDROGEN_NODES
from hourgrid.functions import power, text
from hourgrid.operators import curves, overload, scenarios
from hourgrid.plans import views as v
from hourgrid.plans.registry import query
from hourgrid.plans.views import NETWORK, SCENARIO, define
from hourgrid.session import scratch_path

PART = "'^([a-zA-Z]*)([0-9]*)(.*)$'"


def nx_sql(n: int, mode: str = "full") -> str:
    left = f"CASE WHEN trafos - {n} > 0 THEN trafos ELSE 0 END" if mode == "full" else f"greatest(trafos - {n}, 0)"
    return f"CASE WHEN trafos <> 0 THEN capacity / trafos * ({left}) END"


def scores_sql(factor: str) -> str:
    return f"""round(coalesce({factor}, 0), 4) + 0.0 AS "weighFactor", round(coalesce(vol, 0), 4) + 0.0 AS "overloadVolume",
        round(coalesce(med, 0), 4) + 0.0 AS "overloadMedian", CAST(coalesce(freq, 0) AS BIGINT) AS "overloadFreq",
        round(coalesce(med * freq / 8760.0, 0), 4) + 0.0 AS "overloadScore",
        round(coalesce(med * freq / 8760.0 * ({factor}), 0), 4) + 0.0 AS "overloadCalculated\""""


STATS = "median(x) AS med, count(x) AS freq, sum(x) AS vol"

define("mv_flow", f"""SELECT c.scenario_id, hour, substation, sum(mw) AS mw
    FROM site_curve c JOIN site s ON c.scenario_id = s.scenario_id AND c.site = s.site
    WHERE CAST(regexp_extract(substation, {PART}, 2) AS INTEGER) < 150 GROUP BY ALL""")
define("grid_line", """SELECT l.network_id, 'line' AS element_type, element_id, name,
    coalesce(f.vn_kv, t.vn_kv) * max_i_ka * sqrt(3.0) AS capacity, length_km AS factor
    FROM line l LEFT JOIN bus f ON l.from_bus = f.bus_id AND l.network_id = f.network_id
    LEFT JOIN bus t ON l.to_bus = t.bus_id AND l.network_id = t.network_id""")
define("grid_trafo", "SELECT network_id, 'trafo' AS element_type, element_id, name, sn_mva AS capacity, 13.3::DOUBLE AS factor FROM trafo")
define("grid_element", "SELECT * FROM grid_line UNION ALL SELECT * FROM grid_trafo")
define("element_stats", f"""SELECT f.scenario_id, f.network_id, f.element_type, f.element_id, {STATS}
    FROM (SELECT f.*, CASE WHEN abs(mva) - capacity > 0 THEN abs(mva) - capacity END AS x
          FROM element_flow f JOIN grid_element e ON f.network_id = e.network_id AND f.element_type = e.element_type AND f.element_id = e.element_id) f
    GROUP BY ALL""")


def elements_sql(view: str) -> str:
    return f"""SELECT r.scenario_id, e.network_id, e.element_id, e.name AS "elementName", e.element_type AS "elementType",
        round(coalesce(e.capacity, 0), 4) + 0.0 AS "elementCapacity", {scores_sql('e.factor')}
        FROM {view} e JOIN (SELECT DISTINCT scenario_id, network_id FROM element_flow) r ON e.network_id = r.network_id
        LEFT JOIN element_stats s ON s.scenario_id = r.scenario_id AND s.network_id = r.network_id AND s.element_type = e.element_type
            AND s.element_id = e.element_id"""


def stations_sql(n: int, mode: str = "full") -> str:
    return f"""SELECT coalesce(u.scenario_id, f.scenario_id) AS scenario_id,
        coalesce(u.substation, f.substation) AS "elementName", 'substation' AS "elementType",
        round(coalesce(u.nx, 0), 4) + 0.0 AS "elementCapacity", {scores_sql('13.3::DOUBLE')}
        FROM (SELECT *, {nx_sql(n, mode)} AS nx FROM substation) u
        FULL OUTER JOIN (SELECT scenario_id, substation, {STATS} FROM (
            SELECT f.scenario_id, f.substation,
                CASE WHEN mw > nx THEN mw - nx WHEN mw < -nx THEN mw + nx END AS x
            FROM mv_flow f LEFT JOIN (SELECT *, {nx_sql(n, mode)} AS nx FROM substation) c
              ON f.scenario_id = c.scenario_id AND f.substation = c.substation) GROUP BY ALL) f
        ON u.scenario_id = f.scenario_id AND u.substation = f.substation"""


def _mv_flow(spark, d):
    return overload.mv_substation_flow(v.site_curve(spark, d), v.site(spark, d), SCENARIO)


@query("c9_mv_substation_flow", "SELECT scenario_id, hour, substation, round(mw, 4) + 0.0 AS mw FROM mv_flow")
def c9(spark, d):
    return _mv_flow(spark, d)


@query("c10_substation_overload", stations_sql(0))
def c10(spark, d):
    return overload.substation_overload(_mv_flow(spark, d), v.substation(spark, d), by=SCENARIO)


@query("c10_substation_overload_n1", stations_sql(1))
def c10_n1(spark, d):
    return overload.substation_overload(_mv_flow(spark, d), v.substation(spark, d), n=1, by=SCENARIO)


@query("c10_substation_overload_n_minus_x", stations_sql(1, "n_minus_x"))
def c10_minus(spark, d):
    return overload.substation_overload(_mv_flow(spark, d), v.substation(spark, d), n=1, mode="n_minus_x", by=SCENARIO)


@query("c11_network_overload", elements_sql("grid_element"))
def c11(spark, d):
    return overload.network_overload(
        v.element_flow(spark, d), v.line(spark, d), v.trafo(spark, d), v.bus(spark, d), NETWORK, v.run(spark, d)
    )


@query("c11_line_overload", elements_sql("grid_line"))
def c11_line(spark, d):
    return overload.line_overload(v.element_flow(spark, d), v.line(spark, d), v.bus(spark, d), NETWORK, v.run(spark, d))


@query("c11_trafo_overload", elements_sql("grid_trafo"))
def c11_trafo(spark, d):
    return overload.trafo_overload(v.element_flow(spark, d), v.trafo(spark, d), NETWORK, v.run(spark, d))


@query("u2_union_of_elements", """SELECT network_id, element_type, element_id, name,
    round(capacity, 4) + 0.0 AS capacity, round(factor, 4) + 0.0 AS factor FROM grid_element""")
def u2(spark, d):
    lines = overload.line_elements(v.line(spark, d), v.bus(spark, d), NETWORK)
    return lines.unionByName(overload.trafo_elements(v.trafo(spark, d), NETWORK))


@query("c12_link_overload", f"""SELECT coalesce(s.scenario_id, f.scenario_id) AS scenario_id,
    coalesce(s.naam, f.name) AS "elementName", {scores_sql('f.length_km')}
    FROM (SELECT scenario_id, naam, {STATS} FROM (
        SELECT scenario_id, naam, abs(berekening) - abs(voorwaarde) AS x FROM link_flow WHERE naam IS NOT NULL) GROUP BY ALL) s
    FULL OUTER JOIN link_factor f ON s.scenario_id = f.scenario_id AND s.naam = f.name""")
def c12(spark, d):
    return overload.link_overload(v.link_flow(spark, d), v.link_factor(spark, d), SCENARIO)


@query("j10_link_factors_outer", """SELECT coalesce(s.scenario_id, f.scenario_id) AS scenario_id,
    coalesce(s.naam, f.name) AS naam, CAST(coalesce(n, 0) AS BIGINT) AS n_rows,
    round(coalesce(length_km, 0), 4) + 0.0 AS length_km
    FROM (SELECT scenario_id, naam, count(*) AS n FROM link_flow GROUP BY ALL) s
    FULL OUTER JOIN link_factor f ON s.scenario_id = f.scenario_id AND s.naam = f.name""")
def j10(spark, d):
    counts = v.link_flow(spark, d).groupBy("scenario_id", "naam").agg(F.count("*").alias("n"))
    factors = v.link_factor(spark, d).withColumnRenamed("name", "naam")
    return counts.join(factors, ["scenario_id", "naam"], "full_outer").select(
        "scenario_id", "naam", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce("length_km", F.lit(0.0)).alias("length_km"),
    )


@query("a11_overload_statistics", f"""SELECT scenario_id, substation, round(med, 4) + 0.0 AS median,
    CAST(freq AS BIGINT) AS n, round(vol, 4) + 0.0 AS total FROM (
    SELECT f.scenario_id, f.substation, {STATS} FROM (
        SELECT f.scenario_id, f.substation, CASE WHEN mw > nx THEN mw - nx WHEN mw < -nx THEN mw + nx END AS x
        FROM mv_flow f JOIN (SELECT *, {nx_sql(0)} AS nx FROM substation) c
          ON f.scenario_id = c.scenario_id AND f.substation = c.substation) f
    WHERE x IS NOT NULL GROUP BY ALL)""")
def a11(spark, d):
    from hourgrid.functions.quantiles import bounded_statistics

    reduced = overload.reduced_capacity(v.substation(spark, d))
    return bounded_statistics(overload.substation_excess(_mv_flow(spark, d), reduced, SCENARIO), ["scenario_id", "substation"], "excess")


@query("a11_median_of_large_groups", """SELECT l_returnflag, CAST(count(l_extendedprice) AS BIGINT) AS n,
    round(sum(l_extendedprice), 2) + 0.0 AS total, round(median(l_extendedprice), 4) + 0.0 AS median
    FROM lineitem GROUP BY ALL""")
def a11_large(spark, d):
    from hourgrid.functions.quantiles import statistics

    stats = statistics(v.table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return stats.withColumn("total", F.round("total", 2))


@query("j11_substation_outer", """SELECT coalesce(u.scenario_id, f.scenario_id) AS scenario_id,
    coalesce(u.substation, f.substation) AS substation, u.substation IS NOT NULL AS listed, f.substation IS NOT NULL AS has_flow
    FROM substation u FULL OUTER JOIN (SELECT DISTINCT scenario_id, substation FROM mv_flow) f
    ON u.scenario_id = f.scenario_id AND u.substation = f.substation""")
def j11(spark, d):
    keys = ["scenario_id", "substation"]
    listed = v.substation(spark, d).select(*keys).withColumn("listed", F.lit(True))
    flows = _mv_flow(spark, d).select(*keys).distinct().withColumn("has_flow", F.lit(True))
    no = F.lit(False)
    return listed.join(flows, keys, "full_outer").withColumns(
        {"listed": F.coalesce("listed", no), "has_flow": F.coalesce("has_flow", no)}
    )


@query("p12_substation_parts", f"""SELECT scenario_id, site, regexp_extract(substation, {PART}, 1) AS station,
    CAST(regexp_extract(substation, {PART}, 2) AS INTEGER) AS voltage, regexp_extract(substation, {PART}, 3) AS remaining FROM site""")
def p12(spark, d):
    s = F.col("substation")
    return v.site(spark, d).select(
        "scenario_id", "site", text.station(s).alias("station"), text.voltage(s).alias("voltage"), text.remaining(s).alias("remaining")
    )


@query("p13_medium_voltage_sites", f"""SELECT scenario_id, site, substation, sector FROM site
    WHERE CAST(regexp_extract(substation, {PART}, 2) AS INTEGER) < 150""")
def p13(spark, d):
    return curves.medium_voltage_sites(v.site(spark, d))


@query("a6_site_flow", """SELECT c.scenario_id, hour, substation, round(sum(mw), 4) + 0.0 AS mw
    FROM site_curve c JOIN site s ON c.scenario_id = s.scenario_id AND c.site = s.site GROUP BY ALL""")
def a6(spark, d):
    return overload.site_flow(v.site_curve(spark, d), v.site(spark, d), SCENARIO)


@query("p19_line_capacity", "SELECT network_id, element_id, name, round(capacity, 4) + 0.0 AS capacity, round(factor, 4) + 0.0 AS factor FROM grid_line")
def p19(spark, d):
    return overload.line_elements(v.line(spark, d), v.bus(spark, d), NETWORK).select("network_id", "element_id", "name", "capacity", "factor")


@query("p20_trafo_capacity", "SELECT network_id, element_id, name, capacity, factor FROM grid_trafo")
def p20(spark, d):
    return overload.trafo_elements(v.trafo(spark, d), NETWORK).select("network_id", "element_id", "name", "capacity", "factor")


@query("p21_reduced_capacity", " UNION ALL ".join(
    f"SELECT scenario_id, substation, CAST({n} AS INTEGER) AS n, '{m}' AS mode, round({nx_sql(n, m)}, 4) + 0.0 AS nx_capacity FROM substation"
    for n in (0, 1, 2) for m in ("full", "n_minus_x")))
def p21(spark, d):
    variants = F.array(*[
        F.struct(
            F.lit(n).alias("n"), F.lit(m).alias("mode"),
            power.capacity_without(F.col("capacity"), F.col("trafos"), n, m).alias("nx_capacity"),
        )
        for n in (0, 1, 2) for m in ("full", "n_minus_x")
    ])
    return v.substation(spark, d).select("scenario_id", "substation", F.explode(variants).alias("_v")).select(
        "scenario_id", "substation", "_v.*"
    )


@query("p22_element_excess", """SELECT f.scenario_id, f.network_id, f.element_type, f.element_id, hour,
    round(abs(mva) - capacity, 4) + 0.0 AS excess
    FROM element_flow f JOIN grid_element e ON f.network_id = e.network_id AND f.element_type = e.element_type AND f.element_id = e.element_id
    WHERE abs(mva) - capacity > 0""")
def p22(spark, d):
    elements = overload.line_elements(v.line(spark, d), v.bus(spark, d), NETWORK).unionByName(
        overload.trafo_elements(v.trafo(spark, d), NETWORK)
    )
    return overload.element_excess(v.element_flow(spark, d), elements, NETWORK)


@query("p23_signed_excess", f"""SELECT f.scenario_id, hour, f.substation,
    round(CASE WHEN mw > nx THEN mw - nx WHEN mw < -nx THEN mw + nx END, 4) + 0.0 AS excess
    FROM mv_flow f LEFT JOIN (SELECT *, {nx_sql(0)} AS nx FROM substation) c
      ON f.scenario_id = c.scenario_id AND f.substation = c.substation""")
def p23(spark, d):
    reduced = overload.reduced_capacity(v.substation(spark, d))
    return overload.substation_excess(_mv_flow(spark, d), reduced, SCENARIO)


@query("p24_link_excess", """SELECT scenario_id, naam, round(abs(berekening) - abs(voorwaarde), 4) + 0.0 AS excess
    FROM link_flow WHERE naam IS NOT NULL""")
def p24(spark, d):
    return overload.link_excess(v.link_flow(spark, d), SCENARIO)


_H2 = "(" + ", ".join(f"'{n}'" for n in HYDROGEN_NODES) + ")"


@query("p25_split_links", f"""SELECT scenario_id, name, length_km, from_node, to_node, 'hydrogen' AS carrier FROM link_factor
    WHERE from_node IN {_H2} OR to_node IN {_H2}
    UNION ALL SELECT scenario_id, name, length_km, from_node, to_node, 'methane' AS carrier FROM link_factor
    WHERE from_node NOT IN {_H2} OR to_node NOT IN {_H2}""")
def p25(spark, d):
    return overload.split_links(v.link_factor(spark, d))


@query("j6_line_voltages", """SELECT l.network_id, element_id, f.vn_kv AS from_kv, t.vn_kv AS to_kv FROM line l
    LEFT JOIN bus f ON l.from_bus = f.bus_id AND l.network_id = f.network_id
    LEFT JOIN bus t ON l.to_bus = t.bus_id AND l.network_id = t.network_id""")
def j6(spark, d):
    buses = v.bus(spark, d)
    side = lambda s: buses.select("network_id", F.col("bus_id").alias(f"{s}_bus"), F.col("vn_kv").alias(f"{s}_kv"))
    lines = v.line(spark, d).join(side("from"), ["network_id", "from_bus"], "left")
    return lines.join(side("to"), ["network_id", "to_bus"], "left").select("network_id", "element_id", "from_kv", "to_kv")


define("plan_run", """SELECT plan, CAST(year AS INTEGER) AS plan_year, CASE WHEN CAST(network_id AS BIGINT) % 2 = 0 THEN 'F' ELSE 'O' END AS scenario_id,
    CASE WHEN CAST(network_id AS BIGINT) % 2 = 0 THEN '0001' ELSE '0002' END AS network_id FROM plan_long""")


def plan_runs(spark, d):
    """Scenario and network of every plan and year: many plans share few networks."""
    even = F.col("network_id").cast("bigint") % 2 == 0
    return scenarios.plan_map_long(v.plan_wide(spark, d)).select(
        "plan", F.col("year").cast("int").alias("plan_year"), F.when(even, "F").otherwise("O").alias("scenario_id"), F.when(even, "0001").otherwise("0002").alias("network_id"))


@query("c15_overload_per_plan", f"SELECT p.plan, p.plan_year, r.* FROM plan_run p JOIN ({elements_sql('grid_element')}) r ON p.scenario_id = r.scenario_id AND p.network_id = r.network_id")
def c15_per_plan(spark, d):
    """Each network is evaluated once, its results are handed to all plans and years that use it."""
    flows, lines, trafos, buses = (t(spark, d) for t in (v.element_flow, v.line, v.trafo, v.bus))

    def evaluate(runs):
        on = list(NETWORK)
        return overload.network_overload(flows.join(runs, on, "left_semi"), lines, trafos, buses, by=NETWORK)

    return scenarios.evaluate_once(plan_runs(spark, d), evaluate, NETWORK)


ELEMENT = ["network_id", "element_type", "element_id"]


def bucketed_flows(spark, d):
    """The flows as the stage before hands them over: in buckets of network and element."""
    path = scratch_path(spark, "flows")
    name = "flows_" + path.rsplit("-", 1)[1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a bucket is a task of the next stage
    return sinks.write_bucketed(v.element_flow(spark, d), path, name, ELEMENT, buckets)


@query("c11_on_bucketed_flows", elements_sql("grid_element"))
def c11_bucketed(spark, d):
    """The flows are joined with their elements and summed where they lie."""
    return overload.network_overload(bucketed_flows(spark, d), v.line(spark, d), v.trafo(spark, d), v.bus(spark, d), NETWORK, v.run(spark, d))
