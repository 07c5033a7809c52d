"""Queries on market and site curves (electricity)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.fixed import IGNORED_SITE
from hourgrid.functions import text
from hourgrid.operators import curves
from hourgrid.plans import views as v
from hourgrid.plans.overload import PART
from hourgrid.plans.registry import query
from hourgrid.plans.views import SCENARIO, define

define("market_sector", """SELECT m.scenario_id, hour, product, sector, sum(mw) AS mw
    FROM market_curve m JOIN categories c ON m.market_key = c.market_key WHERE carrier = 'Electricity' GROUP BY ALL""")
define("market_node", """SELECT scenario_id, hour, node, product, m.sector, mw * weight AS mw
    FROM market_sector m JOIN weights w ON m.sector = w.sector""")
define("lifted_site", f"""SELECT scenario_id, site, sector,
    CASE WHEN CAST(regexp_extract(substation, {PART}, 2) AS INTEGER) < 150
         THEN regexp_extract(substation, {PART}, 1) || '150' ELSE substation END AS substation FROM site""")
define("net_node", """SELECT c.scenario_id, hour, substation AS node, sector, sum(mw) AS mw
    FROM site_curve c JOIN lifted_site s ON c.scenario_id = s.scenario_id AND c.site = s.site GROUP BY ALL""")
define("site_node", """SELECT scenario_id, hour, node, sector, 'Demand' AS product, greatest(mw, 0.0) + 0.0 AS mw FROM net_node
    UNION ALL SELECT scenario_id, hour, node, sector, 'Supply', greatest(-mw, 0.0) + 0.0 FROM net_node""")


def station_exceptions(spark, d):
    """Two stations whose high-voltage station has another name, from the nations of one region."""
    nations = v.table(spark, d, "nation").where(F.col("n_regionkey") == 0)
    return nations.select(
        F.concat(F.lit("N"), F.char(F.lit(65) + F.col("n_nationkey"))).alias("station"),
        F.concat(F.lit("X"), F.col("n_nationkey").cast("string"), F.lit("HV")).alias("lifted_station"),
    )


def sector_exceptions(spark):
    rows = [("Supply", "Sector 2", "Sector 1"), ("Demand", "Sector 0", "Sector 1")]
    array = F.array(*[
        F.struct(F.lit(p).alias("product"), F.lit(s).alias("sector"), F.lit(t).alias("to_sector")) for p, s, t in rows
    ])
    return spark.range(1).select(F.explode(array).alias("_r")).select("_r.*")


@query("a4_categorise_market", "SELECT scenario_id, hour, product, sector, round(mw, 4) + 0.0 AS mw FROM market_sector")
def a4(spark, d):
    return curves.categorise(v.market_curve(spark, d), v.categories(spark, d), carrier="Electricity", by=SCENARIO)


@query("a4_categorise_by_category", """SELECT m.scenario_id, hour, carrier, category, round(sum(mw), 4) + 0.0 AS mw
    FROM market_curve m JOIN categories c ON m.market_key = c.market_key GROUP BY ALL""")
def a4_category(spark, d):
    return curves.categorise(v.market_curve(spark, d), v.categories(spark, d), ["carrier", "category"], by=SCENARIO)


@query("j1_market_key_to_sector", """SELECT m.scenario_id, hour, m.market_key, product, sector, round(mw, 4) + 0.0 AS mw
    FROM market_curve m JOIN categories c ON m.market_key = c.market_key""")
def j1(spark, d):
    lookup = v.categories(spark, d).select("market_key", "product", "sector")
    return v.market_curve(spark, d).join(lookup, "market_key").select("scenario_id", "hour", "market_key", "product", "sector", "mw")


@query("a4_one_carrier_of_two", """SELECT m.scenario_id, hour, product, sector, round(sum(mw), 4) + 0.0 AS mw FROM market_curve m
    JOIN categories c ON m.market_key = c.market_key WHERE c.market_key NOT LIKE 'error%' GROUP BY ALL""")
def a4_carrier(spark, d):
    """Categories of two carriers: only those of the asked one count."""
    gas = F.when(F.col("market_key").startswith("error"), F.lit("Methane")).otherwise(F.col("carrier"))
    mixed = v.categories(spark, d).withColumn("carrier", gas)
    return curves.categorise(v.market_curve(spark, d), mixed, carrier="Electricity", by=SCENARIO)


@query("j5_regionalise", "SELECT scenario_id, hour, node, product, sector, round(mw, 4) + 0.0 AS mw FROM market_node")
def j5(spark, d):
    sectors = curves.categorise(v.market_curve(spark, d), v.categories(spark, d), by=SCENARIO)
    return curves.regionalise(sectors, v.weights(spark, d), SCENARIO)


@query("c2_regional_market_curves", "SELECT scenario_id, hour, node, product, sector, round(mw, 4) + 0.0 AS mw FROM market_node")
def c2(spark, d):
    return curves.regional_market_curves(v.market_curve(spark, d), v.categories(spark, d), v.weights(spark, d), by=SCENARIO)


@query("c3_nodal_sector_curves", "SELECT scenario_id, hour, node, sector, product, round(mw, 4) + 0.0 AS mw FROM site_node")
def c3(spark, d):
    return curves.nodal_sector_curves(v.site_curve(spark, d), v.site(spark, d), by=SCENARIO)


@query("a3_net_by_sector", "SELECT scenario_id, hour, node, sector, round(mw, 4) + 0.0 AS mw FROM net_node")
def a3(spark, d):
    return curves.net_by_sector(v.site_curve(spark, d), curves.lift_to_high_voltage(v.site(spark, d)), SCENARIO)


@query("p14_lift_to_high_voltage", "SELECT scenario_id, site, substation, sector FROM lifted_site")
def p14(spark, d):
    return curves.lift_to_high_voltage(v.site(spark, d))


@query("j15_lift_with_exceptions", f"""SELECT scenario_id, site, sector,
    CASE WHEN CAST(regexp_extract(substation, {PART}, 2) AS INTEGER) < 150
         THEN coalesce(lifted, regexp_extract(substation, {PART}, 1)) || '150' ELSE substation END AS substation
    FROM site LEFT JOIN (SELECT 'N' || chr(65 + n_nationkey) AS station, 'X' || n_nationkey || 'HV' AS lifted
        FROM nation WHERE n_regionkey = 0) e ON e.station = regexp_extract(substation, {PART}, 1)""")
def j15(spark, d):
    return curves.lift_to_high_voltage(v.site(spark, d), station_exceptions(spark, d), SCENARIO)


@query("p17_split_products", "SELECT scenario_id, hour, site, product, round(mw, 4) + 0.0 AS mw FROM ("
       "SELECT scenario_id, hour, site, 'Demand' AS product, greatest(mw, 0.0) AS mw FROM site_curve "
       "UNION ALL SELECT scenario_id, hour, site, 'Supply', greatest(-mw, 0.0) FROM site_curve)")
def p17(spark, d):
    return curves.split_products(v.site_curve(spark, d))


@query("p18_remap_sectors", """SELECT scenario_id, hour, node, product, round(sum(mw), 4) + 0.0 AS mw,
    CASE WHEN product = 'Supply' AND sector = 'Sector 2' THEN 'Sector 1'
         WHEN product = 'Demand' AND sector = 'Sector 0' THEN 'Sector 1' ELSE sector END AS sector
    FROM site_node GROUP BY ALL""")
def p18(spark, d):
    return curves.nodal_sector_curves(
        v.site_curve(spark, d), v.site(spark, d), sector_exceptions=sector_exceptions(spark), by=SCENARIO
    )


@query("p11_sector_names", "SELECT DISTINCT replace(l_shipmode_, '_', ' ') AS sector FROM "
       "(SELECT 'Sector_' || event_type || '_' || (user_id % 3) AS l_shipmode_ FROM events)")
def p11(spark, d):
    raw = F.concat_ws("_", F.lit("Sector"), "event_type", (F.col("user_id") % 3).cast("string"))
    return v.table(spark, d, "events").select(text.sector_name(raw).alias("sector")).distinct()


define("part_curve", """SELECT l_linestatus AS scenario_id, CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) AS hour,
    CAST(l_partkey AS VARCHAR) AS site, sum(CASE WHEN l_discount > 0.05 THEN l_quantity ELSE 0 END) AS mw FROM lineitem GROUP BY ALL""")
define("idle_site", """SELECT scenario_id, site FROM part_curve WHERE site NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)
    GROUP BY ALL HAVING round(sum(mw), 9) = 0""")


@query("p16_drop_idle_unknown_sites", """SELECT scenario_id, hour, site, round(mw, 4) + 0.0 AS mw FROM part_curve f
    WHERE NOT EXISTS (SELECT 1 FROM idle_site i WHERE i.scenario_id = f.scenario_id AND i.site = f.site)""")
def p16(spark, d):
    rows = v.table(spark, d, "lineitem").select(
        F.col("l_linestatus").alias("scenario_id"), v._ship_day().alias("hour"), F.col("l_partkey").cast("string").alias("site"),
        F.when(F.col("l_discount") > 0.05, F.col("l_quantity")).otherwise(0.0).alias("mw"),
    )
    flat = rows.groupBy("scenario_id", "hour", "site").agg(F.sum("mw").alias("mw"))
    return curves.drop_idle_unknown_sites(flat, v.site(spark, d), SCENARIO)


@query("p3_drop_site", """SELECT scenario_id, hour, site, round(mw, 4) + 0.0 AS mw FROM
    (SELECT scenario_id, hour, CASE WHEN site = '7' THEN 'Rijnmond_Per' ELSE site END AS site, mw FROM site_curve)
    WHERE site <> 'Rijnmond_Per'""")
def p3(spark, d):
    named = F.when(F.col("site") == "7", F.lit(IGNORED_SITE)).otherwise(F.col("site"))
    return curves.drop_site(v.site_curve(spark, d).withColumn("site", named))


_ALIGN = """SELECT {cols} FROM {view} c JOIN (
    SELECT a.scenario_id, least(n, m, 8760) AS lim FROM (SELECT scenario_id, max(hour) + 1 AS n FROM market_curve GROUP BY ALL) a
    JOIN (SELECT scenario_id, max(hour) + 1 AS m FROM site_curve GROUP BY ALL) b ON a.scenario_id = b.scenario_id) l
    ON c.scenario_id = l.scenario_id WHERE c.hour < lim"""


@query("w5_align_site_curves", _ALIGN.format(cols="c.scenario_id, hour, site, round(mw, 4) + 0.0 AS mw", view="site_curve"))
def w5(spark, d):
    return curves.align_series(v.market_curve(spark, d), v.site_curve(spark, d), by=SCENARIO)[1]


@query("w5_align_market_curves", _ALIGN.format(cols="c.scenario_id, hour, market_key, round(mw, 4) + 0.0 AS mw", view="market_curve"))
def w5_market(spark, d):
    return curves.align_series(v.market_curve(spark, d), v.site_curve(spark, d), by=SCENARIO)[0]


@query("u7_demand_supply_columns", """SELECT scenario_id, hour, node, round(sum(CASE WHEN product = 'Demand' THEN mw ELSE 0 END), 4) + 0.0 AS demand,
    round(sum(CASE WHEN product = 'Supply' THEN mw ELSE 0 END), 4) + 0.0 AS supply FROM site_node GROUP BY ALL""")
def u7(spark, d):
    return curves.demand_supply_wide(curves.nodal_sector_curves(v.site_curve(spark, d), v.site(spark, d), by=SCENARIO), SCENARIO)


_FLAGS = {"A": "accepted", "N": "none", "R": "returned"}


@query("r1_long_to_wide", "SELECT l_suppkey, " + ", ".join(
    f"sum(CASE WHEN l_returnflag = '{k}' THEN l_quantity END) AS \"{k}\"" for k in _FLAGS) + " FROM lineitem GROUP BY ALL")
def r1(spark, d):
    rows = v.table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", F.col("l_quantity").alias("mw"))
    return curves.to_wide(rows, ["l_suppkey"], "l_returnflag", list(_FLAGS))


@query("r2_wide_to_long", "SELECT l_suppkey, site, mw FROM (SELECT l_suppkey, " + ", ".join(
    f"sum(CASE WHEN l_returnflag = '{k}' THEN l_quantity END) AS \"{k}\"" for k in _FLAGS)
    + " FROM lineitem GROUP BY ALL) UNPIVOT INCLUDE NULLS (mw FOR site IN (\"A\", \"N\", \"R\"))")
def r2(spark, d):
    return curves.to_long(r1(spark, d), ["l_suppkey"], "site")


@query("r3_nodes_to_columns", "SELECT scenario_id, hour, " + ", ".join(
    f"round(sum(CASE WHEN node = 'R{i}' THEN mw END), 4) + 0.0 AS \"R{i}\"" for i in range(5)) + " FROM market_node GROUP BY ALL")
def r3(spark, d):
    nodal = c2(spark, d)
    return curves.to_wide(nodal, ["scenario_id", "hour"], "node", [f"R{i}" for i in range(5)])


@query("j2_sites_to_sectors", """SELECT c.scenario_id, hour, substation, sector, round(sum(mw), 4) + 0.0 AS mw FROM site_curve c
    JOIN site s ON c.scenario_id = s.scenario_id AND c.site = s.site GROUP BY ALL""")
def j2(spark, d):
    return curves.net_by_sector(v.site_curve(spark, d), v.site(spark, d), SCENARIO).withColumnRenamed("node", "substation")


@query("j4_listed_sites", f"""SELECT c.scenario_id, hour, c.site, round(mw, 4) + 0.0 AS mw FROM site_curve c
    WHERE EXISTS (SELECT 1 FROM site s WHERE c.scenario_id = s.scenario_id AND c.site = s.site
        AND CAST(regexp_extract(substation, {PART}, 2) AS INTEGER) < 150)""")
def j4(spark, d):
    listed = curves.medium_voltage_sites(v.site(spark, d)).select("scenario_id", "site")
    return v.site_curve(spark, d).join(listed, ["scenario_id", "site"], "left_semi").select("scenario_id", "hour", "site", "mw")


@query("j17_hours_of_both_sources", """SELECT DISTINCT m.scenario_id, m.hour FROM market_curve m JOIN site_curve s
    ON m.scenario_id = s.scenario_id AND m.hour = s.hour""")
def j17(spark, d):
    keys = ["scenario_id", "hour"]
    hours = v.market_curve(spark, d).select(*keys).distinct()
    return hours.join(v.site_curve(spark, d).select(*keys).distinct(), keys, "left_semi")


@query("u6_nodes_in_one_source", """SELECT scenario_id, node FROM (SELECT DISTINCT scenario_id, node FROM market_node)
    WHERE node NOT IN (SELECT 'R' || (n_nationkey % 3) FROM nation)""")
def u6(spark, d):
    nodes = c2(spark, d).select("scenario_id", "node").distinct()
    others = v.table(spark, d, "nation").select(F.concat(F.lit("R"), (F.col("n_nationkey") % 3).cast("string")).alias("node"))
    return nodes.join(others.distinct(), "node", "left_anti").select("scenario_id", "node")
