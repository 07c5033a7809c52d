"""Domain views over the test tables, once as DataFrames and once as SQL text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions.text import sector_name

SCENARIO = ("scenario_id",)
NETWORK = ("scenario_id", "network_id")

# Fixed values of the views ---------------------------------------------------

SCENARIOS = ["F", "O"]
NETWORKS = ["0001", "0002"]
EVENT_HOURS = 720
BASE_LOAD = 250.0
CALENDAR = 2600
CARRIER_CODES = ["RTLH_ODO_x", "RTLG_NODO", "HTLH", "H2_new", "CO2_F", "CO2_B", "CO2_P", "GM_H2_new", "EL"]
ASSET_NAMES = ["LNGImport_MV", "ImportH2_MV", "Plant_GM", "Conn_RTLH_ODO_HTLG", "CO2_F_CO2_P", "Site"]
PORT_CARRIERS = [
    "RTLH_ODO", "RTLG_ODO", "RTLH_NODO", "RTLG_NODO", "HTLH", "HTLG", "H2_new", "H2_local", "H2_Hvision",
    "C", "BM", "W", "GM", "Heat", "Steam", "Sun",
]
CATEGORIES = [
    ("view_0", "Electricity", "Demand", "Baseload", "Sector 0"),
    ("view_1", "Electricity", "Demand", "Baseload", "Sector 1"),
    ("click_0", "Electricity", "Demand", "Flex", "Sector 2"),
    ("click_1", "Electricity", "Demand", "Flex", "Sector 0"),
    ("purchase_0", "Electricity", "Demand", "Flex", "Sector 1"),
    ("purchase_1", "Electricity", "Supply", "Market", "Sector 0"),
    ("signup_0", "Electricity", "Supply", "Market", "Sector 1"),
    ("signup_1", "Electricity", "Supply", "Flex", "Sector 2"),
    ("error_0", "Electricity", "Supply", "Must Run", "Sector 0"),
    ("error_1", "Electricity", "Supply", "Must Run", "Sector 1"),
]
CATEGORY_COLUMNS = ["market_key", "carrier", "product", "category", "sector"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _strings(values: list[str]):
    return F.array(*[F.lit(v) for v in values])


def _net_quantity():
    return F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))


def _ship_day():
    return F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date"))


def _letter(key: str):
    return F.char(F.lit(65) + F.col(key))


def site_curve(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(
        F.col("l_linestatus").alias("scenario_id"), _ship_day().alias("hour"),
        F.col("l_suppkey").cast("string").alias("site"), _net_quantity().alias("mw"),
    )
    return rows.groupBy("scenario_id", "hour", "site").agg(F.sum("mw").alias("mw"))


def site(spark: SparkSession, d: str) -> DataFrame:
    volt = F.when(F.col("s_suppkey") % 3 == 0, F.lit("150")).otherwise(F.lit("25"))
    sector = sector_name(F.concat(F.lit("Sector_"), (F.col("s_suppkey") % 3).cast("string")))
    return table(spark, d, "supplier").select(
        F.explode(_strings(SCENARIOS)).alias("scenario_id"),
        F.col("s_suppkey").cast("string").alias("site"),
        F.concat(F.lit("N"), _letter("s_nationkey"), volt).alias("substation"),
        sector.alias("sector"),
    )


def substation(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "nation").select("n_nationkey", F.explode(_strings(SCENARIOS)).alias("scenario_id"))
    return both.select("n_nationkey", "scenario_id", F.explode(_strings(["25", "150"])).alias("kv")).select(
        "scenario_id",
        F.concat(F.lit("N"), _letter("n_nationkey"), F.col("kv")).alias("substation"),
        (F.lit(20.0) + F.col("n_nationkey")).alias("capacity"),
        (F.col("n_nationkey") % 4).cast("int").alias("trafos"),
    )


def market_curve(spark: SparkSession, d: str) -> DataFrame:
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    events = table(spark, d, "events").select(
        F.when(F.col("user_id") % 2 == 0, F.lit("F")).otherwise(F.lit("O")).alias("scenario_id"),
        F.concat_ws("_", "event_type", (F.floor(F.col("user_id") / 2) % 2).cast("string")).alias("market_key"),
        F.floor(seconds / 3600).cast("int").alias("hour"),
        F.col("value").alias("mw"),
    )
    grid = spark.range(1).select(F.explode(_strings(SCENARIOS)).alias("scenario_id"))
    grid = grid.select("scenario_id", F.explode(_strings([r[0] for r in CATEGORIES])).alias("market_key"))
    grid = grid.select(
        "scenario_id", "market_key", F.explode(F.sequence(F.lit(0), F.lit(EVENT_HOURS - 1))).alias("hour"),
        F.lit(BASE_LOAD).alias("mw"),
    )
    return events.unionByName(grid).groupBy("scenario_id", "market_key", "hour").agg(F.sum("mw").alias("mw"))


def categories(spark: SparkSession, d: str) -> DataFrame:
    rows = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(CATEGORY_COLUMNS, row)]) for row in CATEGORIES])
    return spark.range(1).select(F.explode(rows).alias("_r")).select("_r.*")


def weights(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "region").select(
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("node"),
        F.explode(_strings(["Sector 0", "Sector 1", "Sector 2"])).alias("sector"),
        ((F.col("r_regionkey") + 1) / 15).alias("weight"),
    )


def bus(spark: SparkSession, d: str) -> DataFrame:
    volt = F.element_at(F.array(F.lit(110.0), F.lit(150.0), F.lit(380.0)), F.col("n_nationkey") % 3 + 1)
    return table(spark, d, "nation").select(
        F.explode(_strings(NETWORKS)).alias("network_id"),
        F.col("n_nationkey").cast("bigint").alias("bus_id"),
        volt.alias("vn_kv"),
        F.concat(F.lit("N"), _letter("n_nationkey"), F.lit("150")).alias("short_name"),
    )


def line(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.explode(_strings(NETWORKS)).alias("network_id"),
        F.col("p_partkey").alias("element_id"),
        F.col("p_name").alias("name"),
        (F.col("p_partkey") % 30).alias("from_bus"),
        (F.col("p_partkey") % 25).alias("to_bus"),
        (F.col("p_size") / 10).alias("length_km"),
        (F.col("p_size") / 500).alias("max_i_ka"),
    )


def trafo(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        F.explode(_strings(NETWORKS)).alias("network_id"),
        F.col("p_partkey").alias("element_id"),
        F.col("p_name").alias("name"),
        F.col("p_size").cast("double").alias("sn_mva"),
    )


def element_flow(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(
        F.col("l_linestatus").alias("scenario_id"),
        F.when(F.col("l_linestatus") == "F", F.lit("0001")).otherwise(F.lit("0002")).alias("network_id"),
        F.when(F.col("l_returnflag") == "A", F.lit("trafo")).otherwise(F.lit("line")).alias("element_type"),
        F.col("l_partkey").alias("element_id"), _ship_day().alias("hour"), _net_quantity().alias("mva"),
    )
    return rows.groupBy("scenario_id", "network_id", "element_type", "element_id", "hour").agg(F.sum("mva").alias("mva"))


def run(spark: SparkSession, d: str) -> DataFrame:
    """Scenario and network of every run; reads one column."""
    network = F.when(F.col("l_linestatus") == "F", F.lit("0001")).otherwise(F.lit("0002"))
    return table(spark, d, "lineitem").select(F.col("l_linestatus").alias("scenario_id"), network.alias("network_id")).distinct()


def link_flow(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, d, "lineitem").select(
        F.col("l_linestatus").alias("scenario_id"),
        F.concat(F.lit("L"), F.col("l_suppkey").cast("string")).alias("naam"),
        F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("berekening"),
        F.lit(30000.0).alias("voorwaarde"),
    )


def link_factor(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(
        F.explode(_strings(SCENARIOS)).alias("scenario_id"),
        F.concat(F.lit("L"), (F.col("s_suppkey") * 2).cast("string")).alias("name"),
        (F.col("s_suppkey") / 10).alias("length_km"),
        F.concat(F.lit("HW_00"), (F.col("s_nationkey") % 9).cast("string")).alias("from_node"),
        F.concat(F.lit("W1_00"), (F.col("s_suppkey") % 6).cast("string")).alias("to_node"),
    )


def _gas_site(key: str):
    k = F.col(key)
    named = F.when(k == 1, F.lit("CH4Export_Per")).when(k == 2, F.lit("CH4Import_Wijngaarden"))
    named = named.when(k == 3, F.lit("ExportH2_Per")).when(k == 4, F.lit("ImportH2_MV"))
    return named.otherwise(F.concat(F.lit("G"), k.cast("string")))


def gas_curve(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(
        F.col("l_linestatus").alias("scenario_id"),
        F.when(F.col("l_linenumber") % 2 == 1, F.lit("methane")).otherwise(F.lit("hydrogen")).alias("carrier"),
        _ship_day().alias("hour"), _gas_site("l_suppkey").alias("site"), _net_quantity().alias("mw"),
    )
    return rows.groupBy("scenario_id", "carrier", "hour", "site").agg(F.sum("mw").alias("mw"))


def gas_site(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.explode(_strings(SCENARIOS)).alias("scenario_id"))
    rows = rows.select("*", F.explode(_strings(["methane", "hydrogen"])).alias("carrier"))
    rows = rows.select("*", F.explode(_strings(["11", "12"])).alias("network_id"))
    balance = F.when(F.col("carrier") == "methane", F.lit("BAL_M")).otherwise(F.lit("BAL_H"))
    node = F.concat(F.lit("G"), _letter("s_nationkey"), F.col("network_id"))
    node = F.when(F.col("s_suppkey") % 10 == 0, balance).when(F.col("s_suppkey") % 17 != 0, node)
    return rows.select("scenario_id", "network_id", "carrier", _gas_site("s_suppkey").alias("site"), node.alias("substation"))


def market_length(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.range(1).select(F.explode(_strings(SCENARIOS)).alias("scenario_id"))
    rows = rows.select("*", F.explode(_strings(["methane", "hydrogen"])).alias("carrier"))
    return rows.withColumn("market_hours", F.when(F.col("carrier") == "methane", F.lit(CALENDAR)).otherwise(F.lit(2000)))


def _brand():
    return F.split("p_brand", "#")[1].cast("int")


def asset_row(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    klass = F.when(F.col("l_returnflag") == "A", F.lit("EConnection")).when(F.col("l_returnflag") == "R", F.lit("GConnection"))
    name = F.concat_ws("_", F.element_at(_strings(ASSET_NAMES), F.col("p_size") % 6 + 1), _brand().cast("string"))
    lines = table(spark, d, "lineitem")
    return lines.join(part, lines["l_partkey"] == part["p_partkey"]).select(
        F.col("l_linestatus").alias("scenario_id"),
        F.concat(F.lit("M"), F.col("l_partkey").cast("string")).alias("member"),
        (F.col("l_partkey") * 7919 % 1000003).cast("int").alias("member_pos"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 4096 + _ship_day()).alias("row_idx"),
        name.alias("assetName"),
        klass.otherwise(F.lit("Import")).alias("assetClass"),
        F.element_at(_strings(CARRIER_CODES), _brand() % 9 + 1).alias("carrierId"),
        F.lit("Sector 0").alias("sector"),
        (F.col("l_extendedprice") * F.lit(1e6)).alias("allocationPower"),
    )


def site_name(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat_ws("_", F.element_at(_strings(ASSET_NAMES), F.col("p_size") % 6 + 1), (_brand() + 3).cast("string"))
    return table(spark, d, "part").select(
        raw.alias("raw_name"),
        F.concat(F.lit("S"), (F.col("p_partkey") % 40).cast("string")).alias("grid_name"),
        F.col("p_partkey").alias("row_idx"),
    )


def port(spark: SparkSession, d: str) -> DataFrame:
    rank = (F.col("l_linenumber").cast("bigint") * 4096 + _ship_day()) * 1000000 + F.col("l_suppkey")
    outlet = F.col("l_returnflag") == "R"
    return table(spark, d, "lineitem").select(
        F.col("l_linestatus").alias("scenario_id"),
        F.col("l_orderkey").alias("asset_id"),
        F.col("l_orderkey").alias("asset_pos"),
        rank.alias("port_pos"),
        F.when(outlet, F.lit("out")).otherwise(F.lit("in")).alias("port_kind"),
        F.element_at(_strings(PORT_CARRIERS), (F.col("l_partkey") % 16 + 1).cast("int")).alias("carrier_id"),
        F.when(outlet, F.lit("Electricity")).otherwise(F.lit("Fuel")).alias("carrier_name"),
    )


def scenario(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("scenarioId"),
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("scenarioUuid"),
        (F.lit(2025) + F.year("o_orderdate") % 6 * 5).cast("int").alias("scenarioYear"),
        F.col("o_orderstatus").alias("calculationState"),
        F.concat(F.lit("runs/"), F.col("o_orderkey").cast("string"), F.lit("/")).alias("bucketFolder"),
    )


def plan_wide(spark: SparkSession, d: str) -> DataFrame:
    ids = [
        F.lpad((F.col("r_regionkey") * 6 + i).cast("string"), 20, "0").alias(str(2025 + 5 * i)) for i in range(6)
    ]
    return table(spark, d, "region").select(F.concat(F.lit("Plan "), F.col("r_name")).alias("index"), *ids)


def price(spark: SparkSession, d: str) -> DataFrame:
    day = F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date"))
    return table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("scenario_id"), day.alias("hour")).agg(
        F.avg("o_totalprice").alias("price")
    )


# The same views as SQL text --------------------------------------------------

_QTY = "CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END"
_DAY = "CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS INTEGER)"
_SCEN = "(VALUES ('F'), ('O')) AS sc(scenario_id)"
_NETS = "(VALUES ('0001'), ('0002')) AS nw(network_id)"
_BRAND = "CAST(split_part(p_brand, '#', 2) AS INTEGER)"


def _gas_sql(key: str) -> str:
    return (
        f"CASE {key} WHEN 1 THEN 'CH4Export_Per' WHEN 2 THEN 'CH4Import_Wijngaarden' WHEN 3 THEN 'ExportH2_Per' "
        f"WHEN 4 THEN 'ImportH2_MV' ELSE 'G' || {key} END"
    )


def _values(rows: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


SQL = {
    "site_curve": f"""SELECT l_linestatus AS scenario_id, {_DAY} AS hour, CAST(l_suppkey AS VARCHAR) AS site,
        sum({_QTY}) AS mw FROM lineitem GROUP BY ALL""",
    "site": f"""SELECT scenario_id, CAST(s_suppkey AS VARCHAR) AS site,
        'N' || chr(65 + s_nationkey) || CASE WHEN s_suppkey % 3 = 0 THEN '150' ELSE '25' END AS substation,
        'Sector ' || (s_suppkey % 3) AS sector FROM supplier, {_SCEN}""",
    "substation": f"""SELECT scenario_id, 'N' || chr(65 + n_nationkey) || kv AS substation,
        20.0::DOUBLE + n_nationkey AS capacity, CAST(n_nationkey % 4 AS INTEGER) AS trafos
        FROM nation, {_SCEN}, (VALUES ('25'), ('150')) AS v(kv)""",
    "categories": f"SELECT * FROM (VALUES {_values(CATEGORIES)}) AS c({', '.join(CATEGORY_COLUMNS)})",
    "market_curve": f"""SELECT scenario_id, market_key, hour, sum(mw) AS mw FROM (
        SELECT CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'O' END AS scenario_id,
            event_type || '_' || ((user_id // 2) % 2) AS market_key,
            CAST(date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', date_trunc('hour', ts)) AS INTEGER) AS hour, value AS mw
        FROM events
        UNION ALL
        SELECT scenario_id, market_key, CAST(h AS INTEGER), CAST({BASE_LOAD} AS DOUBLE)
        FROM {_SCEN}, categories, range({EVENT_HOURS}) AS r(h)) GROUP BY ALL""",
    "weights": """SELECT 'R' || r_regionkey AS node, sector, (r_regionkey + 1) / 15.0::DOUBLE AS weight
        FROM region, (VALUES ('Sector 0'), ('Sector 1'), ('Sector 2')) AS v(sector)""",
    "bus": f"""SELECT network_id, CAST(n_nationkey AS BIGINT) AS bus_id,
        CAST([110.0, 150.0, 380.0][n_nationkey % 3 + 1] AS DOUBLE) AS vn_kv,
        'N' || chr(65 + n_nationkey) || '150' AS short_name FROM nation, {_NETS}""",
    "line": f"""SELECT network_id, p_partkey AS element_id, p_name AS name, p_partkey % 30 AS from_bus,
        p_partkey % 25 AS to_bus, p_size / 10.0::DOUBLE AS length_km, p_size / 500.0::DOUBLE AS max_i_ka FROM part, {_NETS}""",
    "trafo": f"""SELECT network_id, p_partkey AS element_id, p_name AS name,
        CAST(p_size AS DOUBLE) AS sn_mva FROM part, {_NETS}""",
    "element_flow": f"""SELECT l_linestatus AS scenario_id, CASE WHEN l_linestatus = 'F' THEN '0001' ELSE '0002' END AS network_id,
        CASE WHEN l_returnflag = 'A' THEN 'trafo' ELSE 'line' END AS element_type, l_partkey AS element_id,
        {_DAY} AS hour, sum({_QTY}) AS mva FROM lineitem GROUP BY ALL""",
    "link_flow": """SELECT l_linestatus AS scenario_id, 'L' || l_suppkey AS naam,
        CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS berekening,
        30000.0::DOUBLE AS voorwaarde FROM lineitem""",
    "link_factor": f"""SELECT scenario_id, 'L' || (s_suppkey * 2) AS name, s_suppkey / 10.0::DOUBLE AS length_km,
        'HW_00' || (s_nationkey % 9) AS from_node, 'W1_00' || (s_suppkey % 6) AS to_node FROM supplier, {_SCEN}""",
    "gas_curve": f"""SELECT l_linestatus AS scenario_id,
        CASE WHEN l_linenumber % 2 = 1 THEN 'methane' ELSE 'hydrogen' END AS carrier, {_DAY} AS hour,
        {_gas_sql('l_suppkey')} AS site, sum({_QTY}) AS mw FROM lineitem GROUP BY ALL""",
    "gas_site": f"""SELECT scenario_id, network_id, carrier, {_gas_sql('s_suppkey')} AS site,
        CASE WHEN s_suppkey % 10 = 0 THEN CASE WHEN carrier = 'methane' THEN 'BAL_M' ELSE 'BAL_H' END
             WHEN s_suppkey % 17 <> 0 THEN 'G' || chr(65 + s_nationkey) || network_id END AS substation
        FROM supplier, {_SCEN}, (VALUES ('methane'), ('hydrogen')) AS c(carrier), (VALUES ('11'), ('12')) AS n(network_id)""",
    "market_length": f"""SELECT scenario_id, carrier, CASE WHEN carrier = 'methane' THEN {CALENDAR} ELSE 2000 END AS market_hours
        FROM {_SCEN}, (VALUES ('methane'), ('hydrogen')) AS c(carrier)""",
    "asset_row": f"""SELECT l_linestatus AS scenario_id, 'M' || l_partkey AS member, CAST(l_partkey * 7919 % 1000003 AS INTEGER) AS member_pos,
        (l_orderkey * 8 + l_linenumber) * 4096 + {_DAY} AS row_idx,
        {ASSET_NAMES}[p_size % 6 + 1] || '_' || {_BRAND} AS "assetName",
        CASE l_returnflag WHEN 'A' THEN 'EConnection' WHEN 'R' THEN 'GConnection' ELSE 'Import' END AS "assetClass",
        {CARRIER_CODES}[{_BRAND} % 9 + 1] AS "carrierId", 'Sector 0' AS sector,
        l_extendedprice * 1e6 AS "allocationPower" FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "site_name": f"""SELECT {ASSET_NAMES}[p_size % 6 + 1] || '_' || ({_BRAND} + 3) AS raw_name,
        'S' || (p_partkey % 40) AS grid_name, p_partkey AS row_idx FROM part""",
    "port": f"""SELECT l_linestatus AS scenario_id, l_orderkey AS asset_id, l_orderkey AS asset_pos,
        (CAST(l_linenumber AS BIGINT) * 4096 + {_DAY}) * 1000000 + l_suppkey AS port_pos,
        CASE WHEN l_returnflag = 'R' THEN 'out' ELSE 'in' END AS port_kind,
        {PORT_CARRIERS}[CAST(l_partkey % 16 + 1 AS INTEGER)] AS carrier_id,
        CASE WHEN l_returnflag = 'R' THEN 'Electricity' ELSE 'Fuel' END AS carrier_name FROM lineitem""",
    "scenario": """SELECT o_orderkey AS "scenarioId", 'U' || o_custkey AS "scenarioUuid",
        CAST(2025 + year(o_orderdate) % 6 * 5 AS INTEGER) AS "scenarioYear", o_orderstatus AS "calculationState",
        'runs/' || o_orderkey || '/' AS "bucketFolder" FROM orders""",
    "plan_wide": "SELECT 'Plan ' || r_name AS \"index\", "
    + ", ".join(f"lpad(CAST(r_regionkey * 6 + {i} AS VARCHAR), 20, '0') AS \"{2025 + 5 * i}\"" for i in range(6))
    + " FROM region",
    "plan_long": "SELECT \"index\" AS plan, year, network_id FROM plan_wide UNPIVOT (network_id FOR year IN "
    + "(" + ", ".join(f'"{2025 + 5 * i}"' for i in range(6)) + "))",
    "price": """SELECT o_orderstatus AS scenario_id,
        CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS hour,
        avg(o_totalprice) AS price FROM orders GROUP BY ALL""",
}


def define(name: str, sql: str) -> str:
    """Add a derived SQL view that oracles may use by name; returns the name."""
    SQL[name] = sql
    return name


def _uses(sql: str) -> list[str]:
    """Views named in the text, those that others build on first."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in SQL:
            if name not in seen and re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text):
                seen.add(name)
                visit(SQL[name])
                order.append(name)

    visit(sql)
    return order


def with_views(sql: str) -> str:
    """The SQL with the definitions of all views it names."""
    names = _uses(sql)
    if not names:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + f"\n{sql}"
