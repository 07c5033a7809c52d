"""Queries on scenario records and state tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.operators import scenarios
from hourgrid.plans import views as v
from hourgrid.plans.registry import query

_COLS = '"scenarioId", "scenarioUuid", "scenarioYear", "calculationState", "bucketFolder"'
_FIRST = f"""SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY "scenarioUuid" ORDER BY "scenarioId") AS rn
    FROM scenario WHERE "calculationState" = 'O') WHERE rn = 1"""
_NEXT = f'{_FIRST} ORDER BY "scenarioUuid" LIMIT 5'


def _waiting(spark, d):
    return v.scenario(spark, d).where(F.col("calculationState") == "O")


@query("a15_first_row_per_group", _FIRST)
def a15(spark, d):
    return scenarios.first_per_group(_waiting(spark, d), "scenarioUuid", ["scenarioId"])


@query("o2_next_scenarios", _NEXT)
def o2(spark, d):
    return scenarios.next_scenarios(v.scenario(spark, d), "O", scenarios.admission(30))


@query("c18_kick_off", f"""SELECT "scenarioId", "scenarioUuid", "scenarioYear",
    CASE WHEN "scenarioUuid" IN (SELECT "scenarioUuid" FROM ({_NEXT})) THEN 'kickedOff' ELSE "calculationState" END AS "calculationState",
    "bucketFolder" FROM scenario""")
def c18(spark, d):
    table = v.scenario(spark, d)
    return scenarios.mark(table, scenarios.next_scenarios(table, "O", scenarios.admission(30)), "kickedOff")


@query("r4_plan_map_long", "SELECT plan, year, network_id FROM plan_long")
def r4(spark, d):
    return scenarios.plan_map_long(v.plan_wide(spark, d))


_FAN = f"""SELECT {_COLS}, network_id AS "networkId", plan AS "investmentPath" FROM scenario s
    JOIN plan_long p ON CAST(s."scenarioYear" AS VARCHAR) = p.year"""


@query("c15_fan_out", _FAN)
def c15(spark, d):
    return scenarios.fan_out(v.scenario(spark, d), r4(spark, d))


@query("j13_plans_of_year", """SELECT "scenarioYear", CAST(count(*) AS BIGINT) AS n_records, CAST(count(DISTINCT plan) AS BIGINT) AS n_plans
    FROM scenario s JOIN plan_long p ON CAST(s."scenarioYear" AS VARCHAR) = p.year GROUP BY ALL""")
def j13(spark, d):
    records = c15(spark, d)
    return records.groupBy("scenarioYear").agg(
        F.count("*").alias("n_records"), F.countDistinct("investmentPath").alias("n_plans")
    )


@query("c16_plans_using_network", "SELECT DISTINCT plan FROM plan_long WHERE regexp_matches(network_id, '0*1[0-9]$')")
def c16(spark, d):
    return scenarios.plans_using_network(r4(spark, d), "0*1[0-9]$")


@query("snk5_messages", f"""SELECT json_extract_string(body, '$.scenarioId') AS id, json_extract_string(body, '$.networkId') AS network,
    json_extract_string(body, '$.investmentPath') AS plan FROM (SELECT to_json(t) AS body FROM ({_FAN}) t)""")
def snk5(spark, d):
    body = scenarios.messages(c15(spark, d))
    return body.select(F.json_tuple("body", "scenarioId", "networkId", "investmentPath").alias("id", "network", "plan"))


# updates from the rows of the orders: several per customer, the last order wins
_UPD = """(SELECT 'U' || o_custkey AS "scenarioUuid", arg_max(o_orderpriority, o_orderkey) AS state FROM orders GROUP BY ALL)"""


@query("snk3_update_by_key", """SELECT "customer", name, CASE WHEN u.state IS NOT NULL THEN u.state ELSE c.state END AS state
    FROM (SELECT 'U' || c_custkey AS customer, c_name AS name, c_mktsegment AS state FROM customer) c
    LEFT JOIN """ + _UPD + """ u ON c.customer = u."scenarioUuid\"""")
def snk3(spark, d):
    table = v.table(spark, d, "customer").select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("customer"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("state")
    )
    updates = v.table(spark, d, "orders").select(
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("customer"), F.col("o_orderpriority").alias("state"), "o_orderkey"
    )
    return scenarios.update_by_key(table, updates, ["customer"], ["state"], ["o_orderkey"])


_UPSERT = """SELECT coalesce(c.k, u.k) AS k, CASE WHEN c.k IS NULL THEN u.name ELSE c.name END AS name,
    CASE WHEN u.k IS NULL THEN c.state ELSE u.state END AS state
    FROM (SELECT c_custkey * 2 AS k, c_name AS name, c_mktsegment AS state FROM customer) c
    FULL OUTER JOIN (SELECT o_custkey AS k, arg_min('order ' || o_orderkey, o_orderkey) AS name,
        arg_max(o_orderpriority, o_orderkey) AS state FROM orders GROUP BY ALL) u ON c.k = u.k"""


@query("snk4_upsert", _UPSERT)
def snk4(spark, d):
    table = v.table(spark, d, "customer").select(
        (F.col("c_custkey") * 2).alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("state")
    )
    updates = v.table(spark, d, "orders").select(
        F.col("o_custkey").alias("k"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderpriority").alias("state"), "o_orderkey",
    )
    return scenarios.upsert(table, updates, ["k"], ["state"], ["o_orderkey"])


@query("c19_state_upsert", f"""SELECT "scenarioId", "networkId", "investmentPath", 'postProcessingDone' AS "calculationState",
    rtrim("bucketFolder", '/') || '/investmentModels/' || "investmentPath" || '/power' AS location FROM ({_FAN})""")
def c19(spark, d):
    records = c15(spark, d)
    path = scenarios.result_path(F.col("bucketFolder"), "investmentModels", F.col("investmentPath"), "power")
    done = records.select(
        "scenarioId", "networkId", "investmentPath", F.lit("postProcessingDone").alias("calculationState"), path.alias("location")
    )
    started = records.select(
        "scenarioId", "networkId", "investmentPath", F.col("calculationState"), F.lit(None).cast("string").alias("location")
    )
    return scenarios.upsert(started, done, ["scenarioId", "networkId", "investmentPath"], ["calculationState", "location"])


@query("p31_result_keys", """SELECT "scenarioId", rtrim("bucketFolder", '/') || '/designs/D' || "scenarioYear" || '/overload' AS path,
    'D' || "scenarioYear" AS design, 'overload' AS kind FROM scenario""")
def p31(spark, d):
    path = scenarios.result_path(F.col("bucketFolder"), "designs", F.concat(F.lit("D"), F.col("scenarioYear").cast("string")), "overload")
    rows = v.scenario(spark, d).select("scenarioId", path.alias("path"))
    return scenarios.path_keys(rows, "path", {"design": -2, "kind": -1})


@query("p28_network_assignment", """SELECT 'im' || "scenarioYear" || '_' || "scenarioId" AS folder, 'NETWERK' || "scenarioId" AS investeringsplan,
    'postProcessed' AS etmreeks FROM scenario""")
def p28(spark, d):
    folder = F.concat(F.lit("im"), F.col("scenarioYear").cast("string"), F.lit("_"), F.col("scenarioId").cast("string"))
    return scenarios.network_assignment(v.scenario(spark, d).select(folder.alias("folder")), "folder", "postProcessed")
