"""Queries that write derived tables to the shared folder and read them back, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid import sinks, streaming
from hourgrid.operators import scenarios
from hourgrid.plans import views as v
from hourgrid.plans.registry import query
from hourgrid.plans.scenarios import _COLS, _FAN
from hourgrid.session import scratch_path
from hourgrid.sources import messages, tables
from hourgrid.streaming import state

_CURVE = "SELECT scenario_id, hour, site, round(mw, 4) + 0.0 AS mw FROM site_curve"
RECORD = ["scenarioId", "scenarioUuid", "scenarioYear", "calculationState", "bucketFolder"]


@query("snk1_partitioned_table", _CURVE)
def snk1(spark, d):
    path = scratch_path(spark, "curves")
    sinks.write_table(v.site_curve(spark, d), path, ["scenario_id"])
    return spark.read.parquet(path).select("scenario_id", "hour", "site", "mw")


@query("snk1_csv_and_src2_read", _CURVE)
def src2(spark, d):
    path = scratch_path(spark, "csv")
    sinks.write_csv(v.site_curve(spark, d), path, ["scenario_id"])
    read = spark.read.option("sep", ";").option("header", True).schema("hour INT, site STRING, mw DOUBLE").csv(path)
    return tables.keys_from_path(read, {"scenario_id": "scenario_id=([^/]+)"}).select("scenario_id", "hour", "site", "mw")


@query("snk2_dataset_per_carrier", "SELECT scenario_id, carrier, hour, site, round(mw, 4) + 0.0 AS mw FROM gas_curve")
def snk2(spark, d):
    path = scratch_path(spark, "gas")
    sinks.write_by_carrier(v.gas_curve(spark, d), path, ["scenario_id"])
    return spark.read.parquet(path).select("scenario_id", "carrier", "hour", "site", "mw")


@query("src8_network_tables", """SELECT l.network_id, l.element_id, l.name, f.vn_kv AS from_kv FROM line l
    JOIN bus f ON l.network_id = f.network_id AND l.from_bus = f.bus_id""")
def src8(spark, d):
    root = scratch_path(spark, "network")
    for name, df in {"bus": v.bus(spark, d), "line": v.line(spark, d), "trafo": v.trafo(spark, d)}.items():
        sinks.write_table(df, f"{root}/{name}", ["network_id"])
    net = tables.read_network(spark, root, v.NETWORKS)
    source = net["bus"].select("network_id", F.col("bus_id").alias("from_bus"), F.col("vn_kv").alias("from_kv"))
    return net["line"].join(source, ["network_id", "from_bus"]).select("network_id", "element_id", "name", "from_kv")


@query("src11_keys_from_folders", """SELECT l_linestatus AS scenario, l_returnflag AS design, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL""")
def src11(spark, d):
    path = scratch_path(spark, "designs")
    rows = v.table(spark, d, "lineitem").select("l_linestatus", "l_returnflag", "l_orderkey")
    rows.write.partitionBy("l_linestatus", "l_returnflag").parquet(path)
    read = spark.read.option("recursiveFileLookup", True).parquet(path)
    keyed = tables.keys_from_path(read, {"scenario": "l_linestatus=([^/]+)", "design": "l_returnflag=([^/]+)"})
    return keyed.groupBy("scenario", "design").agg(F.count("*").alias("n"))


@query("src11_discovered_designs", """SELECT DISTINCT l_linestatus AS scenario, l_returnflag AS design FROM lineitem
    UNION ALL SELECT DISTINCT l_linestatus, 'empty' FROM lineitem""")
def src11_discovered(spark, d):
    """Designs by their files alone, those without rows included."""
    path = scratch_path(spark, "designs")
    rows = v.table(spark, d, "lineitem").select("l_linestatus", "l_returnflag", "l_orderkey")
    rows.write.partitionBy("l_linestatus", "l_returnflag").parquet(path)
    for run in rows.select("l_linestatus").distinct().collect():  # two
        rows.select("l_orderkey").where("false").write.parquet(f"{path}/l_linestatus={run[0]}/l_returnflag=empty")
    return tables.discover(spark, path, {"scenario": "l_linestatus=([^/]+)", "design": "l_returnflag=([^/]+)"}).select("scenario", "design")


def _land_batches(spark, d) -> str:
    """Scenario records as message batches of ten ids at most; some records doubly encoded."""
    path = scratch_path(spark, "messages")
    records = v.scenario(spark, d)
    body = F.to_json(F.struct(*RECORD))
    twice = F.to_json(F.struct(body.alias("Message")))
    coded = F.struct(F.when(F.col("calculationState") == "F", twice).otherwise(body).alias("body"))
    batch = records.groupBy(F.floor(F.col("scenarioId") / 10).alias("batch")).agg(F.collect_list(coded).alias("Records"))
    batch.select(F.to_json(F.struct("Records")).alias("value")).write.text(path)
    return path


def _typed(records):
    return records.select(
        F.col("scenarioId").cast("bigint").alias("scenarioId"), "scenarioUuid", F.col("scenarioYear").cast("int").alias("scenarioYear"),
        "calculationState", "bucketFolder",
    )


@query("src10_message_batches", f"SELECT {_COLS} FROM scenario")
def src10(spark, d):
    return _typed(messages.decode(spark.read.text(_land_batches(spark, d))))


@query("st1_stream_messages", f"SELECT {_COLS} FROM scenario")
def st1(spark, d):
    out, check = scratch_path(spark, "records"), scratch_path(spark, "checkpoint")
    records = _typed(messages.decode(spark.readStream.text(_land_batches(spark, d))))
    streaming.write_records(records, out, check).awaitTermination()
    return spark.read.parquet(out)


@query("st2_stream_fan_out", _FAN)
def st2(spark, d):
    out, check = scratch_path(spark, "fanout"), scratch_path(spark, "checkpoint")
    records = _typed(messages.decode(spark.readStream.text(_land_batches(spark, d))))
    plans = scenarios.plan_map_long(v.plan_wide(spark, d))
    streaming.write_records(streaming.fan_out(records, plans), out, check).awaitTermination()
    return spark.read.parquet(out)


_STATE = """SELECT coalesce(c.k, u.k) AS "scenarioUuid", CASE WHEN c.k IS NULL THEN u.folder ELSE c.folder END AS "bucketFolder",
    CASE WHEN u.k IS NULL THEN c.state ELSE u.state END AS "calculationState"
    FROM (SELECT 'U' || (c_custkey * 2) AS k, c_name AS folder, c_mktsegment AS state FROM customer) c
    FULL OUTER JOIN (SELECT "scenarioUuid" AS k, arg_min("bucketFolder", "scenarioId") AS folder,
        arg_max("calculationState", "scenarioId") AS state FROM scenario GROUP BY ALL) u ON c.k = u.k"""


@query("st3_stream_state_upsert", _STATE)
def st3(spark, d):
    log, check = scratch_path(spark, "log"), scratch_path(spark, "checkpoint")
    records = _typed(messages.decode(spark.readStream.text(_land_batches(spark, d))))
    updates = records.select("scenarioUuid", "scenarioId", "bucketFolder", "calculationState")
    streaming.log_updates(updates, log, check, ["scenarioUuid"], ["scenarioId"]).awaitTermination()
    base = v.table(spark, d, "customer").select(
        F.concat(F.lit("U"), (F.col("c_custkey") * 2).cast("string")).alias("scenarioUuid"), F.col("c_name").alias("bucketFolder"),
        F.col("c_mktsegment").alias("calculationState"),
    )
    return streaming.read_state(base, log, ["scenarioUuid"], ["calculationState"], ["scenarioId"])


def _land_twice(spark, d) -> str:
    """All scenario records, each in two messages of one id: in batches by their number, and again in other batches."""
    path = scratch_path(spark, "redelivered")
    message = F.struct(
        F.to_json(F.struct(*RECORD)).alias("body"), F.col("scenarioId").cast("string").alias("messageId"),
        F.create_map(F.lit("SentTimestamp"), (F.col("scenarioId") + 1_000_000_000_000).cast("string")).alias("attributes"),
    )
    records = v.scenario(spark, d)
    rounds = [records.groupBy(key.alias("batch")).agg(F.collect_list(message).alias("Records")) for key in (
        F.floor(F.col("scenarioId") / 10), F.concat_ws("-", F.col("scenarioId") % 97, F.floor(F.col("scenarioId") / 1000)))]
    for n, batch in enumerate(rounds):
        batch.select(F.to_json(F.struct("Records")).alias("value")).write.text(f"{path}/round={n}")
    return f"{path}/*"


def _delivered(spark, d):
    """The messages as a stream of several batches."""
    lines = spark.readStream.option("maxFilesPerTrigger", 6).text(_land_twice(spark, d))
    return messages.decode(lines, envelope=True)


@query("st4_fan_out_once_per_message", _FAN)
def st4(spark, d):
    """Records that are delivered twice are fanned out once."""
    out, check = scratch_path(spark, "once"), scratch_path(spark, "checkpoint")
    records = streaming.once(_delivered(spark, d), "36500 days")
    plans = scenarios.plan_map_long(v.plan_wide(spark, d))
    streaming.write_records(streaming.fan_out(_typed(records), plans), out, check).awaitTermination()
    return spark.read.parquet(out)


@query("st5_state_in_partitions", _STATE)
def st5(spark, d):
    """The state by the positions of records that come twice, in any order, in several batches."""
    path, check = scratch_path(spark, "state"), scratch_path(spark, "checkpoint")
    base = v.table(spark, d, "customer").select(
        F.concat(F.lit("U"), (F.col("c_custkey") * 2).cast("string")).alias("scenarioUuid"), F.col("c_name").alias("bucketFolder"),
        F.col("c_mktsegment").alias("calculationState"),
    )
    key, overwrite = ["scenarioUuid"], ["calculationState"]
    state.create(base, path, key, [("scenarioId", "bigint")], overwrite, 16)
    updates = _delivered(spark, d).select("scenarioUuid", F.col("scenarioId").cast("bigint").alias("scenarioId"), "bucketFolder", "calculationState")
    state.keep(updates, path, base.schema, check, key, overwrite, ["scenarioId"]).awaitTermination()
    return state.read(spark, path, base.schema)
