"""State under redelivery: any order, repetition and cut into batches gives one state, and only touched partitions are rewritten."""

import json
import random
from datetime import datetime, timezone
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import types as T

from hourgrid import streaming
from hourgrid.operators import scenarios
from hourgrid.sources import messages
from hourgrid.streaming import state

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "folder", "state")])
UPDATE = "id string, folder string, state string, sent long, message string"
ORDER = [("sent", "bigint"), ("message", "string")]
KEY, OVERWRITE, AT = ["id"], ["state"], ["sent", "message"]


def started(spark, path, base, partitions=8):
    state.create(spark.createDataFrame(base, SCHEMA), str(path), KEY, ORDER, OVERWRITE, partitions)
    return str(path)


def apply(spark, path, updates):
    return state.apply(spark.createDataFrame(updates, UPDATE), path, SCHEMA, KEY, OVERWRITE, AT)


def expected(base, updates):
    """The base with all updates in the order of their positions; the first inserts, the last sets the state."""
    table = {r[0]: list(r) for r in base}
    for key, folder, value, sent, message in sorted(updates, key=lambda u: (u[3], u[4], u[1], u[2])):
        table.setdefault(key, [key, folder, value])[2] = value
    return sorted(map(tuple, table.values()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_delivery_gives_one_state(spark, tmp_path, seed):
    draw = random.Random(seed)
    base = [(f"k{k}", "base", "new") for k in range(6)]
    sent = [(f"k{draw.randrange(12)}", f"f{n}", draw.choice(["started", "done", "failed"]), draw.randrange(8), f"m{n % 15}") for n in range(20)]
    path = started(spark, tmp_path / "state", base)
    delivered = sent + draw.choices(sent, k=20)
    draw.shuffle(delivered)
    cuts = sorted(draw.sample(range(len(delivered)), 3))
    for a, b in zip([0, *cuts], [*cuts, len(delivered)]):
        apply(spark, path, delivered[a:b])
    assert rows(state.read(spark, path, SCHEMA)) == expected(base, sent)


def test_an_older_message_does_not_turn_the_state_back(spark, tmp_path):
    path = started(spark, tmp_path / "state", [("a", "f", "new")])
    kicked, done = ("a", "x", "kickedOff", 1, "m1"), ("a", "x", "done", 2, "m2")
    for batch in ([kicked], [done], [kicked], [kicked, done], [("b", "late", "done", 9, "m9")], [("b", "early", "kickedOff", 3, "m3")]):
        apply(spark, path, batch)
    assert rows(state.read(spark, path, SCHEMA)) == [("a", "f", "done"), ("b", "early", "done")]


def test_an_update_of_five_keys_touches_five_partitions(spark, tmp_path):
    base = [(f"k{k}", "base", "new") for k in range(500)]
    path = started(spark, tmp_path / "state", base, 64)
    keys = [f"k{k * 31}" for k in range(5)]
    wanted = {r["folder"] for r in state.versions(spark, path).collect()}
    probe = spark.createDataFrame([(k,) for k in keys], "id string").select(state._partition(KEY, 64).alias("p"))
    mine = {r["p"] for r in probe.collect()}
    assert len(wanted) == 64 and len(mine) <= 5
    # whoever reads another partition fails
    for folder in wanted:
        if int(folder.rsplit("=", 1)[1]) not in mine:
            for file in Path(folder).glob("*.parquet"):
                file.write_bytes(b"broken")
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    assert set(apply(spark, path, [(k, "x", "done", 1, "m") for k in keys])) == mine
    new = {r["folder"] for r in state.versions(spark, path).collect()} - wanted
    assert len(new) == len(mine)
    got = {r["id"]: r["state"] for r in state.read(spark, path, SCHEMA, sorted(mine)).collect()}
    assert all(got[k] == "done" for k in keys) and set(got.values()) == {"done", "new"}


def test_a_version_that_is_not_listed_is_not_read(spark, tmp_path):
    path = started(spark, tmp_path / "state", [("a", "f", "new")])
    before = rows(state.read(spark, path, SCHEMA))
    frame = spark.createDataFrame([("a", "f", "half")], SCHEMA)
    frame.withColumn("_partition", state._partition(KEY, 8)).write.partitionBy("_partition").parquet(f"{path}/version-1-dead")
    assert rows(state.read(spark, path, SCHEMA)) == before


def test_edges(spark, tmp_path):
    path = started(spark, tmp_path / "state", [])
    assert rows(state.read(spark, path, SCHEMA)) == [] and apply(spark, path, []) == []
    apply(spark, path, [(None, "f", "x", None, None), (None, "f", "y", 1, "m")])
    apply(spark, path, [(None, "g", "x", None, None), ("a", None, None, 1, "m")])
    assert rows(state.read(spark, path, SCHEMA)) == [("a", None, None), (None, "f", "y")]
    slim = spark.createDataFrame([("c", "z", 5, "m")], "id string, state string, sent long, message string")
    state.apply(slim, path, SCHEMA, KEY, OVERWRITE, AT)
    assert ("c", None, "z") in rows(state.read(spark, path, SCHEMA))


def land(folder, name, *sent):
    """One file of messages (id, seconds after noon, record)."""
    folder.mkdir(parents=True, exist_ok=True)
    noon = datetime(2030, 1, 1, 12, tzinfo=timezone.utc).timestamp()
    found = [{"messageId": m, "attributes": {"SentTimestamp": str(int((noon + s) * 1000))}, "body": json.dumps(r)} for m, s, r in sent]
    (folder / name).write_text(json.dumps({"Records": found}))


def record(i, value, folder="f"):
    return {"scenarioId": i, "scenarioUuid": f"u{i}", "scenarioYear": 2030, "calculationState": value, "bucketFolder": folder}


def test_fan_out_once_per_message(spark, tmp_path):
    plans = spark.createDataFrame([("P1", "2030", "0001"), ("P2", "2030", "0002")], "plan string, year string, network_id string")
    land(tmp_path / "in", "1.json", ("a", 0, record(1, "new")), ("b", 1, record(2, "new")))
    land(tmp_path / "in", "2.json", ("a", 0, record(1, "new")))
    land(tmp_path / "in", "3.json", ("b", 1, record(2, "new")), ("c", 30, record(1, "new")), ("c", 30, record(1, "new")))

    def run():
        given = streaming.stream_batches(spark, str(tmp_path / "in"), 1, envelope=True).drop("fields")
        made = streaming.fan_out(streaming.once(given, "1 hour"), plans)
        streaming.write_records(made, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")), "messageId", "scenarioId", "investmentPath")

    want = [(m, i, p) for m, i in (("a", "1"), ("b", "2"), ("c", "1")) for p in ("P1", "P2")]
    assert run() == want
    # the state store outlives the query
    land(tmp_path / "in", "4.json", ("c", 30, record(1, "new")), ("a", 0, record(1, "new")))
    assert run() == want


def test_a_stream_keeps_the_state(spark, tmp_path):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("scenarioId", "bucketFolder", "calculationState")])
    path = str(tmp_path / "state")
    order = [("sentAt", "timestamp"), ("messageId", "string")]
    state.create(spark.createDataFrame([("1", "kept", "new")], schema), path, ["scenarioId"], order, ["calculationState"], 4)
    land(tmp_path / "in", "1.json", ("a", 0, record(1, "kickedOff")), ("b", 1, record(2, "kickedOff", "first")))
    land(tmp_path / "in", "2.json", ("c", 9, record(1, "done")), ("d", 9, record(2, "done", "second")))
    land(tmp_path / "in", "3.json", ("a", 0, record(1, "kickedOff")))

    def run(check):
        given = messages.decode(spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"), wholetext=True), envelope=True)
        updates = given.select("scenarioId", "bucketFolder", "calculationState", "sentAt", "messageId")
        state.keep(updates, path, schema, str(tmp_path / check), ["scenarioId"], ["calculationState"], ["sentAt", "messageId"]).awaitTermination()
        return rows(state.read(spark, path, schema))

    want = [("1", "kept", "done"), ("2", "first", "done")]
    assert run("check") == want
    assert run("check-lost") == want  # all messages once more


def test_the_log_goes_by_positions(spark, tmp_path):
    """A record that a later batch delivers again does not turn back the state that the log gives."""
    base = spark.createDataFrame([("a", "f", "new")], SCHEMA)
    for n, (value, sent) in enumerate([("kickedOff", 1), ("done", 2), ("kickedOff", 1)]):
        update = spark.createDataFrame([("a", "f", value, sent)], "id string, folder string, state string, sent long")
        update.write.parquet(f"{tmp_path}/log/stream=s1/batch_id={n}")
    assert rows(streaming.read_state(base, f"{tmp_path}/log", KEY, OVERWRITE, ["sent"])) == [("a", "f", "done")]
    assert scenarios.upsert(base, base.limit(0), KEY, OVERWRITE, ["folder"]).count() == 1
