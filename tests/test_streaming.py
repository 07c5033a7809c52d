"""Streams of scenario records: fan-out, redelivery, state."""

import json

from conftest import rows
from pyspark.sql import functions as F

from hourgrid import streaming
from hourgrid.sources import messages


def land(folder, name, *records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps({"Records": [{"body": json.dumps(r)} for r in records]}))


def record(i, state, folder="f"):
    return {"scenarioId": i, "scenarioUuid": f"u{i}", "scenarioYear": 2030, "calculationState": state, "bucketFolder": folder}


def test_fan_out_resumes_where_it_stopped(spark, tmp_path):
    plans = spark.createDataFrame([("P1", "2030", "0001"), ("P2", "2030", "0002"), ("P3", "2035", "0003")], "plan string, year string, network_id string")

    def run():
        records = streaming.stream_batches(spark, str(tmp_path / "in"), 1).drop("fields")
        streaming.write_records(streaming.fan_out(records, plans), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")), "scenarioId", "investmentPath", "networkId")

    land(tmp_path / "in", "1.json", record(1, "new"))
    assert run() == [("1", "P1", "0001"), ("1", "P2", "0002")]
    land(tmp_path / "in", "2.json", record(2, "new"))
    # the first file is not read again
    assert run() == [("1", "P1", "0001"), ("1", "P2", "0002"), ("2", "P1", "0001"), ("2", "P2", "0002")]


def updates_of(spark, folder):
    records = messages.decode(spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder), wholetext=True))
    return records.select("scenarioId", "bucketFolder", "calculationState")


def test_redelivery_changes_nothing(spark, tmp_path):
    key, overwrite, order = ["scenarioId"], ["calculationState"], ["calculationState"]
    base = spark.createDataFrame([("1", "kept", "a-new")], "scenarioId string, bucketFolder string, calculationState string")
    land(tmp_path / "in", "1.json", record(1, "b-started"), record(2, "a-new", "first"))

    def run(check):
        query = streaming.log_updates(updates_of(spark, tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / check), key, order)
        query.awaitTermination()
        return rows(streaming.read_state(base, str(tmp_path / "log"), key, overwrite, order))

    first = [("1", "kept", "b-started"), ("2", "first", "a-new")]
    assert run("check") == first
    # a lost checkpoint delivers the same batch again
    assert run("check-lost") == first
    land(tmp_path / "in", "2.json", record(2, "b-started", "second"), record(2, "c-done", "third"))
    assert run("check") == [("1", "kept", "b-started"), ("2", "first", "c-done")]


def test_compacted_state_is_a_new_base(spark, tmp_path):
    key, overwrite, order = ["scenarioId"], ["calculationState"], ["calculationState"]
    base = spark.createDataFrame([], "scenarioId string, bucketFolder string, calculationState string")
    land(tmp_path / "in", "1.json", record(1, "a"))
    args = (str(tmp_path / "log"), str(tmp_path / "check"), key, order)
    streaming.log_updates(updates_of(spark, tmp_path / "in"), *args).awaitTermination()
    state = streaming.read_state(base, str(tmp_path / "log"), key, overwrite, order)
    base = streaming.compact_state(spark, state, str(tmp_path / "base1"))
    land(tmp_path / "in", "2.json", record(1, "b", "later"))
    streaming.log_updates(updates_of(spark, tmp_path / "in"), *args).awaitTermination()
    got = streaming.read_state(base, str(tmp_path / "log"), key, overwrite, order, {streaming.stream_name(str(tmp_path / "check")): 0})
    assert rows(got) == [("1", "f", "b")]
    assert got.where(F.col("scenarioId") == "1").count() == 1
