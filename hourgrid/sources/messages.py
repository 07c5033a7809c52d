"""Scenario messages: JSON batches whose records may be encoded once or twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("body", T.StringType()), T.StructField("messageId", T.StringType()), T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]))),
])
TOPIC = T.StructType([T.StructField("Message", T.StringType())])

# fields every scenario record has; all others travel in ``fields``
KNOWN = ["scenarioId", "scenarioUuid", "scenarioYear", "bucketName", "bucketFolder", "calculationState"]


def _record(body: Column) -> Column:
    return F.from_json(body, T.MapType(T.StringType(), T.StringType()))


def decode(batches: DataFrame, column: str = "value", known: Sequence[str] = KNOWN, envelope: bool = False) -> DataFrame:
    """One row per scenario record of JSON batches; works on batch and streaming input.

    A body with a ``Message`` is decoded a second time.  Fields that are not known stay in the ``fields`` map, so a record
    can be passed on whole.  With ``envelope`` a row says which message it came in: ``messageId`` and ``sentAt``, which a
    message keeps however often it is delivered.
    """
    bodies = batches.select(F.explode(F.from_json(F.col(column), BATCH)["Records"]).alias("_r")).select("_r.*")
    inner = F.coalesce(F.from_json(F.col("body"), TOPIC)["Message"], F.col("body"))
    sent = F.timestamp_millis(F.try_element_at("attributes", F.lit("SentTimestamp")).try_cast("bigint")).alias("sentAt")
    outer = [F.col("messageId"), sent] if envelope else []
    records = bodies.select(_record(inner).alias("_m"), *outer).where(F.col("_m").isNotNull())
    rest = F.map_filter("_m", lambda k, _: ~k.isin(list(known)))
    names = [F.try_element_at("_m", F.lit(k)).alias(k) for k in known]
    return records.select(*names, rest.alias("fields"), *[c for c in ("messageId", "sentAt") if envelope])


def encode(records: DataFrame) -> Column:
    """Record back to one JSON text, with its extra fields on the same level."""
    plain = [c for c in records.columns if c != "fields"]
    present = F.map_from_arrays(F.array(*[F.lit(c) for c in plain]), F.array(*[F.col(c).cast("string") for c in plain]))
    known = F.map_filter(present, lambda _, v: v.isNotNull())
    if "fields" not in records.columns:
        return F.to_json(known)
    others = F.map_filter(F.coalesce("fields", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(plain))
    return F.to_json(F.map_concat(known, others))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Landed message files, one JSON document per file."""
    return decode(spark.read.text(path, wholetext=True))


def stream_batches(spark: SparkSession, path: str, files_per_trigger: int | None = None, envelope: bool = False) -> DataFrame:
    """The same as an unbounded input."""
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return decode(reader.text(path, wholetext=True), envelope=envelope)
