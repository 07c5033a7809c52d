"""A state table in hash partitions of its key, of which an update rewrites those that it touches.

Rows carry the positions of the first and the last update that made them.  The first update of a key inserts, the last sets
the overwritten columns, both by the position of the record itself, so updates may come in any order and any number of
times, in one batch or in many: the state is the same.  Rows of the table that a state starts from lie before all updates.

A batch writes its partitions to a folder of its own and then adds one line per partition to the list of versions.  A reader
takes the last version of each, so a batch that fails half way is not seen, and one that is repeated changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

PARTITIONS = 64
MARKS = ("_first", "_last")


def _at(order: Sequence[str], values: Sequence[str], updates: DataFrame) -> Column:
    """Position of an update; records at one position are told apart by their values."""
    text = lambda c: F.col(c).cast("string") if c in updates.columns else F.lit(None).cast("string")
    return F.struct(*[F.col(c) for c in order], *[text(c).alias(f"_v{k}") for k, c in enumerate(values)])


def _partition(key: Sequence[str], partitions: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in key]), F.lit(partitions)).cast("int")


def create(base: DataFrame, path: str, key: Sequence[str], order: Sequence[tuple[str, str]], overwrite: Sequence[str], partitions: int = PARTITIONS) -> None:
    """Start a state from a table; ``order`` names the columns of a position with their types."""
    values = [c for c in base.columns if c not in key]
    kinds = [*order, *[(f"_v{k}", "string") for k in range(len(values))]]
    mark = F.lit(None).cast("struct<" + ",".join(f"`{n}`:{t}" for n, t in kinds) + ">")
    _write(base.select("*", *[mark.alias(m) for m in MARKS]), path, key, partitions, 0)


def _write(rows: DataFrame, path: str, key: Sequence[str], partitions: int, number: int) -> None:
    """One version of the partitions that the rows belong to."""
    folder = f"{path.rstrip('/')}/version-{number}-{uuid.uuid4().hex}"
    placed = rows.withColumn("_partition", _partition(key, partitions))
    placed.repartition("_partition").write.partitionBy("_partition").parquet(folder)
    spark = rows.sparkSession
    written = spark.read.schema(placed.schema).parquet(folder).select("_partition").distinct().collect()  # from the names of folders
    lines = [(r[0], number, f"{folder}/_partition={r[0]}", partitions) for r in written] or [(-1, number, folder, partitions)]
    lines = spark.createDataFrame(lines, "partition int, number long, folder string, partitions int")
    lines.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/_versions")  # a line per partition


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The last version of each partition: ``partition``, ``number``, ``folder``."""
    found = spark.read.parquet(f"{path.rstrip('/')}/_versions").where("partition >= 0")
    return found.groupBy("partition").agg(F.max_by(F.struct("number", "folder"), F.struct("number", "folder")).alias("_l")).select("partition", "_l.*")


def _last_number(spark: SparkSession, path: str) -> tuple[int, int]:
    return tuple(spark.read.parquet(f"{path.rstrip('/')}/_versions").agg(F.max("number"), F.max("partitions")).first())


def read(spark: SparkSession, path: str, schema: T.StructType, parts: Sequence[int] | None = None, marks: bool = False) -> DataFrame:
    """The state, or some partitions of it, with the columns of ``schema``; with the ``marks`` of its rows if asked for."""
    found = versions(spark, path)
    if parts is not None:
        found = found.where(F.col("partition").isin(list(parts)))
    folders = [r["folder"] for r in found.collect()]  # one per partition
    if not folders:
        return spark.createDataFrame([], schema)
    whole = spark.read.parquet(*folders)
    return whole if marks else whole.select(*schema.names)


def apply(updates: DataFrame, path: str, schema: T.StructType, key: Sequence[str], overwrite: Sequence[str], order: Sequence[str]) -> list[int]:
    """Bring updates into the state; the partitions that were rewritten.

    ``order`` are the columns of a record's own position, as the time it was sent and its id.  Columns of the state that the
    updates lack are null in rows that they insert.  Only the partitions of the updates' keys are read and written.
    """
    spark, key = updates.sparkSession, list(key)
    number, partitions = _last_number(spark, path)
    values = [c for c in schema.names if c not in key]
    inserted = [c for c in values if c not in overwrite]
    have = lambda names: F.struct(*[F.col(c) if c in updates.columns else F.lit(None).cast(schema[c].dataType).alias(c) for c in names])
    at = _at(order, values, updates)
    names = [f"_k{k}" for k in range(len(key))]
    changes = updates.groupBy(*key).agg(
        F.min_by(have(inserted), at).alias("_ins") if inserted else F.first(F.lit(None)).alias("_ins"),
        F.max_by(have(overwrite), at).alias("_new"), F.min(at).alias("_from"), F.max(at).alias("_to"),
    ).withColumn("_partition", _partition(key, partitions)).withColumnsRenamed(dict(zip(key, names)))
    changes = changes.persist()
    try:
        touched = sorted(r[0] for r in changes.select("_partition").distinct().collect())  # at most the partitions of the state
        if not touched:
            return []
        found = versions(spark, path).where(F.col("partition").isin(touched)).collect()
        marks = spark.read.parquet(*[r["folder"] for r in found]) if found else None
        if marks is None:
            kind = changes.schema["_to"].dataType
            marks = spark.createDataFrame([], T.StructType([*schema.fields, *[T.StructField(m, kind) for m in MARKS]]))
        # null-safe: a key may be missing
        same = [marks[k].eqNullSafe(changes[n]) for k, n in zip(key, names)]
        both = marks.withColumn("_known", F.lit(True)).join(changes.drop("_partition"), same, "full_outer")
        hit, known = F.col("_to").isNotNull(), F.coalesce("_known", F.lit(False))
        # a row that no update has made lies before all
        later = hit & (F.col("_last").isNull() | (F.col("_to") > F.col("_last")))
        earlier = hit & ~known | hit & known & F.col("_first").isNotNull() & (F.col("_from") < F.col("_first"))
        column = {c: F.when(later, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in overwrite}
        column |= {k: F.coalesce(k, n).alias(k) for k, n in zip(key, names)}
        column |= {c: F.when(earlier, F.col(f"_ins.{c}")).otherwise(F.col(c)).alias(c) for c in inserted}
        merged = both.select(
            *[column[c] for c in schema.names],
            F.when(earlier, F.col("_from")).otherwise(F.col("_first")).alias("_first"), F.when(later, F.col("_to")).otherwise(F.col("_last")).alias("_last"),
        )
        _write(merged, path, key, partitions, number + 1)
        return touched
    finally:
        changes.unpersist()


def keep(
    updates: DataFrame, path: str, schema: T.StructType, checkpoint: str, key: Sequence[str], overwrite: Sequence[str], order: Sequence[str],
    available_now: bool = True,
) -> StreamingQuery:
    """Bring every batch of a stream into the state; one writer per state."""
    writer = updates.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: apply(batch, path, schema, key, overwrite, order) and None)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
