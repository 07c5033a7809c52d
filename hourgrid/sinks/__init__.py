"""Writers of curves, results and messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from hourgrid.keys import BY, held


def _writer(df: DataFrame, partition: Sequence[str], mode: str) -> DataFrameWriter:
    """Partitioned by the run keys; an overwrite replaces the runs that ``df`` holds and leaves the others.

    Without any of the keys there is one result, and an overwrite replaces it.
    """
    keys = held(df, partition)
    writer = df.write.mode(mode)
    return writer.option("partitionOverwriteMode", "dynamic").partitionBy(*keys) if keys else writer


def write_table(df: DataFrame, path: str, partition: Sequence[str] = BY, mode: str = "overwrite") -> None:
    """Parquet partitioned by run key: the system of record.

    Rows are not shuffled for the layout; a run's rows may come as several files.
    """
    _writer(df, partition, mode).parquet(path)


def write_csv(
    df: DataFrame, path: str, partition: Sequence[str] = BY, mode: str = "overwrite", sort: Sequence[str] = ()
) -> None:
    """Gzip CSV with semicolons, partitioned by run key."""
    out = df.sortWithinPartitions(*sort) if sort else df
    _writer(out, partition, mode).option("sep", ";").option("header", True).option("compression", "gzip").csv(path)


def write_bucketed(df: DataFrame, path: str, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Hand-over table in buckets of the keys that the next stage joins and sums by; the table, read back.

    Rows are shuffled once, here, so that every bucket is one sorted file; a stage that joins or groups by the keys, or by
    more columns than these, takes the buckets as they are.  The table ``name`` is known to the session's catalog, its files
    lie at ``path``; as many ``buckets`` as the next stage shall have tasks.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def write_by_carrier(df: DataFrame, path: str, by: Sequence[str] = BY, mode: str = "overwrite") -> None:
    """All gases as one dataset with a folder per carrier."""
    write_table(df, path, [*by, "carrier"], mode)


def write_messages(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON text per line; ``df`` has the column ``body``."""
    df.select(F.col("body").alias("value")).write.mode(mode).text(path)
