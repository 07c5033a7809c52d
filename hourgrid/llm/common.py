"""Helpers shared by the text operators: whole rows carried along, text of a row, written intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its plain name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that helper columns beside it cannot clash with theirs."""
    return F.struct(*[col(c) for c in df.columns])


def text_of(df: DataFrame, name: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def kept(df: DataFrame) -> DataFrame:
    """The frame written to the folder of spark.checkpoint.dir and read back, so that lost executors cost no lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet below the shared folder and read back, so that later uses read their columns alone."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
