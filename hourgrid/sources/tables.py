"""Curve files, lookups, network tables and plain tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.functions import positions, text


def _csv(spark: SparkSession, path: str | Sequence[str], sep: str, names: Sequence[str] | None = None) -> DataFrame:
    """Text columns; an empty field is null.  The path of each file is kept."""
    reader = spark.read.option("sep", sep).option("header", True).option("encoding", "UTF-8")
    if names is not None:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return reader.csv(path)


def keys_from_path(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Run keys from the folder names of the files that the rows come from.

    ``patterns`` maps a column to a regular expression with one group.
    """
    found = {name: F.regexp_extract(F.col("_metadata.file_path"), p, 1) for name, p in patterns.items()}
    return df.withColumns(found)


def list_files(spark: SparkSession, path: str | Sequence[str], patterns: Mapping[str, str] | None = None) -> DataFrame:
    """Files below a folder, ``path`` and ``length``, with keys from their folder names; no file is opened.

    Spark lists folders in parallel; a file without rows, as that of an empty design, is found like any other.  Files whose
    path lacks a key are left out.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    keys = {name: F.regexp_extract("path", p, 1) for name, p in (patterns or {}).items()}
    for key in keys.values():
        found = found.where(key != "")
    return found.withColumns(keys)


def discover(spark: SparkSession, path: str | Sequence[str], patterns: Mapping[str, str]) -> DataFrame:
    """The runs, networks or designs that have files below a folder, with the number of files and of bytes."""
    found = list_files(spark, path, patterns)
    return found.groupBy(*patterns).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))


def read_wide_curves(
    spark: SparkSession, path: str | Sequence[str], sites: Sequence[str], hour: str = "hour", sep: str = ";",
    patterns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Wide site curves (one column per site) as long rows; every listed site is a column of the files."""
    fields = [*[T.StructField(s, T.DoubleType()) for s in sites], T.StructField(hour, T.IntegerType())]
    reader = spark.read.option("sep", sep).option("header", True).option("enforceSchema", False)
    wide = reader.schema(T.StructType(fields)).csv(path)
    patterns = patterns or {}
    keyed = keys_from_path(wide, patterns).select(*patterns, *sites, hour)
    long = keyed.unpivot([*patterns, hour], list(sites), "site", "mw").withColumnRenamed(hour, "hour")
    return long.withColumn("mw", text.null_if_nan(F.col("mw")))


def header_of(spark: SparkSession, path: str, sep: str = ";") -> list[str]:
    """Column names of a CSV file; reads its first line only."""
    first = spark.read.text(path).limit(1).collect()[0][0]
    return first.lstrip("﻿").split(sep)


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """Categorisation of market keys; the first column is the key, whatever its header."""
    return _csv(spark, path, ";", ["market_key", "carrier", "product", "category", "sector"])


def read_weights(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Regional weights with decimal commas, nodes in rows and sectors in columns, as long rows."""
    wide = _csv(spark, path, sep)
    node, *sectors = wide.columns
    long = wide.withColumnRenamed(node, "node").unpivot("node", sectors, "sector", "weight")
    return long.withColumn("weight", text.decimal_comma(F.col("weight")))


def read_link_factors(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Length and ends of gas links; other columns of the file are not read."""
    names = ["name", "length_km", "diameter_m", "from_node", "to_node", "_5", "_6", "_7"]
    rows = _csv(spark, path, ";", names).select("name", "length_km", "from_node", "to_node")
    return rows.withColumn("length_km", F.col("length_km").try_cast("double"))


def read_plan_map(spark: SparkSession, path: str) -> DataFrame:
    """Plan map as text: network ids keep their leading zeros."""
    return _csv(spark, path, ";")


def read_sites(
    spark: SparkSession, path: str | Sequence[str], patterns: Mapping[str, str] | None = None, gas: bool = False
) -> DataFrame:
    """Sites with substation, sector and capacity; the first column is the site.

    The substation column may carry a time mark in its header; gas files may name it
    freely as the second column.
    """
    patterns = patterns or {}
    rows = _csv(spark, path, ";")
    names = rows.columns
    substation = next((n for n in ("substation", "substation [t-1]") if n in names), names[1] if gas else None)
    if substation is None:
        raise ValueError(f"no substation column in {names}")
    cols = [F.col(f"`{names[0]}`").alias("site"), F.col(f"`{substation}`").alias("substation")]
    if "sector" in names:
        cols.append(text.sector_name(F.col("sector")).alias("sector"))
    if "capacity" in names:
        cols.append(F.col("capacity").try_cast("double").alias("capacity"))
    return keys_from_path(rows, patterns).select(*patterns, *cols)


def read_substations(
    spark: SparkSession, path: str | Sequence[str], patterns: Mapping[str, str] | None = None
) -> DataFrame:
    """Substations with capacity and number of transformers; the second column is the key."""
    patterns = patterns or {}
    rows = _csv(spark, path, ";")
    key = rows.columns[1]
    return keys_from_path(rows, patterns).select(
        *patterns,
        F.col(f"`{key}`").alias("substation"),
        F.col("capacity").try_cast("double").alias("capacity"),
        F.col("trafos").try_cast("int").alias("trafos"),
    )


def read_names(spark: SparkSession, path: str, pairs: Mapping[str, tuple[str, str]], sep: str = ",") -> DataFrame:
    """Name map: per carrier a pair of columns (raw name, grid name), as long rows in file order."""
    rows = _csv(spark, path, sep)
    placed = _file_order(rows)
    entries = F.array(*[
        F.struct(F.lit(c).alias("carrier"), F.col(f"`{raw}`").alias("raw_name"), F.col(f"`{grid}`").alias("grid_name"))
        for c, (raw, grid) in pairs.items()
    ])
    long = placed.select("row_idx", F.explode(entries).alias("_e")).select("row_idx", "_e.*")
    return long.where(F.col("raw_name").isNotNull())


def _file_order(rows: DataFrame) -> DataFrame:
    """Lines in file order: offset of the split, then position inside it.

    The identifier is taken at the scan, before any shuffle, where partitions follow
    the file; it orders the lines of one file.
    """
    return rows.select("*", F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id")).select(
        *rows.columns, (F.col("_start") * F.lit(1 << 20) + F.col("_id") % F.lit(1 << 33)).alias("row_idx")
    )


def read_prices(
    spark: SparkSession, path: str | Sequence[str], patterns: Mapping[str, str] | None = None
) -> DataFrame:
    """Landed price curves: hour is the line position below the header, counted in each file."""
    patterns = patterns or {}
    rows = _csv(spark, path, ",", ["time", "price"]).withColumn("_file", F.col("_metadata.file_path"))
    placed = _file_order(keys_from_path(rows, patterns))
    source = placed.withColumn("price", F.col("price").try_cast("double"))
    return positions.number_rows(source, [*patterns, "_file"], "row_idx", "hour").select(*patterns, "hour", "price")


def read_document_field(spark: SparkSession, path: str | Sequence[str], field: str, multi_line: bool = True) -> DataFrame:
    """One field of JSON documents, one a file or one a line, with the path of each."""
    docs = spark.read.schema(f"`{field}` STRING").option("multiLine", multi_line).json(path)
    return docs.select(F.col("_metadata.file_path").alias("path"), F.col(field))


def read_network(spark: SparkSession, root: str, network_ids: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Network tables ``bus``, ``line`` and ``trafo``, partitioned by network_id.

    A list of networks prunes the partitions that are read.
    """
    tables = {}
    for name in ("bus", "line", "trafo"):
        # network ids keep their leading zeros: the partition column is declared, not guessed
        found = spark.read.parquet(f"{root}/{name}").schema
        fields = [f for f in found.fields if f.name != "network_id"]
        schema = T.StructType([*fields, T.StructField("network_id", T.StringType())])
        table = spark.read.schema(schema).parquet(f"{root}/{name}")
        tables[name] = table if network_ids is None else table.where(F.col("network_id").isin(list(network_ids)))
    return tables


def read_database(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None, **options: str) -> DataFrame:
    """Table of a relational database; filters and limits are pushed down.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` to
    read it in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {}))
    return reader.options(**options).load()
