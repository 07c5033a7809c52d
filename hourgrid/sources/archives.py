"""CSV members of tar.gz archives as rows.

The plan holds the paths of archives only.  A gzip stream cannot be split, so one archive is read by one task, as a stream of
constant memory, and the archives of all scenarios are read side by side; those of ``sinks.packed`` also in parts, by its manifest.  The worker only unpacks and parses; what the rows
mean is decided by DataFrame operators.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import files
from hourgrid.functions import positions
from hourgrid.sources import packed

_PLACE = [
    T.StructField("path", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("member_pos", T.IntegerType()),
    T.StructField("row_idx", T.LongType()),
]
CELLS = T.StructType([*_PLACE, T.StructField("column", T.StringType()), T.StructField("value", T.StringType())])


def _archives(spark: SparkSession, path: str | Sequence[str], loaded: bool) -> DataFrame:
    """Paths of the archives, listed by Spark without reading any; with their bytes if ``loaded``."""
    found = spark.read.format("binaryFile").load(path)
    return found.select("path", "content") if loaded else found.select("path")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, io.RawIOBase]]:
    for batch in batches:
        for row in range(batch.num_rows):
            path = batch.column(0)[row].as_py()
            if batch.num_columns > 1:
                yield path, io.BytesIO(batch.column(1)[row].as_py())
            else:
                with files.open_input(path) as source:
                    yield path, source


def _starting(prefix: str | None) -> packed.Wanted:
    return lambda name: prefix is None or name.startswith(prefix)


def read_records(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    sep: str = ",",
    label: bool = True,
    skip_bad: bool = False,
    member: str | None = None,
    loaded: bool = False,
) -> DataFrame:
    """Rows of all members with the listed columns as text; a column a member lacks is null.

    ``label`` drops a leading row label, ``skip_bad`` skips lines with too many fields, ``member`` keeps the members whose
    name starts so.  ``loaded`` takes whole archives through Spark, 2 GiB each at most, for stores that only Spark reads.
    """
    columns = list(columns)
    schema = T.StructType([*_PLACE, *[T.StructField(c, T.StringType()) for c in columns]])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path_, source in _opened(batches):
            yield from packed.records(path_, source, columns, _starting(member), sep, label, skip_bad)

    return _archives(spark, path, loaded).mapInArrow(parse, schema)


def text_cells(
    spark: SparkSession,
    path: str | Sequence[str] | DataFrame,
    sep: str = ",",
    label: bool = True,
    drop: Sequence[str] = ("Time",),
    skip_bad: bool = False,
    member: str | None = None,
    loaded: bool = False,
    keep_label: bool = False,
    missing: bool = True,
) -> DataFrame:
    """Wide curve members as long cells of text (row, column, value); missing readings are null.

    ``keep_label`` puts the row label of a cell beside it, as ``label``; without ``missing`` cells without a reading are left
    out.  In place of paths the manifest of ``sinks.packed.write_archives`` may be given: its archives are read in parts, by
    as many tasks.
    """
    wanted, cut = _starting(member), packed.Cut(sep, label, skip_bad, list(drop), keep_label, missing)
    schema = T.StructType([*CELLS, T.StructField("label", T.StringType())]) if keep_label else CELLS

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path_, source in _opened(batches):
            yield from packed.cells(path_, source, wanted, cut)

    def parse_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] is None:  # one written before manifests told of parts
                    with files.open_input(row["path"]) as source:
                        yield from packed.cells(row["path"], source, wanted, cut)
                elif wanted(row["part"]["member"]):
                    yield from packed.part_cells(row["path"], row["part"], cut)

    if isinstance(path, DataFrame):
        if loaded:
            raise ValueError("parts of archives are read where they lie, not through Spark")
        n = path.agg(F.sum(F.greatest(F.size("parts"), F.lit(1)))).first()[0]
        return path.select("path", F.explode_outer("parts").alias("part")).repartition(n or 1).mapInArrow(parse_parts, schema)
    return _archives(spark, path, loaded).mapInArrow(parse, schema)


def read_cells(spark: SparkSession, path: str | Sequence[str] | DataFrame, **options) -> DataFrame:
    """The cells as numbers; see ``checks.unreadable_numbers`` for those that are none."""
    return text_cells(spark, path, **options).withColumn("value", number(F.col("value")))


def wide_cells(spark: SparkSession, path: str | Sequence[str], sep: str = ";", hour: str | None = "hour") -> DataFrame:
    """Wide curve files, gzip or plain, as long cells of text (path, hour, site, value).

    Each file may have columns of its own: its first line names them and is joined to its
    other lines by path.  Fields are plain: quotes around one are taken off, a separator
    inside one is not expected.  Without an ``hour`` column the position of the row is the
    hour.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"), F.col("value").alias("_line"),
    )
    heads = lines.where(F.col("_start") == 0).groupBy("path").agg(F.min_by("_line", "_id").alias("_head"))
    plain = lambda c: F.regexp_replace(F.trim(c), r'^["\ufeff]+|"$', "")
    fields = lambda c: F.transform(F.split(c, f"\\Q{sep}\\E", -1), plain)
    rows = lines.join(heads, "path").where((F.col("_line") != F.col("_head")) & (F.trim("_line") != ""))
    rows = rows.withColumn("_names", fields(F.col("_head"))).withColumn("_values", fields(F.col("_line")))
    if hour is None:
        # ids follow the file inside a split, splits follow by their start
        order = F.col("_start") * F.lit(1 << 20) + F.col("_id") % F.lit(1 << 33)
        rows = positions.number_rows(rows.withColumn("_order", order), ["path"], "_order", "hour")
    else:
        at = F.array_position("_names", F.lit(hour)).cast("int")
        rows = rows.withColumn("hour", F.element_at("_values", at).cast("int"))
    cells = rows.select("path", "hour", F.explode(F.arrays_zip("_names", "_values")).alias("_c"))
    cells = cells.select("path", "hour", F.col("_c._names").alias("site"), F.col("_c._values").alias("value"))
    return cells if hour is None else cells.where(F.col("site") != hour)


def read_wide_files(spark: SparkSession, path: str | Sequence[str], sep: str = ";", hour: str | None = "hour") -> DataFrame:
    """Wide curve files as long cells (path, hour, site, mw); see ``checks.unreadable_numbers`` for fields that are no number."""
    return wide_cells(spark, path, sep, hour).select("path", "hour", "site", number(F.col("value")).alias("mw"))


def number(text: Column) -> Column:
    """A number, null for an empty field and for what is no number."""
    value = text.try_cast("double")
    return F.when(~F.isnan(value), value)


def first_member(rows: DataFrame, prefix: str, archive: Sequence[str] = ("path",)) -> DataFrame:
    """Rows of the first member of each archive whose name starts with ``prefix``."""
    found = rows.where(F.col("member").startswith(prefix))
    pick = found.groupBy(*archive).agg(F.min("member_pos").alias("member_pos"))
    return found.join(pick, [*archive, "member_pos"], "left_semi")


def site_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Raw asset series of a simulation archive."""
    return site_texts(spark, path).withColumn("allocationPower", number(F.col("allocationPower")))


def site_texts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The same with readings as they are written."""
    names = ["assetName", "assetClass", "carrierId", "sector", "allocationPower"]
    return read_records(spark, path, names, sep=",", label=True, skip_bad=True)


def market_curves(spark: SparkSession, path: str | Sequence[str], member: str = "merit_order.csv", label: bool = False) -> DataFrame:
    """Market curves of an archive: market_key, hour, mw."""
    cells = read_cells(spark, path, sep=",", label=label, member=member)
    return cells.select(
        "path", F.col("column").alias("market_key"), F.col("row_idx").cast("int").alias("hour"), F.col("value").alias("mw")
    )


def gas_site_curves(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Gas site curves of an archive; the member name is the carrier."""
    cells = read_cells(spark, path, sep=";", label=True)
    return cells.select(
        "path",
        F.regexp_extract("member", r"([^/]+)\.csv$", 1).alias("carrier"),
        F.col("row_idx").cast("int").alias("hour"),
        F.col("column").alias("site"),
        F.col("value").alias("mw"),
    )


def link_flows(spark: SparkSession, path: str | Sequence[str], prefix: str = "faal") -> DataFrame:
    """Gas link flows: the first member of each archive with the prefix."""
    rows = read_records(spark, path, ["naam", "berekening", "voorwaarde"], sep=";", label=True, member=prefix)
    numbers = {c: F.col(c).try_cast("double") for c in ("berekening", "voorwaarde")}
    return first_member(rows, prefix).withColumns(numbers)
