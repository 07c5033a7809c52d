"""Archives as a data source that plans a partition for each archive and takes filters.

    datasource.register(spark)
    rows = datasource.scan(
        spark, "/runs/*/series.tar.gz", ["assetName", "mw"], keys={"run": "/runs/([^/]+)/"}, where="run = 'r1' AND startswith(member, 'faal')")

Filters on path and keys choose the archives when the scan is planned; filters on members choose whose bodies are parsed;
columns that are not asked for are not cut out of the lines.
"""

from __future__ import annotations

import fnmatch
import json
import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, Not, StringContains, StringEndsWith, StringStartsWith,
)

from hourgrid import files
from hourgrid.sources import packed

NAME = "packed_csv"
PLACE = ("path", "member", "member_pos", "row_idx")
# bytes of small archives that share a partition
SHARED = 64 << 20


def _test(filter: Filter) -> tuple[str, Callable[[str], bool]] | None:
    """Column and test of a filter on a text, None if it is of another kind."""
    if isinstance(filter, Not):
        inner = _test(filter.child)
        return inner and (inner[0], lambda v, t=inner[1]: not t(v))
    tests = {
        EqualTo: lambda f: lambda v: v == f.value, EqualNullSafe: lambda f: lambda v: v == f.value, In: lambda f: lambda v: v in f.value,
        StringStartsWith: lambda f: lambda v: v.startswith(f.value), StringEndsWith: lambda f: lambda v: v.endswith(f.value),
        StringContains: lambda f: lambda v: f.value in v, IsNotNull: lambda f: lambda v: True,
    }
    make = tests.get(type(filter))
    return (filter.attribute[0], make(filter)) if make and len(filter.attribute) == 1 else None


class Archives(InputPartition):
    """Archives that one task reads, with their keys."""

    def __init__(self, found: list[tuple[str, dict[str, str]]]):
        self.found = found


class ArchiveReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: Mapping[str, str]):
        self.schema, self.options = schema, dict(options)
        self.keys: dict[str, str] = json.loads(self.options.get("keys", "{}"))
        self.tests: dict[str, list[Callable[[str], bool]]] = {}
        self.columns = [n for n in schema.names if n not in PLACE and n not in self.keys]

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for filter in filters:
            found = _test(filter)
            if found and found[0] in ("path", "member", *self.keys):
                self.tests.setdefault(found[0], []).append(found[1])
            else:
                yield filter

    def _passes(self, column: str, value: str) -> bool:
        return all(test(value) for test in self.tests.get(column, ()))

    def partitions(self) -> Sequence[InputPartition]:
        out, held, size = [], [], 0
        for path, bytes_ in sorted(listed(self.options["path"])):
            matches = {k: re.search(pattern, path) for k, pattern in self.keys.items()}
            keys = {k: m[1] if m else "" for k, m in matches.items()}
            if not self._passes("path", path) or not all(self._passes(k, v) for k, v in keys.items()):
                continue
            if held and size + bytes_ > SHARED:
                out.append(Archives(held))
                held, size = [], 0
            held.append((path, keys))
            size += bytes_
        return [*out, Archives(held)]  # one at least: Spark reads a partition even of nothing

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        flag = lambda name: self.options.get(name, "false").lower() == "true"
        kinds = {"member_pos": pa.int32(), "row_idx": pa.int64()}
        for path, keys in partition.found:
            with files.open_input(path) as source:
                for batch in packed.records(
                    path, source, self.columns, lambda name: self._passes("member", name), self.options.get("sep", ","),
                    flag("label"), flag("skip_bad"), flag("first_member"),
                ):
                    column = lambda n: pa.repeat(pa.scalar(keys[n]), batch.num_rows) if n in keys else batch.column(n)  # noqa: E731, B023
                    yield pa.RecordBatch.from_arrays([column(n).cast(kinds.get(n, pa.string())) for n in self.schema.names], names=self.schema.names)


class ArchiveSource(DataSource):
    """CSV members of tar.gz archives; every column but the place of a row is text."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        raise ValueError("name the columns to read with a schema, or use datasource.scan")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ArchiveReader(schema, self.options)


def listed(pattern: str) -> list[tuple[str, int]]:
    """Address and size of every file that a pattern with * and ? matches; no file is opened."""
    system, place = files.located(pattern)
    prefix = pattern[: len(pattern) - len(place)] if pattern.endswith(place) else ""
    parts = place.split("/")
    plain = next((k for k, part in enumerate(parts) if re.search(r"[*?\[]", part)), len(parts))
    if plain == len(parts):
        info = system.get_file_info(place)
        if info.type == fs.FileType.File:
            return [(prefix + place, info.size)]
        parts = [*parts, "*"]  # the files of a folder
        plain = len(parts) - 1
    found = ["/".join(parts[:plain])]
    for depth, part in enumerate(parts[plain:], plain):
        last = depth == len(parts) - 1
        below = [i for f in found for i in system.get_file_info(fs.FileSelector(f, allow_not_found=True))]
        below = [i for i in below if fnmatch.fnmatchcase(i.base_name, part) and (i.type == fs.FileType.File) == last]
        if last:
            return [(prefix + i.path, i.size) for i in below]
        found = [i.path for i in below]
    return []


def register(spark: SparkSession) -> None:
    """Make the source known to the session and let it take filters."""
    spark.dataSource.register(ArchiveSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def scan(
    spark: SparkSession, path: str, columns: Sequence[str], keys: Mapping[str, str] | None = None, sep: str = ",", label: bool = True,
    skip_bad: bool = False, first_member: bool = False, where: Column | str | None = None,
) -> DataFrame:
    """Rows of the members with their place, the run ``keys`` that patterns find in the path, and the listed columns as text.

    ``where`` goes to the source as far as it can.  Later filters on the result stay with Spark: a source keeps the filters
    it was given, and a frame that two queries filter in different ways would be read by those of the first.
    With ``first_member`` an archive is read up to its first member that passes the filters, and no further.
    """
    register(spark)
    fields = [("path", T.StringType()), ("member", T.StringType()), ("member_pos", T.IntegerType()), ("row_idx", T.LongType())]
    schema = T.StructType([T.StructField(n, k) for n, k in [*fields, *[(c, T.StringType()) for c in [*(keys or {}), *columns]]]])
    reader = spark.read.format(NAME).schema(schema).option("keys", json.dumps(dict(keys or {}))).option("sep", sep)
    for name, value in (("label", label), ("skip_bad", skip_bad), ("first_member", first_member)):
        reader = reader.option(name, str(value).lower())
    found = reader.load(path) if where is None else reader.load(path).where(where)
    return found.where(F.spark_partition_id() >= 0)  # always true; filters do not move past it
