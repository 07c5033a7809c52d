"""One file per run: wide node files and archives of wide members, written as streams by tasks.

A run is read by the next tool as a whole, so its file is one task's work.  What can be large about it is dealt with before:
rows meet per run, member and hour first, evenly, and become one line's cells; only lines go to the task of their file, in
order, behind a header with the run's own nodes.  A task holds one line at a time.  Node files are tiled beyond TILE columns.
Members of archives are cut at hours into parts, which many tasks make to text and deflate; the task of an archive puts the
deflated parts one behind the other, as one gzip stream.  The manifest tells where each part lies, so that readers who have
it take the parts apart.

A member of an archive is preceded by its size.  Sizes are worked out with the headers, from the lengths of all cells, so
nothing is spooled; a body of another length than said is an error.

A file's name holds the attempt that writes it, and what a finished attempt has written stands in a manifest that Spark
commits with the job.  Readers go by the manifest, so files of attempts that were killed, or of older writes of a run, are
never read.
"""

from __future__ import annotations

import gzip
import struct
import tarfile
import time
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, groupby
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hourgrid import files
from hourgrid.keys import sliced_join

# columns of one wide file
TILE = 4000
# bytes of nodes and cells that are made to lines of an archive at a time
PART = 16 << 20


class Line(NamedTuple):
    """A header (with ``names`` and the ``size`` of the lines below it) or a line (with ``cells``) of one member."""

    run: tuple
    tile: int
    member: str
    names: list[str] | None
    size: int | None
    hour: int | None
    cells: list[tuple[str, str]] | None
    part: int = 0


class Block(NamedTuple):
    """Deflated text of lines of one member that follow each other, after the header in its first block."""

    run: tuple
    tile: int
    member: str
    part: int
    said: int  # bytes of all lines of the member
    head: int  # bytes of the header, in its first block
    n: int
    columns: int
    size: int
    crc: int
    data: bytes


def _quoted(c: Column, sep: str) -> Column:
    special = c.contains(sep) | c.rlike('["\\r\\n]')
    return F.when(special, F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def _lines(rows: DataFrame, by: Sequence[str], member: Column, hour: str, node: str, value: str, sep: str, tile: int | None) -> DataFrame:
    """Headers and lines, each file's in one partition and in order."""
    cell = F.coalesce(_quoted(F.col(value).cast("string"), sep), F.lit(""))
    # keys beside their text: the file's place is made of it
    run = F.struct(*[F.col(c).cast("string").alias(c) for c in by]) if by else F.struct(F.lit("").alias("_"))
    slim = rows.select(run.alias("run"), member.alias("member"), F.col(hour).cast("long").alias("hour"), F.col(node).cast("string").alias("node"), cell.alias("cell"))
    slim = slim.where("node IS NOT NULL AND hour IS NOT NULL")
    if tile is None:
        slim = slim.withColumn("tile", F.lit(0))
    else:
        nodes = slim.select("run", "node").distinct().groupBy("run").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
        slim = sliced_join(slim, nodes, ["run"]).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).drop("tiles")
    file = ["run", "tile", "member"]
    lines = slim.groupBy(*file, "hour").agg(
        F.collect_list(F.struct("node", "cell")).alias("cells"), F.sum(F.octet_length("cell")).alias("bytes"),
    )
    names = slim.select(*file, "node").distinct().groupBy(*file).agg(F.array_sort(F.collect_list("node")).alias("names"))
    # a line has its hour, a separator and a cell for each node, and an end
    label = F.octet_length(F.col("hour").cast("string"))
    sizes = lines.groupBy(*file).agg(F.sum(F.col("bytes") + label + 1).alias("bytes"), F.count(F.lit(1)).alias("n"))
    heads = names.join(sizes, file).select(
        *file, "names", (F.col("bytes") + F.col("n") * F.size("names") * len(sep.encode())).cast("long").alias("size"),
        F.lit(None).cast("long").alias("hour"), F.lit(None).cast(lines.schema["cells"].dataType).alias("cells"),
    )
    body = lines.select(*file, F.lit(None).cast("array<string>").alias("names"), F.lit(None).cast("long").alias("size"), "hour", "cells")
    if tile is not None:
        return heads.unionByName(body).repartition("run", "tile").sortWithinPartitions(*file, F.col("hour").asc_nulls_first())
    # a header for each part of a member, so that its lines are made in many tasks; the window sees hours without cells
    hours = slim.groupBy(*file, "hour").agg(F.sum(F.octet_length("node") + F.octet_length("cell") + 1).alias("weight"))
    before = F.sum("weight").over(Window.partitionBy(*file).orderBy("hour")) - F.col("weight")
    hours = hours.select(*file, "hour", F.floor(before / PART).cast("int").alias("part"))
    heads = heads.join(hours.select(*file, "part").distinct(), file)
    body = body.join(hours, [*file, "hour"], "left")
    order = [*file, F.col("part"), F.col("hour").asc_nulls_first()]
    return heads.unionByName(body).select(*Line._fields).repartition(*file, "part").sortWithinPartitions(*order)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Line]:
    at = Line._fields.index("cells")
    for batch in batches:
        columns = batch.columns
        pairs, columns[at] = columns[at], pa.nulls(batch.num_rows)
        inside, first = pairs.flatten(), 0
        nodes, texts = inside.field("node"), inside.field("cell")
        for (run, *given), n in zip(zip(*(c.to_pylist() for c in columns)), pairs.value_lengths().to_pylist()):
            if n is not None:
                given[at - 1] = list(zip(nodes.slice(first, n).to_pylist(), texts.slice(first, n).to_pylist()))
                first += n
            yield Line(tuple(run.items()), *given)


def _name(name: str, sep: str) -> str:
    special = any(c in name for c in (sep, '"', "\r", "\n"))
    return '"' + name.replace('"', '""') + '"' if special else name


def _texts(head: Line, lines: Iterator[Line], label: str, sep: str) -> Iterator[bytes]:
    """The lines of a member, its header first."""
    yield (sep.join([label, *(_name(n, sep) for n in head.names)]) + "\n").encode()
    place = {name: k for k, name in enumerate(head.names, 1)}  # behind the hour
    empty = [""] * (len(place) + 1)
    for line in lines:
        cells = dict(line.cells)
        if len(cells) < len(line.cells):
            raise ValueError(f"{head.run} {head.member}: hour {line.hour} has a node twice")
        fields = empty.copy()
        fields[0] = str(line.hour)
        for node, cell in cells.items():
            fields[place[node]] = cell
        yield (sep.join(fields) + "\n").encode()


def _deflated(texts: Iterable[bytes]) -> tuple[int, int, bytes]:
    """Size and checksum of the texts, and deflate blocks of them that end with a byte and look at no other piece."""
    pack, pieces, size, crc = zlib.compressobj(wbits=-zlib.MAX_WBITS), [], 0, 0
    for text in texts:
        pieces.append(pack.compress(text))
        size, crc = size + len(text), zlib.crc32(text, crc)
    return size, crc, b"".join([*pieces, pack.flush(zlib.Z_FULL_FLUSH)])


def _zeros(size: int, crc: int) -> int:
    """The checksum of a text that ends with zeros, by that of what is before them."""
    zeros = bytes(1 << 20)
    for at in range(0, size, len(zeros)):
        crc = zlib.crc32(zeros[: size - at], crc)
    return crc


class _Gzip:
    """One gzip stream of pieces that were deflated apart."""

    def __init__(self, out):
        self.out, self.size, self.crc = out, 0, 0
        self.at = out.write(b"\x1f\x8b\x08\0\0\0\0\0\0\xff")  # bytes written

    def add(self, size: int, crc: int, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)
        # that of both texts: zeros move the first one's to its place
        self.size, self.crc = self.size + size, _zeros(size, self.crc) ^ _zeros(size, 0) ^ crc

    def end(self) -> None:
        self.out.write(b"\x03\0" + struct.pack("<II", self.crc, self.size & 0xFFFFFFFF))


def _blocks(lines: Iterator[Line], sep: str) -> Iterator[Block]:
    """A block for each part of a member, its header first."""
    for (run, tile, member, part), rows in groupby(lines, lambda line: (line.run, line.tile, line.member, line.part)):
        head, n = next(rows), 0
        if head.names is None:
            raise ValueError(f"{run} {member} has lines without a header")

        def counted(rows: Iterator[Line] = rows) -> Iterator[Line]:
            nonlocal n
            for row in rows:
                n += 1
                yield row

        texts = _texts(head, counted(), "", sep)
        first = next(texts)
        texts = texts if part else chain([first], texts)
        size, crc, data = _deflated(texts)
        yield Block(run, tile, member, part, head.size, 0 if part else len(first), n, len(head.names), size, crc, data)


def _joined(out, blocks: Iterator[Block], parts: list[dict] | None = None) -> tuple[int, int, int]:
    """All members of a run by their blocks; their number, lines and most columns.  ``parts`` takes where each block lies."""
    members = n = most = 0
    stream = _Gzip(out)
    for member, given in groupby(blocks, lambda block: block.member):
        first, size, lines = next(given), 0, 0
        info = tarfile.TarInfo(f"{member}.csv")
        info.size = first.head + first.said
        stream.add(*_deflated([info.tobuf()]))
        head_at = stream.at
        for block in chain([first], given):
            if parts is not None:
                parts.append({"member": info.name, "member_pos": members, "first": lines, "head_at": head_at, "head": first.head, "at": stream.at, "size": block.size - block.head})
            stream.add(block.size, block.crc, block.data)
            size, lines = size + block.size, lines + block.n
        if size > info.size:
            raise ValueError(f"{first.run} {member} is longer than the {first.said} bytes it was said to have")
        if size < info.size:
            raise OSError(f"{first.run} {member}: unexpected end of data, {first.said} bytes were said")
        stream.add(*_deflated([bytes(-size % tarfile.BLOCKSIZE)]))
        members, n, most = members + 1, n + lines, max(most, first.columns)
    stream.add(*_deflated([bytes(2 * tarfile.BLOCKSIZE)]))
    stream.end()
    return members, n, most


def _archive(out, lines: Iterator[Line], sep: str) -> tuple[int, int, int]:
    """All members of a run by their lines."""
    return _joined(out, _blocks(lines, sep))


def _wide(out, lines: Iterator[Line], label: str, sep: str) -> tuple[int, int, int]:
    head, n = next(lines), -1
    with gzip.GzipFile(fileobj=out, mode="wb", filename="", mtime=0) as zipped:
        for text in _texts(head, lines, label, sep):
            zipped.write(text)
            n += 1
    return 1, n, len(head.names)


BLOCK = "tile int, member string, part int, said long, head long, n long, columns int, size long, crc long, data binary"
# where a part of a member lies in its archive: its first row, the first bytes of its header and of itself, the bytes both inflate to
PARTS = "array<struct<member string, member_pos int, first long, head_at long, head long, at long, size long>>"
MANIFEST = f"path string, tile int, members int, n_lines long, n_columns int, written_at long, parts {PARTS}"


def _written(lines: DataFrame, folder: str, by: Sequence[str], label: str, sep: str, packed: bool) -> DataFrame:
    """Write the files of sorted lines; the manifest of this write."""
    run = T.StructType([T.StructField(c, T.StringType()) for c in by] or [T.StructField("_", T.StringType())])
    schema = T.StructType([T.StructField("run", run), *T._parse_datatype_string(MANIFEST).fields])
    blocks = T.StructType([schema["run"], *T._parse_datatype_string(BLOCK).fields])
    folder, written_at, ending = folder.rstrip("/"), time.time_ns() // 1000, "tar.gz" if packed else "csv.gz"

    def deflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(_read(batches), sep):
            yield pa.RecordBatch.from_pylist([block._asdict() | {"run": dict(block.run)}], _arrow(blocks))

    def deflated(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
        for batch in batches:
            for row in batch.to_pylist():
                yield Block(**row | {"run": tuple(row["run"].items())})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        given = deflated(batches) if packed else _read(batches)
        for (key, tile), rows in groupby(given, lambda row: (row.run, row.tile)):
            place = [f"{c}={quote(str(v), safe='')}" for c, v in key if by]
            path = "/".join([folder, *place, f"{'series' if packed else f'part-{tile}'}-{attempt}.{ending}"])
            parts = [] if packed else None
            with files.open_output(path) as out:
                counts = _joined(out, rows, parts) if packed else _wide(out, rows, label, sep)
            row = {
                "run": dict(key), "path": path, "tile": tile, "members": counts[0], "n_lines": counts[1], "n_columns": counts[2],
                "written_at": written_at, "parts": parts,
            }
            yield pa.RecordBatch.from_pylist([row], _arrow(schema))

    if packed:  # only deflated text goes to the task of a file
        lines = lines.mapInArrow(deflate, blocks).repartition("run", "tile").sortWithinPartitions("run", "tile", "member", "part")
    lines.mapInArrow(write, schema).write.mode("append").parquet(f"{folder}/_manifest")
    return committed(lines.sparkSession, folder).where(F.col("written_at") == written_at)


def _arrow(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def write_archives(
    rows: DataFrame, folder: str, by: Sequence[str], member: str = "carrier", hour: str = "hour", node: str = "site", value: str = "mw", sep: str = ";"
) -> DataFrame:
    """One ``tar.gz`` per run below ``folder`` with a wide CSV member for each value of ``member``; the manifest of this write.

    A member has the hours as row labels and its own nodes as columns, both sorted; a cell without a row is empty.  Hours
    and nodes that are null are left out; a node that has two rows in one hour is an error.
    """
    name = F.col(member).cast("string")
    return _written(_lines(rows, by, name, hour, node, value, sep, None), folder, by, "", sep, True)


def write_wide_files(
    rows: DataFrame, folder: str, by: Sequence[str], hour: str = "hour", node: str = "node", value: str = "mw", sep: str = ";", tile: int | None = None
) -> DataFrame:
    """One wide gzip CSV per run, or per TILE columns of it, with the hours in the column ``hour`` and the run's own nodes."""
    return _written(_lines(rows, by, F.lit(""), hour, node, value, sep, tile or TILE), folder, by, hour, sep, False)


def committed(spark: SparkSession, folder: str) -> DataFrame:
    """The files of the last finished write of each run: ``run``, ``path``, ``tile``, ``members``, ``n_lines``, ``n_columns``, ``written_at``, ``parts``."""
    found = spark.read.option("mergeSchema", True).parquet(f"{folder.rstrip('/')}/_manifest")  # older writes have no parts
    last = found.groupBy(F.col("run").alias("last_run")).agg(F.max("written_at").alias("last_at"))
    return found.join(last, (found["run"] == last["last_run"]) & (found["written_at"] == last["last_at"]), "left_semi")
