"""Members of packed archives and their CSV rows, as streams.

An archive is inflated as it is read: what a worker holds is a buffer, the header of one member and the rows of one batch,
whatever the size of the archive or of a member.  The body of a member that nobody reads is inflated but not parsed.
"""

from __future__ import annotations

import csv
import io
import re
import sys
import tarfile
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import closing
from itertools import chain, compress, islice
from operator import itemgetter
from typing import BinaryIO, NamedTuple

import numpy as np
import pyarrow as pa

from hourgrid import files

# rows, and cells, of a batch
ROWS = 4096
CELLS = 1 << 16
# bytes that are inflated, or read of a member, at a time
PIECE = 1 << 18

# Fields that stand for a missing reading.
MISSING = frozenset(
    ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
)

Wanted = Callable[[str], bool]


class _Body(io.RawIOBase):
    """A member's body as a plain stream: that of a streamed archive cannot tell whether it seeks."""

    def __init__(self, source: BinaryIO):
        self.source = source

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.source.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


class _Entry(tarfile.TarInfo):
    """The header of a member; that of a plain file is read without the fields that nobody asks for."""

    @classmethod
    def frombuf(cls, buf: bytes, encoding: str, errors: str) -> tarfile.TarInfo:
        size, check = buf[124:135], buf[148:154]
        plain = buf[156:157] == b"0" and buf[345:346] == b"\0" and len(buf) == tarfile.BLOCKSIZE
        if not plain or buf[100:156].translate(None, b"01234567\0 ") or not size.isdigit() or not check.isdigit():
            return super().frombuf(buf, encoding, errors)
        if int(check, 8) != sum(buf) - sum(buf[148:156]) + 8 * 32:
            return super().frombuf(buf, encoding, errors)
        entry = cls(buf[:100].partition(b"\0")[0].decode(encoding, errors))
        entry.size, entry.chksum, entry.type = int(size, 8), int(check, 8), tarfile.REGTYPE
        return entry


class _Inflated:
    """What a gzip stream holds, read forward only; a piece of bounded size is kept, however well it was packed."""

    def __init__(self, source: BinaryIO, given: bytes = b"", wbits: int = zlib.MAX_WBITS | 16):
        self.source, self.given, self.inflate = source, given, zlib.decompressobj(wbits)
        self.piece, self.at, self.before = b"", 0, 0  # what is inflated, read of it, and the bytes of all pieces before

    def _more(self) -> bool:
        """The next piece; whether there is one."""
        self.before, self.piece, self.at = self.before + len(self.piece), b"", 0
        while not self.piece and not self.inflate.eof:
            packed = self.inflate.unconsumed_tail or self.given or self.source.read(PIECE)
            self.given = b""
            try:
                self.piece = self.inflate.decompress(packed, PIECE)
            except zlib.error as error:
                raise tarfile.ReadError("invalid compressed data") from error
            if not packed and not self.piece:
                break
        return bool(self.piece)

    def read(self, size: int) -> bytes:
        """So many bytes, fewer at the end only."""
        data = self.piece[self.at : self.at + size]
        self.at += len(data)
        if len(data) == size:
            return data
        parts = [data]
        left = size - len(data)
        while left and self._more():
            parts.append(self.piece[:left])
            self.at = len(parts[-1])
            left -= self.at
        return b"".join(parts)

    def tell(self) -> int:
        return self.before + self.at

    def seek(self, place: int) -> int:
        if place < self.tell():
            raise tarfile.StreamError("seeking backwards is not allowed")
        while place > self.before + len(self.piece) and self._more():
            pass
        self.at = min(place - self.before, len(self.piece))
        return self.tell()


class _Replayed:
    """A stream whose first bytes were read already."""

    def __init__(self, source: BinaryIO, given: bytes):
        self.source, self.given = source, given

    def read(self, size: int) -> bytes:
        data, self.given = self.given[:size], self.given[size:]
        return data + self.source.read(size - len(data)) if len(data) < size else data


def _opened(source: BinaryIO) -> tarfile.TarFile:
    """An archive to read forward; one in gzip without the copies that ``tarfile`` makes of all it has inflated."""
    given = source.read(3)
    if given == b"\x1f\x8b\x08":
        return tarfile.TarFile(fileobj=_Inflated(source, given), tarinfo=_Entry)
    return tarfile.open(fileobj=_Replayed(source, given), mode="r|*")


def members(source: BinaryIO) -> Iterator[tuple[int, str, BinaryIO]]:
    """Place among the regular files, name and body of each, in order; a body is gone when the next member is asked for."""
    with _opened(source) as archive:
        place = 0
        while (entry := archive.next()) is not None:
            archive.members.clear()  # else the headers of all members before are kept
            if entry.isfile():
                body = archive.extractfile(entry)
                yield place, entry.name, io.BytesIO(body.read()) if entry.size <= PIECE else io.BufferedReader(_Body(body), 1 << 16)
                place += 1


def lines(body: BinaryIO, sep: str, skip_bad: bool) -> Iterator[list[str]]:
    """Header and rows of a CSV file; empty lines are left out, short rows filled up.

    A row with too many fields is an error, or left out with ``skip_bad``.  Names that a header repeats are numbered.
    """
    return chain.from_iterable(_some_lines(body, sep, skip_bad))


def _some_lines(body: BinaryIO, sep: str, skip_bad: bool) -> Iterator[list[list[str]]]:
    """The header, then rows some at a time: first few, then as many as make a piece."""
    csv.field_size_limit(sys.maxsize)
    rows = csv.reader(io.TextIOWrapper(body, encoding="utf-8-sig", newline=""), delimiter=sep)
    header = next((row for row in rows if not _empty(row)), None)
    if header is None:
        return
    seen: dict[str, int] = {}
    for k, name in enumerate(header):
        seen[name] = seen.get(name, -1) + 1
        header[k] = f"{name}.{seen[name]}" if seen[name] else name
    yield [header]
    width, line, n = len(header), rows.line_num, max(1, CELLS // len(header))
    while some := list(islice(rows, n)):
        if width > 1 and set(map(len, some)) == {width}:
            yield some
        else:
            yield _even(some, width, skip_bad, line)
        line = rows.line_num


def _empty(row: list[str]) -> bool:
    return not row or len(row) == 1 and not row[0].strip()


def _even(rows: list[list[str]], width: int, skip_bad: bool, line: int) -> list[list[str]]:
    """The rows that a file of so many columns holds; they come behind so many lines of it."""
    out = []
    for row in rows:
        line += 1 + sum(len(re.findall("\r\n|\r|\n", field)) for field in row)
        if _empty(row):
            continue
        if len(row) > width:
            if skip_bad:
                continue
            raise ValueError(f"line {line} has {len(row)} fields, the header {width}")
        out.append(row + [""] * (width - len(row)) if len(row) < width else row)
    return out


def _filled(fields: Sequence[str]) -> list[str | None]:
    return [None if f in MISSING else f for f in fields]


def records(
    path: str, source: BinaryIO, columns: Sequence[str], wanted: Wanted, sep: str, label: bool, skip_bad: bool, first_only: bool = False
) -> Iterator[pa.RecordBatch]:
    """Batches (path, member, member_pos, row_idx, *columns) of the wanted members; rows of small members share a batch."""
    names = ["path", "member", "member_pos", "row_idx", *columns]
    # for each run of rows of one member its name, place, first row and number of rows; then the fields by column
    held: list[tuple[str, int, int, int]] = []
    fields: list[list[str | None]] = [[] for _ in columns]
    size = 0

    def batch() -> pa.RecordBatch:
        of, places, first, n = zip(*held)
        count = np.array(n)
        inside = np.arange(size) - np.repeat(np.cumsum(count) - count, count)  # a row's place in its run
        out = [
            pa.repeat(pa.scalar(path, pa.string()), size), pa.array(of, pa.string()).take(pa.array(np.repeat(np.arange(len(count)), count))),
            pa.array(np.repeat(np.array(places, np.int32), count)), pa.array(np.repeat(np.array(first, np.int64), count) + inside),
            *[pa.array(_filled(f), pa.string()) for f in fields],
        ]
        return pa.RecordBatch.from_arrays(out, names=names)

    for place, member, body in members(source):
        if not wanted(member):
            continue
        rows = lines(body, sep, skip_bad)
        header = next(rows, None)
        if header is not None:
            found = {name: k for k, name in enumerate(header) if k or not label}
            at = [found.get(c) for c in columns]
            n = 0
            while some := list(islice(rows, ROWS - size)):
                for column, k in zip(fields, at):
                    column.extend([""] * len(some) if k is None else map(itemgetter(k), some))
                held.append((member, place, n, len(some)))
                n, size = n + len(some), size + len(some)
                if size >= ROWS:
                    yield batch()
                    held, fields, size = [], [[] for _ in columns], 0
        if first_only:
            break
    if size:
        yield batch()


class Cut(NamedTuple):
    """How the cells of members are cut out of their lines."""

    sep: str
    label: bool  # a leading row label is no cell
    skip_bad: bool
    drop: Sequence[str]
    keep_label: bool = False  # it stands beside the cells
    missing: bool = True  # cells without a reading are cells


def cells(path: str, source: BinaryIO, wanted: Wanted, cut: Cut) -> Iterator[pa.RecordBatch]:
    """Batches (path, member, member_pos, row_idx, column, value) of the wanted members, a row per field; see ``Cut``."""
    for place, member, body in members(source):
        if wanted(member):
            yield from _cells(path, place, member, 0, body, cut)


def part_cells(path: str, part: Mapping, cut: Cut) -> Iterator[pa.RecordBatch]:
    """The same of a part of a member, whose place in its archive the manifest tells (``sinks.packed``); nothing else is inflated."""
    with closing(_Part(path, part)) as source:
        yield from _cells(path, part["member_pos"], part["member"], part["first"], io.BufferedReader(_Body(source), 1 << 16), cut)


class _Part:
    """The header of a member and some of its lines behind it, deflated apart from all else."""

    def __init__(self, path: str, part: Mapping):
        # a first part lies behind its header in the same block
        if part["at"] == part["head_at"]:
            self.todo = [(part["at"], part["head"] + part["size"])]
        else:
            self.todo = [(part["head_at"], part["head"]), (part["at"], part["size"])]
        self.path, self.file, self.source, self.left = path, None, None, 0

    def read(self, size: int) -> bytes:
        while not self.left and self.todo:
            (place, self.left), *self.todo = self.todo
            self.close()
            self.file = files.open_at(self.path, place)
            self.source = _Inflated(self.file, wbits=-zlib.MAX_WBITS)
        data = self.source.read(min(size, self.left)) if self.left else b""
        if len(data) < min(size, self.left):
            raise tarfile.ReadError(f"{self.path}: unexpected end of data")
        self.left -= len(data)
        return data

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _cells(path: str, place: int, member: str, first: int, body: BinaryIO, cut: Cut) -> Iterator[pa.RecordBatch]:
    of = {"path": pa.scalar(path), "member": pa.scalar(member), "member_pos": pa.scalar(place, pa.int32())}
    found = names = None
    for n, header, labels, rows in _chunks(lines(body, cut.sep, cut.skip_bad), cut.label, cut.drop):
        if found is not header:
            found, names = header, pa.array(header, pa.string())
        yield _long(first + n, names, labels if cut.keep_label else None, rows, of, cut.missing)


def _chunks(rows: Iterator[list[str]], label: bool, drop: Sequence[str]) -> Iterator[tuple[int, list[str], list[str], list[list[str]]]]:
    """Rows some at a time, with the number of the first, the names of the fields that stay, and the first fields."""
    header = next(rows, None)
    at = [k for k, name in enumerate(header or ()) if (k or not label) and name not in drop]
    if not at:
        return
    names, labels, held, first = [header[k] for k in at], [], [], 0
    whole = len(at) == at[-1] + 1 - at[0]  # no field between them is dropped
    for row in rows:
        labels.append(row[0])
        held.append(row[at[0] : at[-1] + 1] if whole else [row[k] for k in at])
        if len(held) * len(at) >= CELLS:
            yield first, names, labels, held
            first, labels, held = first + len(held), [], []
    if held:
        yield first, names, labels, held


def _long(first: int, names: pa.Array, labels: list[str] | None, rows: list[list[str]], place: dict[str, pa.Scalar], missing: bool) -> pa.RecordBatch:
    width, values = len(names), list(chain.from_iterable(rows))
    if missing:
        at, values = np.arange(len(values)), _filled(values)
    else:
        # an empty field is nothing to Python, the others that stand for nothing are few
        at, values = list(compress(range(len(values)), values)), list(filter(None, values))
        held = [v not in MISSING for v in values]
        at, values = np.array(list(compress(at, held)), np.int64), list(compress(values, held))
    row = at // width
    columns = [pa.repeat(v, len(at)) for v in place.values()]
    columns.append(pa.array(first + row))
    columns.append(names.take(pa.array(at % width)))
    columns.append(pa.array(values, pa.string()))
    found = [*place, "row_idx", "column", "value"]
    if labels is not None:
        columns.append(pa.array(_filled(labels), pa.string()).take(pa.array(row)))
        found.append("label")
    return pa.RecordBatch.from_arrays(columns, names=found)
