"""Archives as streams: constant memory, filters that reach the reader, small members in shared batches."""

import gzip
import io
import re
import subprocess
import sys
import tarfile
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, Not, StringStartsWith

from hourgrid.sources import archives, datasource, packed
from test_sources import pack

LIMITED = """
import resource, sys
sys.path.insert(0, {root!r})
from hourgrid import files
from hourgrid.sources import packed
def peak():
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024
start, n, last = peak(), 0, None
with files.open_input({path!r}) as source:
    for batch in packed.records("p", source, ["x"], lambda name: True, ",", True, False):
        n, last = n + batch.num_rows, batch.column("x")[-1].as_py()
print(n, last, peak() - start)
"""


def big_archive(path: Path, members: int, rows_: int) -> int:
    """An archive of long members and many small ones, written as a stream; its size unpacked."""
    size = 0
    with tarfile.open(str(path), "w|gz", compresslevel=1) as out:
        for k in range(members):
            line = (",x\n" + "".join(f"{n},{k}-{n}-{'y' * 60}\n" for n in range(rows_))).encode()
            info = tarfile.TarInfo(f"m{k}.csv")
            info.size = len(line)
            out.addfile(info, io.BytesIO(line))
            size += len(line)
    return size


def test_an_archive_larger_than_the_memory_is_read(tmp_path):
    """160 MB unpacked, of them 40 MB in one member, are read in a process that may grow by 64 MB."""
    path = tmp_path / "big.tar.gz"
    assert big_archive(path, 4, 550_000) > 160 << 20
    code = LIMITED.format(root=str(Path(__file__).parents[1]), path=str(path))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    n, last, grown = out.stdout.split() if out.stdout else pytest.fail(out.stderr)
    assert (int(n), last) == (4 * 550_000, f"3-549999-{'y' * 60}")
    assert int(grown) < 64 << 20


def test_a_stream_that_is_packed_well_is_not_kept_whole():
    """8 MB of one letter fit in a buffer of packed bytes; what is held of them is bounded."""
    text = b"x" * (8 << 20) + b"end"
    stream = packed._Inflated(io.BytesIO(gzip.compress(text)))
    got, most = 0, 0
    while got < len(text) - 3:
        data = stream.read(min(1 << 16, len(text) - 3 - got))
        assert data == b"x" * len(data)
        got, most = got + len(data), max(most, len(stream.piece))
    assert most <= packed.PIECE and stream.tell() == got and stream.read(9) == b"end" and stream.read(1) == b""
    skipping = packed._Inflated(io.BytesIO(gzip.compress(text)))
    assert skipping.seek(8 << 20) == 8 << 20 and skipping.read(9) == b"end" and skipping.seek(9 << 20) == len(text)
    with pytest.raises(tarfile.StreamError):
        skipping.seek(0)
    with pytest.raises(tarfile.ReadError, match="invalid compressed data"):
        packed._Inflated(io.BytesIO(gzip.compress(text)[:40] + b"no" * 99)).read(len(text))


@pytest.mark.parametrize("form", [tarfile.USTAR_FORMAT, tarfile.GNU_FORMAT, tarfile.PAX_FORMAT])
@pytest.mark.parametrize("mode", ["w:gz", "w:bz2", "w"])
def test_names_and_bodies_of_members(form, mode):
    given = [("a.csv", b""), ("ö/ b.csv", b"x\n"), ("f/" + "n" * 80 + "/" + "m" * 60, b"y" * 700), ("c" * 100, b"z" * packed.PIECE), ("d", b"w" * (packed.PIECE + 1))]
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode, format=form) as archive:
        for name, data in given:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
            folder = tarfile.TarInfo("folder")
            folder.type = tarfile.DIRTYPE
            archive.addfile(folder)
    assert [(k, name, body.read()) for k, name, body in packed.members(io.BytesIO(out.getvalue()))] == [(k, *g) for k, g in enumerate(given)]
    assert [name for _, name, _ in packed.members(io.BytesIO(out.getvalue()))] == [name for name, _ in given]  # bodies nobody reads


def test_the_line_of_an_error_behind_many_rows():
    text = "a,b\n" + '1,"x\r\ny"\n' * 3000 + "\n1,2,3\n"
    with pytest.raises(ValueError, match="line 6003 has 3 fields, the header 2"):
        list(packed.lines(io.BytesIO(text.encode()), ",", False))
    assert len(list(packed.lines(io.BytesIO(text.encode()), ",", True))) == 3001


def test_headers_of_many_members_are_not_kept(tmp_path):
    path = tmp_path / "many.tar.gz"
    big_archive(path, 500, 2)
    with open(path, "rb") as source:
        batches = list(packed.records("p", source, ["x"], lambda name: True, ",", True, False))
    assert [b.num_rows for b in batches] == [1000]  # small members share a batch


@pytest.mark.parametrize(("text", "want"), [
    (b"", []), (b"\n\n", []), (b"a,b\n", [["a", "b"]]), (b"\xef\xbb\xbfa,b\r\n1,2\r\n", [["a", "b"], ["1", "2"]]), (b"a,b\n1\n\n2,3", [["a", "b"], ["1", ""], ["2", "3"]]),
    (b'a,b\n"x,""y""\nz",2\n', [["a", "b"], ['x,"y"\nz', "2"]]), (b"a,a,a\n1,2,3\n", [["a", "a.1", "a.2"], ["1", "2", "3"]]), (b"a,b\n1,2,3\n4,5\n", [["a", "b"], ["4", "5"]]),
    (b"a\n" + b"y" * 200_000, [["a"], ["y" * 200_000]]),
])
def test_lines(text, want):
    assert list(packed.lines(io.BytesIO(text), ",", True)) == want


def test_a_row_with_too_many_fields_is_an_error():
    with pytest.raises(ValueError, match="line 2 has 3 fields"):
        list(packed.lines(io.BytesIO(b"a,b\n1,2,3\n"), ",", False))


def test_whole_archives_through_spark_give_the_same(spark, tmp_path):
    path = pack(tmp_path / "a.tar.gz", {"m.csv": ",x\n0,1\n1,NA\n", "n.csv": ",y\n0,2\n"})
    for read in (lambda **o: archives.read_records(spark, path, ["x"], **o), lambda **o: archives.text_cells(spark, path, **o)):
        assert rows(read()) == rows(read(loaded=True)) != []


@pytest.fixture
def runs(tmp_path):
    for run in ("r1", "r2"):
        for year in ("2030", "2040"):
            pack(tmp_path / run / year / "flow.tar.gz", {
                "other.csv": ",x,z\n0,no,n\n", "faal_1.csv": f",x,z\n0,{run},{year}\n1,b,c\n", "faal_2.csv": ",x,z\n0,second,n\n"})
    return f"{tmp_path}/*/*/flow.tar.gz"


KEYS = {"run": r"/(r\d)/", "year": r"/(\d{4})/"}


def test_filters_reach_the_source(spark, runs, capsys):
    found = datasource.scan(spark, runs, ["x"], KEYS, where=F.col("member").startswith("faal") & (F.col("run") == "r2"))
    capsys.readouterr()
    found.explain("formatted")
    plan = capsys.readouterr().out
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan)[1]
    assert "StringStartsWith(member,faal)" in pushed and "EqualTo(run,r2)" in pushed
    assert found.rdd.getNumPartitions() == 1
    got = rows(found, "run", "year", "member", "row_idx", "x")
    assert got == [("r2", y, m, n, x) for y in ("2030", "2040") for m, n, x in (("faal_1.csv", 0, "r2"), ("faal_1.csv", 1, "b"), ("faal_2.csv", 0, "second"))]


def test_other_filters_stay_with_spark(spark, runs):
    scan = lambda where: datasource.scan(spark, runs, ["x"], KEYS, where=where)
    assert rows(scan("row_idx = 1 AND x = 'b' AND year IN ('2040', '2050') AND NOT run = 'r1'"), "run", "year", "x") == [("r2", "2040", "b")]
    assert scan("member LIKE '%2.csv' AND contains(path, '/r1/')").count() == 2
    assert scan("member = 'other.csv' OR x = 'second'").count() == 8
    assert scan("run = 'r9'").count() == 0


def test_a_frame_is_filtered_in_different_ways(spark, runs):
    found = datasource.scan(spark, runs, ["x"], KEYS, where="member = 'faal_1.csv'")
    assert [found.where(f"run = '{r}'").count() for r in ("r9", "r1", "r2")] == [0, 4, 4] and found.count() == 8


def test_bodies_of_other_members_are_not_parsed(runs, monkeypatch):
    parsed, opened = [], []
    lines, open_input = packed.lines, datasource.files.open_input
    monkeypatch.setattr(packed, "lines", lambda body, *rest: (parsed.append(1), lines(body, *rest))[1])
    monkeypatch.setattr(datasource.files, "open_input", lambda path: (opened.append(path), open_input(path))[1])
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("member", "run", "x")])
    options = {"path": runs, "keys": '{"run": "/(r\\\\d)/"}', "label": "true"}

    def read(filters, **more):
        reader = datasource.ArchiveReader(schema, {**options, **more})
        left = list(reader.pushFilters(filters))
        found = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        done = len(parsed), len(opened)
        parsed.clear()
        opened.clear()
        return len(left), len(found), *done

    assert read([]) == (0, 16, 12, 4)
    assert read([StringStartsWith(("member",), "faal"), GreaterThan(("x",), "a")]) == (1, 12, 8, 4)
    assert read([EqualTo(("run",), "r1"), In(("member",), ("other.csv",))]) == (0, 2, 2, 2)
    assert read([StringStartsWith(("member",), "faal")], first_member="true") == (0, 8, 4, 4)
    assert read([Not(StringStartsWith(("member",), "faal"))]) == (0, 4, 4, 4)


def test_listing(tmp_path):
    pack(tmp_path / "a b" / "x.tar.gz", {"m.csv": ",x\n"})
    assert [p for p, _ in datasource.listed(f"{tmp_path}/*/x.tar.gz")] == [f"{tmp_path}/a b/x.tar.gz"]
    assert [p for p, _ in datasource.listed(f"file://{tmp_path}/a b/x.tar.gz")] == [f"file://{tmp_path}/a b/x.tar.gz"]
    assert [p for p, _ in datasource.listed(f"file://{tmp_path}/a b")] == [f"file://{tmp_path}/a b/x.tar.gz"]
    assert datasource.listed(f"{tmp_path}/none/*.gz") == []
