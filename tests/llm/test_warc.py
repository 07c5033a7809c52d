import gzip
import hashlib
import io
import zlib

import pytest
from helpers import differs, rows

from hourgrid.llm import warc


def archive(*payloads):
    return b"".join(warc.record(str(n), f"http://e.org/{n}", p, None) for n, p in enumerate(payloads))


def test_one_member_for_each_record():
    raw = archive(b"", b"x" * 100, "é\r\n\r\nWARC/1.1\r\n".encode() * 9)
    assert raw.count(b"\x1f\x8b\x08") >= 3
    got = list(warc.records(io.BytesIO(raw)))
    assert [r.payload for r in got] == [b"", b"x" * 100, "é\r\n\r\nWARC/1.1\r\n".encode() * 9]
    assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert warc.bare(got[1].headers["warc-payload-digest"]) == hashlib.sha1(b"x" * 100).hexdigest()


@pytest.mark.parametrize("chunk", [1, 7, 100, 1 << 20])
def test_chunks_may_end_anywhere(monkeypatch, chunk):
    monkeypatch.setattr(warc, "CHUNK", chunk)
    payloads = [bytes([n]) * n * 37 for n in range(20)]
    assert [r.payload for r in warc.records(io.BytesIO(archive(*payloads)))] == payloads


def test_damage_is_seen():
    raw = archive(b"payload" * 50)
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(io.BytesIO(raw[:-9])))
    plain = zlib.decompress(raw, 31)
    pack = lambda data: io.BytesIO(gzip.compress(data))
    for broken, message in ((plain.replace(b"payloadpay", b"paXloadpay", 1), "block digest"), (plain[:-4], "framed"), (plain.replace(b"WARC/1.1", b"HTTP/1.1", 1), "not a WARC")):
        with pytest.raises(ValueError, match=message):
            list(warc.records(pack(broken)))
    with pytest.raises(zlib.error):
        list(warc.records(io.BytesIO(b"no gzip at all")))


def test_headers_cannot_be_forged():
    (got,) = warc.records(io.BytesIO(warc.record("1", "http://e.org/a b\r\nWARC-Type: revisit", b"p", None)))
    assert got.headers["warc-type"] == "response" and got.headers["warc-target-uri"] == "http://e.org/a%20b%0D%0AWARC-Type:%20revisit"


def test_edge_rows(spark, tmp_path):
    big, other = "é" * 600, "b" * 1000
    data = [(1, "u", big), (5, None, big), (5, "u", big), (3, "u", big), (None, "u", big), (7, "u", other), (8, "u", "b" * 999), (9, "u", "b" * 999), (10, "u", None), (11, "u", ""), (12, "u", "c" * 500_000)]
    pages = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in data], "page_id long, url string, html string, key string, id int")
    manifest = warc.write_archives(pages, str(tmp_path / "w"), file_bytes=2000)
    got = rows(warc.read_archives(manifest, str(tmp_path / "w")), "id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = []
    for i, _, h in data:
        raw = (h or "").encode()
        again = h == big and i != 5
        want.append((None if i is None else str(i), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", "5" if again else None))
    assert got == sorted(want, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))
    files = list((tmp_path / "w").glob("*.warc.gz"))
    assert sum(len(list(warc.records(f.open("rb")))) for f in files) == len(data)  # gzipped once, by the records alone
    (tmp_path / "w" / "part-00000-99-0000.warc.gz").write_bytes(b"left by a lost task")
    assert warc.read_archives(manifest, str(tmp_path / "w")).count() == len(data)


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, f"file://{tmp_path}/w")
    assert manifest.count() == 0 and warc.read_archives(manifest, f"file://{tmp_path}/w").count() == 0


def test_query(spark, sf_dir):
    assert differs(spark, sf_dir, "op9_warc") is None


def test_identifiers_cannot_forge_headers(spark, tmp_path):
    keys = ["a\r\nWARC-Type: x", "<urn:page:1>", "1%0D", " é ", "7", "a b>", "\x00\x85"]
    big = "b" * 1000
    pages = spark.createDataFrame([(k, "u", h) for k in keys for h in (k, big)], "page_id string, url string, html string")
    got = warc.read_archives(warc.write_archives(pages, str(tmp_path / "w")), str(tmp_path / "w")).collect()
    assert sorted(r.id for r in got) == sorted(2 * keys)
    assert sorted(r.id for r in got if r.record_type == "revisit") == sorted(set(keys) - {max(keys)})
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {max(keys)}
