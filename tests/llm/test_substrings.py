import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import rows

from hourgrid.llm import queries, substrings
from hourgrid.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(docs, size=20):
    """Kept words of (id, text) pairs, by looking at every window; documents in the order of their identifiers, null last."""
    seen, out = set(), {}
    for at in sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0])):
        words = WORD.findall(docs[at][1] or "")
        gone = set()
        for k in range(len(words) - size + 1):
            window = tuple(words[k : k + size])
            if window in seen:
                gone.update(range(k, k + size))
            seen.add(window)
        out[docs[at][0]] = (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    return sorted(((i, *v) for i, v in out.items()), key=lambda r: (r[0] is None, r[0]))


def removed(spark, docs, size=20, seed=4, kind="long"):
    frame = spark.createDataFrame(docs, f"doc_id {kind}, text string").repartition(5)
    found = substrings.deduplicated(frame, size=size, seed=seed)
    return sorted((tuple(r) for r in found.select("row.doc_id", "n_words", "n_removed", "kept_text").collect()), key=lambda r: (r[0] is None, r[0]))


def passages(n, seed, vocabulary=40):
    """Texts that share passages, halves of them, single words over and over, and odd white space."""
    draw = random.Random(seed)
    shared = [[f"w{draw.randrange(vocabulary)}é" for _ in range(draw.randrange(15, 90))] for _ in range(8)]
    docs = []
    for k in range(n):
        words = []
        for _ in range(draw.randrange(0, 5)):
            kind = draw.randrange(4)
            if kind == 0:
                words += draw.choice(shared)
            elif kind == 1:
                some = draw.choice(shared)
                at = draw.randrange(len(some))
                words += some[at : at + draw.randrange(10, 40)]
            elif kind == 2:
                words += [f"n{draw.randrange(1000)}" for _ in range(draw.randrange(30))]
            else:
                words += ["ha"] * draw.randrange(60)
        docs.append((k * 7 % 1000, draw.choice([" ", "\n", " \t\r ", "\x0b"]).join(words)))
    return docs


@pytest.mark.parametrize("size, seed", [(20, 4), (20, 1), (7, 3), (5, 5)])
def test_against_every_window(spark, size, seed):
    docs = passages(120, size + seed)
    assert removed(spark, docs, size, seed) == expected(docs, size)


@pytest.mark.parametrize("buckets", [1 << 20, 64])
def test_hot_anchors_are_cut_into_windows(spark, monkeypatch, buckets):
    docs = passages(150, 3)
    monkeypatch.setattr(substrings, "HOT", 3)
    monkeypatch.setattr(substrings, "MEANS", 1)
    monkeypatch.setattr(substrings, "BUCKETS", buckets)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    hot = substrings.hot_buckets(frame, "text")
    assert hot.any() and not hot.all()
    assert removed(spark, docs) == expected(docs)


def test_rows_of_an_index_go_on_over_batches(spark, monkeypatch):
    docs = passages(80, 4)
    monkeypatch.setattr(substrings, "CHUNK", 16)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert removed(spark, docs) == expected(docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def windows(texts):
    """(text, first word): (hash, anchor) of all windows."""
    out = {}
    for anchor, text, start, count, hashes in substrings._stretches(pa.array(texts), 20, 4):
        at = 0
        for a, t, s, n in zip(anchor, text, start, count):
            out.update({(t, s + k): (hashes[at + k], a) for k in range(n)})
            at += n
        assert at == len(hashes)
    return out


def test_parts_looked_at_together_change_nothing(monkeypatch):
    texts = [t for _, t in passages(40, 8)]
    want = windows(texts)
    assert set(want) == {(k, s) for k, t in enumerate(texts) for s in range(len(WORD.findall(t)) - 19)}
    for name, value in (("CHUNK", 16), ("LONGEST", 3), ("BYTES", 64)):
        monkeypatch.setattr(substrings, name, value)
    assert windows(texts) == want


def test_nulls_empty_long_ties_and_clashing_columns(spark):
    long = " ".join(f"x{k % 5000}" for k in range(30_000))  # repeats itself
    docs = [(None, long), (3, None), (4, ""), (5, " \n "), (6, long), (7, "a " * 19), (8, "b " * 21), (9, "z" * 200_000 + " " + "c " * 20), (10, "z" * 200_000 + " " + "c " * 20)]
    assert removed(spark, docs) == expected(docs)
    assert removed(spark, []) == []
    frame = spark.createDataFrame([("p", "q " * 30, 1, 2, 3)], "doc_id string, text string, id int, digest int, `a.row` int")
    got = substrings.deduplicated(frame).first()
    assert got["row"].asDict() == {"doc_id": "p", "text": "q " * 30, "id": 1, "digest": 2, "a.row": 3}
    numbers = spark.createDataFrame([(1, 12), (2, None)], "doc_id int, text int")
    assert rows(substrings.deduplicated(numbers), "row.doc_id", "row.text", "n_words", "kept_text") == [(1, 12, 1, "12"), (2, None, 0, "")]
    nulls = spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string")
    assert rows(substrings.deduplicated(nulls), "row.doc_id", "row.text", "kept_text") == [(1, None, ""), (2, "", "")]
    assert (got["n_words"], got["n_removed"], got["kept_text"], [tuple(s) for s in got["spans"]]) == (30, 29, "q", [(1, 30)])


def test_rows_sharing_identifier(spark):
    """Equal rows are one document; different texts of one identifier stand in a fixed order, one of them keeps the passage."""
    passage = " ".join(f"p{k}" for k in range(25))
    docs = [(1, passage + " one"), (1, passage + " one"), (1, passage + " two"), (2, passage), (None, passage), (None, passage)]
    got = removed(spark, docs)
    ones = sorted(r[1:] for r in got if r[0] == 1)
    assert [r[1] for r in ones] in ([0, 0, 25], [0, 25, 25])
    assert all(r[1:] == (25, 25, "") for r in got if r[0] != 1)


def test_word_places_and_hashes():
    texts = pa.array(["", "ab", "ab c", " ab", "c d ab ", "x" * 100_000])
    data, bounds = substrings._bytes(texts.slice(1))
    starts, ends = substrings.word_places(data, bounds)
    words = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert words == [w for t in texts.to_pylist() for w in WORD.findall(t)]
    hashes = substrings.word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(words))
    assert all((hashes[i] == hashes[j]) == (a == b) for i, a in enumerate(words) for j, b in enumerate(words))


def test_whole_table_against_every_window(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert sum(r[2] for r in expected(docs)) > 1000
    import hashlib

    want = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in expected(docs)]
    got = queries.QUERIES["op11_substrings"](spark, sf_dir)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == want
