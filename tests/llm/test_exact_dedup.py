import hashlib
import re

import pytest
from helpers import differs, rows

from hourgrid.llm import exact_dedup

SCHEMA = "doc_id long, text string, id string, row int, norm string, hash long, piece int"
TEXTS = [None, "", " ", "  \n", "a b", "a  b", "a\tb", "a\x0b\x0c\rb", "a b ", "a\xa0b", "é" * 40, "é" * 40 + " ", "x" * 100_000, "x" * 100_000, "x" * 99_999 + "y"]


def frame(spark, extra=()):
    data = [(i, t, "s", 1, "n", 2, 3) for i, t in enumerate(TEXTS)] + [(None, "a b", None, None, None, None, None), (4, "a b", "again", 1, "n", 2, 3)]
    return spark.createDataFrame([*data, *extra], SCHEMA)


def brute(data):
    """(id, keep, size, kept, digest) of rows (id, text)."""
    groups = {}
    for i, t in data:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is None, i or 0))
        keep = order[0]
        for n, i in enumerate(order):
            out.append((i, keep, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot_rows", [512, 1])
def test_against_brute_force(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", hot_rows)
    extra = [(100 + i, "hot  text", "s", 1, "n", 2, 3) for i in range(300)]
    docs = frame(spark, extra)
    found = exact_dedup.content_groups(docs)
    got = sorted((tuple(r) for r in found.select("id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_rows_that_stay_are_unchanged(spark):
    docs = frame(spark)
    stay = exact_dedup.deduplicate(docs)
    assert stay.schema.fieldNames() == docs.schema.fieldNames() and [f.dataType for f in stay.schema] == [f.dataType for f in docs.schema]
    kept = [(i, t) for i, t, *_ in map(tuple, docs.collect())]
    want = {(i, t) for i, keep, _, first, _ in brute(kept) if first for j, t in kept if j == i}
    assert {(r.doc_id, r.text) for r in stay.collect()} <= want and stay.count() == len({b[4] for b in brute(kept)})


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert rows(exact_dedup.content_groups(docs)) == [] and exact_dedup.deduplicate(docs).columns == docs.columns


def test_only_built_in_functions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = exact_dedup.deduplicate(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|SinglePartition|Cartesian|NestedLoop", plan)


def test_query(spark, sf_dir):
    assert differs(spark, sf_dir, "op7_exact_dedup") is None
