import random
import re

import numpy as np
import pytest
import xxhash
from helpers import roots, rows

from hourgrid.llm import queries, simhash

SCHEMA = "doc_id long, text string, fp long, root long, id string"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(prints, bits=4):
    found = []
    for n, a in enumerate(prints):
        found += [(a, b) for b in prints[n + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits]
    return found


TEXTS = [None, "", " \n", "One", "one", "a b c", "A B c d", "a b c d e f g h", "É É é a", "x\x1cy z\x0bw", "\xa0  ", "word " * 70_000]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") == plain_fingerprint(text)


def test_the_hash_is_the_one_of_sql(spark):
    got = spark.createDataFrame([("é b c d",)], "t string").selectExpr("xxhash64(t)").first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("é b c d".encode(), 42)


@pytest.mark.parametrize("layout", [simhash.THREE, simhash.TWO])
def test_every_anchor_within_reach(layout):
    rng = np.random.default_rng(1)
    for _, width in layout.segments:
        values = rng.integers(0, 1 << width, 40)
        at, anchor, lives = layout.anchors(values, layout.steps(width))
        coded = (1 << layout.coded) - 1
        assert not layout.syndromes(anchor & coded).any()
        away = np.bitwise_count(anchor ^ values[at])
        assert (away <= layout.reach).all() and all(lives[at == n].sum() == 1 for n in range(40))
        assert (away[lives] <= 1).all()
        assert all(len(set(anchor[at == n].tolist())) == (at == n).sum() for n in range(40))
        # all words of at most ``reach`` flips that are anchors were found
        flips = [sum(1 << int(b) for b in rng.choice(width, layout.reach, replace=False)) for _ in range(3000)]
        near = np.array([int(values[0]) ^ f for f in flips])
        assert set(near[layout.syndromes(near & coded) == 0].tolist()) <= set(anchor[at == 0].tolist())


@pytest.mark.parametrize(("cell", "layout"), [(1024, simhash.THREE), (3, simhash.THREE), (1024, simhash.TWO)])
def test_links_against_brute_force(spark, monkeypatch, cell, layout):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1}
    for _ in range(30):
        base = rng.getrandbits(64)
        prints |= {base ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (0, 0, 1, 2, 3, 4, 4, 5, 6, 8)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed * 2], "fp long")
    got = roots([tuple(r) for r in simhash.links(df, layout=layout).collect()])
    assert got == roots(near(sorted(signed)))


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(500, k) for k in range(501, 560)]
    edges = [(a, b) for a, b in edges if a != b]
    got = dict(map(tuple, simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == roots(edges)


def test_groups_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(1004, "one"), (None, "one")]
    docs += [(2000 + i, docs[7][1] + " more" * i) for i in range(4)]
    frame = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in docs], SCHEMA)
    got = simhash.near_duplicates(frame)
    prints = {(i, t): plain_fingerprint(t) for i, t in docs}
    root = roots(near(sorted(set(prints.values()))))
    first = {}
    for (i, _), p in prints.items():
        if i is not None:
            first[root.get(p, p)] = min(first.get(root.get(p, p), i), i)
    want = sorted(((i, p, first.get(root.get(p, p))) for (i, _), p in prints.items() for _ in range(docs.count((i, _)))), key=str)
    assert sorted(((r.id, r.fp % (1 << 64), r.component_id) for r in got.collect()), key=str) == want
    stay = simhash.deduplicate(frame)
    assert stay.columns == frame.columns
    # one row of each group: the smallest identifier, null last; of texts that share it the smallest fingerprint as a signed number
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    keepers = {}
    for i, t in docs:
        p = prints[i, t]
        rank = (i is None, i or 0, signed(p))
        r = root.get(p, p)
        keepers[r] = min(keepers.get(r, (rank, i, t)), (rank, i, t), key=lambda k: k[0])
    assert sorted(((r.doc_id, r.text) for r in stay.collect()), key=str) == sorted(((i, t) for _, i, t in keepers.values()), key=str)


def test_one_row_of_a_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text), (None, "other"), (None, "other")], "doc_id long, text string")
    assert rows(simhash.deduplicate(docs)) == [(1, text), (None, "other")]


def test_texts_that_share_an_identifier(spark):
    """A text stays though another one under its identifier repeats a text with a smaller one."""
    one, other = (" ".join(f"{w}{k}" for k in range(60)) for w in ("a", "b"))
    docs = spark.createDataFrame([(1, one, "x"), (5, one, "y"), (5, other, "z"), (7, other, "u")], "id long, text string, fp string")
    assert rows(simhash.deduplicate(docs, id_col="id")) == [(1, one, "x"), (5, other, "z")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert rows(simhash.near_duplicates(docs)) == [] and simhash.deduplicate(docs).count() == 0


def test_query(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op2_simhash(spark, sf_dir).collect()}
    texts = dict(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()))
    assert got.keys() == texts.keys()
    assert all(r.fingerprint == f"{plain_fingerprint(texts[i]):016x}" for i, r in got.items())
