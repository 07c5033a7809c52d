import random
import time

import numpy as np
import pytest
from helpers import rows

from hourgrid.llm import decontaminate as d
from hourgrid.llm import queries

DOCS = "doc_id long, text string, id string, item_id string, similarity int"
ITEMS = "item_id long, text string, doc_id long"


def plain_best(text, item):
    """Best similarity of any window as long as the item."""
    words, wanted = d.words_of(text), d.words_of(item)
    if not words or not wanted:
        return 0.0
    size, n = min(5, len(wanted)), min(len(wanted), len(words))
    windows = (words[k : k + n] for k in range(len(words) - n + 1))
    return max(d.similarity(d.bag(w, size), d.bag(wanted, size)) for w in windows)


@pytest.mark.parametrize("text", ["", "One two, THREE_3 four-five", "İstanbul Straße ß ǅ", "áb   x", "१२ 中文。字", "word " * 50_000])
def test_hashes_follow_words(text):
    words, hashes = d.words_of(text), d.word_hashes(text)
    assert len(words) == len(hashes)
    assert len(set(words)) == len(set(hashes.tolist())) and len(set(zip(words, hashes.tolist()))) == len(set(words))


def test_tables_hold_all_within_radius():
    rng = np.random.default_rng(0)
    prints = rng.integers(0, 1 << 63, 50).astype(np.uint64)
    tables = d.Index._tables(prints)
    for _ in range(2000):
        item = rng.integers(50)
        flips = rng.choice(64, d.RADIUS, replace=False)
        other = np.array([prints[item] ^ np.uint64(sum(1 << int(b) for b in flips))])
        blocks = other.view(np.uint8)
        lists = [items[starts[blocks[k]] : starts[int(blocks[k]) + 1]] for k, (starts, items) in enumerate(tables)]
        assert any(item in found for found in lists)
        w, items, bits = d.Index._near(other, prints, tables)
        assert (w == 0).all() and dict(zip(items.tolist(), bits.tolist()))[item] == d.RADIUS
        near = np.bitwise_count(prints ^ other[0])
        assert dict(zip(items.tolist(), bits.tolist())) == {k: b for k, b in enumerate(near.tolist()) if b <= d.RADIUS}


def test_against_brute_force():
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [" ".join(rng.choices(vocabulary, k=rng.choice([3, 4, 5, 9, 30, 60]))) for _ in range(25)]
    index = d.Index(list(enumerate(items)), 0.8)
    seen = 0
    for n in range(150):
        words = rng.choices(vocabulary, k=rng.randrange(0, 120))
        put = items[rng.randrange(25)].split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):  # words replaced, dropped or doubled
            k = rng.randrange(len(put))
            put[k : k + 1] = rng.choice([[rng.choice(vocabulary)], [], [put[k], put[k]]])
            put = put or ["w0"]
        at = rng.randrange(len(words) + 1)
        text = " ".join(words[:at]) + "\n" + ", ".join(put).upper() + ". " + " ".join(words[at:])
        got = {k: s for k, s, *_ in index.matches(text)}
        want = {k: s for k, item in enumerate(items) if (s := plain_best(text, item)) >= 0.8}
        assert got == pytest.approx(want)
        seen += len(want)
    assert seen > 60


def test_edge_rows(spark):
    passage = " ".join(f"word{k}" for k in range(30))
    docs = spark.createDataFrame([
        (1, None, "x", "y", 1), (2, "", "x", "y", 1), (3, f"before {passage} after", None, None, None), (3, f"before {passage} after", None, None, None),
        (None, passage.replace(" ", " ,\n"), "x", "y", 1), (5, "filler " * 100_000 + passage, "x", "y", 1), (6, "word1 word2 word3 word4", "x", "y", 1), (7, "only Ten", "x", "y", 1),
    ], DOCS)
    items = spark.createDataFrame([(10, passage, 1), (10, passage, 2), (11, None, 3), (12, " .", 4), (None, "only ten", 5)], ITEMS)
    got = rows(d.contaminated(docs, items), "id", "item_id", "start_word", "n_words", "n_bits")
    found = [(3, 10, 1, 30, 0)] * 4 + [(5, 10, 100_000, 30, 0)] * 2 + [(7, None, 0, 2, 0)] + [(None, 10, 0, 30, 0)] * 2
    assert got == found
    clean = d.clean(docs, items)
    assert clean.columns == docs.columns and rows(clean, "doc_id") == [(1,), (2,), (6,)]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "some text of five words", "", "", 0)], DOCS), spark.createDataFrame([], ITEMS)
    assert d.contaminated(docs, items).count() == 0 and d.clean(docs, items).count() == 1
    assert d.contaminated(docs.limit(0), items).count() == 0


def test_slices_give_the_same(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = rows(d.contaminated(docs, items))
    monkeypatch.setattr(d, "SLICE_ITEMS", 15)
    assert rows(d.contaminated(docs, items)) == whole


def test_query(spark, sf_dir):
    got = rows(queries.op6_decontaminate(spark, sf_dir), "doc_id", "item_id", "similarity")
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    shingles = [(i, set(d.bag(d.words_of(i.text), 5))) for i in items]
    want = []
    for doc in docs:
        own = set(d.bag(d.words_of(doc.text or ""), 5))
        want += [(doc.doc_id, i.item_id, s) for i, bag in shingles if own & bag and (s := plain_best(doc.text, i.text)) >= 0.8]
    assert got == sorted(want)


def test_a_repeated_stem_costs_little():
    """Items that share a stem, as exam questions do, and documents that only repeat it."""
    draw, stem = random.Random(4), "which of the following is true"
    items = [(k, stem + " " + " ".join(f"w{draw.randrange(5000)}" for _ in range(24))) for k in range(2000)]
    index = d.Index(items, 0.8)
    text = " ".join([stem] * 400)
    took = []
    for _ in range(3):
        start = time.perf_counter()
        assert index.matches(text) == []
        took.append(time.perf_counter() - start)
    assert min(took) < 0.3
    assert [m[0] for m in index.matches(text + " " + items[7][1] + " " + text)] == [7]


def test_radius_holds_pairs_at_the_threshold():
    """Of windows just above the threshold the radius finds all, as the binomial distribution of the bits says."""
    rng, found, n = np.random.default_rng(1), 0, 3000
    for _ in range(n):
        m = int(rng.integers(18, 60))
        a = rng.integers(0, 1 << 63, m).astype(np.uint64)
        b = a.copy()
        b[: m // 9] = rng.integers(0, 1 << 63, m // 9).astype(np.uint64)
        x, y = (d.simhashes(h, np.array([0]), m)[0] for h in (a, b))
        found += int(np.bitwise_count(x ^ y)) <= d.RADIUS
    assert found / n > 0.999
