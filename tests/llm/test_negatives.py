import math
import random

import numpy as np
import pytest
from helpers import differs, rows
from pyspark.sql import functions as F

from hourgrid.llm import negatives

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def expected(given, every=100, positives=5, wanted=10, lowest=30, highest=90):
    """By looking at every pair, with whole numbers of any size."""
    whole = {}
    for i, label, vec in given:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        row = (label, [math.floor(256 * x) for x in vec])
        whole[i] = min(whole.get(i, row), row)
    out = []
    for a, (label, vec) in whole.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vec, other)), i, mark) for i, (mark, other) in whole.items() if i != a)
        for p in [(-s, i) for s, i, mark in scored if mark == label][:positives]:
            hard = [(-s, i) for s, i, mark in scored if mark != label and lowest * p[0] <= -100 * s <= highest * p[0]]
            out += [(a, p[1], k + 1, i, p[0], s) for k, (s, i) in enumerate(hard[:wanted])]
    return sorted(out)


def table(spark, given):
    return spark.createDataFrame(given, "vec_id long, label int, embedding array<float>").repartition(4)


def clustered(n, seed, width=6):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(9, width))
    found = centres[draw.integers(9, size=n)] + draw.normal(size=(n, width)) * 0.2
    found[::11] = found[0]  # one vector many times: ties
    found = found.astype(np.float32)
    return [(int(i) * 5, int(draw.integers(4)), [float(x) for x in v]) for i, v in zip(draw.permutation(n), found)]


@pytest.mark.parametrize("seed, sample", [(1, 8192), (2, 100), (3, 1)])
def test_against_every_pair(spark, seed, sample):
    given = clustered(700, seed)
    found = negatives.hard_negatives(table(spark, given), every=50, sample_rows=sample)
    assert rows(found, *COLUMNS) == expected(given, 50)


def test_cells_of_few_rows(spark, monkeypatch):
    """Leaves dealt out over cells, and many queries of a leaf, give the same."""
    monkeypatch.setattr(negatives, "CELL", 16)
    given = clustered(400, 4)
    assert rows(negatives.hard_negatives(table(spark, given), every=10), *COLUMNS) == expected(given, 10)


def test_the_tree_leaves_out_subtrees_without_hits():
    rng = np.random.default_rng(5)
    data = np.floor(256 * np.concatenate([c + rng.normal(size=(300, 8)) * 0.05 for c in rng.normal(size=(12, 8))]))
    tree = negatives.Tree(data[::3])
    leaf, ranges = tree.placed(data)
    best = {}
    for *key, low, high in ranges:
        have = best.get(tuple(key), (np.inf, -np.inf))
        best[tuple(key)] = (min(have[0], low), max(have[1], high))
    tree.ranged([(*k, *v) for k, v in best.items()])
    queries = data[::100]
    score = negatives.scores(queries, data)
    low = np.sort(score, axis=1)[:, -60].astype(float)
    high = np.sort(score, axis=1)[:, -20].astype(float)
    query, found = tree.visited(queries, low, high)
    visited = set(zip(query.tolist(), found.tolist()))
    for q in range(len(queries)):
        hits = set(leaf[(score[q] >= low[q]) & (score[q] <= high[q])].tolist())
        assert all((q, x) in visited for x in hits)
    assert len(visited) < 0.5 * len(queries) * tree.leaves


def test_nulls_lengths_repeats_and_empty_tables(spark):
    inf, nan = float("inf"), float("nan")
    given = [
        (0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (0, 2, [0.0]), (1, 1, [1.0, 1.9]), (2, 1, [1.0]), (3, 2, [0.9, 1.5, 7.0]), (4, 2, [1.0, 1.0]), (5, 3, []),
        (6, None, [1.0]), (7, 1, None), (8, 2, [1.0, None]), (9, 2, [nan, 1.0]), (10, 2, [inf]), (None, 2, [1.0]), (100, 3, [-1.0, -1.0]), (101, 3, [1.0, 1.0]),
    ]
    odd = table(spark, given).selectExpr("vec_id", "label", "embedding", "1 AS id", "2 AS leaf", "3 AS `a.b`")
    assert rows(negatives.hard_negatives(odd), *COLUMNS) == expected(given)
    assert rows(negatives.hard_negatives(table(spark, [])), *COLUMNS) == []
    assert rows(negatives.hard_negatives(table(spark, [(0, 1, [])])), *COLUMNS) == []


def test_scores_beyond_doubles(spark):
    draw = random.Random(6)
    given = [(k, k % 2, [float(draw.randrange(1 << 22)) for _ in range(3)]) for k in range(40)]
    assert rows(negatives.hard_negatives(table(spark, given), every=20), *COLUMNS) == expected(given, 20)


def test_registered_query(spark, sf_dir):
    assert differs(spark, sf_dir, "op12_negatives") is None


def test_relabelled(spark):
    given = clustered(60, 7)
    label = F.when(F.col("vec_id") % 7 == 0, F.col("label") + 1).otherwise(F.col("label"))
    want = expected([(i, mark + (i % 7 == 0), vec) for i, mark, vec in given], 50)
    assert rows(negatives.hard_negatives(table(spark, given), label=label, every=50), *COLUMNS) == want
