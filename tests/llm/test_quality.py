import zlib

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from hourgrid.llm import quality, queries


def auc(y, score):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(y))
    ranks[order] = np.arange(len(y))
    ones = y == 1
    return (ranks[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


def test_trees_learn_what_no_single_feature_tells():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def test_arrays_walk_like_trees():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(300, 3)), rng.integers(0, 2, 300).astype(float)
    model = quality.fit(x, y, trees=7, depth=3)
    binned = model.binned(x)
    for row in range(0, 300, 37):
        logit = model.prior
        for t in range(7):
            node = 0
            while node < 7:
                node = 2 * node + 1 + int(binned[row, model.feature[t, node]] > model.bin[t, node])
            logit += model.value[t, node - 7]
        assert model.score(x[row : row + 1])[0] == pytest.approx(1 / (1 + np.exp(-logit)))


def test_nothing_to_learn_from():
    width = len(quality.STATISTICS)
    assert quality.fit(np.zeros((0, width)), np.zeros(0)).score(np.zeros((2, width))).tolist() == [0.5, 0.5]
    assert quality.fit(np.ones((9, width)), np.ones(9)).score(np.ones((1, width)))[0] > 0.9
    assert quality.fit(np.ones((9, width)), np.ones(9)).score(np.ones((0, width))).tolist() == []


@pytest.mark.parametrize("text", ["", " \n\t", "a", "!!!", " ", "word " * 100_000, "\n" * 50_000, "é" * 99_999])
def test_statistics_of_odd_texts(text):
    got = quality.statistics(text)
    assert len(got) == len(quality.STATISTICS) and np.isfinite(got).all()


def test_edge_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, 9.0), (7, "", 9.0), (7, "", 9.0), (8, "x " * 200_000, None)], "doc_id long, text string, score double")
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), sample_rows=100)
    got = rows(quality.scored(odd, model))
    assert len(got) == 4 and all(0 <= s <= 1 and p == (s >= 0.3) for _, s, p in got)
    assert len({s for i, s, _ in got if i != 8}) == 1
    assert quality.accepted(odd, model).columns == odd.columns
    assert quality.scored(odd.limit(0), model).count() == 0
    bare = quality.train(docs.limit(0), spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int"))
    assert bare.score(np.zeros((1, len(quality.STATISTICS))))[0] == 0.5


def test_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op1_quality(spark, sf_dir).toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    both = got[got["held_out"]].merge(labels, on="doc_id")
    assert auc(both["quality"].to_numpy(), both["score"].to_numpy()) > 0.95
    assert (both["predicted"][both["quality"] == 1] == 1).mean() > 0.95


def test_held_out_labels_do_not_count(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(F.expr(queries.HELD_OUT), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = queries.quality_model(docs, labels), queries.quality_model(docs, turned)
    assert (a.value == b.value).all() and (a.feature == b.feature).all()


def test_the_sample_is_bounded_where_documents_share_an_identifier(spark, monkeypatch):
    """What comes to the driver has as many rows as the parameter says, and the same ones in any order of the table."""
    docs = spark.createDataFrame([(1, f"text number {k} with words") for k in range(500)] + [(1, "twice")] * 40 + [(2, "other text")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append((x.copy(), y.copy())))
    for frame in (docs, docs.orderBy("text").repartition(7)):
        quality.train(frame, labels, sample_rows=10)
    (x, y), (again, _) = seen
    assert len(x) == len(y) == 10 and (x == again).all()


def test_statistics_and_splits_against_plain_code():
    """The best first split of a small sample is the one that trying every feature and bin finds."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = (x[:, 3] + 0.3 * rng.normal(size=400) > 0.4).astype(float)
    model = quality.fit(x, y, trees=1, depth=1, rate=1.0)
    p = 1 / (1 + np.exp(-model.prior))
    grad, hess = y - p, np.full(len(y), p * (1 - p))
    binned, best = model.binned(x).astype(int), (-1.0, None, None)
    for f in range(5):
        for cut in range(quality.BINS - 1):
            left = binned[:, f] <= cut
            if hess[left].sum() < quality.LEAST_WEIGHT or hess[~left].sum() < quality.LEAST_WEIGHT:
                continue
            score = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + quality.RIDGE)  # noqa: E731, B023
            gain = score(left) + score(~left) - score(np.ones(len(y), bool))
            if gain > best[0] + 1e-9:
                best = (gain, f, cut)
    assert (model.feature[0, 0], model.bin[0, 0]) == best[1:]
    left = binned[:, best[1]] <= best[2]
    want = [grad[m].sum() / (hess[m].sum() + quality.RIDGE) for m in (left, ~left)]
    assert np.allclose(model.value[0], want)
