"""Groups of any size: one key holds a third of all rows or more."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from hourgrid.functions import positions, quantiles
from hourgrid.operators import curves, gas

SHAPES = {
    "uniform": lambda rng, n: rng.uniform(-5, 5, n),
    "heavy tail": lambda rng, n: rng.pareto(0.5, n) * rng.choice([-1, 1], n),
    "ties": lambda rng, n: rng.integers(0, 3, n).astype(float),
    "one value": lambda rng, n: np.full(n, 2.5),
    "two clusters": lambda rng, n: np.concatenate([np.full(n // 2, -1.0), np.full(n - n // 2, 1.0)]),
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
@pytest.mark.parametrize("bound", [10, 10_000])
def test_exact_median(spark, shape, bound):
    rng = np.random.default_rng(7)
    groups = {"hot": 20_001, "even": 1000, "pair": 2, "single": 1}
    values = {g: SHAPES[shape](rng, n) for g, n in groups.items()}
    data = [(g, float(x)) for g, xs in values.items() for x in xs] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(data, "k string, x double").repartition(8)
    got = {r["k"]: r for r in quantiles.statistics(df, ["k"], "x", bound).collect()}
    assert sorted(got) == sorted([*groups, "empty"])
    assert got["empty"]["n"] == 0 and got["empty"]["median"] is None
    for g, xs in values.items():
        assert got[g]["n"] == len(xs)
        assert got[g]["median"] == pytest.approx(float(np.median(xs)), abs=1e-12)
        assert got[g]["total"] == pytest.approx(float(np.sum(xs)), rel=1e-9)


def test_no_window_holds_a_hot_group(spark, monkeypatch):
    """What is ranked at last holds no more rows of a group than the bound says."""
    df = spark.createDataFrame([("hot", float(x)) for x in np.random.default_rng(1).normal(size=30_000)], "k string, x double")
    seen, ranked = [], quantiles._ranked

    def watched(slim, state, keys):
        seen.append(quantiles._inside(slim, state, keys).groupBy(*keys).count().agg(F.max("count")).first()[0])
        return ranked(slim, state, keys)

    monkeypatch.setattr(quantiles, "_ranked", watched)
    assert quantiles.statistics(df, ["k"], "x", 100).count() == 1 and 0 < seen[0] <= 100


@pytest.mark.parametrize("shape", ["magnitudes", "outliers", "far and near"])
def test_few_rounds_whatever_the_values(spark, monkeypatch, shape):
    """Values over 600 magnitudes would take a round for each factor of a thousand if all parts were of equal width."""
    rng, n = np.random.default_rng(5), 40_001
    values = {
        "magnitudes": lambda: 10.0 ** rng.uniform(-300, 300, n) * rng.choice([-1, 1], n),
        "outliers": lambda: np.concatenate([rng.normal(size=n - 5), np.full(5, 1e300)]),
        "far and near": lambda: np.concatenate([1 + rng.uniform(0, 1e-9, n - 20_000), rng.uniform(-1e200, 1e200, 20_000)]),
    }[shape]()
    df = spark.createDataFrame([("hot", float(x)) for x in values], "k string, x double").repartition(8)
    rounds, narrowed = [], quantiles._narrowed
    monkeypatch.setattr(quantiles, "_narrowed", lambda *a: rounds.append(1) or narrowed(*a))
    got = quantiles.statistics(df, ["k"], "x", 100).first()
    assert got["median"] == pytest.approx(float(np.median(values)), rel=1e-12) and len(rounds) <= 4


@pytest.mark.parametrize("block", [1, 7, 1 << 16])
def test_row_numbers_across_blocks(spark, block):
    rng = np.random.default_rng(3)
    data = [(g, int(i)) for g, n in (("hot", 500), (None, 20), ("one", 1)) for i in rng.permutation(n * 3)[:n]]
    df = spark.createDataFrame(data, "k string, i bigint")
    got = rows(positions.number_rows(df, ["k"], "i", "pos", block), "k", "i", "pos")
    expected = []
    for g in {g for g, _ in data}:
        expected += [(g, i, p) for p, i in enumerate(sorted(i for k, i in data if k == g))]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_bounded_and_unbounded_medians_agree(spark, sf_dir):
    flow = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", F.col("l_extendedprice").alias("x"))
    a = rows(quantiles.bounded_statistics(flow, ["l_suppkey"], "x"), "l_suppkey", "n", "median")
    b = rows(quantiles.statistics(flow, ["l_suppkey"], "x"), "l_suppkey", "n", "median")
    assert a == b


@pytest.fixture
def no_broadcast(spark):
    """Joins as large lookups give them, and partitions as they are shuffled."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _one_run(spark):
    hours = spark.range(4000).select(F.lit("F").alias("scenario_id"), F.lit("methane").alias("carrier"), F.col("id").cast("int").alias("hour"))
    curve = hours.select("*", F.explode(F.array(F.lit("a"), F.lit("b"), F.lit(None))).alias("site")).withColumn("mw", F.rand(1))
    return curve.unionByName(curve.limit(1).withColumn("scenario_id", F.lit(None).cast("string")))


RUN_JOINS = {
    "cut_to": lambda spark, c: curves.cut_to(c, spark.createDataFrame([("F", 3000)], "scenario_id string, _limit int"), ["scenario_id"]),
    "fit_calendar": lambda spark, c: gas.fit_calendar(
        c, spark.createDataFrame([("F", "methane", 4000)], "scenario_id string, carrier string, market_hours int"), 3000, ["scenario_id"]),
}


@pytest.mark.parametrize("name", sorted(RUN_JOINS))
def test_the_rows_of_one_run_go_to_many_tasks(spark, no_broadcast, name):
    curve = _one_run(spark)
    got = RUN_JOINS[name](spark, curve).localCheckpoint()
    columns = ["scenario_id", "hour", "site", "mw"]
    assert rows(got, *columns) == rows(curve.where("hour < 3000 AND scenario_id IS NOT NULL"), *columns)
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) < 0.4 * sum(per_task)
