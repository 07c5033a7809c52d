"""Properties that hold for any input, and an independent restatement of discounting."""

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from hourgrid.operators import curves, discount, gas, overload
from hourgrid.plans import views as v
from hourgrid.plans.views import SCENARIO

S = ("scenario_id",)


def test_balance_sums_to_zero(spark, sf_dir):
    balanced = gas.balance_on_slack(v.gas_curve(spark, sf_dir), by=SCENARIO)
    worst = gas.hourly_balance(balanced, SCENARIO).agg(F.max(F.abs("residual"))).first()[0]
    assert worst < 1e-6


def test_regional_curves_keep_the_total(spark, sf_dir):
    sectors = curves.categorise(v.market_curve(spark, sf_dir), v.categories(spark, sf_dir), by=SCENARIO)
    nodal = curves.regionalise(sectors, v.weights(spark, sf_dir), SCENARIO)
    a, b = (df.agg(F.sum("mw")).first()[0] for df in (sectors, nodal))
    assert a == pytest.approx(b)


def test_score_is_median_times_frequency(spark, sf_dir):
    flow = overload.mv_substation_flow(v.site_curve(spark, sf_dir), v.site(spark, sf_dir), SCENARIO)
    got = overload.substation_overload(flow, v.substation(spark, sf_dir), by=SCENARIO)
    off = F.abs(F.col("overloadScore") - F.col("overloadMedian") * F.col("overloadFreq") / 8760)
    assert got.agg(F.max(off)).first()[0] < 1e-9


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_same_result_for_any_partitioning(spark, sf_dir, parts):
    curve = v.site_curve(spark, sf_dir).repartition(parts)
    flow = overload.mv_substation_flow(curve, v.site(spark, sf_dir), SCENARIO)
    got = overload.substation_overload(flow, v.substation(spark, sf_dir), by=SCENARIO)
    expected = overload.mv_substation_flow(v.site_curve(spark, sf_dir), v.site(spark, sf_dir), SCENARIO)
    expected = overload.substation_overload(expected, v.substation(spark, sf_dir), by=SCENARIO)
    assert rows(got, "scenario_id", "elementName", "overloadFreq", "overloadVolume") == rows(
        expected, "scenario_id", "elementName", "overloadFreq", "overloadVolume")


def restated(market: pd.DataFrame, sites: pd.DataFrame, area: list[str], size: int) -> pd.Series:
    """Discounting on dense wide frames, chunk by chunk, written from the rules."""
    out = []
    cells = ["product", "sector"]
    m = market.pivot_table(index=["hour", "node"], columns=cells, values="mw", aggfunc="sum").fillna(0.0)
    x = sites.pivot_table(index=["hour", "node"], columns=cells, values="mw", aggfunc="sum").fillna(0.0)
    for _, hours in pd.Series(sorted(market.hour.unique())).groupby(lambda i: i // size):
        e = m[m.index.get_level_values("hour").isin(hours)]
        s = x[x.index.get_level_values("hour").isin(hours)]
        inside = e.index.get_level_values("node").isin(area)
        n = e[~inside]
        he = e[inside].groupby("hour").sum().reindex(hours, fill_value=0.0)
        hx = s.groupby("hour").sum().reindex(hours, fill_value=0.0)
        total = n.groupby("hour").sum()
        owed = pd.DataFrame(0.0, index=total.index, columns=total.columns)
        for c in hx.columns:
            owed[c] = hx[c] - he[c] if area else hx[c]
        share = n / total.reindex(n.index.get_level_values("hour")).to_numpy()
        n = n - share.fillna(0.0) * owed.reindex(n.index.get_level_values("hour")).to_numpy()
        per = lambda f: f.T.groupby(level="product").sum().T
        n1, x1 = per(n), per(s)
        if (total.round(9) < owed.round(9)).any().any():
            rest = per(e.groupby("hour").sum()) - n1.groupby("hour").sum() - x1.groupby("hour").sum().reindex(hours, fill_value=0.0)
            left = n1.groupby("hour").sum()
            left = left.where(left.round(9) != 0)
            at = n1.index.get_level_values("hour")
            n1 = (n1 + n1 / left.reindex(at).to_numpy() * rest.reindex(at).to_numpy()).fillna(0.0)
        both = pd.concat([n1, x1])
        out.append(both["Supply"] - both["Demand"])
    return pd.concat(out).sort_index()


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("area", [[], ["A"], ["A", "B"]])
def test_discount_against_restatement(spark, seed, area):
    rng = np.random.default_rng(seed)
    hours, nodes = range(30), ["A", "B", "C", "D"]
    pairs = [(p, s) for p in ("Supply", "Demand") for s in ("s1", "s2", "s3")]
    market = pd.DataFrame([
        ("z", h, n, p, s, round(float(rng.uniform(0, 40)), 3) if rng.random() < 0.8 else 0.0)
        for h in hours for n in nodes for p, s in pairs], columns=["scenario_id", "hour", "node", "product", "sector", "mw"])
    known = pairs if not area else [c for c in pairs if c[1] != "s3"]
    scale = 150 if seed % 2 else 40
    sites = pd.DataFrame([
        ("z", h, n, p, s, round(float(rng.uniform(0, scale)), 3) if rng.random() < 0.6 else 0.0)
        for h in hours for n in ("X", "Y") for p, s in known], columns=market.columns)
    schema = "scenario_id string, hour int, node string, product string, sector string, mw double"
    got = discount.discount(spark.createDataFrame(market, schema), spark.createDataFrame(sites, schema), area, 7, S).toPandas()
    ours = got.set_index(["hour", "node"])["power"].sort_index()
    theirs = restated(market, sites, area, 7)
    assert list(ours.index) == list(theirs.index)
    np.testing.assert_allclose(ours.to_numpy(), theirs.to_numpy(), atol=1e-6)


def test_fused_power_equals_the_general_one(spark, sf_dir):
    """The nodal path and the one that spreads last must agree."""
    market, site = curves.align_series(v.market_curve(spark, sf_dir), v.site_curve(spark, sf_dir), by=SCENARIO)
    nodal = curves.regional_market_curves(market, v.categories(spark, sf_dir), v.weights(spark, sf_dir), by=SCENARIO)
    simulated = curves.nodal_sector_curves(site, v.site(spark, sf_dir), by=SCENARIO)
    general = discount.discount(nodal, simulated, ["R4", "R0"], 48, SCENARIO)
    fused = discount.nodal_power(
        v.market_curve(spark, sf_dir), v.site_curve(spark, sf_dir), v.categories(spark, sf_dir), v.weights(spark, sf_dir),
        v.site(spark, sf_dir), ["R4", "R0"], chunk_hours=48, by=SCENARIO)
    joined = general.join(fused.withColumnRenamed("power", "other"), ["scenario_id", "hour", "node"], "full_outer")
    off = F.coalesce(F.abs(F.col("power") - F.col("other")), F.lit(1e9))
    assert joined.agg(F.max(off)).first()[0] < 1e-6


def test_plans_share_one_market(spark, sf_dir):
    """Site designs per plan fan out over a market that knows no plan."""
    market = curves.categorise(v.market_curve(spark, sf_dir), v.categories(spark, sf_dir), by=SCENARIO)
    market = curves.regionalise(market, v.weights(spark, sf_dir), SCENARIO)
    sites = v.site(spark, sf_dir).select("*", F.explode(F.array(F.lit("p1"), F.lit("p2"))).alias("plan"))
    by = ("scenario_id", "plan")
    simulated = curves.nodal_sector_curves(v.site_curve(spark, sf_dir).where("hour < 720"), sites, by=by)
    power = discount.discount(market, simulated, "R4", 24, by)
    one = power.where("plan = 'p1'").drop("plan")
    two = power.where("plan = 'p2'").drop("plan")
    assert one.count() == two.count() > 0
    joined = one.join(two.withColumnRenamed("power", "other"), ["scenario_id", "hour", "node"])
    assert joined.agg(F.max(F.abs(F.col("power") - F.col("other")))).first()[0] < 1e-9
