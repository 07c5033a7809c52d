"""Queries on discounting and net power per node (electricity)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourgrid.operators import curves, discount
from hourgrid.plans import views as v
from hourgrid.plans.registry import query
from hourgrid.plans.views import SCENARIO, define

AREA = "R4"
CHUNK = 24

# both sources cut to the shorter one, then the rules of discounting step by step
define("limits", """SELECT a.scenario_id, least(n, m, 8760) AS lim FROM (SELECT scenario_id, max(hour) + 1 AS n FROM market_curve GROUP BY ALL) a
    JOIN (SELECT scenario_id, max(hour) + 1 AS m FROM site_curve GROUP BY ALL) b ON a.scenario_id = b.scenario_id""")
define("em", "SELECT e.* FROM market_node e JOIN limits l ON e.scenario_id = l.scenario_id WHERE hour < lim")
define("xs", "SELECT x.* FROM site_node x JOIN limits l ON x.scenario_id = l.scenario_id WHERE hour < lim")


def _steps(tag: str, area: str | None) -> None:
    """Views of the discount rules with or without an exception node."""
    outside = f"node <> '{area}'" if area else "true"
    owed = "coalesce(hx, 0) - coalesce(he, 0)" if area else "coalesce(hx, 0)"
    define(f"tot_{tag}", f"""SELECT scenario_id, hour, product, sector, sum(CASE WHEN {outside} THEN mw ELSE 0 END) AS t,
        sum(CASE WHEN {outside} THEN 0 ELSE mw END) AS he FROM em GROUP BY ALL""")
    define(f"hx_{tag}", "SELECT scenario_id, hour, product, sector, sum(mw) AS hx FROM xs GROUP BY ALL")
    define(f"cell_{tag}", f"""SELECT coalesce(a.scenario_id, b.scenario_id) AS scenario_id, coalesce(a.hour, b.hour) AS hour,
        coalesce(a.product, b.product) AS product, coalesce(a.sector, b.sector) AS sector, coalesce(t, 0) AS t, coalesce(he, 0) AS he,
        coalesce(hx, 0) AS hx, coalesce(a.hour, b.hour) // {CHUNK} AS chunk,
        CASE WHEN EXISTS (SELECT 1 FROM hx_{tag} k WHERE k.scenario_id = coalesce(a.scenario_id, b.scenario_id)
            AND k.product = coalesce(a.product, b.product) AND k.sector = coalesce(a.sector, b.sector)) THEN {owed} ELSE 0 END AS d
        FROM tot_{tag} a FULL OUTER JOIN hx_{tag} b ON a.scenario_id = b.scenario_id AND a.hour = b.hour
            AND a.product = b.product AND a.sector = b.sector""")
    define(f"imb_{tag}", f"""SELECT scenario_id, chunk, bool_or(round(t, 9) < round(d, 9)) AS imb FROM cell_{tag} GROUP BY ALL""")
    define(f"kept_{tag}", f"""SELECT e.scenario_id, e.hour, e.node, e.product, e.sector, c.chunk,
        e.mw - CASE WHEN c.t = 0 THEN 0 ELSE e.mw / c.t * c.d END AS mw
        FROM em e JOIN cell_{tag} c ON e.scenario_id = c.scenario_id AND e.hour = c.hour AND e.product = c.product AND e.sector = c.sector
        WHERE {outside.replace('node', 'e.node')}""")
    define(f"n1_{tag}", f"SELECT scenario_id, hour, chunk, node, product, sum(mw) AS n1 FROM kept_{tag} GROUP BY ALL")
    define(f"res_{tag}", f"""SELECT e.scenario_id, e.hour, e.product, e.total - coalesce(n.total, 0) - coalesce(x.total, 0) AS r, n.total AS left_
        FROM (SELECT scenario_id, hour, product, sum(mw) AS total FROM em GROUP BY ALL) e
        LEFT JOIN (SELECT scenario_id, hour, product, sum(n1) AS total FROM n1_{tag} GROUP BY ALL) n
            ON e.scenario_id = n.scenario_id AND e.hour = n.hour AND e.product = n.product
        LEFT JOIN (SELECT scenario_id, hour, product, sum(mw) AS total FROM xs GROUP BY ALL) x
            ON e.scenario_id = x.scenario_id AND e.hour = x.hour AND e.product = x.product""")
    define(f"n2_{tag}", f"""SELECT n.scenario_id, n.hour, n.node, n.product,
        CASE WHEN i.imb THEN CASE WHEN round(r.left_, 9) = 0 THEN 0 ELSE n1 + n1 / r.left_ * r.r END ELSE n1 END AS mw
        FROM n1_{tag} n JOIN imb_{tag} i ON n.scenario_id = i.scenario_id AND n.chunk = i.chunk
        JOIN res_{tag} r ON n.scenario_id = r.scenario_id AND n.hour = r.hour AND n.product = r.product""")
    define(f"net_{tag}", f"""SELECT scenario_id, hour, node, sum(CASE WHEN product = 'Supply' THEN mw ELSE -mw END) AS power
        FROM (SELECT scenario_id, hour, node, product, mw FROM n2_{tag}
              UNION ALL SELECT scenario_id, hour, node, product, mw FROM xs) GROUP BY ALL""")


_steps("area", AREA)
_steps("plain", None)


def _aligned(spark, d):
    market, sites = curves.align_series(v.market_curve(spark, d), v.site_curve(spark, d), by=SCENARIO)
    nodal = curves.regional_market_curves(market, v.categories(spark, d), v.weights(spark, d), by=SCENARIO)
    return nodal, curves.nodal_sector_curves(sites, v.site(spark, d), by=SCENARIO)


def _cells(spark, d):
    market, simulated = _aligned(spark, d)
    totals = discount.market_totals(market, [AREA], SCENARIO)
    return discount.discounts(totals, discount.site_totals(simulated, SCENARIO), True, SCENARIO, CHUNK)


_NET = "SELECT scenario_id, hour, node, round(power, 4) + 0.0 AS power FROM net_{}"


@query("c4_discount", _NET.format("area"))
def c4(spark, d):
    market, simulated = _aligned(spark, d)
    return discount.discount(market, simulated, AREA, CHUNK, SCENARIO)


@query("c4_discount_without_exceptions", _NET.format("plain"))
def c4_plain(spark, d):
    market, simulated = _aligned(spark, d)
    return discount.discount(market, simulated, None, CHUNK, SCENARIO)


@query("c5_nodal_power", _NET.format("area"))
def c5(spark, d):
    return discount.nodal_power(
        v.market_curve(spark, d), v.site_curve(spark, d), v.categories(spark, d), v.weights(spark, d), v.site(spark, d),
        AREA, chunk_hours=CHUNK, by=SCENARIO,
    )


@query("w3_imbalanced_chunks", "SELECT scenario_id, CAST(chunk AS INTEGER) AS chunk, imb AS imbalanced FROM imb_area")
def w3(spark, d):
    return discount.imbalanced_chunks(_cells(spark, d), SCENARIO)


@query("j9_discount_per_cell", """SELECT scenario_id, hour, product, sector, round(t, 4) + 0.0 AS t, round(he, 4) + 0.0 AS inside,
    round(hx, 4) + 0.0 AS hx, round(d, 4) + 0.0 AS d, CAST(chunk AS INTEGER) AS chunk FROM cell_area""")
def j9(spark, d):
    return _cells(spark, d)


@query("w1_share_of_hourly_total", """SELECT e.scenario_id, e.hour, node, e.product, e.sector,
    round(CASE WHEN t = 0 THEN 0 ELSE mw / t END, 4) + 0.0 AS share
    FROM em e JOIN tot_plain t ON e.scenario_id = t.scenario_id AND e.hour = t.hour AND e.product = t.product AND e.sector = t.sector""")
def w1(spark, d):
    market, _ = _aligned(spark, d)
    cell = ["scenario_id", "hour", "product", "sector"]
    totals = market.groupBy(*cell).agg(F.sum("mw").alias("t"))
    share = F.coalesce(F.try_divide("mw", "t"), F.lit(0.0)).alias("share")
    return market.join(totals, cell).select("scenario_id", "hour", "node", "product", "sector", share)


@query("j7_area_split", f"""SELECT scenario_id, hour, node = '{AREA}' AS inside, round(sum(mw), 4) + 0.0 AS mw FROM em GROUP BY ALL""")
def j7(spark, d):
    market, _ = _aligned(spark, d)
    return market.groupBy("scenario_id", "hour", (F.col("node") == AREA).alias("inside")).agg(F.sum("mw").alias("mw"))


@query("a7_totals_by_product", "SELECT scenario_id, hour, product, round(sum(mw), 4) + 0.0 AS mw FROM em GROUP BY ALL")
def a7(spark, d):
    market, _ = _aligned(spark, d)
    return market.groupBy("scenario_id", "hour", "product").agg(F.sum("mw").alias("mw"))


@query("a8_net_power", """SELECT scenario_id, hour, node, round(sum(CASE WHEN product = 'Supply' THEN mw ELSE -mw END), 4) + 0.0 AS power
    FROM (SELECT scenario_id, hour, node, product, mw FROM em UNION ALL SELECT scenario_id, hour, node, product, mw FROM xs) GROUP BY ALL""")
def a8(spark, d):
    market, simulated = _aligned(spark, d)
    return discount.net_power(market, simulated, SCENARIO)


@query("u1_union_of_sources", """SELECT scenario_id, hour, node, product, sector, round(mw, 4) + 0.0 AS mw FROM em
    UNION ALL SELECT scenario_id, hour, node, product, sector, round(mw, 4) + 0.0 FROM xs""")
def u1(spark, d):
    market, simulated = _aligned(spark, d)
    return market.unionByName(simulated, allowMissingColumns=True)


@query("c17_discountability", """SELECT e.scenario_id, e.hour, e.product, round(e.m, 4) + 0.0 AS market_mw, round(x.s, 4) + 0.0 AS simulated_mw,
    round(e.m - x.s, 9) >= 0 AS discountable
    FROM (SELECT scenario_id, hour, product, sum(mw) AS m FROM em GROUP BY ALL) e
    JOIN (SELECT scenario_id, hour, product, sum(mw) AS s FROM xs GROUP BY ALL) x
      ON e.scenario_id = x.scenario_id AND e.hour = x.hour AND e.product = x.product""")
def c17(spark, d):
    from hourgrid.operators.checks import hourly_totals

    return hourly_totals(*_aligned(spark, d), SCENARIO)


@query("a14_any_and_all", """SELECT scenario_id, product, bool_or(round(t, 9) < round(d, 9)) AS any_short,
    bool_and(round(t, 9) >= round(d, 9)) AS all_covered FROM cell_area GROUP BY ALL""")
def a14(spark, d):
    short = F.round("t", 9) < F.round("d", 9)
    return _cells(spark, d).groupBy("scenario_id", "product").agg(
        F.bool_or(short).alias("any_short"), F.bool_and(~short).alias("all_covered")
    )


@query("d_undistributable", """SELECT c.scenario_id, c.hour, c.product, CAST(c.hour // 24 AS INTEGER) AS chunk
    FROM res_area c JOIN imb_area i ON c.scenario_id = i.scenario_id AND c.hour // 24 = i.chunk
    WHERE i.imb AND round(left_, 9) = 0 AND round(r, 9) <> 0""")
def undistributable(spark, d):
    return discount.undistributable(_cells(spark, d), SCENARIO).select("scenario_id", "hour", "product", "chunk")


define("und_cell", f"""SELECT coalesce(a.scenario_id, b.scenario_id) AS scenario_id, coalesce(a.hour, b.hour) AS hour, coalesce(a.product, b.product) AS product,
    coalesce(he, 0) AS he, coalesce(hx, 0) AS hx, CASE WHEN EXISTS (SELECT 1 FROM hx_area k WHERE k.scenario_id = coalesce(a.scenario_id, b.scenario_id)
        AND k.product = coalesce(a.product, b.product) AND k.sector = coalesce(a.sector, b.sector)) THEN coalesce(hx, 0) - coalesce(he, 0) ELSE 0 END AS d
    FROM (SELECT scenario_id, hour, product, sector, sum(mw) AS he FROM em WHERE node = '{AREA}' GROUP BY ALL) a
    FULL OUTER JOIN hx_area b ON a.scenario_id = b.scenario_id AND a.hour = b.hour AND a.product = b.product AND a.sector = b.sector""")
define("und_imb", f"SELECT scenario_id, hour // {CHUNK} AS chunk, bool_or(round(d, 9) > 0) AS imb FROM und_cell GROUP BY ALL")


@query("d_undistributable_area_only", f"""SELECT c.scenario_id, c.hour, c.product, CAST(c.hour // {CHUNK} AS INTEGER) AS chunk, round(sum(he) - sum(hx), 4) + 0.0 AS residual
    FROM und_cell c JOIN und_imb i ON c.scenario_id = i.scenario_id AND c.hour // {CHUNK} = i.chunk WHERE i.imb
    GROUP BY c.scenario_id, c.hour, c.product HAVING round(sum(he) - sum(hx), 9) <> 0""")
def undistributable_area_only(spark, d):
    """All market power lies in the area, so no residual can be spread."""
    market, simulated = _aligned(spark, d)
    area = market.where(F.col("node") == AREA)
    market = area.unionByName(area.withColumns({"node": F.lit("R0"), "mw": F.lit(0.0)}))
    totals = discount.market_totals(market, [AREA], SCENARIO)
    cells = discount.discounts(totals, discount.site_totals(simulated, SCENARIO), True, SCENARIO, CHUNK)
    return discount.undistributable(cells, SCENARIO).select("scenario_id", "hour", "product", "chunk", "residual")
