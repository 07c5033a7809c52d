"""Reconcile market curves with simulated site curves into net power per node and hour.

Both sources describe the same demand and supply.  What the sites report is taken
off the market curves of the remaining nodes, in proportion to their share, per
hour, product and sector.

The amount taken off depends on hourly totals only, so it is one factor per
(hour, product, sector).  The factors are worked out on those small tables; the
wide node axis is touched once, to multiply and to sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.fixed import CHUNK_HOURS
from hourgrid.functions import power, time
from hourgrid.keys import BY, held, per_run, run_keys, shared
from hourgrid.operators import curves as c

CELL = ["hour", "product", "sector"]
# decimals at which totals are compared, so that summation order cannot flip a chunk
COMPARE = 9


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def market_totals(market: DataFrame, exceptions: Sequence[str], by: Sequence[str] = BY) -> DataFrame:
    """Totals per hour, product and sector: ``t`` outside the exception nodes, ``inside`` on them."""
    inside = F.col("node").isin(list(exceptions)) if exceptions else F.lit(False)
    return market.groupBy(*run_keys(market, by), *CELL).agg(
        F.sum(F.when(~inside, F.col("mw")).otherwise(0.0)).alias("t"),
        F.sum(F.when(inside, F.col("mw")).otherwise(0.0)).alias("inside"),
    )


def weighted_totals(
    categorised: DataFrame, weights: DataFrame, exceptions: Sequence[str], by: Sequence[str] = BY
) -> DataFrame:
    """The same totals without spreading the curves over the nodes first."""
    inside = F.col("node").isin(list(exceptions)) if exceptions else F.lit(False)
    shares = weights.groupBy(*held(weights, by), "sector").agg(
        F.sum(F.when(~inside, F.col("weight")).otherwise(0.0)).alias("_out"),
        F.sum(F.when(inside, F.col("weight")).otherwise(0.0)).alias("_in"),
    )
    on = shared(categorised, shares, by, "sector")
    return categorised.join(shares, on).select(
        *run_keys(categorised, by), *CELL,
        (F.col("mw") * F.col("_out")).alias("t"),
        (F.col("mw") * F.col("_in")).alias("inside"),
    )


def site_totals(simulated: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    return simulated.groupBy(*run_keys(simulated, by), *CELL).agg(F.sum("mw").alias("hx"))


def discounts(
    totals: DataFrame, site: DataFrame, with_exceptions: bool, by: Sequence[str] = BY, chunk_hours: int = CHUNK_HOURS
) -> DataFrame:
    """Per run, hour, product and sector: market total ``t``, discount ``d``, both sources' totals, chunk.

    The market volume on the exception nodes is replaced by the simulated one, so
    only the difference is discounted.  A sector the sites do not have at all is
    not discounted.
    """
    keys = run_keys(site, by)
    # a market without all run keys serves every run that shares the ones it has
    cells = per_run(totals, site, keys).join(site, [*keys, *CELL], "full_outer")
    # one row per hour in each window: as long as the calendar at most
    series = Window.partitionBy(*keys, "product", "sector")
    owed = _zero("hx") - _zero("inside") if with_exceptions else _zero("hx")
    return cells.select(
        *keys, *CELL,
        _zero("t").alias("t"),
        _zero("inside").alias("inside"),
        _zero("hx").alias("hx"),
        F.when(F.max(F.col("hx").isNotNull()).over(series), owed).otherwise(0.0).alias("d"),
        time.chunk(F.col("hour"), chunk_hours).alias("chunk"),
    )


def _short() -> Column:
    """Does this cell owe more than the market has?"""
    return F.round("t", COMPARE) < F.round("d", COMPARE)


def _kept() -> Column:
    """Share of the market power that remains after the discount."""
    return F.lit(1.0) - F.coalesce(F.try_divide("d", "t"), F.lit(0.0))


def imbalanced_chunks(cells: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """One flag per run and chunk: does any hour owe more than the market has?"""
    return cells.groupBy(*run_keys(cells, by), "chunk").agg(F.bool_or(_short()).alias("imbalanced"))


def factors(cells: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Multiplier of the market power per run, hour, product and sector.

    In a balanced chunk it is what remains after the discount, ``1 - d/t``.  In an
    imbalanced chunk the hourly residual per product is spread over the remaining
    market power of that product as well.

    Both windows share one shuffle by run and chunk; a chunk has as many rows as it
    has hours and sectors, whatever the data.
    """
    keys = run_keys(cells, by)
    chunk = Window.partitionBy(*keys, "chunk")
    product = Window.partitionBy(*keys, "chunk", "hour", "product")
    # the chunk comes first: its shuffle serves the narrower window as well
    cells = cells.withColumns({"_kept": _kept(), "_imbalanced": F.bool_or(_short()).over(chunk)})
    left = F.sum(F.col("t") * F.col("_kept")).over(product)
    had = F.sum(F.col("t") + F.col("inside")).over(product)
    cells = cells.withColumns({"_left": left, "_residual": had - left - F.sum("hx").over(product)})
    # a product that lost all of its power may leave float noise behind; it counts as nothing
    spread = F.when(F.round("_left", COMPARE) == 0, F.lit(0.0)).otherwise(
        F.lit(1.0) + F.try_divide("_residual", "_left")
    )
    return cells.select(
        *keys, *CELL, F.when(F.col("_imbalanced"), F.col("_kept") * spread).otherwise(F.col("_kept")).alias("factor")
    )


def undistributable(cells: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Hours and products with a residual but no market power to carry it (diagnostics)."""
    keys = run_keys(cells, by)
    n1 = F.sum(F.col("t") * _kept())
    products = cells.groupBy(*keys, "chunk", "hour", "product").agg(
        F.round(n1, COMPARE).alias("remaining"),
        F.round(F.sum(F.col("t") + F.col("inside")) - n1 - F.sum("hx"), COMPARE).alias("residual"),
    )
    flagged = products.join(imbalanced_chunks(cells, by), [*keys, "chunk"])
    return flagged.where(F.col("imbalanced") & (F.col("remaining") == 0) & (F.col("residual") != 0))


def net_power(market: DataFrame, simulated: DataFrame, by: Sequence[str]) -> DataFrame:
    """Supply minus demand of both sources per run, hour and node."""
    keys = run_keys(simulated, by)
    net = power.signed(F.col("product"), F.col("mw")).alias("power")
    both = market.select(*keys, "hour", "node", net).unionByName(simulated.select(*keys, "hour", "node", net))
    return both.groupBy(*keys, "hour", "node").agg((F.sum("power") + F.lit(0.0)).alias("power"))


def discount(
    market: DataFrame,
    simulated: DataFrame,
    exceptions: Sequence[str] | str | None = None,
    chunk_hours: int = CHUNK_HOURS,
    by: Sequence[str] = BY,
) -> DataFrame:
    """Net power per hour and node from nodal market curves and nodal simulated curves.

    ``exceptions`` are market nodes that lie in the simulated area.
    """
    nodes = [exceptions] if isinstance(exceptions, str) else list(exceptions or [])
    cells = discounts(market_totals(market, nodes, by), site_totals(simulated, by), bool(nodes), by, chunk_hours)
    outside = market.where(~F.col("node").isin(nodes)) if nodes else market
    share = factors(cells, by)
    on = shared(outside, share, by, *CELL)
    left = outside.join(share, on).withColumn("mw", F.col("mw") * F.col("factor"))
    return net_power(left, simulated, by)


def nodal_power(
    market: DataFrame,
    site_curves: DataFrame,
    categories: DataFrame,
    weights: DataFrame,
    sites: DataFrame,
    exceptions: Sequence[str] | str | None = None,
    carrier: str = "Electricity",
    chunk_hours: int = CHUNK_HOURS,
    station_exceptions: DataFrame | None = None,
    sector_exceptions: DataFrame | None = None,
    by: Sequence[str] = BY,
    limit: DataFrame | None = None,
) -> DataFrame:
    """Raw market and site curves to net power per hour and node.

    Nothing is checked here: nodes in both sources, unknown exceptions and sectors that the market lacks go through.
    ``quality.checked_nodal_power`` checks first and sets bad runs aside.

    Discounting happens on (hour, product, sector) totals, cut to the hours that both
    sources have; the spread over nodes comes last and is summed over products and
    sectors in the same stage.  Both sources are read and summed once: every later
    use starts from the shuffled sums.  ``limit`` are the hours of each run (``_limit``) if
    they are known; else each source is read once more, two columns wide, for its length.
    """
    nodes = [exceptions] if isinstance(exceptions, str) else list(exceptions or [])
    categorised = c.categorise(market, categories, carrier=carrier, by=by)
    lifted = c.lift_to_high_voltage(sites, station_exceptions, by)
    net = c.net_by_sector(c.drop_site(site_curves), lifted, by)
    limit = c.common_length(categorised, net, by=by) if limit is None else limit
    net = c.cut_to(net, limit, by)
    simulated = c.split_products(net)
    if sector_exceptions is not None:
        simulated = c.remap_sectors(simulated, sector_exceptions, by)
    totals = c.cut_to(weighted_totals(categorised, weights, nodes, by), limit, by)
    cells = discounts(totals, site_totals(simulated, by), bool(nodes), by, chunk_hours)
    share = factors(cells, by)
    # what is left per (hour, product, sector), still without nodes; hours that were cut have no factor
    left = categorised.join(share, shared(categorised, share, by, *CELL))
    left = left.withColumn("mw", F.col("mw") * F.col("factor"))
    outside = weights.where(~F.col("node").isin(nodes)) if nodes else weights
    return net_power(c.regionalise(left, outside, by), simulated, by)
