"""Overload of grid elements: volume, median, frequency, score and weighted score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.fixed import CONSTANT_WEIGHT, HOURS_PER_YEAR, HYDROGEN_NODES
from hourgrid.functions import power, quantiles
from hourgrid.keys import BY, held, per_run, run_keys, shared
from hourgrid.operators.curves import medium_voltage_sites

RESULT = ["weighFactor", "overloadVolume", "overloadMedian", "overloadFreq", "overloadScore", "overloadCalculated"]


def _scores(elements: DataFrame, stats: DataFrame, on: list[str], how: str, factor: Column, keep: list[str]) -> DataFrame:
    """Attach statistics to elements; what is missing on either side counts as 0."""
    score = F.col("median") * F.col("n") / F.lit(float(HOURS_PER_YEAR))
    zero = lambda col: F.coalesce(col, F.lit(0.0)) + F.lit(0.0)
    return elements.join(stats, on, how).select(
        *keep,
        zero(factor).alias("weighFactor"),
        zero(F.col("total")).alias("overloadVolume"),
        zero(F.col("median")).alias("overloadMedian"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("overloadFreq"),
        zero(score).alias("overloadScore"),
        zero(score * factor).alias("overloadCalculated"),
    )


def line_elements(lines: DataFrame, buses: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Lines with thermal capacity and length as weight."""
    keys = held(lines, by)
    volts = lambda side: buses.select(*held(buses, by), F.col("bus_id").alias(f"{side}_bus"), F.col("vn_kv").alias(f"{side}_kv"))
    source, target = volts("from"), volts("to")
    return (
        lines.join(source, shared(lines, source, by, "from_bus"), "left")
        .join(target, shared(lines, target, by, "to_bus"), "left")
        .select(
            *keys, F.lit("line").alias("element_type"), "element_id", "name",
            power.line_capacity(F.col("from_kv"), F.col("to_kv"), F.col("max_i_ka")).alias("capacity"),
            F.col("length_km").alias("factor"),
        )
    )


def trafo_elements(trafos: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Transformers with rated power and the constant weight."""
    return trafos.select(
        *held(trafos, by), F.lit("trafo").alias("element_type"), "element_id", "name",
        F.col("sn_mva").alias("capacity"), F.lit(CONSTANT_WEIGHT).alias("factor"),
    )


def element_excess(flows: DataFrame, elements: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Hourly excess of every element; rows within the capacity are dropped."""
    on = shared(flows, elements, by, "element_type", "element_id")
    joined = flows.join(elements.select(*on, "capacity"), on)
    keys = list(dict.fromkeys(run_keys(flows, by) + held(elements, by)))
    over = power.excess(F.col("mva"), F.col("capacity"))
    return joined.select(*keys, "element_type", "element_id", "hour", over.alias("excess")).where("excess is not null")


def element_overload(
    flows: DataFrame, elements: DataFrame, by: Sequence[str] = BY, runs: DataFrame | None = None
) -> DataFrame:
    """Score every element; those without overload stay, as zeros.

    ``runs`` lists the runs to score; without it they are found in the flows.

    Statistics are per element id, because names may repeat.  There is one flow per
    element and hour, so a group is as long as the calendar at most.
    """
    keys = list(dict.fromkeys(run_keys(flows, by) + held(elements, by)))
    on = [*keys, "element_type", "element_id"]
    stats = quantiles.bounded_statistics(element_excess(flows, elements, by), on, "excess")
    elements = per_run(elements, flows if runs is None else runs, by)
    keep = [
        *[F.col(k) for k in keys],
        F.col("element_id"),
        F.col("name").alias("elementName"),
        F.col("element_type").alias("elementType"),
        F.coalesce("capacity", F.lit(0.0)).alias("elementCapacity"),
    ]
    return _scores(elements, stats, on, "left", F.col("factor"), keep)


def line_overload(
    flows: DataFrame, lines: DataFrame, buses: DataFrame, by: Sequence[str] = BY, runs: DataFrame | None = None
) -> DataFrame:
    return element_overload(flows.where(F.col("element_type") == "line"), line_elements(lines, buses, by), by, runs)


def trafo_overload(
    flows: DataFrame, trafos: DataFrame, by: Sequence[str] = BY, runs: DataFrame | None = None
) -> DataFrame:
    return element_overload(flows.where(F.col("element_type") == "trafo"), trafo_elements(trafos, by), by, runs)


def network_overload(
    flows: DataFrame,
    lines: DataFrame,
    trafos: DataFrame,
    buses: DataFrame,
    by: Sequence[str] = BY,
    runs: DataFrame | None = None,
) -> DataFrame:
    """Lines and transformers in one pass over the flows."""
    elements = line_elements(lines, buses, by).unionByName(trafo_elements(trafos, by))
    return element_overload(flows, elements, by, runs)


def site_flow(curves: DataFrame, sites: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Net flow per substation and hour of the listed sites."""
    on = shared(curves, sites, by, "site")
    keys = list(dict.fromkeys(run_keys(curves, by) + held(sites, by)))
    lookup = sites.select(*held(sites, by), "site", "substation")
    return curves.join(lookup, on).groupBy(*keys, "hour", "substation").agg(F.sum("mw").alias("mw"))


def mv_substation_flow(curves: DataFrame, sites: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Net flow per medium-voltage substation and hour."""
    return site_flow(curves, medium_voltage_sites(sites), by)


def reduced_capacity(substations: DataFrame, n: int = 0, mode: str = "full") -> DataFrame:
    """Substations with the capacity that is left without ``n`` transformers."""
    left = power.capacity_without(F.col("capacity"), F.col("trafos"), n, mode)
    return substations.withColumn("nx_capacity", left)


def substation_excess(flow: DataFrame, substations: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Hourly signed excess over the reduced capacity; null within it."""
    on = shared(flow, substations, by, "substation")
    joined = flow.join(substations.select(*on, "nx_capacity"), on, "left")
    over = power.signed_excess(F.col("mw"), F.col("nx_capacity"))
    return joined.select(*run_keys(flow, by), "hour", "substation", over.alias("excess"))


def substation_overload(
    flow: DataFrame,
    substations: DataFrame,
    n: int = 0,
    factor: float = CONSTANT_WEIGHT,
    mode: str = "full",
    by: Sequence[str] = BY,
) -> DataFrame:
    """Score every substation; excess is signed, so opposite hours can cancel out.

    Substations without flow and flows without substation both appear, as zeros.
    There is one flow per substation and hour, so a group is as long as the calendar
    at most.
    """
    reduced = reduced_capacity(substations, n, mode)
    keys = run_keys(flow, by)
    on = [*keys, "substation"]
    stats = quantiles.bounded_statistics(substation_excess(flow, reduced, by), on, "excess", keep_empty=True)
    listed = per_run(reduced, flow, by).select(*on, "nx_capacity")
    keep = [
        *[F.col(k) for k in keys],
        F.col("substation").alias("elementName"),
        F.lit("substation").alias("elementType"),
        F.coalesce("nx_capacity", F.lit(0.0)).alias("elementCapacity"),
    ]
    # stations that stay within their capacity come from the statistics as well, with count 0
    return _scores(listed, stats, on, "full_outer", F.lit(factor), keep)


def link_excess(flows: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Excess of every link row over its limit, both signs; nameless links are dropped."""
    over = power.link_excess(F.col("berekening"), F.col("voorwaarde"))
    return flows.where(F.col("naam").isNotNull()).select(*run_keys(flows, by), "naam", over.alias("excess"))


def link_overload(flows: DataFrame, factors: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Score every gas link; links without flow and links without factor appear as zeros.

    Nothing bounds the rows of one link, so the median is the one for groups of any size.
    """
    factors = per_run(factors, flows, by)
    keys = held(factors, by)
    on = [*keys, "naam"]
    stats = quantiles.statistics(link_excess(flows, by), on, "excess")
    named = factors.select(*keys, F.col("name").alias("naam"), "length_km")
    keep = [*[F.col(k) for k in keys], F.col("naam").alias("elementName")]
    return _scores(named, stats, on, "full_outer", F.col("length_km"), keep)


def split_links(factors: DataFrame, nodes: Sequence[str] = HYDROGEN_NODES) -> DataFrame:
    """Tag links as hydrogen (either end) and methane (not both ends); mixed links get both tags."""
    start, end = F.col("from_node").isin(list(nodes)), F.col("to_node").isin(list(nodes))
    tags = F.array_compact(F.array(
        F.when(start | end, F.lit("hydrogen")),
        F.when(~start | ~end, F.lit("methane")),
    ))
    return factors.withColumn("carrier", F.explode(tags))
