"""Checked evaluations: offenders of a stage in one table, its bad runs set aside, results of the others.

A run that fails a check is quarantined and the others go on; a faulty lookup that
all runs share stops the batch.  Offenders are worked out once, written to the shared
folder and read from there for every later use.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.fixed import HOURS_PER_YEAR
from hourgrid.keys import BY, held, run_keys, shared
from hourgrid.operators import checks, curves, discount, gas, overload, profiles
from hourgrid.session import scratch_path

# keys of a lookup that all runs share; more than these are no lookup
SHARED_KEYS = 10_000


def _offenders(found: DataFrame, check: str, item: str, by: Sequence[str]) -> DataFrame:
    return found.select(*held(found, by), F.lit(check).alias("check"), F.col(item).cast("string").alias("item"))


def _together(found: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def _written(offenders: DataFrame) -> DataFrame:
    path = scratch_path(offenders.sparkSession, "offenders")
    offenders.write.parquet(path)
    return offenders.sparkSession.read.schema(offenders.schema).parquet(path)


def passed(facts: DataFrame, offenders: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Facts of the runs without offenders; an offender that belongs to no run sets none aside."""
    named = offenders.where(F.col(held(offenders, by)[0]).isNotNull()) if held(offenders, by) else offenders.limit(0)
    return checks.quarantine(facts, named, by) if held(offenders, by) else facts


def _unused(lookup: DataFrame, used: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Keys of a lookup that a run does not use; a lookup without run keys holds for every run."""
    if held(lookup, by):
        return checks.missing_keys(lookup, used, key, by)
    keys = [r[0] for r in lookup.select(key).distinct().limit(SHARED_KEYS + 1).collect()]
    if len(keys) > SHARED_KEYS:
        raise ValueError(f"a lookup of over {SHARED_KEYS} keys needs run keys")
    wanted = F.array(*[F.lit(k) for k in sorted(keys)]).cast("array<string>")
    have = F.collect_set(F.when(F.col(key).isin(keys), F.col(key)))
    per_run = used.groupBy(*run_keys(used, by)).agg(F.array_except(wanted, have).alias("_lost"))
    return per_run.select(*run_keys(used, by), F.explode("_lost").alias(key))


class KeySums(NamedTuple):
    """What a scan of both sources gives per run and key: all that checks need, and how long the series are."""

    used: DataFrame  # run keys, market_key, last hour
    totals: DataFrame  # run keys, site, sum, last hour


def key_sums(market: DataFrame, site_curves: DataFrame, by: Sequence[str] = BY) -> KeySums:
    """One row per run and market key, and per run and site, from one scan of each source; combined before the shuffle."""
    last = F.max("hour").alias("_last")
    used = market.groupBy(*run_keys(market, by), "market_key").agg(last)
    totals = curves.drop_site(site_curves).groupBy(*run_keys(site_curves, by), "site").agg(F.sum("mw").alias("_sum"), last)
    return KeySums(_written(used), _written(totals))


def common_limit(sums: KeySums, categories: DataFrame, sites: DataFrame, carrier: str = "Electricity", by: Sequence[str] = BY) -> DataFrame:
    """Hours that both sources have, by the last hours of the keys that take part; no source is scanned for it."""
    known = categories.where(F.col("carrier") == carrier)
    sold = sums.used.join(known, shared(sums.used, known, by, "market_key"), "left_semi").withColumnRenamed("_last", "hour")
    placed = sums.totals.join(sites, shared(sums.totals, sites, by, "site"), "left_semi").withColumnRenamed("_last", "hour")
    return curves.common_length(sold, placed, by=by)


def electricity_offenders(
    market: DataFrame,
    site_curves: DataFrame,
    categories: DataFrame,
    sites: DataFrame,
    buses: DataFrame | None = None,
    weights: DataFrame | None = None,
    exceptions: Sequence[str] | str | None = None,
    carrier: str = "Electricity",
    station_exceptions: DataFrame | None = None,
    sector_exceptions: DataFrame | None = None,
    by: Sequence[str] = BY,
    sums: KeySums | None = None,
) -> DataFrame:
    """What is wrong per run: run keys, check, item.

    Each source is summed once, to its keys; everything else is worked out on those.  ``sums`` are these, if they are known.
    """
    nodes = [exceptions] if isinstance(exceptions, str) else list(exceptions or [])
    known = categories.where(F.col("carrier") == carrier)
    keys = run_keys(site_curves, by)
    used, totals = (t.drop("_last") for t in sums or key_sums(market, site_curves, by))
    on = shared(totals, sites, by, "site")
    listed = sites.select(*on).distinct()
    strangers = totals.join(listed, on, "left_anti").where(F.round(F.coalesce("_sum", F.lit(0.0)), 9) != 0)
    lifted = curves.lift_to_high_voltage(sites, station_exceptions, by)
    columns = [c for c in ("substation", "sector") if c in sites.columns]
    active = totals.join(lifted.select(*on, *columns), on).select(*keys, *columns)
    found = [
        _offenders(checks.missing_keys(used, known, "market_key", by), "market key without category", "market_key", by),
        _offenders(_unused(known, used, "market_key", by), "category without market key", "market_key", by),
        _offenders(strangers, "curve without site", "site", by),
        _offenders(checks.missing_keys(sites, totals, "site", by), "site without curve", "site", by),
        _offenders(checks.unreadable_voltage(sites, by), "voltage is no number", "substation", by),
        _offenders(_missing_runs(totals, used, by), "run without market curves", "_item", by),
        _offenders(_missing_runs(used, totals, by), "run without site curves", "_item", by),
    ]
    if "sector" in sites.columns and {"product", "sector"} <= set(known.columns):
        sold = used.join(known, shared(used, known, by, "market_key")).select(*held(used, by), "product", "sector").distinct()
        both = F.explode(F.array(F.lit("Demand"), F.lit("Supply"))).alias("product")
        bought = active.select(*keys, "sector", both)
        if sector_exceptions is not None:
            to = shared(bought, sector_exceptions, by, "product", "sector")
            bought = bought.join(sector_exceptions.select(*to, "to_sector"), to, "left")
            bought = bought.withColumn("sector", F.coalesce("to_sector", "sector"))
        lost = checks.sectors_not_in_market(sold, bought, by).withColumn("item", F.concat_ws(" ", "product", "sector"))
        found.append(_offenders(lost, "sector not in market", "item", by))
        if weights is not None:
            bare = checks.sectors_without_weights(sold, weights, by)
            found.append(_offenders(bare, "sector without regional weights", "sector", by))
    if buses is not None:
        found.append(_offenders(checks.unknown_substations(lifted, buses, by), "substation without bus", "substation", by))
    if weights is not None:
        if held(weights, by):
            found.append(_offenders(checks.weight_sums(weights, by), "regional weights do not add up", "sector", by))
        simulated = active.withColumnRenamed("substation", "node")
        found.append(_offenders(checks.overlapping_nodes(weights, simulated, nodes, by), "node in both sources", "node", by))
        if nodes:
            wanted = used.select(*held(used, by)).distinct()
            wanted = wanted.select("*", F.explode(F.array(*[F.lit(n) for n in nodes])).alias("node"))
            found.append(_offenders(checks.missing_keys(wanted, weights, "node", by), "exception node not in market", "node", by))
    return _together(found)


def _missing_runs(runs: DataFrame, other: DataFrame, by: Sequence[str]) -> DataFrame:
    """Runs of one source that the other does not have."""
    on = shared(runs, other, by)
    return runs.select(*on).distinct().join(other.select(*on).distinct(), on, "left_anti").withColumn("_item", F.lit("all hours"))


def check_weights(weights: DataFrame, exceptions: Sequence[str] = (), by: Sequence[str] = BY) -> None:
    """Stop when regional weights that all runs share do not add up, or leave no node to discount."""
    if not held(weights, by):
        checks.require(checks.weight_sums(weights, by), "regional weights do not add up to 1")
    if exceptions and not weights.where(~F.col("node").isin(list(exceptions))).limit(1).count():
        raise checks.CheckFailed("every node is an exception: nothing is left to discount")


def checked_nodal_power(
    market: DataFrame,
    site_curves: DataFrame,
    categories: DataFrame,
    weights: DataFrame,
    sites: DataFrame,
    buses: DataFrame | None = None,
    exceptions: Sequence[str] | str | None = None,
    carrier: str = "Electricity",
    station_exceptions: DataFrame | None = None,
    sector_exceptions: DataFrame | None = None,
    by: Sequence[str] = BY,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Net power of the runs that pass every check, and what is wrong with the others.

    Each source is scanned once for its keys, which the checks and the common length come from, and once for its values.
    """
    nodes = [exceptions] if isinstance(exceptions, str) else list(exceptions or [])
    check_weights(weights, nodes, by)
    lookups = {"carrier": carrier, "station_exceptions": station_exceptions, "sector_exceptions": sector_exceptions, "by": by}
    sums = key_sums(market, site_curves, by)
    bad = _written(electricity_offenders(market, site_curves, categories, sites, buses, weights, nodes, **lookups, sums=sums))
    limit = common_limit(sums, categories, curves.lift_to_high_voltage(sites, station_exceptions, by), carrier, by)
    power = discount.nodal_power(
        passed(market, bad, by), passed(site_curves, bad, by), categories, weights, sites, nodes, **lookups, limit=limit, **options
    )
    return power, bad


def gas_offenders(
    site_curves: DataFrame, sites: DataFrame, market_length: DataFrame, hours: int = HOURS_PER_YEAR, by: Sequence[str] = BY
) -> DataFrame:
    """Series that do not fill the calendar, and carriers whose market has no length."""
    fitted = gas.fitted_length(site_curves, market_length, hours, by)
    keys = run_keys(site_curves, by)
    short = fitted.where(F.col("_to") != F.lit(hours)).withColumn("item", F.concat_ws(" ", "carrier", "_to"))
    found = [_offenders(short, "series length", "item", by)]
    on = shared(fitted, market_length, by, "carrier")
    unknown = fitted.select(*keys, "carrier").join(market_length.select(*on), on, "left_anti")
    found.append(_offenders(unknown, "carrier without market length", "carrier", by))
    listed = gas.clean_sites(sites)
    carriers = fitted.select(*keys, "carrier")
    bare = carriers.join(listed.select(*shared(carriers, listed, by, "carrier")).distinct(), shared(carriers, listed, by, "carrier"), "left_anti")
    found.append(_offenders(bare, "carrier without sites", "carrier", by))
    return _together(found)


def market_lengths(market: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Hours of the gas market curves per run and carrier."""
    return market.groupBy(*run_keys(market, by), "carrier").agg((F.max("hour") + 1).alias("market_hours"))


def checked_gas_input(
    site_curves: DataFrame,
    sites: DataFrame,
    market: DataFrame,
    hours: int = HOURS_PER_YEAR,
    by: Sequence[str] = BY,
) -> tuple[DataFrame, DataFrame]:
    """The gas stage in one call: balanced on the slack sites, fitted to the calendar, folded to nodes.

    ``market`` are the market curves of the gases; only their lengths count.
    """
    lengths = market_lengths(market, by)
    bad = _written(gas_offenders(site_curves, sites, lengths, hours, by))
    balanced = gas.balance_on_slack(passed(site_curves, bad, by), by=[c for c in by if c in site_curves.columns])
    return gas.gas_model_input(balanced, sites, lengths, hours, by=by), bad


def overload_offenders(flows: DataFrame, lines: DataFrame, trafos: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Elements with flow that the network does not have, and the other way round."""
    kind = lambda table, name: table.select(*held(table, by), F.lit(name).alias("element_type"), "element_id")
    apart = checks.element_mismatch(flows, kind(lines, "line").unionByName(kind(trafos, "trafo")), by)
    side = F.when(F.col("in_flow"), F.lit("not in network")).otherwise(F.lit("without flow"))
    return _offenders(apart.withColumn("item", F.concat_ws(" ", "element_type", "element_id", side)), "element mismatch", "item", by)


def checked_network_overload(
    flows: DataFrame, lines: DataFrame, trafos: DataFrame, buses: DataFrame, by: Sequence[str] = BY
) -> tuple[DataFrame, DataFrame]:
    """Overload of the networks whose elements and flows match, and what is wrong with the others."""
    bad = _written(overload_offenders(flows, lines, trafos, by))
    good = lambda table: passed(table, bad, by)
    return overload.network_overload(good(flows), good(lines), good(trafos), buses, by), bad


def profile_offenders(
    merit_order: DataFrame, prices: DataFrame | None = None, hours: int = HOURS_PER_YEAR, by: Sequence[str] = BY
) -> DataFrame:
    """Runs whose market or price curves do not fill the calendar, and runs without prices."""
    length = lambda table, name: _offenders(checks.series_length(table, hours, by), name, "n_hours", by)
    found = [length(merit_order, "series length")]
    if prices is not None:
        found.append(length(prices, "price length"))
        bare = checks.scenarios_without_prices(merit_order, prices, by).withColumn("item", F.lit("price"))
        found.append(_offenders(bare, "run without prices", "item", by))
    return _together(found)


def checked_plant_profiles(
    merit_order: DataFrame,
    classes: DataFrame | None = None,
    prices: DataFrame | None = None,
    hours: int = HOURS_PER_YEAR,
    by: Sequence[str] = BY,
) -> tuple[DataFrame, DataFrame]:
    """Plant profiles, with the price profile if prices are given, of the runs with full calendars."""
    bad = _written(profile_offenders(merit_order, prices, hours, by))
    made = profiles.plant_profiles(passed(merit_order, bad, by), classes, by)
    return made if prices is None else made.unionByName(profiles.price_profile(passed(prices, bad, by), by)), bad
