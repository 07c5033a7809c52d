"""Gas curves: hourly balance, calendar length, balance nodes and node power."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid import fixed
from hourgrid.functions import power, time
from hourgrid.keys import BY, held, run_keys, shared, sliced_join


def _by_carrier(carrier_values: Mapping[str, str]):
    """CASE over the carriers of a small fixed mapping."""
    expr = None
    for carrier, value in carrier_values.items():
        hit = F.col("carrier") == carrier
        expr = F.when(hit, F.lit(value)) if expr is None else expr.when(hit, F.lit(value))
    return expr


def hourly_balance(curves: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Sum over all sites per carrier and hour."""
    return curves.groupBy(*run_keys(curves, by), "carrier", "hour").agg(F.sum("mw").alias("residual"))


def balance_on_slack(
    curves: DataFrame, slack: Mapping[str, tuple[str, str]] = fixed.SLACK_SITES, by: Sequence[str] = BY
) -> DataFrame:
    """Make every hour sum to 0: surplus leaves on the export site, shortage comes from the import site.

    One sum per run, carrier and hour holds the balance and what the two slack sites
    carry; their corrected rows are made from it, all other rows stay where they are.
    """
    keys = [*run_keys(curves, by), "carrier", "hour"]
    out_site = _by_carrier({k: v[0] for k, v in slack.items()})
    in_site = _by_carrier({k: v[1] for k, v in slack.items()})
    is_slack = F.coalesce((F.col("site") == out_site) | (F.col("site") == in_site), F.lit(False))
    on_site = lambda site: F.sum(F.when(F.col("site") == site, F.col("mw")))
    hours = (
        curves.where(F.col("carrier").isin(list(slack)))
        .groupBy(*keys)
        .agg(F.sum("mw").alias("_r"), on_site(out_site).alias("_out"), on_site(in_site).alias("_in"))
    )
    r, zero = F.coalesce("_r", F.lit(0.0)), F.lit(0.0)
    rows = F.array(
        F.struct(out_site.alias("site"), (F.coalesce("_out", zero) - F.least(r, zero)).alias("mw")),
        F.struct(in_site.alias("site"), (F.coalesce("_in", zero) - F.greatest(r, zero)).alias("mw")),
    )
    corrected = hours.select(*keys, F.explode(rows).alias("_s")).select(*keys, "_s.site", "_s.mw")
    return curves.where(~is_slack).select(*keys, "site", "mw").unionByName(corrected)


def clean_sites(sites: DataFrame) -> DataFrame:
    """Sites without any null."""
    return sites.na.drop()


def fitted_length(
    curves: DataFrame, market_length: DataFrame, hours: int = fixed.HOURS_PER_YEAR, by: Sequence[str] = BY
) -> DataFrame:
    """Hours per run and carrier before (``_n``) and after (``_to``) fitting the calendar.

    ``market_length`` holds ``market_hours`` per run and carrier.
    """
    keys = [*run_keys(curves, by), "carrier"]
    lengths = curves.where(F.col("hour") < hours).groupBy(*keys).agg((F.max("hour") + 1).alias("_n"))
    on = shared(lengths, market_length, by, "carrier")
    joined = lengths.join(market_length.select(*on, "market_hours"), on, "left")
    padded = F.when(F.col("_n") < F.col("market_hours"), F.lit(hours)).otherwise(F.col("_n"))
    return joined.select(*keys, "_n", padded.alias("_to"))


def fit_calendar(
    curves: DataFrame, market_length: DataFrame, hours: int = fixed.HOURS_PER_YEAR, by: Sequence[str] = BY
) -> DataFrame:
    """Cut at ``hours``; a series shorter than the market's is padded with its last row.

    The rows of the last hour are repeated where they are.  Where Spark does not broadcast
    the lengths, the rows of one run and carrier go to many tasks.
    """
    keys = [*run_keys(curves, by), "carrier"]
    lengths = fitted_length(curves, market_length, hours, by)
    last = (F.col("hour") == F.col("_n") - 1) & (F.col("_to") > F.col("_n"))
    spread = F.when(last, F.sequence(F.col("hour"), F.col("_to") - 1)).otherwise(F.array("hour"))
    cut = curves.where(F.col("hour") < hours)
    return sliced_join(cut, lengths, keys).select(*keys, "site", F.explode(spread).alias("hour"), "mw")


def site_power(curves: DataFrame, sites: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Net power per hour and node of the listed sites."""
    on = shared(curves, sites, by, "carrier", "site")
    keys = list(dict.fromkeys(run_keys(curves, by) + held(sites, by)))
    lookup = sites.select(*held(sites, by), "carrier", "site", F.col("substation").alias("node"))
    return curves.join(lookup, on).groupBy(*keys, "carrier", "hour", "node").agg(F.sum("mw").alias("mw"))


def fold_balance_sites(
    curves: DataFrame,
    sites: DataFrame,
    lengths: DataFrame,
    nodes: Mapping[str, str] = fixed.BALANCE_NODES,
    by: Sequence[str] = BY,
) -> DataFrame:
    """Net power per hour and node; each carrier's balance node has a row in every hour.

    Sites that no design lists are left out, sites on the balance node share it.
    ``lengths`` gives the hours (``_to``) per run and carrier.
    """
    on = shared(curves, sites, by, "carrier", "site")
    keys = list(dict.fromkeys(run_keys(curves, by) + held(sites, by)))
    lookup = sites.select(*held(sites, by), "carrier", "site", F.col("substation").alias("node"))
    listed = curves.join(lookup, on).select(*keys, "carrier", "hour", "node", "mw")
    networks = sites.select(*held(sites, by), "carrier").distinct()
    calendar = lengths.join(networks, shared(lengths, networks, by, "carrier"))
    # not a filter: it would reach the lengths and keep their shuffle from being shared
    hours = F.when(F.col("carrier").isin(list(nodes)), F.sequence(F.lit(0), F.col("_to") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    empty = calendar.select(
        *keys, "carrier", F.explode(hours).alias("hour"), _by_carrier(nodes).alias("node"), F.lit(0.0).alias("mw")
    )
    # the zero rows join before the sum, so there is one shuffle
    return listed.unionByName(empty).groupBy(*keys, "carrier", "hour", "node").agg(F.sum("mw").alias("mw"))


def demand_supply(nodal: DataFrame) -> DataFrame:
    """Demand and supply side by side."""
    mw = F.col("mw")
    others = [c for c in nodal.columns if c != "mw"]
    return nodal.select(*others, power.demand(mw).alias("demand"), power.supply(mw).alias("supply"))


def node_power(nodal: DataFrame) -> DataFrame:
    """Supply minus demand."""
    split = demand_supply(nodal)
    others = [c for c in nodal.columns if c != "mw"]
    return split.select(*others, (F.col("supply") - F.col("demand") + F.lit(0.0)).alias("power"))


def nodal_power_gas(curves: DataFrame, sites: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Net power per carrier, hour and node."""
    return node_power(site_power(curves, sites, by))


def time_keys(curves: DataFrame) -> DataFrame:
    """Hour position to day of the year and hour of the day (1 to 24)."""
    return curves.withColumns({"dag": time.day_of_year(F.col("hour")), "uur": time.hour_of_day(F.col("hour"))})


def gas_model_input(
    curves: DataFrame,
    sites: DataFrame,
    market_length: DataFrame,
    hours: int = fixed.HOURS_PER_YEAR,
    nodes: Mapping[str, str] = fixed.BALANCE_NODES,
    by: Sequence[str] = BY,
) -> DataFrame:
    """Node power of both gases on a full calendar, long, keyed by day and hour."""
    fitted = fit_calendar(curves, market_length, hours, by)
    lengths = fitted_length(curves, market_length, hours, by)
    folded = fold_balance_sites(fitted, clean_sites(sites), lengths, nodes, by)
    return time_keys(node_power(folded)).drop("hour")
