"""Data-quality checks.

A check returns the offending rows; an empty result means the data pass.
``require`` turns a check into an error, ``quarantine`` sets the offending runs
aside so that the others go on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.fixed import HOURS_PER_YEAR
from hourgrid.functions import text
from hourgrid.keys import BY, held, shared


class CheckFailed(ValueError):
    """A strict check found offending rows."""


def require(offenders: DataFrame, message: str, show: int = 5) -> None:
    """Raise when the check found anything; only a few rows reach the message."""
    rows = offenders.take(show)
    if rows:
        raise CheckFailed(f"{message}: {[r.asDict() for r in rows]}")


def quarantine(facts: DataFrame, offenders: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Facts of the runs without any offending row."""
    on = shared(facts, offenders, by)
    return facts.join(offenders.select(*on).distinct(), on, "left_anti")


def missing_keys(left: DataFrame, right: DataFrame, key: str, by: Sequence[str] = BY) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not know."""
    on = shared(left, right, by, key)
    wanted = held(left, by) + [key]
    return left.select(*wanted).distinct().join(right.select(*on), on, "left_anti")


def curve_mapping(curves: DataFrame, mapping: DataFrame, key: str, by: Sequence[str] = BY) -> DataFrame:
    """Curve keys without mapping and mapping keys without curve, told apart by ``missing_in``."""
    unmapped = missing_keys(curves, mapping, key, by).withColumn("missing_in", F.lit("mapping"))
    unused = missing_keys(mapping, curves, key, by).withColumn("missing_in", F.lit("curves"))
    return unmapped.unionByName(unused, allowMissingColumns=True)


def sectors_without_weights(categorised: DataFrame, weights: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Sectors of the curves that have no regional weights."""
    return missing_keys(categorised, weights, "sector", by)


def weights_without_sectors(categorised: DataFrame, weights: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Regional weights that no curve uses; a warning only."""
    return missing_keys(weights, categorised, "sector", by)


def weight_sums(weights: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Sectors whose regional weights do not add up to 1 at three decimals."""
    sums = weights.groupBy(*held(weights, by), "sector").agg(F.round(F.sum("weight"), 3).alias("total"))
    return sums.where(F.col("total") != F.lit(1.0))


def element_mismatch(flows: DataFrame, elements: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Elements on one side only: with flow but not in the network, or the other way round."""
    key = ["element_type", "element_id"]
    on = shared(flows, elements, by, *key)
    in_flow = flows.select(*on).distinct().withColumn("in_flow", F.lit(True))
    in_network = elements.select(*on).distinct().withColumn("in_network", F.lit(True))
    return (
        in_flow.join(in_network, on, "full_outer")
        .withColumns({
            "in_flow": F.coalesce("in_flow", F.lit(False)),
            "in_network": F.coalesce("in_network", F.lit(False)),
        })
        .where(~(F.col("in_flow") & F.col("in_network")))
    )


def unknown_substations(sites: DataFrame, buses: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Substations of the sites that the network has no bus for."""
    known = buses.select(*held(buses, by), F.col("short_name").alias("substation"))
    return missing_keys(sites, known, "substation", by)


def unreadable_voltage(sites: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Sites whose substation text holds no voltage."""
    rows = sites.select(*held(sites, by), "site", "substation")
    return rows.where(text.voltage(F.col("substation")).isNull())


def overlapping_nodes(
    market: DataFrame, simulated: DataFrame, exceptions: Sequence[str] = (), by: Sequence[str] = BY
) -> DataFrame:
    """Nodes in both sources that are not declared as exceptions."""
    on = shared(market, simulated, by, "node")
    nodes = simulated.select(*held(simulated, by), "node").distinct()
    both = nodes.join(market.select(*on), on, "left_semi")
    return both.where(~F.col("node").isin(list(exceptions))) if exceptions else both


def unknown_exceptions(market: DataFrame, exceptions: Sequence[str], by: Sequence[str] = BY) -> DataFrame:
    """Exception nodes that a run's market curves do not have.

    A run whose every node is an exception has nothing left to discount; it is
    reported with node null.
    """
    keys = held(market, by)
    listed = list(exceptions)
    seen = [F.max(F.col("node") == F.lit(n)).alias(f"_seen{i}") for i, n in enumerate(listed)]
    others = F.max(~F.col("node").isin(listed)) if listed else F.lit(True)
    per_run = market.groupBy(*keys).agg(*seen, F.coalesce(others, F.lit(False)).alias("_others"))
    lost = [F.when(~F.col(f"_seen{i}"), F.lit(n)) for i, n in enumerate(listed)]
    problems = F.array(
        *[F.struct(p.isNotNull().alias("bad"), p.alias("node")) for p in lost],
        F.struct((~F.col("_others")).alias("bad"), F.lit(None).cast("string").alias("node")),
    )
    return per_run.select(*keys, F.explode(problems).alias("_p")).where("_p.bad").select(*keys, "_p.node")


def hourly_totals(market: DataFrame, simulated: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Market and simulated totals per hour and product, with a flag where the market is smaller.

    Diagnostics only: a run that fails goes on and is balanced over product groups.
    """
    keys = held(market, by)
    m = market.groupBy(*keys, "hour", "product").agg(F.sum("mw").alias("market_mw"))
    s = simulated.groupBy(*held(simulated, by), "hour", "product").agg(F.sum("mw").alias("simulated_mw"))
    joined = m.join(s, shared(m, s, by, "hour", "product"))
    return joined.withColumn("discountable", F.round(F.col("market_mw") - F.col("simulated_mw"), 9) >= 0)


def sectors_not_in_market(market: DataFrame, simulated: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """(product, sector) pairs of the simulated curves that the market does not have."""
    on = shared(market, simulated, by, "product", "sector")
    pairs = simulated.select(*held(simulated, by), "product", "sector").distinct()
    return pairs.join(market.select(*on).distinct(), on, "left_anti")


def series_length(curves: DataFrame, hours: int = HOURS_PER_YEAR, by: Sequence[str] = BY) -> DataFrame:
    """Runs whose series has another number of hours."""
    keys = held(curves, by)
    # distinct hours first, so that a run is counted from its calendar and not from its rows
    lengths = curves.select(*keys, "hour").distinct().groupBy(*keys).agg(F.count("*").alias("n_hours"))
    return lengths.where(F.col("n_hours") != F.lit(hours))


def long_series(raw: DataFrame, hours: int = HOURS_PER_YEAR, by: Sequence[str] = BY) -> DataFrame:
    """Series of raw members with more rows than the calendar has hours."""
    keys = [*held(raw, by), "member", "assetName", "carrierId"]
    return raw.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > hours)


def unreadable_numbers(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither empty nor a number."""
    text_ = F.trim(F.col(column))
    return rows.where((text_ != "") & (F.lower(text_) != "nan") & text_.try_cast("double").isNull())


def scenarios_without_prices(scenarios: DataFrame, prices: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Scenarios without a price curve."""
    on = shared(scenarios, prices, by)
    return scenarios.select(*on).distinct().join(prices.select(*on), on, "left_anti")


def duplicate_site_hours(curves: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Site series that hold an hour more than once."""
    keys = [*held(curves, by), *[c for c in ("carrier", "site", "hour") if c in curves.columns]]
    return curves.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
