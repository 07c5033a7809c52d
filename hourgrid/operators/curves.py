"""Market and site curves brought to grid nodes (electricity)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.fixed import HOURS_PER_YEAR, IGNORED_SITE, MV_LIMIT_KV
from hourgrid.functions import power, text
from hourgrid.keys import BY, held, run_keys, shared, sliced_join


def categorise(
    curves: DataFrame,
    categories: DataFrame,
    columns: Sequence[str] = ("product", "sector"),
    carrier: str | None = None,
    by: Sequence[str] = BY,
) -> DataFrame:
    """Sum market curves to any columns of the categorisation."""
    lookup = categories if carrier is None else categories.where(F.col("carrier") == carrier)
    on = shared(curves, lookup, by, "market_key")
    lookup = lookup.select(*on, *columns)
    return (
        curves.join(lookup, on)
        .groupBy(*run_keys(curves, by), "hour", *columns)
        .agg(F.sum("mw").alias("mw"))
    )


def regionalise(categorised: DataFrame, weights: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Spread every sector over the nodes by weight; the join on sector is the fan-out."""
    on = shared(categorised, weights, by, "sector")
    return categorised.join(weights.select(*on, "node", "weight"), on).select(
        *run_keys(categorised, by), "hour", "node", "product", "sector", (F.col("mw") * F.col("weight")).alias("mw")
    )


def regional_market_curves(
    market: DataFrame, categories: DataFrame, weights: DataFrame, carrier: str = "Electricity", by: Sequence[str] = BY
) -> DataFrame:
    """Market curves per hour, node, product and sector."""
    return regionalise(categorise(market, categories, carrier=carrier, by=by), weights, by)


def medium_voltage_sites(sites: DataFrame) -> DataFrame:
    """Sites on substations below the high-voltage level."""
    return sites.where(text.voltage(F.col("substation")) < MV_LIMIT_KV)


def lift_to_high_voltage(sites: DataFrame, exceptions: DataFrame | None = None, by: Sequence[str] = BY) -> DataFrame:
    """Move medium-voltage sites to the high-voltage station of the same name.

    ``exceptions`` (station, lifted_station) renames stations on the way.
    """
    name = text.station(F.col("substation"))
    if exceptions is not None:
        columns = sites.columns
        lookup = exceptions.select(*held(exceptions, by), F.col("station").alias("_station"), "lifted_station")
        staged = sites.withColumn("_station", name)
        sites = staged.join(lookup, shared(staged, lookup, by, "_station"), "left")
        name = F.coalesce("lifted_station", "_station")
    lifted = F.when(
        text.voltage(F.col("substation")) < MV_LIMIT_KV, F.concat(name, F.lit(str(MV_LIMIT_KV)))
    ).otherwise(F.col("substation"))
    sites = sites.withColumn("substation", lifted)
    return sites if exceptions is None else sites.select(*columns)


def net_by_sector(curves: DataFrame, sites: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Signed net power per hour, node and sector."""
    on = shared(curves, sites, by, "site")
    keys = list(dict.fromkeys(run_keys(curves, by) + held(sites, by)))
    lookup = sites.select(*held(sites, by), "site", F.col("substation").alias("node"), "sector")
    return curves.join(lookup, on).groupBy(*keys, "hour", "node", "sector").agg(F.sum("mw").alias("mw"))


def split_products(net: DataFrame) -> DataFrame:
    """One Demand and one Supply row for every net power."""
    mw = F.col("mw")
    parts = F.array(
        F.struct(F.lit("Demand").alias("product"), power.demand(mw).alias("mw")),
        F.struct(F.lit("Supply").alias("product"), power.supply(mw).alias("mw")),
    )
    others = [c for c in net.columns if c != "mw"]
    return net.select(*others, F.explode(parts).alias("_p")).select(*others, "_p.product", "_p.mw")


def remap_sectors(curves: DataFrame, exceptions: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Rename sectors per product (sector -> to_sector); unlisted ones stay, then sum again."""
    on = shared(curves, exceptions, by, "product", "sector")
    renamed = curves.join(exceptions.select(*on, "to_sector"), on, "left").withColumn(
        "sector", F.coalesce("to_sector", "sector")
    )
    keys = [c for c in curves.columns if c != "mw"]
    return renamed.groupBy(*keys).agg(F.sum("mw").alias("mw"))


def nodal_sector_curves(
    curves: DataFrame,
    sites: DataFrame,
    station_exceptions: DataFrame | None = None,
    sector_exceptions: DataFrame | None = None,
    by: Sequence[str] = BY,
) -> DataFrame:
    """Simulated demand and supply per hour, node and sector.

    Sites of one sector on one node are netted before the sign split.
    """
    lifted = lift_to_high_voltage(sites, station_exceptions, by)
    split = split_products(net_by_sector(curves, lifted, by))
    return split if sector_exceptions is None else remap_sectors(split, sector_exceptions, by)


def drop_idle_unknown_sites(curves: DataFrame, sites: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Remove sites that no design knows and that carry no power; other unknown sites stay."""
    on = shared(curves, sites, by, "site")
    unknown = curves.join(sites.select(*on), on, "left_anti")
    keys = run_keys(curves, by) + ["site"]
    idle = unknown.groupBy(*keys).agg(F.sum("mw").alias("_sum"))
    idle = idle.where(F.round(F.coalesce("_sum", F.lit(0.0)), 9) == 0).select(*keys)
    return curves.join(idle, keys, "left_anti")


def drop_site(curves: DataFrame, site: str = IGNORED_SITE) -> DataFrame:
    """Remove one site by name; nameless series stay."""
    return curves.where(~F.col("site").eqNullSafe(F.lit(site)))


def series_lengths(curves: DataFrame, by: Sequence[str] = BY, alias: str = "n_hours") -> DataFrame:
    """Number of hours of each run, from its last hour."""
    return curves.groupBy(*run_keys(curves, by)).agg((F.max("hour") + 1).alias(alias))


def common_length(
    left: DataFrame, right: DataFrame, hours: int = HOURS_PER_YEAR, by: Sequence[str] = BY
) -> DataFrame:
    """Hours of the shorter of two sources per run, ``hours`` at most."""
    on = shared(left, right, by)
    none = F.lit(None).cast("int")
    hours_of_both = left.select(*on, F.col("hour").alias("_left"), none.alias("_right")).unionByName(
        right.select(*on, none.alias("_left"), F.col("hour").alias("_right"))
    )
    ends = hours_of_both.groupBy(*on).agg(F.max("_left").alias("_left"), F.max("_right").alias("_right"))
    # a run that only one source has is left out
    both = ends.where(F.col("_left").isNotNull() & F.col("_right").isNotNull())
    return both.select(*on, F.least(F.col("_left") + 1, F.col("_right") + 1, F.lit(hours)).alias("_limit"))


def cut_to(curves: DataFrame, limit: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Rows before the limit of their run; the rows of one run go to many tasks."""
    joined = sliced_join(curves, limit, shared(curves, limit, by))
    return joined.where(F.col("hour") < F.col("_limit")).select(*curves.columns)


def align_series(
    left: DataFrame, right: DataFrame, hours: int = HOURS_PER_YEAR, by: Sequence[str] = BY
) -> tuple[DataFrame, DataFrame]:
    """Cut two sources to the shorter one, and to ``hours`` at most."""
    limit = common_length(left, right, hours, by)
    return cut_to(left, limit, by), cut_to(right, limit, by)


def demand_supply_wide(curves: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Demand and supply side by side per hour and node."""
    keys = run_keys(curves, by)
    side = lambda p: F.coalesce(F.sum(F.when(F.col("product") == p, F.col("mw"))), F.lit(0.0))
    return curves.groupBy(*keys, "hour", "node").agg(side("Demand").alias("demand"), side("Supply").alias("supply"))


def to_long(wide: DataFrame, ids: Sequence[str], variable: str, value: str = "mw") -> DataFrame:
    """Wide curve frame (one column per series) to long rows."""
    series = [c for c in wide.columns if c not in ids]
    return wide.unpivot(list(ids), series, variable, value)


def to_wide(curves: DataFrame, ids: Sequence[str], variable: str, names: Sequence[str], value: str = "mw") -> DataFrame:
    """Long rows to one column per listed series; used at sinks only."""
    return curves.groupBy(*ids).pivot(variable, list(names)).agg(F.sum(value))
