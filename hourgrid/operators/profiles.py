"""Plant profiles and price profiles on the hourly calendar."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid import fixed
from hourgrid.functions import time
from hourgrid.keys import BY, held, run_keys, shared


def lookup_table(spark: SparkSession, mapping: Mapping[str, str], key: str, value: str) -> DataFrame:
    """A small fixed mapping as an inline table, so its size is known to the planner."""
    pairs = F.explode(F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]))
    return spark.range(1).select(pairs.alias(key, value))


def sum_by_class(merit_order: DataFrame, classes: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Hourly sum per plant class; keys without a class are dropped."""
    on = shared(merit_order, classes, by, "market_key")
    return (
        merit_order.join(classes.select(*on, "profile"), on)
        .groupBy(*run_keys(merit_order, by), "profile", "hour")
        .agg(F.sum("mw").alias("mw"))
    )


def normalise(
    series: DataFrame, name: str = "profile", margin: float = fixed.PEAK_MARGIN, idle: float = fixed.IDLE_VALUE,
    by: Sequence[str] = BY,
) -> DataFrame:
    """Share of the series' peak plus margin; an idle hour gets a small value, an idle series null.

    The peak is an aggregate joined back (combined map-side), not a window over the
    whole series.
    """
    keys = [*run_keys(series, by), name]
    peaks = series.groupBy(*keys).agg(F.max("mw").alias("_peak"))
    share = F.try_divide(F.col("mw"), F.col("_peak") * F.lit(margin))
    value = F.when(share == 0, F.lit(idle)).otherwise(share)
    return series.join(peaks, keys).select(*keys, "hour", value.alias("value"))


def plant_profiles(
    merit_order: DataFrame,
    classes: DataFrame | None = None,
    by: Sequence[str] = BY,
) -> DataFrame:
    """Profile elements (from, to, value) per plant class, for all hours there are.

    Whether a run has a full calendar is for ``quality.checked_plant_profiles`` to say.
    """
    if classes is None:
        classes = lookup_table(merit_order.sparkSession, fixed.PLANT_CLASS_OF_KEY, "market_key", "profile")
    shares = normalise(sum_by_class(merit_order, classes, by), by=by)
    return profile_elements(shares, by)


def profile_elements(values: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Hour positions to intervals of one hour."""
    hour = F.col("hour")
    return values.select(
        *run_keys(values, by), "profile", time.profile_from(hour).alias("from_ts"), time.profile_to(hour).alias("to_ts"), "value"
    )


def price_profile(prices: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Hourly prices as profile elements."""
    values = prices.select(
        *run_keys(prices, by), F.lit("ElectricityPriceProfile").alias("profile"), "hour", F.col("price").alias("value")
    )
    return profile_elements(values, by)


def nest_profile(elements: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """One sorted array of intervals per profile; as long as the calendar."""
    element = F.struct("from_ts", "to_ts", "value")
    return elements.groupBy(*held(elements, by), "profile").agg(F.sort_array(F.collect_list(element)).alias("elements"))


def assign_profiles(
    ports: DataFrame,
    class_of_carrier: Mapping[str, str] = fixed.PLANT_CLASS_OF_CARRIER,
    by: Sequence[str] = BY,
) -> DataFrame:
    """Give every plant the profile of its inlet carrier.

    ``ports``: asset_id, asset_pos, port_pos, port_kind (in, out), carrier_id, carrier_name.
    A plant takes part if its first port carries a listed carrier and some port
    carries electricity; its inlet is the last in-port up to the electricity port.
    The first plant of a profile owns it, later ones refer to it.
    """
    keys = run_keys(ports, by)
    asset = [*keys, "asset_id"]
    # carriers as numbers (0: not listed), so that the aggregates hash instead of sorting
    listed = F.array(*[F.lit(c) for c in class_of_carrier])
    coded = ports.select(
        *asset, "asset_pos", "port_pos", "port_kind", "carrier_name",
        F.coalesce(F.array_position(listed, F.col("carrier_id")), F.lit(0)).cast("int").alias("_code"),
    )
    plants = (
        coded.groupBy(*asset)
        .agg(
            F.min("asset_pos").alias("asset_pos"),
            F.min_by("_code", "port_pos").alias("_first"),
            F.min(F.when(F.col("carrier_name") == "Electricity", F.col("port_pos"))).alias("_outlet"),
        )
        .where((F.col("_first") > 0) & F.col("_outlet").isNotNull())
    )
    inlets = (
        coded.where(F.col("port_kind") == "in")
        .join(plants.select(*asset, "_outlet", F.col("asset_pos").alias("_pos")), asset)
        .where(F.col("port_pos") <= F.col("_outlet"))
        .groupBy(*asset)
        .agg(F.max_by("_code", "port_pos").alias("_code"), F.first("_pos").alias("asset_pos"))
        .where(F.col("_code") > 0)
    )
    classes = F.array(*[F.lit(c) for c in class_of_carrier.values()])
    assigned = inlets.select(
        *asset, "asset_pos",
        F.element_at(listed, F.col("_code")).alias("carrier_id"), F.element_at(classes, F.col("_code")).alias("profile"),
    )
    owners = assigned.groupBy(*keys, "profile").agg(F.min("asset_pos").alias("_owner"))
    return assigned.join(owners, [*keys, "profile"]).select(
        *asset, "asset_pos", "carrier_id", "profile",
        F.when(F.col("asset_pos") == F.col("_owner"), F.lit("profile")).otherwise(F.lit("reference")).alias("link"),
    )
