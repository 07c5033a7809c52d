"""Route simulated asset series to carriers and name their sites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid import fixed
from hourgrid.functions import power, text
from hourgrid.keys import BY, held, run_keys, shared

SERIES = ["member", "assetName", "carrierId"]
# rows of an archive; the limits of align_to_first need both columns, so that they can share the rows' shuffle
ORDER = ["member_pos", "row_idx"]
CARRIER_BITS = {"electricity": 1, "methane": 2, "hydrogen": 4, "co2": 8}


def _has_series(raw: DataFrame) -> DataFrame:
    """Members that lack asset class or name are not series of an asset."""
    return raw.where(F.col("assetName").isNotNull())


def member_facts(raw: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Kind of each member by its first row's asset class, and whether it holds a methane import asset.

    The class is reduced to two flags before the sum, so that the aggregate keeps
    plain numbers and hashes instead of sorting.
    """
    electricity = F.col("assetClass").contains(fixed.ELECTRICITY_CLASS).cast("int")
    gas = F.col("assetClass").contains(fixed.GAS_CLASS).cast("int")
    methane = text.contains_any(F.col("assetName"), fixed.METHANE_ASSETS)
    return (
        _has_series(raw)
        .groupBy(*run_keys(raw, by), "member")
        .agg(
            F.min_by(electricity + 2 * gas, "row_idx").alias("_kind"),
            F.bool_or(methane).alias("has_methane_asset"),
        )
        .where(F.col("_kind").isNotNull())
        .select(
            *run_keys(raw, by), "member",
            (F.col("_kind") % 2 == 1).alias("is_electricity"), (F.col("_kind") >= 2).alias("is_gas"), "has_methane_asset",
        )
    )


def target_carriers() -> Column:
    """Carriers a row goes to, as a sum of ``CARRIER_BITS``; expects the member's facts on the row."""
    electricity, gas = F.col("is_electricity"), F.col("is_gas")
    carrier = lambda codes: text.contains_any(F.col("carrierId"), codes)
    asset = lambda names: text.contains_any(F.col("assetName"), names)
    goes = {
        "electricity": electricity,
        "methane": (gas & carrier(fixed.METHANE_CARRIERS)) | (~gas & asset(fixed.METHANE_ASSETS)),
        "hydrogen": (gas & carrier(fixed.HYDROGEN_CARRIERS))
        | (~gas & ~F.col("has_methane_asset") & asset(fixed.HYDROGEN_ASSETS)),
        "co2": gas & carrier(fixed.CO2_CARRIERS),
    }
    total = F.lit(0)
    for name, rule in goes.items():
        total = total + F.when(rule, F.lit(CARRIER_BITS[name])).otherwise(F.lit(0))
    return total


def targets(raw: DataFrame, by: Sequence[str] = BY, carriers: Sequence[str] = tuple(CARRIER_BITS)) -> DataFrame:
    """Rows that go to any of the carriers, in MW, with their targets as one number.

    The facts of a member are windows over its rows, so that the rows are shuffled once,
    by run and member; what comes later works inside that partitioning.
    """
    keys = [*run_keys(raw, by), "member"]
    member = Window.partitionBy(*keys)
    kind = F.col("assetClass").contains(fixed.ELECTRICITY_CLASS).cast("int") + 2 * F.col("assetClass").contains(fixed.GAS_CLASS).cast("int")
    rows = _has_series(raw).select(
        *keys, "member_pos", "row_idx", "assetName", "carrierId", "sector",
        power.watt_to_megawatt(F.col("allocationPower")).alias("mw"),
        F.first(kind).over(member.orderBy(*ORDER)).alias("_kind"),
        F.max(text.contains_any(F.col("assetName"), fixed.METHANE_ASSETS)).over(member).alias("has_methane_asset"),
    )
    rows = rows.where(F.col("_kind").isNotNull())
    rows = rows.withColumns({"is_electricity": F.col("_kind") % 2 == 1, "is_gas": F.col("_kind") >= 2})
    wanted = sum(CARRIER_BITS[c] for c in carriers)
    rows = rows.withColumn("targets", target_carriers().bitwiseAND(F.lit(wanted)))
    return rows.where(F.col("targets") > 0).drop("_kind", "is_electricity", "is_gas", "has_methane_asset")


def one_row_per_carrier(rows: DataFrame) -> DataFrame:
    others = [c for c in rows.columns if c != "targets"]
    names = F.array_compact(F.array(*[
        F.when(F.col("targets").bitwiseAND(F.lit(bit)) > 0, F.lit(name)) for name, bit in CARRIER_BITS.items()
    ]))
    return rows.select(*others, F.explode(names).alias("carrier"))


def route(raw: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Rows per target carrier in MW; a row may go to several carriers, or to none."""
    return one_row_per_carrier(targets(raw, by))


def number_hours(rows: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Hour of every row, its position inside its own series, and the rows of the series.

    All rows of a series go to the same carriers, so they are numbered before they
    are repeated per carrier.  A series is one asset-year; ``checks.long_series`` reports
    those that are longer than a calendar.
    """
    series = Window.partitionBy(*run_keys(rows, by), *SERIES)
    readings, missing = F.count("mw").over(series), F.count_if(F.col("mw").isNull()).over(series)
    return rows.withColumns({
        "hour": (F.row_number().over(series.orderBy(*ORDER)) - 1).cast("int"),
        "series_rows": readings + missing,
    })


def first_lengths(series: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Rows of the first series of each carrier: that of the first member in the archive, then of the first row."""
    # one number to order by, so that the aggregate hashes
    place = F.col("member_pos").cast("decimal(38,0)") * F.lit(10**18).cast("decimal(19,0)") + F.col("row_idx")
    heads = series.where(F.col("hour") == 0)
    return heads.groupBy(*run_keys(series, by), "carrier").agg(F.min_by("series_rows", place.cast("decimal(38,0)")).alias("_limit"))


def align_to_first(series: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Cut all series of a carrier to the length of its first one; ``series`` are numbered rows per carrier."""
    limits = first_lengths(series, by)
    cut = series.join(limits, shared(series, limits, by, "carrier")).where(F.col("hour") < F.col("_limit"))
    return cut.select(*series.columns)


def longer_than_first(series: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Series that ``align_to_first`` cuts, with the rows they lose."""
    limits = first_lengths(series, by)
    heads = series.where(F.col("hour") == 0).join(limits, shared(series, limits, by, "carrier"))
    lost = (F.col("series_rows") - F.col("_limit")).alias("rows_lost")
    return heads.where(F.col("series_rows") > F.col("_limit")).select(*run_keys(series, by), "carrier", *SERIES, lost)


def latest_names(names: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """One grid name per raw name; a later line of the map wins.

    A map with several carriers counts with its electricity part: all carriers are named by it.
    """
    if "carrier" in names.columns:
        names = names.where(F.col("carrier") == "electricity")
    keys = [*held(names, by), "raw_name"]
    last = names.groupBy(*keys).agg(F.max("row_idx").alias("row_idx"))
    return names.join(last, [*keys, "row_idx"], "left_semi").select(*keys, "grid_name")


def same_names(names: DataFrame, by: Sequence[str] = BY) -> bool:
    """Whether the electricity and the methane part of a name map are equal; a map without carriers is one map for both."""
    if "carrier" not in names.columns:
        return False
    one = lambda c: latest_names(names.where(F.col("carrier") == c).withColumn("carrier", F.lit("electricity")), by)
    electricity, methane = one("electricity"), one("methane")
    apart = electricity.exceptAll(methane).unionByName(methane.exceptAll(electricity))
    return not apart.limit(1).count()


def name_sites(series: DataFrame, names: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Attach grid names; electricity keeps series without one, gas drops them."""
    lookup = latest_names(names, by).withColumnRenamed("raw_name", "asset")
    named = series.join(lookup, shared(series, lookup, by, "asset"), "left").withColumnRenamed("grid_name", "site")
    return named.where(F.col("site").isNotNull() | (F.col("carrier") == "electricity"))


def export_site_curves(
    raw: DataFrame,
    names: DataFrame,
    merge_gas_codes: bool | None = None,
    by: Sequence[str] = BY,
) -> DataFrame:
    """Site curves (carrier, asset, site, hour, mw) of all carriers but CO2.

    Sites of all carriers are named by the electricity map.  Where it equals the methane
    map, gas codes in asset names are unified and equal names summed before naming;
    ``merge_gas_codes`` says so without looking.
    """
    merge = same_names(names, by) if merge_gas_codes is None else merge_gas_codes
    rows = targets(raw, by, ["electricity", "methane", "hydrogen"]).drop("sector")
    series = align_to_first(one_row_per_carrier(number_hours(rows, by)), by)
    asset = text.unify_gas_code(F.col("assetName")) if merge else F.col("assetName")
    keys = run_keys(raw, by)
    curves = series.select(*keys, "carrier", asset.alias("asset"), "hour", "mw")
    if merge:
        curves = curves.groupBy(*keys, "carrier", "asset", "hour").agg(F.sum("mw").alias("mw"))
    return name_sites(curves, names, by).select(*keys, "carrier", "asset", "site", "hour", "mw")


def co2_streams(raw: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """CO2 rows tagged with every stream their asset name mentions."""
    routed = route(raw, by).where(F.col("carrier") == "co2")
    streams = F.array_compact(F.array(*[F.when(F.col("assetName").contains(s), F.lit(s)) for s in fixed.CO2_CARRIERS]))
    return routed.select(*run_keys(raw, by), "member", "row_idx", "assetName", "sector", "mw", F.explode(streams).alias("stream"))
