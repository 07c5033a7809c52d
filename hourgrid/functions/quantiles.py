"""Exact medians.

``bounded_statistics`` is for groups whose size the calendar bounds: one row per
element and hour.  ``statistics`` makes no such assumption; a single group may
hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.session import scratch_path

# rows of a bracket that are ranked at once, and parts a larger one is counted into
BRACKET_ROWS = 10_000
BUCKETS = 1024
# approximate percentiles that limit a bracket from its second round on, and the rows that one of them may be off: a share
# of 1 / ACCURACY, far below the distance of two of them
CUTS = 256
ACCURACY = 10_000


def bounded_statistics(rows: DataFrame, keys: Sequence[str], value: str, keep_empty: bool = False) -> DataFrame:
    """Median, count and sum per group of at most one row per hour; nulls count as nothing.

    A group of nulls only is left out, or with ``keep_empty`` has count 0, no median and no sum.
    """
    v = F.col(value)
    valid = rows if keep_empty else rows.where(v.isNotNull())
    return (
        valid.groupBy(*keys)
        .agg(F.median(v).alias("median"), F.count(v).alias("n"), F.sum(v).alias("total"))
    )


def statistics(rows: DataFrame, keys: Sequence[str], value: str, bound: int = BRACKET_ROWS) -> DataFrame:
    """Exact median, count and sum per group of any size; values are finite, nulls count as nothing.

    The median of a group lies in a bracket, at first from its smallest to its largest
    value.  While a bracket holds more than ``bound`` rows, its rows are counted into
    BUCKETS parts and it shrinks to the part of the middle ranks: a count that is combined
    before the shuffle, one row per group and part after it.  In the first round the parts
    are of equal width.  Where that does not do, as values lie over many magnitudes, later
    rounds divide what lies between two approximate percentiles around the middle rank, and
    count the rest as two parts: whatever the values, a round leaves 3 / CUTS of the rows of
    its bracket at most.  The counts are exact, so the percentiles need not be.  Then the
    rows of the bracket, ``bound`` at most, are ranked.

    No window holds more than BUCKETS or ``bound`` rows, whatever the group.  The state of
    a round, one row per group, is written to the shared folder; the first round reads the
    rows once more, a later one twice.
    """
    keys = list(keys)
    slim = rows.select(*keys, F.col(value).cast("double").alias("_v"))
    n = F.count("_v")
    state = _written(slim.groupBy(*keys).agg(
        n.alias("n"), F.sum("_v").alias("total"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
        F.lit(0).cast("long").alias("_below"), n.alias("_inside"), F.lit(None).cast("double").alias("median"),
    ))
    wide = F.col("median").isNull() & (F.col("_inside") > bound) & (F.col("_lo") < F.col("_hi"))
    first = True
    while state.where(wide).limit(1).count():
        limits = state.where(wide).withColumns({"_from": F.col("_lo"), "_to": F.col("_hi")}) if first else _written(_limited(slim, state.where(wide), keys))
        narrow, first = _narrowed(slim, limits, keys), False
        state = _written(state.where(~F.coalesce(wide, F.lit(False))).unionByName(narrow))
    one = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo"))
    state = state.withColumn("median", F.coalesce("median", one))
    ranked = _ranked(slim, state.where(F.col("median").isNull() & (F.col("n") > 0)), keys)
    result = state.join(ranked, keys, "left")
    return result.select(*keys, "n", "total", F.coalesce("median", "_median").alias("median"))


def _written(state: DataFrame) -> DataFrame:
    path = scratch_path(state.sparkSession, "median")
    state.write.parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def _ranks() -> tuple[Column, Column]:
    """The middle ranks, counted from 0 at the bracket's lower end."""
    return F.floor((F.col("n") - 1) / 2) - F.col("_below"), F.floor(F.col("n") / 2) - F.col("_below")


def _inside(slim: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    limits = [c for c in ("_from", "_to") if c in state.columns]
    return slim.join(state.select(*keys, "_lo", "_hi", *limits), keys).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _limited(slim: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The state with ``_from`` and ``_to``, approximate percentiles of a bracket's rows below and above the middle ranks."""
    share = [k / CUTS for k in range(CUTS + 1)]
    cuts = _inside(slim, state, keys).groupBy(*keys).agg(F.percentile_approx("_v", share, ACCURACY).alias("_cuts"))
    low, _ = _ranks()
    k = F.floor(low * CUTS / F.col("_inside")).cast("int")
    below, above = F.greatest(k - 1, F.lit(0)), F.least(k + 2, F.lit(CUTS))
    return state.join(cuts, keys).select(*state.columns, F.get("_cuts", below).alias("_from"), F.get("_cuts", above).alias("_to"))


def _narrowed(slim: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The state after one round: brackets shrunk to a part, or medians that lie between two parts.

    The first and the last part hold what lies outside ``_from`` and ``_to``, the others are of equal width.
    """
    inner = BUCKETS - 2
    v, low, high = F.col("_v") / F.lit(inner), F.col("_from") / F.lit(inner), F.col("_to") / F.lit(inner)  # so that no difference overflows
    part = (
        F.when(F.col("_v") < F.col("_from"), 0).when(F.col("_v") > F.col("_to"), BUCKETS - 1).when(F.col("_from") == F.col("_to"), 1)
        .otherwise(1 + F.least(F.floor((v - low) / (high - low) * F.lit(inner)), F.lit(inner - 1)))
    )
    parts = _inside(slim, state, keys).groupBy(*keys, part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_first"), F.max("_v").alias("_last")
    )
    running = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("_end", F.sum("_c").over(running)).join(state, keys)
    low, high = _ranks()
    holds = lambda rank: (F.col("_end") - F.col("_c") <= rank) & (rank < F.col("_end"))
    middle = parts.where(holds(low) | holds(high)).groupBy(*keys).agg(
        F.first("n").alias("n"), F.first("total").alias("total"),
        F.count(F.lit(1)).alias("_parts"), F.min("_first").alias("_first"), F.min("_last").alias("_low_end"),
        F.max("_first").alias("_high_start"), F.max("_last").alias("_last"),
        F.min(F.col("_end") - F.col("_c")).alias("_before"), F.sum("_c").alias("_c"), F.first("_below").alias("_below"),
    )
    # two parts: the lower middle rank is the last of the one, the upper the first of the other
    return middle.select(
        *keys, "n", "total", F.col("_first").alias("_lo"), F.col("_last").alias("_hi"),
        (F.col("_below") + F.col("_before")).alias("_below"), F.col("_c").alias("_inside"),
        F.when(F.col("_parts") == 2, F.col("_low_end") / 2 + F.col("_high_start") / 2).alias("median"),
    )


def _ranked(slim: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Medians of the groups whose brackets are small enough to rank."""
    distinct = _inside(slim, state, keys).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = distinct.withColumn("_end", F.sum("_c").over(running)).join(state.select(*keys, "n", "_below"), keys)
    low, high = _ranks()
    start = F.col("_end") - F.col("_c")
    middle = ((start <= low) & (low < F.col("_end"))) | ((start <= high) & (high < F.col("_end")))
    return placed.where(middle).groupBy(*keys).agg((F.min("_v") / 2 + F.max("_v") / 2).alias("_median"))
