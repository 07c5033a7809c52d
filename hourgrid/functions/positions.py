"""Row positions inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 16


def number_rows(rows: DataFrame, keys: Sequence[str], order: str, alias: str, block: int = BLOCK) -> DataFrame:
    """Number the rows of every group from 0 in the order of an integer column.

    A group is cut into blocks of ``block`` order units.  Rows are numbered inside
    their block and shifted by the rows of the blocks before, so no task sorts a
    whole group; only the block counts of a group meet in one window.
    """
    keys = list(keys)
    cut = rows.withColumn("_block", F.floor(F.col(order) / F.lit(block)))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"_key{i}" for i in range(len(keys))]
    offsets = (
        cut.groupBy(*keys, "_block")
        .agg(F.count("*").alias("_rows"))
        .select(
            *[F.col(c).alias(n) for c, n in zip(keys, names)],
            F.col("_block").alias("_in_block"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        )
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    numbered = cut.withColumn("_pos", F.row_number().over(inside) - 1)
    # null-safe: a group key may be missing
    on = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(keys, names)]
    joined = numbered.join(offsets, on + [F.col("_block") == F.col("_in_block")])
    return joined.select(*rows.columns, (F.col("_pos") + F.col("_offset")).cast("int").alias(alias))
