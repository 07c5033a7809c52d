"""Run keys: the columns that tell one scenario evaluation from another.

Every fact table carries run keys (scenario, year and, where they apply, plan,
design, network or carrier).  Lookups may carry all, some or none of them; a
join uses the ones both sides hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BY = ("scenario_id", "year")


# columns that tell runs apart wherever they occur
KEY_LIKE = ("scenario_id", "year", "plan", "design", "network_id")


def held(df: DataFrame, by: Sequence[str]) -> list[str]:
    """The run keys that ``df`` carries; a lookup may carry none."""
    return [c for c in by if c in df.columns]


def run_keys(facts: DataFrame, by: Sequence[str]) -> list[str]:
    """The run keys of a fact table, by which it is summed.

    ``by=()`` stands for a single run.  Else a table without any of the keys is refused, and so is one that carries
    another key of runs: its runs would be added up.
    """
    found = held(facts, by)
    other = [c for c in KEY_LIKE if c in facts.columns and c not in by]
    if other or by and not found:
        raise ValueError(f"runs are told apart by {list(by)}, the table has {found + other}")
    return found


def shared(left: DataFrame, right: DataFrame, by: Sequence[str], *columns: str) -> list[str]:
    """Join columns: run keys held by both sides, then the named columns."""
    return [c for c in by if c in left.columns and c in right.columns] + list(columns)


def per_run(lookup: DataFrame, facts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Repeat a lookup for every run in ``facts`` that it applies to.

    The runs come from an aggregate of the facts (combined map-side, one row per
    run).  A lookup with no run key at all cannot be told apart by run without a
    cross product, so it is refused.
    """
    missing = [c for c in by if c not in lookup.columns and c in facts.columns]
    if not missing:
        return lookup
    on = shared(lookup, facts, by)
    if not on:
        raise ValueError(f"lookup must carry at least one of the run keys {list(by)}")
    runs = facts.select(*held(facts, by)).distinct()
    return lookup.join(runs, on)


# parts that the rows of a run are dealt to; a lookup of the runs is repeated as often
SLICES = 64


def sliced_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join facts with a lookup of few rows per run, where a shuffle by the run alone would put a whole run into one task.

    The rows of a run are dealt to SLICES parts by a hash of their other columns, and the lookup is repeated for each part.
    """
    own = [f.name for f in facts.schema.fields if f.name not in on and f.dataType.typeName() not in ("array", "map", "struct", "variant")]
    dealt = facts.withColumn("_slice", F.pmod(F.hash(*own), F.lit(SLICES)) if own else F.lit(0))
    each = lookup.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    return dealt.join(each, [*on, "_slice"], how).drop("_slice")
