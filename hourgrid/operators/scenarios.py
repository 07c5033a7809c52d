"""Scenario records: selection, marking, fan-out over plans, state tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_group(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of every group in a stated order; combined map-side, no window."""
    others = [c for c in rows.columns if c != key]
    first = rows.groupBy(key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_r"))
    return first.select(*[F.col(key) if c == key else F.col(f"_r.{c}").alias(c) for c in rows.columns])


def next_scenarios(
    state: DataFrame, in_state: str, n: int, key: str = "scenarioUuid", order: Sequence[str] = ("scenarioId",)
) -> DataFrame:
    """Up to ``n`` scenarios in a state, one row per key, smallest key first."""
    waiting = state.where(F.col("calculationState") == in_state)
    return first_per_group(waiting, key, order).orderBy(key).limit(n)


def admission(requests_per_minute: int) -> int:
    """Scenarios started per tick."""
    return round(requests_per_minute / 6)


def update_by_key(
    table: DataFrame, updates: DataFrame, key: Sequence[str], columns: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """Overwrite columns of the rows whose key occurs in ``updates``; no rows are added.

    With several updates per key the last in ``order`` wins; without an order they are refused.
    """
    changes = _last(updates, key, columns, order)
    joined = table.join(changes, list(key), "left")
    new = {c: F.when(F.col("_hit"), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns}
    return joined.select(*[new.get(c, F.col(c)) for c in table.columns])


def mark(table: DataFrame, chosen: DataFrame, state: str, key: str = "scenarioUuid") -> DataFrame:
    """Set the state of every row whose key was chosen."""
    updates = chosen.select(key).distinct().withColumn("calculationState", F.lit(state))
    return update_by_key(table, updates, [key], ["calculationState"])


def _position(order: Sequence[str] | None) -> Column:
    return F.struct(*order) if order else F.lit(0)


def _told_apart(picked: Column, order: Sequence[str] | None) -> Column:
    """Without an order a key may have one update only; a second one is an error."""
    if order:
        return picked
    return F.when(F.count(F.lit(1)) == 1, picked).otherwise(F.raise_error(F.lit("several updates of one key need an order")))


def _last(updates: DataFrame, key: Sequence[str], columns: Sequence[str], order: Sequence[str] | None) -> DataFrame:
    return (
        updates.groupBy(*key)
        .agg(_told_apart(F.max_by(F.struct(*columns), _position(order)), order).alias("_new"))
        .withColumn("_hit", F.lit(True))
    )


def upsert(
    table: DataFrame,
    updates: DataFrame,
    key: Sequence[str],
    overwrite: Sequence[str],
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Insert new keys; of known keys overwrite the listed columns only.

    Several updates of one key act in ``order``: the first inserts, the last sets
    the overwritten columns.  Without an order they are refused.
    """
    key = list(key)
    kept = [c for c in table.columns if c not in key and c not in overwrite]
    aggregates = [_told_apart(F.max_by(F.struct(*overwrite), _position(order)), order).alias("_new")]
    if kept:
        have = [c for c in kept if c in updates.columns]
        if have:
            aggregates.append(F.min_by(F.struct(*have), _position(order)).alias("_ins"))
    changes = updates.groupBy(*key).agg(*aggregates).withColumn("_hit", F.lit(True))
    known = table.withColumn("_known", F.lit(True))
    joined = known.join(changes, key, "full_outer")

    def column(c: str) -> Column:
        if c in key:
            return F.col(c)
        if c in overwrite:
            return F.when(F.col("_hit"), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
        if c in updates.columns:
            return F.when(F.col("_known"), F.col(c)).otherwise(F.col(f"_ins.{c}")).alias(c)
        return F.col(c)

    return joined.select(*[column(c) for c in table.columns])


def plan_map_long(wide: DataFrame, plan: str = "index") -> DataFrame:
    """One column per year to rows (plan, year, network_id)."""
    years = [c for c in wide.columns if c != plan]
    return wide.unpivot([plan], years, "year", "network_id").withColumnRenamed(plan, "plan")


def fan_out(scenarios: DataFrame, plans: DataFrame, plan_field: str = "investmentPath") -> DataFrame:
    """One record per scenario and plan of its year, with plan and network added."""
    lookup = plans.select(
        F.col("year").cast("string").alias("_year"), F.col("plan").alias(plan_field), F.col("network_id").alias("networkId")
    )
    joined = scenarios.join(lookup, F.col("scenarioYear").cast("string") == F.col("_year"))
    others = [c for c in scenarios.columns if c not in (plan_field, "networkId")]
    return joined.select(*[scenarios[c] for c in others], lookup["networkId"], lookup[plan_field])


def evaluate_once(assigned: DataFrame, evaluate: Callable[[DataFrame], DataFrame], run: Sequence[str]) -> DataFrame:
    """Results for every row of ``assigned``, worked out once for all rows that share a run.

    ``assigned`` says which run each plan and year uses: the columns ``run``, as scenario and network, and those that merely
    name the use.  ``evaluate`` gets the distinct runs and returns results that carry the columns ``run``; facts are thus
    aggregated once per run however many plans are built on it, and only results, never facts, are repeated per plan.
    """
    run = list(run)
    uses = [c for c in assigned.columns if c not in run]
    results = evaluate(assigned.select(*run).distinct())
    clash = sorted(set(uses) & set(results.columns))
    if clash:
        raise ValueError(f"results have columns of the assignment: {clash}")
    return assigned.join(results, run).select(*uses, *results.columns)


def plans_using_network(plans: DataFrame, pattern: str) -> DataFrame:
    """Plans with a matching network in any year."""
    return plans.where(F.col("network_id").rlike(pattern)).select("plan").distinct()


def messages(records: DataFrame) -> DataFrame:
    """Every record as one JSON text."""
    return records.select(F.to_json(F.struct(*records.columns)).alias("body"))


def path_keys(paths: DataFrame, column: str, fields: Mapping[str, int], sep: str = "/") -> DataFrame:
    """Parts of a path as columns; negative positions count from the end."""
    parts = F.split(F.col(column), sep)
    return paths.withColumns({name: F.try_element_at(parts, F.lit(pos)) for name, pos in fields.items()})


def model_and_network(paths: DataFrame, folder: str) -> DataFrame:
    """Folder name ``model_network`` split at the underscore."""
    parts = F.split(F.col(folder), "_")
    return paths.withColumns({
        "investmentModel": F.try_element_at(parts, F.lit(1)),
        "networkId": F.try_element_at(parts, F.lit(2)),
    })


def network_assignment(paths: DataFrame, folder: str, series: str) -> DataFrame:
    """Plan label and series name of each network folder."""
    label = F.concat(F.lit("NETWERK"), F.try_element_at(F.split(F.col(folder), "_"), F.lit(2)))
    return paths.select(folder, label.alias("investeringsplan"), F.lit(series).alias("etmreeks"))


def result_path(root: Column, *parts: str | Column) -> Column:
    """Result location below a scenario folder; one function for every stage."""
    tail = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("/", F.rtrim(root, F.lit("/")), *tail)
