"""Names, Spark callables and oracle SQL of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.plans.views import with_views

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles to a fixed number of decimals, without negative zero, for comparison."""
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*[(F.round(c, digits) + F.lit(0.0)).alias(c) if c in doubles else F.col(c) for c in df.columns])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the domain views by name."""

    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    # views are looked up here, when all modules have defined theirs
    return {name: with_views(sql) for name, sql in _ORACLES.items()}
