"""Expressions on power, capacity and excess."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourgrid.fixed import WATT_PER_MEGAWATT


def watt_to_megawatt(watt: Column) -> Column:
    return watt / F.lit(float(WATT_PER_MEGAWATT))


def demand(net: Column) -> Column:
    """Positive part of a signed net power; nothing measured counts as 0."""
    return F.greatest(net, F.lit(0.0)) + F.lit(0.0)


def supply(net: Column) -> Column:
    """Negative part of a signed net power, as a positive number."""
    return F.greatest(-net, F.lit(0.0)) + F.lit(0.0)


def signed(product: Column, power: Column) -> Column:
    """Net power is supply minus demand."""
    return F.when(product == "Supply", power).when(product == "Demand", -power).otherwise(F.lit(0.0))


def line_capacity(from_kv: Column, to_kv: Column, max_ka: Column) -> Column:
    """Thermal capacity V * I * sqrt(3); the to-side voltage stands in for a missing from side."""
    return F.coalesce(from_kv, to_kv) * max_ka * F.sqrt(F.lit(3.0))


def capacity_without(capacity: Column, trafos: Column, n: int, mode: str = "full") -> Column:
    """Capacity of a substation with ``n`` transformers out of service.

    ``full`` keeps the whole capacity as long as any transformer is left,
    ``n_minus_x`` takes the lost share off.  No transformers at all gives null.
    """
    if mode == "full":
        left = F.when(trafos - F.lit(n) > 0, trafos).otherwise(F.lit(0))
    elif mode == "n_minus_x":
        left = F.greatest(trafos - F.lit(n), F.lit(0))
    else:
        raise ValueError(f"mode must be 'full' or 'n_minus_x', not {mode!r}")
    return F.try_divide(capacity, trafos.cast("double")) * left


def excess(flow: Column, capacity: Column) -> Column:
    """How far the absolute flow exceeds the capacity; null when it does not."""
    over = F.abs(flow) - capacity
    return F.when(over > 0, over)


def signed_excess(flow: Column, capacity: Column) -> Column:
    """Excess with the sign of the flow direction; null within the capacity."""
    return F.when(flow < -capacity, flow + capacity).when(flow > capacity, flow - capacity)


def link_excess(computed: Column, limit: Column) -> Column:
    """Absolute flow minus absolute limit; both signs are kept."""
    return F.abs(computed) - F.abs(limit)
