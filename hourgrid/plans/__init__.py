"""Registered queries: every operator bound to the driver's test tables."""

from __future__ import annotations

from hourgrid.plans import checks, curves, export, gas, io, overload, power, profiles, scenarios, sources
from hourgrid.plans.registry import oracles, queries

__all__ = ["queries", "oracles", "checks", "curves", "export", "gas", "io", "overload", "power", "profiles", "scenarios", "sources"]
