"""Expressions on names, carriers and substation texts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourgrid.fixed import GAS_CODE_NAME, GAS_CODES

SUBSTATION = r"^([a-zA-Z]*)([0-9]*)(.*)$"


def contains_any(value: Column, needles: Sequence[str]) -> Column:
    """True when the text holds any needle (literal, not a pattern); null counts as no."""
    found = reduce(lambda a, b: a | b, [value.contains(n) for n in needles])
    return F.coalesce(found, F.lit(False))


def unify_gas_code(name: Column, codes: Sequence[str] = GAS_CODES, to: str = GAS_CODE_NAME) -> Column:
    """Replace the first code that occurs in the name, everywhere it occurs."""
    result = name
    for code in reversed(codes):
        result = F.when(name.contains(code), F.replace(name, F.lit(code), F.lit(to))).otherwise(result)
    return result


def station(substation: Column) -> Column:
    return F.regexp_extract(substation, SUBSTATION, 1)


def voltage_text(substation: Column) -> Column:
    return F.regexp_extract(substation, SUBSTATION, 2)


def voltage(substation: Column) -> Column:
    """Voltage in the substation text; null where it is not a number."""
    return voltage_text(substation).try_cast("int")


def remaining(substation: Column) -> Column:
    return F.regexp_extract(substation, SUBSTATION, 3)


def sector_name(sector: Column) -> Column:
    """Sector labels come with underscores where the lookups have blanks."""
    return F.replace(sector, F.lit("_"), F.lit(" "))


def decimal_comma(value: Column) -> Column:
    """Number written with a decimal comma; null where it is no number."""
    return F.replace(F.trim(value), F.lit(","), F.lit(".")).try_cast("double")


def null_if_nan(value: Column) -> Column:
    """Missing readings arrive as NaN; inside the engine they are null."""
    return F.when(~F.isnan(value), value)
