"""Expressions on hour positions (0 is the first hour of a series)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourgrid.fixed import CHUNK_HOURS, PROFILE_START


def profile_from(hour: Column, start: str = PROFILE_START) -> Column:
    """Start of the hour as a zone-less timestamp."""
    zero = F.lit(0)
    return F.to_timestamp_ntz(F.lit(start)) + F.make_dt_interval(zero, hour, zero, F.lit(0.0))


def profile_to(hour: Column, start: str = PROFILE_START) -> Column:
    return profile_from(hour + F.lit(1), start)


def day_of_year(hour: Column) -> Column:
    return (F.floor(hour / F.lit(24)) + F.lit(1)).cast("int")


def hour_of_day(hour: Column) -> Column:
    """1 to 24."""
    return (hour % F.lit(24) + F.lit(1)).cast("int")


def chunk(hour: Column, hours: int = CHUNK_HOURS) -> Column:
    """Block of hours that is balanced as one."""
    return F.floor(hour / F.lit(hours)).cast("int")
