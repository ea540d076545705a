"""Numeric clean-up and bounds as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_or(value: Column, default: int = 0) -> Column:
    """Whole number in the text or column, else the default."""
    return F.coalesce(F.trim(value.cast("string")).try_cast("bigint"), F.lit(default).cast("bigint"))


def loose_double(value: Column) -> Column:
    """Number written with thousands commas, a percent or a plus sign; unreadable is 0."""
    plain = F.trim(F.regexp_replace(value.cast("string"), "[,%+]", ""))
    number = plain.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), F.lit(0.0)).otherwise(number)


def loose_flag(value: Column) -> Column:
    """Whole number of a flag column; unreadable is 0."""
    number = F.trim(value.cast("string")).try_cast("double")
    kept = F.when(number.isNull() | F.isnan(number), F.lit(0.0)).otherwise(number)
    return F.when(kept >= 0, F.floor(kept)).otherwise(F.ceil(kept)).cast("int")


def finite(value: Column) -> Column:
    """The value as a double, with NaN and the infinities turned to null."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))
