"""Number columns: units, ratios, lenient casts, histogram bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def runtime_minutes(value: Column, unit: Column) -> Column:
    """Whole minutes; seconds are divided by 60 and cut, any other unit is taken as minutes."""
    return F.when(unit == "seconds", (value / 60).cast("int")).otherwise(value.cast("int"))


def seconds(milliseconds: Column) -> Column:
    return (milliseconds / 1000).cast("double")


def whole_hours(total_seconds: Column) -> Column:
    return (total_seconds / 3600).cast("bigint")


def number_or_null(text: Column) -> Column:
    return text.try_cast("double")


def bin_number(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin 1..bins of ``value``; the top value falls in the last bin, equal bounds give bin 1.

    Clamped at both ends, as bounds summed in another order may differ in the last digit.
    """
    bucket = F.greatest(F.least(F.width_bucket(value, low, high, F.lit(bins)), F.lit(bins)), F.lit(1))
    return F.when(low == high, F.lit(1)).otherwise(bucket).cast("int")
