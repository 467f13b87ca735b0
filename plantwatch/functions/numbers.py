"""Numeric expressions that stay total under ANSI mode: bad input is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plantwatch.schema import MB_PER_RECORD

# Java reads "1.5d", "2f" and hexadecimal text as numbers; the data's producers do not.
_JAVA_ONLY = r"[0-9.][dDfF]\s*$|[xX]"


def finite(value: Column) -> Column:
    """NaN becomes null, so that comparisons and means treat it as missing."""
    return F.when(~F.isnan(value), value)


def to_number(text: Column) -> Column:
    """Number in a text, null where there is none."""
    return F.when(~text.rlike(_JAVA_ONLY), finite(text.try_cast("double")))


def fill(value: Column, default: Column | float) -> Column:
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """(value - mean) / population std; null for a constant series."""
    return F.try_divide(finite(value) - mean, std)


def guarded_scale(variance: Column) -> Column:
    """Square root of a variance, kept off zero for use as a divisor."""
    return F.sqrt(variance) + F.lit(1e-8)


def at_least_zero(value: Column) -> Column:
    return F.greatest(F.lit(0), value)


def lag_megabytes(lag_records: Column) -> Column:
    return at_least_zero(lag_records) * F.lit(MB_PER_RECORD)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole with 0 where whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def row_mean(columns: list[Column]) -> Column:
    """Mean of the non-null members of one row."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in columns), F.lit(0.0))
    return F.try_divide(total, _present(columns))


def row_sample_variance(columns: list[Column]) -> Column:
    """Sample variance of the non-null members of one row, null below two members."""
    mean = row_mean(columns)
    squares = sum((F.coalesce((c - mean) * (c - mean), F.lit(0.0)) for c in columns), F.lit(0.0))
    return F.when(_present(columns) >= 2, F.try_divide(squares, _present(columns) - 1))


def _present(columns: list[Column]) -> Column:
    return sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
