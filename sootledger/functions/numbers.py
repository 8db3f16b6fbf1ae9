"""Number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sootledger import domain


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Text to double, NULL when it is not a number."""
    return _col(c).try_cast("double")


def half_even(c: Column | str, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back: the array-library rounding."""
    power = F.lit(float(10**digits))
    return F.rint(_col(c) * power) / power


def to_tonnes(kg: Column | str) -> Column:
    return _col(kg) / F.lit(domain.KG_PER_TONNE)


def tonnes_or_zero(kg: Column | str) -> Column:
    return F.coalesce(to_number(kg), F.lit(0.0)) / F.lit(domain.KG_PER_TONNE)


def thousands(c: Column | str, digits: int = 2) -> Column:
    """Text such as 1,234.56."""
    return F.format_number(_col(c), digits)
