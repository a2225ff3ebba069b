"""Numbers: NaN handling and sums that do not depend on merge order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_finite(value: Column | str) -> Column:
    """True for a number that is neither NULL, NaN nor infinite."""
    c = _col(value)
    infinity = F.lit(float("inf"))
    return c.isNotNull() & ~F.isnan(c) & (c != infinity) & (c != -infinity)


def nan_to_null(value: Column | str) -> Column:
    """NaN as NULL: one NaN would otherwise poison every average it meets."""
    c = _col(value)
    return F.when(~F.isnan(c), c)


def finite(value: Column | str) -> Column:
    """NaN and infinity as NULL."""
    return F.when(is_finite(value), _col(value))


#: Decimals that sums carry beyond those of the grid, so that a value which has more of
#: them than the grid says is not cut to it.
GUARD = 4


def scaled(value: Column | str, scale: int) -> Column:
    """Fixed-point value as an integer count of its last decimal."""
    return F.rint(_col(value) * float(10**scale)).cast("long")


def steady_total(value: Column | str, decimals: int = 9) -> Column:
    """Sum of free values on decimals, so that it does not depend on merge order."""
    return F.sum(finite(value).cast(f"decimal(28,{decimals})")).cast("double")


def free_total(value: Column | str, scale: int | None = None) -> Column:
    """Sum of values that are no fixed-point values, on a grid whose values may be.

    On a fixed-point grid sums are repeatable everywhere, so these run on nine decimals.
    """
    return F.sum(_col(value)) if scale is None else steady_total(value)


def free_mean(value: Column | str, scale: int | None = None) -> Column:
    """Mean with the sum of ``free_total``."""
    if scale is None:
        return F.avg(_col(value))
    return steady_total(value) / F.count(finite(value))


def total(value: Column | str, scale: int | None = None) -> Column:
    """Sum; exact for fixed-point values when ``scale`` is given."""
    if scale is None:
        return F.sum(_col(value))
    return F.sum(scaled(value, scale + GUARD)) / F.lit(float(10 ** (scale + GUARD)))


def mean(value: Column | str, scale: int | None = None) -> Column:
    """Mean over non-NULL values; exact sum for fixed-point values."""
    if scale is None:
        return F.avg(_col(value))
    return total(value, scale) / F.count(_col(value))


def mean_square(value: Column | str, scale: int | None = None) -> Column:
    """Mean of squares of free values."""
    c = _col(value)
    return free_mean(c * c, scale)
