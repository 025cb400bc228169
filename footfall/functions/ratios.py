"""Ratios whose missing sides stay missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(count: Column | str) -> Column:
    """A count, or NULL where nothing was counted."""
    return F.nullif(F.col(count) if isinstance(count, str) else count, F.lit(0).cast("bigint"))


def ratio(part: Column, whole: Column) -> Column:
    """NULL if either side is, or the divisor is 0; ANSI mode never raises."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def share(part: Column | str, whole: Column | str) -> Column:
    """Ratio of two counts, NULL unless both counted something."""
    return ratio(present(part), present(whole))


def filled_share(part: Column, whole: Column) -> Column:
    """Ratio of two counts: 0 where the numerator is, NULL only where the divisor is 0."""
    return ratio(part, whole)


def zero_as_one(divisor: Column) -> Column:
    return F.when(divisor == 0, F.lit(1)).otherwise(divisor)


def near(a: Column, b: Column, tolerance: float = 1e-6) -> Column:
    """Equal within a tolerance; two NULLs are equal, one NULL is not."""
    close = F.abs(a - b) < tolerance
    return F.coalesce(close, a.isNull() & b.isNull())
