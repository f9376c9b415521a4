"""Arithmetic whose result must not depend on partitioning or on the engine.

Everything here is built from Spark's own expressions, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

COUNT = DecimalType(19, 0)
# A sum of scores or rates; dividing it by a COUNT keeps 22 fraction digits.
TOTAL = DecimalType(20, 4)


def round_half_away(col: Column, digits: int) -> Column:
    """Round a double by scaling it, the way C ``round`` does.

    Spark's own ``round(double, n)`` works on the shortest decimal form, so it
    gives 1.01 for 1.005 where scaling gives 1.0.
    """
    factor = 10.0**digits
    return F.round(col * F.lit(factor), 0) / F.lit(factor)


def round_half_even(col: Column, digits: int) -> Column:
    """Round a double by scaling it and taking the even neighbour on a tie."""
    factor = 10.0**digits
    return F.rint(col * F.lit(factor)) / F.lit(factor)


def exact_ratio(top: Column, bottom: Column, digits: int) -> Column:
    """``top / bottom`` of two whole numbers in decimals; NULL when bottom is 0."""
    zero = F.lit(0).cast(COUNT)
    return F.round(top.cast(COUNT) / F.nullif(bottom.cast(COUNT), zero), digits)


def exact_avg(col: Column, digits: int) -> Column:
    """Average of a decimal column with two to four fraction digits, rounded once.

    ``avg`` on decimals keeps only four digits more than its input, which can
    round twice; sum and count are exact and combine before the shuffle.
    """
    return F.round(F.sum(col).cast(TOTAL) / F.count(col).cast(COUNT), digits)


def exact_mean(col: Column) -> Column:
    """Unrounded average of a decimal column as a double; the sum is exact for any row order."""
    return F.sum(col).cast("double") / F.count(col)


def number_or_null(column: str) -> str:
    """SQL of a cell as a double; text that is no number, and NaN, become NULL."""
    return f"nanvl(try_cast({column} as double), null)"


def text_mean(col: Column) -> Column:
    """Mean of a text or numeric score as a double, cells that are no number left out.

    Report it through ``round_mean``: the last bits of a sum depend on row order.
    """
    return F.avg(F.nanvl(col.try_cast("double"), F.lit(None)))


def round_mean(col: Column, digits: int) -> Column:
    """A mean of doubles rounded half to even; four digits more come first, so that a tie is one for any row order."""
    return round_half_even(round_half_even(col, digits + 4), digits)


def text_to_integer(col: Column) -> Column:
    """Whole number from text; ``'10'`` and ``'10.0'`` both give 10."""
    return F.round(F.trim(col).cast("double"), 0).cast("int")
