"""Fixed-point money: 29 whole digits and nine decimals, as in the source's numeric type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS, SCALE = 38, 9
STORED = f"decimal({DIGITS},{SCALE})"
FRACTION = f"decimal({SCALE},{SCALE})"


def stored(c: Column) -> Column:
    return c.cast(STORED)


def ratio(top: Column, bottom: Column, digits: int) -> Column:
    """Rounded quotient, NULL when the divisor is zero."""
    return F.round(F.try_divide(top.cast("double"), bottom.cast("double")), digits)


def _split(c: Column) -> tuple[Column, Column]:
    """Whole part and fraction, both with the sign of the value."""
    whole = F.when(c < 0, F.ceil(c)).otherwise(F.floor(c))
    return whole, (c - whole).cast(FRACTION)


def times(a: Column, b: Column) -> Column:
    """Product of two amounts, rounded half up to nine decimals; one that does not fit stops the job.

    Spark types the product of two 38-digit numbers so that 20 whole digits are left. Each partial
    product here fits: all four have the sign of the product, and only that of the fractions has
    more than nine decimals, so rounding it alone rounds the product.
    """
    (a, a_part), (b, b_part) = _split(stored(a)), _split(stored(b))
    small = F.round(a_part * b_part, SCALE)
    return stored(stored(a * b) + stored(a * b_part) + stored(a_part * b) + stored(small))
