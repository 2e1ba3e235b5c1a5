"""Exact ratios and guarded measures.

Ratios of counts are rounded half up to the same value on every engine and in every
merge order.  With numerator and denominator whole, ``(2 * a * 10^k + b) / (2 * b)``
is at least ``1 / (2 * b)`` below the next whole number it does not reach; as long as
the numerator is below 2^53 a double quotient cannot round up to it, so ``floor`` is
exact.  For percentages with two decimals that holds up to about 4e11.  The
arithmetic on doubles needs no wide decimals and compiles to little code: a table
with dozens of ratios stays below the size where the JVM stops compiling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def half_up(num: Column, den: Column, scale: int = 2) -> Column:
    """``round(num / den, scale)`` for whole numbers, null unless ``den > 0``."""
    n, d = num.cast("double"), den.cast("double")
    whole = F.floor((F.abs(n) * (2.0 * 10 ** scale) + d) / (d * 2.0))
    if scale == 0:
        return F.when(d > 0, F.when(n < 0, -whole).otherwise(whole))
    # adding zero turns a rounded -0.0 into 0.0
    return F.when(d > 0, F.signum(n) * whole / (10.0 ** scale) + 0.0)


def pct(num: Column, den: Column, scale: int = 2) -> Column:
    """Share of ``den`` in percent."""
    return half_up(num.cast("double") * 100.0, den, scale)


def per_thousand(num: Column, den: Column, scale: int = 1) -> Column:
    """Events per thousand of ``den``."""
    return half_up(num.cast("double") * 1000.0, den, scale)


def change_pct(now: Column, before: Column, scale: int = 2) -> Column:
    """Relative change in percent, null unless ``before > 0``."""
    return pct(now - before, before, scale)


def non_negative(c: Column, to: str = "int") -> Column:
    """Whole number (half to even, as a float-to-integer cast does), null below zero."""
    return F.when(c >= 0, F.rint(c).cast(to))


def null_as_zero_sum(*cols: Column) -> Column:
    """Total that counts missing parts as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])


def first_available(*cols: Column) -> Column:
    return F.coalesce(*cols)
