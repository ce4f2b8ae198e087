"""Sums and averages that do not depend on partitioning, and lose no digits.

A floating-point sum changes in its last digits with the order of its rows, and
a tie then rounds either way. Measures here are therefore summed as whole numbers in two
limbs: whole units (1/10,000 for money, distance, speed and ratios, milliseconds for
minutes) and millionths of a unit. Both are BIGINT sums inside generated code and add up
to any coarser grouping; they are put together as an exact decimal, and divided as whole
numbers, once a group is complete. A value beyond BIGINT units, an infinite one too, and
an overflowing sum raise an error: the units of a group may reach 9.2e18, and a group
may hold 9.2e12 values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10_000
MINUTE_UNITS = 60_000


@dataclass(frozen=True)
class Measure:
    """One aggregate column: ``kind`` is ``avg`` or ``sum``, rounded to ``digits``."""

    kind: str
    column: str
    digits: int = 3
    units: int = UNITS


#: Parts of a unit, the lower limb.
PARTS = 1_000_000


def _known(value: Column) -> Column:
    # NaN is larger than any number here
    return value.isNotNull() & ~F.isnan(value)


def limbs(col: Column | str, units: int = UNITS) -> tuple[Column, Column]:
    """Whole units and millionths of a unit (0 to 999,999) of a value; NaN becomes null, a value too large is an error."""
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    refused = F.when(_known(value), F.raise_error(F.lit("a measure exceeds the range of its units")).cast("double"))
    # one guarded value, on which generated code shares all that follows
    value = F.when(F.abs(value) < F.lit(2.0**63 / units), value).otherwise(refused)
    # whole numbers and fractions part without loss; parts of a unit are whole numbers below 2^53
    whole = value.cast("bigint")
    parts = F.rint((value - whole.cast("double")) * F.lit(float(units * PARTS)))
    above = F.floor(parts / F.lit(float(PARTS)))
    return whole * F.lit(units).cast("bigint") + above, parts.cast("bigint") - above * F.lit(PARTS).cast("bigint")


def limb_sums(name: str, col: Column | str, units: int = UNITS) -> list[Column]:
    """Sums of both limbs as ``name`` and ``name_low``."""
    high, low = limbs(col, units)
    return [F.sum(high).alias(name), F.sum(low).alias(f"{name}_low")]


def resummed(name: str) -> list[Column]:
    """The same sums from finer sums."""
    return [F.sum(n).alias(n) for n in (name, f"{name}_low")]


def count_known(col: Column | str) -> Column:
    """Number of values that are neither null nor NaN."""
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    return F.count_if(_known(value))


def _total(name: str) -> Column:
    """The exact sum in parts of a unit."""
    high, low = (F.col(n).cast("decimal(20,0)") for n in (name, f"{name}_low"))
    return high * F.lit(PARTS).cast("decimal(7,0)") + low


def _rounded(total: Column, whole: Column, digits: int) -> Column:
    """total / whole as a double, rounded away from zero at ties; both are whole numbers."""
    doubled = F.abs(total) * F.lit(2 * 10**digits).cast("decimal(10,0)") + whole
    steps = F.call_function("div", doubled, whole * F.lit(2).cast("decimal(1,0)"))
    return F.signum(total) * steps.cast("double") / F.lit(float(10**digits))


def rounded_sum(name: str, digits: int, units: int = UNITS) -> Column:
    return _rounded(_total(name), F.lit(units * PARTS).cast("decimal(12,0)"), digits)


def rounded_avg(name: str, count: Column, digits: int, units: int = UNITS) -> Column:
    """Null for an empty group."""
    values = F.nullif(count, F.lit(0)).cast("decimal(19,0)")
    return _rounded(_total(name), values * F.lit(units * PARTS).cast("decimal(12,0)"), digits)


def plain_avg(name: str, count: Column, units: int = UNITS) -> Column:
    """Unrounded average, for comparing with thresholds."""
    return _total(name).cast("double") / F.nullif(count.cast("double") * F.lit(float(units * PARTS)), F.lit(0.0))


def _half_up(value: Column, digits: int) -> Column:
    """Round away from zero at ties."""
    return F.signum(value) * F.floor(F.abs(value) + F.lit(0.5)) / F.lit(float(10**digits))


def round_half_up(value: Column, digits: int) -> Column:
    """Row-wise rounding of a double with the same rule as the aggregates."""
    return _half_up(value * F.lit(float(10**digits)), digits)
