"""Column expressions for rates, bounds and totals."""

from __future__ import annotations

import math
import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clamp(value: ColumnLike, low: float, high: float) -> Column:
    """``value`` bounded to [low, high]; NULL becomes ``low`` because greatest() skips NULLs."""
    return F.least(F.lit(high), F.greatest(F.lit(low), _col(value)))


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient that is NULL, not an error, when the denominator is zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    return ratio(numerator, denominator) * F.lit(100.0)


def seconds_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole seconds from ``start`` to ``end``; fractions of either second are dropped first."""
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def minutes_between(start: ColumnLike, end: ColumnLike) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def hours_between(start: ColumnLike, end: ColumnLike) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def any_true(flags: Sequence[ColumnLike]) -> Column:
    """Three-valued OR: TRUE if one flag is, else NULL if one is unknown, else FALSE."""
    return reduce(operator.or_, [_col(flag) for flag in flags])


def to_number(value: ColumnLike) -> Column:
    """Text as double; text that is no number becomes NULL."""
    return _col(value).try_cast("double")


def count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


#: Most places after the point that a total of 2^37 units parted in two longs can have as a decimal.
_SCALES = 6
#: Bits of the lower of the two longs.
_LOW_BITS = 26


def stable_sum(value: ColumnLike, scale: int | None) -> Column:
    """Sum of doubles; with a ``scale``, each is rounded to it and summed as a decimal, so the row order
    cannot change the result."""
    if scale is None:
        return F.sum(_col(value))
    if not 1 <= scale <= _SCALES:
        return F.sum(_col(value).cast(f"decimal(28,{scale})")).cast("double")
    # Most doubles are whole units of the scale, which are summed as two longs; decimals are for the rest.
    number, unit = _col(value), float(10**scale)
    # below this bound a double's digits lie within a third of a unit, so such a number is what the decimal rounds to
    bound = 2.0 ** math.floor(math.log2(0.3 * 2**52 / unit))
    rounded = F.when(F.abs(number) < bound, F.rint(number * F.lit(unit)).cast("bigint"))
    units = F.when(rounded / F.lit(unit) == number, rounded)
    high, low = F.sum(F.shiftright(units, _LOW_BITS)), F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    rest = F.sum(F.when(units.isNull(), number.cast(f"decimal(28,{scale})")))
    whole = high.cast("decimal(20,0)") * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low.cast("decimal(20,0)")
    exact = whole * F.lit(f"{10**-scale:.{scale}f}").cast(f"decimal({scale},{scale})")
    return F.when(high.isNull(), rest).when(rest.isNull(), exact).otherwise(exact + rest).cast("double")


def stable_avg(value: ColumnLike, scale: int | None) -> Column:
    if scale is None:
        return F.avg(_col(value))
    return F.try_divide(stable_sum(value, scale), F.count(_col(value)).cast("double"))
