"""Rounding, ratios and the normal distribution as plain column arithmetic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rational approximation of the normal tail by Hart (1968) in the
# double precision form of West (2005); highest power first.
HART_TOP = (
    3.52624965998911e-02,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
)
HART_BOTTOM = (
    8.83883476483184e-02,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
)
HART_SWITCH = 7.07106781186547


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it.

    For long formulas on result rows: it keeps the expression (and the generated code)
    from growing with every mention.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def round_even(value: Column, digits: int) -> Column:
    """Round a double half to even, in binary arithmetic as numpy does it."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient as a double; NULL when the divisor is 0."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent(top: Column, bottom: Column, digits: int = 2) -> Column:
    """Share in percent, rounded."""
    return round_even(ratio(top, bottom) * F.lit(100.0), digits)


def _polynomial(coefficients: tuple[float, ...], x: Column) -> Column:
    total = F.lit(coefficients[0])
    for coefficient in coefficients[1:]:
        total = total * x + F.lit(coefficient)
    return total


def normal_tail(z: Column) -> Column:
    """Upper tail of the standard normal distribution, P(Z > z), to double precision."""

    def tail_of(size: Column) -> Column:
        density = F.exp(-size * size / 2)
        near = density * _polynomial(HART_TOP, size) / _polynomial(HART_BOTTOM, size)
        fraction = size + F.lit(0.65)
        for numerator in (4, 3, 2, 1):
            fraction = size + F.lit(float(numerator)) / fraction
        far = density / fraction / F.lit(2.506628274631)
        return F.when(size < F.lit(HART_SWITCH), near).otherwise(far)

    def signed(x: Column) -> Column:
        upper = let(F.abs(x), tail_of)
        return F.when(x >= 0, upper).otherwise(F.lit(1.0) - upper)

    return let(z, signed)
