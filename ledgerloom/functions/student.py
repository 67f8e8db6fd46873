"""Two-sided p-values of Student's t distribution in built-in SQL functions.

For many degrees of freedom a normalising transform (Hill 1970) is exact to about ten
digits; for few, the incomplete beta function is summed as a continued fraction.  The
formulas are SQL text: as chained columns their hundreds of terms would take longer to
build than to run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import let, normal_tail

# Above this many degrees of freedom the transform is used.
MANY = 100
FRACTION_STEPS = 120


def log_gamma(x: str) -> str:
    """SQL text of the log gamma function for x > 0: Stirling's series after a shift by 8."""
    series = "1/(12*z) - 1/(360*pow(z,3)) + 1/(1260*pow(z,5)) - 1/(1680*pow(z,7)) + 1/(1188*pow(z,9))"
    product = " * ".join(f"(z - {8 - i})" for i in range(8))
    stirling = f"(z - 0.5D) * ln(z) - z + 0.5D * ln(2 * pi()) + {series} - ln({product})"
    return f"element_at(transform(array({x} + 8D), z -> {stirling}), 1)"


def _few(t: str, df: str) -> str:
    """SQL text of the p-value by the continued fraction of the incomplete beta function."""
    # I_x(a, 1/2) with x = df / (df + t^2) below the mean of the beta law; above it the
    # mirrored function 1 - I_(1-x)(1/2, a) converges instead.
    x = f"({df} / ({df} + {t} * {t}))"
    past_mean = f"{x} > ({df} / 2 + 1) / ({df} / 2 + 2.5D)"
    sides = (
        f"if({past_mean}, struct(0.5D AS a, {df} / 2 AS b, 1 - {x} AS x, true AS mirrored), "
        f"struct({df} / 2 AS a, 0.5D AS b, {x} AS x, false AS mirrored))"
    )
    # Modified Lentz recurrence: step 1 belongs to the start, then the two kinds of
    # numerators alternate.
    first = "1 / (1 - (p.a + p.b) * p.x / (p.a + 1))"
    even = "(i/2) * (p.b - i/2) * p.x / ((p.a + i - 1) * (p.a + i))"
    odd = (
        "-(p.a + (i-1)/2) * (p.a + p.b + (i-1)/2) * p.x / ((p.a + i - 1) * (p.a + i))"
    )
    step = f"if(i % 2 = 0, {even}, {odd})"
    fraction = (
        f"aggregate(sequence(2, {FRACTION_STEPS}), struct(1D AS c, {first} AS d, {first} AS f), "
        f"(s, i) -> element_at(transform(array({step}), n -> "
        "struct(1 + n / s.c AS c, 1 / (1 + n * s.d) AS d, "
        "s.f * (1 + n / s.c) / (1 + n * s.d) AS f)), 1), s -> s.f)"
    )
    log_beta = (
        f"{log_gamma('p.a')} + {log_gamma('p.b')} - {log_gamma('(p.a + p.b)')}"
    )
    share = f"exp(p.a * ln(p.x) + p.b * ln(1 - p.x) - ({log_beta})) * {fraction} / p.a"
    return (
        f"element_at(transform(array({sides}), p -> if(p.mirrored, 1 - {share}, {share})), 1)"
    )


def _normal_deviate(t: str, df: str) -> str:
    """SQL text of the normal deviate with the same tail as ``t`` (Hill 1970)."""
    b = f"(48 * ({df} - 0.5D) * ({df} - 0.5D))"
    tail = f"(((-0.4D * y - 3.3D) * y - 24) * y - 85.5D) / (0.8D * y * y + 100 + {b})"
    y = f"({df} - 0.5D) * log1p({t} * {t} / {df})"
    return f"element_at(transform(array({y}), y -> (({tail} + y + 3) / {b} + 1) * sqrt(y)), 1)"


def t_two_sided(t: str, df: str) -> Column:
    """P(|T| > |t|) from the names of two columns; NULL when t or df is missing or df <= 0."""
    many = let(F.expr(_normal_deviate(t, df)), lambda z: 2 * normal_tail(z))
    return (
        F.when(F.col(t).isNull() | F.col(df).isNull() | (F.col(df) <= 0), F.lit(None))
        .when(F.col(t) == 0, F.lit(1.0))
        .when(F.col(df) > MANY, many)
        .otherwise(F.expr(_few(t, df)))
    )
