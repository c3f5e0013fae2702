"""Numeric column expressions shared by operators and by the SQL oracles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Chebyshev coefficients of the complementary error function on
# t = 2 / (2 + z), z >= 0 (Numerical Recipes, 3rd ed., section 6.2.2), in order c0..c27.
ERFC_CHEB = [
    -1.3026537197817094, 6.4196979235649026e-1, 1.9476473204185836e-2, -9.561514786808631e-3,
    -9.46595344482036e-4, 3.66839497852761e-4, 4.2523324806907e-5, -2.0278578112534e-5,
    -1.624290004647e-6, 1.303655835580e-6, 1.5626441722e-8, -8.5238095915e-8,
    6.529054439e-9, 5.059343495e-9, -9.91364156e-10, -2.27365122e-10,
    9.6467911e-11, 2.394038e-12, -6.886027e-12, 8.94487e-13,
    3.13092e-13, -1.12708e-13, 3.81e-16, 7.106e-15,
    -1.523e-15, -9.4e-17, 1.21e-16, -2.8e-17,
]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c, digits: int = 6) -> Column:
    """Round to ``digits`` decimals as round(x * 10^d) / 10^d and normalise -0.0.

    Scaling first makes the rounding act on one IEEE product, which Spark and DuckDB
    round identically (half away from zero), so the two engines agree bit for bit.
    """
    scale = float(10 ** digits)
    return F.round(col(c) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI mode would raise on x / 0)."""
    return F.try_divide(col(a), col(b))


def erfc_nonneg(z) -> Column:
    """erfc(z) for z >= 0: Clenshaw recurrence over the Chebyshev coefficients as one
    ``aggregate`` expression (relative error ~1e-14, far below any output rounding)."""
    z = col(z)
    t = F.lit(2.0) / (F.lit(2.0) + z)
    ty = F.lit(4.0) * t - F.lit(2.0)
    coeffs = F.array(*[F.lit(c) for c in reversed(ERFC_CHEB[1:])])
    start = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("dd"))
    return F.aggregate(
        coeffs, start,
        lambda acc, c: F.struct((ty * acc["d"] - acc["dd"] + c).alias("d"), acc["d"].alias("dd")),
        lambda acc: t * F.exp(-(z * z) + F.lit(0.5) * (F.lit(ERFC_CHEB[0]) + ty * acc["d"]) - acc["dd"]),
    )


def normal_two_sided_p(score) -> Column:
    """2 * P(N(0,1) > |score|) = erfc(|score| / sqrt 2)."""
    return erfc_nonneg(F.abs(col(score)) / F.lit(2.0 ** 0.5))


# --------------------------------------------------------------------------------------
# The same expressions as SQL text, used by the DuckDB oracles (and usable in spark.sql).
# --------------------------------------------------------------------------------------

def sql_r6(expr: str, digits: int = 6) -> str:
    scale = f"1e{digits}"
    return f"(round(({expr}) * {scale}) / {scale} + 0.0)"


def sql_erfc_nonneg(z: str) -> str:
    theta = f"(2.0 * atan(sqrt(({z}) / 2.0)))"
    terms = [f"{ERFC_CHEB[0] / 2.0!r}"]
    for j in range(1, len(ERFC_CHEB)):
        terms.append(f"({ERFC_CHEB[j]!r}) * cos({float(j)!r} * {theta})")
    s = " + ".join(terms)
    return f"((2.0 / (2.0 + ({z}))) * exp(-(({z}) * ({z})) + ({s})))"


def sql_normal_two_sided_p(score: str) -> str:
    return sql_erfc_nonneg(f"abs({score}) / sqrt(2.0)")
