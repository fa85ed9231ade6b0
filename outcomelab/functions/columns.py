"""Column-level helpers: all built-in expressions, evaluated JVM-side."""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def qcol(name: str) -> Column:
    """Column by its exact name, even with dots or spaces (one-hot names)."""
    return F.col("`" + name.replace("`", "``") + "`")


def safe_div(num, den) -> Column:
    """Division that yields NULL for a zero or NULL denominator (ANSI mode
    raises on a plain ``/`` by zero)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def smoothed_rate(num_obs, sum_obs, num_assumed, sum_assumed) -> Column:
    """(sum_obs + sum_assumed) / (num_obs + num_assumed)  (O54)."""
    return safe_div(col_(sum_obs) + col_(sum_assumed), col_(num_obs) + col_(num_assumed))


def flag_to_bool(c) -> Column:
    """'t' / 'f' text to boolean, anything else NULL."""
    c = col_(c)
    return F.when(c == "t", F.lit(True)).when(c == "f", F.lit(False))


def any_of(*cols) -> Column:
    """Boolean OR of several columns."""
    return reduce(lambda a, b: a | b, [col_(c) for c in cols])


def product_of(*cols) -> Column:
    """Product of several probability columns."""
    return reduce(mul, [col_(c) for c in cols])


def years_between(first, last, digits: int = 2) -> Column:
    """Whole days between two dates / 365, rounded."""
    return F.round(F.datediff(col_(last), col_(first)) / F.lit(365.0), digits)


def concat_strict(*cols, sep: str = "-") -> Column:
    """Concatenate with a separator; NULL if any part is NULL."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(col_(c))
    return F.concat(*parts)


def digamma(x) -> Column:
    """psi(x) for x >= 1 as a Column expression: shift by six with the
    recurrence psi(x) = psi(x + 1) - 1/x, then the asymptotic series
    (error below 1e-10 for x >= 1)."""
    x = col_(x).cast("double")
    shift = reduce(lambda a, b: a + b, [F.lit(1.0) / (x + F.lit(float(j))) for j in range(6)])
    y = x + F.lit(6.0)
    y2 = y * y
    series = (F.log(y) - F.lit(0.5) / y
              - F.lit(1.0 / 12.0) / y2
              + F.lit(1.0 / 120.0) / (y2 * y2)
              - F.lit(1.0 / 252.0) / (y2 * y2 * y2)
              + F.lit(1.0 / 240.0) / (y2 * y2 * y2 * y2)
              - F.lit(5.0 / 660.0) / (y2 * y2 * y2 * y2 * y2))
    return series - shift


def digamma_np(x):
    """NumPy twin of :func:`digamma` (for checks and tiny driver-side sums)."""
    import numpy as np
    x = np.asarray(x, dtype=float)
    shift = sum(1.0 / (x + j) for j in range(6))
    y = x + 6.0
    y2 = y * y
    series = (np.log(y) - 0.5 / y - (1.0 / 12.0) / y2 + (1.0 / 120.0) / y2 ** 2
              - (1.0 / 252.0) / y2 ** 3 + (1.0 / 240.0) / y2 ** 4 - (5.0 / 660.0) / y2 ** 5)
    return series - shift


# Fixed values of the integer scatter: a Mersenne prime and two multipliers.
SCATTER_PRIME = (1 << 31) - 1
SCATTER_LOW = 1103515245
SCATTER_HIGH = 48271


def scatter(c, code: int = 0) -> Column:
    """Deterministic pseudo-random integer in 0 .. SCATTER_PRIME - 1 from an id
    and a number: stable under repartitioning and recomputation, unlike
    ``rand``, and plain integer arithmetic, so any SQL engine can repeat it.

    An affine step and a fifth power modulo the prime; both are one to one,
    so ids below the prime never meet.  Ids that are no integers go through
    their 64-bit hash first."""
    p = F.lit(SCATTER_PRIME).cast("long")
    c = col_(c)
    n = F.coalesce(c.try_cast("long"), F.xxhash64(c))
    u = F.pmod(F.pmod(n, p) * SCATTER_LOW + F.pmod(F.shiftright(n, 31), p) * SCATTER_HIGH
               + F.lit(code % SCATTER_PRIME).cast("long"), p)
    square = u * u % p
    return square * square % p * u % p
