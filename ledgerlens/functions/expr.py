"""Column expressions shared by the feature plans.

All are built-in expressions, so they stay inside whole-stage codegen.
Under ANSI mode ``x / 0`` raises, ``try_divide`` gives NULL instead, and
``ln(x <= 0)`` is NULL: the zero/inf/NaN clean-up of a pandas pipeline
becomes a single ``coalesce`` around each expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: epsilon added after min-max scaling.
MINMAX_EPSILON = 1e-6
MICROS_PER_DAY = 86_400_000_000.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double(x) -> Column:
    return _c(x).cast("double")


def safe_div(num, den) -> Column:
    """Zero-safe ratio: 0 when the denominator is 0 or NULL, or the
    numerator is NULL (x/0 -> inf -> 0 and 0/0 -> NaN -> 0)."""
    return F.coalesce(F.try_divide(as_double(num), as_double(den)), F.lit(0.0))


def safe_log(x) -> Column:
    """Natural log with log(0) = -inf -> 0 and log(negative) = NaN -> 0."""
    return F.coalesce(F.ln(as_double(x)), F.lit(0.0))


def fill0(x) -> Column:
    return F.coalesce(_c(x), F.lit(0))


def fill0d(x) -> Column:
    return F.coalesce(as_double(x), F.lit(0.0))


def null_sum(*cols) -> Column:
    """Null-propagating sum: NULL if any term is NULL."""
    out = _c(cols[0])
    for c in cols[1:]:
        out = out + _c(c)
    return out


def filled_sum(*cols) -> Column:
    """Fill-first sum: each term NULL -> 0 before adding."""
    out = fill0(cols[0])
    for c in cols[1:]:
        out = out + fill0(c)
    return out


def flag(cond: Column) -> Column:
    """0/1 integer flag; a NULL condition gives 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def days_between(later, earlier) -> Column:
    """Whole days ``later - earlier`` between dates."""
    return F.datediff(_c(later), _c(earlier))


def fractional_days(later, earlier) -> Column:
    """Fractional days between two timestamps (microsecond resolution)."""
    return F.timestamp_diff("MICROSECOND", _c(earlier), _c(later)).cast("double") / F.lit(MICROS_PER_DAY)


def minmax_log(x, lo, hi) -> Column:
    """log((x - lo) / (hi - lo) + eps) with a constant column (hi == lo)
    giving NaN -> 0.  A value outside [lo, hi], which only another population's
    fitted bounds leave, counts as the nearer bound: without that, the log of a
    negative would become 0, the value of the maximum."""
    scaled = F.try_divide(as_double(x) - as_double(lo), as_double(hi) - as_double(lo))
    inside = F.when(scaled < 0, F.lit(0.0)).when(scaled > 1, F.lit(1.0)).otherwise(scaled)
    return safe_log(inside + F.lit(MINMAX_EPSILON))


def replace_inf(x) -> Column:
    """+-inf -> 0 for data loaded from files (NaN is a null token there)."""
    d = as_double(x)
    return F.when(d.isin(float("inf"), float("-inf")), F.lit(0.0)).otherwise(d)
