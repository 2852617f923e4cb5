"""Column-expression helpers shared by every operator.

Spark 4 runs with ANSI semantics: a bare ``/`` by zero, an invalid cast or
``corr`` on a constant column raises.  Every division, cast and correlation in
the library goes through the guarded forms below, which return NULL instead.
Missing values are NULL, never NaN (Spark orders NaN above every number, so
``NaN >= 66`` is true there while it is false in pandas/numpy).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL."""
    return F.try_divide(col(a), col(b))


def pct(a, b) -> Column:
    """100 * a / b, NULL when b is 0 or NULL."""
    return F.try_divide(col(a) * F.lit(100.0), col(b))


def pct_change(cur, prev) -> Column:
    """Percent change from prev to cur; NULL when prev is 0 or NULL."""
    return (F.try_divide(col(cur), col(prev)) - F.lit(1.0)) * F.lit(100.0)


def q4(c) -> Column:
    """Quantise a double to 4 decimals for cross-engine comparison.

    The +0.37 offset keeps the cut point away from short decimal ties, so
    last-bit differences between engines never flip the result.
    """
    return F.floor(col(c) * F.lit(10000.0) + F.lit(0.37)) / F.lit(10000.0)


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def clip(c, lo=None, hi=None) -> Column:
    """Clamp, keeping NULL as NULL (greatest/least would skip the NULL)."""
    c = col(c)
    out = c
    if lo is not None:
        out = F.when(out < F.lit(lo), F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > F.lit(hi), F.lit(hi)).otherwise(out)
    return F.when(c.isNotNull(), out)


def weekday0(d) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6 (pandas convention)."""
    return F.weekday(col(d))


def is_weekend(d) -> Column:
    return F.weekday(col(d)) >= F.lit(5)


def paired(a, b):
    """Pairwise-complete inputs: both sides NULL unless both are present."""
    a, b = col(a), col(b)
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, a), F.when(both, b)


def safe_corr(a, b) -> Column:
    """Pearson correlation as an aggregate, NULL when either side is constant.

    ``F.corr`` raises DIVIDE_BY_ZERO under ANSI mode on a constant column;
    this form has the same value elsewhere and is NULL there, as pandas'
    NaN.  Pairs with a NULL on either side are skipped (pairwise complete).
    """
    pa, pb = paired(a, b)
    return F.try_divide(F.covar_samp(pa, pb), F.stddev_samp(pa) * F.stddev_samp(pb))


def sample_std(c) -> Column:
    """Sample standard deviation (pandas ``.std()``); NULL for one row."""
    return F.stddev_samp(col(c))


def isclose(a, b, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """numpy.isclose semantics; NULL on either side counts as not close,
    except both NULL, which counts as equal (as equal_nan=True)."""
    a, b = col(a), col(b)
    close = F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)
    return F.when(a.isNull() & b.isNull(), F.lit(True)).otherwise(F.coalesce(close, F.lit(False)))


def season(month) -> Column:
    """Indian crop seasons by month number (fixed values below).

    Nov-Feb Winter, Mar-May Summer, Jun-Sep Monsoon, Oct Post-Monsoon.
    """
    m = col(month)
    return (F.when(m.isin(11, 12, 1, 2), F.lit("Winter"))
            .when(m.isin(3, 4, 5), F.lit("Summer"))
            .when(m.isin(6, 7, 8, 9), F.lit("Monsoon"))
            .otherwise(F.lit("Post-Monsoon")))
