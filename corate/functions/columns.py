"""Column expressions shared by the operators.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corate.constants import ERROR_BANDS, PREDICTION_HEADER  # noqa: F401  (fixed values)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def guarded_ratio(num: str | Column, den: str | Column, default=0.0) -> Column:
    """num/den when both are non-zero (and not null), else ``default``.

    Written so that no division by zero is ever evaluated (ANSI mode raises).
    """
    n, d = col(num), col(den)
    ok = n.isNotNull() & d.isNotNull() & (n != 0) & (d != 0)
    dflt = default if isinstance(default, Column) else F.lit(default)
    return F.when(ok, n / F.when(ok, d)).otherwise(dflt)


#: Relative size below which a sum of products of centred values counts as zero.
CENTRED_ZERO = 1e-11


def noise(n: Column) -> Column:
    """Bound of the rounding errors of a difference of sums over ``n`` terms,
    relative to the sums."""
    return F.lit(2 * 2.0**-52) * (n + F.lit(4.0))


def pearson_from_moments(
    n: str | Column,
    sx: str | Column,
    sy: str | Column,
    sxy: str | Column,
    sxx: str | Column,
    syy: str | Column,
) -> Column:
    """Pearson correlation from raw co-moment sums; 0 when undefined.

    num = n*Sxy - Sx*Sy, den = sqrt(n*Sxx - Sx^2) * sqrt(n*Syy - Sy^2).
    Multiplying the centred form by n^2 keeps every term a sum of products of
    the inputs, so ratings on a fixed grid (half stars) give exact numerators
    and denominators that do not depend on row order. Off the grid, a variance
    or covariance within the rounding errors of its sums is zero (constant
    series, no covariance). The inputs should be shifted to about zero first:
    the correlation does not change, and the sums cancel less.
    """
    n, sx, sy, sxy, sxx, syy = map(col, (n, sx, sy, sxy, sxx, syy))
    nd = n.cast("double")
    num = nd * sxy - sx * sy
    vx = nd * sxx - sx * sx
    vy = nd * syy - sy * sy
    # each difference is written as few times as possible: a long expression
    # gives a generated method that the JVM leaves to its interpreter
    real = (
        (vx > noise(nd) * nd * sxx)
        & (vy > noise(nd) * nd * syy)
        & (F.abs(num) > noise(nd) * nd * F.sqrt(sxx * syy))
    )
    sim = F.try_divide(num, F.sqrt(vx) * F.sqrt(vy))
    return F.coalesce(F.when(real, sim), F.lit(0.0))


def centred_pearson(sab: str | Column, saa: str | Column, sbb: str | Column) -> Column:
    """Pearson-style ratio of pre-centred sums: Sab / (sqrt(Saa) * sqrt(Sbb)),
    0 below ``CENTRED_ZERO``."""
    sab, saa, sbb = map(col, (sab, saa, sbb))
    den = F.sqrt(saa) * F.sqrt(sbb)
    sim = F.when(F.abs(sab) > F.lit(CENTRED_ZERO) * den, F.try_divide(sab, den))
    return F.coalesce(sim, F.lit(0.0))


def sum_normalized(sxy: str | Column, sx: str | Column, sy: str | Column) -> Column:
    """Sxy / (Sx * Sy) over co-raters, 0 when undefined."""
    sxy, sx, sy = map(col, (sxy, sx, sy))
    return F.coalesce(guarded_ratio(sxy, sx * sy), F.lit(0.0))


def band_aggregates(err: str | Column) -> list[Column]:
    """Counts of |err| per half-open band, in one pass.

    NaN errors belong to no band (a NaN comparison is false in the
    reference's language, while Spark orders NaN above every number).
    """
    e = col(err)
    ok = e.isNotNull() & ~F.isnan(e)
    out = []
    for name, lo, hi in ERROR_BANDS:
        cond = ok & (e >= F.lit(lo))
        if hi is not None:
            cond = cond & (e < F.lit(hi))
        out.append(F.count_if(cond).alias(name))
    return out
