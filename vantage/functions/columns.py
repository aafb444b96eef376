"""Column-level helpers.  Every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vantage.functions.fixed import EARTH_RADIUS_KM, RISK_TIERS

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1: ColumnOrName, lng1: ColumnOrName,
                 lat2: ColumnOrName, lng2: ColumnOrName) -> Column:
    """Great-circle distance in km; NULL when any input is NULL.

    The inner term is clamped to 1.0 so antipodal points never hit asin(>1).
    """
    la1, lo1, la2, lo2 = (_c(lat1), _c(lng1), _c(lat2), _c(lng2))
    a = (F.pow(F.sin(F.radians((la2 - la1) / 2)), 2)
         + F.cos(F.radians(la1)) * F.cos(F.radians(la2))
         * F.pow(F.sin(F.radians((lo2 - lo1) / 2)), 2))
    root = F.sqrt(a)
    # clamp without least(): least() skips NULLs and would turn a missing
    # coordinate into a half circumference
    clamped = F.when(root > F.lit(1.0), F.lit(1.0)).otherwise(root)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(clamped)


def flag(cond: Column) -> Column:
    """Boolean that is never NULL: three-valued logic collapsed to false."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def safe_rate(num: ColumnOrName, den: ColumnOrName, default: float = 0.0) -> Column:
    """num / den as double, ``default`` when the denominator is 0 or NULL."""
    return F.coalesce(F.try_divide(_c(num).cast("double"), _c(den).cast("double")),
                      F.lit(default))


def tier_label(score: ColumnOrName) -> Column:
    """Risk tier name of a 0..1 score: the first tier whose upper bound is above
    the score, the top tier otherwise; NULL stays NULL."""
    s = _c(score)
    expr = F.when(s.isNull(), F.lit(None).cast("string"))
    for name, _lo, hi, _action in RISK_TIERS[:-1]:
        expr = expr.when(s < F.lit(hi), F.lit(name))
    return expr.otherwise(F.lit(RISK_TIERS[-1][0]))


def year_month(ts: ColumnOrName) -> Column:
    """``strftime(ts::date, '%Y-%m')``."""
    return F.date_format(_c(ts), "yyyy-MM")


def last_segment(col: ColumnOrName, sep: str = ".") -> Column:
    """Last ``sep``-separated segment of a string."""
    import re
    return F.element_at(F.split(_c(col), re.escape(sep)), -1)


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Fractional hours from ``start`` to ``end`` (NULL if either is NULL).

    ``timestampdiff`` on TIMESTAMP_NTZ values is wall-clock arithmetic, so the
    result does not depend on the session time zone or its DST changes."""
    s, e = _c(start).cast("timestamp_ntz"), _c(end).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", s, e).cast("double") / F.lit(3_600_000_000.0)


def round_half_away(col: ColumnOrName, digits: int) -> Column:
    """Round half away from zero on the binary value, as SQL engines round doubles
    (Spark's own ``round`` works on the decimal text of the double)."""
    scale = F.lit(float(10 ** digits))
    x = _c(col)
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale


def percent(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """``round(100.0 * num / nullif(den, 0), digits)`` as DOUBLE (NULL when den is 0)."""
    return round_half_away(F.try_divide(F.lit(100.0) * _c(num).cast("double"), _c(den).cast("double")), digits)
