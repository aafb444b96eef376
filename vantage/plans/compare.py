"""Output canonicalisation for engine-to-engine comparison.

Applied as the last projection of every registered query, identically to the
oracle SQL: dates and timestamps become ISO text, doubles are rounded to 6
decimals after a 1e-9 nudge (sums in a different order differ in the last bits), integers are
widened to BIGINT.  Values are otherwise untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6
NUDGE = 1e-9


def canonical(df: DataFrame, nullable_ints=()) -> DataFrame:
    """``nullable_ints``: integer columns that may hold NULLs; they are emitted as
    DOUBLE because the two engines hand NULL-able integers to pandas as
    different dtypes (float64 vs Int64)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            # the nudge settles exact decimal ties (avg of 2-decimal values over
            # 2^k rows) the same way in both engines; + 0.0 folds -0.0 into 0.0
            c = F.round(c.cast("double") + F.lit(NUDGE), DIGITS) + F.lit(0.0)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("double") if f.name in nullable_ints else c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)
