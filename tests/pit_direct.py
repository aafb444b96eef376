"""The textbook form of a point-in-time panel, as a cross-check: entities x spine, a
semi join for eligibility, a left join ``fact.ts <= snapshot``, filtered aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.operators.pit import _cast_out, _direct_agg, _interval, time_spine


def pit_direct(facts: DataFrame, entity: str, ts: str, features,
               unit: str = "month", lead: str = "1 month",
               out: str = "snapshot_date") -> DataFrame:
    """Readable form: pairs, left join on ``entity`` and ``ts <= snapshot``, filtered aggregates."""
    spine = time_spine(facts, ts, unit, out)
    ents = facts.where(F.col(entity).isNotNull()).select(entity).distinct()
    f_alias = facts.alias("f")
    pairs = (ents.crossJoin(F.broadcast(spine)).alias("p")
                 .join(f_alias.select(entity, ts).alias("e"),
                       (F.col(f"p.{entity}") == F.col(f"e.{entity}"))
                       & (F.col(f"e.{ts}") <= F.col(f"p.{out}").cast("timestamp_ntz") + _interval(lead)),
                       "left_semi"))
    joined = pairs.alias("p").join(
        f_alias,
        (F.col(f"p.{entity}") == F.col(f"f.{entity}"))
        & (F.col(f"f.{ts}") <= F.col(f"p.{out}").cast("timestamp_ntz")),
        "left")
    snap_ts = F.col(f"p.{out}").cast("timestamp_ntz")
    ts_col = F.col(f"f.{ts}")
    aggs = [_cast_out(f, _direct_agg(f, ts_col, snap_ts, f"f.{ts}")).alias(f.name) for f in features]
    return joined.groupBy(F.col(f"p.{entity}").alias(entity), F.col(f"p.{out}").alias(out)).agg(*aggs)
