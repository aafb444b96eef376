"""Positions of rows in a global order, without one task seeing a whole group.

Rows are range partitioned by the full order, so a hot group spans many partitions; what
is combined across partitions is one count for each (group, partition)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import materialize


def numbered(df: DataFrame, order: list[str], group: list[str] | None = None) -> DataFrame:
    """``df`` with ``pos``, the row's place from 0 within its group by ``order`` (nulls
    first), and ``total``, the rows of the group.  Group columns hold no nulls; rows equal in
    group and order get places in any order.  The sorted rows are written once, so the places
    stay the same when an executor is lost.  ``df`` should be a written, narrow table: range
    partitioning reads it twice."""
    group = group or []
    keys = [*group, *order]
    put = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                      .withColumn("seq", F.monotonically_increasing_id()), "sorted")
    put = put.withColumn("part", F.shiftright("seq", 33))
    runs = put.groupBy(*group, "part").agg(F.count("*").alias("rows"), F.min("seq").alias("first"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(*group, "part", F.sum("rows").over(Window.partitionBy(*group)).alias("total"),
                       (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return (put.join(runs, [*group, "part"])
            .select(*df.columns, (F.col("seq") + F.col("shift")).alias("pos"), "total"))
