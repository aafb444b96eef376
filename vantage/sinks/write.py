"""Sinks: table replace by versions, month-partitioned Parquet, partition audit.

A table that is replaced is an external table on one of its version folders.  New rows are
written to a new folder first; then the table's location is switched, one catalogue
operation.  Readers see the old rows or the new ones, and a write that fails loses nothing.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    """(Hadoop file system, path) of any scheme."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder on whatever file system it is; false where there was none."""
    fs, place = _fs(spark, path)
    return fs.delete(place, True)


def point_table(spark: SparkSession, schema: str, table: str, path: str, columns: T.StructType, fmt: str = "parquet",
                by: str | None = None) -> str:
    """Make ``schema.table`` the rows under ``path``: its location is switched where it has these
    columns already.  With other columns a table made aside takes the name, and only the
    catalogue entry of the old one goes.  Rows partitioned ``by`` a column become a view on
    their folder, replaced in one operation as well, because a catalogue keeps the place of
    each partition."""
    name = f"`{schema}`.`{table}`"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    # what a catalogue keeps of columns: names and types
    shape = lambda s: [(f.name, f.dataType.simpleString()) for f in s]
    if by is not None:
        listed = ", ".join(f"`{f.name}`" for f in columns)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM {fmt}.`{path}`")
        return name
    if spark.catalog.tableExists(f"{schema}.{table}") and shape(spark.table(name).schema) == shape(columns):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        aside = f"{table}_{uuid.uuid4().hex[:8]}"
        spark.catalog.createTable(f"{schema}.{aside}", path=path, source=fmt, schema=columns)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE `{schema}`.`{aside}` RENAME TO {name}")
    spark.catalog.refreshTable(name)
    return name


def replace_table(df: DataFrame, schema: str, table: str, fmt: str = "parquet", root: str | None = None,
                  keep: int = 2) -> str:
    """Write ``df`` as the next version of ``schema.table`` and switch the table to it.

    Versions are folders under ``root/table`` (by default beside the schema's own tables);
    the latest ``keep`` stay, so that running readers of the previous one can end."""
    spark = df.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    if root is None:
        where = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE SCHEMA `{schema}`").collect()}
        root = f"{where['Location'].rstrip('/')}/versions"
    home = f"{root.rstrip('/')}/{table}"
    path = f"{home}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    fs, place = _fs(spark, path)
    try:
        df.write.format(fmt).save(path)
        name = point_table(spark, schema, table, path, spark.read.format(fmt).load(path).schema, fmt)
    except BaseException:
        fs.delete(place, True)
        raise
    held = sorted(s.getPath().getName() for s in fs.listStatus(place.getParent()))
    for old in held[:-keep]:
        fs.delete(_fs(spark, f"{home}/{old}")[1], True)
    return name


def write_month_partitioned(df: DataFrame, path: str, part_col: str = "partition_month",
                            max_records_per_file: int | None = None, replace: str = "all") -> str:
    """Hive-style ``part_col=YYYY-MM`` Parquet, overwrite.

    Rows are clustered by the partition column with a ``rebalance`` hint: AQE
    hash-clusters by month, then splits a month bigger than the advisory size
    over several tasks and coalesces small ones.  Each month becomes a few
    well-sized files: no small-file explosion, and no single task holding a
    whole month (a plain ``repartition(month)`` would put a month of a 100 TB
    table in one task).  The partition value leaves the files.

    ``replace``: "all" (the table becomes ``df``) or "months" (only those present
    in ``df`` are replaced, so re-loading one month is idempotent).  The mode is an
    option of this write; the session's setting stays as it is.
    """
    mode = {"all": "static", "months": "dynamic"}[replace]
    w = (df.hint("rebalance", part_col).write.mode("overwrite").partitionBy(part_col)
         .option("partitionOverwriteMode", mode))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    return path


def partition_audit(spark: SparkSession, path: str, part_col: str = "partition_month") -> DataFrame:
    """Per partition: number of part files and rows (read back from storage)."""
    df = spark.read.parquet(path)
    return (df.groupBy(part_col)
              .agg(F.count_distinct(F.col("_metadata.file_path")).alias("part_files"),
                   F.count(F.lit(1)).alias("row_count")))
