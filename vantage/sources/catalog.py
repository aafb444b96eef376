"""Catalogue access: register and synchronise file tables, list schemas, ad-hoc SQL, and the
raw landing layout keyed by event type."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.sources.raw import load_stamp


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   partitioned: bool = True) -> DataFrame:
    """Make files under ``path`` queryable by SQL as ``name`` (external table).

    Partitioned layouts are invisible until their partitions are recovered.  Returns what was
    created and found: the columns of ``sync_partitions``, all partitions ``added``."""
    spark.catalog.createTable(name, path=path, source=fmt)
    if not partitioned:
        return spark.createDataFrame([], CHANGES)
    return sync_partitions(spark, name)


#: one row a partition: its specification, and added, removed or kept
CHANGES = "partition string, change string"


def sync_partitions(spark: SparkSession, name: str) -> DataFrame:
    """Bring a table's partitions up to its folders, only those that came or went, and report
    each (partition ``key=value``, change added, removed or kept)."""
    def held() -> set[str]:
        return {r.partition for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}  # the catalogue's own list

    before = held()
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    after = held()
    rows = [(p, "kept" if p in before & after else "added" if p in after else "removed") for p in sorted(before | after)]
    return spark.createDataFrame(rows, CHANGES)


def list_schemas(spark: SparkSession, threads: int = 8) -> DataFrame:
    """Schemas that hold tables, sorted; the catalogue is asked about ``threads`` at a time."""
    names = [r.namespace for r in spark.sql("SHOW SCHEMAS").collect()]  # the catalogue's own list

    def holds(name: str) -> bool:
        return not spark.sql(f"SHOW TABLES IN `{name}`").where("NOT isTemporary").isEmpty()
    with ThreadPoolExecutor(max_workers=threads) as pool:
        held = [(n,) for n, h in zip(names, pool.map(holds, names)) if h]
    return spark.createDataFrame(held, "table_schema string").orderBy("table_schema")


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Ad-hoc SQL over registered tables and views."""
    return spark.sql(sql)


def event_type_of(file_name_col: Column) -> Column:
    """``olist_orders_dataset.csv`` -> ``orders``: file stem minus prefix/suffix."""
    stem = F.regexp_replace(file_name_col, r"\.[^.]*$", "")
    return F.regexp_replace(F.regexp_replace(stem, r"^olist_", ""), r"_dataset$", "")


def source_name(path: Column) -> Column:
    """Name of the source that a row's file belongs to: the file's, or its folder's where the
    source is a folder of part files."""
    return F.regexp_extract(path, r"([^/]+)(?:/part-[^/]*)?$", 1)


def land_by_event_type(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write rows under ``path/event_type=<type>/`` from each row's source file; only the types
    in ``df`` are replaced, so sources with other columns land beside each other.  Reading
    ``path`` back discovers ``event_type`` as a partition column."""
    out = df.withColumn("event_type", event_type_of(source_name(F.col("_metadata.file_path"))))
    # rebalance: a few well-sized files per type instead of one per type per task
    (out.hint("rebalance", "event_type").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_type").format(fmt).save(path))
    return path


def read_landed(spark: SparkSession, path: str, event_type: str, schema: T.StructType, fmt: str = "parquet",
                loaded_at: str | None = None) -> DataFrame:
    """Rows of one event type with the declared columns and provenance: the filter on the folder
    column leaves the other types' files unopened."""
    landed = T.StructType([*schema.fields, T.StructField("event_type", T.StringType())])
    rows = spark.read.schema(landed).format(fmt).load(path).where(F.col("event_type") == event_type)
    return rows.select(*schema.fieldNames(), "event_type", F.lit(loaded_at or load_stamp()).alias("_loaded_at"),
                       F.col("_metadata.file_name").alias("_source_file"))
