"""Incremental ingest that follows changed files.

A file stream reads a path once, so a file that is delivered again under its name is missed.
Here the landing folder's listing (path, length, modification time; no contents are read) is
compared with a ledger of the file versions that count.  New versions become events, a small
Parquet file a run; a Structured Streaming query over the events, with its checkpoint as cursor,
hands them to ``foreachBatch``, which reads those files and writes their rows under
``file=.../version=...``.  Only then the batch's versions enter the ledger.

Readers join the stored rows with the ledger's latest version of each file, which prunes folders.
So a batch's files appear at once, a changed file's rows are replaced, a file that became empty
has none, and what a failed batch wrote is not seen.  Every write of a batch overwrites its own
folders alone, so a batch that is tried again gives the same table.

A file that changes while it is read counts from the next run; one that was removed keeps its
last rows, as in an append-only load.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.streaming.ingest import CSV_OPTIONS

EVENT = "path string, length long, modified timestamp, version string"
LEDGER = EVENT + ", rows long, batch long"


def _version() -> F.Column:
    """Name of a file's state, the same in the listing and in the rows read from the file."""
    m = F.col("_metadata")
    return F.sha2(F.concat_ws("|", m["file_path"], m["file_size"].cast("string"),
                              F.unix_micros(m["file_modification_time"]).cast("string")), 256).substr(1, 24)


def list_files(spark: SparkSession, landing: str) -> DataFrame:
    """(path, length, modified, version) of the landed files, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    return files.select("path", "length", F.col("modificationTime").alias("modified"), _version().alias("version"))


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """The version of each file that counts: the one of the latest batch."""
    if not _exists(spark, f"{table}/ledger"):
        return spark.createDataFrame([], LEDGER)
    kept = spark.read.schema(LEDGER).parquet(f"{table}/ledger")
    return kept.groupBy("path").agg(F.max_by(F.struct(*(c for c in kept.columns if c != "path")), "batch").alias("last")).select(
        "path", "last.*")


def current_rows(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Rows of the file versions that count, with ``_source_file``."""
    stored = T.StructType([*schema.fields, T.StructField("_source_file", T.StringType()), T.StructField("version", T.StringType())])
    if not _exists(spark, f"{table}/rows"):
        return spark.createDataFrame([], stored).drop("version")
    rows = spark.read.schema(stored).parquet(f"{table}/rows")
    counts = ledger(spark, table).where("rows > 0").select("version")  # a filter: Spark prunes folders by the join
    return rows.join(counts, "version").select(*schema.fieldNames(), "_source_file")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def upsert_files(spark: SparkSession, landing: str, schema: T.StructType, table: str, checkpoint: str, fmt: str = "csv",
                 options: dict | None = None, gate: Callable[[DataFrame], None] | None = None) -> dict:
    """Bring ``table`` up to the files in ``landing``; returns the files and rows that were taken.

    ``gate`` gets a batch's rows as stored, before they count: what it raises ends the run,
    leaves the table as it was, and the next run tries the batch again."""
    events = f"{table}/events"
    new = list_files(spark, landing).join(ledger(spark, table).select("path", "version"), ["path", "version"], "left_anti")
    pending = new.join(_announced(spark, events), ["path", "version"], "left_anti")  # by a run that failed
    if not pending.isEmpty():
        pending.repartition(1).write.mode("append").parquet(events)
    if not _exists(spark, events):
        return {"files": 0, "rows": 0}
    taken = {"files": 0, "rows": 0}
    csv = CSV_OPTIONS if fmt == "csv" else {}

    def merge(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        asked = (batch.select("path", "version").distinct()  # but not what was delivered again since
                 .join(list_files(own, landing), ["path", "version"]).persist())
        paths = sorted(r.path for r in asked.select("path").collect())  # the files of one batch
        if not paths:
            return
        read = own.read.schema(schema).format(fmt).options(**csv, **(options or {})).load(paths)
        name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # given as part of a URI
        rows = read.select(*schema.fieldNames(), name.alias("_source_file"), _version().alias("version"))
        seen = Observation()
        (rows.observe(seen, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{table}/rows"))
        stored = own.read.schema(rows.schema).parquet(f"{table}/rows").join(asked.select("version"), "version")
        if gate is not None:
            gate(stored.select(*schema.fieldNames(), "_source_file"))
        counted = stored.groupBy("version").agg(F.count(F.lit(1)).alias("rows"))
        entry = asked.join(counted, "version", "left").select(
            "path", "length", "modified", "version", F.coalesce("rows", F.lit(0)).alias("rows"), F.lit(number).cast("long").alias("batch"))
        (entry.repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
         .parquet(f"{table}/ledger"))
        taken["files"] += len(paths)
        taken["rows"] += seen.get["rows"]
        asked.unpersist()

    query = (spark.readStream.schema(EVENT).parquet(events).writeStream.foreachBatch(merge)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .queryName(f"upsert-{uuid.uuid4().hex[:8]}").start())
    query.awaitTermination()
    return taken


def _announced(spark: SparkSession, events: str) -> DataFrame:
    """Versions that have an event already."""
    if not _exists(spark, events):
        return spark.createDataFrame([], EVENT).select("path", "version")
    return spark.read.schema(EVENT).parquet(events).select("path", "version")


def land_files(df: DataFrame, landing: str, name: str, names: list[str]) -> None:
    """Deliver one CSV file for each of ``names`` (values of the column ``name``), in place of an
    earlier one; a name without rows gets a file with the header alone."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    staged = f"{landing.rstrip('/')}-staged-{uuid.uuid4().hex[:8]}"
    (df.where(F.col(name).isin(names)).repartition(name).write.partitionBy(name).option("header", True)
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(staged))
    fs = path(landing).getFileSystem(conf)
    fs.mkdirs(path(landing))
    header = ",".join(c for c in df.columns if c != name) + "\n"
    for n in names:
        target, made = path(f"{landing}/{n}.csv"), fs.globStatus(path(f"{staged}/{name}={n}/part-*.csv"))
        if made:
            fs.delete(target, False)
            fs.rename(made[0].getPath(), target)
        else:
            out = fs.create(target, True)
            out.write(header.encode())
            out.close()


def demo_changed_orders(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Orders in four files.  Three arrive; then one of them comes again changed and one
    empty, and the fourth arrives: a run over these is refused by its gate, which leaves the
    table as it was, and tried again.  Returns the rows that count."""
    from vantage.sources.raw import SCHEMAS
    from vantage.sources.tpch import raw_orders

    landing, table, ckpt = f"{root}/landing", f"{root}/orders", f"{root}/_checkpoint"
    orders = raw_orders(spark, sf_dir).withColumn("file", F.concat(F.lit("orders-"), (F.col("order_id") % 4).cast("string")))
    run = lambda **more: upsert_files(spark, landing, SCHEMAS["orders"], table, ckpt, **more)
    rows = lambda: current_rows(spark, table, SCHEMAS["orders"])
    land_files(orders, landing, "file", ["orders-0", "orders-1", "orders-2"])
    first = run()
    again = F.when(F.expr("order_id % 4 = 1 AND order_status = 'processing'"), "shipped").otherwise(F.col("order_status"))
    changed = (orders.where("order_id % 4 = 3 OR (order_id % 4 = 1 AND order_status != 'canceled')")
               .withColumn("order_status", again))
    land_files(changed, landing, "file", ["orders-0", "orders-1", "orders-3"])

    def refuse(new: DataFrame) -> None:
        raise RuntimeError(f"refused: {new.columns}")
    try:
        run(gate=refuse)
    except StreamingQueryException:
        pass
    if rows().count() != first["rows"]:
        raise AssertionError("a refused batch changed the table")
    second = run()
    if (first["files"], second["files"], run()["files"]) != (3, 3, 0):
        raise AssertionError(f"files taken: {first}, {second}")
    stamps = [c for c in SCHEMAS["orders"].fieldNames() if c.startswith("order_") and c not in ("order_id", "order_status")]
    return rows().select(F.col("order_id").cast("long").alias("order_id"), F.col("customer_id").cast("long").alias("customer_id"),
                         "order_status", *(F.col(c).try_cast("timestamp_ntz").alias(c) for c in stamps), "_source_file")
