"""Test-result documents: nested JSON ``{"results": [{unique_id, status,
execution_time, message}, ...]}`` flattened to one row per test."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.functions.columns import last_segment

RESULT = T.StructType([
    T.StructField("unique_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("execution_time", T.DoubleType()),
    T.StructField("message", T.StringType()),
])
DOCUMENT = T.StructType([T.StructField("results", T.ArrayType(RESULT))])

OUT = T.StructType([
    T.StructField("test_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("execution_time", T.DoubleType()),
    T.StructField("message", T.StringType()),
])


def test_rows(results: DataFrame) -> DataFrame:
    """Flat result rows -> report rows: keep ``test.*`` ids, name = last dot
    segment, time rounded to 3 (0 when missing), message cut to 200 chars
    (NULL -> ''), status 'unknown' when missing."""
    return (results.where(F.col("unique_id").startswith("test."))
            .select(last_segment("unique_id").alias("test_name"),
                    F.coalesce(F.col("status"), F.lit("unknown")).alias("status"),
                    F.round(F.coalesce(F.col("execution_time"), F.lit(0.0)), 3).alias("execution_time"),
                    F.substring(F.coalesce(F.col("message"), F.lit("")), 1, 200).alias("message")))


def read_test_results(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Read result documents under ``path``; a missing path gives an empty
    frame with the fixed columns.  Documents of one line each (``multi_line=False``)
    are read in splits; one that spans lines is a file and a task of its own."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], OUT)
    docs = spark.read.schema(DOCUMENT).option("multiLine", multi_line).json(path)
    return test_rows(docs.select(F.explode("results").alias("r")).select("r.*"))
