"""Raw CSV sources: registry, declared schemas, provenance, input check and
load audit.

Schemas are declared, never inferred: inference reads the whole file twice and
turns zip prefixes such as ``01151`` into integers.  Timestamps of the orders
file stay text here; the silver layer ``try_cast``s them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.functions.fixed import SOURCE_FILES

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


SCHEMAS = {
    "orders": _schema(("order_id", S), ("customer_id", S), ("order_status", S),
                      ("order_purchase_timestamp", S), ("order_approved_at", S),
                      ("order_delivered_carrier_date", S), ("order_delivered_customer_date", S),
                      ("order_estimated_delivery_date", S)),
    "order_items": _schema(("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
                           ("shipping_limit_date", T.TimestampNTZType()), ("price", D), ("freight_value", D)),
    "order_payments": _schema(("order_id", S), ("payment_sequential", I), ("payment_type", S),
                              ("payment_installments", I), ("payment_value", D)),
    "order_reviews": _schema(("review_id", S), ("order_id", S), ("review_score", I),
                             ("review_comment_title", S), ("review_comment_message", S),
                             ("review_creation_date", S), ("review_answer_timestamp", T.TimestampNTZType())),
    "customers": _schema(("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
                         ("customer_city", S), ("customer_state", S)),
    "sellers": _schema(("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S)),
    "products": _schema(("product_id", S), ("product_category_name", S), ("product_name_lenght", I),
                        ("product_description_lenght", I), ("product_photos_qty", I), ("product_weight_g", D),
                        ("product_length_cm", D), ("product_height_cm", D), ("product_width_cm", D)),
    "geolocation": _schema(("geolocation_zip_code_prefix", S), ("geolocation_lat", D), ("geolocation_lng", D),
                           ("geolocation_city", S), ("geolocation_state", S)),
    "category_translation": _schema(("product_category_name", S), ("product_category_name_english", S)),
}

# short source name -> position in the fixed file list
_ORDER = ["customers", "geolocation", "order_items", "order_payments", "order_reviews",
          "orders", "products", "sellers", "category_translation"]


@dataclass(frozen=True)
class SourceSpec:
    name: str
    file: str
    table: str
    schema: T.StructType


SOURCES: dict[str, SourceSpec] = {
    name: SourceSpec(name, f, t, SCHEMAS[name]) for name, (f, t) in zip(_ORDER, SOURCE_FILES)
}


#: sources with quoted line breaks; the option makes a file one task, so no other has it
MULTI_LINE = frozenset({"order_reviews"})


def read_source(spark: SparkSession, root: str, name: str, fmt: str = "csv") -> DataFrame:
    """Scan one source under ``root`` (local path, HDFS or object store URI): a file, or a
    folder of part files of that name.

    CSV columns are bound by the names in the header, whatever their order; a missing one
    is an error, as is a part file with another header.  Everything is read as text and
    cast to the declared type; a value that does not parse fails the query.
    Parquet: ``root/<table>`` directory, same column names.
    """
    spec = SOURCES[name]
    base = root.rstrip("/")
    if fmt == "parquet":
        return spark.read.schema(spec.schema).parquet(f"{base}/{spec.table}")
    if fmt != "csv":
        raise ValueError(f"unsupported format {fmt!r}")
    path = f"{base}/{spec.file}"
    options = {"header": "true", "escape": '"', "enforceSchema": "false", "mode": "FAILFAST",
               "multiLine": str(name in MULTI_LINE).lower()}
    held = spark.read.options(**options).csv(path).columns  # the header alone
    if missing := [f for f in spec.schema.fieldNames() if f not in held]:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    text = _schema(*((c, S) for c in held))
    raw = spark.read.schema(text).options(**options).csv(path)
    return raw.select(*(_typed(f, name) for f in spec.schema.fields), F.col("_metadata.file_name").alias(FILE))


#: file name of each row, carried beside the declared columns
FILE = "_source_file"


def _typed(field: T.StructField, source: str) -> Column:
    """The declared type of a text column; a value that does not parse raises."""
    value = F.col(field.name)
    if field.dataType == S:
        return value
    cast = value.try_cast(field.dataType)
    bad = F.raise_error(F.concat(F.lit(f"{source}.{field.name}: not a {field.dataType.simpleString()}: "), value))
    return F.when(value.isNotNull() & cast.isNull(), bad.cast(field.dataType)).otherwise(cast).alias(field.name)


def load_stamp() -> str:
    """One ISO UTC stamp per run; every table of the run carries the same value."""
    return datetime.now(UTC).isoformat()


def with_provenance(df: DataFrame, loaded_at: str) -> DataFrame:
    """Append ``_loaded_at`` (the run's stamp) and ``_source_file`` (file name
    of each row, from the hidden ``_metadata`` column of file sources)."""
    name = F.col(FILE) if FILE in df.columns else F.col("_metadata.file_name")
    return df.select(*(c for c in df.columns if c != FILE), F.lit(loaded_at).alias("_loaded_at"), name.alias(FILE))


def missing_sources(spark: SparkSession, root: str, names=None) -> list[str]:
    """File names of registered sources absent under ``root`` (Hadoop FS check,
    works for any scheme); call before starting any job."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for n in names or SOURCES:
        p = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{SOURCES[n].file}")
        if not p.getFileSystem(conf).exists(p):
            missing.append(SOURCES[n].file)
    return missing


def load_audit(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count per loaded table in one job: ``(table_name, row_count)``."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_raw(spark: SparkSession, root: str, fmt: str = "csv", loaded_at: str | None = None,
             names=None) -> dict[str, DataFrame]:
    """All (or ``names``) sources with provenance; fails fast on missing files."""
    if fmt == "csv":
        missing = missing_sources(spark, root, names)
        if missing:
            raise FileNotFoundError(f"{len(missing)} source file(s) missing under {root}: {missing}")
    stamp = loaded_at or load_stamp()
    return {n: with_provenance(read_source(spark, root, n, fmt), stamp) for n in names or SOURCES}
