"""Seeds: three small versioned reference tables.

They can be read from their CSV files (``read_seed``) or built from the fixed
values (``seed_frame``); either frame can be given to the lookups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vantage.functions.fixed import CATEGORY_RISK_PRIORS, PAYMENT_METHOD_RISK, RISK_TIERS

SEED_SCHEMAS = {
    "payment_method_risk": T.StructType([
        T.StructField("payment_type", T.StringType()),
        T.StructField("base_risk_score", T.DoubleType()),
        T.StructField("rationale", T.StringType()),
    ]),
    "risk_thresholds": T.StructType([
        T.StructField("tier", T.StringType()),
        T.StructField("lower_bound_inclusive", T.DoubleType()),
        T.StructField("upper_bound_exclusive", T.DoubleType()),
        T.StructField("action", T.StringType()),
    ]),
    "category_risk_priors": T.StructType([
        T.StructField("product_category_name_english", T.StringType()),
        T.StructField("fraud_prior", T.DoubleType()),
        T.StructField("evidence", T.StringType()),
    ]),
}

SEED_ROWS = {
    "payment_method_risk": PAYMENT_METHOD_RISK,
    "risk_thresholds": RISK_TIERS,
    "category_risk_priors": CATEGORY_RISK_PRIORS,
}


def seed_frame(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(list(SEED_ROWS[name]), SEED_SCHEMAS[name])


def read_seed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read ``root/<name>.csv`` with the declared schema (header, quoted text)."""
    return (spark.read.schema(SEED_SCHEMAS[name])
            .option("header", True).option("multiLine", True).option("escape", '"')
            .csv(f"{root.rstrip('/')}/{name}.csv"))


def all_seeds(spark: SparkSession, root: str | None = None) -> dict[str, DataFrame]:
    if root:
        return {n: read_seed(spark, root, n) for n in SEED_SCHEMAS}
    return {n: seed_frame(spark, n) for n in SEED_SCHEMAS}
