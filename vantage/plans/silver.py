"""Silver layer: typed, deduplicated tables (one function per table).

Inputs are the raw/bronze frames with the source column names; every function
is a lazy DataFrame so callers decide where to materialise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions.columns import flag
from vantage.operators.relational import centroid, keep_first, keep_latest


def stg_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order (earliest purchase time wins, NULLS LAST), with the
    stable customer identity and the cancelled-after-approval flag."""
    deduped = keep_first(orders, ["order_id"],
                         [F.col("order_purchase_timestamp").asc_nulls_last(),
                          F.col("order_approved_at").asc_nulls_last(),
                          F.col("order_status").asc_nulls_last()])
    cust = customers.select("customer_id", "customer_unique_id", "customer_state",
                            "customer_zip_code_prefix")
    approved = F.col("order_approved_at").try_cast("timestamp_ntz")
    return (deduped.join(cust, "customer_id", "left")
            .select(
                "order_id", "customer_unique_id", "customer_id", "customer_state",
                "customer_zip_code_prefix", "order_status",
                F.col("order_purchase_timestamp").try_cast("timestamp_ntz").alias("order_purchase_ts"),
                approved.alias("order_approved_ts"),
                F.col("order_delivered_customer_date").try_cast("timestamp_ntz").alias("order_delivered_ts"),
                flag((F.col("order_status") == "canceled") & approved.isNotNull())
                .alias("is_cancelled_post_approval"),
            ))


def stg_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per ``customer_unique_id``: zip/state of its latest order
    (NULLS LAST; customers without orders keep a row).

    Only the latest purchase time per ``customer_id`` can decide the ranking, so
    orders are reduced to that (hash aggregate, map-side combine) before the
    join: the join sees one row per customer id instead of one per order.
    """
    last = (orders.groupBy("customer_id")
                  .agg(F.max("order_purchase_timestamp").alias("_last_ts")))
    joined = customers.select("customer_id", "customer_unique_id", "customer_state",
                              "customer_zip_code_prefix").join(last, "customer_id", "left")
    best = keep_latest(joined, ["customer_unique_id"], ["_last_ts"],
                       tiebreak=[F.col("customer_state").desc_nulls_last(),
                                 F.col("customer_zip_code_prefix").desc_nulls_last()])
    return best.select("customer_unique_id", "customer_state", "customer_zip_code_prefix")


def stg_order_items(items: DataFrame) -> DataFrame:
    return items.select(
        "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        "product_id", "seller_id",
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value"),
    )


def stg_order_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "order_id",
        F.col("payment_sequential").cast("int").alias("payment_sequential"),
        "payment_type",
        F.col("payment_installments").cast("int").alias("payment_installments"),
        F.col("payment_value").cast("double").alias("payment_value"),
    )


def stg_order_reviews(reviews: DataFrame) -> DataFrame:
    """Latest review per order (creation date descending, then review id)."""
    latest = keep_latest(reviews, ["order_id"], ["review_creation_date"],
                         tiebreak=[F.col("review_id").desc_nulls_last(),
                                   F.col("review_score").desc_nulls_last()])
    return latest.select(
        "review_id", "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        F.col("review_creation_date").try_cast("date").alias("review_creation_date"),
    )


def stg_geolocation(geo: DataFrame) -> DataFrame:
    """Mean coordinate per zip prefix."""
    return centroid(geo, "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                    out_key="zip_code_prefix")


def build_silver(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_orders": stg_orders(raw["orders"], raw["customers"]),
        "stg_customers": stg_customers(raw["customers"], raw["orders"]),
        "stg_order_items": stg_order_items(raw["order_items"]),
        "stg_order_payments": stg_order_payments(raw["order_payments"]),
        "stg_order_reviews": stg_order_reviews(raw["order_reviews"]),
        "stg_geolocation": stg_geolocation(raw["geolocation"]),
    }
