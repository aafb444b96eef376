"""Analyst and health queries over the layers (dashboard and ad-hoc SQL needs).

All are DataFrame functions; top-k queries keep a limit because the limit is
the feature, and every ordering carries a key tie-break so results are stable.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions.columns import percent, round_half_away


def cancellation_rate_by_state(orders: DataFrame, customers: DataFrame, top: int = 20) -> DataFrame:
    """Orders, cancellations and cancel-rate percent per customer state, top ``top``."""
    canceled = F.when(F.col("order_status") == "canceled", 1).otherwise(0)
    agg = (orders.select("customer_id", "order_status")
                 .join(customers.select("customer_id", "customer_state"), "customer_id", "inner")
                 .groupBy("customer_state")
                 .agg(F.count(F.lit(1)).alias("total_orders"), F.sum(canceled).alias("canceled")))
    return (agg.withColumn("cancel_rate_pct", percent("canceled", "total_orders"))
               .orderBy(F.col("cancel_rate_pct").desc_nulls_last(), F.col("customer_state").asc_nulls_last())
               .limit(top))


def low_review_on_delivered(orders: DataFrame, reviews: DataFrame, low: int = 2) -> DataFrame:
    """Delivered orders joined to their reviews: count, low reviews, percent."""
    lowc = F.when(F.col("review_score") <= low, 1).otherwise(0)
    j = (orders.where(F.col("order_status") == "delivered").select("order_id")
               .join(reviews.select("order_id", "review_score"), "order_id", "inner"))
    return (j.agg(F.count(F.lit(1)).alias("delivered_orders"), F.sum(lowc).alias("low_review"))
             .withColumn("inr_proxy_rate_pct", percent("low_review", "delivered_orders")))


def top_risky_customers(latest: DataFrame, limit: int = 50, min_orders: int = 2) -> DataFrame:
    """Top ``limit`` customers by cancel + low-review rate; ``latest`` holds the rows of
    the latest snapshot (``snapshots="latest"``)."""
    limit = int(limit)
    cur = latest.where(F.col("total_orders_lifetime") >= min_orders)
    return (cur.orderBy((F.col("cancel_rate_lifetime") + F.col("low_review_on_delivered_rate")).desc_nulls_last(),
                        F.col("total_orders_lifetime").desc_nulls_last(),
                        F.col("customer_unique_id").asc_nulls_last())
               .limit(limit)
               .select("customer_unique_id", "customer_state", "total_orders_lifetime", "orders_last_30d",
                       round_half_away("cancel_rate_lifetime", 3).alias("cancel_rate"),
                       F.col("cancel_post_approval_count_30d").alias("cancel_30d"),
                       round_half_away("avg_review_score", 2).alias("avg_review"),
                       round_half_away("low_review_on_delivered_rate", 3).alias("low_review_rate"),
                       round_half_away("avg_customer_seller_distance_km", 0).alias("avg_dist_km"),
                       F.col("distinct_shipping_states_30d").alias("states_30d")))


def feature_store_summary(fct: DataFrame) -> DataFrame:
    """Seven KPIs of the feature table (one row)."""
    return fct.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        F.count_distinct("snapshot_date").alias("snapshots"),
        F.min("snapshot_date").alias("first_snapshot"),
        F.max("snapshot_date").alias("last_snapshot"),
        round_half_away(F.avg("cancel_rate_lifetime"), 4).alias("avg_cancel_rate"),
        round_half_away(F.avg("low_review_on_delivered_rate"), 4).alias("avg_low_review_rate"),
    )


def orders_overview(stg_orders: DataFrame) -> DataFrame:
    """Six KPIs of the silver orders table (one row)."""
    c = F.when(F.col("is_cancelled_post_approval"), 1).otherwise(0)
    return (stg_orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        F.sum(c).alias("cancel_post_approval"),
        F.min("order_purchase_ts").alias("first_order_ts"),
        F.max("order_purchase_ts").alias("last_order_ts"))
        .withColumn("pct_cancel_post_approval", percent("cancel_post_approval", "total_orders"))
        .select("total_orders", "unique_customers", "cancel_post_approval", "pct_cancel_post_approval",
                "first_order_ts", "last_order_ts"))


def risk_distribution(latest: DataFrame, min_orders: int = 1) -> DataFrame:
    """Cancel rate, low-review rate and order count per customer at the latest snapshot."""
    return (latest.where(F.col("total_orders_lifetime") >= min_orders)
            .select("cancel_rate_lifetime", "low_review_on_delivered_rate", "total_orders_lifetime"))


def layer_row_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Exact row count of every table in every layer, sorted by layer and name.

    One ``agg(count)`` per table unioned together: each count is a separate scan
    with map-side partial counts; the union holds one row per table.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
             for layer, tables in layers.items() for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("layer", "table_name")
