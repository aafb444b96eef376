"""Features the design specifies beyond the base table (24 h window, recency,
no-review rate, geographic velocity, approval latency) and the seed lookups
(payment-method risk, category prior, risk tier)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.functions.columns import hours_between, tier_label, year_month
from vantage.functions.fixed import IMPLAUSIBLE_SPEED_KMH, UNKNOWN_MERCHANT, VELOCITY_WINDOWS_HOURS
from vantage.operators.pit import Feature, floor_unit, point_in_time_features
from vantage.operators.relational import keep_first, range_lookup
from vantage.sources.seeds import seed_frame


def previous_event_ts(df: DataFrame, entity: str, ts: str, tiebreak: str,
                      bucket: str = "day", out: str = "prev_ts") -> DataFrame:
    """(tiebreak, previous timestamp of the entity in ``(ts, tiebreak)`` order).

    Skew-split lag on these three columns alone: rows are dealt out and windowed per
    ``(entity, time bucket)``, so one hot entity spreads over many tasks; the first row
    of a bucket takes the last timestamp of the entity's previous non-empty bucket,
    found on the small per-bucket table (rows per entity bounded by the number of
    buckets).  The explicit repartition keeps an earlier partitioning by the entity
    alone from being reused for the window.
    """
    b = df.select(entity, ts, tiebreak).withColumn("_bucket", floor_unit(F.col(ts), bucket))
    last = (b.groupBy(entity, "_bucket").agg(F.max(ts).alias("_bucket_last"))
              .withColumn("_carry", F.lag("_bucket_last").over(Window.partitionBy(entity).orderBy("_bucket")))
              .select(entity, "_bucket", "_carry"))
    w = Window.partitionBy(entity, "_bucket").orderBy(F.col(ts).asc_nulls_last(), F.col(tiebreak).asc_nulls_last())
    inner = b.repartition(entity, "_bucket").withColumn("_lag", F.lag(ts).over(w))
    return (inner.join(last, [entity, "_bucket"], "left")
                 .select(tiebreak, F.coalesce(F.col("_lag"), F.col("_carry")).alias(out)))


def order_velocity(enriched: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Per order: hours since the customer's previous order and the implied
    speed ``distance / hours`` (NULL for the first order or a zero gap).  ``orders``
    (the silver orders) spares the lag the joins of the enriched table."""
    known = F.col("customer_unique_id").isNotNull() & F.col("order_purchase_ts").isNotNull()
    prev = previous_event_ts((enriched if orders is None else orders).where(known),
                             "customer_unique_id", "order_purchase_ts", "order_id")
    hours = hours_between("prev_ts", "order_purchase_ts")
    return (enriched.where(known).join(prev, "order_id", "left")
                .withColumn("hours_since_prev_order", hours)
                .withColumn("velocity_kmh", F.try_divide(F.col("customer_seller_distance_km"),
                                                         F.nullif(F.col("hours_since_prev_order"), F.lit(0.0))))
                .drop("prev_ts"))


def extended_features(speed_limit: float = IMPLAUSIBLE_SPEED_KMH,
                      hours: Sequence[int] = VELOCITY_WINDOWS_HOURS) -> list[Feature]:
    delivered = F.col("order_status") == "delivered"
    return [
        *(Feature(f"orders_last_{h}h", "count", "order_id", window=f"{h} hours") for h in hours),
        Feature("days_since_last_order", "days_since_max"),
        Feature("no_review_on_delivered_rate", "rate", "order_id",
                where=F.col("is_no_review_delivered"), den_where=delivered),
        Feature("max_geographic_velocity_kmh", "max", "velocity_kmh"),
        Feature("implausible_velocity_orders", "count", "order_id",
                where=F.col("velocity_kmh") > F.lit(float(speed_limit))),
        Feature("avg_hours_purchase_to_approval", "avg", "hours_to_approval"),
    ]


EXTENDED_COLUMNS = ["customer_unique_id", "snapshot_date", *(f"orders_last_{h}h" for h in VELOCITY_WINDOWS_HOURS),
                    "days_since_last_order",
                    "no_review_on_delivered_rate", "max_geographic_velocity_kmh",
                    "implausible_velocity_orders", "avg_hours_purchase_to_approval"]


def avg_hours(start: str, end: str):
    """Column of hours from ``start`` to ``end`` for an ``avg`` feature."""
    return hours_between(start, end)


def fct_extended_features(enriched: DataFrame, lead: str = "1 month", orders: DataFrame | None = None) -> DataFrame:
    facts = (order_velocity(enriched, orders)
             .withColumn("hours_to_approval", avg_hours("order_purchase_ts", "order_approved_ts")))
    return point_in_time_features(facts, "customer_unique_id", "order_purchase_ts", extended_features(),
                                  unit="month", lead=lead).select(*EXTENDED_COLUMNS)


# ----------------------------------------------------------------- seeds

def payment_risk(enriched: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """Per order: primary payment type and its base risk score (``seed``: as read from
    its file; else the fixed rows).  Spark knows a seed's size and broadcasts it by that."""
    seed = seed_frame(enriched.sparkSession, "payment_method_risk") if seed is None else seed
    s = seed.select(F.col("payment_type").alias("primary_payment_type"),
                    F.col("base_risk_score").alias("payment_method_risk_score"))
    return enriched.select("order_id", "primary_payment_type").join(s, "primary_payment_type", "left")


def category_prior(items: DataFrame, products: DataFrame, translation: DataFrame,
                   seed: DataFrame | None = None) -> DataFrame:
    """Per order: item count, items with a known prior, max and mean category prior.

    product -> category -> English name -> prior.  Products, the translation and the seed
    are dimension tables: Spark broadcasts them by their measured size.
    """
    seed = seed_frame(items.sparkSession, "category_risk_priors") if seed is None else seed
    cat = (products.select("product_id", "product_category_name")
                   .join(translation.select("product_category_name", "product_category_name_english"),
                         "product_category_name", "left")
                   .join(seed.select("product_category_name_english", "fraud_prior"),
                         "product_category_name_english", "left")
                   .select("product_id", "fraud_prior"))
    return (items.select("order_id", "product_id").join(cat, "product_id", "left")
                 .groupBy("order_id")
                 .agg(F.count(F.lit(1)).alias("items"),
                      F.count("fraud_prior").alias("items_with_prior"),
                      F.max("fraud_prior").alias("max_category_prior"),
                      F.avg("fraud_prior").alias("avg_category_prior")))


def score_tiers(df: DataFrame, score: str, seed: DataFrame | None = None) -> DataFrame:
    """Tier and action of a 0..1 score by range join ``[lower, upper)`` against
    the risk-threshold seed, plus the same label computed as a column."""
    tiers = seed_frame(df.sparkSession, "risk_thresholds") if seed is None else seed
    out = range_lookup(df, score, tiers, "lower_bound_inclusive", "upper_bound_exclusive")
    return (out.drop("lower_bound_inclusive", "upper_bound_exclusive")
               .withColumn("tier_label", tier_label(score)))


# ----------------------------------------------------------------- bronze

def orders_with_merchant(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Raw orders plus tenant (seller of the first item, else a fixed
    'unknown' value) and purchase month ``YYYY-MM``."""
    first = keep_first(items.select("order_id", "order_item_id", "seller_id"), ["order_id"],
                       [F.col("order_item_id").asc_nulls_last(), F.col("seller_id").asc_nulls_last()])
    fs = first.select(F.col("order_id").alias("_oid"), F.col("seller_id").cast("string").alias("_merchant"))
    return (orders.join(fs, orders["order_id"] == fs["_oid"], "left")
                  .withColumn("merchant_id", F.coalesce(F.col("_merchant"), F.lit(UNKNOWN_MERCHANT)))
                  .withColumn("partition_month", year_month(F.to_date(F.col("order_purchase_timestamp"))))
                  .drop("_oid", "_merchant"))
