"""Gold layer: the enriched order (one row per order) and the point-in-time
customer feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions.columns import flag, haversine_km
from vantage.functions.fixed import LOW_REVIEW_THRESHOLD
from vantage.operators.pit import Feature, point_in_time_features, spine_bounds
from vantage.operators.relational import arg_max, arg_min


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Per order: total value, max installments, slice count, type of the largest slice."""
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("order_value"),
        F.max("payment_installments").alias("max_installments"),
        F.count(F.lit(1)).alias("payment_slices"),
        arg_max("payment_type", "payment_value").alias("primary_payment_type"),
    )


def primary_seller(items: DataFrame) -> DataFrame:
    """Per order: seller of the lowest item index (ties to the smallest seller)."""
    return items.groupBy("order_id").agg(arg_min("seller_id", "order_item_id").alias("primary_seller_id"))


def customer_geo(stg_customers: DataFrame, geo: DataFrame) -> DataFrame:
    g = geo.select(F.col("zip_code_prefix"), F.col("lat").alias("cust_lat"), F.col("lng").alias("cust_lng"))
    return (stg_customers.join(g, stg_customers["customer_zip_code_prefix"] == g["zip_code_prefix"], "left")
            .select("customer_unique_id", "zip_code_prefix", "cust_lat", "cust_lng"))


def seller_geo(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    g = geo.select(F.col("zip_code_prefix"), F.col("lat").alias("seller_lat"), F.col("lng").alias("seller_lng"))
    return (sellers.join(g, sellers["seller_zip_code_prefix"] == g["zip_code_prefix"], "left")
            .select("seller_id", "seller_lat", "seller_lng"))


def int_orders_enriched(stg_orders: DataFrame, payments: DataFrame, reviews: DataFrame,
                        items: DataFrame, stg_customers: DataFrame, geo: DataFrame,
                        sellers: DataFrame, low_review: int = LOW_REVIEW_THRESHOLD) -> DataFrame:
    """One row per order with payment aggregates, review, primary seller and the
    customer-seller distance (left outer star around the order).

    The three order-keyed sides come out of ``groupBy(order_id)`` / a rank-1
    window, so they are already hash partitioned on ``order_id``; only the order
    side is shuffled for those joins.  The customer's point is joined first, while the
    order's row is narrow: joined last, the whole row is shuffled and sorted by customer.
    The geo sides are zip centroids and the seller table (bounded by the zip and
    seller domains); AQE broadcasts them from their measured size and falls back to a
    shuffle join otherwise.
    """
    p = payments_per_order(payments)
    r = reviews.select("order_id", "review_score")
    i = primary_seller(items)
    cg = customer_geo(stg_customers, geo)
    sg = seller_geo(sellers, geo)
    o = (stg_orders.join(cg, "customer_unique_id", "left")
                   .join(p, "order_id", "left")
                   .join(r, "order_id", "left")
                   .join(i, "order_id", "left")
                   .join(sg, F.col("primary_seller_id") == sg["seller_id"], "left"))
    delivered = F.col("order_status") == "delivered"
    return o.select(
        "order_id", "customer_unique_id", "customer_state", "order_status",
        "order_purchase_ts", "order_approved_ts", "order_delivered_ts",
        "is_cancelled_post_approval",
        F.coalesce(F.col("order_value"), F.lit(0.0)).alias("order_value"),
        "primary_payment_type", "max_installments", "primary_seller_id", "review_score",
        flag(delivered & (F.col("review_score") <= low_review)).alias("is_low_review_delivered"),
        flag(delivered & F.col("review_score").isNull()).alias("is_no_review_delivered"),
        haversine_km("cust_lat", "cust_lng", "seller_lat", "seller_lng").alias("customer_seller_distance_km"),
    )


#: a country's states at most; a table with more fails the query
STATES = 64


def return_risk_features() -> list[Feature]:
    """The feature set of the customer return-risk table."""
    cancelled = F.col("is_cancelled_post_approval")
    return [
        Feature("customer_state", "max", "customer_state", domain=STATES),
        Feature("days_since_first_order", "days_since_min"),
        Feature("total_orders_lifetime", "count", "order_id"),
        Feature("orders_last_30d", "count", "order_id", window="30 days"),
        Feature("orders_last_7d", "count", "order_id", window="7 days"),
        Feature("distinct_sellers_last_7d", "count_distinct", "primary_seller_id", window="7 days"),
        Feature("total_spent_last_30d", "sum", "order_value", window="30 days", default=0.0),
        Feature("cancel_rate_lifetime", "rate", "order_id", where=cancelled),
        Feature("cancel_post_approval_count_30d", "count", "order_id", where=cancelled, window="30 days"),
        Feature("avg_review_score", "avg", "review_score"),
        Feature("low_review_on_delivered_rate", "rate", "order_id",
                where=F.col("is_low_review_delivered"),
                den_where=F.col("order_status") == "delivered"),
        Feature("avg_customer_seller_distance_km", "avg", "customer_seller_distance_km"),
        Feature("distinct_shipping_states_30d", "count_distinct", "customer_state", window="30 days", domain=STATES),
    ]


FEATURE_COLUMNS = [
    "customer_unique_id", "snapshot_date", "customer_state", "days_since_first_order",
    "total_orders_lifetime", "orders_last_30d", "orders_last_7d", "distinct_sellers_last_7d",
    "total_spent_last_30d", "cancel_rate_lifetime", "cancel_post_approval_count_30d",
    "avg_review_score", "low_review_on_delivered_rate", "avg_customer_seller_distance_km",
    "distinct_shipping_states_30d",
]


def fct_customer_return_risk_features(enriched: DataFrame, lead: str = "1 month",
                                      distinct: str = "explode", snapshots: str = "all",
                                      parts: int | None = None) -> DataFrame:
    """Point-in-time features per ``(customer_unique_id, snapshot_date)`` on a
    monthly spine.  ``lead`` is the eligibility look-ahead (``"0 days"`` gives
    the stricter documented rule).  ``parts``: as in ``pit_scale``."""
    cols = ["order_id", "customer_unique_id", "customer_state", "order_status",
            "order_purchase_ts", "is_cancelled_post_approval", "order_value",
            "primary_seller_id", "review_score", "is_low_review_delivered",
            "customer_seller_distance_km"]
    facts = enriched.select(*cols)
    return point_in_time_features(facts, "customer_unique_id", "order_purchase_ts",
                                  return_risk_features(), unit="month", lead=lead,
                                  distinct=distinct, snapshots=snapshots, parts=parts).select(*FEATURE_COLUMNS)


def review_dated_features(enriched: DataFrame, reviews: DataFrame, lead: str = "1 month") -> DataFrame:
    """The feature table with a stricter clock for reviews: a score counts from the day the
    review was written (never before its order), so a review written after a snapshot
    leaves that snapshot's values as they are.

    A reviewed order gives two facts, the order without its score and the score at its own
    time; the spine stays that of the orders."""
    when = F.greatest(F.col("order_purchase_ts"), F.col("review_creation_date").cast("timestamp_ntz"))
    dated = enriched.join(reviews.select("order_id", "review_creation_date"), "order_id", "left")
    names = ["order_id", "customer_unique_id", "customer_state", "order_status", "order_purchase_ts",
             "is_cancelled_post_approval", "order_value", "primary_seller_id", "review_score",
             "is_low_review_delivered", "customer_seller_distance_km"]
    none = lambda c: F.lit(None).cast(enriched.schema[c].dataType).alias(c)
    scores = ("review_score", "is_low_review_delivered")
    placed = [F.lit(True).alias("placed"), *(none(c) if c in scores else F.col(c) for c in names)]
    scored = [F.lit(False).alias("placed"), *(
        when.alias(c) if c == "order_purchase_ts" else F.col(c) if c in (*scores, "customer_unique_id") else none(c)
        for c in names)]
    facts = (dated.select(*placed).unionByName(dated.where("review_score IS NOT NULL").select(*scored))
             .withColumn("fact", F.lit(1)))
    features = [Feature(f.name, "rate", "fact", where=F.col("is_low_review_delivered"),
                        den_where=F.col("placed") & (F.col("order_status") == "delivered"))
                if f.name == "low_review_on_delivered_rate" else
                Feature(f.name, "rate", "fact", where=F.col("is_cancelled_post_approval"), den_where=F.col("placed"))
                if f.name == "cancel_rate_lifetime" else f for f in return_risk_features()]
    bounds = spine_bounds(enriched, "order_purchase_ts", "month")
    return point_in_time_features(facts, "customer_unique_id", "order_purchase_ts", features, unit="month",
                                  lead=lead, bounds=bounds, domain_of=enriched).select(*FEATURE_COLUMNS)
