"""The declared data-quality suites of each layer, as ``Check`` lists.

Table names are the layer names used by the pipeline: bronze tables carry the
source names (``orders``, ``order_items`` ...), silver the ``stg_*`` names,
gold ``int_orders_enriched`` / ``fct_customer_return_risk_features``, seeds
their seed names.
"""

from __future__ import annotations

from vantage.functions.fixed import ORDER_STATUSES, PAYMENT_TYPES, RISK_TIERS, REVIEW_SCORES
from vantage.operators.quality import ERROR, Check


def bronze_suite() -> list[Check]:
    return [
        Check("orders", "unique", "order_id"),
        Check("orders", "not_null", "order_id"),
        Check("orders", "not_null", "customer_id"),
        Check("orders", "relationships", "customer_id", parent="customers", parent_field="customer_id"),
        Check("orders", "accepted_values", "order_status", values=tuple(ORDER_STATUSES)),
        Check("orders", "not_null", "order_purchase_timestamp"),
        Check("order_items", "not_null", "order_id"),
        Check("order_items", "relationships", "order_id", parent="orders", parent_field="order_id"),
        Check("order_items", "not_null", "product_id"),
        Check("order_items", "not_null", "seller_id"),
        Check("order_items", "not_null", "price"),
        Check("order_items", "expression_is_true", "price", expression=">= 0"),
        Check("order_payments", "not_null", "order_id"),
        Check("order_payments", "relationships", "order_id", parent="orders", parent_field="order_id"),
        Check("order_payments", "accepted_values", "payment_type", values=tuple(PAYMENT_TYPES)),
        Check("order_payments", "expression_is_true", "payment_value", expression=">= 0"),
        Check("order_reviews", "not_null", "review_id"),
        Check("order_reviews", "not_null", "order_id"),
        Check("order_reviews", "relationships", "order_id", parent="orders", parent_field="order_id"),
        Check("order_reviews", "accepted_values", "review_score", values=tuple(REVIEW_SCORES)),
        Check("customers", "unique", "customer_id"),
        Check("customers", "not_null", "customer_id"),
        Check("customers", "not_null", "customer_unique_id"),
        Check("sellers", "unique", "seller_id"),
        Check("sellers", "not_null", "seller_id"),
        Check("products", "unique", "product_id"),
        Check("products", "not_null", "product_id"),
        Check("category_translation", "unique", "product_category_name"),
        Check("category_translation", "not_null", "product_category_name"),
        Check("category_translation", "not_null", "product_category_name_english"),
    ]


def silver_suite() -> list[Check]:
    return [
        Check("stg_orders", "not_null", "order_id"),
        Check("stg_orders", "unique", "order_id"),
        Check("stg_orders", "not_null", "customer_unique_id"),
        Check("stg_orders", "accepted_values", "order_status", values=tuple(ORDER_STATUSES)),
        Check("stg_customers", "not_null", "customer_unique_id"),
        Check("stg_customers", "unique", "customer_unique_id"),
        Check("stg_order_items", "not_null", "order_id"),
        Check("stg_order_items", "expression_is_true", "price", expression=">= 0"),
        Check("stg_order_payments", "not_null", "order_id"),
        Check("stg_order_reviews", "not_null", "order_id"),
        Check("stg_order_reviews", "unique", "order_id"),
        Check("stg_order_reviews", "accepted_values", "review_score", values=tuple(REVIEW_SCORES)),
    ]


def gold_suite() -> list[Check]:
    fct = "fct_customer_return_risk_features"
    return [
        Check("int_orders_enriched", "not_null", "order_id"),
        Check("int_orders_enriched", "unique", "order_id", severity=ERROR),
        Check("int_orders_enriched", "not_null", "customer_unique_id"),
        Check("int_orders_enriched", "expression_is_true", "order_value", expression=">= 0"),
        Check(fct, "not_null", "customer_unique_id"),
        Check(fct, "not_null", "snapshot_date"),
        Check(fct, "expression_is_true", "total_orders_lifetime", expression=">= 0"),
        Check(fct, "expression_is_true", "cancel_rate_lifetime", expression="between 0 and 1"),
        Check(fct, "expression_is_true", "low_review_on_delivered_rate", expression="between 0 and 1"),
        Check(fct, "unique_combination", columns=("customer_unique_id", "snapshot_date")),
    ]


def seed_suite() -> list[Check]:
    return [
        Check("payment_method_risk", "unique", "payment_type"),
        Check("payment_method_risk", "not_null", "payment_type"),
        Check("payment_method_risk", "not_null", "base_risk_score"),
        Check("payment_method_risk", "expression_is_true", "base_risk_score", expression="between 0 and 1"),
        Check("risk_thresholds", "unique", "tier"),
        Check("risk_thresholds", "not_null", "tier"),
        Check("risk_thresholds", "accepted_values", "tier", values=tuple(t[0] for t in RISK_TIERS)),
        Check("risk_thresholds", "accepted_values", "action", values=tuple(t[3] for t in RISK_TIERS)),
        Check("category_risk_priors", "unique", "product_category_name_english"),
        Check("category_risk_priors", "not_null", "product_category_name_english"),
        Check("category_risk_priors", "not_null", "fraud_prior"),
        Check("category_risk_priors", "expression_is_true", "fraud_prior", expression="between 0 and 1"),
    ]
