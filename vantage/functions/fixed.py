"""Fixed values the results depend on.

These must equal the values the original pipeline uses, so they are written
out plainly, in natural order, in one place.
"""

# ---- fixed values -----------------------------------------------------------

EARTH_RADIUS_KM = 6371.0

ORDER_STATUSES = ["created", "approved", "invoiced", "shipped", "delivered",
                  "unavailable", "canceled", "processing"]

PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]

REVIEW_SCORES = [1, 2, 3, 4, 5]

LOW_REVIEW_THRESHOLD = 2

VELOCITY_WINDOWS_HOURS = [1, 24, 168]

IMPLAUSIBLE_SPEED_KMH = 800
# risk_thresholds seed: tier, lower bound (inclusive), upper bound (exclusive), action
RISK_TIERS = [
    ("low", 0.00, 0.30, "auto_approve"),
    ("medium", 0.30, 0.60, "monitor"),
    ("high", 0.60, 0.85, "manual_review"),
    ("critical", 0.85, 1.01, "block_and_investigate"),
]

# payment_method_risk seed: payment_type, base_risk_score, rationale
PAYMENT_METHOD_RISK = [
    ("credit_card", 0.70, "CNP fraud is overwhelmingly card-driven; highest base risk"),
    ("debit_card", 0.30, "Lower fraud rate than credit because of immediate fund check"),
    ("boleto", 0.20, "Brazilian bank slip, paid offline at agency, near-zero CNP fraud"),
    ("voucher", 0.40, "Promotional vouchers attract account-farming and abuse rings"),
    ("not_defined", 0.60, "Missing payment type is itself a quality signal — treat as elevated"),
]

# category_risk_priors seed: product_category_name_english, fraud_prior, evidence
CATEGORY_RISK_PRIORS = [
    ("electronics", 0.45, "High resale value plus small form factor — top INR target"),
    ("computers_accessories", 0.42, "Same as electronics"),
    ("telephony", 0.40, "Mobile phones are top stolen-card target globally"),
    ("watches_gifts", 0.38, "Luxury resale value; common in friendly fraud"),
    ("audio", 0.30, "Headphones and speakers; moderate resale value"),
    ("fashion_bags_accessories", 0.25, "Luxury bag resale market drives elevated risk"),
    ("health_beauty", 0.18, "Moderate — diversion and reseller abuse"),
    ("sports_leisure", 0.15, "Moderate baseline"),
    ("toys", 0.12, "Low — seasonal abuse only"),
    ("furniture_decor", 0.10, "Bulky, hard to resell — low fraud rate"),
    ("housewares", 0.08, "Low resale value"),
    ("food", 0.05, "Perishable — near-zero fraud incentive"),
]

# raw CSV file -> raw table name (the nine sources)
SOURCE_FILES = [
    ("olist_customers_dataset.csv", "olist_customers_dataset"),
    ("olist_geolocation_dataset.csv", "olist_geolocation_dataset"),
    ("olist_order_items_dataset.csv", "olist_order_items_dataset"),
    ("olist_order_payments_dataset.csv", "olist_order_payments_dataset"),
    ("olist_order_reviews_dataset.csv", "olist_order_reviews_dataset"),
    ("olist_orders_dataset.csv", "olist_orders_dataset"),
    ("olist_products_dataset.csv", "olist_products_dataset"),
    ("olist_sellers_dataset.csv", "olist_sellers_dataset"),
    ("product_category_name_translation.csv", "product_category_name_translation"),
]

UNKNOWN_MERCHANT = "unknown_merchant"

# ---- end of fixed values ----------------------------------------------------
