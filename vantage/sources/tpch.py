"""Role mapping from the TPC-H-like driver tables to the nine raw e-commerce
sources, so the same silver/gold code runs on both.

Every frame here is a projection (plus one union and one distinct) of the
driver tables; nothing is synthesised, so the work grows with the tables.
The mapping is mirrored line by line in ``oracle_sql.py``.

Roles:
  order / customer                    o_orderkey / o_custkey; two custkeys share an identity
  purchase time                       o_orderdate, plus o_orderkey % 24 hours unless o_orderkey % 3 = 0
  repeated orders                     o_orderkey % 50 = 0 once more, two days later, not approved
  status                              F -> canceled, O -> delivered, P -> processing
  approved at                         o_orderdate + 1 day, NULL for priority 5-LOW
  delivered at                        o_orderdate + 7 days when delivered
  item, seller, product               lineitem: l_linenumber, l_suppkey, l_partkey
  payment slice                       lineitem: type from l_returnflag,
                                      value l_extendedprice, installments l_linenumber
  review                              lineitem rows of orders with o_orderkey % 7 <> 0,
                                      score 1 + (l_orderkey + l_linenumber) % 5,
                                      created on l_shipdate (several per order); o_orderkey % 97 = 0
                                      gives reviews of orders that do not exist
  state / zip                         nation key, zero padded to 2 / 5 characters
  coordinates                         one point per customer and supplier around
                                      the nation's anchor (n*2.5-30, n*7-84)
  product category                    p_type, translated by a fixed table; one has no prior
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TPCH_TABLES = ("orders", "lineitem", "customer", "supplier", "part", "nation")

# fixed values: role mapping of driver codes to domain values
STATUS_OF = [("F", "canceled"), ("O", "delivered"), ("P", "processing")]
PAYMENT_TYPE_OF = [("A", "credit_card"), ("N", "boleto"), ("R", "voucher")]
CATEGORY_OF = [("ECONOMY", "housewares"), ("LARGE", "furniture_decor"),
               ("MEDIUM", "sports_leisure"), ("PROMO", "toys"),
               ("SMALL", "electronics"), ("STANDARD", "no_known_prior")]


def read_tpch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(col: str, pairs) -> F.Column:
    expr = None
    for k, v in pairs:
        expr = F.when(F.col(col) == k, F.lit(v)) if expr is None else expr.when(F.col(col) == k, F.lit(v))
    return expr


def _zip(col: str) -> F.Column:
    return F.lpad(F.col(col).cast("string"), 5, "0")


def _state(col: str) -> F.Column:
    return F.lpad(F.col(col).cast("string"), 2, "0")


def raw_orders(spark, sf_dir) -> DataFrame:
    o = read_tpch(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    hours = F.when(key % 3 == 0, F.lit(0)).otherwise(key % 24).cast("int")
    copies = F.when(key % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    o = o.select("*", hours.alias("hours"), F.explode(copies).alias("copy"))

    def days(n):
        return F.expr(f"INTERVAL {n} DAYS")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _case("o_orderstatus", STATUS_OF).alias("order_status"),
        (F.col("o_orderdate") + F.expr("make_dt_interval(copy * 2, hours)")).alias("order_purchase_timestamp"),
        F.when((F.col("copy") == 0) & (F.col("o_orderpriority") != "5-LOW"),
               F.col("o_orderdate") + days(1)).alias("order_approved_at"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate") + days(3)).alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate") + days(7)).alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + days(14)).alias("order_estimated_delivery_date"),
    )


def raw_customers(spark, sf_dir) -> DataFrame:
    c = read_tpch(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.expr("(c_custkey + 1) div 2").alias("customer_unique_id"),
        _zip("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        _state("c_nationkey").alias("customer_state"),
    )


def raw_order_items(spark, sf_dir) -> DataFrame:
    li = read_tpch(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )


def raw_order_payments(spark, sf_dir) -> DataFrame:
    li = read_tpch(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        _case("l_returnflag", PAYMENT_TYPE_OF).alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )


def raw_order_reviews(spark, sf_dir) -> DataFrame:
    li = read_tpch(spark, sf_dir, "lineitem")
    return (li.where(F.col("l_orderkey") % 7 != 0)
              .select(
                  F.concat_ws("-", F.col("l_orderkey").cast("string"),
                              F.col("l_linenumber").cast("string")).alias("review_id"),
                  F.when(F.col("l_orderkey") % 97 == 0, -F.col("l_orderkey"))
                  .otherwise(F.col("l_orderkey")).alias("order_id"),
                  (F.lit(1) + (F.col("l_orderkey") + F.col("l_linenumber")) % 5).cast("int").alias("review_score"),
                  F.lit(None).cast("string").alias("review_comment_title"),
                  F.col("l_linestatus").alias("review_comment_message"),
                  F.to_date("l_shipdate").alias("review_creation_date"),
                  (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("review_answer_timestamp"),
              ))


def raw_sellers(spark, sf_dir) -> DataFrame:
    s = read_tpch(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("seller_id"),
        _zip("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        _state("s_nationkey").alias("seller_state"),
    )


def _points(df: DataFrame, key: str, nation: str, city: str) -> DataFrame:
    n = F.col(nation)
    k = F.col(key)
    return df.select(
        _zip(nation).alias("geolocation_zip_code_prefix"),
        (n * 2.5 - 30 + ((k % 11) - 5).cast("double") * 0.01).alias("geolocation_lat"),
        (n * 7.0 - 84 + ((k % 7) - 3).cast("double") * 0.01).alias("geolocation_lng"),
        F.col(city).alias("geolocation_city"),
        _state(nation).alias("geolocation_state"),
    )


def raw_geolocation(spark, sf_dir) -> DataFrame:
    c = read_tpch(spark, sf_dir, "customer")
    s = read_tpch(spark, sf_dir, "supplier")
    return _points(c, "c_custkey", "c_nationkey", "c_mktsegment").unionByName(
        _points(s, "s_suppkey", "s_nationkey", "s_name"))


def raw_products(spark, sf_dir) -> DataFrame:
    p = read_tpch(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").cast("int").alias("product_name_lenght"),
        F.length("p_brand").cast("int").alias("product_description_lenght"),
        (F.col("p_size") % 5).cast("int").alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        F.col("p_size").cast("double").alias("product_length_cm"),
        F.col("p_size").cast("double").alias("product_height_cm"),
        F.col("p_size").cast("double").alias("product_width_cm"),
    )


def raw_category_translation(spark, sf_dir) -> DataFrame:
    p = read_tpch(spark, sf_dir, "part")
    return (p.select(F.col("p_type").alias("product_category_name")).distinct()
             .select("product_category_name",
                     _case("product_category_name", CATEGORY_OF).alias("product_category_name_english")))


RAW_BUILDERS = {
    "orders": raw_orders,
    "customers": raw_customers,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
    "sellers": raw_sellers,
    "geolocation": raw_geolocation,
    "products": raw_products,
    "category_translation": raw_category_translation,
}


class LazyFrames(Mapping):
    """Mapping of source name -> DataFrame, each built on first access."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = RAW_BUILDERS[name](self._spark, self._dir)
        return self._built[name]

    def __iter__(self):
        return iter(RAW_BUILDERS)

    def __len__(self) -> int:
        return len(RAW_BUILDERS)


def raw_from_tpch(spark: SparkSession, sf_dir: str) -> LazyFrames:
    """The nine raw sources, as lazy frames over the driver tables."""
    return LazyFrames(spark, sf_dir)
