"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the whole driver tables through the role mapping in
``vantage.sources.tpch`` and ends with :func:`canonical` so it can be compared
with the DuckDB text in ``oracle_sql.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.plans.compare import canonical
from vantage.plans.gold import fct_customer_return_risk_features, int_orders_enriched
from vantage.plans.silver import build_silver
from vantage.sources.tpch import raw_from_tpch

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str, nullable_ints=()):
    def deco(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return canonical(fn(spark, sf_dir), nullable_ints)
        REGISTRY[name] = run
        run.raw = fn
        return fn
    return deco


def layers(spark: SparkSession, sf_dir: str):
    """raw, silver and the enriched order over the driver tables (all lazy)."""
    raw = raw_from_tpch(spark, sf_dir)
    silver = build_silver(raw)
    enriched = int_orders_enriched(silver["stg_orders"], silver["stg_order_payments"],
                                   silver["stg_order_reviews"], silver["stg_order_items"],
                                   silver["stg_customers"], silver["stg_geolocation"],
                                   raw["sellers"])
    return raw, silver, enriched


@register("pit_customer_features", nullable_ints=("days_since_first_order",))
def pit_customer_features(spark, sf_dir):
    _, _, enriched = layers(spark, sf_dir)
    return fct_customer_return_risk_features(enriched)


@register("pit_customer_features_strict", nullable_ints=("days_since_first_order",))
def pit_customer_features_strict(spark, sf_dir):
    _, _, enriched = layers(spark, sf_dir)
    return fct_customer_return_risk_features(enriched, lead="0 days")


@register("pit_customer_features_review_dated", nullable_ints=("days_since_first_order",))
def pit_customer_features_review_dated(spark, sf_dir):
    from vantage.plans.gold import review_dated_features
    _, silver, enriched = layers(spark, sf_dir)
    return review_dated_features(enriched, silver["stg_order_reviews"])


# ---------------------------------------------------------------- helpers

def _fct(spark, sf_dir):
    _, _, enriched = layers(spark, sf_dir)
    return fct_customer_return_risk_features(enriched)


def _latest(spark, sf_dir):
    """Feature rows of the latest snapshot, from the stored feature table."""
    from vantage.plans.pipeline import latest_rows
    from vantage.plans.store import stored_layers
    return latest_rows(stored_layers(spark, sf_dir).layers["gold"]["fct_customer_return_risk_features"])


def _events(spark, sf_dir):
    from vantage.sources.tpch import read_tpch
    return read_tpch(spark, sf_dir, "events")


def _scratch(spark, name: str) -> str:
    """Fresh folder under the session's shared checkpoint folder."""
    from vantage.plans.pipeline import staging_root
    return staging_root(spark, name)


# ---------------------------------------------------------- spine / pairs

@register("month_spine")
def month_spine(spark, sf_dir):
    from vantage.operators.pit import time_spine
    _, silver, _ = layers(spark, sf_dir)
    return time_spine(silver["stg_orders"], "order_purchase_ts", "month")


@register("eligible_customer_months")
def eligible_customer_months(spark, sf_dir):
    from vantage.operators.pit import eligible_pairs
    _, _, enriched = layers(spark, sf_dir)
    return eligible_pairs(enriched, "customer_unique_id", "order_purchase_ts", "month", lead="1 month")


# ------------------------------------------------------- silver and gold

@register("stg_orders")
def stg_orders_q(spark, sf_dir):
    _, silver, _ = layers(spark, sf_dir)
    return silver["stg_orders"]


@register("customer_current_row")
def customer_current_row(spark, sf_dir):
    _, silver, _ = layers(spark, sf_dir)
    return silver["stg_customers"]


@register("stg_order_reviews")
def stg_order_reviews_q(spark, sf_dir):
    _, silver, _ = layers(spark, sf_dir)
    return silver["stg_order_reviews"]


@register("stg_order_items")
def stg_order_items_q(spark, sf_dir):
    _, silver, _ = layers(spark, sf_dir)
    return silver["stg_order_items"]


@register("stg_order_payments")
def stg_order_payments_q(spark, sf_dir):
    _, silver, _ = layers(spark, sf_dir)
    return silver["stg_order_payments"]


@register("region_centroid")
def region_centroid(spark, sf_dir):
    _, silver, _ = layers(spark, sf_dir)
    return silver["stg_geolocation"]


@register("items_keep_first")
def items_keep_first(spark, sf_dir):
    from vantage.operators.relational import keep_first
    raw = raw_from_tpch(spark, sf_dir)
    return keep_first(raw["order_items"], ["order_id", "order_item_id"],
                      ["shipping_limit_date", "seller_id", "product_id", "price", "freight_value"])


@register("latest_event_per_user")
def latest_event_per_user(spark, sf_dir):
    from vantage.operators.relational import keep_latest
    ev = _events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type", "value")
    return keep_latest(ev, ["user_id"], ["ts"], tiebreak=[F.col("event_id").desc_nulls_last()])


@register("payments_per_order")
def payments_per_order_q(spark, sf_dir):
    from vantage.plans.gold import payments_per_order
    _, silver, _ = layers(spark, sf_dir)
    return payments_per_order(silver["stg_order_payments"])


@register("primary_seller")
def primary_seller_q(spark, sf_dir):
    from vantage.plans.gold import primary_seller
    _, silver, _ = layers(spark, sf_dir)
    return primary_seller(silver["stg_order_items"])


@register("orders_enriched",
          nullable_ints=("max_installments", "primary_seller_id", "review_score"))
def orders_enriched(spark, sf_dir):
    _, _, enriched = layers(spark, sf_dir)
    return enriched


@register("customer_seller_distance", nullable_ints=("primary_seller_id",))
def customer_seller_distance(spark, sf_dir):
    _, _, enriched = layers(spark, sf_dir)
    return enriched.select("order_id", "customer_unique_id", "primary_seller_id", "customer_seller_distance_km")


# ------------------------------------------------------------ extended

@register("order_velocity")
def order_velocity_q(spark, sf_dir):
    from vantage.plans.extended import order_velocity
    _, silver, enriched = layers(spark, sf_dir)
    return order_velocity(enriched, silver["stg_orders"]).select("order_id", "customer_unique_id", "order_purchase_ts",
                                           "hours_since_prev_order", "velocity_kmh")


@register("pit_customer_features_extended", nullable_ints=("days_since_last_order",))
def pit_customer_features_extended(spark, sf_dir):
    from vantage.plans.extended import fct_extended_features
    _, silver, enriched = layers(spark, sf_dir)
    return fct_extended_features(enriched, orders=silver["stg_orders"])


@register("pit_event_features", nullable_ints=("days_since_first_event", "days_since_last_event"))
def pit_event_features(spark, sf_dir):
    from vantage.plans.events import event_features
    return event_features(_events(spark, sf_dir))


@register("payment_risk")
def payment_risk_q(spark, sf_dir):
    from vantage.plans.extended import payment_risk
    _, _, enriched = layers(spark, sf_dir)
    return payment_risk(enriched)


@register("payment_risk_from_file")
def payment_risk_from_file(spark, sf_dir):
    """The lookup with a seed that was edited in its file."""
    from vantage.plans.extended import payment_risk
    from vantage.sources.seeds import read_seed, seed_frame
    root, name = _scratch(spark, "seeds"), "payment_method_risk"
    edited = seed_frame(spark, name).where("payment_type != 'boleto'").withColumn(
        "base_risk_score", F.col("base_risk_score") + 0.05)
    edited.write.options(header=True, escape='"').csv(f"{root}/{name}.csv")
    _, _, enriched = layers(spark, sf_dir)
    return payment_risk(enriched, read_seed(spark, root, name))


@register("category_prior")
def category_prior_q(spark, sf_dir):
    from vantage.plans.extended import category_prior
    raw, silver, _ = layers(spark, sf_dir)
    return category_prior(silver["stg_order_items"], raw["products"], raw["category_translation"])


@register("score_tier")
def score_tier(spark, sf_dir):
    from vantage.plans.extended import score_tiers
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    scored = s.select("s_suppkey", ((F.col("s_acctbal") + F.lit(1000.0)) / F.lit(11000.0)).alias("risk_score"))
    return score_tiers(scored, "risk_score")


@register("price_bands")
def price_bands(spark, sf_dir):
    """Items a price band: one band a part, overlapping; a third of the prices share a cell."""
    from vantage.operators.relational import range_totals
    item = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    low = F.lit(1000.0) + F.col("p_partkey") % 2000 * 50 + F.col("p_partkey") % 7
    own = F.when(F.col("p_partkey") != -1, F.col("p_partkey"))  # -1 is the band of the rest
    bands = part.select(own.alias("band"), low.alias("low"), (low + F.col("p_size")).alias("high"))
    price = F.when(F.col("l_orderkey") % 3 == 0, F.lit(5000.0) + F.col("l_discount")).otherwise(F.col("l_extendedprice"))
    found = range_totals(item.select("l_orderkey", price.alias("price")), "price", "l_orderkey", bands, "low", "high",
                         "band", _scratch(spark, "price-bands"))
    return found.select(F.coalesce("band", F.lit(-1)).alias("band"), F.col("rows").alias("items"),
                        F.col("keys").alias("orders"), F.col("top").alias("top_price"))


@register("orders_with_merchant")
def orders_with_merchant_q(spark, sf_dir):
    from vantage.plans.extended import orders_with_merchant
    raw = raw_from_tpch(spark, sf_dir)
    return orders_with_merchant(raw["orders"], raw["order_items"])


@register("partitioned_roundtrip")
def partitioned_roundtrip(spark, sf_dir):
    from vantage.plans.extended import orders_with_merchant
    from vantage.sinks.write import write_month_partitioned
    raw = raw_from_tpch(spark, sf_dir)
    path = write_month_partitioned(orders_with_merchant(raw["orders"], raw["order_items"]),
                                   _scratch(spark, "orders-by-month"))
    back = spark.read.parquet(path)
    return back.groupBy("partition_month").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("merchant_id").alias("merchants"))


@register("partition_audit")
def partition_audit_q(spark, sf_dir):
    """Rows of every month as stored, after one month was written once more."""
    from vantage.plans.extended import orders_with_merchant
    from vantage.sinks.write import partition_audit, write_month_partitioned
    raw = raw_from_tpch(spark, sf_dir)
    orders = orders_with_merchant(raw["orders"], raw["order_items"])
    path = write_month_partitioned(orders, _scratch(spark, "orders-by-month"))
    first = orders.where("partition_month = '1995-03' AND order_status = 'canceled'")
    write_month_partitioned(first, path, replace="months")
    return partition_audit(spark, path).select(
        "partition_month", "row_count", (F.col("part_files") > 0).alias("has_files"))


def _land_csv(spark, sf_dir, name) -> str:
    """Driver orders or reviews as CSV part files: columns in another order, quoted line
    breaks in the comments."""
    from vantage.sources.raw import SOURCES
    df, root = raw_from_tpch(spark, sf_dir)[name], _scratch(spark, "csv")
    if name == "order_reviews":
        df = df.withColumn("review_comment_message", F.concat(
            F.col("review_comment_message"), F.lit('\n"'), F.col("review_id"), F.lit('", again')))
    options = {"header": True, "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    df.select(*sorted(df.columns, reverse=True)).write.options(**options).csv(f"{root}/{SOURCES[name].file}")
    return root


def _loaded(spark, sf_dir, name):
    from vantage.sources.raw import load_raw
    df = load_raw(spark, _land_csv(spark, sf_dir, name), loaded_at="2026-01-01T00:00:00+00:00", names=[name])[name]
    return df.withColumn("_source_file", F.regexp_replace("_source_file", "^part-.*[.]csv$", "part"))


@register("csv_load")
def csv_load(spark, sf_dir):
    return _loaded(spark, sf_dir, "orders")


@register("csv_load_reviews")
def csv_load_reviews(spark, sf_dir):
    return _loaded(spark, sf_dir, "order_reviews")


@register("gate_verdict")
def gate_verdict(spark, sf_dir):
    """Bronze and silver checks with message, time and whether the check stops a run."""
    from vantage.operators.quality import evaluate, report
    from vantage.plans.pipeline import Record, run_pipeline
    from vantage.plans.suites import bronze_suite
    raw, record = raw_from_tpch(spark, sf_dir), Record()
    run_pipeline(spark, raw, layers=("silver",), fail_on=(), record=record)
    found = report(spark, evaluate(bronze_suite(), raw) + record.results)
    return found.select("check_name", "table_name", "status", F.coalesce("message", F.lit("")).alias("message"),
                         (F.col("execution_time") > 0).alias("timed"), (F.col("failures") > 0).alias("stops"))


# ---------------------------------------------------------- analytics

@register("cancel_rate_by_state")
def cancel_rate_by_state(spark, sf_dir):
    from vantage.plans.analytics import cancellation_rate_by_state
    raw = raw_from_tpch(spark, sf_dir)
    return cancellation_rate_by_state(raw["orders"], raw["customers"])


@register("low_review_on_delivered")
def low_review_on_delivered_q(spark, sf_dir):
    from vantage.plans.analytics import low_review_on_delivered
    raw = raw_from_tpch(spark, sf_dir)
    return low_review_on_delivered(raw["orders"], raw["order_reviews"])


@register("top_risky_customers")
def top_risky_customers_q(spark, sf_dir):
    from vantage.plans.analytics import top_risky_customers
    return top_risky_customers(_latest(spark, sf_dir), limit=50)


@register("risk_distribution")
def risk_distribution_q(spark, sf_dir):
    from vantage.plans.analytics import risk_distribution
    return risk_distribution(_latest(spark, sf_dir))


@register("feature_store_summary")
def feature_store_summary_q(spark, sf_dir):
    from vantage.plans.analytics import feature_store_summary
    return feature_store_summary(_fct(spark, sf_dir))


@register("orders_overview")
def orders_overview_q(spark, sf_dir):
    from vantage.plans.analytics import orders_overview
    _, silver, _ = layers(spark, sf_dir)
    return orders_overview(silver["stg_orders"])


@register("layer_row_counts")
def layer_row_counts_q(spark, sf_dir):
    """Stored tables are counted by their footers, the views of bronze and the seeds by a scan."""
    from vantage.plans.analytics import layer_row_counts
    from vantage.plans.store import footer_counts, stored_layers
    from vantage.sources.seeds import all_seeds
    stored = stored_layers(spark, sf_dir)
    paths = {(layer, name): stored.paths[name] for layer in ("silver", "gold") for name in stored.layers[layer]}
    scanned = layer_row_counts({"bronze": stored.layers["bronze"], "seeds": all_seeds(spark)})
    return scanned.unionByName(footer_counts(spark, paths)).orderBy("layer", "table_name")


@register("load_audit")
def load_audit_q(spark, sf_dir):
    from vantage.sources.raw import load_audit
    return load_audit(raw_from_tpch(spark, sf_dir))


# ------------------------------------------------------------- quality

@register("dq_not_null")
def dq_not_null(spark, sf_dir):
    from vantage.operators.quality import not_null
    _, silver, _ = layers(spark, sf_dir)
    return not_null(silver["stg_orders"], "order_approved_ts")


@register("dq_store_failures")
def dq_store_failures(spark, sf_dir):
    """Failing rows of a silver check written under the shared folder and read back."""
    from vantage.operators.quality import Check, store_failures
    from vantage.plans.pipeline import staging_root
    _, silver, _ = layers(spark, sf_dir)
    path = store_failures(Check("stg_orders", "not_null", "order_approved_ts"), silver,
                          staging_root(spark, "dq_failures"))
    return spark.read.parquet(path)


@register("dq_unique")
def dq_unique(spark, sf_dir):
    from vantage.operators.quality import unique
    raw = raw_from_tpch(spark, sf_dir)
    return unique(raw["order_reviews"], "order_id")


@register("dq_accepted_values")
def dq_accepted_values(spark, sf_dir):
    from vantage.operators.quality import accepted_values
    raw = raw_from_tpch(spark, sf_dir)
    return accepted_values(raw["order_payments"], "payment_type", ["credit_card", "debit_card", "boleto"])


@register("dq_relationships")
def dq_relationships(spark, sf_dir):
    from vantage.operators.quality import relationships
    raw = raw_from_tpch(spark, sf_dir)
    return relationships(raw["order_reviews"], "order_id", raw["orders"], "order_id")


@register("dq_expression")
def dq_expression(spark, sf_dir):
    from vantage.operators.quality import expression_is_true
    _, _, enriched = layers(spark, sf_dir)
    return expression_is_true(enriched.select("order_id", "customer_seller_distance_km"),
                              "customer_seller_distance_km", "< 5000")


@register("dq_unique_combination")
def dq_unique_combination(spark, sf_dir):
    from vantage.operators.quality import unique_combination
    raw = raw_from_tpch(spark, sf_dir)
    return unique_combination(raw["order_items"], ["order_id", "order_item_id"])


@register("dq_report")
def dq_report(spark, sf_dir):
    """All 64 checks: those of a written layer on its write, the others beside it."""
    from concurrent.futures import ThreadPoolExecutor

    from vantage.operators.quality import evaluate, report
    from vantage.plans.pipeline import Record, run_pipeline
    from vantage.plans.suites import bronze_suite, seed_suite
    from vantage.sources.seeds import all_seeds
    raw, record = raw_from_tpch(spark, sf_dir), Record()
    with ThreadPoolExecutor(max_workers=1) as beside:
        unwritten = beside.submit(evaluate, bronze_suite() + seed_suite(), {**raw, **all_seeds(spark)}, threads=2)
        run_pipeline(spark, raw, fail_on=(), record=record)
        found = report(spark, unwritten.result() + record.results)
    return found.select(*(c for c in found.columns if c != "execution_time"), (F.col("execution_time") > 0).alias("timed"))


# ------------------------------------------------------ scalar / nested

@register("typed_try_cast", nullable_ints=("props_k", "event_type_as_int", "value_as_int"))
def typed_try_cast(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").try_cast("timestamp_ntz").alias("ts_second"),
        F.get_json_object("props", "$.k").try_cast("int").alias("props_k"),
        F.col("event_type").try_cast("int").alias("event_type_as_int"),
        F.bround("value").cast("int").alias("value_as_int"),
        F.date_format("ts", "yyyy-MM-dd").try_cast("date").alias("event_date"),
    )


@register("nested_results")
def nested_results(spark, sf_dir):
    from vantage.sources.results import read_test_results
    ev = _events(spark, sf_dir)
    k = F.get_json_object("props", "$.k")
    flat = ev.select(
        "event_id",
        F.concat(F.when(F.col("event_type").isin("error", "click"), F.lit("test.")).otherwise(F.lit("model.")),
                 F.lit("vantage."), F.col("event_type"), F.lit("_"), F.col("event_id").cast("string"))
        .alias("unique_id"),
        F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
        F.col("value").alias("execution_time"),
        F.when(k.try_cast("int") % 3 != 0, F.concat(F.lit("k="), k)).alias("message"),
    )
    # documents of up to 100 results, as JSON text, then read and exploded
    path = _scratch(spark, "results")
    (flat.groupBy(F.expr("event_id div 100").alias("document"))
         .agg(F.collect_list(F.struct("unique_id", "status", "execution_time", "message")).alias("results"))
         .select("results").write.json(path))
    return read_test_results(spark, path, multi_line=False)


# ------------------------------------------------------------ streaming

@register("incremental_ingest")
def incremental_ingest(spark, sf_dir):
    from vantage.streaming.ingest import demo_incremental_orders
    return demo_incremental_orders(spark, sf_dir, _scratch(spark, "ingest"))


@register("ingest_upsert")
def ingest_upsert(spark, sf_dir):
    from vantage.streaming.upsert import demo_changed_orders
    return demo_changed_orders(spark, sf_dir, _scratch(spark, "upsert"))


# --------------------------------------------------- tables and catalogue

@register("table_replaced")
def table_replaced(spark, sf_dir):
    """A table written twice and a third time in vain: rows by status as a reader of the first
    version and a reader of the table see them."""
    from vantage.sinks.write import replace_table
    orders, root = raw_from_tpch(spark, sf_dir)["orders"], _scratch(spark, "replaced")
    schema = "vantage_" + root.rpartition("-")[2]
    kept = orders.select("order_id", "customer_id", "order_status")
    name = replace_table(kept.where("order_status != 'delivered'"), schema, "orders", root=root)
    early = spark.table(name)
    replace_table(kept.where("order_id % 3 != 0"), schema, "orders", root=root)
    broken = F.when(F.col("order_id") >= 0, F.raise_error(F.lit("refused")).cast("string")).alias("order_status")
    try:
        replace_table(kept.select("order_id", "customer_id", broken), schema, "orders", root=root)
    except Exception as e:  # the write's own error, whatever class carries it
        if "refused" not in str(e):
            raise
    seen = {"early": early, "now": spark.table(name)}
    out = [df.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"), F.sum("customer_id").alias("customers"))
           .withColumn("reader", F.lit(reader)) for reader, df in seen.items()]
    spark.sql(f"DROP SCHEMA {schema} CASCADE")  # the catalogue's entry; the rows stay with their readers
    return out[0].unionByName(out[1])


@register("landed_orders")
def landed_orders(spark, sf_dir):
    """Two sources landed as Parquet by event type, one read back through its folder."""
    from vantage.sources.catalog import land_by_event_type, read_landed
    from vantage.sources.raw import SOURCES, read_source
    raw, root = raw_from_tpch(spark, sf_dir), _scratch(spark, "landing")
    options = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    for name in ("orders", "customers"):
        spec = SOURCES[name]
        raw[name].select(*spec.schema.fieldNames()).write.options(**options).csv(f"{root}/raw/{spec.file}")
        land_by_event_type(read_source(spark, f"{root}/raw", name).select(*spec.schema.fieldNames()), f"{root}/landed")
    back = read_landed(spark, f"{root}/landed", "orders", SOURCES["orders"].schema, loaded_at="2026-01-01T00:00:00+00:00")
    return back.withColumn("_source_file", F.regexp_replace("_source_file", "^part-.*[.]parquet$", "part"))


@register("partitions_synced")
def partitions_synced(spark, sf_dir):
    """A registered table by month after one month was removed and one added: what the
    synchronisation reports, and the rows that the table then has."""
    from vantage.plans.extended import orders_with_merchant
    from vantage.sinks.write import delete_folder, write_month_partitioned
    from vantage.sources.catalog import register_table, sync_partitions
    raw, path = raw_from_tpch(spark, sf_dir), _scratch(spark, "months")
    orders = orders_with_merchant(raw["orders"], raw["order_items"]).select("order_id", "merchant_id", "partition_month")
    write_month_partitioned(orders.where("partition_month != '1997-01'"), path)
    name = "vantage_months_" + path.rpartition("-")[2]
    register_table(spark, name, path)
    delete_folder(spark, f"{path}/partition_month=1996-02")
    write_month_partitioned(orders.where("partition_month = '1997-01'"), path, replace="months")
    changes = sync_partitions(spark, name).select(
        F.split_part("partition", F.lit("="), F.lit(2)).alias("partition_month"), "change")
    rows = spark.table(name).groupBy("partition_month").agg(F.count(F.lit(1)).alias("row_count"))
    out = changes.join(rows, "partition_month", "full").select("partition_month", "change",
                                                              F.coalesce("row_count", F.lit(0)).alias("row_count"))
    found = _scratch(spark, "synced")
    out.write.parquet(found)  # a partitioned table is read through the catalogue
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(out.schema).parquet(found)


@register("catalog_schemas")
def catalog_schemas(spark, sf_dir):
    """Schemas that hold tables, of one made for each order status and an empty one."""
    from vantage.sinks.write import replace_table
    from vantage.sources.catalog import list_schemas
    orders, root = raw_from_tpch(spark, sf_dir)["orders"], _scratch(spark, "schemas")
    mark = "vantage_" + root.rpartition("-")[2] + "_"
    made = [mark + s for s in ("canceled", "delivered", "processing")]
    for name in made:
        replace_table(orders.where(F.col("order_status") == name.removeprefix(mark)), name, "orders", root=f"{root}/{name}")
    spark.sql(f"CREATE SCHEMA {mark}empty")
    held = list_schemas(spark).where(F.col("table_schema").startswith(mark))
    found = [r.table_schema for r in held.collect()]  # the schemas made here
    counts = [spark.table(f"{n}.orders").agg(F.count(F.lit(1)).alias("orders"))
              .select(F.lit(n.removeprefix(mark)).alias("table_schema"), "orders") for n in found]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    for name in (*made, f"{mark}empty"):
        spark.sql(f"DROP SCHEMA {name} CASCADE")
    return out
