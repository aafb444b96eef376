import json
import os

from pyspark.sql import functions as F

from vantage.sources.raw import SOURCES, load_audit, load_raw, missing_sources, read_source
from vantage.sources.results import read_test_results


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_multiline_zip_and_provenance(spark, scratch):
    root = os.path.join(scratch, "raw")
    write(f"{root}/{SOURCES['order_reviews'].file}",
          'review_id,order_id,review_score,review_comment_title,review_comment_message,'
          'review_creation_date,review_answer_timestamp\n'
          'r1,o1,5,"ok","line one\nline ""two""",2020-01-01 00:00:00,2020-01-02 00:00:00\n'
          'r2,o2,1,,,2020-01-03 00:00:00,\n')
    write(f"{root}/{SOURCES['customers'].file}",
          "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
          "c1,u1,01151,sao paulo,SP\n")
    assert len(missing_sources(spark, root)) == 7
    reviews = read_source(spark, root, "order_reviews")
    rows = reviews.orderBy("review_id").collect()
    assert len(rows) == 2 and rows[0].review_comment_message == 'line one\nline "two"'
    cust = read_source(spark, root, "customers")
    assert cust.first().customer_zip_code_prefix == "01151"
    from vantage.sources.raw import with_provenance
    prov = with_provenance(cust, "2026-01-01T00:00:00+00:00").first()
    assert prov._loaded_at == "2026-01-01T00:00:00+00:00" and prov._source_file == SOURCES["customers"].file
    audit = {r.table_name: r.row_count for r in load_audit({"reviews": reviews, "customers": cust}).collect()}
    assert audit == {"reviews": 2, "customers": 1}


def test_csv_columns_are_bound_by_name(spark, scratch):
    import pytest
    root = os.path.join(scratch, "named")
    file = SOURCES["sellers"].file
    write(f"{root}/{file}/part-1.csv", "seller_state,extra,seller_city,seller_id,seller_zip_code_prefix\nPE,x,recife,s1,01151\n")
    write(f"{root}/{file}/part-2.csv", "seller_state,extra,seller_city,seller_id,seller_zip_code_prefix\nSP,y,sao paulo,s2,00001\n")
    got = read_source(spark, root, "sellers").orderBy("seller_id").collect()
    assert [(r.seller_id, r.seller_zip_code_prefix, r.seller_city, r._source_file) for r in got] == \
        [("s1", "01151", "recife", "part-1.csv"), ("s2", "00001", "sao paulo", "part-2.csv")]
    write(f"{scratch}/less/{file}", "seller_id,seller_city\ns1,recife\n")
    with pytest.raises(ValueError, match="seller_zip_code_prefix"):
        read_source(spark, f"{scratch}/less", "sellers")
    write(f"{scratch}/mixed/{file}/part-1.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,a,b\n")
    write(f"{scratch}/mixed/{file}/part-2.csv", "seller_zip_code_prefix,seller_id,seller_city,seller_state\n1,s1,a,b\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_source(spark, f"{scratch}/mixed", "sellers").collect()


def test_csv_value_that_does_not_parse_fails(spark, scratch):
    import pytest
    write(f"{scratch}/bad/{SOURCES['order_payments'].file}",
          "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,boleto,1,10.5\no2,1,boleto,,abc\n")
    df = read_source(spark, f"{scratch}/bad", "order_payments")
    assert df.where("order_id = 'o1'").first().payment_value == 10.5
    with pytest.raises(Exception, match="order_payments.payment_value: not a double: abc"):
        df.collect()


def test_single_line_sources_are_split(spark, scratch):
    file = f"{scratch}/wide/{SOURCES['orders'].file}"
    names = SOURCES["orders"].schema.fieldNames()
    write(file, ",".join(names) + "\n" + "\n".join(",".join([f"o{i}", *["x" * 40] * (len(names) - 1)]) for i in range(20000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = read_source(spark, f"{scratch}/wide", "orders")
        assert df.rdd.getNumPartitions() > 4 and df.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_replace_table(spark):
    from vantage.sinks.write import replace_table
    try:
        for n in (5, 3):
            name = replace_table(spark.range(n), "vantage_test_schema", "t")
        assert spark.table(name).count() == 3
    finally:
        spark.sql("DROP SCHEMA IF EXISTS vantage_test_schema CASCADE")


def test_month_write_replaces_all_or_its_months(spark, scratch):
    from vantage.sinks.write import write_month_partitioned
    path = os.path.join(scratch, "months")
    df = spark.createDataFrame([(1, "2017-01"), (2, "2017-02")], "v int, partition_month string")
    write_month_partitioned(df, path)
    write_month_partitioned(df.where("v = 2").withColumn("v", F.lit(9)), path, replace="months")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]
    write_month_partitioned(df.where("v = 2"), path)
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static").lower() == "static"


def test_seeds_from_files_reach_the_lookups(spark, scratch):
    from vantage.plans.extended import payment_risk, score_tiers
    from vantage.sources.seeds import read_seed
    write(f"{scratch}/payment_method_risk.csv", 'payment_type,base_risk_score,rationale\nboleto,0.9,"edited, by hand"\n')
    write(f"{scratch}/risk_thresholds.csv", "tier,lower_bound_inclusive,upper_bound_exclusive,action\nall,0.0,2.0,look\n")
    orders = spark.createDataFrame([("o1", "boleto"), ("o2", "voucher")], "order_id string, primary_payment_type string")
    got = payment_risk(orders, read_seed(spark, scratch, "payment_method_risk"))
    assert {r.order_id: r.payment_method_risk_score for r in got.collect()} == {"o1": 0.9, "o2": None}
    scored = spark.createDataFrame([(0.4,), (1.9,)], "s double")
    assert {r.action for r in score_tiers(scored, "s", read_seed(spark, scratch, "risk_thresholds")).collect()} == {"look"}


def test_load_raw_fails_fast(spark, scratch):
    import pytest
    with pytest.raises(FileNotFoundError):
        load_raw(spark, os.path.join(scratch, "nothing"))


def test_month_partitioned_roundtrip(spark, scratch):
    from vantage.sinks.write import partition_audit, write_month_partitioned
    df = spark.range(30).select(F.col("id"), F.format_string("2020-%02d", (F.col("id") % 3) + 1)
                                .alias("partition_month"))
    path = write_month_partitioned(df, os.path.join(scratch, "pm"))
    assert sorted(os.listdir(path))[-3:] == ["partition_month=2020-01", "partition_month=2020-02",
                                             "partition_month=2020-03"]
    audit = {r.partition_month: (r.part_files, r.row_count) for r in partition_audit(spark, path).collect()}
    assert {k: v[1] for k, v in audit.items()} == {"2020-01": 10, "2020-02": 10, "2020-03": 10}
    assert all(v[0] == 1 for v in audit.values())          # clustered: one file per month
    back = spark.read.parquet(path)
    assert "partition_month" in back.columns and back.count() == 30


def test_test_results_reader(spark, scratch):
    p = os.path.join(scratch, "run_results.json")
    write(p, json.dumps({"results": [
        {"unique_id": "test.proj.not_null_orders_order_id.abc123", "status": "pass", "execution_time": 0.12345,
         "message": None},
        {"unique_id": "model.proj.stg_orders", "status": "success", "execution_time": 1.0, "message": "x"},
        {"unique_id": "test.proj.unique_x", "status": "fail", "execution_time": 2.0, "message": "m" * 300}]}))
    rows = {r.test_name: r for r in read_test_results(spark, p).collect()}
    assert set(rows) == {"abc123", "unique_x"}
    assert rows["abc123"].execution_time == 0.123 and rows["abc123"].message == ""
    assert len(rows["unique_x"].message) == 200
    empty = read_test_results(spark, os.path.join(scratch, "missing.json"))
    assert empty.columns == ["test_name", "status", "execution_time", "message"] and empty.count() == 0


def test_catalog_register_and_event_type(spark, scratch):
    from vantage.sources.catalog import event_type_of, list_schemas, register_table
    df = spark.range(5).select(F.col("id"), (F.col("id") % 2).alias("part"))
    path = os.path.join(scratch, "tbl")
    df.write.partitionBy("part").parquet(path)
    name = "vantage_test_tbl"
    register_table(spark, name, path)
    assert spark.table(name).count() == 5
    spark.sql("CREATE SCHEMA IF NOT EXISTS vantage_empty")
    held = [r.table_schema for r in list_schemas(spark).collect()]
    spark.sql("DROP SCHEMA vantage_empty")
    assert "default" in held and "vantage_empty" not in held
    spark.sql(f"DROP TABLE {name}")
    got = spark.createDataFrame([("olist_orders_dataset.csv",), ("product_category_name_translation.csv",)], "f string")
    assert [r.e for r in got.select(event_type_of(F.col("f")).alias("e")).collect()] == \
        ["orders", "product_category_name_translation"]


def test_land_by_event_type(spark, scratch):
    from vantage.sources.catalog import land_by_event_type
    src = os.path.join(scratch, "src")
    write(f"{src}/olist_orders_dataset.csv", "order_id\no1\no2\n")
    write(f"{src}/olist_sellers_dataset.csv", "seller_id\ns1\n")
    df = spark.read.option("header", True).schema("id string").csv(src)
    path = land_by_event_type(df, os.path.join(scratch, "landed"))
    got = {r.event_type: r.n for r in spark.read.parquet(path).groupBy("event_type")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"orders": 2, "sellers": 1}


def test_sources_land_beside_each_other_and_read_back_by_folder(spark, scratch):
    from pyspark.sql import types as T
    from vantage.sources.catalog import land_by_event_type, read_landed
    write(f"{scratch}/raw/olist_orders_dataset.csv/part-0.csv", "order_id,n\no1,1\no2,2\n")
    write(f"{scratch}/raw/olist_orders_dataset.csv/part-1.csv", "order_id,n\no3,3\n")
    write(f"{scratch}/raw/olist_sellers_dataset.csv", "seller_id\ns1\n")
    orders = T.StructType.fromDDL("order_id string, n long")
    path = f"{scratch}/landed"
    load = lambda file, ddl: spark.read.option("header", True).schema(ddl).csv(f"{scratch}/raw/{file}")
    land_by_event_type(load("olist_orders_dataset.csv", "order_id string, n long"), path)
    land_by_event_type(load("olist_sellers_dataset.csv", "seller_id string"), path)
    assert sorted(os.listdir(path))[-2:] == ["event_type=orders", "event_type=sellers"]
    got = read_landed(spark, path, "orders", orders, loaded_at="now")
    assert [(r.order_id, r.n, r.event_type, r._loaded_at) for r in got.orderBy("order_id").collect()] == \
        [("o1", 1, "orders", "now"), ("o2", 2, "orders", "now"), ("o3", 3, "orders", "now")]
    assert all(f.endswith(".parquet") for (f,) in got.select("_source_file").distinct().collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "event_type" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    write(f"{scratch}/raw/olist_orders_dataset.csv/part-2.csv", "order_id,n\no4,4\n")
    land_by_event_type(load("olist_orders_dataset.csv", "order_id string, n long"), path)  # again: replaced, not doubled
    assert read_landed(spark, path, "orders", orders).count() == 4
    sellers = read_landed(spark, path, "sellers", T.StructType.fromDDL("seller_id string"))
    assert [r.seller_id for r in sellers.collect()] == ["s1"]


def test_partition_sync_reports_what_came_and_went(spark, scratch):
    from vantage.sinks.write import delete_folder
    from vantage.sources.catalog import register_table, sync_partitions
    path = os.path.join(scratch, "synced")
    df = spark.range(12).select("id", (F.col("id") % 4).alias("p"))
    df.where("p < 3").write.partitionBy("p").parquet(path)
    found = register_table(spark, "vantage_sync_tbl", path)
    try:
        assert [tuple(r) for r in found.collect()] == [(f"p={i}", "added") for i in range(3)]
        assert delete_folder(spark, f"{path}/p=1") and not delete_folder(spark, f"{path}/p=7")
        df.where("p = 3").write.mode("append").partitionBy("p").parquet(path)
        assert [tuple(r) for r in sync_partitions(spark, "vantage_sync_tbl").collect()] == \
            [("p=0", "kept"), ("p=1", "removed"), ("p=2", "kept"), ("p=3", "added")]
        assert sorted(r.p for r in spark.table("vantage_sync_tbl").collect()) == [0] * 3 + [2] * 3 + [3] * 3
        assert {r.change for r in sync_partitions(spark, "vantage_sync_tbl").collect()} == {"kept"}
    finally:
        spark.sql("DROP TABLE vantage_sync_tbl")
    spark.range(2).write.parquet(f"{scratch}/flat")
    try:
        assert register_table(spark, "vantage_flat_tbl", f"{scratch}/flat", partitioned=False).collect() == []
        assert spark.table("vantage_flat_tbl").count() == 2
    finally:
        spark.sql("DROP TABLE vantage_flat_tbl")


def test_parquet_source_and_stamp(spark, scratch):
    """SRC-08 and FN-15: Parquet roots by declared schema, one stamp a run."""
    import re
    from vantage.sources.raw import load_raw, load_stamp
    spec = SOURCES["sellers"]
    rows = spark.createDataFrame([("s1", "01151", "recife", "PE")], spec.schema)
    rows.select(*reversed(rows.columns)).withColumn("more", F.lit(1)).write.parquet(f"{scratch}/{spec.table}")
    got = load_raw(spark, scratch, fmt="parquet", names=["sellers"])["sellers"].first()
    assert (got.seller_id, got.seller_zip_code_prefix, got.seller_state) == ("s1", "01151", "PE")
    assert got._source_file.endswith(".parquet") and re.fullmatch(r"\d{4}-\d\d-\d\dT[\d:.]+\+00:00", got._loaded_at)
    assert load_stamp() <= load_stamp()
