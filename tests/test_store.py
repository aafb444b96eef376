"""Tables that are replaced by versions, published layers, and what reads stored layers."""

import os
import time

import pytest
from pyspark.sql import functions as F

from vantage.sinks.write import replace_table

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def schema(spark):
    name = f"vantage_{time.time_ns()}"
    yield name
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def test_a_failed_write_leaves_the_old_table(spark, schema, scratch):
    df = spark.range(5).select(F.col("id"), F.lit("a").alias("word"))
    name = replace_table(df, schema, "t", root=scratch)
    bad = df.select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"), "word")
    with pytest.raises(Exception, match="broken"):
        replace_table(bad, schema, "t", root=scratch)
    assert spark.table(name).count() == 5
    assert len(os.listdir(f"{scratch}/t")) == 1  # what was half written is gone


def test_readers_see_the_old_rows_or_the_new_ones(spark, schema, scratch):
    rows = lambda n, word: spark.range(n).select("id", F.lit(word).alias("word"))
    name = replace_table(rows(5, "a"), schema, "t", root=scratch)
    reader = spark.table(name)
    replace_table(rows(7, "b"), schema, "t", root=scratch)
    assert spark.table(name).count() == 7
    assert reader.count() == 5  # planned before, its version is kept
    with pytest.raises(Exception):  # a query that reads the table which it replaces
        replace_table(spark.table(name).select("id", F.raise_error(F.lit("no")).cast("string").alias("word")), schema, "t", root=scratch)
    replace_table(spark.table(name).where("id > 0"), schema, "t", root=scratch)
    assert spark.table(name).count() == 6
    for n in (8, 9):
        replace_table(rows(n, "c"), schema, "t", root=scratch)
    assert len(os.listdir(f"{scratch}/t")) == 2 and spark.table(name).count() == 9
    wider = rows(3, "d").withColumn("more", F.lit(1.5))
    replace_table(wider, schema, "t", root=scratch)
    assert spark.table(name).columns == ["id", "word", "more"] and spark.table(name).count() == 3
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {schema}").where("NOT isTemporary").collect()] == ["t"]


def test_published_layers_switch_after_the_gates(spark, schema, scratch, monkeypatch):
    from vantage.operators.quality import QualityGateError
    from vantage.plans import pipeline
    from vantage.sources.tpch import raw_from_tpch
    raw = raw_from_tpch(spark, SF)
    record = pipeline.Record()
    built = pipeline.run_pipeline(spark, raw, root=scratch, publish=schema, record=record, prefix="one_")
    orders = spark.table(f"{schema}.stg_orders").count()
    assert orders == record.rows["stg_orders"] == built["silver"]["stg_orders"].count()
    panel = f"{schema}.fct_customer_return_risk_features"
    assert spark.table(panel).columns == built["gold"]["fct_customer_return_risk_features"].columns
    assert spark.table(panel).count() == record.rows["fct_customer_return_risk_features"]
    assert {r.check.table for r in record.results} >= {"stg_orders", "int_orders_enriched"}
    plain = pipeline.build_silver
    monkeypatch.setattr(pipeline, "build_silver", lambda raw: {
        **plain(raw), "stg_orders": plain(raw)["stg_orders"].unionByName(plain(raw)["stg_orders"])})
    with pytest.raises(QualityGateError):
        pipeline.run_pipeline(spark, raw, root=scratch, publish=schema, prefix="two_")
    assert spark.table(f"{schema}.stg_orders").count() == orders
    assert spark.table("one_silver_stg_orders").count() == orders and not spark.catalog.tableExists("two_gold_int_orders_enriched")
    monkeypatch.undo()
    half = {**raw, "orders": raw["orders"].where("order_id % 2 = 0")}
    pipeline.run_pipeline(spark, half, root=scratch, publish=schema, fail_on=(), prefix="three_")
    assert 0 < spark.table(f"{schema}.stg_orders").count() < orders and spark.table(panel).count() < record.rows[
        "fct_customer_return_risk_features"]


def test_counts_come_from_footers(spark, scratch):
    from vantage.plans.store import footer_counts
    spark.range(1000).repartition(3).write.parquet(f"{scratch}/a")
    spark.range(7).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(f"{scratch}/b")
    out = footer_counts(spark, {("x", "a"): f"{scratch}/a", ("y", "b"): f"{scratch}/b"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2 and "FileScan" not in plan
    assert sorted(map(tuple, out.collect())) == [("x", "a", 1000), ("y", "b", 7)]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_serving_reads_one_folder_of_the_stored_layer(spark):
    from vantage.plans.pipeline import latest_rows
    from vantage.plans.store import stored_layers
    first, again = stored_layers(spark, SF), stored_layers(spark, SF)
    assert first is again  # nothing changed
    panel = first.layers["gold"]["fct_customer_return_risk_features"]
    plan = latest_rows(panel)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "snapshot_date" in filters and "Subquery" in filters
    last = panel.agg(F.max("snapshot_date")).first()[0]
    assert latest_rows(panel).select("snapshot_date").distinct().collect() == [(last,)]
    assert sorted(map(tuple, latest_rows(panel).collect()), key=repr) == sorted(
        map(tuple, panel.where(F.col("snapshot_date") == F.lit(last)).collect()), key=repr)


def test_a_changed_source_is_stored_again(spark, scratch):
    import shutil
    from vantage.plans.store import stored_layers
    from vantage.sources.tpch import TPCH_TABLES
    for t in TPCH_TABLES:
        shutil.copy(f"{SF}/{t}.parquet", f"{scratch}/{t}.parquet")
    first = stored_layers(spark, scratch)
    half = spark.read.parquet(f"{SF}/orders.parquet").where("o_orderkey % 2 = 0")
    half.coalesce(1).write.parquet(f"{scratch}/half")
    part = next(f for f in os.listdir(f"{scratch}/half") if f.endswith(".parquet"))
    shutil.copy(f"{scratch}/half/{part}", f"{scratch}/orders.parquet")
    spark.catalog.clearCache()
    second = stored_layers(spark, scratch)
    assert second is not first
    assert second.layers["silver"]["stg_orders"].count() < first.layers["silver"]["stg_orders"].count()


def test_scratch_tables_are_removed_on_request(spark, scratch):
    import subprocess
    import sys
    code = (
        "import os\n"
        "from vantage.session import clear_scratch, get_session, scratch_root\n"
        f"spark = get_session('local[1]', extra={{'spark.checkpoint.dir': '{scratch}/shared'}})\n"
        "from vantage.plans.pipeline import staging_root\n"
        "spark.range(3).write.parquet(staging_root(spark) + '/t')\n"
        "root = scratch_root(spark).removeprefix('file:')\n"
        f"assert root.startswith('{scratch}/shared'), root\n"
        "assert os.path.isdir(root)\n"
        "clear_scratch(spark)\n"
        "assert not os.path.exists(root)\n"
        "print('cleared')\n")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                          cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "cleared" in done.stdout, done.stderr[-2000:]
