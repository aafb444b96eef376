"""Skew and plan-shape rules: a hot key holding a third of the rows, the
skew-split lag, and the layered pipeline."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vantage.plans.gold import FEATURE_COLUMNS, fct_customer_return_risk_features

from test_pit import SCHEMA, _random_facts, direct_features, rows_by_key


def _hot_facts(seed=5, n=300):
    rows = _random_facts(seed, n=n)
    # a third of all facts belong to one customer
    return [(r[0], "HOT" if i % 3 == 0 else r[1]) + r[2:] for i, r in enumerate(rows)]


def test_hot_entity_scale_equals_direct(spark):
    facts = spark.createDataFrame(_hot_facts(), SCHEMA)
    a = rows_by_key(fct_customer_return_risk_features(facts))
    b = rows_by_key(direct_features(facts))
    assert a.keys() == b.keys()
    hot = [k for k in a if k[0] == "HOT"]
    last = max(hot)[1]
    counted = sum(1 for r in _hot_facts() if r[1] == "HOT" and r[4] <= dt.datetime.combine(last, dt.time()))
    assert hot and a[max(hot)].total_orders_lifetime == counted > 80
    for k in a:
        for c in FEATURE_COLUMNS[2:]:
            x, y = getattr(a[k], c), getattr(b[k], c)
            assert (x == pytest.approx(y)) if isinstance(x, float) else x == y, (k, c)


def test_scale_plan_has_no_cross_or_nested_loop_over_facts(spark):
    facts = spark.createDataFrame(_hot_facts(), SCHEMA)
    plan = fct_customer_return_risk_features(facts)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan   # join-free
    # the only nested-loop join attaches the one-row spine bounds
    assert plan.count("BroadcastNestedLoopJoin") <= 1


def test_skew_split_lag_equals_plain_lag(spark):
    from vantage.plans.extended import previous_event_ts
    rnd = random.Random(3)
    rows = [(f"o{i}", "HOT" if i % 3 == 0 else rnd.choice("ABC"),
             dt.datetime(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 200))) for i in range(400)]
    df = spark.createDataFrame(rows, "order_id string, cust string, ts timestamp_ntz")
    got = {r.order_id: r.prev_ts for r in previous_event_ts(df, "cust", "ts", "order_id").collect()}
    w = Window.partitionBy("cust").orderBy("ts", "order_id")
    want = {r.order_id: r.p for r in df.select("order_id", F.lag("ts").over(w).alias("p")).collect()}
    assert got == want


def test_hot_customer_is_dealt_out_by_bucket(spark):
    """The exchange under the lag window is on (entity, bucket), also after a join on the entity."""
    from vantage.plans.extended import previous_event_ts
    rows = [(f"o{i}", "HOT" if i % 3 == 0 else f"c{i % 50}", dt.datetime(2020, 1, 1) + dt.timedelta(hours=i)) for i in range(600)]
    df = spark.createDataFrame(rows, "order_id string, cust string, ts timestamp_ntz")
    customers = df.select("cust").distinct().withColumn("state", F.lit("SP"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = previous_event_ts(df.join(customers, "cust", "left"), "cust", "ts", "order_id")._jdf \
            .queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines = plan.split("\n")
    lag = next(i for i, line in enumerate(lines) if "Window [lag(ts" in line)
    exchange = next(line for line in lines[lag:] if "Exchange" in line)
    assert "hashpartitioning(cust" in exchange and "_bucket" in exchange


def test_event_panel_has_one_plan_at_every_size(spark):
    import re
    from vantage.plans.queries import REGISTRY
    shapes = set()
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        plan = REGISTRY["pit_event_features"](spark, f"/root/testdata/{sf}")._jdf.queryExecution().optimizedPlan().toString()
        shapes.add(tuple(re.findall(r"^[\s:+-]*([A-Z]\w+)", plan, re.M)))
    assert len(shapes) == 1


def test_run_stops_at_a_failed_silver_check(spark, scratch, monkeypatch):
    from vantage.operators.quality import QualityGateError
    from vantage.plans import pipeline
    from vantage.sources.tpch import raw_from_tpch
    raw = raw_from_tpch(spark, "/root/testdata/sf0.001")
    plain = pipeline.build_silver

    def doubled(raw):
        out = dict(plain(raw))
        out["stg_orders"] = out["stg_orders"].unionByName(out["stg_orders"])
        return out
    monkeypatch.setattr(pipeline, "build_silver", doubled)
    with pytest.raises(QualityGateError, match="unique_stg_orders_order_id"):
        pipeline.run_pipeline(spark, raw, root=scratch)


def test_run_pipeline_layers_and_gate(spark, scratch):
    from vantage.operators.quality import ERROR, Check, QualityGateError, gate, run_checks
    from vantage.plans.pipeline import gold_report, run_pipeline
    from vantage.sources.tpch import raw_from_tpch
    raw = raw_from_tpch(spark, "/root/testdata/sf0.001")
    built = run_pipeline(spark, raw, root=scratch)
    fct = built["gold"]["fct_customer_return_risk_features"]
    assert fct.count() > 0 and set(FEATURE_COLUMNS) == set(fct.columns)
    assert spark.table("silver_stg_orders").count() == built["silver"]["stg_orders"].count()
    rep = {r.check_name: r.status for r in gold_report(built).collect()}
    assert rep["unique_int_orders_enriched_order_id"] == "pass"
    assert spark.table("silver_stg_orders").inputFiles()  # read from what was written
    again = run_pipeline(spark, raw, root=scratch + "/g", layers=("gold",), previous=built)
    assert again["gold"]["fct_customer_return_risk_features"].count() == fct.count()
    report = run_checks([Check("stg_orders", "unique", "order_id")], {
        "stg_orders": built["silver"]["stg_orders"].unionByName(built["silver"]["stg_orders"])})
    assert gate(report).first().status == "warn" and report.first().message.startswith("got ")
    with pytest.raises(QualityGateError):
        gate(report, ("error", "warn"))
    dup = built["silver"]["stg_orders"].unionByName(built["silver"]["stg_orders"].limit(1))
    with pytest.raises(QualityGateError):
        gate(run_checks([Check("t", "unique", "order_id", severity=ERROR)], {"t": dup}))


def test_panel_fans_out_in_partitions_of_its_own_size(spark):
    facts = spark.createDataFrame(_hot_facts(), SCHEMA)
    sized = fct_customer_return_risk_features(facts, parts=7)
    plan = sized._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(customer_unique_id" in plan and ", 7), REPARTITION_BY_NUM" in plan
    assert rows_by_key(sized) == rows_by_key(fct_customer_return_risk_features(facts))


def test_stored_panel_is_written_in_tasks_sized_by_its_rows(spark, scratch, monkeypatch):
    """As many tasks as its rows need, whatever AQE would make of the bytes shuffled."""
    from vantage.plans import pipeline
    from vantage.sources.tpch import raw_from_tpch
    sizes, plain = [], pipeline.write_checked

    def seen(df, path, checks=(), by=None, parts=None, near=None):
        if by:
            sizes.append(parts)
        return plain(df, path, checks, by, parts, near)
    monkeypatch.setattr(pipeline, "write_checked", seen)
    monkeypatch.setattr(pipeline, "PANEL_ROWS", 100)
    record = pipeline.Record()
    built = pipeline.run_pipeline(spark, raw_from_tpch(spark, "/root/testdata/sf0.001"), root=scratch, fail_on=(), record=record)
    panel = built["gold"]["fct_customer_return_risk_features"]
    rows = record.rows["fct_customer_return_risk_features"]
    assert sizes and sizes[0] >= rows / 100 and panel.count() == rows
    files = panel.groupBy(F.input_file_name().alias("f")).count()
    assert files.agg(F.max("count")).first()[0] < 100


def test_partitioned_write_splits_a_large_value(spark, scratch):
    from vantage.operators.quality import write_checked
    df = spark.range(20000).select("id", F.when(F.col("id") < 19000, 1).otherwise(F.col("id") % 5).alias("p"))
    out, rows, _ = write_checked(df, f"{scratch}/t", by="p", parts=64)
    assert rows == out.count() == 20000 and sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    assert out.groupBy(F.input_file_name().alias("f")).count().agg(F.max("count")).first()[0] < 6000


def test_neighbouring_values_stay_together_on_their_way(spark):
    from vantage.operators.quality import _dealt
    df = spark.range(600).select((F.col("id") % 20).alias("id"), F.floor(F.col("id") / 20).alias("p"))
    at = (_dealt(df, "p", 16, "p div 10").select("id", (F.col("p") / 10).cast("int").alias("near"), F.spark_partition_id().alias("at"))
          .groupBy("near", "id").agg(F.count_distinct("at").alias("n"), F.count(F.lit(1)).alias("rows")))
    assert {(r.n, r.rows) for r in at.collect()} == {(1, 10)}


def test_enriched_orders_meet_their_customer_while_narrow(spark):
    from vantage.plans.queries import layers
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        enriched = layers(spark, "/root/testdata/sf0.001")[2]
        plan = enriched._jdf.queryExecution().optimizedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    on = [line for line in plan if "Join LeftOuter, (customer_unique_id" in line or "Join LeftOuter, (order_id" in line]
    assert "customer_unique_id" in on[-1]  # below the three joins by order
