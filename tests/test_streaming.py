import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.sources.raw import SCHEMAS
from vantage.streaming.ingest import ingest_new_files, land_csv


def test_available_now_ingest_is_once_per_file(spark, scratch):
    landing, sink, ckpt = (os.path.join(scratch, d) for d in ("landing", "bronze", "ckpt"))
    base = spark.range(100).select(F.col("id").cast("string").alias("order_id"), F.lit("c").alias("customer_id"),
                                   F.lit("delivered").alias("order_status"),
                                   F.lit("2020-01-01 00:00:00").alias("order_purchase_timestamp"),
                                   *[F.lit(None).cast("string").alias(c) for c in
                                     ("order_approved_at", "order_delivered_carrier_date",
                                      "order_delivered_customer_date", "order_estimated_delivery_date")])
    land_csv(base, landing)
    r1 = ingest_new_files(spark, landing, SCHEMAS["orders"], sink, ckpt)
    r2 = ingest_new_files(spark, landing, SCHEMAS["orders"], sink, ckpt)
    land_csv(base.limit(50), landing)
    r3 = ingest_new_files(spark, landing, SCHEMAS["orders"], sink, ckpt)
    assert (r1["input_rows"], r2["input_rows"], r3["input_rows"]) == (100, 0, 50)
    out = spark.read.parquet(sink)
    assert out.count() == 150
    assert {"_loaded_at", "_source_file"} <= set(out.columns)


def _orders(spark, ids, status):
    return spark.createDataFrame([(f"o{i}", status) for i in ids], "order_id string, status string")


def test_changed_files_replace_their_rows(spark, scratch):
    from vantage.streaming.upsert import current_rows, ledger, list_files, upsert_files
    schema = T.StructType([T.StructField("order_id", T.StringType()), T.StructField("status", T.StringType())])
    landing, table, ckpt = (os.path.join(scratch, d) for d in ("land", "table", "ckpt"))
    os.makedirs(landing)
    assert upsert_files(spark, landing, schema, table, ckpt) == {"files": 0, "rows": 0}
    assert current_rows(spark, table, schema).collect() == []

    def deliver(name, rows, at=None):
        path = os.path.join(landing, name)
        with open(path, "w") as f:
            f.write("order_id,status\n" + "".join(f"{a},{b}\n" for a, b in rows))
        if at:
            os.utime(path, (at, at))

    def rows():
        return sorted((r.order_id, r.status, r._source_file) for r in current_rows(spark, table, schema).collect())

    deliver("a b.csv", [("o1", "new"), ("o2", "new")], 1_700_000_000)
    deliver("c.csv", [("o3", "new")], 1_700_000_000)
    assert upsert_files(spark, landing, schema, table, ckpt) == {"files": 2, "rows": 3}
    assert upsert_files(spark, landing, schema, table, ckpt) == {"files": 0, "rows": 0}
    before = rows()
    assert before == [("o1", "new", "a b.csv"), ("o2", "new", "a b.csv"), ("o3", "new", "c.csv")]

    # same length, other time: delivered again; one emptied; one new
    deliver("a b.csv", [("o1", "old"), ("o9", "new")], 1_700_000_100)
    deliver("c.csv", [])
    deliver("d.csv", [("o4", "new")])

    def refuse(new):
        assert sorted(r.order_id for r in new.collect()) == ["o1", "o4", "o9"]
        raise RuntimeError("no")
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            upsert_files(spark, landing, schema, table, ckpt, gate=refuse)
        assert rows() == before
    assert upsert_files(spark, landing, schema, table, ckpt) == {"files": 3, "rows": 3}
    assert rows() == [("o1", "old", "a b.csv"), ("o4", "new", "d.csv"), ("o9", "new", "a b.csv")]
    assert {r.rows for r in ledger(spark, table).collect()} == {0, 1, 2}
    # a file that changes again before a refused batch is tried again
    deliver("d.csv", [("o5", "new")], 1_700_000_200)
    with pytest.raises(StreamingQueryException):
        upsert_files(spark, landing, schema, table, ckpt, gate=lambda new: 1 / 0)
    deliver("d.csv", [("o6", "new"), ("o7", "new")], 1_700_000_300)
    got = upsert_files(spark, landing, schema, table, ckpt)
    assert got == {"files": 1, "rows": 2} and [r[0] for r in rows()] == ["o1", "o6", "o7", "o9"]
    plan = list_files(spark, landing)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]  # listing reads no file
    # readers prune to the folders that count
    plan = current_rows(spark, table, schema)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_ingest_counts_do_not_depend_on_the_sink_log(spark, scratch):
    import glob
    landing, sink, ckpt = (os.path.join(scratch, d) for d in ("l", "s", "c"))
    df = _orders(spark, range(10), "x").select("order_id", *(F.lit("2020-01-01 00:00:00").alias(c) for c in SCHEMAS["orders"].names[1:]))
    land_csv(df, landing)
    assert ingest_new_files(spark, landing, SCHEMAS["orders"], sink, ckpt)["input_rows"] == 10
    for f in glob.glob(f"{sink}/_spark_metadata/0"):
        os.rename(f, f + ".compact")  # as after many batches
    land_csv(df.limit(4), landing)
    assert ingest_new_files(spark, landing, SCHEMAS["orders"], sink, ckpt)["input_rows"] == 4
