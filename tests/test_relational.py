import datetime as dt
import random

from pyspark.sql import functions as F

from vantage.operators.relational import arg_max, arg_min, keep_first, keep_latest, range_lookup, range_totals
from vantage.plans.gold import payments_per_order, primary_seller
from vantage.plans.silver import stg_customers, stg_orders


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def test_keep_first_nulls_last(spark):
    df = spark.createDataFrame([("o1", None, "a"), ("o1", ts("2020-01-02 00:00:00"), "b"),
                                ("o1", ts("2020-01-03 00:00:00"), "c")], "k string, t timestamp_ntz, v string")
    got = keep_first(df, ["k"], ["t"]).collect()
    assert [r.v for r in got] == ["b"]


def test_keep_first_is_planned_with_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = keep_first(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_keep_latest_desc_nulls_last(spark):
    df = spark.createDataFrame([("c", None, 1), ("c", 5, 2), ("c", 3, 3)], "k string, t int, v int")
    assert [r.v for r in keep_latest(df, ["k"], ["t"]).collect()] == [2]


def test_arg_max_ties_and_nulls(spark):
    pays = spark.createDataFrame(
        [("o1", 1, "voucher", 1, 10.0), ("o1", 2, "boleto", 1, 10.0),      # tie on value -> greatest type
         ("o2", 1, None, 1, 50.0), ("o2", 2, "credit_card", 1, 20.0),      # NULL type at the max is skipped
         ("o3", 1, "boleto", 3, None)],                                     # no usable slice -> NULL
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    got = {r.order_id: r for r in payments_per_order(pays).collect()}
    assert got["o1"].primary_payment_type == "voucher" and got["o1"].order_value == 20.0
    assert got["o2"].primary_payment_type == "credit_card" and got["o2"].payment_slices == 2
    assert got["o3"].primary_payment_type is None and got["o3"].max_installments == 3


def test_arg_min_primary_seller(spark):
    items = spark.createDataFrame([("o1", 2, "s9"), ("o1", 1, "s5"), ("o1", 1, "s3"), ("o2", None, "s1")],
                                  "order_id string, order_item_id int, seller_id string")
    got = {r.order_id: r.primary_seller_id for r in primary_seller(items).collect()}
    assert got == {"o1": "s3", "o2": None}


def test_range_lookup_half_open(spark):
    from vantage.sources.seeds import seed_frame
    df = spark.createDataFrame([(0.0,), (0.3,), (0.849,), (0.85,), (1.5,), (None,)], "s double")
    out = range_lookup(df, "s", seed_frame(spark, "risk_thresholds"), "lower_bound_inclusive",
                       "upper_bound_exclusive")
    got = [(r.s, r.tier) for r in out.orderBy(F.col("s").asc_nulls_last()).collect()]
    assert got == [(0.0, "low"), (0.3, "medium"), (0.849, "high"), (0.85, "critical"), (1.5, None), (None, None)]


def test_range_lookup_equals_a_plain_join(spark):
    rnd = random.Random(4)
    inf, nan = float("inf"), float("nan")
    lows = [rnd.choice([rnd.uniform(0, 1), rnd.uniform(0, 1e6), -rnd.random()]) for _ in range(300)] + [7.0] * 20
    ranges = [(i, a, a + rnd.choice([1e-3, 0.1, 5.0, 3e5])) for i, a in enumerate(lows)]
    ranges += [(900, None, 1.0), (901, 1.0, None), (902, 5.0, 5.0), (903, 6.0, 2.0), (904, -inf, -2.0), (905, 1e9, inf)]
    values = [rnd.choice([rnd.uniform(-1, 2), rnd.uniform(0, 1e6), rnd.choice(lows), 0.5]) for _ in range(400)]
    values += [None, inf, -inf, nan, -3.0, 2e9] + [0.25] * 200
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    r = spark.createDataFrame(ranges, "band int, low double, high double")
    got = sorted((x.id, -1 if x.band is None else x.band) for x in range_lookup(df, "v", r, "low", "high").collect())
    want = []
    for i, v in enumerate(values):
        hits = [b for b, a, z in ranges if v is not None and a is not None and z is not None and a <= v < z]
        want += [(i, b) for b in hits or [-1]]
    assert got == sorted(want) and len(got) > len(values)
    assert range_lookup(df, "v", r.limit(0), "low", "high").where("band IS NULL").count() == len(values)
    whole = spark.range(50).withColumn("v", F.col("id") * 3)
    assert range_lookup(whole, "v", r.where("band = 904 OR low = 7.0"), "low", "high").where("v = 9").count() >= 1


def test_range_lookup_never_loops_over_the_ranges(spark):
    df = spark.range(1000).select((F.col("id") % 100).cast("double").alias("v"))
    r = spark.range(5000).select((F.col("id") / 50).alias("low"), (F.col("id") / 50 + 0.01).alias("high"))
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = range_lookup(df, "v", r, "low", "high")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Broadcast" not in plan and "SortMergeJoin" in plan
        assert out.where("low IS NOT NULL").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_range_lookup_does_not_broadcast_cut_ranges(spark, scratch):
    """A file of narrow ranges is small, cut to cells it is not."""
    spark.range(2000).select((F.col("id") / 50).alias("low"), (F.col("id") / 50 + 20).alias("high")).write.parquet(f"{scratch}/r")
    df = spark.range(1000).select((F.col("id") % 100).cast("double").alias("v"))
    out = range_lookup(df, "v", spark.read.parquet(f"{scratch}/r"), "low", "high")
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_range_totals_equal_the_grouped_lookup(spark, scratch):
    rnd = random.Random(7)
    for turn, (n, wide) in enumerate(((400, 30.0), (600, 900.0), (1, 1.0))):
        bands = []
        for i in range(n):
            low = float(rnd.choice([rnd.randint(0, 900), rnd.randint(0, 90)]))
            for _ in range(rnd.choice([1, 1, 2])):  # a key twice, from the same start
                bands.append((i or None, low, rnd.choice([None, low, low + rnd.random() * wide, low + 5])))
        items = [(rnd.choice([None, *range(150)]), rnd.choice([None, 50.0, float("nan"), rnd.uniform(-20, 1000), float(rnd.randint(0, 90))]))
                 for _ in range(3000)]
        r = spark.createDataFrame(bands, "band int, low double, high double")
        df = spark.createDataFrame(items, "k int, v double")
        got = {x.band: (x.rows, x.keys, repr(x.top)) for x in range_totals(df, "v", "k", r, "low", "high", "band", f"{scratch}/{turn}").collect()}
        want = {x.band: (x.rows, x.keys, repr(x.top)) for x in range_lookup(df, "v", r, "low", "high").groupBy("band").agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("k").alias("keys"), F.max("v").alias("top")).collect()}
        assert got == want
    none = range_totals(df, "v", "k", r.limit(0), "low", "high", "band", f"{scratch}/none").collect()
    assert [(x.band, x.rows) for x in none] == [(None, 3000)]


def test_price_bands_build_no_row_for_each_item_and_band(spark, scratch, monkeypatch):
    from vantage.operators import relational
    from vantage.plans.queries import REGISTRY
    spark.range(4000).selectExpr("id AS l_orderkey", "6000.0D + id % 50 AS l_extendedprice", "0.05D AS l_discount").write.parquet(f"{scratch}/lineitem.parquet")
    spark.range(300).selectExpr("id * 14000 + 100 AS p_partkey", "40 AS p_size").write.parquet(f"{scratch}/part.parquet")
    plain, sizes = relational.range_lookup, []

    def counted(*a):
        out = plain(*a)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(relational, "range_lookup", counted)
    got = REGISTRY["price_bands"](spark, scratch).collect()
    assert len(got) == 301 and sizes == [4000]  # the items, in one segment each


def test_stg_orders_rules(spark):
    orders = spark.createDataFrame([
        ("o1", "c1", "canceled", None, "2020-01-01 10:00:00", None),
        ("o1", "c1", "canceled", "2020-01-01 09:00:00", "2020-01-01 10:00:00", None),  # wins: has a timestamp
        ("o2", "c2", "canceled", "2020-01-02 09:00:00", None, None),                   # no approval -> false
        ("o3", "c2", "canceled", "2020-01-03 09:00:00", "", None),                     # empty text -> NULL
        ("o4", "c3", "delivered", "2020-01-04 09:00:00", "not a date", "2020-01-09 00:00:00"),
    ], "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
       "order_approved_at string, order_delivered_customer_date string")
    customers = spark.createDataFrame([("c1", "u1", "01151", "city", "SP"), ("c2", "u2", "20000", "x", "RJ"),
                                       ("c3", "u2", "30000", "y", "MG")],
                                      "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                                      "customer_city string, customer_state string")
    got = {r.order_id: r for r in stg_orders(orders, customers).collect()}
    assert len(got) == 4
    assert got["o1"].order_purchase_ts == ts("2020-01-01 09:00:00") and got["o1"].is_cancelled_post_approval
    assert got["o2"].is_cancelled_post_approval is False
    assert got["o3"].order_approved_ts is None and got["o3"].is_cancelled_post_approval is False
    assert got["o4"].order_approved_ts is None
    assert got["o1"].customer_zip_code_prefix == "01151"
    dim = {r.customer_unique_id: r for r in stg_customers(customers.union(spark.createDataFrame(
        [("c9", "u9", "99999", "z", "AC")], customers.schema)), orders).collect()}
    assert dim["u2"].customer_state == "MG"          # latest order's state wins
    assert "u9" in dim                                # customer without orders keeps a row
