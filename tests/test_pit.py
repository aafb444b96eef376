"""Point-in-time engine: hand cases, scale == direct on random inputs, and the
leakage property."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vantage.operators.pit import Feature, eligible_pairs, point_in_time_features, time_spine
from pit_direct import pit_direct
from vantage.plans.gold import FEATURE_COLUMNS, fct_customer_return_risk_features, return_risk_features

SCHEMA = ("order_id string, customer_unique_id string, customer_state string, order_status string, "
          "order_purchase_ts timestamp_ntz, is_cancelled_post_approval boolean, order_value double, "
          "primary_seller_id string, review_score int, is_low_review_delivered boolean, "
          "customer_seller_distance_km double")


def T(s):
    return dt.datetime.fromisoformat(s)


def order(oid, cust, ts, state="SP", status="delivered", cancel=False, value=10.0, seller="s1",
          review=5, dist=100.0):
    low = status == "delivered" and review is not None and review <= 2
    return (oid, cust, state, status, T(ts) if ts else None, cancel, value, seller, review, low, dist)


def direct_features(facts, lead="1 month"):
    return pit_direct(facts, "customer_unique_id", "order_purchase_ts", return_risk_features(),
                      lead=lead).select(*FEATURE_COLUMNS)


def rows_by_key(df):
    return {(r.customer_unique_id, r.snapshot_date): r for r in df.collect()}


def test_boundaries_and_lookahead(spark):
    facts = spark.createDataFrame([
        order("a1", "A", "2020-01-01 00:00:00"),            # exactly on a month start
        order("a2", "A", "2020-02-01 00:00:01", seller="s2"),
        order("a3", "A", "2020-03-02 00:00:00", cancel=True, status="canceled"),  # 30 d before 2020-04-01
        order("b1", "B", "2020-03-25 00:00:00", state="RJ"),  # 7 d before 2020-04-01
        order("z1", "Z", "2020-04-15 00:00:00"),              # after the last month start: counted nowhere
    ], SCHEMA)
    for form in (fct_customer_return_risk_features, direct_features):
        got = rows_by_key(form(facts))
        d = dt.date
        assert got[("A", d(2020, 1, 1))].total_orders_lifetime == 1          # inclusive bound
        assert got[("A", d(2020, 2, 1))].total_orders_lifetime == 1          # 00:00:01 not yet counted
        assert got[("A", d(2020, 3, 1))].total_orders_lifetime == 2
        assert got[("A", d(2020, 4, 1))].orders_last_30d == 1                # closed 30 d window
        assert got[("A", d(2020, 4, 1))].cancel_post_approval_count_30d == 1
        assert got[("A", d(2020, 4, 1))].cancel_rate_lifetime == pytest.approx(1 / 3)
        assert got[("B", d(2020, 4, 1))].orders_last_7d == 1                 # closed 7 d window
        assert got[("B", d(2020, 3, 1))].total_orders_lifetime == 0          # look-ahead row, all empty
        assert got[("B", d(2020, 3, 1))].customer_state is None
        assert got[("B", d(2020, 3, 1))].avg_review_score is None
        assert ("B", d(2020, 2, 1)) not in got
        z = got[("Z", d(2020, 4, 1))]                                          # eligible via look-ahead
        assert z.total_orders_lifetime == 0 and z.days_since_first_order is None
        assert sorted({k[1] for k in got}) == [d(2020, m, 1) for m in (1, 2, 3, 4)]


def test_strict_lead_drops_lookahead_rows(spark):
    facts = spark.createDataFrame([order("b1", "B", "2020-03-25 00:00:00"),
                                   order("c1", "C", "2020-01-10 00:00:00")], SCHEMA)
    got = rows_by_key(fct_customer_return_risk_features(facts, lead="0 days"))
    assert all(r.total_orders_lifetime >= 1 for r in got.values())


def _random_facts(seed, n=120):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        cust = rnd.choice("ABCDE")
        day = dt.datetime(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 150),
                                                     seconds=rnd.choice([0, 0, 1, 3600, 86399]))
        status = rnd.choice(["delivered", "canceled", "processing"])
        review = rnd.choice([None, 1, 2, 3, 5])
        rows.append((f"o{i}", cust, rnd.choice(["SP", "RJ", None]), status, day,
                     status == "canceled" and rnd.random() < 0.7, float(rnd.randint(0, 500)),
                     rnd.choice(["s1", "s2", "s3", None]), review,
                     status == "delivered" and review is not None and review <= 2,
                     rnd.choice([None, 10.0, 250.5])))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scale_equals_direct_monthly(spark, seed):
    facts = spark.createDataFrame(_random_facts(seed), SCHEMA)
    a = rows_by_key(fct_customer_return_risk_features(facts))
    if seed == 3:   # the coverage path on the monthly table as well
        cov = point_in_time_features(facts, "customer_unique_id", "order_purchase_ts", return_risk_features(),
                                     distinct="coverage").select(*FEATURE_COLUMNS)
        a = rows_by_key(cov)
    b = rows_by_key(direct_features(facts))
    assert a.keys() == b.keys()
    for k in a:
        for c in FEATURE_COLUMNS[2:]:
            x, y = getattr(a[k], c), getattr(b[k], c)
            assert (x == pytest.approx(y)) if isinstance(x, float) else x == y, (k, c, x, y)


@pytest.mark.parametrize("distinct", ["explode", "coverage"])
def test_scale_equals_direct_daily_windows(spark, distinct):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([1, 2, 3]), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20)),
             rnd.choice(["click", "view", "purchase"]), float(rnd.randint(1, 9))) for i in range(300)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double")
    feats = [Feature("n", "count", "event_id"), Feature("n24", "count", "event_id", window="24 hours"),
             Feature("v7", "sum", "value", window="7 days", default=0.0),
             Feature("types7", "count_distinct", "event_type", window="7 days"),
             Feature("mx", "max", "value", window="30 days"), Feature("last", "days_since_max"),
             Feature("r", "rate", "event_id", where=F.col("event_type") == "purchase"),
             Feature("avg", "avg", "value")]
    kw = dict(unit="day", lead="1 day")
    feats.append(Feature("types20", "count_distinct", "event_type", window="20 days"))
    a = {(r.user_id, r.snapshot_date): r for r in
         point_in_time_features(ev, "user_id", "ts", feats, distinct=distinct, **kw).collect()}
    b = {(r.user_id, r.snapshot_date): r for r in
         pit_direct(ev, "user_id", "ts", feats, **kw).collect()}
    assert a.keys() == b.keys() and len(a) > 30
    for k in a:
        for f in feats:
            x, y = getattr(a[k], f.name), getattr(b[k], f.name)
            assert (x == pytest.approx(y)) if isinstance(x, float) else x == y, (k, f.name, x, y)


def test_latest_snapshot_equals_the_last_rows_of_the_panel(spark):
    for seed in (4, 5):
        facts = spark.createDataFrame(_random_facts(seed), SCHEMA)
        panel = rows_by_key(fct_customer_return_risk_features(facts))
        last = max(d for _, d in panel)
        got = rows_by_key(fct_customer_return_risk_features(facts, snapshots="latest"))
        assert got.keys() == {k for k in panel if k[1] == last}
        for k, r in got.items():
            for c in FEATURE_COLUMNS[2:]:
                x, y = getattr(r, c), getattr(panel[k], c)
                assert (x == pytest.approx(y)) if isinstance(x, float) else x == y, (k, c, x, y)
    plan = fct_customer_return_risk_features(facts, snapshots="latest")._jdf.queryExecution().toString()
    assert "Window" not in plan and "Generate" not in plan  # neither running values nor fan-out


def test_no_leakage_from_later_facts(spark):
    """Adding facts later than snapshot s must not change any feature of rows
    with snapshot <= s (rows may be added, values may not move)."""
    base = _random_facts(11, n=80)
    cut = dt.datetime(2020, 3, 1)
    early = [r for r in base if r[4] <= cut]
    later = [r for r in base if r[4] > cut]
    a = rows_by_key(fct_customer_return_risk_features(spark.createDataFrame(early, SCHEMA)))
    b = rows_by_key(fct_customer_return_risk_features(spark.createDataFrame(early + later, SCHEMA)))
    checked = 0
    for k, ra in a.items():
        if k[1] <= cut.date():
            rb = b[k]
            for c in FEATURE_COLUMNS[2:]:
                x, y = getattr(ra, c), getattr(rb, c)
                assert (x == pytest.approx(y)) if isinstance(x, float) else x == y, (k, c)
            checked += 1
    assert checked > 5


def test_review_written_after_a_snapshot_leaves_it_alone(spark):
    from vantage.plans.gold import review_dated_features
    facts = spark.createDataFrame([order("a1", "A", "2020-01-10 00:00:00", review=1), order("a2", "A", "2020-02-10 00:00:00"),
                                   order("a3", "A", "2020-04-15 00:00:00", review=None)], SCHEMA)
    dates = "order_id string, review_creation_date date"
    early = spark.createDataFrame([("a1", dt.date(2020, 3, 5)), ("a2", dt.date(2020, 1, 1))], dates)
    late = spark.createDataFrame([("a1", dt.date(2020, 9, 5)), ("a2", dt.date(2020, 1, 1))], dates)
    got, later = (rows_by_key(review_dated_features(facts, r)) for r in (early, late))
    score = {k[1].month: (r.avg_review_score, r.low_review_on_delivered_rate, r.total_orders_lifetime) for k, r in got.items()}
    assert score == {1: (None, 0.0, 0), 2: (None, 0.0, 1), 3: (5.0, 0.0, 2), 4: (3.0, 0.5, 2)}
    assert [k for k in got if got[k] != later[k]] == [("A", dt.date(2020, 4, 1))] and got.keys() == later.keys()
    plain = rows_by_key(fct_customer_return_risk_features(facts))
    for k, r in got.items():
        assert r.orders_last_30d == plain[k].orders_last_30d and r.cancel_rate_lifetime == plain[k].cancel_rate_lifetime


def test_spine_and_pairs(spark):
    facts = spark.createDataFrame([order("a", "A", "2020-01-15 10:00:00"), order("b", "B", "2020-03-01 00:00:00"),
                                   order("n", None, "2020-02-01 00:00:00")], SCHEMA)
    spine = [r.snapshot_date for r in time_spine(facts, "order_purchase_ts").orderBy("snapshot_date").collect()]
    assert spine == [dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 3, 1)]
    pairs = sorted((r.customer_unique_id, r.snapshot_date.month) for r in
                   eligible_pairs(facts, "customer_unique_id", "order_purchase_ts").collect())
    assert pairs == [("A", 1), ("A", 2), ("A", 3), ("B", 2), ("B", 3)]
    plan = eligible_pairs(facts, "customer_unique_id", "order_purchase_ts")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_aligned_windows_closed_lower_bound(spark):
    """Facts exactly on d - n (midnight) count; one second earlier they do not."""
    from vantage.operators.pit import aligned_steps
    assert aligned_steps("24 hours", "day") == 1 and aligned_steps("7 days", "day") == 7
    assert aligned_steps("30 days", "month") is None and aligned_steps("36 hours", "day") is None
    base = dt.datetime(2024, 1, 10)
    rows = [(1, 1, base - dt.timedelta(days=7), 1.0), (2, 1, base - dt.timedelta(days=7, seconds=1), 2.0),
            (3, 1, base - dt.timedelta(days=1), 4.0), (4, 1, base - dt.timedelta(days=1, seconds=1), 8.0),
            (5, 1, base, 16.0), (6, 2, base - dt.timedelta(days=3, hours=5), 32.0), (7, 1, base + dt.timedelta(days=3), 0.5)]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, value double")
    feats = [Feature("n24", "count", "event_id", window="24 hours"),
             Feature("v7", "sum", "value", window="7 days", default=0.0),
             Feature("a7", "avg", "value", window="7 days"),
             Feature("mn7", "min", "value", window="7 days"),
             Feature("r7", "rate", "event_id", where=F.col("value") > 3, window="7 days")]
    kw = dict(unit="day", lead="0 days")
    a = {(r.user_id, r.snapshot_date): r for r in point_in_time_features(ev, "user_id", "ts", feats, **kw).collect()}
    b = {(r.user_id, r.snapshot_date): r for r in
         pit_direct(ev, "user_id", "ts", feats, **kw).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for f in feats:
            x, y = getattr(a[k], f.name), getattr(b[k], f.name)
            assert (x == pytest.approx(y)) if isinstance(x, float) else x == y, (k, f.name, x, y)
    r = a[(1, base.date())]
    assert r.n24 == 2 and r.v7 == 1.0 + 2.0 * 0 + 4.0 + 8.0 + 16.0


DOMAIN = "entity string, ts timestamp_ntz, word string, size long"


def _domain_features(domain):
    return [Feature("last", "max", "word", domain=domain), Feature("first", "min", "word", domain=domain),
            Feature("last_30d", "max", "word", window="30 days", domain=domain),
            Feature("words_30d", "count_distinct", "word", window="30 days", domain=domain),
            Feature("words_7d", "count_distinct", "word", where=F.col("size") > 3, window="7 days", domain=domain),
            Feature("sizes_30d", "count_distinct", "size", window="30 days", domain=domain and 10),
            Feature("n", "count", "word")]


@pytest.mark.parametrize("snapshots", ["all", "latest"])
def test_small_domains_equal_the_plain_form(spark, snapshots):
    rnd = random.Random(6)
    words = [f"w{i}" * (i % 5) for i in range(63)] + ["é", None]
    rows = [(rnd.choice("ABCD"), T("2020-01-01") + dt.timedelta(hours=rnd.randint(0, 3000)), rnd.choice(words), rnd.randint(0, 9))
            for _ in range(500)]
    facts = spark.createDataFrame(rows + [("E", T("2020-02-03"), None, None)], DOMAIN)
    forms = [{(r.entity, r.snapshot_date): r.asDict() for r in point_in_time_features(
        facts, "entity", "ts", _domain_features(d), snapshots=snapshots).collect()} for d in (64, None)]
    assert forms[0] == forms[1] and len(forms[0]) > 3
    assert max(r["words_30d"] for r in forms[0].values()) > 20
    assert any(r["last"] == "é" for r in forms[0].values())


def test_a_domain_with_more_values_fails(spark):
    facts = spark.createDataFrame([("A", T("2020-01-01"), f"w{i}", 1) for i in range(9)], DOMAIN)
    with pytest.raises(Exception, match="word: more than 8 values"):
        point_in_time_features(facts, "entity", "ts", _domain_features(8)).collect()
    with pytest.raises(ValueError):
        Feature("x", "count", "word", domain=4)


def test_panel_hashes_above_the_exploded_facts(spark):
    """No sort aggregate and no Expand between the facts' explode and the panel."""
    from vantage.plans.queries import REGISTRY
    for name in ("pit_customer_features", "pit_customer_features_review_dated"):
        plan = REGISTRY[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        above = plan[:plan.index("Generate explode(CASE WHEN (CASE WHEN")].split("\n")
        above = "\n".join(line for line in above if not line.lstrip().startswith(":"))  # not the subqueries beside
        assert above.count("HashAggregate") >= 4 and "SortAggregate" not in above
        assert "Expand" not in plan
