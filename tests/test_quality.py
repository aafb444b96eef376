import pytest

from vantage.operators.quality import (ERROR, Check, QualityGateError, accepted_values, evaluate, expression_is_true,
                                       gate, key_counts, not_null, relationships, report, run_checks, unique,
                                       unique_combination, write_checked)


@pytest.fixture()
def tables(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, "a", 0.5), (2, "b", 1.5), (3, None, None), (None, "a", -1.0), (2, "z", 0.0)],
                                  "pid int, code string, rate double")
    return {"parent": parent, "child": child}


def test_row_checks_null_semantics(tables):
    c = tables["child"]
    assert not_null(c, "code").count() == 1
    assert accepted_values(c, "code", ["a", "b"]).count() == 1          # NULL passes, 'z' fails
    assert expression_is_true(c, "rate", "between 0 and 1").count() == 2  # NULL passes
    assert unique(c, "pid").count() == 1                                  # 2 twice; NULL ignored
    assert unique_combination(c, ["code"]).count() == 1                   # 'a' twice; NULL is a value
    assert relationships(c, "pid", tables["parent"], "id").count() == 1   # 3 orphan; NULL passes


def test_report_and_gate(tables):
    suite = [Check("child", "not_null", "code"), Check("child", "accepted_values", "code", values=("a", "b")),
             Check("child", "expression_is_true", "rate", expression=">= 0"),
             Check("child", "unique", "pid", severity=ERROR),
             Check("child", "relationships", "pid", parent="parent", parent_field="id"),
             Check("parent", "unique", "id", severity=ERROR)]
    rep = {r.check_name: r for r in run_checks(suite, tables).collect()}
    assert rep["not_null_child_code"].failures == 1 and rep["not_null_child_code"].status == "warn"
    assert rep["unique_child_pid"].status == "error"
    assert rep["unique_parent_id"].status == "pass"
    with pytest.raises(QualityGateError):
        gate(run_checks(suite, tables))
    gate(run_checks([suite[-1]], tables))


def test_declared_suites_on_driver_tables(spark):
    from vantage.plans.suites import bronze_suite, gold_suite, seed_suite, silver_suite
    from vantage.sources.seeds import all_seeds
    from vantage.sources.tpch import raw_from_tpch
    n = len(bronze_suite()) + len(silver_suite()) + len(gold_suite()) + len(seed_suite())
    assert n == 64
    tables = {**raw_from_tpch(spark, "/root/testdata/sf0.001"), **all_seeds(spark)}
    suite = bronze_suite() + seed_suite()
    lazily = {r.check_name: r.failures for r in run_checks(suite, tables).collect()}
    got = evaluate(suite, tables)
    assert {r.check.check_name: r.failures for r in got} == lazily and len(got) == len(suite)
    assert lazily["unique_orders_order_id"] > 0 and lazily["relationships_order_reviews_order_id"] > 0


SUITE = [Check("child", "not_null", "code"), Check("child", "accepted_values", "code", values=("a", "b")),
         Check("child", "expression_is_true", "rate", expression=">= 0"),
         Check("child", "unique", "pid", severity=ERROR), Check("child", "unique_combination", columns=("code",)),
         Check("child", "unique_combination", columns=("pid", "code")), Check("child", "unique", "code"),
         Check("child", "relationships", "pid", parent="parent", parent_field="id"),
         Check("parent", "relationships", "id", parent="parent", parent_field="id"),
         Check("parent", "unique", "id", severity=ERROR)]


def test_checks_that_are_run_equal_lazy_ones_and_are_timed(spark, tables):
    lazily = {r.check_name: (r.failures, r.status, r.message) for r in run_checks(SUITE, tables).collect()}
    got = report(spark, evaluate(SUITE, tables)).collect()
    assert [r.check_name for r in got] == [c.check_name for c in SUITE]
    assert {r.check_name: (r.failures, r.status, r.message) for r in got} == lazily
    assert all(r.execution_time > 0 for r in got)
    with pytest.raises(QualityGateError):
        gate(report(spark, evaluate(SUITE, tables)))


def test_row_checks_ride_on_the_write(spark, tables, scratch):
    out, rows, found = write_checked(tables["child"], f"{scratch}/child", SUITE)
    assert rows == 5 == out.count() and [r.failures for r in found] == [1, 1, 1]
    stored = {"child": out, "parent": tables["parent"]}
    asked = []

    class Watched(dict):
        def __getitem__(self, name):
            asked.append(name)
            return super().__getitem__(name)
    got = evaluate(SUITE, Watched(stored), done=found)
    assert [r.failures for r in got] == [r.failures for r in evaluate(SUITE, tables)]
    assert asked.count("child") == 2  # its keys, and its references; no scan for row-level checks
    for none in (tables["child"].limit(0), tables["child"].where("pid > 99")):
        out, rows, found = write_checked(none, f"{scratch}/none-{id(none)}", SUITE)
        assert rows == 0 and [r.failures for r in found] == [0, 0, 0] and out.columns == none.columns


def test_uniqueness_checks_of_a_table_share_one_scan(spark, tables, scratch):
    tables["child"].write.parquet(f"{scratch}/stored")
    keyed = key_counts(spark.read.parquet(f"{scratch}/stored"), [c for c in SUITE if c.table == "child" and "unique" in c.kind])
    assert list(keyed.first()) == [1, 1, 0, 1]
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
