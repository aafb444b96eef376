import random

import brute
from vantage.llm.decontaminate import decontaminate


def run(spark, docs, items, n):
    d = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, hash int, key string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, span int")
    got = decontaminate(d, b, n=n).collect()
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r["items"]) for r in got)
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got), key=repr)


def test_matches_brute_force(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(30)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(10, 40)))) for i in range(12)]
    items += [(20, items[0][1]), (21, "Three short words"), (22, "ünï CODE-d 9 x"), (23, None), (24, ""), (25, "!!! ?"),
              (None, items[1][1]), (3, "again " + items[2][1])]
    docs = [(i, " ".join(word() for _ in range(rng.randrange(80)))) for i in range(30)]
    docs += [(100 + i, f"{docs[i][1]}, {(t or '').upper()}... {docs[i + 1][1]}") for i, (_, t) in enumerate(items[:15])]
    docs += [(200, None), (201, ""), (202, "three SHORT words"), (203, "ünï-code d 9x"), (204, "Ünï code d 9 x"),
             (205, (items[5][1] + " ") * 50), (None, items[4][1]), (None, "nothing"), (100, docs[0][1]), (100, docs[0][1])]
    assert run(spark, docs, items, 10) == sorted(brute.leaks(docs, items, 10), key=repr)


def test_empty_tables(spark):
    docs, items = [(1, "a b c d e f g h i j k l")], [(1, "a b c d e f g h i j")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate(d.limit(0), b).collect() == []
    assert [(r.n_hit, r.contaminated) for r in decontaminate(d, b.limit(0)).collect()] == [(0, False)]
    assert [(r.n_hit, r["items"]) for r in decontaminate(d, b).collect()] == [(10, ["1"])]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = decontaminate(docs, docs.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_rows_that_repeat_id_and_text(spark):
    item = " ".join(f"w{i}" for i in range(200))
    docs = [(1, item + " end")] * 300 + [(2, "x " + item[:100])]
    got = run(spark, docs, [(7, item)], 10)
    assert got[:300] == [(1, 201, 200, ("7",))] * 300 and got[300][0] == 2
