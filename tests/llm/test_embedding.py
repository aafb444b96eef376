import numpy as np

import brute
from vantage.llm import embedding


def vectors(seed, n=150, d=24):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    for i in range(n // 2, n):  # near copies, scaled
        x[i] = (x[rng.integers(n // 2)] + rng.standard_normal(d) * rng.uniform(0, 0.35)) * rng.uniform(0.1, 9)
    return x


def brute_force(rows):
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    links = [(a, b) for k, (a, x) in enumerate(ok) for b, y in ok[:k]
             if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.95]
    return links, brute.groups({i for i, _ in rows if i is not None}, links)


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding, "CHUNK", 16)
    x = vectors(1)
    rows = [(int(i * 5 % 901), v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # a group of copies
    rows += [(2000, None), (2001, [0.0] * 24), (2002, [float("nan")] * 24), (2003, [None] * 24), (2004, []),
             (2005, [1.0, 2.0]), (2006, [1.0, 2.0]), (2007, [float("inf")] * 24), (None, rows[3][1])]
    df = spark.createDataFrame([(i, v, 1, "k") for i, v in rows], "vec_id long, embedding array<double>, key int, id string")
    got = embedding.near_duplicates(df.repartition(3)).collect()
    links, want = brute_force(rows)
    assert len(links) > 100 and len(got) == len(rows)
    known = {r.vec_id: r for r in got if r.vec_id is not None}
    count = {i: sum(i in e for e in links) for i in want}
    assert {i: r.component_id for i, r in known.items()} == want
    assert {i: r.n_links for i, r in known.items()} == count
    assert all(r.kept == (r.vec_id == r.component_id) for r in known.values())
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]


def test_rows_that_repeat_an_id_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding.near_duplicates(df).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]
    assert embedding.near_duplicates(df.limit(0)).collect() == []


def test_pigeonhole_shares_add_up():
    for d in (1, 2, 7, 24, 64):
        parts = embedding.blocks(d)
        assert parts[0][0] == 0 and parts[-1][1] == d and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        r = embedding.rotation(d)
        assert np.allclose(r @ r.T, np.eye(d))


def test_one_id_with_different_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (5, [0.01, 1.0, 0.0]), (7, [0.0, 0.0, 1.0]), (7, [0.0, 0.01, 1.0]),
            (9, [0.0, 0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding.near_duplicates(df).collect())
    assert got == [(1, 0, 1, True), (1, 1, 1, True), (5, 1, 1, False), (7, 2, 7, True), (7, 2, 7, True), (9, 2, 7, False)]
