import random

import pytest

import brute
from vantage.llm import jaccard
from vantage.llm.components import components


def run(spark, rows, k, num, parts=3):
    df = spark.createDataFrame([(i, t, 5, "s") for i, t in rows], "doc_id long, text string, id int, set string")
    return jaccard.jaccard_components(df.repartition(parts), k=k, num=num, den=100).collect()


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80)])
def test_matches_brute_force(spark, k, num):
    texts = brute.near_texts(7, n=90, size=200) + [None, "", " ", "a", "A", "a b", "b a", "a b c", "x" * 3000]
    rows = [(i * 7 % 997, t) for i, t in enumerate(texts)] + [(None, texts[0])]
    got = run(spark, rows, k, num)
    want = brute.similar_groups(rows, k, num, 100)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    sizes = {i: len(brute.shingles(t, k)) for i, t in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in got) and len(got) == len(rows)


def test_large_group_of_near_copies_is_compared_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "DENSE", 4)
    monkeypatch.setattr(jaccard, "CHUNK", 8)
    rng = random.Random(2)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(100)]
    rows = []
    for i in range(70):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in run(spark, rows, 3, 90)}
    assert got == brute.similar_groups(rows, 3, 90, 100)
    assert len(set(got.values())) > 1  # some copies differ too much


def test_empty_table_and_components(spark):
    assert run(spark, [(1, "a")], 3, 90)[0].component_id == 1
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(df).collect() == []
    rng = random.Random(4)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(7, i) for i in range(300, 340)]
    links += [(i, i + 1) for i in range(500, 560)] + [(None, 3), (4, None), (9, 9)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    real = [(a, b) for a, b in links if None not in (a, b) and a != b]
    want = brute.groups({x for e in real for x in e}, real)
    assert {r.id: r.component for r in got} == want and len(got) == len(want)
