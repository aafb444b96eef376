import random

import pytest

import brute
from vantage.llm import substring
from vantage.llm.substring import substring_dedup

SCHEMA = "doc_id long, text string, kept string, spans long, id long, mz long"


def run(spark, rows, k, parts=3):
    df = spark.createDataFrame([(i, t, "x", 7, 8, 9) for i, t in rows], SCHEMA).repartition(parts)
    got = substring_dedup(df, k=k).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=repr)


@pytest.mark.parametrize("k", [4, 20])
def test_matches_brute_force_on_copies_passages_and_periods(spark, k):
    rng = random.Random(k)
    texts = brute.near_texts(k)
    texts += [" ".join(["a", "b", "c"] * 30), "z " * 90, "a b c " * 10 + "d", texts[0] + "\n" + texts[0], texts[3] * 3]
    texts += [None, "", "   \t\n", "one two", " ".join(f"u{rng.randrange(9)}" for _ in range(3000)), "x" * 5000]
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, texts[0])]
    assert run(spark, rows, k) == sorted(brute.cut_repeats(rows, k), key=repr)


def test_rows_that_repeat_an_id(spark):
    text, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, text), (1, text), (1, other), (2, text), (2, other)]
    assert run(spark, rows, 20) == sorted(brute.cut_repeats(rows, 20), key=repr)


def test_hot_passage_in_every_text_stays_once(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(i, f"x{i} {passage} y{i}") for i in range(300)]
    got = run(spark, rows, 20, parts=7)
    assert [r for r in got if r[2] == 0] == [(0, 57, 0, f"x0 {passage} y0")]
    assert {r[3] for r in got if r[0]} == {f"x{i} y{i}" for i in range(1, 300)}


def test_spans_and_empty_table(spark):
    text = " ".join(f"a{i}" for i in range(30))
    df = spark.createDataFrame([(1, text), (2, "q " + text)], "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in substring_dedup(df, k=20).collect()}
    assert got == {1: [], 2: [(1, 31)]}
    assert substring_dedup(df.limit(0), k=20).collect() == []
    carried = substring_dedup(df, k=20, carry=True).where("doc_id = 2").first()
    assert carried.row.text == "q " + text and carried.kept == "q"


def test_frequent_minimizers_are_spread_over_their_contents(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(substring, "SPREAD", 3)
    mins, content = np.array([5, 7, 5, 5, 5, 7, 5], np.uint64), np.arange(10, 17, dtype=np.uint64)
    key, split = substring._spread(mins, content)
    assert split.tolist() == [False, False, False, True, True, False, True]
    assert (key[~split] == mins[~split]).all() and len(set(key[split].tolist())) == 3
    rng = random.Random(7)
    phrase = " ".join(f"f{i}" for i in range(6))
    word = lambda: f"w{rng.randrange(40)}"
    shared = [" ".join(word() for _ in range(25)) + f" {phrase} " + " ".join(word() for _ in range(25)) for _ in range(12)]
    texts = []
    for i in range(120):  # one phrase in different sentences, some of them shared, some cut short
        around = f"{word()} {word()} {phrase} " + " ".join(word() for _ in range(rng.randrange(30)))
        texts.append(f"{around} {rng.choice(shared)[rng.randrange(60):]} {word()}")
    rows = list(enumerate(texts))
    for parts in (1, 5):
        assert run(spark, rows, 8, parts=parts) == sorted(brute.cut_repeats(rows, 8), key=repr)
