"""Collocations against a plain count of all n-grams."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import vantage.llm.collocations as collocation_module
from vantage.llm.collocations import collocations, count_windows, fold, phrase_counts

DOCS = "doc_id long, text string, lang string"


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
        if words := re.findall(r"[^\x20\x09]+", piece):
            yield words


def grams(rows):
    f = Counter()
    for _, text, lang in rows:
        for w in pieces(text):
            for m in (1, 2, 3, 4):
                f.update((lang if lang is not None else "und", *w[i:i + m]) for i in range(len(w) - m + 1))
    return f


def plain(rows, least, top):
    f = grams(rows)
    total = Counter()
    for k, c in f.items():
        if len(k) == 2:
            total[k[0]] += c
    found = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    out = {}
    for k, a in found.items():
        lang, p = k[0], k[1:]
        if any(100 * b >= 80 * a and len(q) > len(k) and q[0] == lang
               and any(q[1:][i:i + len(p)] == p for i in range(len(q) - len(p))) for q, b in found.items()):
            continue
        score, _, left, right = min((2000000 * a // (f[(lang, *p[:c])] + f[(lang, *p[c:])]), c, f[(lang, *p[:c])], f[(lang, *p[c:])])
                                    for c in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, total[lang], -s)
                  for lang, rows_ in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rows_)[:top]))


def sample(seed, n=300):
    rnd = random.Random(seed)
    vocab = ["the", "of", "New", "york", "City", "is", "é", "a-b", "x\x1ey"] + [f"w{i}" for i in range(15)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rnd.randint(0, 40)):
            words += ["New", "York", "city"] if rnd.random() < 0.1 else [rnd.choice(vocab)]
        text = "".join(w + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n"]) for w in words)
        rows.append((i % 7, text, rnd.choice(["en", "en", "de", None, "", "a b\nc"])))
    return rows + [(None, None, "en"), (1, "", None), (2, " .,; ", "zz"), rows[0], rows[0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_equal_plain_counts(spark, seed):
    rows = sample(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS + ", phrase string, n int").repartition(6)
    got = sorted(map(tuple, collocations(df, least=5, top=40).collect()))
    assert got == plain(rows, 5, 40)
    assert len(got) > 50


def test_phrases_with_a_hot_pair_are_dealt_out_and_exact(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(f"hot pair r{rnd.randint(0, 3000)} q{rnd.randint(0, 9)}" for _ in range(30)), "en") for i in range(60)]
    rows += [(100 + i, f"hot pair s{i} . cold w{i % 3}", "en") for i in range(40)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] for r in rows], "text": [r[1] for r in rows]})
    found = [w for b in count_windows(iter([batch])) for w in b.to_pylist()]
    assert any(w["n"] < 0 for w in found) and sum(w["n"] == 0 for w in found) >= 1
    got = {tuple(r.phrase.split(" ")): r.f for r in phrase_counts(df, 30).where("size > 0").collect()}
    assert got == {k[1:]: c for k, c in grams(rows).items() if c >= 30}


def test_long_texts_are_taken_in_overlapping_parts():
    rnd = random.Random(3)
    rows = [(0, " ".join(rnd.choice(["a", "bb", "c.", "dé"]) for _ in range(4000)), "en"), (1, "a bb a bb", None)]
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] for r in rows], "text": [r[1] for r in rows]})

    def windows(**sizes):
        out = Counter()
        for b in count_windows(iter([batch]), **sizes):
            for w in b.to_pylist():
                out[w["window"]] += abs(w["n"])
        return {k: n for k, n in out.items() if n}

    whole = windows()
    assert whole == windows(limit=500, long=97) == windows(limit=100, long=1 << 20)
    assert sum(whole.values()) == sum(len(w) for r in rows for w in pieces(r[1]))


def test_rare_words_cut_windows_and_colliding_ones_stay(monkeypatch):
    texts = ["a b rare c d e", "a b c d", "A b c d"]
    batch = pa.RecordBatch.from_pydict({"lang": pa.array(["en", "en", None], pa.string()), "text": texts})
    counted = Counter()
    for b in collocation_module.count_words(iter([batch])):
        for w in b.to_pylist():
            counted[w["at"]] += w["n"]
    assert sorted(counted.values()) == [1] * 6 + [2] * 4  # en holds a b c d twice, und once
    bits = np.zeros(1 << collocation_module.BITS - 3, np.uint8)
    for at, n in counted.items():
        if n >= 2:
            bits[at >> 3] |= 1 << (at & 7)
    got = {w["window"]: w["n"] for b in count_windows(iter([batch]), bits) for w in b.to_pylist()}
    assert got == {"en\na b  ": 1, "en\nb   ": 1, "en\n   ": 2, "en\nd   ": 2, "en\na b c d": 1, "en\nb c d ": 1,
                   "en\nc d  ": 2, "und\n   ": 4}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_folding_does_not_depend_on_batches(size):
    rnd = random.Random(size)
    windows = Counter()
    for _ in range(400):
        head = f"en\n{rnd.choice('ab')} {rnd.choice(['', 'x', 'y'])}"
        w3 = "" if head.endswith(" ") else rnd.choice(["", "p", "q", "r"])
        windows[head, w3, rnd.choice(["", "m", "n", "o"]) if w3 else ""] += rnd.randint(1, 3)
    rows = sorted([(" ".join(k), n) for k, n in windows.items()] + [("en\nb y  ", 0)])
    names = ["window", "n"]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows[i:i + size]]) for i in range(0, len(rows), size)]
    got = Counter()
    for b in fold(iter(batches), 40):
        for r in b.to_pylist():
            got[r["w1"], r["w2"], r["w3"], r["w4"]] += r["n"]
    assert sum(got.values()) == sum(windows.values())
    want, sums = Counter(), Counter()
    for (head, w3, w4), n in windows.items():
        w1, w2 = head.split("\n")[1].split(" ")
        for k in range(1, 5):
            sums[(w1, w2, w3, w4)[:k]] += n
    for (head, w3, w4), n in windows.items():
        w = tuple(head.split("\n")[1].split(" ")) + (w3, w4)
        k = 4
        while (w[0], w[1]) != ("b", "y") and k > 1 and (not w[k - 1] or sums[w[:k]] < 40):
            k -= 1
        want[w[:k] + ("",) * (4 - k)] += n
    assert got == want


def test_empty_table_and_shorter_phrases(spark):
    assert collocations(spark.createDataFrame([], DOCS)).collect() == []
    rows = sample(4, 100)
    got = collocations(spark.createDataFrame(rows, DOCS), least=4, longest=2, top=5).collect()
    assert got and all(len(r.phrase.split(" ")) == 2 for r in got)
    with pytest.raises(ValueError):
        collocations(spark.createDataFrame(rows, DOCS), longest=5)
