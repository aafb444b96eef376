"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def cut_repeats(docs, k):
    """{row: (words, removed, kept)} of (id, text) rows."""
    first = {}
    for i, t in docs:
        w = words(t)
        for s in range(len(w) - k + 1):
            if i is not None:
                key = tuple(w[s:s + k])
                first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, t in docs:
        w, gone = words(t), set()
        for s in range(len(w) - k + 1):
            if i is not None and first[tuple(w[s:s + k])] < (i, s):
                gone.update(range(s, s + k))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def leak_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def leaks(docs, items, n):
    spans = {}
    for i, t in items:
        w = leak_words(t)
        size = min(len(w), n)
        for s in range(len(w) - size + 1 if w else 0):
            spans.setdefault(tuple(w[s:s + size]), set()).add(i)
    sizes = {len(s) for s in spans}
    out = []
    for i, t in docs:
        w, hit, found = leak_words(t), set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                if (got := spans.get(tuple(w[s:s + size]))) is not None:
                    hit.update(range(s, s + size))
                    found |= got
        out.append((i, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return out


def shingles(text, k):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[s:s + k]) for s in range(max(1, len(w) - k + 1))) if w else frozenset()


def groups(ids, links):
    """{id: least id reachable}"""
    label = {i: i for i in ids}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {i: root(i) for i in ids}


def similar_groups(docs, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in docs if i is not None]
    links = [(a, b) for x, (a, s) in enumerate(sets) for b, t in sets[:x]
             if s and t and den * len(s & t) >= num * len(s | t)]
    return groups({i for i, _ in sets}, links)


def near_texts(seed=1, n=60, size=120, vocabulary=400):
    """Random texts, copies with a few changed words, and a shared passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passage = " ".join(word() for _ in range(40))
    texts = []
    for i in range(n):
        if texts and i % 3:
            base = rng.choice(texts).split(" ")
            for _ in range(rng.randrange(4)):
                base[rng.randrange(len(base))] = word()
            texts.append(" ".join(base))
        else:
            texts.append(" ".join([word() for _ in range(rng.randrange(20, size))] + [passage] * (i % 2)))
    return texts
