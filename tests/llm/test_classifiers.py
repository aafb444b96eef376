import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from vantage.llm import common, labelled, quality, toxicity


def data(seed=3, n=500):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice("the of and red blue green stone river".split()) for _ in range(rng.randrange(20, 80))]
        bad, rude = i % 5 == 0, i % 7 == 0
        if bad:
            w = [x.upper() + "!!" for x in w] if i % 2 else [w[0]] * 60
        if rude:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["zonk", "Zonk!", "z0nk", "grubling", "grublers"]))
        docs.append((i, " ".join(w), i % 3, 0.5))
        if i % 10 != 1:
            labels.append((i, 0 if bad else 1, 1 if rude else 0))
    docs += [(9000, None, 1, 0.1), (9001, "", 1, 0.1), (9002, "\n \t", 1, 0.1), (9003, "stone " * 40000, 1, 0.1), (None, "red", 1, 0.1),
             (0, docs[0][1], 1, 0.1)]
    return docs, labels


def frames(spark):
    docs, labels = data()
    return (spark.createDataFrame(docs, "doc_id long, text string, label int, score double").repartition(4),
            spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int"))


def accuracy(got, truth):
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40
    return np.mean([a == b for a, b in held])


def check_rows(got, docs):
    assert len(got) == len(docs)
    for r in got:
        assert 0 <= r.score <= 1 and r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)


def test_quality(spark):
    docs, labels = frames(spark)
    model = quality.fit(docs, labels)
    got = quality.score(docs, model, keep=0.3).collect()
    check_rows(got, data()[0])
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    assert accuracy(got, {i: q for i, q, _ in data()[1]}) > 0.97
    again = quality.fit(docs.repartition(2), labels)
    assert np.allclose(model[0], again[0]) and np.isclose(model[1], again[1])
    assert quality.score(docs.limit(0), model).collect() == []
    carried = quality.score(docs, model, carry=("text", "score")).columns
    assert carried == ["doc_id", "held_out", "score", "predicted", "text", "score"]


def test_quality_without_labels_of_both_kinds(spark):
    docs, labels = frames(spark)
    assert {round(r.score, 6) for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}
    one = quality.score(docs, quality.fit(docs, labels.where("quality = 1"))).collect()
    assert all(r.score > 0.99 for r in one)


def test_quality_scores_do_not_move_with_the_sample_cap(spark):
    rng = random.Random(5)
    kind = [int(i % 7 > 0) for i in range(3000)]  # 6 : 1, told apart by one word that both have
    texts = [" ".join(["stone" if rng.random() < (0.7 if q else 0.5) else "river"] + rng.choices("a b c d e f".split(), k=5))
             for q in kind]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(2)
    labels = spark.createDataFrame(list(enumerate(kind)), "doc_id long, quality int").coalesce(2)
    mean = {n: quality.score(docs, quality.fit(docs, labels, per_class=n)).agg({"score": "avg"}).first()[0]
            for n in (200, 3000)}
    assert abs(mean[3000] - 6 / 7) < 0.05
    assert abs(mean[200] - mean[3000]) < 0.08, mean


def test_weights_and_scores_of_a_column_agree():
    texts = pa.array(["a bb bb ccc", None, "", "é", "x" * 3000, "bb a"], pa.string())
    odds = np.random.default_rng(1).standard_normal(quality.BUCKETS)
    f = quality.Features(texts)
    each = [(odds[a] * w).sum() for a, w in f.weights()]
    assert np.allclose(each, f.scores(odds), atol=1e-4)
    assert all(np.isclose(w.sum(), 1, atol=1e-4) for (a, w), t in zip(f.weights(), texts.to_pylist()) if t)
    assert np.allclose(quality.Features(texts.slice(3, 2)).scores(odds), f.scores(odds)[3:5])


def test_toxicity(spark):
    docs, labels = frames(spark)
    model = toxicity.fit(docs, labels)
    assert {"zonk", "grubl*"} <= set(model.lexicon) and "stone" not in model.lexicon
    got = toxicity.score(docs, model).collect()
    check_rows(got, data()[0])
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    assert accuracy(got, {i: t for i, _, t in data()[1]}) > 0.95
    assert toxicity.score(docs.limit(0), model).collect() == []
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}


def test_isotonic_and_trees():
    rng = np.random.default_rng(2)
    s, y = rng.random(400), None
    y = (rng.random(400) < s).astype(int)
    x, v = toxicity.isotonic(s, y, np.ones(400))
    assert (np.diff(v) >= 0).all() and (np.diff(x) >= 0).all() and abs(np.interp(s, x, v).mean() - y.mean()) < 0.02
    f = rng.random((500, 3))
    t = (f[:, 0] > 0.5) ^ (f[:, 1] > 0.5)
    trees = toxicity.Trees(f, t.astype(int), np.ones(500))
    assert ((trees(f) > 0.5) == t).mean() > 0.95


def test_hidden_writing_and_nearness():
    f = toxicity.Features({"zonk": 1})
    plain, near, hidden = f("a zonk " + "x " * 30), f("you zonk " + "x " * 30), f("a z0nk! " + "x " * 30)
    assert plain[1] == near[1] == hidden[1] > 0 and near[7] > plain[7] == 0 and hidden[15] > 0 == plain[15]
    assert (f(None) == 0).all() and (f("") == 0).all()


def test_samples_are_bounded_by_rows_and_leave_out_conflicting_labels(spark):
    docs = spark.createDataFrame([(i % 4, f"text {i // 40}") for i in range(400)] + [(50, "z")], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (2, 0), (3, 0), (3, 0), (50, 1), (None, 1)], "doc_id long, quality int")
    got = labelled.labelled_sample(docs, labels, "quality", "doc_id", "text", 1).collect()
    assert sorted(r.label for r in got) == [0, 1]
    some = labelled.labelled_sample(docs, labels, "quality", "doc_id", "text", 10).collect()
    known = {i: q for i, q in ((0, 0), (1, 1), (3, 0), (50, 1)) if zlib.crc32(str(i).encode()) % 5}
    assert {r.id: r.label for r in some} == known and len(some) == len(known)
    again = labelled.labelled_sample(docs.repartition(3), labels, "quality", "doc_id", "text", 10).collect()
    assert sorted(map(tuple, some)) == sorted(map(tuple, again))
    assert labelled.label_counts(labels, "quality", "doc_id").tolist() == [list(known.values()).count(v) for v in (0, 1)]


ALL = (1 << 64) - 1


def plain_mix(x):
    x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 & ALL
    x = (x ^ x >> 29) * 0x94D049BB133111EB & ALL
    return x ^ x >> 32


def plain_quality(text, odds, bias):
    def bucket(code, kind):
        return ((code ^ kind * 0xD1B54A32D192ED03 & ALL) * 0x9E3779B97F4A7C15 & ALL) >> 50

    def hashed(word):
        return plain_mix((sum(int(common._BYTE[b]) * pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i, b in enumerate(word))
                          + len(word)) & ALL)

    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode()) if w]
    total = 0.0
    for i, w in enumerate(words):
        marked = b"\x02" + w + b"\x03"
        grams = [bucket(int.from_bytes(marked[j:j + g], "little"), g) for g in quality.GRAMS for j in range(len(marked) - g + 1)]
        total += sum(odds[b] for b in [bucket(hashed(w), 0), *grams]) / (1 + len(grams))
        if i:
            a, b = hashed(words[i - 1]), hashed(w)
            total += odds[quality.SAME if a == b else bucket((3 * a + b) & ALL, 1)]
    z = total / max(2 * len(words) - 1, 1) + bias
    return 1 / (1 + math.exp(-z))


def test_quality_scores_equal_a_plain_version(spark):
    docs, labels = frames(spark)
    model = quality.fit(docs, labels)
    docs = docs.where("doc_id != 9003").unionByName(spark.createDataFrame([(77, "é ü-x A A a", 0, 0.0)], docs.schema))
    got = quality.score(docs.select("doc_id", "text"), model, carry=("text",)).collect()
    assert all(math.isclose(r.score, plain_quality(r.text, *model), abs_tol=1e-9) for r in got)


def plain_toxicity(text, model):
    tokens = (text or "").encode().split()
    x = [0.0] * toxicity.N_FEATURES
    if tokens:
        n, data = len(tokens), (text or "").encode()
        tier, second, caps, hidden, behind = [], [], [], [], []
        for t in tokens:
            word, read, masked = toxicity.terms(t)
            look = lambda w: min((model.lexicon[s] for s in toxicity.stems(w) if s in model.lexicon), default=0)
            b = look(read) if masked else 0
            tier.append(look(word) or b)
            second.append(word in toxicity.SECOND)
            caps.append(len(word) > 1 and t.decode().isupper())
            hidden.append(masked)
            behind.append(b > 0)
        near = [t > 0 and any(second[max(0, i - toxicity.NEAR):i + toxicity.NEAR + 1]) for i, t in enumerate(tier)]
        share = lambda a, b: sum(a <= c < b for c in data) / len(data)
        x = [math.log1p(n), *(tier.count(k) / n for k in (1, 2, 3)), math.log1p(sum(t > 0 for t in tier)), math.log1p(tier.count(1)),
             sum(second) / n, sum(near) / n, share(65, 91), sum(caps) / n, share(33, 34), share(63, 64), share(34, 48), share(48, 58),
             sum(hidden) / n, sum(behind) / n]
    z = model.trees.base
    for feature, cut, value in model.trees.trees:
        node = 0
        for _ in range(model.trees.depth):
            node = 2 * node + 1 + (x[feature[node]] > cut[node])
        z += value[node - (2 ** model.trees.depth - 1)]
    raw = 1 / (1 + math.exp(-z))
    xs, ys = model.calibration
    return 0.98 * float(np.interp(raw, xs, ys)) + 0.02 * raw


def test_toxicity_scores_equal_a_plain_version(spark):
    docs, labels = frames(spark)
    model = toxicity.fit(docs, labels)
    docs = docs.where("doc_id != 9003").unionByName(spark.createDataFrame([(77, "YOU z0nk! é ü-x 1 you", 0, 0.0)], docs.schema))
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = toxicity.score(docs, model).collect()
    assert all(math.isclose(r.score, plain_toxicity(texts[r.doc_id], model), abs_tol=1e-9) for r in got)
