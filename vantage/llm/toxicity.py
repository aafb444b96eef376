"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of learned lexicon words (three tiers by how common
they are in toxic texts), second-person words and lexicon words near them, capital letters
and capitalised words, punctuation, digits, and words that are written to be missed
(letters mixed with digits or signs), with the lexicon words found behind such writing.

The lexicon (words, and beginnings of longer words) is learned from labels: terms that
toxic texts hold more often, by a likelihood-ratio test far beyond chance.  The trees are
fitted to three quarters of the sample, the isotonic map of their scores to the rest,
weighted to the shares of the labels over all learnable rows.  The sample is at most
``per_class`` labelled rows of each label outside the held-out fifth.

Cases: null and empty texts have zero features; very long texts are scored whole; without
labels of both kinds the score is the share of label 1 (0 if there are none); rows with the
same id are scored one by one; null ids are held out; what repeated ids and conflicting labels
teach is in ``labelled``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.llm.common import MEMO_WORDS, map_arrow, slices
from vantage.llm.labelled import held_out, label_counts, labelled_sample

PER_CLASS = 4000
#: terms of the lexicon at most, the strongest first
LEXICON = 2000
#: least likelihood ratio of a term (chance of one in 100 thousand)
EVIDENCE = 20.0
#: length of the beginnings that may become terms
STEM = 5
#: words between a lexicon word and a second-person word that count as near
NEAR = 5
N_FEATURES = 16

# fixed values: second-person words, and signs that stand for letters
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine tu te toi ton ta vous votre tú ti usted ustedes".split())
SIGNS = str.maketrans("013457@$!|", "oieastasil")
_EDGE = regex.compile(r"^[^\p{L}\p{N}@$]+|[^\p{L}\p{N}@$]+$")
_HIDDEN = regex.compile(r"\p{L}.*[\d@$*!|_.-].*\p{L}|[\d@$].*\p{L}{2}")
_LETTERS = regex.compile(r"[^\p{L}]+")


def terms(token: bytes) -> tuple[str, str, bool]:
    """(word, its reading with signs as letters, is it written to be missed?)"""
    bare = _EDGE.sub("", token.decode())
    word = bare.lower()
    hidden = bool(_HIDDEN.search(bare))
    return word, _LETTERS.sub("", word.translate(SIGNS)) if hidden else word, hidden


def stems(word: str) -> tuple[str, ...]:
    return (word, word[:STEM] + "*") if len(word) > STEM else (word,)


class Features:
    """Dense features of texts, given the lexicon (term -> tier 1 to 3)."""

    def __init__(self, lexicon: dict[str, int]):
        self.lexicon, self.codes = lexicon, {}

    def _code(self, token: bytes) -> int:
        word, read, hidden = terms(token)
        tier = min((self.lexicon[t] for t in stems(word) if t in self.lexicon), default=0)
        behind = min((self.lexicon[t] for t in stems(read) if t in self.lexicon), default=0) if hidden else 0
        caps = len(word) > 1 and token.decode().isupper()
        if len(self.codes) >= MEMO_WORDS:
            self.codes.clear()
        code = self.codes[token] = tier or behind
        code |= 4 * (word in SECOND) | 8 * caps | 16 * hidden | 32 * bool(behind)
        self.codes[token] = code
        return code

    def __call__(self, text: str | None) -> np.ndarray:
        out = np.zeros(N_FEATURES)
        data = (text or "").encode()
        tokens = data.split()
        if not tokens:
            return out
        get, make = self.codes.get, self._code
        code = np.array([c if (c := get(t)) is not None else make(t) for t in tokens], np.int64)
        n, tier = len(code), code & 3
        second = (code & 4) > 0
        around = np.cumsum(np.r_[np.zeros(NEAR + 1, np.int64), second, np.zeros(NEAR, np.int64)])
        near = around[2 * NEAR + 1:] > around[:n]
        chars = np.bincount(np.frombuffer(data, np.uint8), minlength=256) / len(data)
        out[:] = [np.log1p(n), *((tier == t).sum() / n for t in (1, 2, 3)), np.log1p((tier > 0).sum()),
                  np.log1p((tier == 1).sum()), second.mean(), ((tier > 0) & near).sum() / n, chars[65:91].sum(),
                  ((code & 8) > 0).mean(), chars[33], chars[63], chars[34:48].sum(), chars[48:58].sum(),
                  ((code & 16) > 0).mean(), ((code & 32) > 0).mean()]
        return out


class Trees:
    """Boosted trees of depth ``depth`` on binned features, logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 80, depth: int = 3,
                 rate: float = 0.15, bins: int = 32, ridge: float = 1.0):
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T)])
        mean = float(np.average(y, weights=weight))
        self.base = np.log(mean / (1 - mean))
        self.depth, self.trees = depth, []
        z = np.full(len(y), self.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-z))
            grad, hess = weight * (y - p), weight * p * (1 - p)
            feature, cut = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
            node = np.zeros(len(y), np.int64)
            for at in range(2 ** depth - 1):
                rows = np.flatnonzero(node == at)
                best, side = 1e-3, np.zeros(len(rows), bool)
                for f in range(len(cuts)) if len(rows) > 1 else ():
                    g, h = (np.bincount(binned[f, rows], v[rows], bins)[:len(cuts[f]) + 1].cumsum() for v in (grad, hess))
                    gain = (g[:-1] ** 2 / (h[:-1] + ridge) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge)
                            - g[-1] ** 2 / (h[-1] + ridge))
                    if len(gain) and gain.max() > best:
                        b = int(gain.argmax())
                        best, feature[at], cut[at] = float(gain[b]), f, cuts[f][b]
                        side = binned[f, rows] > b
                node[rows] = 2 * at + 1 + side
            leaf = node - (2 ** depth - 1)
            g, h = (np.bincount(leaf, v, 2 ** depth) for v in (grad, hess))
            value = rate * g / (h + ridge)
            self.trees.append((feature, cut, value))
            z += value[leaf]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            z += value[node - (2 ** self.depth - 1)]
        return 1 / (1 + np.exp(-z))


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, rising values): least squares by pooling adjacent violators."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v, w in zip(score[order], y[order].astype(float), weight[order]):
        blocks.append([v, w, s, s])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, _, hi = blocks.pop()
            v1, w1, lo, _ = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, lo, hi])
    x = np.array([b for v, w, lo, hi in blocks for b in (lo, hi)])
    return x, np.array([v for v, w, lo, hi in blocks for _ in (0, 1)])


class Model:
    def __init__(self, lexicon, trees, calibration, constant: float = 0.0):
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.constant)
        raw = self.trees(x)
        # a small share of the raw score keeps the order within a step
        return 0.98 * np.interp(raw, *self.calibration) + 0.02 * raw


def learn_lexicon(sample: DataFrame) -> dict[str, int]:
    """Terms with their tiers, from (text, label); counted over texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [Counter(), Counter()]
        for batch in slices(batches, "text"):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {terms(t)[1] for t in set((text or "").encode().split())}
                count[label].update({s for w in words if len(w) > 2 for s in stems(w)})
            if sum(map(len, count)) >= 500_000:
                yield out(count)
                count = [Counter(), Counter()]
        yield out(count)

    def out(count):
        names = sorted(count[1])  # a term that no toxic text has cannot enter
        rest = sorted(t for t in count[0] if t not in count[1])
        return pa.RecordBatch.from_pydict(
            {"term": pa.array(names + rest, pa.string()), "pos": pa.array([count[1][t] for t in names + rest], pa.int64()),
             "neg": pa.array([count[0][t] for t in names + rest], pa.int64())})

    total = sample.agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")).first()
    if not total.pos or not total.neg:
        return {}
    seen = (map_arrow(sample.select("text", "label"), run, "term string, pos long, neg long")
            .groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where("pos > 0"))
    rate = (F.col("pos") + F.col("neg")) / F.lit(float(total.pos + total.neg))
    part = lambda n, of: F.when(n > 0, n * F.log(n / (rate * float(of)))).otherwise(0.0)
    evidence = 2 * (part(F.col("pos"), total.pos) + part(F.col("neg"), total.neg))
    share_pos, share_neg = F.col("pos") / float(total.pos), F.col("neg") / float(total.neg)
    strong = (seen.withColumn("g", evidence).where((F.col("g") >= EVIDENCE) & (share_pos > 10 * share_neg))
              .withColumn("share", share_pos).orderBy(F.desc("g"), "term").limit(LEXICON).collect())
    return {r.term: 1 if r.share >= 0.05 else 2 if r.share >= 0.01 else 3 for r in strong}


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        per_class: int = PER_CLASS) -> Model:
    sample = labelled_sample(docs, labels, label_col, id_col, text_col, per_class)
    apart = F.xxhash64(F.lit(1), "id") % 4 == 0  # a quarter calibrates
    lexicon = learn_lexicon(sample.where(~apart))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features(lexicon)
        for batch in slices(batches, "text"):
            rows = [make(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(rows, pa.list_(pa.float64()))],
                                             ["label", "apart", "x"])

    got = map_arrow(sample.select("text", "label", apart.alias("apart")), run,
                    "label int, apart boolean, x array<double>").collect()  # 2 * per_class rows at most
    got.sort(key=lambda r: (r.label, r.apart, r.x))
    y = np.array([r.label for r in got], np.int64)
    if len(set(y.tolist())) < 2:
        return Model({}, None, None, float(y.mean()) if len(y) else 0.0)
    weight = (label_counts(labels, label_col, id_col) / np.bincount(y, minlength=2))[y]
    weight /= weight.mean()
    x, rest = np.array([r.x for r in got]), np.array([r.apart for r in got], bool)
    if len(set(y[~rest].tolist())) < 2 or len(set(y[rest].tolist())) < 2:
        rest[:] = False  # too few rows to hold any back
    trees = Trees(x[~rest], y[~rest], weight[~rest])
    for_map = rest if rest.any() else ~rest
    return Model(lexicon, trees, isotonic(trees(x[for_map]), y[for_map], weight[for_map]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", flag: float = 0.5) -> DataFrame:
    """id, held_out, score (of label 1), predicted (score >= ``flag``)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([src.schema["id"]]).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features(model.lexicon)
        for batch in slices(batches, "text"):
            x = np.array([make(t) for t in batch.column(1).to_pylist()]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x), pa.float64())], ["id", "score"])

    return map_arrow(src, run, schema).select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
        (F.col("score") >= flag).cast("int").alias("predicted"))
