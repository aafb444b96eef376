"""Quality classifier: subword embeddings averaged over a document, softmax output.

Features of a document, in order of its white-space separated words: the word, its
character n-grams (over UTF-8 bytes, with word boundaries), and the word pair with its
predecessor; a word that repeats its predecessor gives the pair feature "=" whatever
the word.
Every feature is hashed to a bucket with a learned vector; the document is the mean of
its words' vectors, a word the mean of its features'.  A softmax layer scores the two
labels; both layers are trained by mini-batch gradient descent in numpy on a sample of
at most ``per_class`` labelled documents of each label (whole texts, outside the held-out
fifth).  Each counts in the loss for as many labelled documents as it stands for, so the
labels keep their shares whatever the size of the sample.

After training both layers collapse to one number a bucket, so a task scores its documents by
adding up the numbers of their features, all words of a piece of the column at once.

Cases: null and empty texts have no features and get the bias alone; very long texts are
scored whole; without labels of both kinds the score is the share of label 1 (0.5 if there
are none); rows with the same id are scored one by one; null ids are held out; what repeated ids
and conflicting labels teach is in ``labelled``; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.llm.common import Words, map_arrow, slices
from vantage.llm.labelled import held_out, labelled_sample, stands_for

BUCKETS = 1 << 14
PER_CLASS = 1500
DIM = 8


#: lengths of the character n-grams
GRAMS = (3, 4)
#: bytes of text worked on at once
PART = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _bucket(code: np.ndarray, kind: int) -> np.ndarray:
    """Buckets of feature codes, different ones for each kind of feature."""
    with np.errstate(over="ignore"):
        mixed = (code ^ np.uint64(kind) * np.uint64(0xD1B54A32D192ED03)) * _ODD
    return (mixed >> np.uint64(64 - 14)).astype(np.int64)


SAME = int(_bucket(np.zeros(1, np.uint64), 9)[0])


class Features:
    """Bucketed features of a column of texts, flat: of words, of n-grams, of pairs."""

    def __init__(self, column: pa.Array):
        self.words = w = Words(column)
        n = len(w.hash)
        self.word = _bucket(w.hash, 0)
        # words between boundary signs, one after another
        size = w.size + 2 if n else np.zeros(0, np.int64)
        begin = np.cumsum(size) - size
        flat = np.zeros(int(size.sum()), np.uint64)
        if n:
            owner = np.repeat(np.arange(n), w.size)
            flat[np.arange(len(w.letters)) + 2 * owner + 1] = w.letters
            flat[begin], flat[begin + size - 1] = 2, 3
        self.grams, self.begin, self.count = [], begin, np.ones(n)
        for g in GRAMS:
            code = flat.copy()
            for i in range(1, g):
                code[:len(flat) - i] |= flat[i:] << np.uint64(8 * i)
            inside = np.ones(len(flat), bool)
            for i in range(1, min(g, len(flat) + 1)):  # those that would cross a word's end
                cross = begin + size - i
                inside[cross[cross >= begin]] = False
            self.grams.append((_bucket(code, g), inside))
            self.count += np.maximum(size - g + 1, 0)
        second = np.ones(n, bool)
        second[w.first[:-1][w.first[:-1] < n]] = False
        self.second = np.flatnonzero(second)  # words with a predecessor in their text
        a, b = w.hash[self.second - 1], w.hash[self.second]
        with np.errstate(over="ignore"):
            self.pair = np.where(a == b, SAME, _bucket(a * np.uint64(3) + b, 1))

    def by_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of one value a word over each text."""
        total = np.r_[0.0, np.cumsum(values)]
        return total[self.words.first[1:]] - total[self.words.first[:-1]]

    def parts(self) -> np.ndarray:
        """Words and pairs of each text."""
        return np.maximum(2 * np.diff(self.words.first) - 1, 1)

    def scores(self, odds: np.ndarray) -> np.ndarray:
        value = odds[self.word].copy()
        for bucket, inside in self.grams:
            if len(value):
                value += np.add.reduceat(np.where(inside, odds[bucket], 0.0), self.begin)
        value /= self.count
        value[self.second] += odds[self.pair]
        return self.by_text(value) / self.parts()

    def weights(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(buckets, weights) of each text; the weights add up to 1."""
        n, first = len(self.words.hash), self.words.first
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        owner = np.repeat(np.arange(n), self.words.size + 2) if n else np.zeros(0, np.int64)
        each = 1 / self.count
        at, weight = [text * BUCKETS + self.word, text[self.second] * BUCKETS + self.pair], [each, np.ones(len(self.pair))]
        for bucket, inside in self.grams:
            at.append(text[owner[inside]] * BUCKETS + bucket[inside])
            weight.append(each[owner[inside]])
        keys, where = np.unique(np.concatenate(at), return_inverse=True)
        total = np.bincount(where, np.concatenate(weight), len(keys)) / self.parts()[keys // BUCKETS]
        cut = np.searchsorted(keys, np.arange(len(first)) * BUCKETS)
        return [((keys[a:b] % BUCKETS).astype(np.int32), total[a:b].astype(np.float32)) for a, b in zip(cut, cut[1:])]


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 8, batch: int = 64,
          rate: float = 0.2, seed: int = 7, each: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """(number a bucket, bias): the log odds of label 1 that both layers come to.  A document
    counts ``each`` times in the loss (once by default)."""
    times = np.ones(len(docs)) if each is None else each / each.mean()
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1, 1, (BUCKETS, DIM)) / DIM
    out, bias = np.zeros((DIM, 2)), np.zeros(2)
    g_emb, g_out = np.full(BUCKETS, 1e-6), np.full((DIM, 2), 1e-6)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // batch)):
            at = np.concatenate([docs[r][0] for r in rows])
            weight = np.concatenate([docs[r][1] for r in rows]).astype(float)
            size = np.array([len(docs[r][0]) for r in rows])
            owner = np.repeat(np.arange(len(rows)), size)
            hidden = np.zeros((len(rows), DIM))
            np.add.at(hidden, owner, emb[at] * weight[:, None])
            z = hidden @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            p *= times[rows][:, None]  # gradient of the loss
            d_out, d_hidden = hidden.T @ p / len(rows), p @ out.T
            g_out += d_out ** 2
            out -= rate * d_out / np.sqrt(g_out)
            bias -= rate * p.mean(0)
            step = d_hidden[owner] * weight[:, None]
            buckets, inverse = np.unique(at, return_inverse=True)
            d_emb = np.zeros((len(buckets), DIM))
            np.add.at(d_emb, inverse, step)
            g_emb[buckets] += (d_emb ** 2).mean(1)
            emb[buckets] -= rate * d_emb / np.sqrt(g_emb[buckets])[:, None]
    odds = emb @ (out[:, 1] - out[:, 0])
    return odds, float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """Learn from the sample; only its bucket weights (at most 2 * ``per_class`` documents)
    reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PART):
            got = Features(batch.column(0)).weights()
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([a.tobytes() for a, _ in got], pa.binary()),
                 pa.array([w.tobytes() for _, w in got], pa.binary()), batch.column(2)], ["label", "at", "weight", "id"])

    sample = labelled_sample(docs, labels, label_col, id_col, text_col, per_class).select("text", "label", "id")
    kind = sample.schema["id"].dataType.simpleString()
    rows = map_arrow(sample, run, f"label int, at binary, weight binary, id {kind}").collect()
    rows.sort(key=lambda r: (r["id"], bytes(r["at"]), bytes(r["weight"])))  # the same model from the same rows
    known = np.array([r["label"] for r in rows], np.int64)
    if len(set(known.tolist())) < 2:
        share = float(known.mean()) if len(known) else 0.5
        return np.zeros(BUCKETS), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    return train([(np.frombuffer(r["at"], np.int32), np.frombuffer(r["weight"], np.float32)) for r in rows], known,
                 each=stands_for(labels, label_col, id_col, per_class)[known])


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text",
          keep: float = 0.3, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, held_out, score (of label 1), predicted (score >= ``keep``), and ``carry`` as it is."""
    odds, bias = model
    text, more = F.col(text_col).cast("string"), [c for c in carry if c != text_col]
    src = docs.select(F.col(id_col).alias("id"), text.alias("text"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(more)))
    keep_text = text_col in carry  # sent to the tasks' Python once either way
    schema = T.StructType([f for f in src.schema.fields if f.name != "text" or keep_text]).add("score", "double")
    names = schema.names
    back = {c: F.col("text").cast(docs.schema[c].dataType) if c == text_col else F.col(f"c{more.index(c)}") for c in carry}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PART):
            scores = 1 / (1 + np.exp(-Features(batch.column(1)).scores(odds) - bias))
            columns = batch.columns if keep_text else [batch.column(0), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], names)

    scored = map_arrow(src, run, schema)
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
                         (F.col("score") >= keep).cast("int").alias("predicted"),
                         *(back[c].alias(c) for c in carry))
