"""Byte-level BPE encoding and decoding by speculation and verification.

Per task: words (pre-tokens) not seen before get a *greedy longest-match*
proposal; a vectorised check then tests every adjacent pair of proposed tokens
of the whole batch at once; only words with a failing pair, or with a token whose
merges are ambiguous, are merged exactly.

Why the pair check suffices: merges are applied in rank order and a merge always
has a higher rank than the merges that made its parts.  So a merge across the
boundary of tokens a|b happens exactly if some node u on the right spine of a and
some node v on the left spine of b have a merge (u, v) of a rank below the rank
at which u is consumed inside a, and not above the one at which v is consumed
inside b (on a tie the left pair goes first).  No crossing at any boundary means
that merging leaves the proposal as it is.

Cases: null text encodes as empty text (no ids, decoded ''); strings of special
tokens in the text become that token, as the library does by default; rows with
equal or null ids are encoded one by one; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import map_arrow, slices
from vantage.llm.pieces import WS, Memo, cut_pieces, gather

#: fixed value: the word pattern of the vocabulary, white space spelled out
_WORD = r"^ ?[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+$"  # pieces that are one word for sure
_PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+|[{WS}]+(?![^{WS}])|[{WS}]+")
#: bytes of text encoded at once
SLICE = 2 << 20
NONE = np.iinfo(np.int64).max


def _byte_chars() -> dict[str, int]:
    """Printable stand-in of every byte: printable Latin-1 characters stand for
    themselves, the others follow from 256 on in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and spines of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = _byte_chars()
        to_bytes = lambda s: bytes(chars[c] for c in s)
        vocab = {to_bytes(t): i for t, i in spec["model"]["vocab"].items()}
        self.specials = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.of_bytes = vocab
        self.bytes_of = [b""] * size
        for t, i in vocab.items():
            self.bytes_of[i] = t
        for t, i in self.specials.items():
            self.bytes_of[i] = t.encode()
        self.longest: dict[int, int] = {}
        for t in vocab:
            self.longest[t[0]] = max(self.longest.get(t[0], 0), len(t))
        self.rank = np.full(size, -1, np.int64)  # of the merge that makes a token
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.sure = np.ones(size, bool)
        merges, results = [], []
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = (to_bytes(x) for x in (m.split(" ") if isinstance(m, str) else m))
            i, j, k = vocab[a], vocab[b], vocab[a + b]
            merges.append((i, j))
            results.append(k)
            if self.left[k] >= 0 or max(self.rank[i], self.rank[j]) >= r:
                self.sure[k] = False  # two ways to make it, or out of order
            else:
                self.rank[k], self.left[k], self.right[k] = r, i, j
        codes = np.array([i << 32 | j for i, j in merges], np.int64)
        order = np.argsort(codes)
        self.codes = np.r_[codes[order], NONE]
        self.ranks = np.r_[np.arange(len(codes))[order], NONE]
        self.results = np.r_[np.array(results, np.int64)[order], -1]
        self.byte_ids = np.array([vocab.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.checked = np.zeros(size, bool)  # is a token its own encoding?
        sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.byte_start = np.r_[0, np.cumsum(sizes)]
        self.byte_data = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def greedy(self, word: bytes) -> list[int]:
        ids, at, find, n = [], 0, self.of_bytes.get, len(word)
        while at < n:
            stop = min(n, at + self.longest[word[at]])
            while (i := find(word[at:stop])) is None:
                stop -= 1
            ids.append(i)
            at = stop
        return ids

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per pair: rank and result of its merge (a rank of NONE: there is none)."""
        code = a << 32 | b
        at = np.searchsorted(self.codes, code)
        hit = self.codes[at] == code
        return np.where(hit, self.ranks[at], NONE), self.results[at]

    def exact(self, words: list[bytes]) -> list[list[int]]:
        """Merging by rank, leftmost first: all words go through one merge at a time
        together, and only pairs beside a merge are looked up again."""
        out: list[list[int]] = [[] for _ in words]
        size = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), size)
        rank, made = np.full(len(ids), NONE), np.zeros(len(ids), np.int64)
        near = np.flatnonzero(owner[1:] == owner[:-1])
        rank[near], made[near] = self._pair(ids[near], ids[near + 1])
        while len(ids):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            count = np.diff(np.r_[first, len(ids)])
            least = np.minimum.reduceat(rank, first)
            over = np.repeat(least == NONE, count)
            if over.any():
                done, whose = ids[over].tolist(), owner[first[least == NONE]].tolist()
                at = 0
                for w, n in zip(whose, count[least == NONE].tolist()):
                    out[w] = done[at:at + n]
                    at += n
                least = np.repeat(least, count)[~over]
                ids, owner, rank, made = ids[~over], owner[~over], rank[~over], made[~over]
                if not len(ids):
                    break
            else:
                least = np.repeat(least, count)
            hit = np.flatnonzero(rank == least)
            run = np.flatnonzero(np.r_[True, np.diff(hit) != 1])  # of overlapping pairs every other one
            hit = hit[(np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))) % 2 == 0]
            ids[hit] = made[hit]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            ids, owner, rank, made = ids[keep], owner[keep], rank[keep], made[keep]
            hit -= np.arange(len(hit))  # where the merged tokens are now
            near = np.unique(np.r_[hit, hit[hit > 0] - 1])
            rank[near] = NONE
            near = near[near + 1 < len(ids)]
            near = near[owner[near] == owner[near + 1]]
            rank[near], made[near] = self._pair(ids[near], ids[near + 1])
        return out

    def _sure(self, ids: np.ndarray) -> np.ndarray:
        """Per token: its own encoding is itself, by its own merges."""
        new = np.unique(ids[~self.checked[ids]])
        alone = self.exact([self.bytes_of[i] for i in new])
        self.sure[new] &= np.array([a == [i] for a, i in zip(alone, new)], bool)
        self.checked[new] = True
        return self.sure[ids]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Per pair: no merge crosses the boundary (see the module's text)."""
        good = np.ones(len(a), bool)
        u, used_u = a.copy(), np.full(len(a), NONE)  # used: rank at which the node is consumed
        while (live := u >= 0).any():
            v, used_v = np.where(live, b, -1), np.full(len(a), NONE)
            while (row := np.flatnonzero(v >= 0)).size:
                r, _ = self._pair(u[row], v[row])
                good[row[(r < used_u[row]) & (r <= used_v[row]) & (r != NONE)]] = False
                used_v[row] = self.rank[v[row]]
                v[row] = self.left[v[row]]
            used_u = np.where(live, self.rank[u], used_u)
            u = np.where(live, self.right[u], -1)
        return good

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Speculate, verify all pairs at once, merge what failed."""
        guess = [self.greedy(w) for w in words]
        size = np.fromiter(map(len, guess), np.int64, len(guess))
        if not size.sum():
            return guess
        flat = np.fromiter((i for g in guess for i in g), np.int64, int(size.sum()))
        owner = np.repeat(np.arange(len(guess)), size)
        bad = np.zeros(len(guess), bool)
        bad[owner[~self._sure(flat)]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, where = np.unique(flat[inner] << 32 | flat[inner + 1], return_inverse=True)
        fits = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
        bad[owner[inner[~fits[where]]]] = True
        redo = np.flatnonzero(bad)
        for i, ids in zip(redo, self.exact([words[i] for i in redo])):
            guess[i] = ids
        return guess


class Encoder:
    """Texts -> ids.  Distinct pieces are learned once and kept in a memo of bounded bytes."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.names, self.memo = vocab, tuple(vocab.specials), Memo()

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of new pieces, by the words that they consist of."""
        specials = self.vocab.specials
        one = np.asarray(pc.match_substring_regex(new, _WORD))
        parts = [[p] if w or p in specials else _PATTERN.findall(p) for p, w in zip(new.to_pylist(), one.tolist())]
        words = list(dict.fromkeys(w for p in parts for w in p if w not in specials))
        known = dict(zip(words, self.vocab.encode_words([w.encode() for w in words])))
        known.update((s, [i]) for s, i in specials.items())
        got = [known[p[0]] if len(p) == 1 else [i for w in p for i in known[w]] for p in parts]
        return np.fromiter(chain.from_iterable(got), np.int32), np.fromiter(map(len, got), np.int64, len(got))

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text)."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        pieces, first = cut_pieces(column, self.names)
        code, start, ids = self.memo.lookup(pieces, self._learn)
        flat, ends = gather(ids, start[code], start[code + 1] - start[code])
        return flat, np.r_[0, ends][first]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        return self.decode_column(ids, offsets).to_pylist()

    def decode_column(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        v = self.vocab
        flat, ends = gather(v.byte_data, v.byte_start[ids], v.byte_start[ids + 1] - v.byte_start[ids])
        cuts = np.r_[0, ends][offsets]
        data = flat.tobytes()
        inner = cuts[cuts < len(flat)]
        try:
            data.decode()
            if (flat[inner] & 0xC0 != 0x80).all():  # whole characters in every text
                return pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data))
        except UnicodeDecodeError:
            pass
        return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])], pa.string())


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(Vocabulary(path))


def bpe(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: the id, ``ids`` array<int>, and the text ``decoded``
    from those ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        try:
            for batch in slices(batches, "text", SLICE):
                ids, offsets = enc.encode(batch.column(1))
                texts = enc.decode_column(ids, offsets)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, texts], ["id", "ids", "decoded"])
        finally:
            enc.memo.clear()  # a worker lives on after its task

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return map_arrow(src, run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def digest_columns(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns from the operator's ids and texts."""
    decimal = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
