"""Phrase collocations by marginalising the longest windows.

Only windows of the longest length are counted: one for each word of a piece, with the next
words as lead columns and padding beyond the piece's end.  Counts of shorter phrases, of single
words and of all words are sums over prefixes of the windows, taken by one ROLLUP; nothing is
exploded by length.

- Words: occurrences are summed in 2^26 counters by hash; a word whose counter stays below
  ``least`` is rare and cuts windows, as no candidate holds it.  The counters come back as 8 MB of
  bits whatever the input's size.  A collision only leaves a rare word in, never takes one out.
- Windows: a task combines equal windows of a few megabytes of text before anything is shuffled.
- Folding: windows meet sorted under their first two words.  A window's tail is cut where the
  prefix so far occurs less than ``least`` times, because no candidate and no part of one
  reaches there; the count moves to the shorter prefix.  This streams with a few numbers of state.
- A pair of words that holds over 1 % of a chunk's distinct windows is dealt out by the whole
  window instead and reaches ROLLUP unfolded; a marker under the pair says so to the windows
  of other chunks.
- ROLLUP, then the cuts of candidates and the phrases inside longer ones as joins on phrases.

Cases: null text is empty; a null language is ``und``; rows with equal ids, and equal rows, all
count; texts without words give nothing; texts of over 4 MB are taken in parts that overlap by
three words; an empty table gives an empty result; the id and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.common import Words, long_array, map_arrow, materialize, mix, slices

#: words of the longest window
WORDS = 4
#: bytes of text whose windows are combined before the shuffle
CHUNK = 6 << 20
#: bytes of text that are taken as one row
LONG = 4 << 20
#: counters of words by hash, as a power of two
BITS = 26
#: rows of a batch that goes back to Spark
ROWS = 1 << 16

# fixed values: bytes that end a piece, and bytes that only end a word
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t")] = True
_GAP = _BREAK | _SPACE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _parts(text: bytes, limit: int) -> Iterator[tuple[bytes, int]]:
    """A long text as parts cut between words, each with the next three words of its piece
    appended; and how many last words of the part belong to the next one."""
    gap = _GAP[np.frombuffer(text, np.uint8)]
    starts = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
    at, first = 0, 0
    while len(text) - at > limit and (nxt := int(np.searchsorted(starts, at + limit))) < len(starts):
        more = min(nxt + WORDS - 1, len(starts)) - nxt
        stop = int(starts[nxt + more]) if nxt + more < len(starts) else len(text)
        yield text[at:stop], more
        at = int(starts[nxt])
    yield text[at:], 0


def _chunks(batches: Iterator[pa.RecordBatch], limit: int, long: int) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
    """(languages, texts, words at each row's end that are not its own)."""
    held, size = [], 0
    for batch in slices(batches, "text", min(limit, long)):
        text = batch.column(1).cast(pa.large_binary())
        lang, skip = batch.column(0), np.zeros(batch.num_rows, np.int64)
        bytes_of = np.asarray(pc.fill_null(pc.binary_length(text), 0))
        if bytes_of.max() > long:
            rows = [(g, *p) for g, t in zip(lang.to_pylist(), text) for p in _parts(t.as_py() or b"", long)]
            for g, part, more in rows:
                yield pa.array([g], pa.string()), pa.array([part], pa.large_binary()), np.array([more])
            continue
        held.append((lang, text, skip))
        size += int(bytes_of.sum())
        if size >= limit:
            yield tuple(map(_concat, zip(*held)))
            held, size = [], 0
    if held:
        yield tuple(map(_concat, zip(*held)))


def _concat(parts):
    return np.concatenate(parts) if isinstance(parts[0], np.ndarray) else pa.concat_arrays(parts)


class _Tokens:
    """Words of a chunk: ``id`` of each (places in ``names``, sorted, from 1), ``code`` of its
    language (in ``langs``), ``piece``, and ``own``, false where it belongs to the next part."""

    def __init__(self, lang: pa.Array, text: pa.Array, skip: np.ndarray):
        text = pc.fill_null(text, b"")
        cut = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = _LOWER[np.frombuffer(text.buffers()[2] or b"", np.uint8)[cut[0]:cut[-1]]]
        cut = cut - cut[0]
        inside = ~_GAP[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[cut] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:-1]
        at = np.flatnonzero(start)
        first = np.searchsorted(at, cut)
        row = np.repeat(np.arange(len(text)), np.diff(first))
        self.piece = np.cumsum(_BREAK[data], dtype=np.int32)[at] + row
        letters = data[inside]
        begin = np.cumsum(inside, dtype=np.int32)[at] - 1
        words = pa.StringArray.from_buffers(len(at), pa.py_buffer(np.r_[begin, len(letters)].astype(np.int32)),
                                            pa.py_buffer(letters)).dictionary_encode()
        order = pc.sort_indices(words.dictionary)
        rank = np.empty(len(order), np.int64)
        rank[np.asarray(order)] = np.arange(1, len(order) + 1)
        self.names = pa.concat_arrays([pa.array([""]), words.dictionary.take(order)])
        self.id = rank[np.asarray(words.indices)]
        langs = _escape(lang.fill_null("und")).dictionary_encode()
        self.langs = langs.dictionary
        self.code = np.asarray(langs.indices).astype(np.int64)[row]
        self.own = np.arange(len(at)) < np.repeat(first[1:] - skip, np.diff(first))

    def counters(self) -> tuple[np.ndarray, np.ndarray]:
        """(language and word as one number, counter) of the words that occur."""
        key = self.code * len(self.names) + self.id
        top = len(self.langs) * len(self.names)
        key = np.flatnonzero(np.bincount(key, minlength=top)) if top <= 1 << 24 else np.unique(key)
        word = np.r_[np.uint64(0), Words(self.names.slice(1)).hash]
        lang = mix(np.array([crc32(x.encode()) + 1 for x in self.langs.to_pylist()], np.uint64))
        code = mix(word[key % len(self.names)] ^ lang[key // len(self.names)])
        return key, (code >> np.uint64(64 - BITS)).astype(np.int64)


def count_words(batches: Iterator[pa.RecordBatch], limit: int = CHUNK, long: int = LONG) -> Iterator[pa.RecordBatch]:
    """Occurrences by counter, combined a chunk."""
    for chunk in _chunks(batches, limit, long):
        t = _Tokens(*chunk)
        if len(t.id):
            key, at = t.counters()
            got = np.bincount(np.searchsorted(key, (t.code * len(t.names) + t.id)[t.own]), minlength=len(key))
            yield pa.RecordBatch.from_arrays([long_array(at), long_array(got)], ["at", "n"])


def _windows(t: _Tokens, frequent: np.ndarray | None) -> pa.RecordBatch:
    """Distinct padded windows of a chunk, in order: the language, a line break and four words
    with spaces between, and n, their count.  Windows of a hot pair have -n, and the pair's
    window without more words a marker of 0.  ``frequent``: a bit a counter."""
    names, langs, many = t.names, t.langs, len(t.names)
    known = t.id
    if frequent is not None:
        key, at = t.counters()
        rare = (frequent[at >> 3] >> (at & 7) & 1) == 0
        if many * len(langs) <= 1 << 24:
            bad = np.zeros(many * len(langs), bool)
            bad[key[rare]] = True
            known = np.where(bad[t.code * many + t.id], 0, t.id)
        else:
            known = np.where(rare[np.searchsorted(key, t.code * many + t.id)], 0, t.id)
    lead = [known]
    for k in range(1, WORDS):
        lead.append(np.zeros(len(known), np.int64))
        lead[k][:-k] = np.where((t.piece[k:] == t.piece[:-k]) & (lead[k - 1][:-k] > 0), known[k:], 0)
    code = t.code
    if not t.own.all():
        lead, code = [x[t.own] for x in lead], code[t.own]
    high, low = (code * many + lead[0]) * many + lead[1], lead[2] * many + lead[3]
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
    n = np.diff(np.r_[new, len(high)])
    high, low = high[new], low[new]
    of = np.flatnonzero(np.r_[True, high[1:] != high[:-1]])  # first window of each pair
    rows = np.diff(np.r_[of, len(high)])
    pair = high[of]
    first = pc.binary_join_element_wise(langs.take(pa.array(pair // (many * many))),
                                        names.take(pa.array(pair // many % many)), "\n")
    heads = pc.binary_join_element_wise(first, names.take(pa.array(pair % many)), " ")
    hot = rows > max(256, len(high) // 100)
    put = np.repeat(np.arange(len(of)), rows)
    found = pc.binary_join_element_wise(heads.take(pa.array(put)), names.take(pa.array(low // many)),
                                        names.take(pa.array(low % many)), " ")
    n[hot[put]] *= -1
    if hot.any():
        marks = pc.binary_join_element_wise(heads.filter(pa.array(hot)), "", "", " ")
        found, n = pa.concat_arrays([found, marks]), np.r_[n, np.zeros(len(marks), np.int64)]
    return pa.RecordBatch.from_arrays([found, long_array(n)], ["window", "n"])


def count_windows(batches: Iterator[pa.RecordBatch], frequent: np.ndarray | None = None, limit: int = CHUNK,
                  long: int = LONG) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches, limit, long):
        t = _Tokens(*chunk)
        if t.own.any():
            found = _windows(t, frequent)
            for a in range(0, found.num_rows, ROWS):
                yield found.slice(a, ROWS)


@dataclass
class _Open:
    """The groups that a batch ends in: last window, its count so far; totals and rests of
    what is closed in its groups of three words and two, rest of its first word."""

    window: str
    n: int
    t3: int
    r3: int
    t2: int
    r2: int
    r1: int
    through: bool


def _new(column: pa.Array) -> np.ndarray:
    """True where a value differs from the one before, and at the start."""
    return np.r_[True, np.asarray(pc.not_equal(column[1:], column[:-1]))]


def _filled(column: pa.Array, at: np.ndarray) -> np.ndarray:
    return np.asarray(pc.not_equal(column.take(pa.array(at)), ""))


def _escape(lang: pa.Array) -> pa.Array:
    """Without spaces, so that a window's parts are found by them."""
    return pc.replace_substring(pc.replace_substring(lang, "%", "%25"), " ", "%20")


def _language(first: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(language, word) of the first part of windows."""
    lang, word = _columns(pc.split_pattern(first, "\n", max_splits=1, reverse=True), 2)
    return pc.replace_substring(pc.replace_substring(lang, "%20", " "), "%25", "%"), word


def _columns(lists: pa.Array, many: int) -> list[pa.Array]:
    flat, n = lists.flatten(), np.arange(len(lists)) * many
    return [flat.take(pa.array(n + k)) for k in range(many)]


def fold(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Sorted windows -> windows cut after the longest prefix that occurs ``least`` times; those
    of a pair that starts with a marker or with -n pass as they are."""
    left: _Open | None = None
    for batch in chain(batches, [None]):
        last = batch is None
        if last and left is None or not last and not batch.num_rows:
            continue
        window, n = batch.columns if not last else (pa.array([], pa.string()), np.zeros(0, np.int64))
        n = np.asarray(n)
        through, n = n <= 0, np.abs(n)
        if left:
            window = pa.concat_arrays([pa.array([left.window], pa.string()), window])
            n = np.r_[left.n, n]
            through = np.r_[left.through, through]
        first, w2, w3, w4 = _columns(pc.split_pattern(window, " "), WORDS)
        new1 = _new(first)
        new2 = new1 | _new(w2)
        new3 = new2 | _new(w3)
        new4 = new3 | _new(w4)
        i1, i2, i3, i4 = (np.flatnonzero(x) for x in (new1, new2, new3, new4))
        through = through[i2]
        shut = slice(None) if last else slice(0, -1)  # the last groups may go on in the next batch

        def closed(values: np.ndarray) -> np.ndarray:
            out = np.zeros_like(values)
            out[shut] = values[shut]
            return out

        s4 = np.add.reduceat(n, i4)
        c4 = closed(s4)
        keep4 = through[np.cumsum(new2)[i4] - 1] | (c4 >= least) & _filled(w4, i4)
        of3 = np.flatnonzero(new3[i4])
        t3, r3 = np.add.reduceat(c4, of3), np.add.reduceat(np.where(keep4, 0, c4), of3)
        if left:
            t3[0] += left.t3
            r3[0] += left.r3
        c3 = closed(r3)
        keep3 = (closed(t3) >= least) & _filled(w3, i3)
        of2 = np.flatnonzero(new2[i3])
        t2, r2 = np.add.reduceat(closed(t3), of2), np.add.reduceat(np.where(keep3, 0, c3), of2)
        if left:
            t2[0] += left.t2
            r2[0] += left.r2
        c2 = closed(r2)
        keep2 = (closed(t2) >= least) & _filled(w2, i2)
        r1 = np.add.reduceat(np.where(keep2, 0, c2), np.flatnonzero(new1[i2]))
        if left:
            r1[0] += left.r1
        c1 = closed(r1)

        keep = [c1 > 0, keep2 & (c2 > 0), keep3 & (c3 > 0), keep4 & (c4 > 0)]
        at = [i[k] for i, k in zip((i1, i2, i3, i4), keep)]
        lang, w1 = _language(first.take(pa.array(np.concatenate(at))))
        more = [pa.concat_arrays([pa.array([""] * sum(map(len, at[:k])), pa.string()),
                                  w.take(pa.array(np.concatenate(at[k:])))]) for k, w in ((1, w2), (2, w3), (3, w4))]
        yield pa.RecordBatch.from_arrays(
            [lang, w1, *more, long_array(np.concatenate([c[k] for c, k in zip((c1, c2, c3, c4), keep)]))],
            ["lang", "w1", "w2", "w3", "w4", "n"])
        left = _Open(window[-1].as_py(), int(s4[-1]), int(t3[-1]), int(r3[-1]), int(t2[-1]), int(r2[-1]),
                     int(r1[-1]), bool(through[-1]))


def frequent_bits(src: DataFrame, least: int) -> np.ndarray:
    """A bit for each counter that reaches ``least``: 2^BITS bits, as rows of 4 KB at most."""
    sums = map_arrow(src, count_words, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    rows = (sums.where(F.col("n") >= least).groupBy(F.expr("at div 32768").alias("block"))
            .agg(F.bitmap_construct_agg(F.col("at") % 32768).alias("bits")).collect())
    out = np.zeros(1 << BITS - 3, np.uint8)
    for r in rows:
        out[r.block * 4096:(r.block + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def phrase_counts(df: DataFrame, least: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Exact counts of the phrases of one to four words that occur ``least`` times in their
    language (lang, size, phrase, f), and of all words of a language (size 0, phrase '')."""
    src = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    frequent = frequent_bits(src, least)
    windows = map_arrow(src, lambda batches: count_windows(batches, frequent), "window string, n long")
    # under their pair; those of a hot pair by themselves
    to = F.when(F.col("n") < 0, F.xxhash64("window")).otherwise(F.xxhash64(F.substring_index("window", " ", 2)))
    met = windows.repartition(to).sortWithinPartitions("window", "n")
    cut = materialize(map_arrow(met, lambda batches: fold(batches, least),
                                "lang string, w1 string, w2 string, w3 string, w4 string, n long"), "windows")
    words = ["w1", "w2", "w3", "w4"]
    sums = cut.rollup("lang", *words).agg(F.sum("n").alias("f"), F.grouping_id().alias("gid"))
    size = WORDS - F.bit_count("gid")
    ends = F.greatest(*(F.when((size == k + 1) & (F.col(w) != ""), True).otherwise(False) for k, w in enumerate(words)))
    rows = sums.where((size == 0) | ends & (F.col("f") >= least)).select(
        "lang", size.alias("size"), F.concat_ws(" ", *words).alias("phrase"), "f")
    return materialize(rows.where("size >= 0"), "phrases")


def collocations(df: DataFrame, least: int = 30, longest: int = 4, share: tuple[int, int] = (80, 100),
                 top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` (at most 4) words by their weakest cut:
    lang, rank, phrase, a, l, r, n, score.  Phrases inside a longer candidate that has
    ``share`` of their count or more are left out."""
    if not 2 <= longest <= WORDS:
        raise ValueError(f"longest must be 2 to {WORDS}")
    counts = phrase_counts(df, least, text_col, lang_col)
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    known = counts.where(f"size between 1 and {longest - 1}").select("lang", "phrase", "f")
    found = counts.where(f"size between 2 and {longest}").select(
        "lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))

    def part(first: Column, size: Column) -> Column:
        return F.array_join(F.slice("words", first, size), " ")

    k = F.col("k")
    cuts = found.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "size")
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), k).alias("first"), part(k + 1, F.col("size")).alias("rest"))
    cuts = (cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
            .join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    score = F.expr("cast((cast(2000000 as decimal(38, 0)) * a) div (cast(l as decimal(38, 0)) + r) as bigint)")
    scored = (cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
              .groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut")))

    def inside_of(m: int) -> Column:
        """All phrases of m words inside a longer one."""
        starts = F.sequence(F.lit(1), F.col("size") - m + 1)
        return F.when(F.col("size") > m, F.transform(starts, lambda i: part(i, F.lit(m)))).otherwise(
            F.array().cast("array<string>"))

    if longest > 2:
        within = (found.where("size > 2").select("lang", "a", F.explode(F.flatten(F.array(*(
            inside_of(m) for m in range(2, longest))))).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
        num, den = share
        inside = F.expr(f"cast({den} as decimal(38, 0)) * longer >= cast({num} as decimal(38, 0)) * a")
        scored = scored.join(within, ["lang", "phrase"], "left").where(~F.coalesce(inside, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a",
                                            "cut.l", "cut.r", "n", "cut.score")
