"""Substring dedup: De Bruijn compaction of repeated token k-mers.

Every k consecutive words of a document are an edge of a De Bruijn graph (from
its first to its last k-1 words).  A word goes if it is covered by an edge that
also occurs at an earlier coordinate: a smaller document id, or earlier in the same
document.

The graph is never built edge by edge.  Consecutive edges with the same minimizer
(the least hash among their m-grams) form a *path*; equal edges have equal
minimizers, so they meet under the same key, and a passage that is copied as it is
gives the same paths everywhere.

1. Paths: a row per path (minimizer, content hash, document, start), the copies
   within a task already reduced to the first; dealt out by minimizer.  Of
   equal paths only the first coordinate stays.  A minimizer with several
   contents is a branching place of the graph, as is a path that repeats an edge.
   A minimizer with over ``SPREAD`` contents in a task branches for sure: two of them
   go to the minimizer, so that it branches there too, the others are marked and
   dealt out by their contents.  Then a content may keep two first coordinates, but both
   are taken apart, and step 3 has the least of each edge.
2. First coordinates go back to their documents (one row for each distinct path,
   so a group of copies of any size returns one row for each path).  A path of a
   document that is not among them is a repeat as a whole.
3. First paths at branching places are taken apart into edges; the least
   coordinate of each edge goes back to its document in the same way.
4. Every document checks the returned coordinates against its own words (the
   fingerprint travels with them) and cuts the spans found.

Two k-mers are taken as equal if their minimizer and window hashes, 128 bits
together, agree.

Cases: null text has no words; a document of fewer than k words loses nothing;
rows without an id are not compared (nothing is removed from them); rows with the
same id share their coordinates, and neither is earlier than the other at the same
place; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.llm.common import Words, long_array, map_arrow, mix, rolling, slices, window_min

#: words of a minimizer
GRAM = 6
#: paths gathered in a task before its copies are reduced
FLUSH = 1_000_000
#: contents of a minimizer in a task that stay together
SPREAD = 16
#: bytes of text worked on at once: arrays over its words stay in cache
PART = 1 << 20

_P = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)


class Paths:
    """The paths of a column of texts.  Edge i starts at word ``at[i]`` of the flat words;
    path p consists of ``size[p]`` edges from edge ``start[p]`` on."""

    def __init__(self, column: pa.Array, k: int):
        self.words = w = Words(column)
        m = min(GRAM, k)
        self.row, self.at = w.runs(k)
        if not len(self.at):
            self.edges = self.minimizer = self.content = np.zeros(0, np.uint64)
            self.start = self.size = np.zeros(0, np.int64)
            return
        self.edges = mix(rolling(w.hash, k))[self.at]
        low = window_min(mix(rolling(w.hash, m)), k - m + 1)[self.at]
        self.start = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (self.row[1:] != self.row[:-1])])
        self.size = np.diff(np.r_[self.start, len(low)])
        self.minimizer = low[self.start]
        power = np.cumprod(np.full(int(self.size.max()), _P))
        inner = np.arange(len(low)) - np.repeat(self.start, self.size)
        self.content = mix(np.add.reduceat(self.edges * power[inner], self.start) + self.size.astype(np.uint64))

    def place(self) -> np.ndarray:
        """First word of every path, counted within its row."""
        e = self.start
        return self.at[e] - self.words.first[self.row[e]]

    def repeating(self, k: int) -> np.ndarray:
        """Per path: does it hold an edge twice?  One whose minimizer occurs once has
        at most as many edges as grams fit a window, so longer ones count as well."""
        reach = k - min(GRAM, k) + 1
        out = self.size > reach
        path = np.repeat(np.arange(len(self.start)), self.size)
        for d in range(1, min(reach, len(path))):
            same = np.flatnonzero(self.edges[:-d] == self.edges[d:])
            out[path[same[path[same] == path[same + d]]]] = True
        return out

    def entries(self, listed: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat word, fingerprint, flag) of the coordinates listed for each row."""
        size = np.asarray(pc.fill_null(pc.list_value_length(listed), 0))
        entry = np.asarray(listed.flatten()).astype(np.int64).view(np.uint64)
        row = np.repeat(np.arange(len(size)), size)
        at = (entry >> np.uint64(33)).astype(np.int64)
        here = at < np.diff(self.words.first)[row]
        entry = entry[here]
        return self.words.first[row[here]] + at[here], entry >> np.uint64(1) & _LOW, entry & np.uint64(1)

    def firsts(self, listed: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Per path: is it a first one as a whole; is it a first one to be taken apart?"""
        path_at = np.full(len(self.words.hash) + 1, -1)
        path_at[self.at[self.start]] = np.arange(len(self.start))
        word, check, flag = self.entries(listed)
        path = path_at[word]
        good = (path >= 0) & (self.content[path] & _LOW == check) if len(self.content) else np.zeros(len(path), bool)
        whole, apart = (np.zeros(len(self.start), bool) for _ in range(2))
        whole[path[good & (flag == 0)]] = True
        apart[path[good & (flag == 1)]] = True
        return whole, apart


def _spread(mins: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, is it spread?) of paths with different contents: their minimizer; for all but two of
    a minimizer with over ``SPREAD`` contents a mix of both."""
    order = np.argsort(mins, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(mins[order].view(np.int64)) != 0]) if len(order) else order
    count = np.diff(np.r_[first, len(order)])
    rank = np.arange(len(order)) - np.repeat(first, count)
    split = np.zeros(len(order), bool)
    split[order] = (np.repeat(count, count) > SPREAD) & (rank >= 2)
    return np.where(split, mix(mins ^ mix(content)), mins), split


def _paths(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flush():
            mins, content, ids, pos, flag = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((pos, ids, content))
            order = order[np.r_[True, np.diff(content[order].view(np.int64)) != 0]]  # the first of each content
            key, split = _spread(mins[order], content[order])
            return pa.RecordBatch.from_arrays(
                [long_array(key), long_array(content[order]), long_array(ids[order]),
                 long_array(pos[order] * 2 + (flag[order] | split))], ["key", "c", "id", "at"])

        for batch in slices(batches, "text", PART):
            p = Paths(batch.column(1), k)
            ids = np.asarray(batch.column(0)).astype(np.int64)
            held.append((p.minimizer, p.content, ids[p.row[p.start]], p.place(), p.repeating(k)))
            rows += len(p.start)
            if rows >= FLUSH:
                yield flush()
                held, rows = [], 0
        if held:
            yield flush()
    return run


def _edges(k: int):
    """Edges of the first paths at branching places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PART):
            p = Paths(batch.column(1), k)
            _, apart = p.firsts(batch.column(2))
            e = np.flatnonzero(np.repeat(apart, p.size))
            ids = np.asarray(batch.column(0).fill_null(0)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [long_array(np.repeat(p.minimizer, p.size)[e]), long_array(p.edges[e]), long_array(ids[p.row[e]]),
                 long_array(p.at[e] - p.words.first[p.row[e]])], ["mz", "e", "id", "at"])
    return run


def _cut(k: int):
    """Kept text and removed spans of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PART):
            ids, text = batch.column(0), batch.column(1)
            p = Paths(text, k)
            first = p.words.first
            whole, apart = p.firsts(batch.column(2))
            stays = np.repeat(whole, p.size)
            edge_at = np.full(len(p.words.hash) + 1, -1)
            edge_at[p.at] = np.arange(len(p.at))
            word, check, _ = p.entries(batch.column(3))
            edge = edge_at[word]
            edge = edge[(edge >= 0) & (p.edges[edge] & _LOW == check)] if len(p.edges) else edge[:0]
            stays[edge] |= np.repeat(apart, p.size)[edge]
            stays |= ~np.asarray(ids.is_valid())[p.row]  # without an id nothing is compared
            step = np.zeros(len(p.words.hash) + 1, np.int64)
            gone = p.at[~stays]
            np.add.at(step, gone, 1)
            np.add.at(step, gone + k, -1)
            covered = np.cumsum(step)[:-1] > 0
            removed = np.diff(np.r_[0, np.cumsum(covered)][first])
            texts, spans = [], []
            for i, (t, n) in enumerate(zip(text.to_pylist(), removed.tolist())):
                kept, cut = t.encode().split() if t else [], []  # splits at 0x20 and 0x09 to 0x0D alone
                if n:
                    mask = covered[first[i]:first[i + 1]]
                    ends = np.flatnonzero(np.diff(np.r_[False, mask, False])).reshape(-1, 2).tolist()
                    cut = [{"start": a, "stop": b} for a, b in ends]
                    kept = list(compress(kept, (~mask).tolist()))
                texts.append(b" ".join(kept).decode())
                spans.append(cut)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(first), pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                 *([batch.column(4), text] if batch.num_columns > 4 else [])],
                ["id", "n_words", "n_removed", "kept", "spans", *(["row", "text"] if batch.num_columns > 4 else [])])
    return run


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 20,
                    carry: bool = False) -> DataFrame:
    """Per row: id, n_words, n_removed, ``kept`` (words that stay, joined by a space) and
    ``spans`` (start and stop of the removed words); with ``carry`` also ``row``, a struct of
    the columns that came in."""
    # the text moves once, beside the other columns
    rest = [c for c in df.columns if c != text_col or df.schema[c].dataType != T.StringType()]
    packed = F.struct(F.lit(1).alias("#"), *(F.col(c) for c in rest)).alias("row")
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                     *([packed] if carry else []))
    paths = map_arrow(docs.where("id IS NOT NULL"), _paths(k), "key long, c long, id long, at long")

    # all contents of a key side by side, each with its least coordinate first
    one = Window.partitionBy("key").orderBy("c", "id", "at")
    whole = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entry = F.expr("shiftleft(shiftright(at, 1), 33) | shiftleft(c & 4294967295L, 1)")
    firsts = (paths
              .withColumn("before", F.lag("c").over(one))
              .withColumn("branching", F.first("c").over(whole) != F.last("c").over(whole))
              .where("before IS NULL OR before != c")
              .select("id", entry.bitwiseOR(F.expr("IF(branching OR (at & 1) = 1, 1L, 0L)")).alias("entry"))
              .groupBy("id").agg(F.collect_list("entry").alias("firsts")))
    with_firsts = docs.join(firsts, "id", "left")

    # a projection, not a filter: so both uses of the documents share one exchange
    some = F.exists("firsts", lambda x: x.bitwiseAND(F.lit(1).cast("long")) == 1)
    to_part = with_firsts.select("id", F.when(some, F.col("text")).alias("text"), "firsts")
    edges = map_arrow(to_part, _edges(k), "mz long, e long, id long, at long")
    first_edges = (edges.groupBy("mz", "e").agg(F.min(F.struct("id", "at")).alias("o"))
                   .select("o.id", F.expr("shiftleft(o.at, 33) | shiftleft(e & 4294967295L, 1)").alias("entry"))
                   .groupBy("id").agg(F.collect_list("entry").alias("edges")))
    done = with_firsts.join(first_edges, "id", "left").select("id", "text", "firsts", "edges", *["row"] * carry)
    schema = T.StructType.fromDDL("id long, n_words long, n_removed long, kept string, "
                                  "spans array<struct<start:long,stop:long>>")
    if carry:
        schema = schema.add(done.schema["row"]).add("text", "string")
    out = map_arrow(done, _cut(k), schema)
    names = ["id", "n_words", "n_removed", "kept", "spans"]
    whole = F.struct(*(F.col("row")[c].alias(c) if c in rest else F.col("text").alias(c) for c in df.columns)).alias("row")
    return out.select(*names, *([whole] if carry else [])).withColumnRenamed("id", id_col)
