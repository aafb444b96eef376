"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set are its distinct k-word shingles (64-bit hashes).  Documents with equal
sets are one class, whose smallest id stands for it.

Prefixes: in one global order of shingles, two sets with Jaccard similarity t or more
share at least l shingles among the first ``n - ceil(t n) + l`` of each (l-prefix).  Rare
shingles come first, so few sets meet.  To keep the counting of shingles in proportion to
what prefixes need, the order puts the shingles below a fixed hash value first (by
frequency, then hash) and all others behind (by hash); a document sends only those, or
what its longest prefix needs.

Adaptive: each set picks its own l, from 1 to ``DEPTH``, by the estimated cost of its
candidates: a longer prefix meets more sets, but a pair must then share l shingles to be
verified.  A pair is held to the lesser l of its two sets.

Shingles that more than ``DENSE`` sets have in their prefixes make no pairs, but a star that
connects their sets.  Candidate pairs and stars make clusters; the sets of a cluster are
verified against each other on whole texts, by size class and in chunks of ``CHUNK`` sets, each
pair of chunks a group of its own, by multiplying their incidence matrices.  A group
returns an edge of a spanning forest for each set, so nothing quadratic leaves a task.

Cases: null texts and texts without words have an empty set and link with nothing, also not
with each other; texts of fewer than k words have one shingle, the whole sequence; rows
without an id are not compared and get no component; rows with the same id share a component
with every set that one of them links with; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import Words, _ship, long_array, map_arrow, materialize, mix, rolling, slices
from vantage.llm.components import components, forest

DEPTH = 6
DENSE = 32
CHUNK = 256
#: part of the hash values that come first, beyond 1 - t: so much of a set can be frequent
#: shingles before its prefix has to take some in
SLACK = 0.08
#: bytes of text worked on at once
PART = 1 << 20
_COLUMNS = 4096


def _sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingles of every row."""
    w = Words(column, fold=True)
    many = np.diff(w.first)
    flat = mix(rolling(w.hash, k)) if len(w.hash) >= k else np.zeros(0, np.uint64)
    out = []
    for start, n in zip(w.first.tolist(), many.tolist()):
        if n >= k:
            s = np.sort(flat[start:start + n - k + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif n:
            out.append(mix(rolling(w.hash[start:start + n], n) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _least(n: int, num: int, den: int) -> int:
    """Shingles that a set of n must share."""
    return -(-num * n // den)


def _sent(s: np.ndarray, limit: np.uint64, num: int, den: int) -> tuple[int, int]:
    """(shingles below ``limit``, shingles sent) of a set."""
    low = int(np.searchsorted(s, limit))
    return low, max(low, min(len(s), len(s) - _least(len(s), num, den) + DEPTH))


def _keys(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    with np.errstate(over="ignore"):
        return int(mix(s).sum().view(np.int64)), int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum().view(np.int64))


def _describe(k: int, limit: np.uint64, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PART):
            sets = _sets(batch.column(1), k)
            keys = [_keys(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a for a, _ in keys], pa.int64()), pa.array([b for _, b in keys], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_sent(s, limit, num, den)[0] for s in sets], pa.int64())], ["id", "set", "more", "n", "low"])
    return run


def _tokens(k: int, limit: np.uint64, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task are sent once
        for batch in slices(batches, "text", PART):
            tokens, names, places = [], [], []
            for s in _sets(batch.column(1), k):
                if not len(s) or (name := _keys(s)[0]) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(name)
                low, sent = _sent(s, limit, num, den)
                tokens.append(s[:sent])
                names.append(np.full(sent, name))
                place = np.arange(sent)
                place[:low] = 0  # their place is known once they are counted
                places.append(place)
            if tokens:
                yield pa.RecordBatch.from_arrays([long_array(np.concatenate(tokens)), pa.array(np.concatenate(names)),
                                                  pa.array(np.concatenate(places))], ["token", "set", "place"])
    return run


def _prefixes(limit: np.uint64, num: int, den: int):
    """(token, id, n, level, depth) of the prefix that a set chooses."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[], [], [], [], []]
            for i, n, low, shared in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(3)):
                v = shared.values
                token = np.asarray(v.field("token")).view(np.uint64)
                seen, place = np.asarray(v.field("seen")), np.asarray(v.field("place")).copy()
                first = token < limit
                order = np.lexsort((token[first], seen[first]))
                place[np.flatnonzero(first)[order]] = low - len(order) + np.arange(len(order))
                least = _least(n, num, den)
                level = np.maximum(1, place - (n - least) + 1)
                meets = seen - 1
                cost, best = np.inf, 1
                for depth in range(1, min(DEPTH, least) + 1):
                    pairs = meets[level <= depth].sum()
                    if (c := pairs + pairs / depth * n / 8) < cost:  # meeting a set, and verifying what is left
                        cost, best = c, depth
                keep = level <= best
                for r, x in zip(rows, (token[keep].view(np.int64), np.full(keep.sum(), i), np.full(keep.sum(), n),
                                       level[keep], np.full(keep.sum(), best))):
                    r.append(x)
            if rows[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(r).astype(np.int64)) for r in rows],
                                                 ["token", "id", "n", "level", "depth"])
    return run


def _compare(k: int, num: int, den: int):
    """Links between two chunks of a cluster (or within one), as forest edges."""
    def run(table: pa.Table) -> pa.Table:
        ids, side = np.asarray(table.column("id")), np.asarray(table.column("side"))
        one = table.column("first")[0].as_py() == table.column("second")[0].as_py()
        sets = _sets(pa.concat_arrays(table.column("text").chunks), k)
        size = np.array([len(s) for s in sets])
        names, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), size)
        used = count[column] > 1
        rank = np.cumsum(count > 1) - 1
        row, column = row[used], rank[column[used]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        left = np.flatnonzero(~side)
        right = left if one else np.flatnonzero(side)
        shared = np.zeros((len(left), len(right)), np.float32)
        for at in range(0, int(rank[-1]) + 1 if len(rank) else 0, _COLUMNS):
            a, b = np.searchsorted(column, [at, at + _COLUMNS])
            m = np.zeros((len(sets), _COLUMNS), np.float32)
            m[row[a:b], column[a:b] - at] = 1
            shared += m[left] @ m[right].T
        shared = shared.astype(np.int64)  # exact: far below 2 ** 24 shingles in common
        total = size[left][:, None] + size[right] - shared
        i, j = np.nonzero(den * shared >= num * total)
        i, j = left[i], right[j]
        i, j = i[i != j], j[i != j]
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        root = ids[order[forest(len(ids), place[i], place[j])[place]]]
        moved = root != ids
        return pa.table({"a": ids[moved], "b": root[moved]})
    return run


def _clusters(edges: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The sets of every cluster that ``edges`` connect, once for every pair of chunks that
    they are in: id, and the group's cluster, cell, first, second, side."""
    met = components(edges).withColumnRenamed("component", "cluster")
    members = classes.select("id", "n").join(met, "id")
    # sets that link differ by at most one size class
    step = F.floor(F.log(F.col("n")) / F.lit(float(np.log(den / num)) * (1 + 1e-9))).cast("long")
    cells = members.select("id", "cluster", step.alias("size")).select(
        "id", "cluster", F.explode(F.array(F.struct(F.col("size").alias("cell"), F.lit(False).alias("visits")),
                                           F.struct((F.col("size") + 1).alias("cell"), F.lit(True).alias("visits")))).alias("c"))
    cells = materialize(cells.select("id", "cluster", "c.cell", "c.visits"), "cells")
    chunks = lambda n: F.ceil(n / CHUNK).cast("int")
    count = (cells.groupBy("cluster", "cell").agg(F.count_if(~F.col("visits")).alias("h"), F.count_if("visits").alias("g"))
             .where("h > 0 AND h + g > 1").select("cluster", "cell", chunks(F.col("h")).alias("home"), chunks(F.col("g")).alias("guests")))
    spread = F.pmod(F.xxhash64("id"), F.when(F.col("visits"), F.col("guests")).otherwise(F.col("home"))).cast("int")
    own = F.when(F.col("visits"), F.col("home") + spread).otherwise(spread)
    others = F.sequence(F.lit(0), F.when(F.col("visits"), F.col("home")).otherwise(F.col("home") + F.col("guests")) - 1)
    return (cells.join(materialize(count, "cells"), ["cluster", "cell"])
            .select("id", "cluster", "cell", own.alias("own"), F.explode(others).alias("other"))
            .select("id", "cluster", "cell", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
                    (F.col("own") > F.col("other")).alias("side")))


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                       num: int = 90, den: int = 100) -> DataFrame:
    """Per row: id, n_shingles, component_id.  Rows link if their sets' Jaccard similarity is
    ``num / den`` or more."""
    spark = df.sparkSession
    _ship(spark)
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    limit = np.uint64(int(min(1.0, (den - num) / den + SLACK) * (2 ** 64 - 1)))
    rows = materialize(map_arrow(docs, _describe(k, limit, num, den), "id long, set long, more long, n long, low long"), "sets")
    key = ["set", "more", "n"]
    classes = materialize(rows.where("n > 0 AND id IS NOT NULL").groupBy(*key)
                          .agg(F.min("id").alias("id"), F.first("low").alias("low")), "classes")

    tokens = map_arrow(docs.where("id IS NOT NULL"), _tokens(k, limit, num, den), "token long, set long, place long")
    seen = materialize(tokens.groupBy("token").agg(F.count("*").alias("seen")).where("seen > 1"), "seen")
    shared = (tokens.join(seen, "token").groupBy("set")
              .agg(F.collect_set(F.struct("token", "seen", "place")).alias("shared")))
    prefixes = map_arrow(classes.join(shared, "set").select("id", "n", "low", "shared"), _prefixes(limit, num, den),
                         "token long, id long, n long, level long, depth long")
    prefixes = materialize(prefixes, "prefixes")

    held = materialize(prefixes.groupBy("token").agg(F.countDistinct("id").alias("sets"), F.min("id").alias("least"))
                       .where("sets > 1"), "held")
    known = prefixes.join(held, "token")
    few, dense = known.where(F.col("sets") <= DENSE), known.where(F.col("sets") > DENSE)
    a, b = (few.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "level", "depth"))) for s in "ab")
    met = a.join(b, "token").where((F.col("id_a") < F.col("id_b")) & (F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num))
    depth = F.least("depth_a", "depth_b")
    pairs = (met.where(F.greatest("level_a", "level_b") <= depth).groupBy(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
             .agg(F.count("*").alias("times"), F.first(depth).alias("depth")).where("times >= depth").select("a", "b"))
    # a star for each dense shingle stands for all pairs of its sets
    edges = pairs.unionByName(dense.select(F.col("id").alias("a"), F.col("least").alias("b")))
    groups = materialize(_clusters(edges, classes, num, den), "groups")
    # one plan at every size: texts meet their groups by a shuffle, also where a broadcast would do
    linked = (docs.join(groups.hint("merge"), "id").groupBy("cluster", "cell", "first", "second")
              .applyInArrow(_compare(k, num, den), "a long, b long"))
    joined = components(linked).withColumnRenamed("id", "of").withColumnRenamed("component", "reached")
    of_class = classes.join(joined, classes["id"] == joined["of"], "left").select(
        *key, F.coalesce("reached", "id").alias("component_id"))
    known_rows = rows.select("id", *key).join(of_class, key, "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return known_rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))
