"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine at least c are at most ``2 - 2c`` apart in squared distance.
All vectors are turned by one fixed random rotation and cut into blocks of about
``BLOCK`` dimensions; in at least one block the squared distance of such a pair is
within the block's proportional share.  So each block is joined on its own: a grid over
its first two coordinates, with cells twice as wide as the block's radius, brings vectors
to the cells within the radius; inside a cell block distances select the candidates,
and every candidate is verified by its cosine in double precision.

A pair is counted once: in the first block that selects it, in the lesser of the two home
cells.  Cells of many vectors are cut into chunks of ``CHUNK`` and compared chunk by chunk, each
pair of chunks a group of its own, so no group grows with the data.  Nothing
quadratic leaves a task: it returns a vector's number of links and one edge of a
spanning forest.  Equal vectors are one vector with a multiplicity from the start.

Cases: vectors that are null, empty, zero or hold null or non-finite components, and rows
without an id, link with nothing; vectors of different lengths are not compared; rows with the
same id are rows of their own, told apart by their vectors; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.llm.common import _ship, map_arrow, materialize
from vantage.llm.components import components, forest

BLOCK = 8
CHUNK = 16384
#: rows of a chunk compared at once
STRIP = 256
SLACK = 1e-6


@lru_cache(maxsize=8)
def rotation(d: int) -> np.ndarray:
    """One fixed random rotation of d dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(0xB10C + d).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def blocks(d: int) -> list[tuple[int, int]]:
    cuts = np.linspace(0, d, max(1, round(d / BLOCK)) + 1).astype(int)
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def turned(vectors: np.ndarray) -> np.ndarray:
    """Rotated unit vectors."""
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True) @ rotation(vectors.shape[1])


def _vectors(column: pa.Array, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) for each vector length of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    cut = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[cut[0]:cut[-1]] if len(column) else np.zeros(0, np.uint8)
    size = np.diff(cut)
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        picked = data if len(rows) == len(size) else data[np.repeat(size == n, size)]
        yield rows, picked.view(kind).reshape(len(rows), -1).astype(float)


def _valid(kind: str):
    """Vectors as bytes; null where they cannot be compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, known in zip(batch.column(1).to_pylist(), batch.column(0).is_valid().to_pylist()):
                v = np.array(x, float) if x and known and None not in x else np.zeros(0)
                with np.errstate(over="ignore"):
                    good = v.size and np.isfinite(v).all() and 0 < np.linalg.norm(v) < np.inf
                out.append((v + 0.0).astype(kind).tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "vec"])
    return run


def _places(kind: str, span: float, cells: dict[tuple[int, int, int], tuple[int, int]] | None):
    """Rows of the cells that a vector belongs to.  Without ``cells``: home and visits alone;
    with the numbers of home and visiting chunks of every cell: the groups to compare."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for rows, vectors in _vectors(batch.column(2), kind):
                x, d = turned(vectors), vectors.shape[1]
                for b, (lo, hi) in enumerate(blocks(d)):
                    radius = np.sqrt(span * (hi - lo) / d) * (1 + SLACK) + SLACK
                    grid = x[:, lo:min(lo + 2, hi)]
                    if grid.shape[1] == 1:
                        grid = np.c_[grid, np.zeros(len(grid))]
                    number = lambda g: (g[:, 0] + 1024) * 4096 + g[:, 1] + 1024
                    home = number(np.floor(grid / (2 * radius)).astype(np.int64))
                    corners = [np.floor((grid + radius * np.array(s)) / (2 * radius)).astype(np.int64)
                               for s in ((-1, -1), (-1, 1), (1, -1), (1, 1))]
                    seen = np.sort(np.stack([number(c) for c in corners]), axis=0)
                    fresh = np.r_[np.ones((1, len(x)), bool), seen[1:] != seen[:-1]] & (seen < home)
                    which, guest = np.nonzero(fresh)
                    at = np.r_[np.arange(len(x)), guest]
                    cell = np.r_[home, seen[which, guest]]
                    visits = np.r_[np.zeros(len(x), bool), np.ones(len(guest), bool)]
                    if cells is None:
                        yield pa.RecordBatch.from_pydict({"d": np.full(len(at), d), "block": np.full(len(at), b),
                                                          "cell": cell, "visits": visits})
                        continue
                    yield from _groups(batch, rows, ids, at, cell, visits, d, b, cells)
    return run


def _groups(batch, rows, ids, at, cell, visits, d, b, cells):
    """Copies of the rows for every pair of chunks that they are in."""
    known, where = np.unique(cell, return_inverse=True)
    home, guests = np.array([cells[d, b, c] for c in known.tolist()], np.int64)[where].T
    mixed = (ids[rows[at]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
    own = np.where(visits, home + mixed % np.maximum(guests, 1), mixed % home)
    # a home chunk meets home chunks (itself too) and visiting chunks, a visiting one home chunks
    many = np.where(visits, home, home + guests)
    k = np.repeat(np.arange(len(at)), many)
    other = np.arange(len(k)) - np.repeat(np.cumsum(many) - many, many)
    first, second = np.minimum(own[k], other), np.maximum(own[k], other)
    names = {"d": pa.array(np.full(len(k), d)), "block": pa.array(np.full(len(k), b)), "cell": pa.array(cell[k]),
             "first": pa.array(first), "second": pa.array(second), "side": pa.array(own[k] != first)}
    take = pa.array(rows[at[k]])
    names |= {n: batch.column(i).take(take) for i, n in enumerate(("id", "times", "vec", "key"))}
    for start in range(0, len(k), 4096):
        yield pa.RecordBatch.from_pydict({n: c[start:start + 4096] for n, c in names.items()})


def _compare(kind: str, least: float, span: float):
    def run(table: pa.Table) -> pa.Table:
        d, b, first, second = (table.column(c)[0].as_py() for c in ("d", "block", "first", "second"))
        side = np.asarray(table.column("side"))
        ids, times = np.asarray(table.column("id")), np.asarray(table.column("times"))
        raw = np.concatenate([v for c in table.column("vec").chunks for _, v in _vectors(c, kind)])
        x, norm = turned(raw), np.linalg.norm(raw, axis=1)
        lo, hi = blocks(d)[b]
        left = np.flatnonzero(~side)
        right = left if first == second else np.flatnonzero(side)
        part = x[:, lo:hi].astype(np.float32)
        square, ones = (part ** 2).sum(1, keepdims=True), np.ones((len(part), 1), np.float32)
        # one product gives the squared distances: |x|^2 + |y|^2 - 2 x y
        ahead, behind = np.hstack([part, square, ones]), np.hstack([-2 * part, ones, square])[right].T.copy()
        budget = np.array([span * (q - p) / d for p, q in blocks(d)]) * (1 + 1e-9) + 1e-12
        limit = np.float32(budget[b] + 1e-5)
        starts = np.array([p for p, _ in blocks(d)])
        found_a, found_b = [], []
        for at in range(0, len(left), STRIP):
            rows = left[at:at + STRIP]
            i, j = np.divmod(np.flatnonzero((ahead[rows] @ behind).ravel() <= limit), len(right))
            i, j = rows[i], right[j]
            if first == second:
                i, j = i[i < j], j[i < j]
            for cut in range(0, len(i), 1 << 15):
                p, q = i[cut:cut + (1 << 15)], j[cut:cut + (1 << 15)]
                within = np.add.reduceat((x[p] - x[q]) ** 2, starts, axis=1) <= budget
                mine = within[:, b] & (within.argmax(1) == b)
                p, q = p[mine], q[mine]
                good = np.einsum("ij,ij->i", raw[p], raw[q]) / (norm[p] * norm[q]) >= least
                found_a.append(p[good])
                found_b.append(q[good])
        a, c = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in (found_a, found_b))
        links = np.bincount(a, times[c], len(ids)) + np.bincount(c, times[a], len(ids))
        # the root of a tree is the least node: the least id, of equal ids the least vector
        order = np.asarray(pc.sort_indices(table.select(["id", "key"]), [("id", "ascending"), ("key", "ascending")]))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        root = order[forest(len(ids), place[a], place[c])[place]]
        hit = np.flatnonzero(links)
        of = lambda name, rows: table.column(name).take(pa.array(rows))
        return pa.table({"id": of("id", hit), "key": of("key", hit), "links": links[hit].astype(np.int64),
                         "root": of("id", root[hit]), "root_key": of("key", root[hit])})
    return run


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95) -> DataFrame:
    """Per row: id, n_links (other vectors with cosine >= ``least``), component_id (least id
    reachable by links), kept (is it that one)."""
    span = 2 - 2 * least
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    single = df.schema[vector_col].dataType == T.ArrayType(T.FloatType(), df.schema[vector_col].dataType.containsNull)
    kind = "<f4" if single else "<f8"
    rows = map_arrow(rows, _valid(kind), "id long, vec binary")
    keyed = materialize(rows.select("id", F.md5("vec").alias("key"), "vec"), "vectors")
    distinct = materialize(keyed.where("vec IS NOT NULL").groupBy("key")
                           .agg(F.min("id").alias("id"), F.count("*").alias("times"), F.first("vec").alias("vec")), "distinct")
    vectors = distinct.select("id", "times", "vec", "key")
    counted = (map_arrow(vectors, _places(kind, span, None), "d long, block long, cell long, visits boolean")
               .groupBy("d", "block", "cell").agg(F.count_if(~F.col("visits")).alias("home"),
                                                  F.count_if("visits").alias("guests")))
    # a row per cell of the grid: bounded by its geometry, not by the data
    cells = {(r.d, r.block, r.cell): (max(1, -(-r.home // CHUNK)), -(-r.guests // CHUNK)) for r in counted.collect()}
    _ship(df.sparkSession)
    found = materialize(
        map_arrow(vectors, _places(kind, span, cells), "d long, block long, cell long, first long, second long, side boolean, "
                                                 "id long, times long, vec binary, key string")
        .groupBy("d", "block", "cell", "first", "second")
        .applyInArrow(_compare(kind, least, span), "id long, key string, links long, root long, root_key string"), "links")
    linked = found.groupBy("key").agg(F.sum("links").alias("links"))
    node = lambda i, k: F.struct(F.col(i).alias("id"), F.col(k).alias("key"))  # noqa: E731  an id may have many vectors
    met = components(found.select(node("id", "key").alias("a"), node("root", "root_key").alias("b")))
    met = met.select("id.key", F.col("component.id").alias("component"))
    classes = materialize(distinct.select("key", "id", "times").join(linked, "key", "left").join(met, "key", "left")
                          .select("key", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                                  F.coalesce("component", "id").alias("component_id")), "classes")
    own = F.coalesce("component_id", "id")
    return keyed.select("id", "key").join(classes, "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"), F.col("id").eqNullSafe(own).alias("kept"))
