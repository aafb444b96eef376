"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered in the order of their ids.  A keyed permutation of 0 .. n-1 sends a row's
number to a place; ``place mod shards`` is its shard and ``place div shards`` its slot.  So the
shuffle is reproducible from (n, seed) alone, shard and slot of a row are computed without a
lookup, the row of a slot by the inverse, and shards differ by one row at most.

The permutation is a Feistel network on pairs (left, right) of a rectangle a x b that just
holds n: in turn, one half is shifted by a keyed function of the other.  Places outside n walk
on along their cycle until they are inside.

Only row numbers and narrow columns move; texts move only when shards are written.

Cases: the law is on row counts, so equal texts and equal ids are rows of their own and are
dealt apart; null ids come first, ties in the id are ordered by text, rows equal in both are
interchangeable; a null text has size 1 and the checksum of no bytes; an empty table gives an
empty result; with fewer rows than shards some shards stay empty.  Columns that are not asked
for are ignored, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.common import long_array, map_arrow, materialize, mix
from vantage.llm.numbering import numbered

ROUNDS = 8


class Permutation:
    """A keyed bijection of 0 .. n-1; ``of`` takes numbers to places, ``back`` places to numbers."""

    def __init__(self, n: int, seed: int = 0):
        self.n = n
        self.a = max(1, isqrt(max(n - 1, 0)) + 1)
        self.b = max(1, -(-n // self.a))
        keys = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.keys = mix(keys ^ mix(np.array([seed % (1 << 64)], np.uint64) + np.uint64(0x5EED)))

    def _shift(self, k: int, half: np.ndarray, size: int) -> np.ndarray:
        return mix(half + self.keys[k]) % np.uint64(size)

    def _forward(self, x: np.ndarray) -> np.ndarray:
        a, b = np.uint64(self.a), np.uint64(self.b)
        left, right = x // b, x % b
        for k in range(ROUNDS):
            if k % 2:
                left = (left + self._shift(k, right, self.a)) % a
            else:
                right = (right + self._shift(k, left, self.b)) % b
        return left * b + right

    def _backward(self, x: np.ndarray) -> np.ndarray:
        a, b = np.uint64(self.a), np.uint64(self.b)
        left, right = x // b, x % b
        for k in reversed(range(ROUNDS)):
            if k % 2:
                left = (left + a - self._shift(k, right, self.a)) % a
            else:
                right = (right + b - self._shift(k, left, self.b)) % b
        return left * b + right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = step(np.asarray(x).astype(np.uint64))
            while (outside := np.flatnonzero(out >= self.n)).size:
                out[outside] = step(out[outside])
        return out.astype(np.int64)

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, self._forward)

    def back(self, places: np.ndarray) -> np.ndarray:
        return self._walk(places, self._backward)


def row_of(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The row number in a slot of a shard."""
    return int(Permutation(n, seed).back(np.array([slot * shards + shard]))[0])


def shard_rows(df: DataFrame, shards: int, carry: dict[str, Column], id_col: str = "doc_id",
               text_col: str = "text", seed: int = 0) -> DataFrame:
    """One row per row of ``df``: the columns of ``carry`` (names and what they hold), ``row``
    (its global number), ``shard`` and ``slot``."""
    # the last key takes copies of one row apart: a range of the order never has to hold them all
    keys = {"#id": F.col(id_col), "#tie": F.xxhash64(F.col(text_col)), "#copy": F.monotonically_increasing_id()}
    narrow = materialize(df.select(F.struct(*(c.alias(k) for k, c in carry.items())).alias("carry"),
                                   *(c.alias(k) for k, c in keys.items())), "rows")
    perm = Permutation(narrow.count(), seed)
    placed = numbered(narrow, list(keys)).select("carry", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = perm.of(np.asarray(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array((place % shards).astype(np.int32)), long_array(place // shards)],
                ["carry", "row", "shard", "slot"])

    kind = placed.schema["carry"].dataType.simpleString()
    dealt = map_arrow(placed, run, f"carry {kind}, row long, shard int, slot long")
    return dealt.select("carry.*", "row", "shard", "slot")


def write_shards(df: DataFrame, folder: str, shards: int, id_col: str = "doc_id", text_col: str = "text",
                 seed: int = 0) -> DataFrame:
    """Write whole rows to ``folder/shard=i`` in the order of their slots; returns the written
    table.  A column of ``df`` named shard, slot or row would clash and is an error."""
    if clash := {"shard", "slot", "row"} & {c.lower() for c in df.columns}:
        raise ValueError(f"columns clash with the written ones: {sorted(clash)}")
    dealt = shard_rows(df, shards, {c: F.col(c) for c in df.columns}, id_col, text_col, seed)
    (dealt.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(folder))
    return df.sparkSession.read.schema(dealt.schema).parquet(folder)
