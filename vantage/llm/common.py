"""Shared helpers of the training-data operators: scratch tables in the shared
folder, word hashing, and batch slicing for the Arrow map stages."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from vantage.session import scratch_root

#: bytes of text handled at once inside a task
CHUNK_BYTES = 1 << 20
#: words remembered by a worker before it starts over
MEMO_WORDS = 200_000

_P = np.uint64(0x9E3779B97F4A7C15)


_SHIPPED: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Give the executors this package, once an application: their workers need not
    have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import vantage
    root = os.path.dirname(os.path.abspath(vantage.__file__))
    made = os.path.join(tempfile.mkdtemp(prefix="ship-"), "vantage.zip")
    with zipfile.ZipFile(made, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(made)  # Spark copies it to every executor
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, fn, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    _ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder (never a machine-local one);
    ``session.clear_scratch`` removes them when their results have been read."""
    return f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: it is
    computed once, and a lost executor costs only the current stage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes each (one
    longer value makes a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        size = np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)
        cut = np.cumsum(size) // limit
        start = 0
        for stop in [*np.flatnonzero(np.diff(cut)) + 1, batch.num_rows]:
            yield batch.slice(start, stop - start)
            start = stop


# fixed values: the white space that ends a word, 0x20 and 0x09 to 0x0D
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(0x5EED).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _FOLDED[97:123]


class Words:
    """The white-space separated words of a column of texts, as hashes in one flat array.

    ``hash[first[i]:first[i + 1]]`` are the words of row i.  ``fold``: A-Z and a-z are equal."""

    def __init__(self, column: pa.Array, fold: bool = False):
        column = column.cast(pa.large_binary())
        cut = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[cut[0]:cut[-1]]
        cut = cut - cut[0]
        ends = np.zeros(len(data) + 1, bool)
        ends[cut] = True
        inside = ~_SPACE[data]
        start = inside.copy()
        start[1:] &= ~inside[:-1] | ends[1:-1]
        at = np.flatnonzero(start)
        self.letters = letters = data[inside]  # of all words, without the space between
        count = np.zeros(len(data) + 1, np.int64)
        np.cumsum(inside, out=count[1:])
        begin = count[at]
        self.size = size = np.diff(np.r_[begin, len(letters)])
        self.first = np.searchsorted(at, cut)
        if len(at):
            power = np.cumprod(np.full(int(size.max()), _P))
            inner = np.arange(len(letters)) - np.repeat(begin, size)
            with np.errstate(over="ignore"):
                self.hash = mix(np.add.reduceat((_FOLDED if fold else _BYTE)[letters] * power[inner], begin)
                                + size.astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, first word) of every run of ``k`` words within a row."""
        n = np.diff(self.first)
        many = np.maximum(n - k + 1, 0)
        row = np.repeat(np.arange(len(n)), many)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        return row, self.first[row] + inner


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer: makes every bit of a rolling hash usable for ordering."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` word hashes (polynomial, by doubling)."""
    out, done, power, part, width, ppow = None, 0, np.uint64(1), h, 1, _P
    with np.errstate(over="ignore"):
        while True:
            if k & width:
                n = len(h) - k + 1
                piece = part[done:done + n] * power
                out = piece if out is None else out + piece
                done, power = done + width, power * ppow
            if width * 2 > k:
                return out
            part = part[:-width] + part[width:] * ppow
            width, ppow = width * 2, ppow * ppow


def window_min(g: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values, by doubling."""
    part, width = g, 1
    while width * 2 <= w:
        part = np.minimum(part[:-width], part[width:])
        width *= 2
    return part if width == w else np.minimum(part[:len(g) - w + 1], part[w - width:])


def long_array(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))
