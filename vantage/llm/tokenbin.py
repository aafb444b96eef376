"""Token ids as binary files with Elias-Fano document boundaries.

File: the ids of the file's documents one after another (16-bit while the
vocabulary allows, else 32-bit, little endian), then the document ids (64-bit),
then the ends of the documents in Elias-Fano form, then a footer.

Elias-Fano: the ends are a rising sequence of n values below or at U.  Their low
``l = floor(log2(U / n))`` bits are stored as they are; the rest in unary in a bit
string, where value i sets bit ``(end_i >> l) + i``.  Every 256th set bit's place is
kept, so ``select`` finds any end after scanning a few words; together about
``2 + l`` bits a document instead of 64.  Readers go over a file in blocks of whole
documents, whose bounds they select; only a block's ends are decoded at a time.

Documents are in ascending id order within and across files (range partitioned by
id, ties by text).  Files are streamed: only lengths and ids of one file's
documents are held in memory.

Cases: null text is empty text (just the end id); null ids sort first and keep
their null; equal ids keep all their rows, ordered by text; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm import files
from vantage.llm.bpe import SLICE, Encoder
from vantage.llm.common import map_arrow, scratch, slices
from vantage.llm.pieces import SIGN, Memo, buffers, gather, white_starts

MAGIC = b"EFTOKEN1"
FOOTER = "<8sqqqqqqq"  # magic, docs, null ids, ids, id width, low bits, high words, samples
SAMPLE = 256
#: pieces joined to one text for the library
JOIN = 200
#: ids read at a time, in whole documents
BLOCK = 1 << 21


class EliasFano:
    """A rising sequence; ``select(i)`` returns value i, ``part(a, b)`` those from a to b - 1,
    ``all()`` every value."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.bits, self.low, self.high, self.samples = n, bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.packbits(((values[:, None] >> np.arange(bits)) & 1).astype(np.uint8), bitorder="little") \
            if bits else np.zeros(0, np.uint8)
        places = (values >> bits) + np.arange(n)
        words = (int(places[-1]) // 64 + 1) if n else 0
        raw = np.zeros(words * 64, np.uint8)
        raw[places] = 1
        high = np.packbits(raw, bitorder="little").view("<u8") if n else np.zeros(0, "<u8")
        return cls(n, bits, low, high, places[::SAMPLE].astype("<u4"))

    def _low(self, i: int) -> int:
        a = i * self.bits
        chunk = int.from_bytes(self.low[a // 8:(a + self.bits + 7) // 8].tobytes(), "little")
        return (chunk >> a % 8) & ((1 << self.bits) - 1)

    def _place(self, i: int) -> int:
        at = int(self.samples[i // SAMPLE])
        left, word = i % SAMPLE, at // 64
        bits = int(self.high[word]) >> at % 64 << at % 64
        while (ones := bits.bit_count()) <= left:
            left, word = left - ones, word + 1
            bits = int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        return word * 64 + (bits & -bits).bit_length() - 1

    def select(self, i: int) -> int:
        return (self._place(i) - i) << self.bits | self._low(i)

    def upto(self, value: int, a: int) -> int:
        """How many values are at or below ``value``, knowing that the first ``a`` are."""
        b = self.n
        while a < b:
            half = (a + b) // 2
            a, b = (half + 1, b) if self.select(half) <= value else (a, half)
        return a

    def part(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.zeros(0, np.int64)
        first, last = self._place(a), self._place(b - 1)
        start = first // 64 * 64
        ones = start + np.flatnonzero(np.unpackbits(self.high[start // 64:last // 64 + 1].view(np.uint8), bitorder="little"))
        out = (ones[(ones >= first) & (ones <= last)] - np.arange(a, b)) << self.bits
        if self.bits:
            bit, size = a * self.bits, (b - a) * self.bits
            low = np.unpackbits(self.low[bit // 8:(bit + size + 7) // 8], bitorder="little")[bit % 8:bit % 8 + size]
            out |= low.reshape(b - a, self.bits).astype(np.int64) @ (np.int64(1) << np.arange(self.bits, dtype=np.int64))
        return out

    def all(self) -> np.ndarray:
        return self.part(0, self.n)


class LibraryEncoder(Encoder):
    """The tokenizers library, asked once for every distinct piece of text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.names = tuple(t.content for t in self.lib.get_added_tokens_decoder().values())
        vocab = self.lib.get_vocab()
        self.size = max(vocab.values()) + 1
        self.bytes = np.zeros(self.size, np.int64)  # of each token: its characters stand for bytes
        self.bytes[list(vocab.values())] = [len(t) for t in vocab]
        self.memo = Memo()

    def _ask(self, texts: list[str]) -> np.ndarray:
        got = [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), np.int64)

    def _joined(self, pieces: pa.Array, lead: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start and size of each piece's ids, is it certain?) of pieces that are joined, each
        behind ``lead``, to texts; tokens are told apart by their lengths in bytes."""
        data, cut = buffers(pc.binary_join_element_wise(pa.scalar(lead.decode()), pieces, "") if lead else pieces)
        data = data.tobytes()
        ids = self._ask([data[a:b].decode() for a, b in zip(cut[:-1:JOIN], [*cut[JOIN:-1:JOIN], cut[-1]])])
        ends = np.r_[0, np.cumsum(self.bytes[ids])]  # before each token, and at the end
        a, b = np.searchsorted(ends, cut[:-1] + len(lead)), np.searchsorted(ends, cut[1:])
        sure = (ends[-1] == cut[-1]) & (ends[np.minimum(a, len(ids))] == cut[:-1] + len(lead)) & (
            ends[np.minimum(b, len(ids))] == cut[1:])
        return ids, a, b - a, sure

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, cut = buffers(new)
        head, white = data[cut[:-1]], np.add.reduceat(white_starts(data).astype(np.int64), cut[:-1])
        plain = not any(" " in s for s in self.names)
        kinds = [(plain & (head == 32) & (white == 1) & (np.diff(cut) > 1), b""),  # a space and a word
                 (plain & SIGN[head] & (white == 0), b" a")]  # signs, which never join a letter before them
        start, size, pool = np.full(len(new), -1), np.zeros(len(new), np.int64), [np.zeros(0, np.int64)]
        for mask, lead in kinds:
            at = np.flatnonzero(mask)
            if len(at):
                ids, a, n, sure = self._joined(new.take(pa.array(at)), lead)
                start[at[sure]], size[at[sure]] = a[sure] + sum(map(len, pool)), n[sure]
                pool.append(ids)
        rest = np.flatnonzero(start < 0)
        if len(rest):
            got = self.lib.encode_batch_fast(new.take(pa.array(rest)).to_pylist(), add_special_tokens=False)
            size[rest] = [len(e.ids) for e in got]
            start[rest] = np.cumsum(size[rest]) - size[rest] + sum(map(len, pool))
            pool.append(np.fromiter(chain.from_iterable(e.ids for e in got), np.int64))
        return gather(np.concatenate(pool), start, size)[0], size


@lru_cache(maxsize=2)
def library(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def write_tokens(df: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Write the files and a manifest (also in ``folder``); returns the manifest: path,
    documents, ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library(tokenizer_path)
        kind = np.dtype("<u2") if enc.size <= 1 << 16 else np.dtype("<u4")
        out, uri, sizes, keys, nulls = None, "", [], [], 0
        for batch in slices(batches, "text", SLICE):
            if out is None:
                uri, out = files.create(folder, ".tok")
            ids, offsets = enc.encode(batch.column(1))
            stops = offsets[1:] + np.arange(1, len(offsets))  # with an end id for each
            body = np.full(int(offsets[-1]) + batch.num_rows, end_id, kind)
            keep = np.ones(len(body), bool)
            keep[stops - 1] = False
            body[keep] = ids
            out.write(body.tobytes())
            sizes.append(np.diff(np.r_[0, stops]))
            key = batch.column(0)
            nulls += key.null_count
            keys.append(np.asarray(key.fill_null(0)).astype("<i8"))
        enc.memo.clear()  # a worker lives on after its task
        if out is None:
            return
        ends = np.cumsum(np.concatenate(sizes))
        ef = EliasFano.build(ends)
        for part in (*keys, ef.low, ef.high, ef.samples):
            out.write(part.tobytes())
        out.write(struct.pack(FOOTER, MAGIC, ef.n, nulls, int(ends[-1]), kind.itemsize, ef.bits, len(ef.high),
                               len(ef.samples)))
        out.close()
        yield pa.RecordBatch.from_pydict({"path": [uri], "docs": [ef.n], "ids": [int(ends[-1])]})

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # equal ids are split by their text, so that no key is too large for one file
    dealt = src.withColumn("tie", F.xxhash64("text"))
    dealt = dealt.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    listed = map_arrow(dealt, run, "path string, docs long, ids long")
    listed.write.parquet(f"{folder}/manifest")
    return df.sparkSession.read.schema(listed.schema).parquet(f"{folder}/manifest")


class TokenFile:
    """One file: document ids, boundaries by select, ids of any range."""

    def __init__(self, uri: str):
        self.file = files.open_random(uri)
        size = self.file.size()
        self.file.seek(size - struct.calcsize(FOOTER))
        magic, n, self.nulls, total, width, bits, words, samples = struct.unpack(FOOTER, self.file.read(struct.calcsize(FOOTER)))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        self.docs, self.kind = n, np.dtype(f"<u{width}")
        self.file.seek(total * width)
        self.keys = self._read(n, "<i8")
        low = self._read((n * bits + 7) // 8, "u1")
        self.ends = EliasFano(n, bits, low, self._read(words, "<u8"), self._read(samples, "<u4"))

    def _read(self, n: int, kind) -> np.ndarray:
        return np.frombuffer(self.file.read(n * np.dtype(kind).itemsize), kind)

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def ids(self, start: int, stop: int) -> np.ndarray:
        self.file.seek(start * self.kind.itemsize)
        return self._read(stop - start, self.kind)


def _documents(f: TokenFile, first: int, block: int) -> Iterator[pa.RecordBatch]:
    """Rows of a file's documents, about ``block`` ids at a time; ``first`` ids are before it."""
    at = 0
    while at < f.docs:
        begin = f.span(at)[0]
        stop = max(at + 1, f.ends.upto(begin + block, at))
        ends = f.ends.part(at, stop)
        begins = np.r_[begin, ends[:-1]]
        ids = f.ids(begin, int(ends[-1])).astype("<u4").tobytes()
        a, b = 4 * (begins - begin), 4 * (ends - begin)
        crc = [zlib.crc32(memoryview(ids)[x:y]) for x, y in zip(a.tolist(), b.tolist())]
        mask = np.arange(at, stop) < f.nulls
        yield pa.RecordBatch.from_arrays(
            [pa.array(f.keys[at:stop], pa.int64(), mask=mask), pa.array(begins + first),
             pa.array((b - a) // 4), pa.array(crc, pa.int64())], ["id", "start", "n_tokens", "crc"])
        at = stop


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: id, start (ids of all documents before
    it), n_tokens (end id included), crc (of the ids as 32-bit little endian)."""
    spark = manifest.sparkSession
    # one row a file, as many as the write had tasks
    listed, rows, before = sorted(manifest.collect(), key=lambda r: r.path.rpartition("/")[2]), [], 0
    for r in listed:
        rows.append((r.path, before))
        before += r.ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(*(c.to_pylist() for c in batch.columns)):
                yield from _documents(TokenFile(path), first, BLOCK)

    schema = "id long, start long, n_tokens long, crc long"
    src = spark.createDataFrame(rows, "path string, first long").repartition(max(1, len(rows)))
    return map_arrow(src, run, schema)


def token_files(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``df`` as token files in a (new) shared folder and read them back."""
    folder = folder or scratch(df.sparkSession, "tokens")
    manifest = write_tokens(df, tokenizer_path, folder, id_col, text_col, end_id)
    return read_tokens(manifest).withColumnRenamed("id", id_col)
