"""Cutting a column of texts into pieces that a byte-level BPE with the usual word pattern
tokenises independently of each other.

Places of cuts, found on the bytes of the whole column at once:

- right before a space, because the pattern joins a space only with what follows it; but not
  inside a run of white space (white space before the space, and white space or the text's end
  behind it), which the pattern takes as a whole;
- between an ASCII letter and an ASCII sign, which never share a token;
- around the strings of special tokens, which tokenizers take out of the text first.

The pieces are dictionary-encoded, so only distinct ones are ever looked at one by one, and those
of earlier slices are known again by encoding them together with the new ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# fixed values: the characters of Unicode White_Space
WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_WIDE = [c.encode() for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))]
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
SIGN = np.zeros(256, bool)
SIGN[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True


def _white(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that end a white-space character, and bytes that start one."""
    ends = _WHITE[data]
    starts = ends
    lead = np.isin(data, [0xC2, 0xE1, 0xE2, 0xE3]) if data.size and data.max() > 127 else np.zeros(0, bool)
    at = np.flatnonzero(lead)
    if len(at):
        ends, starts = ends.copy(), ends.copy()
        for c in _WIDE:
            here = at[at + len(c) <= len(data)]
            for i, b in enumerate(c):
                here = here[data[here + i] == b]
            starts[here] = True
            ends[here + len(c) - 1] = True
    return ends, starts


def white_starts(data: np.ndarray) -> np.ndarray:
    return _white(data)[1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a column of texts; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    cut = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[cut[0]:cut[-1]], cut - cut[0]


def special_spans(column: pa.Array, cut: np.ndarray, specials: tuple[str, ...]) -> np.ndarray:
    """(start, stop) of every special token's string, longest first where several fit."""
    hit = np.zeros(len(column), bool)
    for s in specials:
        hit |= np.asarray(pc.fill_null(pc.match_substring(column, s), False)).astype(bool)
    if not hit.any():
        return np.zeros((0, 2), np.int64)
    find = regex.compile(b"|".join(regex.escape(s.encode()) for s in sorted(specials, key=len, reverse=True)))
    return np.array([(cut[i] + m.start(), cut[i] + m.end()) for i in np.flatnonzero(hit).tolist()
                     for m in find.finditer(column[i].as_py().encode())], np.int64).reshape(-1, 2)


def cut_pieces(column: pa.Array, specials: tuple[str, ...] = ()) -> tuple[pa.Array, np.ndarray]:
    """(pieces of all texts, first piece of each text and the number of pieces)."""
    data, cut = buffers(column)
    ends, starts = _white(data)
    edge = np.zeros(len(data) + 1, bool)  # where a text, or what lies between special tokens, starts or stops
    edge[cut] = True
    spans = special_spans(column, cut, specials)
    edge[spans.ravel()] = True
    before = np.r_[False, ends[:-1]] & ~edge[:-1]
    behind = np.r_[starts[1:], True] | edge[1:]
    at = (data == 32) & ~(before & behind)
    at[1:] |= _LETTER[data[:-1]] & SIGN[data[1:]]
    for a, b in spans.tolist():
        at[a + 1:b] = False
    at |= edge[:-1]
    place = np.flatnonzero(at)
    offsets = np.r_[place, len(data)].astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(place), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    return pieces, np.searchsorted(place, cut)


class Memo:
    """Ids of distinct pieces: Arrow strings and flat numpy arrays, no Python objects."""

    #: bytes of the pieces and ids kept from slice to slice
    LIMIT = 24 << 20

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.names = pa.array([], pa.string())
        self.start, self.ids = np.zeros(1, np.int32), np.zeros(0, np.int32)

    def lookup(self, pieces: pa.Array, learn) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code of each piece, starts of the codes in ids, ids).  ``learn`` gives (ids, sizes) of
        distinct pieces that are new."""
        both = pa.concat_arrays([self.names, pieces]).dictionary_encode()
        code = np.asarray(both.indices)[len(self.names):]
        new = both.dictionary.slice(len(self.names))
        if len(new):
            ids, sizes = learn(new)
            self.start = np.r_[self.start, self.start[-1] + np.cumsum(sizes, dtype=np.int32)]
            self.ids = np.r_[self.ids, ids.astype(np.int32)]
        self.names = both.dictionary
        found = code, self.start, self.ids
        if self.names.nbytes + 4 * (len(self.start) + len(self.ids)) > self.LIMIT:
            self._shrink(code)
        return found

    def _shrink(self, code: np.ndarray) -> None:
        """Keep what the last slice had, if that is within half the limit."""
        used = np.unique(code)
        names = self.names.take(pa.array(used))
        ids, ends = gather(self.ids, self.start[used], self.start[used + 1] - self.start[used])
        if names.nbytes + 4 * (len(used) + len(ids)) > self.LIMIT // 2:
            return self.clear()
        self.names, self.start, self.ids = names, np.r_[0, ends].astype(np.int32), ids


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate data[start:start + size] of every pair; also the running ends."""
    ends = np.cumsum(size, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(start - (ends - size), size) + np.arange(total)
    return data[at], ends
