"""Words of Arrow text columns as numpy arrays: bounds, hashes of words and of runs of words.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D, which is the
same as ``[^\\x20\\x09-\\x0D]+`` over characters, since UTF-8 never uses those
bytes inside a longer character. Texts are worked on in slices of a few
megabytes, so memory follows the slice or the longest document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
#: Bytes that words are hashed over at a time: the numbers of so many stay in a core's cache.
HASH_BYTES = 1 << 16

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but ASCII letters and the bytes of longer characters.
NO_LETTER = np.ones(256, dtype=bool)
NO_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_power = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def mix(x, salt=0):
    """Spread 64-bit values (a bijection for each salt)."""
    x = x ^ np.uint64((salt * 0xD1B54A32D192ED03) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64), 7)


def powers(n, down=False):
    """The first ``n`` powers of the base modulo 2**64, or of its inverse."""
    name, base = ("down", _INVERSE) if down else ("up", _BASE)
    if len(_power[name]) < n:
        steps = np.full(1 << max(n - 1, 1).bit_length(), base, dtype=np.uint64)
        steps[0] = 1
        _power[name] = np.multiply.accumulate(steps)
    return _power[name][:n]


def prefix_hashes(values):
    """``p[i]``: polynomial hash of the first ``i`` values, modulo 2**64."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.multiply(values, powers(len(values)), out=out[1:])
    np.cumsum(out[1:], out=out[1:])
    return out


def span_hashes(prefix, start, end):
    """Hashes of spans that do not depend on where a span stands."""
    return (prefix[end] - prefix[start]) * powers(len(prefix), down=True)[start]


def byte_hashes(data, start, end):
    """``span_hashes`` of spans of bytes that follow each other, without the prefixes of all bytes at once."""
    out = np.empty(len(start), dtype=np.uint64)
    for lo, hi in cuts(np.append(start, len(data)), HASH_BYTES):
        begin = start[lo]
        own = data[begin : end[hi - 1]]
        prefix = prefix_hashes(np.take(_BYTE, own, out=np.empty(len(own), dtype=np.uint64), mode="clip"))
        out[lo:hi] = span_hashes(prefix, start[lo:hi] - begin, end[lo:hi] - begin)
    return out


@dataclass
class Slice:
    """Some documents of a column. ``lo``: row of the first in its batch. ``start``, ``end``: bounds of
    words in ``data``; ``first[d]:first[d + 1]`` are the words of document d; ``doc``: document of a word."""

    lo: int
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    doc: np.ndarray

    @property
    def n_docs(self):
        return len(self.offsets) - 1

    @property
    def n_words(self):
        return np.diff(self.first)

    def word_hashes(self, held=None):
        """64-bit hash of every word, or of the words at ``held`` (ascending)."""
        start, end = (self.start, self.end) if held is None else (self.start[held], self.end[held])
        return mix(byte_hashes(self.data, start, end) + (end - start).astype(np.uint64))

    def run_hashes(self, words, k):
        """Hash of every ``k`` consecutive words, also across documents; see ``inside``."""
        if len(words) < k:
            return np.zeros(0, dtype=np.uint64)
        prefix = prefix_hashes(words)
        at = np.arange(len(words) - k + 1)
        return mix(span_hashes(prefix, at, at + k), k)

    def inside(self, k):
        """Positions whose next ``k`` words belong to one document."""
        at = np.arange(max(len(self.doc) - k + 1, 0))
        return at[self.first[self.doc[at] + 1] - at >= k]


def buffers(column):
    """Bytes and offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def cuts(offsets, limit):
    """Row ranges of about ``limit`` bytes, at least one row each."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def slices(column, lower=False, limit=SLICE_BYTES, gaps=_SPACE):
    """The column as slices with the bounds of their words; ``lower``: A-Z become a-z; ``gaps``: bytes between words."""
    if not len(column):
        return
    data, offsets = buffers(column)
    for lo, hi in cuts(offsets, limit):
        own = data[offsets[lo] : offsets[hi]]
        own = _LOWER[own] if lower else own
        at = offsets[lo : hi + 1] - offsets[lo]
        word = np.zeros(len(own) + 2, dtype=bool)
        if gaps is _SPACE:  # the same by two comparisons, which take a tenth of the time
            np.logical_and(own != 0x20, own - np.uint8(0x09) > 4, out=word[1:-1])
        else:
            np.logical_not(gaps[own], out=word[1:-1])
        # Words begin and end where the kind of byte changes, and at a bound of documents between two of their bytes.
        edges = np.flatnonzero(word[1:] != word[:-1])
        inner = np.unique(at[1:-1])
        inner = np.repeat(inner[word[inner] & word[inner + 1]], 2)
        edges = np.insert(edges, np.searchsorted(edges, inner), inner).reshape(-1, 2)
        start, end = np.ascontiguousarray(edges[:, 0]), np.ascontiguousarray(edges[:, 1])
        first = np.searchsorted(start, at)
        doc = np.repeat(np.arange(hi - lo), np.diff(first))
        yield Slice(lo, own, at, start, end, first, doc)


def strings(part, gaps=_SPACE):
    """The words of a slice as an Arrow dictionary array; ``gaps`` as the slice was made with."""
    letters = part.data[~gaps[part.data]]
    ends = np.zeros(len(part.start) + 1, dtype=np.int32)
    np.cumsum(part.end - part.start, out=ends[1:])
    return pa.StringArray.from_buffers(len(part.start), pa.py_buffer(ends), pa.py_buffer(letters)).dictionary_encode()
