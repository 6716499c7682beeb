"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

Every piece of text is a row of symbols. The leaves of its tree hold, for each
symbol, the rank of the pair it forms with its right neighbour and its place in
one integer, so the smallest of a node is the leftmost pair of lowest rank and
the root yields the next merge. A merge changes three leaves and the nodes above
them, one level after another, and merging goes on until the root holds no
pair. Trees of equal size are rows of one array and work in step.

Texts are cut where the split pattern certainly cuts, before single spaces and
around single line feeds, and the ids of the resulting pieces are kept per worker
up to a bound, so repeated words are merged once.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from obsflow.llm.blocks import shipped
from obsflow.llm.words import buffers, cuts

#: Fixed value: the split pattern of the byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT_PIECES = 150_000
BATCH_BYTES = 1 << 20
_NONE = np.iinfo(np.int64).max


def byte_symbols():
    """The character that stands for each byte: itself if printable, else the next unused one from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        symbols = byte_symbols()
        back = {c: b for b, c in enumerate(symbols)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.of_byte = np.array([ids[c] for c in symbols], dtype=np.int64)
        size = max([*ids.values(), *self.special.values()]) + 1
        self.text = [b""] * size
        for token, i in ids.items():
            self.text[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.text[i] = token.encode()
        pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
        key = np.array([(ids[a] << 32) | ids[b] for a, b in pairs], dtype=np.int64)
        self._order = np.argsort(key)
        self._pairs = key[self._order]
        self.merged = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        self._specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._split = regex.compile(SPLIT)
        self._known = {}

    def ranks(self, left, right):
        """Merge rank of each pair of symbols, ``_NONE`` where there is none or a side is missing (-1)."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where((left >= 0) & (right >= 0) & (self._pairs[at] == key), self._order[at], _NONE)

    def merge(self, pieces):
        """Ids of each piece (bytes), by segment trees that work in step."""
        out = [b""] * len(pieces)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        level = np.array([max(int(n) - 1, 1).bit_length() for n in sizes], dtype=np.int64)
        for height in np.unique(level):
            # Few rows at a time of tall trees: memory stays at some megabytes.
            rows = np.flatnonzero((level == height) & (sizes > 0))
            step = max(1, (1 << 18) >> int(height))
            for lo in range(0, len(rows), step):
                own = rows[lo : lo + step]
                for i, ids in zip(own, self._merge([pieces[i] for i in own], sizes[own], 1 << int(height))):
                    out[i] = ids
        return out

    def _merge(self, pieces, sizes, width):
        n = len(pieces)
        column = np.arange(width)
        there = column < sizes[:, None]
        symbol = np.full((n, width + 1), -1, dtype=np.int64)
        symbol[:, :width][there] = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        follow = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
        follow[np.arange(n), sizes - 1] = width
        before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
        rank = self.ranks(symbol[:, :-1], symbol[:, 1:])
        tree = np.full((n, 2 * width), _NONE, dtype=np.int64)
        tree[:, width:] = np.where(rank == _NONE, _NONE, rank * width + column)
        for node in range(width - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        active = np.flatnonzero(tree[:, 1] != _NONE) if width > 1 else np.zeros(0, np.int64)
        while len(active):
            root = tree[active, 1]
            here = root % width
            gone = follow[active, here]
            after = follow[active, gone]
            prior = before[active, here]
            symbol[active, here] = self.merged[root // width]
            symbol[active, gone] = -1
            follow[active, here] = after
            before[active, after] = here
            rank = self.ranks(symbol[active, here], np.where(after < width, symbol[active, np.minimum(after, width)], -1))
            tree[active, width + here] = np.where(rank == _NONE, _NONE, rank * width + here)
            tree[active, width + gone] = _NONE
            has = prior >= 0
            rank = self.ranks(np.where(has, symbol[active, prior], -1), symbol[active, here])
            leaf = np.where(has, prior, gone)
            tree[active, width + leaf] = np.where(has & (rank != _NONE), rank * width + leaf, _NONE)
            for leaf in (here, gone, leaf):
                node = (width + leaf) >> 1
                while node[0]:
                    tree[active, node] = np.minimum(tree[active, 2 * node], tree[active, 2 * node + 1])
                    node >>= 1
            active = active[tree[active, 1] != _NONE]
        ids = symbol[:, :width]
        kept = ids >= 0
        flat = ids[kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(axis=1)) * 4
        return [flat[i:j] for i, j in zip(np.concatenate([[0], ends[:-1]]), ends)]

    def encode(self, texts):
        """Ids of each text as little-endian unsigned 32-bit integers; special tokens in a text count as such."""
        parts = []
        for text in texts:
            own = self._specials.split(text) if self._specials else [text]
            parts.append([x if x in self.special else self._split.findall(x) for x in own])
        fresh = {p for own in parts for x in own if isinstance(x, list) for p in x}.difference(self._known)
        if fresh:
            if len(self._known) > KEPT_PIECES:
                self._known.clear()
                fresh = {p for own in parts for x in own if isinstance(x, list) for p in x}
            fresh = list(fresh)
            self._known.update(zip(fresh, self.merge([p.encode() for p in fresh])))
        get = self._known.__getitem__
        return [
            b"".join(b"".join(map(get, x)) if isinstance(x, list) else self.special[x].to_bytes(4, "little") for x in own)
            for own in parts
        ]

    def decode(self, ids):
        """The text of ids packed as by ``encode``; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.text.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


class Pieces:
    """Encodes texts piece by piece, and every distinct piece once while it is remembered.

    A piece is a word with the single space before it, or a word that begins a
    line. ``encode`` maps a list of texts to their packed ids. What was not met
    since the memory last filled is forgotten when it fills again.
    """

    def __init__(self, encode):
        self._encode = encode
        self._known = {"": {}, " ": {}}
        self._before = {"": {}, " ": {}}
        self._feed = encode(["\n"])[0]

    def _learn(self, lead, words):
        known, before = self._known[lead], self._before[lead]
        fresh = words.difference(known)
        known.update((w, before[w]) for w in fresh if w in before)
        # A piece must not begin or end with white space: its neighbours could join it.
        fresh = [w for w in fresh if w and w not in known and not w[0].isspace() and not w[-1].isspace()]
        for lo in range(0, len(fresh), 20_000):
            own = fresh[lo : lo + 20_000]
            known.update(zip(own, self._encode([lead + w for w in own])))

    def __call__(self, texts):
        """Packed ids of each text."""
        if sum(map(len, self._known.values())) > KEPT_PIECES:
            self._before, self._known = self._known, {"": {}, " ": {}}
        lines = [[line.split(" ") for line in text.split("\n")] for text in texts]
        self._learn("", {x[0] for own in lines for x in own})
        self._learn(" ", set(chain.from_iterable(x[1:] for own in lines for x in own)))
        bare, spaced = self._known[""].__getitem__, self._known[" "].__getitem__
        out = []
        for text, own in zip(texts, lines):
            try:
                out.append(self._feed.join([bare(x[0]) + b"".join(map(spaced, x[1:])) for x in own]))
            except KeyError:  # white space other than single spaces and line feeds
                out.append(self._encode([text])[0])
        return out


@lru_cache(maxsize=4)
def vocabulary(path):
    """The vocabulary of a file, once per worker."""
    return Vocabulary(path)


@lru_cache(maxsize=4)
def _pieces(path):
    return Pieces(vocabulary(path).encode)


def texts_of(column):
    """Texts of a column in lists of a few megabytes; null is empty."""
    if not len(column):
        return
    data, offsets = buffers(column)
    for lo, hi in cuts(offsets, BATCH_BYTES):
        at = (offsets[lo : hi + 1] - offsets[lo]).tolist()
        own = data[offsets[lo] : offsets[hi]].tobytes()
        yield [own[i:j].decode() for i, j in zip(at[:-1], at[1:])]


def _added(batches, source, name, kind, make):
    for b in batches:
        values = [x for own in make(b.column(source)) for x in own]
        names = [n for n in b.schema.names if n != name]
        yield pa.record_batch([*(b.column(n) for n in names), pa.array(values, type=kind)], names=[*names, name])


def _fields(df, but):
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != but)


def bpe_encode(df, path, text="text", ids="_ids"):
    """``df`` with ``ids``: the token ids of ``text``, little-endian unsigned 32-bit integers in a binary.

    Null and empty texts have no ids. Strings of special tokens in a text count
    as special tokens. Other columns stay; one named like ``ids`` is replaced.
    ``path`` names a vocabulary file that every executor can read.
    """
    shipped(df.sparkSession)

    def run(batches):
        encode = _pieces(path)
        return _added(batches, text, ids, pa.binary(), lambda c: (encode(own) for own in texts_of(c)))

    return df.mapInArrow(run, f"{_fields(df, ids)}, `{ids}` binary")


def bpe_decode(df, path, ids="_ids", text="_decoded"):
    """``df`` with ``text``: what packed ``ids`` stand for, special tokens included; null ids give an empty text."""
    shipped(df.sparkSession)

    def run(batches):
        decode = vocabulary(path).decode
        return _added(batches, ids, text, pa.string(), lambda c: [[decode(x or b"") for x in c.to_pylist()]])

    return df.mapInArrow(run, f"{_fields(df, text)}, `{text}` string")
