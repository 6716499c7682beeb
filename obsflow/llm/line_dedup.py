"""Line dedup as an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity, over the lines of all
documents, and two sets of a similarity of t share a word among the first
n - ceil(t n) + 1 of either, so lines meet in the groups of their rarest words
only. Within a group a pair is dropped if the lengths are too far apart, if
the words left after the shared one are too few, or if parity bitmaps of the
sets differ in more bits than the sets may; what is left is verified on the sets.
A line is removed if an earlier one is similar, judged on the input.

Rarity is read from a table of counters of fixed size that the words of all lines
are hashed into: any order that is the same everywhere keeps the join exact.
Equal lines are settled first, by name, and then one stands for all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from obsflow.llm.blocks import (
    batch,
    block_of,
    but,
    changes,
    deal,
    in_small_batches,
    loosen,
    n_blocks,
    pack,
    ranges,
    squeeze,
    unpack,
    with_keys,
    without_keys,
    written,
)
from obsflow.llm.words import mix, slices
from obsflow.session import materialise

PERCENT = 80
#: Counters of the rarity table (1 MB in all), whatever the number of words.
COUNTERS = 1 << 18
#: Counters that travel in one row.
SHARE = 1 << 10
#: Bytes worked on at a time where nothing is packed by block: their numbers need no fresh memory each time.
SLICE = 1 << 20
#: Earlier partners of a line that one group names; groups with more are finished exactly in a second step.
NAMED = 2
#: Lines of a group that meet in one task; parts of larger groups meet in pairs.
PART = 2048
#: Lines asked for go to the texts up to so many bytes of files; beyond that texts are joined by key.
BROADCAST = 4 << 20
#: Lines of so many words have a bitmap of 256 bits as well: 64 say little about them.
LONG = 90


def line_bounds(part):
    """Lines of a slice: first byte, document and number within it, and the first word of each."""
    feeds = np.flatnonzero(part.data == 0x0A) + 1
    at = np.unique(np.concatenate([part.offsets[:-1], feeds[feeds < len(part.data)]]))
    at = at[at < len(part.data)] if len(part.data) else at[:0]
    doc = np.searchsorted(part.offsets, at, side="right") - 1
    number = np.arange(len(at)) - np.searchsorted(doc, doc)
    return at, doc, number, np.searchsorted(part.start, np.append(at, len(part.data)))


def _line_sets(part, asked=None, rank=None):
    """Distinct words of each line (hashes, sorted within a line), their line, and the bounds of lines.

    ``asked`` gives the numbers of the lines wanted of a document; other lines then have no words.
    With ``rank`` the words of a line are sorted as in ``_by_rarity``, which takes no more time.
    """
    at, doc, number, first = line_bounds(part)
    line = np.repeat(np.arange(len(at)), np.diff(first))
    if asked is None:
        words = part.word_hashes()
    else:
        chosen, begin = np.zeros(len(at), dtype=bool), np.searchsorted(doc, np.arange(part.n_docs + 1))
        for d in range(part.n_docs):
            numbers = np.asarray(asked(d), dtype=np.int64)
            chosen[begin[d] + numbers[numbers < begin[d + 1] - begin[d]]] = True
        held = np.flatnonzero(chosen[line])
        words, line = part.word_hashes(held), line[held]
    words = words[_by_rarity(words, line, rank)]
    new = changes(line, words)
    return words[new], line[new], doc, number


def _names(words, line, n):
    """128 bits that name the set of words of each of ``n`` lines, whatever their order."""
    out = np.zeros((n, 2), dtype=np.uint64)
    begin = np.flatnonzero(changes(line))
    for i in (0, 1):
        if len(begin):
            out[line[begin], i] = np.add.reduceat(mix(words, 71 + i), begin)
        out[:, i] = mix(out[:, i], 75)
    return out


def _slot(words):
    return (words >> np.uint64(46)).astype(np.int64)


def _count(batches):
    """Task side: counters of the words of all lines of a partition, packed ``SHARE`` to a row, where not all zero."""
    total = np.zeros(COUNTERS, dtype=np.int64)
    for b in batches:
        for part in slices(b.column("text"), limit=SLICE):
            total += np.bincount(_slot(part.word_hashes()), minlength=COUNTERS)
    rows = [(i, _small(x)) for i, x in enumerate(total.reshape(-1, SHARE)) if x.any()]
    yield batch(_COUNTS, rows)


def _add_up(key, table):
    """Group side: the sums of one share of the counters."""
    total = np.zeros(SHARE, dtype=np.int64)
    for x in table.column("n"):
        total += _large(x.as_py())
    return pa.table([key, [pack(total)]], schema=_COUNTS)


def rarity(docs):
    """How often words of each counter occur in all documents: an array of ``COUNTERS``."""
    counted = docs.select("text").mapInArrow(_count, _COUNTS_DDL).groupBy("share").applyInArrow(_add_up, _COUNTS_DDL)
    out = np.zeros((COUNTERS // SHARE, SHARE), dtype=np.int64)
    for row in counted.collect():  # at most COUNTERS numbers
        out[row["share"]] = unpack(row["n"], np.int64)
    return out.ravel()


def wide_bitmaps(words, line, chosen):
    """Parity of a 256-bit sketch for each chosen set (ascending), as rows of four 64-bit numbers.

    The four numbers of a row XORed are the set's bitmap of 64 bits.
    """
    at = np.full(max(line.max(initial=-1), chosen.max(initial=-1)) + 1, -1)
    at[chosen] = np.arange(len(chosen))
    at = at[line]
    held = np.flatnonzero(at >= 0)
    out = np.zeros(4 * len(chosen), dtype=np.uint64)
    bit = mix(words[held], 61)
    np.bitwise_xor.at(out, at[held] * 4 + (bit >> np.uint64(62)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out.reshape(-1, 4)


def bitmaps(words, line, n):
    """Parity of a 64-bit sketch for each of ``n`` sets."""
    out = np.zeros(n, dtype=np.uint64)
    begin = np.flatnonzero(changes(line))
    if len(begin):
        out[line[begin]] = np.bitwise_xor.reduceat(np.uint64(1) << (mix(words, 61) & np.uint64(63)), begin)
    return out


def _small(values):
    """Numbers from 0 in the narrowest type, as bytes after one byte that names its width."""
    largest = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if largest < 1 << 8 * w)
    return bytes([width]) + pack(values.astype(f"u{width}"))


def _large(value):
    """What ``_small`` packed."""
    return np.frombuffer(value, dtype=f"u{value[0]}", offset=1).astype(np.int32 if value[0] < 4 else np.int64)


_COUNTS = pa.schema([("share", pa.int32()), ("n", pa.binary())])
_COUNTS_DDL = "share int, n binary"
_NAMES, _GONE, _WORDS = 0, 1, 2
_ROWS = pa.schema(
    [("block", pa.int32()), ("kind", pa.int32())]
    + [(c, pa.binary()) for c in ("k", "doc", "line", "key", "name", "bits", "size", "place", "wide")]
)
_ROWS_DDL = "block int, kind int, " + ", ".join(f"{c} binary" for c in ("k", "doc", "line", "key", "name", "bits", "size", "place", "wide"))
#: The place of a line: id of its document, number, and name, which tells apart rows that share an id.
_LINE = ["k", "line", "name"]
_FIRST = ["k0", "line0", "name0"]
_PLACE = [("k", pa.int64()), ("line", pa.int32()), ("name", pa.int64())]
_PLACE_DDL = "k long, line int, name long"
_FOUND_DDL = f"kind int, key long, {_PLACE_DDL}, k0 long, line0 int, name0 long, members binary"
_FOUND = pa.schema([("kind", pa.int32()), ("key", pa.int64()), *_PLACE, *((f"{c}0", kind) for c, kind in _PLACE), ("members", pa.binary())])
_GROUP = [("key", pa.int64()), ("part", pa.int32()), ("part0", pa.int32())]
_WANTED_DDL = f"key long, part int, part0 int, {_PLACE_DDL}, unsettled boolean"
_SETS_DDL = f"{_PLACE_DDL}, elements binary"
_PAIR, _OPEN, _MEMBER = 2, 3, 4


def _by_rarity(words, line, rank=None):
    """An order of the words (lines ascending) by line, rank of their counter, and word; of equal ones the first comes first.

    Without ``rank`` by line and word.
    """
    if not len(words):
        return np.zeros(0, np.int64)
    slot = _slot(words) if rank is None else rank[_slot(words)]
    above, below = int(line[-1]).bit_length(), (len(words) - 1).bit_length()
    rest = 46 - above - below
    if rest > 0:
        # One number to sort by: line, rank (18 bits), of the word below its counter what fits, and where it stands.
        # Numbers sort in a third of the time that an order of them takes.
        both = ((words << np.uint64(18)) >> np.uint64(64 - rest) << np.uint64(below)) | np.arange(len(words), dtype=np.uint64)
        both |= slot.astype(np.uint64) << np.uint64(rest + below)
        both |= line.astype(np.uint64) << np.uint64(64 - above) if above else np.uint64(0)
        both.sort()
        order = (both & np.uint64((1 << below) - 1)).astype(np.int64)
        both >>= np.uint64(below)
        same = np.flatnonzero(both[1:] == both[:-1])
        if (words[order[same]] == words[order[same + 1]]).all():
            return order
    return np.lexsort((words, slot, line))  # what did not fit decides


def _post(counts, percent, blocks):
    """Task side: names of lines and postings of their rarest words, packed by block."""
    rank = np.argsort(np.argsort(counts, kind="stable")).astype(np.uint32)

    def run(batches):
        for b in batches:
            ids = b.column("_k").to_numpy(zero_copy_only=False)
            for part in slices(b.column("text")):
                words, line, doc, number = _line_sets(part, rank=rank)
                sizes = np.bincount(line, minlength=len(doc))
                names = _names(words, line, len(doc))
                k = ids[part.lo + doc]
                some = np.flatnonzero(sizes)
                order = some[np.lexsort((number[some], k[some], names[some, 1], names[some, 0]))]
                new = changes(names[order, 0], names[order, 1])
                place = changes(k[order], number[order])
                first, again = np.sort(order[new]), np.sort(order[~new & place])

                def rows_of(kind, where, lines, **more):
                    for block, chosen in deal(where):
                        own = lines[chosen]  # ascending, as ``lines`` are
                        new = changes(doc[own])
                        held, back = doc[own[new]], np.cumsum(new) - 1
                        row = dict.fromkeys(("key", "name", "bits", "size", "place", "wide"))
                        row |= {c: pack(v[chosen]) for c, v in more.items()}
                        if kind == _WORDS:
                            short = sizes[own] < LONG
                            row["bits"] = pack(bits[own[short]])
                            row["wide"] = pack(wide[np.searchsorted(long, own[~short])])
                            row["size"], row["place"] = _small(sizes[own]), _small(position[chosen])
                        yield (
                            block,
                            kind,
                            pack(np.diff(ids[part.lo + held], prepend=0)),
                            _small(np.diff(back, prepend=0)),
                            _small(number[own]),
                            *row.values(),
                        )

                rows = [*rows_of(_NAMES, block_of(names[first, 0], blocks), first, name=names[first])]
                spread = mix(mix(k[again].astype(np.uint64)) ^ number[again].astype(np.uint64))
                rows += rows_of(_GONE, block_of(spread, blocks), again, name=names[again, 1])
                # The rarest words of lines that can have a partner of another name.
                sizes_first = np.zeros(len(doc), dtype=np.int64)
                sizes_first[first] = sizes[first]
                partners = (100 * (sizes_first - 1) >= percent * sizes_first) | (100 * sizes_first >= percent * (sizes_first + 1))
                length = np.where(partners & (sizes_first > 0), sizes_first - (percent * sizes_first + 99) // 100 + 1, 0)
                position = np.arange(len(line)) - (np.cumsum(sizes) - sizes)[line]
                held = np.flatnonzero(position < length[line])
                own_words, own_line, position = words[held], line[held], position[held]
                short = np.flatnonzero((sizes < LONG)[line])
                bits = bitmaps(words[short], line[short], len(doc))
                long = np.unique(own_line[sizes[own_line] >= LONG])
                wide = wide_bitmaps(words, line, long)
                # Half of a hash of the word: words that share it only meet more often than they must.
                key = own_words.astype(np.uint32)
                rows += rows_of(_WORDS, block_of(mix(own_words, 81), blocks), own_line, key=key, name=names[own_line, 1])
                yield batch(_ROWS, rows)

    return run


def _needed(x, y, percent):
    """How many common words a similarity of ``percent`` takes, for sets of ``x`` and ``y`` words."""
    return -(-percent * (x + y) // (100 + percent))


def _may_match(own, late, other, early, percent):
    """Which pairs of postings (rows of two tables) of one word pass the filters of length, position and bitmaps.

    A similar pair passes in the group of the first word, by rarity, that both lines have, if in no other.
    """
    x, y = own["size"][late].astype(np.int64), other["size"][early].astype(np.int64)
    # Common words all stand behind the first of them, and in its group the pair meets as well.
    room = np.minimum(x - own["place"][late], y - other["place"][early])
    good = np.flatnonzero((100 + percent) * room >= percent * (x + y))  # that there is room says the lengths are near
    good = good[own["name"][late[good]] != other["name"][early[good]]]
    out = np.zeros(len(late), dtype=bool)
    late, early, x, y = late[good], early[good], x[good], y[good]
    need = _needed(x, y, percent)
    apart = np.bitwise_count(own["bits"][late] ^ other["bits"][early]).astype(np.int64)
    # Bits that differ are words that are not common, in either bitmap.
    both = np.flatnonzero((x >= LONG) & (y >= LONG))
    wider = np.bitwise_count(own["wide"][late[both]] ^ other["wide"][early[both]]).sum(axis=1, dtype=np.int64)
    apart[both] = np.maximum(apart[both], wider)
    out[good] = apart <= x + y - 2 * need
    return out


#: How the postings of a part of a group are laid out in a row.
_HELD = [("k", np.int64), ("name", np.int64), ("bits", np.uint64), ("wide", np.uint64), ("line", np.int32), ("size", np.int32), ("place", np.int32)]


def _hold(own, rows):
    """Postings as bytes."""
    return pack(np.array([len(rows)])) + b"".join(pack(own[c][rows].astype(kind)) for c, kind in _HELD)


def _held(value):
    """What ``_hold`` packed."""
    n, at, out = int(np.frombuffer(value, np.int64, 1)[0]), 8, {}
    for c, kind in _HELD:
        count = n * (4 if c == "wide" else 1)
        out[c] = np.frombuffer(value, kind, count, at)
        at += out[c].nbytes
    out["wide"] = out["wide"].reshape(n, 4)
    return out


def _in_order(own):
    """An order of postings by key, document, number and name."""
    k, line = own["k"], own["line"]
    if (int(k.max()) - int(k.min())).bit_length() + int(line.max()).bit_length() > 32:
        k = np.unique(k, return_inverse=True)[1]
    low, last = int(k.min()), int(line.max()).bit_length()
    if (int(k.max()) - low).bit_length() + last <= 32:
        both = (own["key"].astype(np.uint64) << np.uint64(32)) | ((k - low).astype(np.uint64) << np.uint64(last)) | line.astype(np.uint64)
        order = np.argsort(both)
        if changes(both[order]).all():
            return order
    return np.lexsort((own["name"], line, k, own["key"]))


def _repeated(own):
    """Postings whose key, name and place an earlier one has."""
    below = np.uint64((len(own["key"]) - 1).bit_length())
    both = mix(own["name"].view(np.uint64) ^ mix((own["key"].astype(np.uint64) << np.uint64(32)) | own["place"].astype(np.uint64)))
    both = (both >> below << below) | np.arange(len(both), dtype=np.uint64)
    both.sort()
    order = (both & np.uint64((1 << int(below)) - 1)).astype(np.int64)
    both >>= below
    same = np.flatnonzero(both[1:] == both[:-1])
    early, late = order[same], order[same + 1]
    columns = [own[c] for c in ("place", "name", "key")]
    if all((c[early] == c[late]).all() for c in columns):
        return late
    order = np.lexsort(columns)
    return order[~changes(*(c[order] for c in columns))]


def _meet(percent):
    """Block side: later copies of equal lines, and for every line earlier lines that pass the filters."""

    def run(key, table):
        out = {f.name: [] for f in _FOUND if f.name != "members"}
        groups = []

        def give(kind, keys, late, early=None):
            zero = np.zeros(len(late["k"]), np.int64)
            place = [late[c].astype(np.int64, copy=False).view(np.int64) for c in _LINE]
            other = [early[c].astype(np.int64, copy=False).view(np.int64) for c in _LINE] if early else [zero] * 3
            for c, v in zip(out, (zero + kind, zero if keys is None else keys, *place, *other)):
                out[c].append(v)

        def at(own, rows):
            return {c: own[c][rows] for c in _LINE}

        columns = {}
        for row in table.to_pylist():
            doc = np.cumsum(_large(row["doc"]), dtype=np.int64)
            own = {"k": np.cumsum(unpack(row["k"], np.int64))[doc], "line": _large(row["line"]).astype(np.int64)}
            if row["name"] is not None:
                own["name"] = unpack(row["name"], np.int64)
            if row["kind"] == _WORDS:
                own["key"] = unpack(row["key"], np.uint32)
                own["size"], own["place"] = _large(row["size"]), _large(row["place"])
                short = own["size"] < LONG
                wide = np.zeros((len(doc), 4), dtype=np.uint64)
                wide[~short] = unpack(row["wide"], np.uint64).reshape(-1, 4)
                own["bits"] = wide[:, 0] ^ wide[:, 1] ^ wide[:, 2] ^ wide[:, 3]
                own["bits"][short] = unpack(row["bits"], np.uint64)
                own["wide"] = wide
            for c, v in own.items():
                columns.setdefault(row["kind"], {}).setdefault(c, []).append(v)
        columns = {kind: {c: np.concatenate(v) for c, v in own.items()} for kind, own in columns.items()}
        if _GONE in columns:
            give(_GONE, None, columns[_GONE])
        if _NAMES in columns:
            own = columns[_NAMES]
            whole, own["name"] = own["name"].reshape(-1, 2), own["name"].reshape(-1, 2)[:, 1]
            order = np.lexsort((own["line"], own["k"], whole[:, 1], whole[:, 0]))
            new = changes(whole[order, 0], whole[order, 1])
            first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            later = order[(own["k"][order] != own["k"][first]) | (own["line"][order] != own["line"][first])]
            give(_GONE, None, at(own, later))
        if _WORDS in columns:
            own = columns[_WORDS]
            # One posting for each name and word: that of the first line of the name. Two words of
            # a line can share a key, but not their place.
            order = _in_order(own)
            order = np.delete(order, _repeated({c: own[c][order] for c in ("key", "name", "place")}))
            own = {c: v.take(order, axis=0) for c, v in own.items()}
            group = np.cumsum(changes(own["key"])) - 1
            start = np.flatnonzero(changes(own["key"]))
            size = np.diff(np.append(start, len(group)))
            rank = np.arange(len(group)) - start[group]
            named = np.zeros(len(group), dtype=np.int64)
            active = np.flatnonzero(rank)
            begin = start[group[active]]
            for step in range(PART):
                on = (active - begin > step) & (named[active] < NAMED)
                active, begin = active[on], begin[on]
                if not len(active):
                    break
                early = begin + step
                good = np.flatnonzero(_may_match(own, active, own, early, percent))
                late, early = active[good], early[good]
                named[late] += 1
                give(_PAIR, None, at(own, late), at(own, early))
            # A line named NAMED times, or behind PART lines of its group, may have more partners:
            # the parts of its group are kept for the second step.
            full = ((named >= NAMED) & (rank > NAMED)) | (rank > PART)
            if full.any():
                word = (key[0].as_py() << 32) + own["key"].astype(np.int64)
                give(_OPEN, word[full], at(own, full), {"k": rank[full], "line": rank[full] // PART, "name": rank[full]})
                for g in np.unique(group[full]):
                    for lo in range(start[g], start[g] + size[g], PART):
                        rows = np.arange(lo, min(lo + PART, start[g] + size[g]))
                        groups.append((int(word[lo]), (lo - start[g]) // PART, _hold(own, rows)))
        arrays = [pa.array(np.concatenate(v) if v else [], type=_FOUND.field(c).type) for c, v in out.items()]
        flat = pa.table([*arrays, pa.nulls(len(arrays[0]), pa.binary())], schema=_FOUND)
        # ``line`` of a part of a group is its number, as is ``line0`` of an open line that of its part.
        whole = {"kind": [_MEMBER] * len(groups)} | dict(zip(("key", "line", "members"), zip(*groups)))
        columns = [pa.array(whole.get(f.name, [None] * len(groups)), type=f.type) for f in _FOUND]
        return pa.concat_tables([flat, pa.table(columns, schema=_FOUND)])

    return run


def _wanted(percent):
    """Task side: of two parts of a group, the unsettled lines of the later and the lines of the earlier that pass the filters with one another."""

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in b.schema.names}
                own, other = _held(row["late"]), _held(row["early"])
                asked = {tuple(x[c] for c in _LINE) for x in row["unsettled"]}
                unsettled = [i for i, place in enumerate(zip(*(own[c].tolist() for c in _LINE))) if place in asked]
                late, early = np.zeros(len(own["k"]), bool), np.zeros(len(other["k"]), bool)
                for i in unsettled:
                    before = np.arange(i if row["part"] == row["part0"] else len(early))
                    near = before[_may_match(own, np.full(len(before), i), other, before, percent)]
                    late[i] = len(near)
                    early[near] = True
                if row["part"] == row["part0"]:
                    early &= ~late  # once is enough: in its own part an unsettled line can be the earlier one too
                n = int(late.sum()), int(early.sum())
                places = [pa.array(np.concatenate([own[c][late], other[c][early]]), type=kind) for c, kind in _PLACE]
                where = [pa.array(np.full(sum(n), row[c]), type=kind) for c, kind in _GROUP]
                flag = pa.array(np.arange(sum(n)) < n[0])
                yield pa.record_batch([*where, *places, flag], names=[*(c for c, _ in _GROUP), *_LINE, "unsettled"])

    return run


def _finish(percent):
    """Group side: unsettled lines of a part against the earlier lines of a part, until one is similar."""

    def run(key, table):
        table = table.sort_by([(c, "ascending") for c in _LINE])
        sets = [unpack(x, np.uint64) for x in table.column("elements").to_pylist()]
        sizes = np.array([len(x) for x in sets], dtype=np.int64)
        line = np.repeat(np.arange(len(sets)), sizes)
        bits = wide_bitmaps(np.concatenate(sets) if sets else np.zeros(0, np.uint64), line, np.arange(len(sets)))
        gone = np.zeros(len(sets), dtype=bool)
        for i in np.flatnonzero(table.column("unsettled").to_numpy(zero_copy_only=False)):
            least = _needed(sizes[:i], sizes[i], percent)
            apart = np.bitwise_count(bits[:i] ^ bits[i]).sum(axis=1, dtype=np.int64)
            near = (100 * np.minimum(sizes[:i], sizes[i]) >= percent * np.maximum(sizes[:i], sizes[i])) & (apart <= sizes[:i] + sizes[i] - 2 * least)
            gone[i] = any(_similar(sets[i], sets[j], percent) for j in np.flatnonzero(near))
        return table.select(_LINE).filter(pa.array(gone))

    return run


def _elements_squeezed(batches):
    """Task side: ``_elements`` from squeezed texts."""
    yield from _elements(loosen(batches))


def _places(column):
    """A column of lists of lines as arrays: where the lines of each row begin and end, their numbers, and their names."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
    flat = column.flatten()
    return np.append(0, ends), *(flat.field(c).to_numpy(zero_copy_only=False) for c in ("line", "name"))


def _elements(batches):
    """Task side: the word sets of the lines asked for."""
    for b in batches:
        ids = b.column("_k").to_numpy(zero_copy_only=False)
        bound, lines, wanted = _places(b.column("asked"))
        row = ranges(np.diff(bound))
        for part in slices(b.column("text"), limit=SLICE):
            words, line, doc, number = _line_sets(part, lambda d: lines[bound[part.lo + d] : bound[part.lo + d + 1]])
            names = _names(words, line, len(doc))[:, 1].view(np.int64)
            first = np.searchsorted(doc, np.arange(part.n_docs + 1))
            asked = np.arange(bound[part.lo], bound[part.lo + part.n_docs])
            d = row[asked] - part.lo
            there = lines[asked] < np.diff(first)[d]
            asked, at = asked[there], first[d[there]] + lines[asked[there]]
            same = names[at] == wanted[asked]
            asked, at = asked[same], at[same]
            begin = np.searchsorted(line, np.arange(len(doc) + 1))
            length = begin[at + 1] - begin[at]
            ends = np.cumsum(length)
            held = words[np.arange(length.sum()) + np.repeat(begin[at] - ends + length, length)]
            sets = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(8 * np.append(0, ends)), pa.py_buffer(held)])
            places = [pa.array(v, type=kind) for v, (_, kind) in zip((ids[row[asked]], lines[asked], wanted[asked]), _PLACE)]
            yield pa.record_batch([*places, sets.cast(pa.binary())], names=[*_LINE, "elements"])


def _similar(x, y, percent):
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verify(percent):
    """Task side: the later line of each pair that is similar."""

    def run(batches):
        for b in batches:
            pairs = zip(b.column("x").to_pylist(), b.column("y").to_pylist())
            good = [_similar(unpack(x, np.uint64), unpack(y, np.uint64), percent) for x, y in pairs]
            yield pa.record_batch([b.column(c) for c in _LINE], names=_LINE).filter(pa.array(good, type=pa.bool_()))

    return run


def _drop(batches):
    """Task side: texts without the lines that are gone; ``shared`` says that other rows have the id, too."""
    for b in loosen(batches):
        texts, removed = b.column("text").to_pylist(), [0] * b.num_rows
        bound, lines, wanted = _places(b.column("gone"))
        shared = pc.fill_null(b.column("shared"), False).to_numpy(zero_copy_only=False)
        touched = np.diff(bound) > 0
        out = {i: lines[bound[i] : bound[i + 1]].tolist() for i in np.flatnonzero(touched & ~shared).tolist()}
        # Rows that share an id have lines of other names at the same numbers.
        some = np.flatnonzero(touched & shared)
        for part in slices(b.column("text").take(pa.array(some))):
            words, line, doc, _ = _line_sets(part, lambda d: lines[bound[some[part.lo + d]] : bound[some[part.lo + d] + 1]])
            names = _names(words, line, len(doc))[:, 1].view(np.int64)
            first = np.searchsorted(doc, np.arange(part.n_docs + 1))
            for d in range(part.n_docs):
                i, own = some[part.lo + d], names[first[d] : first[d + 1]]
                out[i] = [x for x, name in zip(lines[bound[i] : bound[i + 1]], wanted[bound[i] : bound[i + 1]]) if x < len(own) and own[x] == name]
        for i, gone in out.items():
            gone = set(gone)
            texts[i] = "\n".join(x for j, x in enumerate(texts[i].split("\n")) if j not in gone)
            removed[i] = len(gone)
        arrays = [b.column("_row"), pa.array(texts, type=pa.string()), pa.array(removed, type=pa.int64())]
        yield pa.record_batch(arrays, names=["_row", "text", "_n_removed"])


def removed_lines(docs, percent=PERCENT):
    """``k``, ``line`` (from 0), ``name``: the lines that repeat an earlier one, by the keys of ``with_keys``."""
    spark = in_small_batches(docs.sparkSession)
    keyed = with_keys(docs.select("doc_id", "text")).select("_k", "text")
    posted = keyed.mapInArrow(_post(rarity(docs), percent, n_blocks(spark)), _ROWS_DDL)
    found = materialise(posted.groupBy("block").applyInArrow(_meet(percent), _FOUND_DDL), "lines")
    pairs = found.where(f"kind = {_PAIR}").select(*_LINE, *_FIRST).distinct()
    open_lines = found.where(f"kind = {_OPEN}").select("key", F.col("line0").alias("part"), *_LINE)

    def sets_of(places, rest=False):
        """The words of lines, from the texts.

        What is asked of the ``rest`` goes to the texts if it is small, by the size it was written with.
        """
        asked, size = written(places.groupBy(F.col("k").alias("_k")).agg(F.collect_list(F.struct("line", "name")).alias("asked")), "asked")
        if rest and size <= BROADCAST:
            sets = keyed.join(F.broadcast(asked), "_k").mapInArrow(_elements, _SETS_DDL)
        else:
            sets = squeeze(keyed).join(asked.hint("merge"), "_k").mapInArrow(_elements_squeezed, _SETS_DDL)
        return materialise(sets, "sets")

    sets = sets_of(pairs.select(*_LINE).union(pairs.select(*_FIRST)).distinct())
    # Dealt by place once: both joins read the same exchange.
    dealt = sets.repartition(*_LINE)
    later = dealt.withColumnRenamed("elements", "x")
    earlier = dealt.select(*(F.col(c).alias(f"{c}0") for c in _LINE), F.col("elements").alias("y"))
    met = pairs.join(later, _LINE).join(earlier, _FIRST).select(*_LINE, "x", "y")
    gone = near = materialise(met.mapInArrow(_verify(percent), _PLACE_DDL).distinct(), "near")
    # What the named partners did not settle meets its whole group, a pair of parts at a time.
    rest = materialise(open_lines.join(near, _LINE, "left_anti"), "open")
    if not rest.isEmpty():
        parts = found.where(f"kind = {_MEMBER}").select("key", F.col("line").alias("part"), "members")
        asked = rest.groupBy("key", "part").agg(F.collect_list(F.struct(*_LINE)).alias("unsettled"))
        late = parts.withColumnRenamed("members", "late").join(asked, ["key", "part"])
        early = parts.select("key", F.col("part").alias("part0"), F.col("members").alias("early"))
        met = late.join(early, "key").where("part0 <= part")
        wanted = materialise(met.mapInArrow(_wanted(percent), _WANTED_DDL), "wanted")
        both = wanted.join(sets_of(wanted.select(*_LINE).distinct(), rest=True), _LINE)
        gone = near.union(materialise(both.groupBy("key", "part", "part0").applyInArrow(_finish(percent), _PLACE_DDL), "rest"))
    return found.where(f"kind = {_GONE}").select(*_LINE).union(gone).distinct()


def dedup_lines(docs, percent=PERCENT):
    """``docs`` without the lines of ``text`` that are similar to an earlier one; ``_n_removed`` is added.

    Lines end at line feeds. A line is the set of its words (as in ``words``); two
    lines are similar when 100 times their common words are at least ``percent`` times
    the words of either. Earlier means a smaller ``doc_id``, or the same document and
    a smaller line number; lines are judged on the input. Lines without
    words stay. A document keeps its row even if no line is left.

    Null texts stay null. A null id comes before every other. Rows that share an id
    are one document: of their lines of one number, equal ones are one line, and
    others follow each other by a hash of their words. Other columns stay; one
    named ``_n_removed`` is replaced. Words are compared by 64-bit hashes.
    """
    docs = but(docs, "_n_removed")
    gone = removed_lines(docs, percent)
    gone = gone.groupBy(F.col("k").alias("_k")).agg(F.collect_list(F.struct("line", "name")).alias("gone"))
    keyed = with_keys(docs).drop("_t")
    shared = keyed.groupBy("_k").count().where("count > 1").select("_k", F.lit(True).alias("shared"))
    gone = gone.join(shared.hint("merge"), "_k", "left")
    row = keyed.schema["_row"].dataType.simpleString()
    cut = squeeze(keyed).join(gone.hint("merge"), "_k", "left").mapInArrow(_drop, f"_row {row}, text string, _n_removed long")
    return without_keys(cut, docs, "_n_removed")
