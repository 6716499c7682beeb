"""Substring dedup by hashing windows, in place of relative Lempel-Ziv parsing.

The reference is the corpus itself. It is cut into passages at content-defined
anchors (the smallest hash of six words within a window), and passages with the
same anchor meet in the same block, wherever their documents lie, so a document
is held against every block that could hold a part of it. A block looks every
window of a passage up among those of earlier places. A window that is found is
marked, and marked neighbours become one duplicate span; the words between spans
are kept. Every window is looked up, so a repeat that begins in one source and
ends in the next is not missed. No factor with a source place and a length is made: the
words removed are those that a greedy parse into factors of at least one
window covers, but the source text does not travel with a passage.

Equal windows have equal anchors, and only anchors that occur twice can have
equal windows, so anchors are counted first and only their windows travel.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import functions as F

from obsflow.llm.blocks import (
    batch,
    block_of,
    but,
    changes,
    deal,
    in_small_batches,
    n_blocks,
    pack,
    ranges,
    unpack,
    with_keys,
    without_keys,
)
from obsflow.llm.words import mix, slices

WINDOW = 20
ANCHOR = 6


def _sliding_min(values, width):
    """The smallest of every ``width`` consecutive values."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    if reach < width:
        values = np.minimum(values[: len(values) - (width - reach)], values[width - reach :])
    return values


def _windows(part, window, anchor):
    """Windows of a slice: first word, document and anchor; whether one holds its anchor twice; word hashes."""
    words = part.word_hashes()
    at = part.inside(window)
    if not len(at):
        return at, at, np.zeros(0, np.uint64), np.zeros(0, bool), words
    grams = part.run_hashes(words, anchor)
    width = window - anchor + 1
    anchors = _sliding_min(grams, width)[at]
    held = np.zeros(len(at), dtype=np.uint8)
    for shift in range(width):
        held += grams[at + shift] == anchors
    return at, part.doc[at], anchors, held > 1, words


_ANCHORS = pa.schema([("block", pa.int32()), ("known", pa.bool_()), ("ids", pa.binary()), ("doc", pa.binary()), ("anchor", pa.binary())])
_REPEATED = "_k long, anchors binary"
_PASSAGES = pa.schema(
    [
        ("block", pa.int32()),
        ("known", pa.bool_()),
        ("k", pa.binary()),
        ("t", pa.binary()),
        ("doc", pa.binary()),
        ("word", pa.binary()),
        ("anchor", pa.binary()),
        ("hash", pa.binary()),
    ]
)
_SPANS = "_k long, _t long, words binary"


def _ddl(schema):
    kinds = {pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary", pa.int64(): "long"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _anchor_rows(window, anchor, blocks):
    """Task side: the distinct anchors of each document, packed by block.

    An anchor seen twice in a slice is known to repeat. It is sent once for the
    count and otherwise travels as known, spread over blocks by document, so an
    anchor that a third of all documents hold fills no block.
    """

    def run(batches):
        for b in batches:
            ids = b.column("_k").to_numpy(zero_copy_only=False)
            for part in slices(b.column("text")):
                at, doc, anchors, twice, _ = _windows(part, window, anchor)
                begin = np.flatnonzero(changes(doc, anchors))
                # Equal windows may also lie within one run of windows: where one
                # holds its anchor twice, or the run is longer than one anchor allows.
                own = np.diff(np.append(begin, len(at))) > window - anchor + 1
                if len(begin):
                    own |= np.logical_or.reduceat(twice, begin)
                doc, anchors = doc[begin], anchors[begin]
                order = np.argsort(anchors, kind="stable")
                new = changes(anchors[order])
                size = np.bincount(np.cumsum(new) - 1)
                first = order[new]
                known = own.copy()
                known[order] |= np.repeat(size, size) > 1
                known = np.flatnonzero(known)
                rows = []
                for told, those in ((False, first), (True, known)):
                    where = block_of(mix(anchors[those]), blocks)
                    if told:
                        where = blocks + block_of(mix(ids[part.lo + doc[those]].astype(np.uint64)), blocks)
                    for block, chosen in deal(where):
                        chosen = np.sort(those[chosen])
                        held, back = np.unique(doc[chosen], return_inverse=True)
                        rows.append((block, told, pack(ids[part.lo + held]), pack(np.diff(back, prepend=0).astype(np.int32)), pack(anchors[chosen])))
                yield batch(_ANCHORS, rows)

    return run


def _repeated_anchors(key, table):
    """Block side: which anchors occur twice, told to the documents that hold them."""
    ids, anchors = [], []
    known = []
    for row in table.to_pylist():
        own = unpack(row["ids"], np.int64)[np.cumsum(unpack(row["doc"], np.int32).astype(np.int64))]
        ids.append(own)
        anchors.append(unpack(row["anchor"], np.uint64))
        known.append(np.full(len(own), row["known"]))
    ids, anchors, known = np.concatenate(ids), np.concatenate(anchors), np.concatenate(known)
    order = np.argsort(anchors, kind="stable")
    new = changes(anchors[order])
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    keep = order[(size[group] > 1) | known[order]]
    keep = keep[np.argsort(ids[keep], kind="stable")]
    at = np.flatnonzero(changes(ids[keep]))
    ends = np.append(at[1:], len(keep))
    return pa.table(
        {
            "_k": pa.array(ids[keep][at], type=pa.int64()),
            "anchors": pa.array([pack(anchors[keep[i:j]]) for i, j in zip(at, ends)], type=pa.binary()),
        }
    )


def _passage_rows(window, anchor, blocks):
    """Task side: windows with a repeated anchor, packed by the anchor's block.

    Of equal windows in a slice only the first in reading order goes to its
    block; the others are repeats already and travel as known, spread by document.
    """

    def run(batches):
        for b in batches:
            ids, hashes = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_k", "_t"))
            told = b.column("anchors").to_pylist()
            for part in slices(b.column("text")):
                own = [np.frombuffer(b"".join(told[part.lo + d]), dtype=np.uint64) for d in range(part.n_docs)]
                holder = ranges([len(x) for x in own]).astype(np.uint64)
                asked = np.unique(mix(np.concatenate(own) ^ mix(holder, 3)))
                at, doc, anchors, _, words = _windows(part, window, anchor)
                held = np.isin(mix(anchors ^ mix(doc.astype(np.uint64), 3)), asked)
                at, doc, anchors = at[held], doc[held], anchors[held]
                value = part.run_hashes(words, window)[at] if len(at) else np.zeros(0, np.uint64)
                k, t = ids[part.lo + doc], hashes[part.lo + doc]
                word = at - part.first[doc]
                order = np.lexsort((word, t, k, value))
                new = changes(value[order])
                # Rows that repeat a document are the same place, not a later one.
                place = changes(k[order], t[order], word[order])
                first = order[new]
                again = order[~new & place]
                rows = []
                for known, those in ((False, first), (True, again)):
                    where = block_of(mix(anchors[those]), blocks)
                    if known:
                        where = blocks + block_of(mix(t[those].astype(np.uint64)), blocks)
                    for block, chosen in deal(where):
                        chosen = np.sort(those[chosen])
                        docs, back = np.unique(doc[chosen], return_inverse=True)
                        run_of = changes(anchors[chosen], doc[chosen])
                        length = np.diff(np.append(np.flatnonzero(run_of), len(chosen)))
                        rows.append(
                            (
                                block,
                                known,
                                pack(ids[part.lo + docs]),
                                pack(hashes[part.lo + docs]),
                                pack(np.diff(back, prepend=0).astype(np.int32)),
                                pack(np.diff(word[chosen], prepend=0).astype(np.int32)),
                                b"" if known else pack(length.astype(np.int32)) + pack(anchors[chosen][run_of]),
                                b"" if known else pack(value[chosen]),
                            )
                        )
                yield batch(_PASSAGES, rows)

    return run


def _factor(window):
    """Block side: look the windows of every passage up among those of the passages before it."""

    def run(key, table):
        columns = {c: [] for c in ("k", "t", "word", "anchor", "hash", "known")}
        for row in table.to_pylist():
            doc = np.cumsum(unpack(row["doc"], np.int32).astype(np.int64))
            columns["k"].append(unpack(row["k"], np.int64)[doc])
            columns["t"].append(unpack(row["t"], np.int64)[doc])
            columns["word"].append(np.cumsum(unpack(row["word"], np.int32).astype(np.int64)))
            columns["known"].append(np.full(len(doc), row["known"]))
            if row["known"]:
                columns["hash"].append(np.zeros(len(doc), np.uint64))
                columns["anchor"].append(np.zeros(len(doc), np.uint64))
                continue
            columns["hash"].append(unpack(row["hash"], np.uint64))
            n = len(row["anchor"]) // 12
            lengths = unpack(row["anchor"][: 4 * n], np.int32)
            columns["anchor"].append(np.repeat(unpack(row["anchor"][4 * n :], np.uint64), lengths))
        k, t, word, anchor, value, known = (np.concatenate(columns[c]) for c in ("k", "t", "word", "anchor", "hash", "known"))
        # The index: the first place of each window of the block in reading order.
        order = np.lexsort((word, t, k, value, anchor))
        first = changes(anchor[order], value[order])
        origin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        same = (k[order] == k[order[origin]]) & (t[order] == t[order[origin]]) & (word[order] == word[order[origin]])
        hit = np.zeros(len(k), dtype=bool)
        hit[order] = ~same
        hit |= known
        chosen = np.flatnonzero(hit)
        chosen = chosen[np.lexsort((word[chosen], t[chosen], k[chosen]))]
        # Factors: runs of windows that are held, one word apart.
        k, t, word = k[chosen], t[chosen], word[chosen]
        new = changes(k, t, word - np.arange(len(word)))
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(word))
        spans = np.stack([word[begin], word[end - 1] + window], axis=1) if len(begin) else np.zeros((0, 2), np.int64)
        k, t = k[begin], t[begin]
        at = np.flatnonzero(changes(k, t))
        ends = np.append(at[1:], len(k))
        return pa.table(
            {
                "_k": pa.array(k[at], type=pa.int64()),
                "_t": pa.array(t[at], type=pa.int64()),
                "words": pa.array([pack(spans[i:j].astype(np.int32)) for i, j in zip(at, ends)], type=pa.binary()),
            }
        )

    return run


def _cut(batches):
    """Task side: cut the spans out of each text."""
    for b in batches:
        ends = b.column("spans").to_pylist()
        hashes = b.column("_t").to_pylist()
        texts, n_words, n_removed, kept_hash, spans = [], [], [], [], []
        column = b.column("text")
        for part in slices(column):
            for d in range(part.n_docs):
                row, lo, hi = part.lo + d, part.first[d], part.first[d + 1]
                body = part.data[part.offsets[d] : part.offsets[d + 1]].tobytes()
                own = [np.frombuffer(x["words"], np.int32) for x in ends[row] or () if x["_t"] == hashes[row]]
                n_words.append(int(hi - lo))
                if not own:
                    texts.append(body)
                    n_removed.append(0)
                    spans.append([])
                    kept_hash.append(hashlib.sha256(b" ".join(body.split())).hexdigest())
                    continue
                pairs = np.concatenate(own).reshape(-1, 2).astype(np.int64)
                depth = np.bincount(pairs[:, 0], minlength=hi - lo + 1) - np.bincount(pairs[:, 1], minlength=hi - lo + 1)
                gone = np.cumsum(depth[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2)
                start = np.append(part.start[lo:hi] - part.offsets[d], len(body))
                kept, done = [], 0
                for i, j in edge:
                    kept.append(body[done : start[i]])
                    done = start[j]
                kept.append(body[done:])
                kept = b"".join(kept)
                texts.append(kept)
                n_removed.append(int(gone.sum()))
                spans.append([{"start": int(i), "end": int(j)} for i, j in edge])
                kept_hash.append(hashlib.sha256(b" ".join(kept.split())).hexdigest())
        arrays = {"_row": b.column("_row")}
        text = pa.array([x.decode() for x in texts], type=pa.string())
        if column.null_count:
            text = pa.compute.if_else(pa.compute.is_null(column), pa.scalar(None, pa.string()), text)
        arrays["text"] = text
        arrays |= {
            "_n_words": pa.array(n_words, type=pa.int64()),
            "_n_removed": pa.array(n_removed, type=pa.int64()),
            "_kept_sha256": pa.array(kept_hash, type=pa.string()),
            "_spans": pa.array(spans, type=pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        }
        yield pa.record_batch(list(arrays.values()), names=list(arrays))


def dedup_substrings(docs, window=WINDOW, anchor=ANCHOR):
    """``docs`` with every word cut out of ``text`` that lies in a window seen earlier.

    A window is ``window`` consecutive words of one document. It was seen
    earlier if the same words start in a document with a smaller ``doc_id``, or
    at an earlier word of the same document; windows are judged on the input.
    The white space after a removed word goes with it. All columns of ``docs``
    stay; ``_n_words``, ``_n_removed``, ``_kept_sha256`` (of the kept words joined by
    one space) and ``_spans`` (removed ranges of words) are added.

    Null texts stay null and have no words; texts under ``window`` words stay as
    they are. A null id comes before every other. Rows alike in id and text are
    one document repeated and get the same result; rows that share only the id
    follow each other by a hash of their texts. Words are compared by 64-bit hashes
    of a window among windows with the same 64-bit anchor.
    """
    spark = in_small_batches(docs.sparkSession)
    blocks = n_blocks(spark)
    added = {"_n_words": "long", "_n_removed": "long", "_kept_sha256": "string", "_spans": "array<struct<start: long, end: long>>"}
    docs = but(docs, *added)
    # All columns travel, so that both joins below read one and the same exchange.
    keyed = with_keys(docs)
    repeated = (
        keyed.select("_k", "text")
        .mapInArrow(_anchor_rows(window, anchor, blocks), _ddl(_ANCHORS))
        .groupBy("block")
        .applyInArrow(_repeated_anchors, _REPEATED)
        .groupBy("_k")
        .agg(F.collect_list("anchors").alias("anchors"))
    )
    spans = (
        keyed.join(repeated.hint("merge"), "_k")
        .mapInArrow(_passage_rows(window, anchor, blocks), _ddl(_PASSAGES))
        .groupBy("block")
        .applyInArrow(_factor(window), _SPANS)
        .groupBy("_k")
        .agg(F.collect_list(F.struct("_t", "words")).alias("spans"))
    )
    kinds = {"_row": keyed.schema["_row"].dataType.simpleString(), "text": "string", **added}
    fields = ", ".join(f"{c} {kind}" for c, kind in kinds.items())
    cut = keyed.join(spans.hint("merge"), "_k", "left").mapInArrow(_cut, fields)
    return without_keys(cut, docs, *added)
