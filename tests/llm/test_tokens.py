"""BPE, packing and fingerprints against the tokenizers library and plain Python."""

import collections
import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from obsflow.llm import fingerprints as fp
from obsflow.llm import packing
from obsflow.llm.bpe import SPLIT, Pieces, bpe_decode, bpe_encode, vocabulary
from obsflow.llm.packing import pack_sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


BITS = ["a", "the", " ", "  ", "\n", "\t", "\r\n", "é", "ß", "12", "'s", "'ll", "!", "...", "<|endoftext|>", " ", "　"]
BITS += ["\x1c", "\x85", "日本", "😀", "x" * 70, " \n ", "\n\n", "é", '"', "don't", "​", "Ⅷ"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=12).map("".join))
def test_ids_equal_the_library(text):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH) if not hasattr(test_ids_equal_the_library, "own") else test_ids_equal_the_library.own
    test_ids_equal_the_library.own = library
    vocabulary_ = vocabulary(PATH)
    want = ids_of(library, text)
    for encode in (vocabulary_.encode, Pieces(vocabulary_.encode)):
        (ids,) = encode([text])
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert vocabulary_.decode(ids) == library.decode(want, skip_special_tokens=False) == text


def test_segment_tree_merges_leftmost_lowest_first():
    v = vocabulary(PATH)
    rank = {int(k): int(r) for k, r in zip(v._pairs, v._order)}
    r = random.Random(2)
    for _ in range(50):
        piece = "".join(r.choice("theranio ") for _ in range(r.randint(1, 40))).encode()
        symbols = [int(v.of_byte[b]) for b in piece]
        while True:
            found = [(rank.get((a << 32) | b, 1 << 60), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
            if not found or min(found)[0] == 1 << 60:
                break
            best, i = min(found)
            symbols[i : i + 2] = [int(v.merged[best])]
        assert np.frombuffer(v.merge([piece])[0], "<u4").tolist() == symbols


def test_pieces_forget_and_learn_again(monkeypatch):
    monkeypatch.setattr("obsflow.llm.bpe.KEPT_PIECES", 3)
    v = vocabulary(PATH)
    encode = Pieces(v.encode)
    for text in ("one two three four", "five six seven", "one two"):
        assert encode([text]) == v.encode([text])


def test_columns_of_encoded_and_decoded(documents, library):
    encoded = bpe_encode(documents, PATH)
    decoded = bpe_decode(encoded, PATH)
    assert decoded.columns == [*documents.columns, "_ids", "_decoded"]
    for r in decoded.collect():
        assert np.frombuffer(r._ids, "<u4").tolist() == ids_of(library, r.text)
        assert r._decoded == (r.text or "") and r.rank == "extra 12"
    again = bpe_decode(bpe_encode(decoded, PATH), PATH)
    assert sorted(again.columns) == sorted(decoded.columns)


def test_invalid_bytes_decode_to_replacement(spark):
    v = vocabulary(PATH)
    lone = int(v.of_byte[0xE9])
    df = spark.createDataFrame([(bytearray(np.array([lone], "<u4").tobytes()),), (None,)], "_ids binary")
    assert [r._decoded for r in bpe_decode(df, PATH).collect()] == ["�", ""]


def check_packed(pieces, documents, library, window):
    """Every id once, sequences without gaps, of ``window`` ids or a power of two."""
    sequences = collections.defaultdict(list)
    for p in pieces:
        assert p.length > 0
        sequences[p.sequence_id].append((p.offset, p.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    want = collections.Counter()
    for r in documents:
        want[r.doc_id, tuple([*ids_of(library, r.text), 1])] += 1
    by_doc = collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id, p.doc_tokens].append((p.start, np.frombuffer(p.ids, "<u4").tolist()))
    total = collections.Counter()
    for (doc_id, n), own in by_doc.items():
        starts = collections.Counter(i for i, _ in own)
        total[doc_id, n] = starts[0]
        assert sum(len(x) for _, x in own) == n * starts[0]
    assert total == collections.Counter({k: v for k, v in _lengths(want).items()})
    # Documents with an id and length of their own come back whole.
    for (doc_id, ids), count in want.items():
        own = sorted(by_doc[doc_id, len(ids)])
        if total[doc_id, len(ids)] == count == 1:
            assert [i for _, x in own for i in x] == list(ids)


def _lengths(want):
    out = collections.Counter()
    for (doc_id, ids), n in want.items():
        out[doc_id, len(ids)] += n
    return out


@pytest.mark.parametrize("window", [64, 2048])
def test_packing(documents, library, window):
    pieces = pack_sequences(documents, PATH, window=window).collect()
    check_packed(pieces, documents.select("doc_id", "text").collect(), library, window)


def test_packing_query_checksums(spark, library):
    docs = spark.createDataFrame([(1, "some words here " * 900), (2, None)], "doc_id long, text string")
    got = pack_sequences(docs, PATH).withColumn("crc", F.crc32("ids")).collect()
    for p in got:
        ids = [*ids_of(library, "some words here " * 900 if p.doc_id == 1 else ""), 1]
        assert p.crc == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())


def test_plan_covers_what_it_can():
    histogram = np.zeros(65, dtype=np.int64)
    histogram[[40, 24, 10, 44, 32]] = [7, 9, 4, 3, 6]
    rows, n, covered = packing.plan(histogram[:64], 64, 8)
    filled = collections.Counter()
    for length, first, end, base, _ in rows:
        assert 0 <= first < end <= covered[length] <= histogram[length]
        for i in range(end - first):
            filled[base + i] += length
    assert set(filled.values()) == {64} and len(filled) == n >= 10


def in_order(rows):
    return sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.t))


def test_fingerprints(documents):
    rows = in_order(documents.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("t")).collect())
    texts = [r.text or "" for r in rows]
    want = sorted((str(r.doc_id), len(t), hashlib.sha256(e.encode()).hexdigest()) for r, t, e in zip(rows, texts, brute.edited(texts)))
    got = fp.fingerprints(documents).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_hash = {}
    for r in got:
        if r.doc_id is not None:
            by_hash.setdefault(r.doc_id, set()).add(r.fingerprint)
    same = collections.defaultdict(set)
    for r in rows:
        if len(by_hash.get(r.doc_id, ())) == 1:
            same[r.text or ""] |= by_hash[r.doc_id]
    assert all(len(v) == 1 for v in same.values())
    assert len({next(iter(v)) for v in same.values()}) == len(same)


def test_one_document_follows_itself(spark):
    got = fp.fingerprints(spark.createDataFrame([(5, "abcdefg")], "doc_id long, text string")).first()
    assert got.edited_sha256 == hashlib.sha256(b"abcdabc").hexdigest() and got.near_next == 1.0 and got.unchanged == 4


@settings(max_examples=150, deadline=None)
@given(st.text("ab", max_size=60), st.integers(0, 59), st.integers(0, 59), st.integers(0, 60))
def test_longest_common_extension(text, i, j, limit):
    points, at = fp._points([text])
    i, j = min(i, len(text)), min(j, len(text))
    limit = min(limit, len(text) - max(i, j))
    want = next((m for m in range(limit) if text[i + m] != text[j + m]), limit)
    assert fp.Prefixes(points).extension(np.array([i]), np.array([j]), np.array([limit])).tolist() == [want]


def test_likeness_follows_overlap():
    r = random.Random(1)
    text = "".join(r.choice("abcdefghij ") for _ in range(6000))
    other = "".join(r.choice("abcdefghij ") for _ in range(6000))
    points, at = fp._points([text, text, text[:4500] + other[:1500], other])
    whole, sketch = fp.sketches(fp.Prefixes(points), at)
    near = [fp.likeness(whole[0], sketch[0], whole[i], sketch[i]) for i in range(4)]
    assert near[:2] == [1.0, 1.0] and near[3] < 0.05 and abs(near[2] - 0.6) < 0.2


def test_empty_tables(empty):
    assert bpe_decode(bpe_encode(empty, PATH), PATH).count() == 0
    assert pack_sequences(empty, PATH).count() == 0
    assert fp.fingerprints(empty).count() == 0


def test_packing_encodes_in_little_more_than_the_time_of_the_ids():
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("etaoinshr", k=r.randint(3, 9))) for _ in range(2000)) for _ in range(100)]
    plain = tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=packing_ranks(), special_tokens=vocabulary(PATH).special)
    encode, _ = packing._encoder(PATH)

    def seconds(work):
        began = time.process_time()
        work()
        return time.process_time() - began

    best = min(seconds(lambda: [plain.encode_to_numpy(t, allowed_special="all") for t in texts]) for _ in range(3))
    assert min(seconds(lambda: [encode(t) for t in texts]) for _ in range(3)) < 1.5 * best + 0.05
    assert all((encode(t) == plain.encode_to_numpy(t, allowed_special="all")).all() for t in texts)


def packing_ranks():
    known = vocabulary(PATH)
    return {token: i for i, token in enumerate(known.text) if i not in known.special.values()}


@pytest.mark.parametrize("text", BITS + ["", "a\n\nb  c ", " lead", "x <|endoftext|> y\t"])
def test_packing_ids_equal_the_library(text, library):
    assert packing._encoder(PATH)[0](text).tolist() == ids_of(library, text)
