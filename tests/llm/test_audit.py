"""Source divergence against plain Python."""

import random
import re
from collections import Counter

import pytest

from obsflow.llm import divergence as module
from obsflow.llm.divergence import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        spread = Counter(t for d in own for t in set(d[2]))
        kept = [t for t in spread if spread[t] >= least]
        counts = {}
        for _, source, terms in own:
            counts.setdefault(source, Counter()).update(t for t in terms if spread[t] >= least)
        whole = sum(counts.values(), Counter())

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}

        def far(p, q):
            return (p - q) ** 2 // (p + q)

        ps, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s, p in ps.items():
            pairs = [(-sum(far(p[t], r[t]) for t in kept), o.encode()) for o, r in ps.items() if o != s]
            terms = [(-far(p[t], q[t]), t.encode()) for t in kept if counts[s][t] and p[t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def corpus(seed=4):
    r = random.Random(seed)
    vocabulary = [w for i in range(60) for w in (f"w{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}", f"É{'abcdefghij'[i % 10]}ß{'klmnop'[i // 10]}")]
    rows = []
    for i in range(160):
        lang, source = r.choice(["en", "fr", None]), r.choice(["a", "b", "é", "Z", None, "", "c d"])
        words = r.choices(vocabulary, [1 / (j + 1) for j in range(len(vocabulary))], k=r.randint(0, 40))
        rows.append((r.choice([" ", "-", "1", "\n", "\x00"]).join(words).replace("wa", r.choice(["wa", "WA"])), lang, source))
    rows += [rows[0], rows[0], (None, "en", "a"), ("", "xx", "only"), ("7 8", "xx", "other"), ("long " * 60000, "fr", "b")]
    return rows


@pytest.mark.parametrize("blocks", [(64, 4096), (2, 7)])
def test_divergence_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(module, "GROUP_BLOCK", blocks[0])
    monkeypatch.setattr(module, "TERM_BLOCK", blocks[1])
    rows = corpus()
    schema = "text string, lang string, source string, p int, n string, term string, rank int, gb int"
    docs = spark.createDataFrame([(*r, 1, "n", "t", 0, 2) for r in rows], schema).repartition(3)
    got = sorted(tuple(r) for r in divergence(docs).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == brute(rows, 10)
    assert {r[2] for r in got} == {"pair", "term"}


def test_groups_without_terms_are_compared(spark):
    docs = spark.createDataFrame([("a b", "en", "x"), (None, "en", "y")], "text string, lang string, source string")
    got = sorted(tuple(r) for r in divergence(docs).collect())
    assert got == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_counts_beyond_64_bits_of_products(spark):
    """A count near 2**53 times a billion passes 64 bits; the shares are exact."""
    n, total = 9_007_199_254_740_881, 9_007_199_254_741_999
    row = spark.createDataFrame([(n, total, 3)], "n long, total long, v long").select(module._p("n", "total", "v")).first()
    assert row[0] == 1 + 10**9 * (n + 2) // (total + 6)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence(docs).count() == 0


def test_pending_counts_are_sent_early(spark, monkeypatch):
    monkeypatch.setattr(module, "_PENDING", 3)
    import pyarrow as pa

    batch = pa.record_batch([["a b c d e f", "a a", "g"], ["l", None, "l"], ["s", "s", "s"]], ["text", "lang", "source"])
    found = pa.Table.from_batches(list(module.count_terms(iter([batch, batch])))).to_pylist()
    total = Counter()
    for r in found:
        total[r["lang"], r["term"]] += r["n"]
    assert total == {**{("l", t): 2 for t in "abcdefg"}, ("", "a"): 4}
