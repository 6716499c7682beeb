"""Phrase collocation mining by best-first branch-and-bound growth.

A phrase grows to the right, word by word. Every phrase that begins with the word w
scores at most ``1000 n / f(w)``: cut after w, the rest is at least as frequent as
the whole. That is the bound of all nodes of the family of w, and it needs
nothing but a prefix count. The frontier holds the prefixes that are frequent enough to grow;
each round expands those of the best bounds, about ``SHARE`` of a language's words
at a time, and leaves out families whose bound lies below the score that the
last wanted phrase has so far. It ends when no node is left, so the last
wanted score, with its ties, is settled.

A round is a few passes over the corpus, kept as runs of 64-bit names of
frequent words: one counts the one-word extensions of the chosen prefixes, one
fetches the words around those frequent enough, and one counts ends of phrases
that belong to families not grown. Which prefixes are meant is sent as a bitmap
of fixed size; a wrong hit costs time, counts are exact by name.

A phrase is dropped for a longer one as frequent exactly if all its places have
the same word before, or the same word behind, so a longest phrase of five words
needs no sixth.

Rows, not ids, are documents. A null text is empty, a null language is ``und``. A
table without rows gives none. Texts are read a few megabytes at a time, so memory
follows the longest text. Names have 64 bits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Window
from pyspark.sql import functions as F

from obsflow.llm.blocks import added_up, in_small_batches
from obsflow.llm.words import mix, prefix_hashes, slices, span_hashes, strings
from obsflow.session import materialise

LONGEST = 5
LEAST = 100
FIRST = 2000
#: Part of a language's words that one round's prefixes begin at, about.
SHARE = 0.5
#: Bits of a bitmap, as a power of two: 2 MB, whatever the data.
BITMAP = 24
#: Bytes of text that become one row of names, or one text if it is longer.
_SLICE = 3 << 19

_CUT = np.zeros(256, dtype=bool)
_CUT[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _CUT.copy()
_GAP[[0x20, 0x09]] = True


def _languages(column):
    """The language of every row of a batch, as Arrow codes, and a number for each."""
    codes = pc.fill_null(column, "und").dictionary_encode()
    salts = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in codes.dictionary.to_pylist()]
    return codes, np.array(salts, dtype=np.uint64)


def _names(part, salts):
    """A 64-bit name, never 0, for every word of a slice; ``salts``: number of each document's language."""
    names = mix(part.word_hashes() ^ salts[part.doc])
    return np.where(names == 0, np.uint64(1), names)


def count_words(batches):
    """Rows (lang, word, name, n); a null word stands for all words of a language."""

    def tables():
        for b in batches:
            codes, salts = _languages(b.column("lang"))
            lang = codes.indices.to_numpy().astype(np.int64)
            for part in slices(b.column("text"), lower=True, limit=_SLICE, gaps=_GAP):
                own = lang[part.lo : part.lo + part.n_docs]
                words = strings(part, _GAP)
                n_words = max(len(words.dictionary), 1)
                key, first, n = np.unique(
                    own[part.doc] * n_words + words.indices.to_numpy(), return_index=True, return_counts=True
                )
                names = _names(part, salts[own])[first].view(np.int64)
                columns = [
                    codes.dictionary.take(pa.array(key // n_words)), words.dictionary.take(pa.array(key % n_words)),
                    pa.array(names), pa.array(n),
                ]
                yield pa.table(columns, ["lang", "word", "h", "n"])
                whole = np.bincount(own[part.doc], minlength=len(codes.dictionary))
                some = np.flatnonzero(whole)
                nothing = pa.nulls(len(some), pa.string())
                columns = [codes.dictionary.take(pa.array(some)), nothing, pa.array(np.zeros(len(some), np.int64)), pa.array(whole[some])]
                yield pa.table(columns, ["lang", "word", "h", "n"])

    yield from added_up(tables(), ("lang", "word", "h"))


def _bitmap(names):
    """A bitmap of the names in column ``h``, as numpy bytes; at most 2**(BITMAP - 6) rows reach the driver."""
    places = names.select(F.shiftrightunsigned("h", 64 - BITMAP).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place % 64 AS int))")
    words = places.groupBy(F.expr("cast(place div 64 AS int)").alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    found = np.zeros(1 << (BITMAP - 6), dtype=np.int64)
    found[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return found.view(np.uint8)


def _hit(bitmap, names):
    """Whether each name is in the bitmap."""
    place = names >> np.uint64(65 - (8 * len(bitmap)).bit_length())
    return (bitmap[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _write_runs(bitmap):
    """Texts to names of frequent words, 0 between pieces and for all other words, compressed."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for b in batches:
            codes, salts = _languages(b.column("lang"))
            lang = codes.indices.to_numpy()
            for part in slices(b.column("text"), lower=True, limit=_SLICE, gaps=_GAP):
                if not len(part.start):
                    continue
                names = _names(part, salts[lang[part.lo : part.lo + part.n_docs]])
                names = np.where(_hit(bitmap, names), names, np.uint64(0))
                cuts = np.zeros(len(part.data) + 1, dtype=np.int64)
                np.cumsum(_CUT[part.data], out=cuts[1:])
                ends = (cuts[part.start[1:]] > cuts[part.end[:-1]]) | (part.doc[1:] != part.doc[:-1])
                place = np.arange(len(names)) + 1
                place[1:] += np.cumsum(ends)
                tokens = np.zeros(place[-1] + 2, dtype=np.uint64)
                tokens[place] = names
                there = tokens > 0
                there[1:-1] &= there[:-2] | there[2:]
                tokens[~there] = 0
                some = there.copy()
                some[1:] |= there[:-1]
                some[0] = True
                tokens = tokens[some]
                if len(tokens) > 2:
                    yield pa.record_batch([pa.array([packer.compress(tokens.tobytes())])], ["tokens"])

    return run


class _Run:
    """The phrases of one row of names."""

    def __init__(self, packed):
        self.tokens = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed.as_buffer()), dtype=np.uint64)
        self._prefix = prefix_hashes(self.tokens)
        self._gaps = np.zeros(len(self.tokens) + 1, dtype=np.int64)
        np.cumsum(self.tokens == 0, out=self._gaps[1:])

    def places(self, length):
        """Where phrases of so many words begin."""
        return np.flatnonzero(self._gaps[length:] == self._gaps[:-length])

    def names(self, at, length):
        """Names of the phrases that begin at ``at``."""
        return self.tokens[at] if length == 1 else mix(span_hashes(self._prefix, at, at + length), length)


def _counted(names):
    found, n = np.unique(names, return_counts=True)
    return pa.table([pa.array(found.view(np.int64)), pa.array(n)], ["h", "n"])


def _count_extensions(bitmap, lengths):
    """Occurrences of the one-word extensions of the prefixes in the bitmap."""

    def tables(batches):
        for b in batches:
            for packed in b.column("tokens"):
                run = _Run(packed)
                for length in lengths:
                    at = run.places(length + 1)
                    yield _counted(run.names(at[_hit(bitmap, run.names(at, length))], length + 1))

    return lambda batches: added_up(tables(batches), ("h",))


def _count_phrases(bitmap, lengths):
    """Occurrences of the phrases in the bitmap."""

    def tables(batches):
        for b in batches:
            for packed in b.column("tokens"):
                run = _Run(packed)
                for length in lengths:
                    names = run.names(run.places(length), length)
                    yield _counted(names[_hit(bitmap, names)])

    return lambda batches: added_up(tables(batches), ("h",))


def _only(values, first):
    """The common value of each group of places, or 0; groups begin at ``first``."""
    low, high = np.minimum.reduceat(values, first), np.maximum.reduceat(values, first)
    return np.where(low == high, low, np.uint64(0))


def _around(bitmap, lengths):
    """Prefix, last word, ends and neighbours of the phrases in the bitmap, a row per phrase and run."""

    def run(batches):
        for b in batches:
            for packed in b.column("tokens"):
                own = _Run(packed)
                for length in lengths:
                    at = own.places(length)
                    names = own.names(at, length)
                    some = _hit(bitmap, names)
                    order = np.argsort(names[some], kind="stable")
                    at, names = at[some][order], names[some][order]
                    if not len(at):
                        continue
                    h, first = np.unique(names, return_index=True)
                    one = at[first]
                    ends = [own.names(one + k, length - k) if k < length - 1 else None for k in range(1, LONGEST - 1)]
                    columns = [
                        h, own.names(one, length - 1), own.tokens[one + length - 1],
                        _only(own.tokens[at - 1], first), _only(own.tokens[at + length], first),
                    ]
                    columns = [pa.array(c.view(np.int64)) for c in columns]
                    columns += [pa.nulls(len(h), pa.int64()) if e is None else pa.array(e.view(np.int64)) for e in ends]
                    yield pa.record_batch(columns, ["h", "parent", "last", "before", "behind", *_ENDS])

    return run


_ENDS = [f"end{k}" for k in range(1, LONGEST - 1)]


def _bound(n="n", first="ls[0]"):
    return F.expr(f"(1000BD * cast({n} AS decimal(19,0))) div cast({first} AS decimal(19,0))")


def _chosen(frontier):
    """Nodes of the best bounds of each language: the octaves that hold ``SHARE`` of its words, at least one."""
    marked = frontier.withColumn("octave", F.floor(F.log2("bound")))
    held = marked.groupBy("lang", "octave").agg(F.sum(F.element_at("ls", -1)).alias("held"), F.first("n").alias("n"))
    above = Window.partitionBy("lang").orderBy(F.desc("octave")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("held").over(above), F.lit(0))
    taken = held.withColumn("before", before).where(F.col("before") < SHARE * F.col("n")).groupBy("lang")
    return marked.join(taken.agg(F.min("octave").alias("from")), "lang").withColumn("now", F.expr("octave >= from"))


def _scored(nodes, known, columns):
    """Nodes with the lowest score of their cuts and that cut's counts; of equal scores the first cut."""
    cuts = nodes.select("h", "n", "ls", F.posexplode("ends").alias("k", "end"))
    known = known.select(F.col("h").alias("end"), F.col("a").alias("r"))
    cuts = cuts.join(known, "end").withColumns({"a": F.element_at("ls", -1), "l": F.expr("ls[k]")})
    # floor(1000 a n / (l r)) by l first, then by r: every step is exact and within 38 digits for any longs.
    cuts = cuts.withColumns({c: F.col(c).cast("decimal(19,0)") for c in "anlr"})
    by_l = "cast((a * n) div l AS decimal(19,0)) * 1000 + (1000 * ((a * n) % l)) div l"
    score = F.expr(f"cast({by_l} AS decimal(24,0)) div r")
    cuts = cuts.select("h", "k", score.alias("score"), *[F.col(c).cast("long").alias(c) for c in "alr"])
    lowest = cuts.groupBy("h").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("c"))
    return nodes.join(lowest, "h").select(*columns, "before", "behind", "c.score", "c.a", "c.l", "c.r")


def collocations(docs, first=FIRST, least=LEAST):
    """The phrases of two to five words with the highest scores of each language.

    Returns ``lang``, ``rank``, ``phrase``, ``a`` (occurrences of the phrase), ``l`` and ``r``
    (of the parts its lowest-scoring cut leaves), ``n`` (words of the language) and
    ``score``. Equal scores are ranked by ``a``, then by the phrase in UTF-8 order; how
    many phrases share the last score is not limited while the search runs. Other
    columns of ``docs`` are not looked at.
    """
    spark = in_small_batches(docs.sparkSession)
    texts = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    found = texts.mapInArrow(count_words, "lang string, word string, h long, n long")
    found = found.groupBy("lang", "word", "h").agg(F.sum("n").alias("a"))
    found = materialise(found.where(F.col("word").isNull() | (F.col("a") >= least)), "words")
    languages = found.where("word IS NULL").select("lang", F.col("a").alias("n"))
    words = found.where("word IS NOT NULL")
    runs = materialise(texts.mapInArrow(_write_runs(_bitmap(words)), "tokens binary"), "runs")

    columns = ["lang", "n", "h", "words", "ls"]
    frontier = words.join(languages, "lang").select("lang", "n", "h", F.array("h").alias("words"), F.array("a").alias("ls"))
    known, best, last = [words.select("h", "a")], None, None
    while True:
        frontier = frontier.withColumn("bound", _bound())
        if last is not None:
            frontier = frontier.join(last, "lang", "left").where("last IS NULL OR bound >= last").drop("last")
        frontier = materialise(_chosen(frontier), "frontier")
        now = frontier.where("now")
        lengths = sorted(r[0] for r in now.select(F.size("words")).distinct().collect())
        if not lengths:
            break
        nodes = _expanded(now, runs, lengths, least, columns)
        longer = [n + 1 for n in lengths]
        known.append(materialise(nodes.select("h", F.element_at("ls", -1).alias("a")), "known"))
        known += _end_counts(nodes, runs, _all(known), [n for n in range(2, max(longer))])
        scored = _scored(nodes, _all(known), columns)
        alive = (F.size("words") == LONGEST) | ((F.col("before") == 0) & (F.col("behind") == 0))
        ours = scored.where(alive).drop("before", "behind")
        place = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
        both = ours if best is None else best.unionByName(ours)
        best = materialise(both.withColumn("place", place).where(F.col("place") <= first).drop("place"), "best")
        last = best.groupBy("lang").agg(F.count("*").alias("held"), F.min("score").alias("last"))
        last = materialise(last.where(F.col("held") >= first).select("lang", "last"), "last")
        rest = frontier.where("NOT now").select(columns)
        frontier = rest.unionByName(nodes.where(F.size("words") < LONGEST).select(columns))
    if best is None:
        best = spark.createDataFrame([], "lang string, n long, h long, words array<long>, ls array<long>, score long, a long, l long, r long")
    return _spelt(best, words, first)


def _all(tables):
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _expanded(chosen, runs, lengths, least, columns):
    """The frequent one-word extensions of the chosen nodes, with their words, prefix counts, ends and neighbours."""
    counted = runs.mapInArrow(_count_extensions(_bitmap(chosen), lengths), "h long, n long")
    counted = counted.groupBy("h").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
    counted = materialise(counted, "counted")
    kinds = ", ".join(f"{c} long" for c in ("h", "parent", "last", "before", "behind", *_ENDS))
    seen = runs.mapInArrow(_around(_bitmap(counted), [n + 1 for n in lengths]), kinds)
    common = [
        F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.lit(0)).alias(c) for c in ("before", "behind")
    ]
    seen = seen.groupBy("h").agg(*[F.first(c).alias(c) for c in ("parent", "last", *_ENDS)], *common)
    parents = chosen.select(F.col("h").alias("parent"), "lang", "n", "words", "ls")
    nodes = counted.join(seen, "h").join(parents, "parent").select(
        "lang", "n", "h",
        F.concat("words", F.array("last")).alias("words"),
        F.concat("ls", F.array("a")).alias("ls"),
        F.array_compact(F.array(*_ENDS, "last")).alias("ends"),
        "before", "behind",
    )
    return materialise(nodes, "nodes")


def _end_counts(nodes, runs, known, lengths):
    """Counts of the ends of phrases that no family grown so far has; no table or one."""
    ends = nodes.select(F.explode("ends").alias("h")).distinct()
    missing = materialise(ends.join(known, "h", "left_anti"), "ends")
    if not lengths or missing.isEmpty():
        return []
    counted = runs.mapInArrow(_count_phrases(_bitmap(missing), lengths), "h long, n long")
    counted = counted.groupBy("h").agg(F.sum("n").alias("a"))
    return [materialise(counted.join(missing, "h", "left_semi"), "known")]


def _spelt(best, words, first):
    """The first phrases of each language by score, occurrences and spelling."""
    spelling = words.select(F.col("h").alias("name"), "word")
    parts = best.select("h", F.posexplode("words").alias("k", "name")).join(spelling, "name")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "word"))), lambda p: p["word"]), " ")
    phrases = best.join(parts.groupBy("h").agg(text.alias("phrase")), "h")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
