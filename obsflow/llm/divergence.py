"""Source divergence audit by three-dimensional cube partitioning.

Every (lang, source) group has a smoothed distribution over the kept terms of its
language. Comparing all groups of a language over all terms is a cube: groups
down, groups across, terms deep. It is cut into cells of (group block, group
block, term block); the slice of a group block and a term block is replicated to
the cells that need it, each cell is a task's work and sums its terms into one
partial divergence per pair, and the partials are added along the term axis.

Inside a cell only terms that some group of the cell has are spread out; all the
others contribute the same amount, which is multiplied, so nothing is left out.
All arithmetic is on whole numbers: decimals where products pass 64 bits, longs
elsewhere.

Rows, not ids, are documents: a repeated row counts again. Null texts,
languages and sources are read as ''. A table without rows gives none. Texts are
read a few megabytes at a time, so memory follows the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from obsflow.llm.blocks import added_up
from obsflow.llm.words import NO_LETTER, slices, strings
from obsflow.session import materialise

MIN_DOCUMENTS = 10
SCALE = 1_000_000_000
TERM_RANKS = 10
#: Groups and terms on the edges of a cell, on average.
GROUP_BLOCK = 64
TERM_BLOCK = 4096
#: Rows of counted terms that a task collects before it adds up and sends them.
_PENDING = 400_000
_COUNTED = "lang string, source string, term string, n long, docs long"


def _counts(part, group):
    """(group, term, occurrences, documents) of a slice; ``group``: code of each of its documents."""
    terms = strings(part, NO_LETTER)
    n_terms = max(len(terms.dictionary), 1)
    code = terms.indices.to_numpy().astype(np.int64)
    own, times = np.unique(part.doc * n_terms + code, return_counts=True)
    key = group[own // n_terms] * n_terms + own % n_terms
    found, back = np.unique(key, return_inverse=True)
    n = np.zeros(len(found), dtype=np.int64)
    np.add.at(n, back, times)
    docs = np.bincount(back, minlength=len(found))
    return found // n_terms, terms.dictionary.take(pa.array(found % n_terms)), n, docs


def count_terms(batches):
    """Counts of terms by group, added up inside the task before they are sent."""

    def tables():
        for b in batches:
            lang, source = (pc.fill_null(b.column(c), "").dictionary_encode() for c in ("lang", "source"))
            n_sources = max(len(source.dictionary), 1)
            group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
            for part in slices(b.column("text"), lower=True, gaps=NO_LETTER):
                g, term, n, docs = _counts(part, group[part.lo : part.lo + part.n_docs])
                names = [lang.dictionary.take(pa.array(g // n_sources)), source.dictionary.take(pa.array(g % n_sources))]
                columns = [*names, term, pa.array(n), pa.array(docs)]
                yield pa.table(columns, ["lang", "source", "term", "n", "docs"])

    yield from added_up(tables(), ("lang", "source", "term"), _PENDING)


def _cells(key, table):
    """Partial divergences of the pairs of one cell.

    Rows with a negative ``col`` name a group and its ``p`` for terms that it lacks;
    the others are terms that it has.
    """
    lang, i, j, _ = (k.as_py() for k in key)
    block, row, col, p = (table.column(c).to_numpy() for c in ("gb", "row", "col", "p"))
    head = col < 0
    n_terms = int(table.column("n_terms").filter(pa.array(head))[0].as_py())
    active, at = np.unique(col[~head], return_inverse=True)
    names = table.column("source")
    sides = {}
    for b in {i, j}:
        heads = np.flatnonzero(head & (block == b))
        heads = heads[np.argsort(row[heads])]
        dense = np.repeat(p[heads][:, None], len(active), axis=1)
        own = block[~head] == b
        dense[np.searchsorted(row[heads], row[~head][own]), at[own]] = p[~head][own]
        sides[b] = p[heads], dense, names.take(pa.array(heads))
    base, dense, left = sides[i]
    others, wide, right = sides[j]
    one, two, value = [], [], []
    for a in range(len(base)):
        first = a + 1 if i == j else 0
        if first >= len(others):
            continue
        q = wide[first:]
        shared = ((q - dense[a]) ** 2 // np.maximum(q + dense[a], 1)).sum(axis=1)
        rest = others[first:]
        lacking = (rest - base[a]) ** 2 // np.maximum(rest + base[a], 1)
        value.append(shared + (n_terms - len(active)) * lacking)
        one.append(np.full(len(q), a))
        two.append(np.arange(first, len(others)))
    if not value:
        return pa.table([[]] * 4, schema=_PARTIAL)
    value = np.concatenate(value)
    columns = [left.take(pa.array(np.concatenate(one))), right.take(pa.array(np.concatenate(two))), pa.array(value)]
    return pa.table([pa.array([lang] * len(value), pa.string()), *columns], schema=_PARTIAL)


_PARTIAL = pa.schema([("lang", pa.string()), ("one", pa.string()), ("two", pa.string()), ("value", pa.int64())])


def _p(n, total, v):
    """``1 + floor(SCALE * (n + 2) / (total + 2 v))``, exact; 0 where there are no terms."""
    share = F.expr(f"({SCALE}BD * (cast({n} AS decimal(20,0)) + 2)) div (cast({total} AS decimal(20,0)) + 2 * {v})")
    return F.when(F.col(v) > 0, F.lit(1) + share).otherwise(F.lit(0)).cast("long")


def _distance(p, q):
    """``floor((p - q)^2 / (p + q))``; both are at most a billion and one, so the square is a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _vocabulary(counts):
    """Kept terms with their count in the language, and V and N per language."""
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = materialise(kept.where(F.col("docs") >= MIN_DOCUMENTS).drop("docs"), "kept")
    return kept, kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))


def divergence(docs, ranks=TERM_RANKS):
    """How far the sources of a language differ, and which terms a source overuses.

    Returns ``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``: in part
    ``pair`` every other source of the language with the divergence summed over all
    kept terms, in part ``term`` the ``ranks`` terms by which a source exceeds its
    language most. Equal values are ranked by the item in UTF-8 order. Other
    columns of ``docs`` are not looked at.
    """
    named = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], "text"
    )
    found = named.mapInArrow(count_terms, _COUNTED)
    counts = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = materialise(counts, "counts")
    kept, totals = _vocabulary(counts)
    totals = materialise(totals, "totals")
    blocks = F.greatest(F.ceil(F.col("v") / TERM_BLOCK), F.lit(1)).cast("long")
    placed = kept.join(totals, "lang").withColumn("block", F.pmod(F.xxhash64("term"), blocks))
    order = Window.partitionBy("lang", "block").orderBy("term")
    placed = placed.select("lang", "term", "lang_n", "block", (F.row_number().over(order) - 1).cast("long").alias("col"))
    cells = materialise(counts.drop("docs").join(placed, ["lang", "term"]), "cells")

    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = materialise(named.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left"), "groups")
    languages = groups.groupBy("lang").agg(F.ceil(F.count("*") / GROUP_BLOCK).cast("long").alias("group_blocks"))
    languages = languages.join(totals, "lang", "left").select(
        "lang", "group_blocks", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("v", "lang_total")]
    )
    groups = groups.join(languages, "lang").withColumn("gb", F.pmod(F.xxhash64("source"), F.col("group_blocks")))
    order = Window.partitionBy("lang", "gb").orderBy("source")
    groups = groups.withColumns(
        {"row": (F.row_number().over(order) - 1).cast("long"), "total": F.coalesce("total", F.lit(0))}
    )
    groups = materialise(groups, "groups")
    entries = cells.join(groups, ["lang", "source"]).withColumn("p", _p("n", "total", "v"))

    pairs = _pairs(groups, entries, placed.groupBy("lang", "block").agg(F.count("*").alias("n_terms")))
    over = entries.withColumn("q", _p("lang_n", "lang_total", "v")).where("n > 0 AND p > q")
    terms = over.select("lang", "source", F.col("term").alias("item"), _distance("p", "q").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(columns).union(terms.withColumn("part", F.lit("term")).select(columns))
    )


def _pairs(groups, entries, term_blocks):
    """Every ordered pair of sources of a language with its divergence."""
    blocks = F.greatest(F.ceil(F.col("v") / TERM_BLOCK), F.lit(1)).cast("long")
    heads = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    heads = heads.join(term_blocks, ["lang", "block"], "left").select(
        "lang", "gb", "group_blocks", "block", "row", F.lit(-1).cast("long").alias("col"),
        F.lit(0).alias("zero"), "total", "v", "source", F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
    )
    heads = heads.withColumn("p", _p("zero", "total", "v"))
    slice_columns = ["lang", "gb", "group_blocks", "block", "row", "col", "p", "source", "n_terms"]
    nothing = {"source": F.lit(None).cast("string"), "n_terms": F.lit(None).cast("long")}
    slabs = heads.select(slice_columns).union(entries.withColumns(nothing).select(slice_columns))
    across = F.explode(F.sequence(F.lit(0).cast("long"), F.col("group_blocks") - 1))
    sent = slabs.withColumn("other", across).select(
        "lang", F.least("gb", "other").alias("i"), F.greatest("gb", "other").alias("j"), "block",
        "gb", "row", "col", "p", "source", "n_terms",
    )
    partial = sent.groupBy("lang", "i", "j", "block").applyInArrow(
        _cells, "lang string, one string, two string, value long"
    )
    whole = partial.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
    ways = F.array(
        F.struct(F.col("one").alias("source"), F.col("two").alias("item")),
        F.struct(F.col("two").alias("source"), F.col("one").alias("item")),
    )
    return whole.select("lang", F.explode(ways).alias("w"), "value").select("lang", "w.source", "w.item", "value")
