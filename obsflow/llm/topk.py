"""Exact top-k search by inner product with M-trees.

Every component becomes an integer, so scores are exact. With one more component
that brings all candidates to the largest length R, the distance of a query to a
candidate is d^2 = |q|^2 + R^2 - 2 score: the nearest in this metric space are the
highest scores. Candidates are cut into blocks, and every block is an M-tree:
pages of leaf entries, and pages of nodes above them, each with a centre, a
covering radius and its distance to the centre of its parent. A query searches
a tree best first, the page with the highest possible score next, and stops
when no page can reach the k-th score found so far. Before a distance is computed, the
stored distance to the parent bounds it by the triangle inequality:
|d(q, parent) - d(x, parent)| <= d(q, x).

Queries meet the trees in blocks of rows, never row by row, and a tree returns
at most k rows for a query.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from obsflow.llm.blocks import pack, shipped, unpack

PAGE = 256
FANOUT = 16
BLOCK = 8192
QUERY_BLOCK = 1024
#: Distances are computed in doubles; bounds are widened by this share of the scale.
_SLACK = 1e-9


def _lift(vectors, square):
    """Vectors with one more component, so that all have the squared length ``square``."""
    rest = np.maximum(square - np.einsum("ij,ij->i", vectors, vectors), 0)
    return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)


def _distances(centre, points):
    return np.sqrt(np.maximum(((points - centre) ** 2).sum(axis=1), 0))


class Tree:
    """An M-tree over lifted vectors, built top down with bounded pages."""

    def __init__(self, points, seed=0):
        self.points = points
        self.centres, self.radii, self.parent_distance = [], [], []
        self.children, self.members, self.member_distance = [], [], []
        random = np.random.default_rng(seed)
        if len(points):
            self._build(np.arange(len(points)), points.mean(axis=0), None, random)

    def _build(self, own, centre, above, random):
        me = len(self.centres)
        distance = _distances(centre, self.points[own])
        self.centres.append(centre)
        self.radii.append(float(distance.max()))
        self.parent_distance.append(0.0 if above is None else float(_distances(above, centre[None])[0]))
        self.children.append([])
        self.members.append(None)
        self.member_distance.append(None)
        if len(own) > PAGE:
            pivots = self.points[random.choice(own, min(FANOUT, -(-len(own) // PAGE) * 2), replace=False)]
            square = (pivots**2).sum(axis=1) - 2 * self.points[own] @ pivots.T
            nearest = square.argmin(axis=1)
            parts = [own[nearest == i] for i in range(len(pivots))]
            if max(map(len, parts)) == len(own):  # equal vectors: any cut will do
                parts = np.array_split(own, len(pivots))
            self.children[me] = [
                self._build(p, self.points[p].mean(axis=0), centre, random) for p in parts if len(p)
            ]
            return me
        order = np.argsort(distance, kind="stable")
        self.members[me], self.member_distance[me] = own[order], distance[order]
        return me

    def search(self, query, score_of, ids, k, skip, square, slack):
        """The k best (score, id) of one query; ``square``: |q|^2 + R^2, ``slack``: widening of bounds."""
        if not self.centres:
            return []
        best, visits = [], 0  # a heap of (score, -id), the worst first

        def reach():
            """Nothing farther than this can enter the result."""
            return np.inf if len(best) < k else np.sqrt(max(square - 2 * best[0][0], 0)) + slack

        root = float(_distances(query, self.centres[0][None])[0])
        heap = [(max(root - self.radii[0], 0), 0, root)]
        while heap:
            least, node, distance = heapq.heappop(heap)
            if least > reach() + slack:
                break
            visits += 1
            if self.members[node] is None:
                limit = reach()
                near = [c for c in self.children[node] if abs(distance - self.parent_distance[c]) - self.radii[c] <= limit + slack]
                if near:
                    found = _distances(query, np.array([self.centres[c] for c in near]))
                    for c, d in zip(near, found):
                        if d - self.radii[c] <= limit + slack:
                            heapq.heappush(heap, (max(d - self.radii[c], 0), c, float(d)))
                continue
            limit = reach() + slack
            own, far = self.members[node], self.member_distance[node]
            lo, hi = np.searchsorted(far, [distance - limit, distance + limit + slack])
            own = own[lo:hi]
            # Before the cut: a repeated id of the query has many rows, and none may take a place.
            own = own[ids[own] != skip]
            if not len(own):
                continue
            scores = score_of(own)
            if len(best) == k:
                good = scores >= best[0][0]
                own, scores = own[good], scores[good]
            order = np.lexsort((ids[own], -scores))[:k]
            for i in order:
                entry = (int(scores[i]), -int(ids[own[i]]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _padded(rows, width):
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _block_rows(size):
    """Task side: vectors of a partition packed by ``size``."""

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, size):
                part = b.slice(lo, size)
                vectors = [np.array(v, dtype=np.int64) for v in part.column("v").to_pylist()]
                width = max(map(len, vectors))
                yield pa.record_batch(
                    [
                        pa.array([pack(part.column("id").to_numpy(zero_copy_only=False))], type=pa.binary()),
                        pa.array([pack(_padded(vectors, width))], type=pa.binary()),
                        pa.array([width], type=pa.int32()),
                    ],
                    names=["ids", "vectors", "width"],
                )

    return run


def _search(k, square):
    """Task side: all queries of a block against the tree of a block."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                width = max(row["q_width"], row["width"])
                ids, queries = unpack(row["ids"], np.int64), unpack(row["q_ids"], np.int64)
                vectors = np.pad(unpack(row["vectors"], np.int64).reshape(len(ids), -1), ((0, 0), (0, width - row["width"])))
                asked = np.pad(unpack(row["q_vectors"], np.int64).reshape(len(queries), -1), ((0, 0), (0, width - row["q_width"])))
                # Sums below 2**53 are exact in doubles, where products are much faster.
                largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(asked).max(initial=0)) * width
                exact = largest < 2.0**53
                rows = vectors.astype(np.float64) if exact else vectors
                tree = Tree(_lift(vectors.astype(np.float64), square))
                lifted = np.concatenate([asked.astype(np.float64), np.zeros((len(asked), 1))], axis=1)
                out = [[], [], []]
                for q, vector, point in zip(queries, asked, lifted):
                    own = vector.astype(rows.dtype)
                    total = float(point @ point) + square
                    slack = _SLACK * np.sqrt(max(total, 1.0)) + _SLACK * max(total, 1.0) / np.sqrt(max(total, 1.0))
                    found = tree.search(point, lambda at: rows[at] @ own, ids, k, q, total, slack)
                    out[0] += [int(q)] * len(found)
                    out[1] += [i for _, i in found]
                    out[2] += [s for s, _ in found]
                yield pa.record_batch([pa.array(x, type=pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors, queries, k=5, id="vec_id", vector="embedding", scale=256, block=BLOCK):
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the ``k`` best candidates of each query.

    ``queries`` and ``vectors`` have columns ``id`` and ``vector``. A component x
    counts as floor(``scale`` * x); the score is the inner product, ties go to the
    smaller id, and a query is not its own candidate. With fewer candidates than
    ``k`` all are returned.

    Vectors that are null, empty, or hold a null or non-finite component take no
    part, nor do rows without an id. Vectors of unequal length are padded with
    zeros. Rows that repeat an id are candidates each; a repeated query row
    is asked once. Columns other than the two are not read.
    """
    spark = shipped(vectors.sparkSession)

    def whole(df):
        x = F.transform(F.col(vector), lambda c: c.cast("double"))
        fine = (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
        floor = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
        return df.where(F.col(id).isNotNull() & fine).select(F.col(id).cast("long").alias("id"), floor.alias("v"))

    def blocks(df, size):
        return df.mapInArrow(_block_rows(size), "ids binary, vectors binary, width int")

    def length(column):
        return F.aggregate(column, F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))

    candidates = whole(vectors)
    square = candidates.agg(F.max(length(F.col("v")))).first()[0] or 0.0
    asked = whole(queries).dropDuplicates(["id"])
    trees = blocks(candidates, block).withColumn("tree", F.monotonically_increasing_id())
    asks = blocks(asked, QUERY_BLOCK).select(*(F.col(c).alias(f"q_{c}") for c in ("ids", "vectors", "width")))
    # Every query block goes to every part of the trees, and meets the trees there: the search is over all rows.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trees = trees.withColumn("part", F.pmod(F.xxhash64("tree"), F.lit(parts)).cast("int")).drop("tree")
    asks = asks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = trees.join(asks.hint("shuffle_merge"), "part")
    found = met.mapInArrow(_search(k, square), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
