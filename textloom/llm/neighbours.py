"""The most similar vectors of every query vector, from a vantage-point tree per shard.

Vectors are spread by hash over shards of bounded size. Each shard builds one tree: an inner node holds a vantage point and, for
either side, the nearest and farthest distance of its vectors; leaves are blocks. Queries descend together: a node
splits the queries that still need it, each visits its nearer side first, and a side is skipped when the triangle inequality rules
out anything nearer than the query's k-th best so far. ``factor`` relaxes the pruning: a side is skipped when its bound exceeds the
k-th best distance divided by the factor, so factor one is exact and larger factors skip more. The shards' answers are merged by query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import shipped

#: Vectors of a shard, of a leaf, and queries that are taken through a shard at once.
SHARD, LEAF, QUERIES = 25_000, 1024, 20_000
#: Places beyond k that a shard keeps while it compares in single precision; the order is settled in double precision.
SPARE = 4


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


class Tree:
    """A vantage-point tree over unit vectors; distances are Euclidean, so cosine order is distance order."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF, seed: int = 0) -> None:
        self.vectors, self.leaf = vectors.astype(np.float32), leaf
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(vectors)))

    def _build(self, at: np.ndarray):
        if len(at) <= self.leaf:
            return at
        # Of a few random points the one whose distances spread most is the vantage point.
        tries = self.rng.choice(at, min(5, len(at)), replace=False)
        some = self.vectors[self.rng.choice(at, min(200, len(at)), replace=False)]
        spread = [np.std(np.sqrt(np.maximum(0, 2 - 2 * some @ self.vectors[t]))) for t in tries]
        vantage = self.vectors[tries[int(np.argmax(spread))]]
        d = np.sqrt(np.maximum(0.0, 2 - 2 * (self.vectors[at] @ vantage)))
        middle = np.median(d)
        near = d <= middle
        if near.all():
            near = d < middle
            if not near.any():  # all as far: copies, one block
                return at
        sides = [(at[m], float(d[m].min()), float(d[m].max())) for m in (near, ~near)]
        return vantage, [(self._build(i), low, high) for i, low, high in sides]

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """(similarities, places) of the k best of each query, best first; missing places are -1."""
        self.q = queries.astype(np.float32)
        self.best = np.full((len(queries), k), -2.0, dtype=np.float32)
        self.where = np.full((len(queries), k), -1, dtype=np.int64)
        self._visit(self.root, np.arange(len(queries)), k, factor)
        order = np.argsort(-self.best, axis=1, kind="stable")
        return np.take_along_axis(self.best, order, 1), np.take_along_axis(self.where, order, 1)

    def _visit(self, node, who: np.ndarray, k: int, factor: float) -> None:
        if isinstance(node, np.ndarray):
            for s in range(0, len(who), 2048):
                self._leaf(node, who[s : s + 2048], k)
            return
        vantage, sides = node
        d = np.sqrt(np.maximum(0.0, 2 - 2 * (self.q[who] @ vantage)))
        bounds = [np.maximum(0.0, np.maximum(low - d, d - high)) for _, low, high in sides]
        first = bounds[0] <= bounds[1]
        for turn in (0, 1):
            for s, (child, _, _) in enumerate(sides):
                mine = first == (s == turn)
                if turn:
                    reach = np.sqrt(np.maximum(0.0, 2 - 2 * self.best[who].min(axis=1)))
                    mine &= bounds[s] <= reach / factor + 1e-4
                if mine.any():
                    self._visit(child, who[mine], k, factor)

    def _leaf(self, node: np.ndarray, who: np.ndarray, k: int) -> None:
        sims = self.q[who] @ self.vectors[node].T
        some = sims > self.best[who].min(axis=1)[:, None]
        rows = np.flatnonzero(some.any(axis=1))
        if not len(rows):
            return
        sims, who = sims[rows], who[rows]
        if sims.shape[1] > k:
            top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            sims, places = np.take_along_axis(sims, top, 1), node[top]
        else:
            places = np.broadcast_to(node, sims.shape)
        sims, places = np.hstack([self.best[who], sims]), np.hstack([self.where[who], places])
        top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        self.best[who], self.where[who] = np.take_along_axis(sims, top, 1), np.take_along_axis(places, top, 1)


def usable(df: DataFrame, vector_col: str, width: int) -> DataFrame:
    """Rows whose vector has the width, no null and no not-a-number in it and is not all zero."""
    v = F.col(vector_col)
    return df.filter((F.size(v) == width) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x)) & F.exists(v, lambda x: x != 0))


def _best(ids: np.ndarray, v: np.ndarray, tree: Tree, qs: np.ndarray, q: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """(similarities, ids) of the k best of each query in one shard, ordered by similarity, then id; missing places have -9.

    The tree compares in single precision; the places it finds beyond k settle the order in double precision. Where the last of them is as near as
    the k-th, more vectors may be equal, so the query is compared with the whole shard.
    """
    want = min(len(ids), k + 1 + SPARE)
    _, at = tree.search(q, want, factor)
    out_s, out_i = np.full((len(qs), k), -9.0), np.zeros((len(qs), k), dtype=np.int64)
    for s in range(0, len(qs), 4096):
        e = min(len(qs), s + 4096)
        places = at[s:e]
        sims, found = np.einsum("qd,qkd->qk", q[s:e], v[places]), ids[places]
        sims[(places < 0) | (found == qs[s:e, None])] = -9
        order = np.lexsort((found, -sims), axis=1)[:, :k]
        top_s, top_i = np.take_along_axis(sims, order, 1), np.take_along_axis(found, order, 1)
        if factor <= 1 and want < len(ids) and top_s.shape[1] == k:
            for i in np.flatnonzero(np.where(sims > -9, sims, 9).min(axis=1) >= top_s[:, -1] - 1e-5):
                all_s = v @ q[s + i]
                all_s[ids == qs[s + i]] = -9
                best = np.lexsort((ids, -all_s))[:k]
                top_s[i], top_i[i] = all_s[best], ids[best]
        out_s[s:e, : top_s.shape[1]], out_i[s:e, : top_i.shape[1]] = top_s, top_i
    return out_s, out_i


def nearest(queries: DataFrame, vectors: DataFrame, k: int, factor: float = 1.0, width: int = 64, shards: int | None = None) -> DataFrame:
    """(query, id, similarity, place): the ``k`` vectors of highest cosine to each query vector, the query's own id left out.

    Both tables have (id, vector); ids are unique, repeated ids are vectors of their own. Null, all-zero and other than ``width``-wide
    vectors take no part; equal similarities order by id. With factor one the result is exact. Fewer than k others give fewer
    rows; an empty table gives none.
    """
    shipped(vectors.sparkSession)
    clean = lambda df: usable(df.select(F.col("id").cast("bigint"), F.col("vector")), "vector", width)
    base, asked = clean(vectors), clean(queries)
    n = shards or max(1, math.ceil(vectors.count() / SHARD))
    # A shard's vectors come first and its queries stream after them, so that its tree is built once and no vector is sent twice.
    raw = F.col("vector").cast("array<float>").alias("vector")
    left = base.select("id", raw, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("shard"), F.lit(False).alias("asks"))
    right = asked.select("id", raw, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("shard"), F.lit(True).alias("asks"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("similarity", pa.float64())])
        now, held, tree, waiting = None, [], None, []

        def asked_of(waiting: list) -> Iterator[pa.RecordBatch]:
            ids, v, grown = tree
            qs, q = np.concatenate([x for x, _ in waiting]), np.concatenate([y for _, y in waiting])
            sims, found = _best(ids, v, grown, qs, q, k, factor)
            ok = sims > -9
            yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(qs[:, None], ok.shape)[ok]), pa.array(found[ok]), pa.array(sims[ok])], schema=schema)

        for b in batches:
            shard, asks, ids = (b.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "asks", "id"))
            v = unit(b.column("vector").flatten().to_numpy().reshape(-1, width)) if len(ids) else None
            cuts = [0, *(np.flatnonzero((shard[1:] != shard[:-1]) | (asks[1:] != asks[:-1])) + 1).tolist(), len(ids)] if len(ids) else []
            for s, e in zip(cuts, cuts[1:]):
                if shard[s] != now:
                    if waiting:
                        yield from asked_of(waiting)
                    now, held, tree, waiting = shard[s], [], None, []
                if not asks[s]:
                    held.append((ids[s:e], v[s:e]))
                    continue
                if held and tree is None:
                    every = np.concatenate([y for _, y in held])
                    tree, held = (np.concatenate([x for x, _ in held]), every, Tree(every)), []
                if tree is not None:
                    waiting.append((ids[s:e], v[s:e]))
                    if sum(len(x) for x, _ in waiting) >= QUERIES:
                        yield from asked_of(waiting)
                        waiting = []
        if waiting:
            yield from asked_of(waiting)

    both = left.unionByName(right).repartition(3 * n, "shard").sortWithinPartitions("shard", "asks")
    found = both.mapInArrow(answer, "query bigint, id bigint, similarity double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "id"))
    return found.withColumn("place", place).filter(F.col("place") <= k)
