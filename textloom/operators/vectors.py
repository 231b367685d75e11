"""Exact nearest vectors in blocks: queries meet every part of the base, each part is one matrix product, and the parts' best are merged."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import shipped

#: Base vectors of a part, and queries that meet one part at once.
PART, QUERIES = 50_000, 10_000


def usable(df: DataFrame, vector: str, width: int = 64) -> DataFrame:
    """Rows whose vector has the width, no null or not-a-number, and is not all zero."""
    v = F.col(vector)
    return df.filter((F.size(v) == width) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x)) & F.exists(v, lambda x: x != 0))


def nearest(queries: DataFrame, base: DataFrame, k: int, same: bool | None = None, width: int = 64, digits: int = 6) -> DataFrame:
    """(query, id, similarity, place): the ``k`` base vectors of highest cosine, rounded to ``digits``, ties by id, the query's own id left out.

    Both tables have (id, key, vector). With ``same`` true only base rows of the query's key count, with false only those of another key. Unusable
    vectors take no part.
    """
    shipped(base.sparkSession)
    clean = lambda df: usable(df.select(F.col("id").cast("bigint"), F.col("key").cast("string"), F.col("vector").cast("array<float>")), "vector", width)
    parts, blocks = max(1, math.ceil(base.count() / PART)), max(1, math.ceil(queries.count() / QUERIES))
    own = lambda n, name, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int").alias(name)
    all_ = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    left = clean(base).select("*", own(parts, "part", 1), all_(blocks, "block"))
    right = clean(queries).select("*", own(blocks, "block", 2), all_(parts, "part"))

    def read(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flat = np.concatenate([c.flatten().to_numpy() for c in t["vector"].chunks]) if t.num_rows else np.zeros(0)
        v = flat.astype(np.float64).reshape(-1, width)
        return t["id"].to_numpy(), np.array(t["key"].to_pylist(), dtype=object), v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)

    def meet(b: pa.Table, q: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if b.num_rows and q.num_rows:
            (ids, keys, v), (qs, qkeys, w) = read(b), read(q)
            for s in range(0, len(qs), 256):
                sims = np.round(w[s : s + 256] @ v.T, digits)
                sims[qs[s : s + 256, None] == ids[None, :]] = -9
                if same is not None:
                    sims[(qkeys[s : s + 256, None] == keys[None, :]) != same] = -9
                bar = np.partition(sims, -min(k, sims.shape[1]), axis=1)[:, -min(k, sims.shape[1])]
                for i, (row, at_least) in enumerate(zip(sims, bar)):
                    near = np.flatnonzero((row >= at_least) & (row > -9))
                    near = near[np.lexsort((ids[near], -row[near]))][:k]
                    out[0].append(np.full(len(near), qs[s + i]))
                    out[1].append(ids[near])
                    out[2].append(row[near])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({n: pa.array(np.concatenate(x) if x else [], t) for n, x, t in zip(("query", "id", "similarity"), out, kinds)})

    found = left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(meet, "query bigint, id bigint, similarity double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "id"))
    return found.withColumn("place", place).filter(F.col("place") <= k)
