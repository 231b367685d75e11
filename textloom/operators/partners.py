"""The best partners within groups, without a row for each pair."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import shipped

#: Pairs and terms in common that are held at once in a task.
SLAB = 2_000_000


@dataclass(frozen=True)
class Score:
    """``of`` gives whole scores and which pairs count, from (terms in common, terms of either, tier, flags of either); ``both``: the lowest is sought too."""

    of: Callable[..., tuple[np.ndarray, np.ndarray]]
    both: bool = False


def shares(common: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return common / np.maximum(one + two - common, 1)


#: Terms in common; and their part of the terms of both, in billionths.
SHARED = Score(lambda common, *_: (common.astype(np.int64), np.ones(len(common), dtype=bool)))
ALIKE = Score(lambda common, one, two, *_: (np.floor(shares(common, one, two) * 1e9 + 0.5).astype(np.int64), np.ones(len(common), dtype=bool)), True)


def _found(rows: pa.Table, by: Score, earlier: bool) -> Iterator[pa.RecordBatch]:
    """(tier, id, most, near, least, far) of each row of whole groups: among the others of its group those of the highest and the lowest score, the lower
    id first. Rows are in order of (tier, g, term, i, j, own, id); where i <> j, a row meets those of the other block only."""
    ids, i, j, own, tier = (rows[c].to_numpy() for c in ("id", "i", "j", "own", "tier"))
    group = np.cumsum(_begins(rows)) - 1
    side = (own != i).astype(np.int64)
    sub = group * 2 + side
    other = group * 2 + np.where(i == j, 0, 1 - side)
    first, last = np.searchsorted(sub, other, "left"), np.searchsorted(sub, other, "right")
    if earlier:
        distinct, rank = np.unique(ids, return_inverse=True)
        last = np.searchsorted(sub * len(distinct) + rank, other * len(distinct) + rank, "left")
    many = last - first  # rows that each row meets
    flag = rows["flag"].to_numpy() if "flag" in rows.column_names else None
    terms = rows["w"].combine_chunks()
    terms = terms.chunk(0) if isinstance(terms, pa.ChunkedArray) else terms
    size = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    code = terms.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row, span = np.repeat(np.arange(len(ids)), size), int(code.max(initial=0)) + 1
    key = sub[row] * span + code
    order = np.argsort(key, kind="stable")
    posted, (known, begin, times) = row[order], np.unique(key[order], return_index=True, return_counts=True)
    want = other[row] * span + code
    place = np.minimum(np.searchsorted(known, want), max(0, len(known) - 1))
    if earlier:
        upto = np.searchsorted(key[order] * len(ids) + posted, want * len(ids) + last[row], "left")
        times = (upto - begin[place] if len(known) else upto).clip(0)
        hits = np.where(known[place] == want, times, 0) if len(known) else times
    else:
        hits = np.where(known[place] == want, times[place], 0) if len(known) else np.zeros(0, dtype=np.int64)
    cost = np.cumsum(many + np.bincount(row, weights=hits, minlength=len(ids)).astype(np.int64))
    lo = 0
    while lo < len(ids):
        hi = max(lo + 1, int(np.searchsorted(cost, (cost[lo - 1] if lo else 0) + SLAB, "right")))
        some, m = slice(at[lo], at[hi]), many[lo:hi]
        base = np.cumsum(m) - m
        n, r = hits[some], row[some]
        met = posted[np.repeat(begin[place[some]] - (np.cumsum(n) - n), n) + np.arange(n.sum())] if n.sum() else np.zeros(0, dtype=np.int64)
        common = np.bincount(np.repeat(base[r - lo] - first[r], n) + met, minlength=int(m.sum()))
        a = np.repeat(np.arange(lo, hi), m)
        b = np.arange(len(a)) - np.repeat(base - first[lo:hi], m)
        score, fit = by.of(common, size[a], size[b], tier[a], None if flag is None else flag[a], None if flag is None else flag[b])
        fit, full = fit & (a != b), np.flatnonzero(m > 0)
        out = []
        for sign in (1, -1) if by.both else (1,):
            s = np.where(fit, sign * score, np.iinfo(np.int64).min)
            top = np.maximum.reduceat(s, base[full]) if len(full) else s
            best = np.flatnonzero((s == np.repeat(top, m[full])) & fit)
            best = best[np.concatenate([[True], a[best][1:] != a[best][:-1]])] if len(best) else best
            out += [score[best], ids[b[best]]]
        if len(best):
            out = out if by.both else out * 2
            yield pa.RecordBatch.from_arrays([pa.array(tier[a[best]], pa.int32()), *[pa.array(x, pa.int64()) for x in (ids[a[best]], *out)]], names=["tier", "id", "most", "near", "least", "far"])
        lo = hi


def _begins(rows: pa.Table) -> np.ndarray:
    """Where a group begins."""
    new = np.zeros(rows.num_rows, dtype=bool)
    new[:1] = True
    for c in ("tier", "g", "term", "i", "j"):
        x = rows[c].combine_chunks()
        x = x.chunk(0) if isinstance(x, pa.ChunkedArray) else x
        k = x.dictionary_encode().indices.to_numpy(zero_copy_only=False) if pa.types.is_string(x.type) else x.to_numpy(zero_copy_only=False)
        new[1:] |= k[1:] != k[:-1]
    return new


def extremes(members: DataFrame, by: Score, block: int = 2000, earlier: bool = False) -> DataFrame:
    """(tier, id, most, near, least, far): for the members (tier, g, term, id, df, w, and a flag for some scores) of each group (tier, g, term), of df at
    most, the others with the highest and, for some scores, the lowest score; with ``earlier`` among those of lower ids. A member's terms ``w`` go once into
    each of its groups, so that no row is made for a pair; groups beyond ``block`` meet block by block."""
    shipped(members.sparkSession)
    cut = members.withColumn("of", F.ceil(F.col("df") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("id"), F.col("of")).cast("int"))
    w = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    keys = ["tier", "g", "term", "i", "j"]
    met = w.select("tier", "g", "term", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "w", *[c for c in members.columns if c == "flag"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            rows = pa.Table.from_batches([b])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows:
                end = int(np.flatnonzero(_begins(held))[-1])
                if end:
                    yield from _found(held.slice(0, end), by, earlier)
                    held = held.slice(end)
        if held is not None and held.num_rows:
            yield from _found(held, by, earlier)

    return met.repartition(*keys).sortWithinPartitions(*keys, "own", "id").mapInArrow(walk, "tier int, id bigint, most bigint, near bigint, least bigint, far bigint")
