"""Groups of records that share most of their content.

One-permutation hashing: every element of a record's set is hashed once, the hash range is cut into bins and each bin keeps its
smallest hash; an empty bin borrows from the first filled bin of a probe sequence that depends on the bin and the attempt only
(optimal densification), so two sets agree in a bin with the probability of their Jaccard similarity. A bin is a band; the permutation is
drawn anew for each of the rows of a band, which keeps the bins no more than the elements. Records with an equal band fall into one
bucket. A small bucket yields its few pairs; a larger one yields star-shaped candidate edges, each member with the smallest one,
so its pairs are bounded by its members, and where the verified stars leave it in several parts, the pairs across the parts follow,
so that the stars lose no link.

Words that a twentieth of the records have say little and make unlike records collide, so they are set aside before hashing
where enough other words remain; a record of mostly such words is hashed whole, with longer bands, and one in between both ways.
The similarity of what remains may be far below that of the whole sets, so sets of words also meet by every two of their rarest
words, as many of which are taken as any pair at the threshold needs to have two in common: no such pair is left to chance.

Candidates pass two exact tests: they must share several words of their rare prefixes (any pair at the threshold does), and their whole
sets must reach the threshold. A task's exact copies are taken together before anything is shuffled.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.components import components
from textloom.session import shipped, stored

#: Bands, and bins of a band without the frequent words and with them. Pairs of which s is the similarity in what is hashed share a band with
#: probability 1 - (1 - s**rows)**bands: without the frequent words 0.995 at 0.62 and 0.99997 at 0.7, whole 0.95 at 0.7 and 0.998 at 0.76.
BANDS, ROWS, WHOLE = 56, 5, (72, 9)
#: Share of all records from which an element is set aside; a record is hashed without such elements if at least LEFT[0] of its
#: elements remain, and whole if less than LEFT[1] do.
FREQUENT, LEFT = 0.05, (0.12, 0.2)
#: A bucket of at most so many members yields all its pairs.
SMALL = 10
#: Entries of one band that one task holds at once.
HELD = 4_000_000
#: Bytes of packs that one task reads, about.
TASK_BYTES = 16_000_000
#: Share of all records from which a word's frequency is known to the order of rare words; others count as rarer. The order decides only what
#: the prefix test and the meeting by rare words cost: they are exact under any order.
KNOWN = 0.0002
#: Elements that the rare prefixes of two sets at the threshold share.
SHARED = 4
#: Members of one bucket that one task pairs across parts; larger buckets are paired by parts of this size.
PART = 4_000
#: Sets of more words meet by single rare words, as the pairs of words grow with the square of the set.
LONG = 100
#: Pairs of rare words a set has, about, and entries of them that one part holds.
RARE, RARE_HELD = 150, 1_500_000
#: Words whose hashes, or counts, a task remembers.
REMEMBERED = 500_000
#: What is no part of a word: characters beyond ASCII, and bytes, which are made blanks.
ODD, BLANKED = re.compile(r"[^\w\x00-\x7f]"), bytes(i if i > 127 or chr(i).isalnum() else 32 for i in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x.astype(np.uint64) * _MIX) ^ np.uint64(seed * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def words_of(text: str | None) -> list[bytes]:
    """A text's words (runs of letters and digits, lower-cased) in UTF-8. Null texts have none."""
    low = text.lower() if text else ""
    if not low.isascii():
        low = ODD.sub(" ", low)
    return low.encode().translate(BLANKED).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


class Elements:
    """Hashes of a text's distinct words, or of its distinct runs of ``n`` words; a text of fewer words is one run."""

    def __init__(self, n: int = 1) -> None:
        self.n, self.known = n, _Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words, known = words_of(text), self.known
        if self.n == 1:
            words = set(words)
        if len(known) > REMEMBERED:
            known.clear()
        x = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if self.n > 1 and len(x):
            with np.errstate(over="ignore"):
                runs = np.zeros(max(1, len(x) - self.n + 1), dtype=np.uint64)
                for i in range(min(self.n, len(x))):
                    runs = runs * _MIX + x[i : i + len(runs)]
            return np.unique(_mixed(runs, 9))
        return x


@lru_cache(10_000)
def _probes(bins: int, seed: int, attempt: int) -> np.ndarray:
    """How far from each bin lies the one that it borrows from at an attempt."""
    at = np.arange(bins, dtype=np.uint64)
    return ((_mixed(at, 1000 + attempt + 100_003 * seed) >> np.uint64(33)) % np.uint64(bins)).astype(np.int64) - at.astype(np.int64)


def signatures(values: np.ndarray, offsets: np.ndarray, bins: int, seed: int = 0) -> np.ndarray:
    """One densified signature (32 bits a bin) of each non-empty set values[offsets[i]:offsets[i+1]]."""
    n = len(offsets) - 1
    h = _mixed(values, 1 + 100_003 * seed)
    record = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    none = np.uint32(0xFFFFFFFF)
    at = record * bins + ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    low = np.minimum((h & np.uint64(0xFFFFFFFF)).astype(np.uint32), none - np.uint32(1))
    flat = np.full(n * bins, none, dtype=np.uint32)
    np.minimum.at(flat, at, low)
    empty = np.flatnonzero(flat == none)
    out, attempt = flat.copy(), 0
    within = empty % bins
    while len(empty):
        attempt += 1
        got = out[empty] = flat[empty + _probes(bins, seed, attempt)[within]]
        still = np.flatnonzero(got == none)
        empty, within = empty[still], within[still]
    return out.reshape(n, bins)


def banded(values: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(bands, records) 32-bit keys."""
    n = len(offsets) - 1
    out = np.empty((bands, n), dtype=np.uint32)
    weights = _mixed(np.arange(rows, dtype=np.uint64), 77) | np.uint64(1)
    for s in range(0, n, 1000):
        e = min(n, s + 1000)
        mixed = np.zeros((e - s, bands), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for r in range(rows):
                mixed += signatures(values[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s], bands, r) * weights[r]
        out[:, s:e] = (_mixed(mixed, 5) >> np.uint64(32)).astype(np.uint32).T
    return out


def rarest_first(values: np.ndarray, offsets: np.ndarray, known: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Each set's elements in one order for all sets, from the rarest on. ``known`` are frequent elements, sorted, and ``often`` how frequent;
    all others count as rarer."""
    n, order = len(offsets) - 1, np.argsort(values)
    if len(known):
        x = values[order]
        at = np.minimum(np.searchsorted(known, x), len(known) - 1)
        found = known[at] == x
        rank = np.empty(len(known), dtype=np.int64)
        rank[np.lexsort((known, often))] = np.arange(len(known))
        order = np.r_[order[~found], order[found][np.argsort(rank[at[found]])]]
    # Sixteen bits are sorted in linear time.
    record = np.repeat(np.arange(n, dtype=np.uint16 if n <= 65536 else np.int64), np.diff(offsets))
    return values[order[np.argsort(record[order], kind="stable")]]


def prefixes(ordered: np.ndarray, offsets: np.ndarray, threshold: float) -> list[bytes]:
    """16-bit hashes of the rarest elements of each set, so many that two sets at the threshold share SHARED of them, led by how many a small set
    has to share. The sets are ``ordered`` from their rarest elements on."""
    n = np.diff(offsets)
    record = np.repeat(np.arange(len(n)), n)
    least = np.ceil(threshold * n - 1e-9).astype(np.int64)
    length = np.minimum(n, n - least + SHARED)
    need = np.minimum(SHARED, least).astype("<u2")
    inside = np.arange(len(ordered)) - np.repeat(offsets[:-1], n) < length[record]
    short = (_mixed(ordered[inside], 3) >> np.uint64(48)).astype("<u2")
    ends = np.r_[0, np.cumsum(length)]
    return [m.tobytes() + short[s:e].tobytes() for m, s, e in zip(need, ends[:-1], ends[1:])]


def rare_keys(values: np.ndarray, offsets: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys (record, 64-bit hash, reach) by which any two sets at the threshold meet, first of pairs of elements, then of single ones. ``values``
    are in the order of rarest_first. ``reach`` is the largest size of a partner that the key serves.

    Sets of sizes x and y at the threshold share at least o = threshold / (1 + threshold) * (x + y) elements. So the second of the shared
    elements has at least o - 2 after it in both sets, and the first o - 1: a key that ends at place j of a set of x serves partners
    with o <= x - j + 1, or o <= x - j if it is a single element. Pairs of elements serve two sets of at most LONG elements,
    single ones those with a longer set, and sets so small that one element is enough."""
    n = np.diff(offsets)
    portion = threshold / (1 + threshold)
    least = np.ceil(threshold * n - 1e-9).astype(np.int64)

    def keys(record: np.ndarray, first: np.ndarray, last: np.ndarray, spare: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        base = offsets[:-1][record]
        with np.errstate(over="ignore"):
            h = _mixed(values[base + first] * _MIX + values[base + last], 13)
        x = n[record]
        reach = np.floor((x - last + spare) / portion + 1e-9).astype(np.int64) - x
        return record, h, reach

    length = np.where(n <= LONG, np.minimum(n, n - least + 2), 0)
    counts = length * (length - 1) // 2
    record = np.repeat(np.arange(len(n)), counts)
    # Pair q of a set, ordered by its later element: q = last * (last - 1) / 2 + first.
    last_of = np.repeat(np.arange(LONG + 2), np.arange(LONG + 2))
    q = np.arange(len(record)) - np.repeat(np.cumsum(counts) - counts, counts)
    last = last_of[q]
    yield keys(record, q - last * (last - 1) // 2, last, 1)

    beyond = n - np.ceil(portion * (n + LONG + 1) - 1e-9).astype(np.int64) + 1  # of a set that only meets longer ones this way
    single = np.where(threshold * n <= 1 + 1e-9, n, np.where(n > LONG, np.minimum(n, n - least + 1), np.where(n >= threshold * (LONG + 1) - 1e-9, np.clip(beyond, 0, n), 0)))
    record = np.repeat(np.arange(len(n)), single)
    place = np.arange(len(record)) - np.repeat(np.cumsum(single) - single, single)
    yield keys(record, place, place, 0)


def hubs(sizes: np.ndarray, reach: np.ndarray, single: bool, threshold: float) -> np.ndarray:
    """Entries of rare_keys of which every pair has one: those that reach a partner of their own size, as the smaller set's do, or, of single
    elements, those of the sets that these serve."""
    return (sizes > LONG) | (threshold * sizes <= 1 + 1e-9) if single else reach >= sizes


def shared(h: np.ndarray, hub: np.ndarray | None = None) -> np.ndarray:
    """Places of the entries whose key another entry has too, by key. Given the hubs, keys without one are left out."""
    order = np.argsort(h)
    if len(h):
        key = h[order]
        same = key[1:] == key[:-1]
        order = order[np.r_[False, same] | np.r_[same, False]]
    if hub is not None and len(order):
        key = h[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        order = order[np.repeat(np.logical_or.reduceat(hub[order], starts), np.diff(np.r_[starts, len(order)]))]
    return order


def rare_pairs(h: np.ndarray, ids: np.ndarray, sizes: np.ndarray, reach: np.ndarray, hub: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
    """Pairs (smaller ids, larger ids, None) of entries with one key and within each other's reach, at least one of them a hub. Of a key with
    more than SMALL hubs come (its smallest id, the others, key)."""
    order = shared(h, hub)
    if not len(order):
        return
    order = order[np.lexsort((ids[order], h[order]))]
    h, ids, sizes, reach, hub = h[order], ids[order], sizes[order], reach[order], hub[order]
    starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    lengths, hubs = np.diff(np.r_[starts, len(h)]), np.add.reduceat(hub.astype(np.int64), starts)

    def met(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, None]:
        near = (hub[x] | hub[y]) & (sizes[x] <= reach[y]) & (sizes[y] <= reach[x]) & (ids[x] != ids[y])
        x, y = ids[x[near]], ids[y[near]]
        return np.minimum(x, y), np.maximum(x, y), None

    for length in range(2, SMALL + 1):
        s = starts[lengths == length]
        if len(s):
            for i in range(length):
                for j in range(i + 1, length):
                    yield met(s + i, s + j)
    for i in np.flatnonzero(lengths > SMALL):
        every = np.arange(starts[i], starts[i] + lengths[i])
        if hubs[i] <= SMALL:
            mine = every[hub[every]]
            yield met(np.repeat(mine, len(every)), np.tile(every, len(mine)))
        else:
            yield np.full(lengths[i] - 1, ids[starts[i]]), ids[every[1:]], int(h[starts[i]])


def _frequent(texts: DataFrame, n: int, records: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words that at least KNOWN of all records have, sorted by hash, how many have them, and which are to be set aside. They are at most as many
    as the words of an average record divided by KNOWN, however many records there are. Runs of several words are too rare to be set aside."""
    if n > 1 or not records:
        return np.array([], dtype=np.uint64), np.array([], dtype=np.int64), np.array([], dtype=bool)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()

        def counted() -> pa.RecordBatch:
            words = np.fromiter(map(xxhash.xxh64_intdigest, counts), np.uint64, len(counts)).view(np.int64)
            many = np.fromiter(counts.values(), np.int64, len(counts))
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(many)], names=["word", "n"])

        for b in batches:
            for text in b.column("text").to_pylist():
                counts.update(set(words_of(text)))
                if len(counts) > REMEMBERED:
                    yield counted()
        yield counted()

    counts = texts.select("text").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"] % 2**64: r["n"] for r in counts.filter(F.col("n") >= max(2, KNOWN * records)).toLocalIterator()}
    known = np.array(sorted(found), dtype=np.uint64)
    often = np.array([found[w] for w in known.tolist()], dtype=np.int64)
    return known, often, often >= FREQUENT * records


def _candidates(texts: DataFrame, n: int, bands: int, rows: int, threshold: float) -> DataFrame:
    """Rows (a, b, bucket, prefix): a pair to verify has no bucket and no prefix, an exact copy bucket 0; in a large bucket a is its
    smallest member and b another. A row with a prefix gives that of record a."""
    count = texts.count()
    splits = max(1, math.ceil(count / HELD))
    known, often, aside = _frequent(texts, n, count)
    frequent = known[aside]
    packed = pa.schema([("key", pa.int32()), ("payload", pa.binary())])
    # Keys of bands, then of parts of pairs of rare words, then of parts of single ones. Runs of words have neither: nothing of them is set aside.
    bands_end, parts = (bands + WHOLE[0]) * splits, math.ceil(count * RARE / RARE_HELD) if n == 1 else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        elements, seen = Elements(n), {}

        def emit(ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            keys, payloads, copies, own = [], [], [], []
            by_id = sorted(range(len(ids)), key=ids.__getitem__)
            n_ids, sizes = np.array([ids[i] for i in by_id], dtype=np.int64), np.array([len(sets[i]) for i in by_id])
            values, starts = np.concatenate([sets[i] for i in by_id]), np.cumsum(sizes) - sizes
            for k in zip(n_ids.tolist(), sizes.tolist(), *(np.add.reduceat(_mixed(values, seed), starts).tolist() for seed in (11, 12))):
                first = seen.setdefault(k[1:], k[0])
                own.append(first == k[0])
                if first != k[0]:
                    copies.append((min(first, k[0]), max(first, k[0])))
            if len(seen) > 1_000_000:
                seen.clear()
            if copies:
                keys.append(-1)
                payloads.append(np.array(copies, dtype="<i8").tobytes())
            if any(own):
                values, n_ids, sizes = values[np.repeat(own, sizes)], n_ids[own], sizes[own]
                offsets, n_sizes = np.r_[0, np.cumsum(sizes)].astype(np.int64), np.minimum(sizes, 65535).astype("<u2")
                ordered = rarest_first(values, offsets, known, often)
                rare = prefixes(ordered, offsets, threshold)
                keys.append(-2)
                lengths = np.array([len(x) for x in rare], dtype="<u4")
                payloads.append(len(sizes).to_bytes(4, "little") + n_ids.astype("<i8").tobytes() + lengths.tobytes() + b"".join(rare))
                # Keys of some records at a time, so that a task holds no more of them than a part does.
                about = np.cumsum(np.where(sizes <= LONG, sizes * sizes // 20, sizes // 3) + 1)
                cuts = np.unique(np.r_[0, np.searchsorted(about, np.arange(RARE_HELD, about[-1], RARE_HELD)), len(sizes)]) if parts else []
                for s, e in zip(cuts[:-1], cuts[1:]):
                    for way, (of, h, reach) in enumerate(rare_keys(ordered[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s], threshold)):
                        part = ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.uint16 if parts < 65536 else np.int64)
                        order = np.argsort(part, kind="stable")
                        ends = np.cumsum(np.bincount(part, minlength=parts))
                        for p, at in enumerate(np.split(order, ends[:-1])):
                            if len(at):
                                runs = np.flatnonzero(np.diff(of[at], prepend=-1))
                                mine, often_in = s + of[at[runs]], np.diff(np.r_[runs, len(at)]).astype("<u4")
                                steps = np.diff(n_ids[mine], prepend=0).astype("<i8")
                                body = len(runs).to_bytes(4, "little") + steps.tobytes() + n_sizes[mine].tobytes() + often_in.tobytes()
                                body = zlib.compress(body + np.minimum(reach[at], 65535).astype("<u2").tobytes(), 1)
                                keys.append(bands_end + way * parts + p)
                                payloads.append(len(at).to_bytes(4, "little") + h[at].astype("<u4").tobytes() + body)
                other = np.ones(len(values), dtype=bool)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
                    other = frequent[at] != values
                left = np.add.reduceat(other.astype(np.int64), offsets[:-1])
                ways = [(0, bands, rows, left >= np.maximum(1, LEFT[0] * sizes), other), (bands, *WHOLE, left < LEFT[1] * sizes, np.ones(len(values), dtype=bool))]
                record = np.repeat(np.arange(len(sizes)), sizes)
                for base, many, length, mine, kept in ways:
                    if not mine.any():
                        continue
                    kept = kept & mine[record]
                    counts = np.bincount(record[kept], minlength=len(sizes))[mine]
                    of_ids, of_sizes = n_ids[mine], n_sizes[mine]
                    for band, h in enumerate(banded(values[kept], np.r_[0, np.cumsum(counts)].astype(np.int64), many, length)):
                        part = h % np.uint32(splits)
                        for p in range(splits):
                            at = np.flatnonzero(part == p) if splits > 1 else slice(None)
                            steps = np.diff(of_ids[at], prepend=0).astype("<i8")
                            body = zlib.compress(steps.tobytes() + of_sizes[at].tobytes(), 1)
                            keys.append((base + band) * splits + p)
                            payloads.append(len(steps).to_bytes(4, "little") + h[at].astype("<u4").tobytes() + body)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(payloads, pa.binary())], schema=packed)

        ids, sets, before = [], [], set()
        for b in batches:
            for i, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                x = elements(text)
                if len(x) and i not in before:
                    ids.append(i)
                    sets.append(x)
                    before.add(i)
                if len(ids) >= 20_000:
                    yield emit(ids, sets)
                    ids, sets, before = [], [], set()
        if ids:
            yield emit(ids, sets)

    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("bucket", pa.int64()), ("prefix", pa.binary())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(a, b, bucket, prefix=None) -> pa.RecordBatch:
            bucket = pa.array(bucket, pa.int64(), mask=bucket < 0)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), bucket, pa.nulls(len(a), pa.binary()) if prefix is None else prefix], schema=out)

        pairs: set[tuple[int, int]] = set()

        def close_rare(key: int, held: list[bytes]) -> Iterator[pa.RecordBatch]:
            hs, ids, sizes, reach = [], [], [], []
            for p in held:
                m = int.from_bytes(p[:4], "little")
                body = zlib.decompress(p[4 + 4 * m :])
                runs = int.from_bytes(body[:4], "little")
                often_in = np.frombuffer(body, "<u4", runs, 4 + 10 * runs)
                hs.append(np.frombuffer(p, "<u4", m, 4))
                ids.append(np.repeat(np.cumsum(np.frombuffer(body, "<i8", runs, 4)), often_in))
                sizes.append(np.repeat(np.frombuffer(body, "<u2", runs, 4 + 8 * runs), often_in))
                reach.append(np.frombuffer(body, "<u2", m, 4 + 14 * runs))
            h, ids, sizes, reach = np.concatenate(hs), np.concatenate(ids), np.concatenate(sizes).astype(np.int64), np.concatenate(reach).astype(np.int64)
            for a, b, bucket in rare_pairs(h, ids, sizes, reach, hubs(sizes, reach, key >= bands_end + parts, threshold)):
                if bucket is not None:
                    yield rows_of(a, b, np.full(len(a), (key << 32) + bucket + 1))
                    continue
                pairs.update(zip(a.tolist(), b.tolist()))
                if len(pairs) > 500_000:
                    yield from flush()

        def close(key: int, held: list[bytes]) -> Iterator[pa.RecordBatch]:
            if key >= bands_end:
                yield from close_rare(key, held)
                return
            hs, ids, sizes = [], [], []
            for p in held:
                m = int.from_bytes(p[:4], "little")
                body = zlib.decompress(p[4 + 4 * m :])
                hs.append(np.frombuffer(p, "<u4", m, 4))
                ids.append(np.cumsum(np.frombuffer(body, "<i8", m)))
                sizes.append(np.frombuffer(body, "<u2", m, 8 * m))
            h, ids, sizes = np.concatenate(hs), np.concatenate(ids), np.concatenate(sizes).astype(np.int64)
            order = shared(h)
            if not len(order):
                return
            order = order[np.lexsort((ids[order], h[order]))]
            h, ids, sizes = h[order], ids[order], sizes[order]
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            lengths = np.diff(np.r_[starts, len(h)])
            for length in range(2, SMALL + 1):
                s = starts[lengths == length]
                for i in range(length):
                    for j in range(i + 1, length):
                        x, y = s + i, s + j
                        near = (np.minimum(sizes[x], sizes[y]) >= threshold * np.maximum(sizes[x], sizes[y]) - 1e-9) & (ids[x] != ids[y])
                        pairs.update(zip(ids[x[near]].tolist(), ids[y[near]].tolist()))
            for s, length in zip(starts[lengths > SMALL], lengths[lengths > SMALL]):
                yield rows_of(np.full(length - 1, ids[s]), ids[s + 1 : s + length], np.full(length - 1, (key << 32) + int(h[s]) + 1))
            if len(pairs) > 500_000:
                yield from flush()

        def flush() -> Iterator[pa.RecordBatch]:
            if pairs:
                x = np.array(list(pairs), dtype=np.int64)
                pairs.clear()
                yield rows_of(x[:, 0], x[:, 1], np.full(len(x), -1))

        held, now = [], None
        for b in batches:
            for key, payload in zip(b.column("key").to_pylist(), b.column("payload").to_pylist()):
                if key == -1:
                    x = np.frombuffer(payload, "<i8").reshape(-1, 2)
                    yield rows_of(x[:, 0], x[:, 1], np.zeros(len(x), dtype=np.int64))
                    continue
                if key == -2:
                    m = int.from_bytes(payload[:4], "little")
                    ids, lengths = np.frombuffer(payload, "<i8", m, 4), np.frombuffer(payload, "<u4", m, 4 + 8 * m)
                    ends = np.r_[0, np.cumsum(lengths)].astype(np.int32)
                    prefix = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(payload[4 + 12 * m :])])
                    yield rows_of(ids, ids, np.full(m, -1), prefix)
                    continue
                if key != now and held:
                    yield from close(now, held)
                    held = []
                now = key
                held.append(payload)
        if held:
            yield from close(now, held)
        yield from flush()

    packs = texts.mapInArrow(pack, "key int, payload binary")
    tasks = min(bands_end, max(bands_end // 10, math.ceil(count * bands * 7 / TASK_BYTES))) + min(parts, math.ceil(count * RARE * 6 / TASK_BYTES))
    # The packs of a band or part go to one task, each task having as many; prefixes and copies, keyed below 0, are spread.
    spread = F.when(F.col("key") < 0, F.pmod(F.xxhash64("payload"), F.lit(tasks))).otherwise(F.pmod("key", F.lit(tasks)))
    return packs.repartitionById(tasks, spread.cast("int")).sortWithinPartitions("key").mapInArrow(meet, "a bigint, b bigint, bucket bigint, prefix binary")


def _share(pairs: DataFrame, prefix: DataFrame) -> DataFrame:
    """Pairs (a, b) whose prefixes have as many elements in common as the sets need; one less is let pass, as two elements may have one
    16-bit hash."""

    def meets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(b.column("pa").to_pylist(), b.column("pb").to_pylist())
            keep = []
            for x, y in rows:
                x, y = memoryview(x).cast("H"), memoryview(y).cast("H")
                keep.append(len(set(x[1:]).intersection(y[1:])) >= max(1, min(x[0], y[0]) - 1))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Pairs and prefixes grow with the records, so they meet by shuffle at every size.
    with_a = pairs.join(prefix.select("a", F.col("prefix").alias("pa")).hint("merge"), "a")
    both = with_a.join(prefix.select(F.col("a").alias("b"), F.col("prefix").alias("pb")).hint("merge"), "b").select("a", "b", "pa", "pb")
    return both.mapInArrow(meets, "a bigint, b bigint")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """Pairs whose whole sets reach the threshold. ``texts`` has one row an id."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        elements, seen = Elements(n), {}

        def read(i: int, text: str) -> set[int]:
            if (x := seen.get((i, text))) is None:
                if len(seen) > 5_000:
                    seen.clear()
                x = seen[i, text] = set(elements(text).tolist())
            return x

        for b in batches:
            keep = []
            for i, j, x, y in zip(*(b.column(c).to_pylist() for c in ("a", "b", "ta", "tb"))):
                x, y = read(i, x), read(j, y)
                common = len(x & y)
                keep.append(common >= threshold * (len(x) + len(y) - common) - 1e-9)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b").select("a", "b", "ta", "tb").mapInArrow(alike, "a bigint, b bigint")


def _across(placed: DataFrame) -> DataFrame:
    """Pairs (a, b) of one bucket's members in different components. A bucket beyond PART members is paired by parts."""
    parts = placed.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    rows = placed.join(parts, "bucket").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "id", "component")

    def cross(t: pa.Table) -> pa.Table:
        ids, comp, part = (t[c].to_numpy() for c in ("id", "component", "part"))
        order = np.argsort(ids)
        ids, comp, part = ids[order], comp[order], part[order]
        apart = np.triu(comp[:, None] != comp[None, :], 1)
        if t["low"][0].as_py() != t["high"][0].as_py():
            apart &= part[:, None] != part[None, :]
        x, y = np.nonzero(apart)
        return pa.table({"a": ids[x], "b": ids[y]})

    return rows.groupBy("bucket", "low", "high").applyInArrow(cross, "a bigint, b bigint").distinct()


def near_duplicates(records: DataFrame, threshold: float = 0.8, words: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, group) of every record that is like another one: linked at a Jaccard similarity of at least ``threshold`` over their sets of
    runs of ``words`` words, directly or through others. ``group`` is the smallest id of the group. Records alike to none have no row.
    With one word a run every link is found, else as hashing finds them.

    ``records`` has (id bigint, text). Records with a null id, or a text that is null or has no word, are like none; of rows
    repeated with one id in different texts all are compared. An empty table gives an empty result.
    """
    shipped(records.sparkSession)
    texts = records.select(F.col("id").cast("bigint").alias("id"), "text").filter("id IS NOT NULL AND text IS NOT NULL")
    candidates = stored(_candidates(texts, words, bands, rows, threshold))
    prefix = candidates.filter("prefix IS NOT NULL").select("a", "prefix")
    pairs = candidates.filter("prefix IS NULL AND (bucket IS NULL OR bucket > 0)").select("a", "b").distinct()
    copies = candidates.filter("bucket = 0").select("a", "b")
    likely, large = stored(_share(pairs, prefix)), candidates.filter("bucket > 0")
    # All texts are shuffled once, for the pairs of now and for those across the parts of large buckets.
    asked = likely.union(large.select("a", "b")).select(F.explode(F.array("a", "b")).alias("id")).distinct()
    some = stored(texts.join(asked.hint("merge"), "id", "left_semi").dropDuplicates(["id"]))
    links = stored(_verified(likely, some, words, threshold).union(copies))
    found = components(links)
    if not large.isEmpty():
        members = large.select("bucket", F.col("b").alias("id")).union(large.select("bucket", F.col("a").alias("id")).distinct())
        placed = members.join(found, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
        split = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("bucket")
        rest = _across(placed.join(split, "bucket", "left_semi")).join(pairs, ["a", "b"], "left_anti")
        more = stored(_verified(stored(_share(rest, prefix)), some, words, threshold))
        if not more.isEmpty():
            found = components(links.union(more))
    return found.select("id", F.col("component").alias("group"))
