"""Filling fixed-capacity containers with items.

Best-fit decreasing within buckets of items spread by hash: the open containers of a bucket are ordered by the room left, and an item goes
to the tightest one that holds it and is compatible. A container carries a bitmap of the duplicate clusters and one of the
sources in it; an item is incompatible with a container that already holds one of its cluster, and with one that holds its source as long as
another container takes it (or always, if so asked). The search goes on to the next tightest until a compatible one is found, else a
new one is opened. Only an item beyond the capacity is split:
into full containers and one rest, which is then placed like any item.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.tokens import TOKENIZER, with_tokens
from textloom.session import shipped, stored

#: Items of a bucket, about. Each bucket packs by itself and leaves at most a few containers part-filled at its end.
BUCKET = 10_000
#: Containers that are taken to the driver at most (their kinds, a small table by nature).
MOST = 10_000


def pack(sizes: list[int], clusters: list[int], sources: list[int], capacity: int, apart: bool | None = None) -> tuple[list[tuple[int, int, int, int]], list[int]]:
    """([(item, container, first, size)], room left of each container). Items of size 0 or less are not placed. Items are taken by size
    downwards, then in order; ``clusters`` and ``sources`` are bit numbers, a cluster below 0 is none. Items of one source share a container where no
    other has room (``apart`` None), never (True), or freely (False)."""
    placed: list[tuple[int, int, int, int]] = []
    room: list[int] = []
    copies: list[int] = []
    origins: list[int] = []
    ordered: list[tuple[int, int]] = []  # (room, container), open containers only

    def open_(item: int, first: int, size: int) -> None:
        k = len(room)
        room.append(capacity - size)
        copies.append(0 if clusters[item] < 0 else 1 << clusters[item])
        origins.append(1 << sources[item])
        placed.append((item, k, first, size))
        if room[k]:
            insort(ordered, (room[k], k))

    rests = []
    for item, size in enumerate(sizes):
        first = 0
        while size - first > capacity:
            open_(item, first, capacity)
            first += capacity
        if size - first > 0:
            rests.append((size - first, -item, first))
    for size, item, first in sorted(rests, reverse=True):
        item = -item
        bit = 0 if clusters[item] < 0 else 1 << clusters[item]
        origin = 0 if apart is False else 1 << sources[item]
        at, same = bisect_left(ordered, (size, -1)), -1
        while at < len(ordered):
            k = ordered[at][1]
            if not copies[k] & bit:
                if not origins[k] & origin:
                    break
                if same < 0:
                    same = at
            at += 1
        if at == len(ordered) and apart is None and same >= 0:
            at = same
        if at == len(ordered):
            open_(item, first, size)
            continue
        left, k = ordered.pop(at)
        room[k] = left - size
        copies[k] |= bit
        origins[k] |= 1 << sources[item]
        placed.append((item, k, first, size))
        if room[k]:
            insort(ordered, (room[k], k))
    return placed, room


def packed(items: DataFrame, containers: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", apart: bool | None = None, clusters: DataFrame | None = None, tokenizer: str = TOKENIZER) -> DataFrame:
    """Every item's place in every kind of container: container, capacity, bin, doc_id, first_token, tokens, room.

    ``containers`` has (container, capacity_tokens); null or non-positive capacities hold nothing. ``bin`` numbers the containers of a kind,
    ``room`` is what its container leaves unused. Texts that are null or empty take no place. Items of one duplicate cluster never share a
    container: copies (the same text up to case and white space; repeated rows are copies), and what ``clusters`` (id, group; one row an id) puts in one group. Items
    of one source share one only where no other has room, or never with ``apart``. Empty tables give an empty result.
    """
    shipped(items.sparkSession)
    kinds = [(r[0], r[1]) for r in containers.select("container", "capacity_tokens").filter("capacity_tokens > 0").distinct().orderBy("capacity_tokens", "container").limit(MOST + 1).collect()]
    if len(kinds) > MOST:
        raise ValueError(f"more than {MOST} kinds of containers")
    text = F.lower(F.trim(F.regexp_replace(text_col, r"\s+", " ")))
    rows = items.filter(F.length(text_col) > 0).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).alias("source"), F.xxhash64(text).alias("cluster"), F.col(text_col).alias("text"))
    sized = with_tokens(rows, "text", tokenizer)
    if clusters is not None:
        grouped = clusters.select(F.col("id").alias("doc_id"), F.xxhash64("group", F.lit(1)).alias("near"))
        sized = sized.join(grouped, "doc_id", "left").withColumn("cluster", F.coalesce("near", "cluster")).drop("near")
    sized = stored(sized)
    buckets = max(1, math.ceil(sized.count() / BUCKET))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def emit(bucket: int, parts: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            b = pd.concat(parts, ignore_index=True).sort_values(["doc_id", "cluster", "tokens"], ignore_index=True)
            often = b["cluster"].map(b["cluster"].value_counts())
            cluster = pd.factorize(b["cluster"].where(often > 1))[0].tolist()  # a text without copies needs no bit
            source = pd.factorize(b["source"].fillna(""))[0].tolist()
            ids = b["doc_id"].to_numpy()
            for name, capacity in kinds:
                placed, room = pack(b["tokens"].tolist(), cluster, source, capacity, apart)
                out = pd.DataFrame(placed, columns=["item", "k", "first_token", "tokens"])
                k = out["k"].to_numpy()
                yield pd.DataFrame({"container": name, "capacity": capacity, "bin": (bucket << 32) + k, "doc_id": ids[out["item"]], "first_token": out["first_token"], "tokens": out["tokens"], "room": [room[x] for x in k]})

        now, parts = None, []
        for b in batches:
            for bucket, part in b.groupby("bucket", sort=True):
                if bucket != now and parts:
                    yield from emit(now, parts)
                    parts = []
                now = bucket
                parts.append(part)
        if parts:
            yield from emit(now, parts)

    spread = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(buckets)))
    spec = "container string, capacity bigint, bin bigint, doc_id bigint, first_token bigint, tokens bigint, room bigint"
    return spread.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(fill, spec)


def filling(placed: DataFrame) -> DataFrame:
    """(container, capacity, bins, tokens, filled) of ``packed``'s result: how many containers were used and their filled share."""
    totals = placed.groupBy("container", "capacity").agg(F.countDistinct("bin").alias("bins"), F.sum("tokens").alias("tokens"))
    return totals.withColumn("filled", F.round(F.col("tokens") / (F.col("bins") * F.col("capacity")), 6))
