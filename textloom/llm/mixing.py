"""Mixing sources to target weights, by the block.

Each source's token stream is cut into blocks of fixed length: chunks of its documents are added up by a prefix sum, so blocks run
on over the chunks and only the last block of a source is short. An output shard draws how many of its slots fall to each
source; the draws are multinomial given the totals, so the totals are met exactly. The k-th slot of a source reads
block ``permutation(k)`` of that source, a new permutation for every repetition, so slots and blocks meet in a
join by index: no sort of the corpus, no shared counter, and any shard can be made again by itself. What a mix reaches, and which
sources cannot give what it asks, is read from the blocks that its slots met.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.tokens import TOKENIZER, with_tokens
from textloom.session import shipped, stored

#: Tokens of a block, and slots of an output shard.
BLOCK = 1024
SHARD = 2048
#: Documents of a chunk, about; each source has as many chunks as its own documents need.
CHUNK_DOCS = 20_000
#: Slots up to which numpy draws hypergeometrically; beyond, the draw is the normal limit, whose error is far below a slot in a million.
EXACT = 500_000_000
#: Rows of targets that are taken to the driver at most; more raise an error.
MOST_TARGETS = 100_000


def _seed(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode(), digest_size=8).digest(), "big")


def permuted(k: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 at the places k: four Feistel rounds over the next power of four, walked
    until the value falls below n."""
    if n <= 1:
        return np.zeros_like(k)
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(_seed(seed, r)) for r in range(4)]

    def step(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(half), v & mask
        for key in keys:
            x = (right + key) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
            left, right = right, left ^ ((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(33) & mask)
        return (left << np.uint64(half)) | right

    with np.errstate(over="ignore"):
        v = step(k.astype(np.uint64))
        while (out := v >= np.uint64(n)).any():
            v[out] = step(v[out])
    return v.astype(np.int64)


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` slots drawn without putting back are good."""
    if good + bad <= EXACT:
        return int(rng.hypergeometric(good, bad, n))
    share, every = good / (good + bad), good + bad
    spread = math.sqrt(n * share * (1 - share) * (every - n) / (every - 1))
    return min(good, n, max(0, n - bad, round(n * share + spread * rng.standard_normal())))


def drawn(totals: np.ndarray, slots: int, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source before a shard, and within it. The slots 0..slots-1 lie in shards of equal length but the
    last; the counts of the left half of any run of shards are drawn hypergeometrically from the run's totals."""
    low, high = 0, shards
    before, here, length = np.zeros_like(totals), totals.copy(), slots
    while high - low > 1:
        middle = (low + high) // 2
        left = min(length, (middle - low) * SHARD)
        rng = np.random.default_rng([seed, low, high])
        draw, rest, room = np.zeros_like(here), int(here.sum()), left
        for i, n in enumerate(here):  # one source after the other: numpy's joint draw wants small totals
            rest -= int(n)
            draw[i] = _hypergeometric(rng, int(n), rest, room) if room and n else 0
            room -= draw[i]
        if shard < middle:
            here, high, length = draw, middle, left
        else:
            before, here, low, length = before + draw, here - draw, middle, length - left
    return before, here


def plan(per: DataFrame, targets: DataFrame) -> DataFrame:
    """What each mix asks of each source, and what the source holds.

    ``per`` has (source, source_tokens), one row a source; ``targets`` has (mix_name, size_share, source, target_share,
    max_repeats). Out: mix_name, source, max_repeats, source_tokens, size_tokens, target_tokens, planned_tokens: the target, or
    ``max_repeats`` times the source's tokens where that is less. Null text has no tokens, null sources belong to no target, a
    source without documents has 0 tokens. Repeated target rows count once; one with a null share or repeats asks for nothing.
    """
    total = per.agg(F.coalesce(F.sum("source_tokens"), F.lit(0)).alias("all_tokens"))
    wanted = targets.select("mix_name", "size_share", "source", "target_share", "max_repeats").distinct()
    size, have = F.col("size_share") * F.col("all_tokens"), F.coalesce(F.col("source_tokens"), F.lit(0))
    rows = wanted.join(per, "source", "left").crossJoin(total)  # the total is one row
    asked = rows.select("mix_name", "source", "max_repeats", have.alias("source_tokens"), size.alias("size_tokens"), (size * F.col("target_share")).alias("target_tokens"))
    return asked.withColumn("planned_tokens", F.least(F.col("target_tokens"), F.col("max_repeats") * F.col("source_tokens")))


def blocks(tokens: DataFrame, block: int = BLOCK, chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """Each source's token stream in blocks: (source, block, doc_id, first_token, tokens), one row a document's part.

    A source's documents are spread by hash over chunks of about ``chunk_docs`` documents, as many as that source needs, so that no source is
    packed in one task. A chunk begins at the token where the chunks before it end, so every block but the last of a source is full.
    """
    docs = tokens.filter("tokens > 0 AND source IS NOT NULL")
    chunks = docs.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / chunk_docs).alias("chunks"))
    docs = docs.join(chunks, "source").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks"))).drop("chunks")
    sizes = docs.groupBy("source", "chunk").agg(F.sum("tokens").alias("n"))
    order = Window.partitionBy("source").orderBy("chunk")  # one row a chunk
    starts = sizes.select("source", "chunk", (F.sum("n").over(order) - F.col("n")).alias("start"))
    run = Window.partitionBy("source", "chunk").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id", "tokens")
    placed = docs.withColumn("inside", F.sum("tokens").over(run)).join(starts, ["source", "chunk"])
    placed = placed.withColumn("end", F.col("start") + F.col("inside")).withColumn("begin", F.col("end") - F.col("tokens"))
    cut = placed.withColumn("b", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))))
    low, high = F.greatest("begin", F.col("b") * block), F.least("end", (F.col("b") + 1) * block)
    return cut.select("source", F.col("b").alias("block"), "doc_id", (low - F.col("begin")).alias("first_token"), (high - low).alias("tokens"))


def slots_for(planned: float, source_tokens: int, max_repeats: int, block: int) -> int:
    """How many slots bring a source nearest to its planned tokens. A repetition is its full blocks and, last, the short one, so whole repetitions
    are counted first and what is left is rounded to a block."""
    full, short = divmod(source_tokens, block)
    each = full + (short > 0)
    if not each:
        return 0
    whole = min(max_repeats, int(planned // source_tokens))
    rest = planned - whole * source_tokens
    if whole == max_repeats or rest <= 0:
        return whole * each
    more = min(full, round(rest / block))
    if short and more == full and abs(rest - source_tokens) < abs(rest - full * block):
        more = each
    return whole * each + more


def slots(spark, sources: list[dict], seed: int = 0, block: int = BLOCK) -> DataFrame:
    """The slots of every mix: (mix_name, shard, slot, source, repeat, block). ``sources`` are rows of ``plan``. A source gets its
    planned tokens in blocks, at most max_repeats of each; within a repetition the short block comes after the full ones, which are permuted."""
    mixes: dict[str, list] = {}
    for r in sorted(sources, key=lambda r: (r["mix_name"], r["source"])):
        n = slots_for(r["planned_tokens"], r["source_tokens"], r["max_repeats"], block)
        if n > 0:
            mixes.setdefault(r["mix_name"], []).append((r["source"], n, -(-r["source_tokens"] // block), r["source_tokens"] // block))
    shards = [(m, i) for m, rows in mixes.items() for i in [math.ceil(sum(r[1] for r in rows) / SHARD)]]
    spec = "mix_name string, shard bigint, slot bigint, source string, repeat int, block bigint"
    if not shards:
        return spark.createDataFrame([], spec)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for mix, shard, of in zip(batch["mix_name"], batch["shard"], batch["shards"]):
                rows = mixes[mix]
                totals = np.array([r[1] for r in rows], dtype=np.int64)
                before, here = drawn(totals, int(totals.sum()), of, shard, _seed(seed, mix) >> 1)
                parts = []
                for (source, _, n_blocks, full), first, n in zip(rows, before, here):
                    k = first + np.arange(n, dtype=np.int64)
                    repeat, at = k // n_blocks, k % n_blocks
                    to = at.copy()
                    for r in np.unique(repeat):
                        mine = (repeat == r) & (at < full)
                        to[mine] = permuted(at[mine], full, _seed(seed, mix, source, r))
                    parts.append(pd.DataFrame({"source": source, "repeat": repeat.astype(np.int32), "block": to}))
                out = pd.concat(parts, ignore_index=True)
                out["slot"] = np.random.default_rng([_seed(seed, mix, "order") >> 1, shard]).permutation(len(out)) + shard * SHARD
                out["mix_name"], out["shard"] = mix, shard
                yield out[["mix_name", "shard", "slot", "source", "repeat", "block"]]

    of = spark.createDataFrame(shards, "mix_name string, shards bigint")
    each = of.select("mix_name", "shards", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("shard"))
    return each.repartition(F.col("mix_name"), F.col("shard")).mapInPandas(draw, spec)


def mix(documents: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, block: int = BLOCK, tokenizer: str = TOKENIZER, chunk_docs: int = CHUNK_DOCS) -> tuple[DataFrame, DataFrame]:
    """The mixed documents and the report. Mixed: mix_name, shard, slot, source, repeat, block, doc_id, first_token, tokens.
    Report: the columns of ``plan`` with reached_tokens, reached_share (the share of the mix really reached) and short: every block of the source was
    drawn as often as allowed, and what came together is less than the target. A source that is not short reaches its target to within a block.

    Documents without text or source take no part; repeated rows are documents of their own. Empty tables give
    empty results.
    """
    spark = documents.sparkSession
    shipped(spark)
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    tokens = stored(with_tokens(docs, "text", tokenizer))
    planned = plan(tokens.groupBy("source").agg(F.sum("tokens").alias("source_tokens")), targets)
    rows = planned.limit(MOST_TARGETS + 1).collect()
    if len(rows) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} targets")
    planned = spark.createDataFrame(rows, planned.schema)
    cut = stored(blocks(tokens, block, chunk_docs))
    drawn_slots = slots(spark, [r.asDict() for r in rows if r["source"] is not None and r["planned_tokens"] is not None], seed, block)
    # Slots and blocks both grow with the corpus, so they meet by shuffle at every size.
    mixed = drawn_slots.join(cut.hint("merge"), ["source", "block"]).select("mix_name", "shard", "slot", "source", "repeat", "block", "doc_id", "first_token", "tokens")
    sizes = cut.groupBy("source", "block").agg(F.sum("tokens").alias("tokens"))
    met = drawn_slots.join(sizes.hint("merge"), ["source", "block"]).groupBy("mix_name", "source").agg(F.sum("tokens").alias("reached_tokens"), F.count(F.lit(1)).alias("slots"))
    share = F.col("reached_tokens") / F.sum("reached_tokens").over(Window.partitionBy("mix_name"))
    all_drawn = F.col("slots") >= F.col("max_repeats") * F.ceil(F.col("source_tokens") / block)
    report = planned.join(met, ["mix_name", "source"], "left").fillna(0, ["reached_tokens", "slots"]).withColumn("reached_share", share)
    short = F.coalesce(all_drawn & (F.col("reached_tokens") < F.col("target_tokens")), F.lit(False))
    return mixed, report.withColumn("short", short).drop("slots")
