"""New batches checked against everything accepted before, from an index by rare token.

Two statements can only repeat each other if they name the same numbers (the same words in the same order imply it), so the
overlap asked of their number tokens is whole and the rarest one alone is the prefix to index. The order from rare to frequent
is fixed (longer runs of digits first), so postings written once stay valid for every later batch. A batch probes the
postings of its tokens, filters by the number of tokens, verifies the overlap, then compares words and vectors; what is
accepted is appended. The index is a stored table in parts by token; a batch reads only the parts, tokens and numbers it names, so what
history it does not touch is not worked through again. Within a token the rows are walked in order of batch and id.

A token that holds very many rows is not walked in one task: its exact copies are taken together first, then rounds over pairs of parts
decide in parallel what the walk would decide one by one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.neighbours import unit
from textloom.session import checkpointed, removed_at_exit, shared_folder, shipped

#: Rows of a token from which it is decided in rounds, and representatives of a part in them.
HOT, PART = 50_000, 4_000
#: Rows that are compared with the postings at once.
CHUNK = 256
#: Parts of the stored index, by the hash of the token, and numbers of batches that one replay takes at most.
PARTS, MOST_BATCHES = 32, 10_000
COSINE = 0.93
ROW = "token string, numbers string, w1 bigint, w2 bigint, vector array<float>, batch bigint, id bigint"


def indexed(facts: DataFrame, width: int = 64, id_col: str = "id", batch_col: str = "batch_no", text_col: str = "statement", vector_col: str = "embedding") -> DataFrame:
    """Facts as postings: token, numbers, the words' hashes, the vector or null where it is unusable, batch and id. A null batch comes
    after all others; rows with a null id are left out; a null statement has neither words nor numbers."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_join(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), " ")
    numbers = F.array_sort(F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0)))
    rarest = F.array_max(F.transform(numbers, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))
    v = F.col(vector_col)
    good = (F.size(v) == width) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x)) & F.exists(v, lambda x: x != 0)
    return facts.filter(F.col(id_col).isNotNull()).select(
        F.coalesce(rarest["x"], F.lit("")).alias("token"), F.array_join(numbers, " ").alias("numbers"),
        F.when(words != "", F.xxhash64(words)).alias("w1"), F.when(words != "", F.xxhash64(words, F.lit(1))).alias("w2"),
        F.when(good, v.cast("array<float>")).alias("vector"), F.coalesce(F.col(batch_col).cast("bigint"), F.lit(2**62)).alias("batch"), F.col(id_col).cast("bigint").alias("id"),
    )


class Postings:
    """The accepted facts with one multiset of numbers, in order of acceptance."""

    def __init__(self, width: int) -> None:
        self.by_words: dict[tuple[int, int], int] = {}
        self.vectors, self.ids, self.n = np.empty((4, width)), np.empty(4, dtype=np.int64), 0

    def append(self, fact: int, words: tuple | None, vector: np.ndarray | None) -> None:
        if words is not None:
            self.by_words[words] = min(fact, self.by_words.get(words, fact))
        if vector is not None:
            if self.n == len(self.ids):
                self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.vectors[self.n], self.ids[self.n] = vector, fact
            self.n += 1

    def extend(self, ids: np.ndarray, words: list, vectors: np.ndarray, good: np.ndarray) -> None:
        for fact, w in zip(ids.tolist(), words):
            if w is not None:
                self.by_words[w] = min(fact, self.by_words.get(w, fact))
        if len(vectors):
            self.vectors = np.concatenate([self.vectors[: self.n], vectors])
            self.ids = np.concatenate([self.ids[: self.n], ids[good]])
            self.n = len(self.ids)

    def walk(self, ids: np.ndarray, batches: np.ndarray, words: list, vectors: np.ndarray, good: np.ndarray, first: int, cosine: float) -> Iterator[tuple[int, int | None]]:
        """(id, smallest accepted id it repeats, or None where it is accepted) of every fact in order. Facts up to batch ``first`` are accepted as they stand
        and not named."""
        known = int(np.searchsorted(batches, first, side="right"))
        self.extend(ids[:known], words[:known], vectors[:known][good[:known]], good[:known])
        for s in range(known, len(ids), CHUNK):
            e = min(len(ids), s + CHUNK)
            block = vectors[s:e]
            before = np.full(e - s, -1, dtype=np.int64)
            if self.n:
                hit = block @ self.vectors[: self.n].T >= cosine
                some = np.flatnonzero(hit.any(axis=1))
                if len(some):
                    before[some] = np.where(hit[some], self.ids[: self.n], np.iinfo(np.int64).max).min(axis=1)
            within = block @ block.T >= cosine if e - s > 1 else None
            taken = np.zeros(e - s, dtype=bool)
            for i in range(e - s):
                found = []
                if words[s + i] is not None and (w := self.by_words.get(words[s + i])) is not None:
                    found.append(w)
                if good[s + i]:
                    if before[i] >= 0:
                        found.append(int(before[i]))
                    if i and within is not None and (near := within[i, :i] & taken[:i]).any():
                        found.append(int(ids[s:e][:i][near].min()))
                kept = min(found) if found else None
                if kept is None:
                    taken[i] = good[s + i]
                    self.append(int(ids[s + i]), words[s + i], block[i] if good[s + i] else None)
                yield int(ids[s + i]), kept


def _columns(t: pa.Table | pa.RecordBatch, width: int):
    ids, batches = t.column("id").to_numpy(), t.column("batch").to_numpy()
    words = [None if a is None else (a, b) for a, b in zip(t.column("w1").to_pylist(), t.column("w2").to_pylist())]
    v = t.column("vector")
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    v = pa.concat_arrays(v.chunks) if isinstance(v, pa.ChunkedArray) else v
    good = v.is_valid().to_numpy(zero_copy_only=False)
    vectors = np.zeros((len(ids), width))
    if good.any():
        vectors[good] = unit(v.drop_null().flatten().to_numpy().reshape(-1, width))
    return ids, batches, words, vectors, good


def _walked(rows: DataFrame, first: int, cosine: float, width: int) -> DataFrame:
    """(kept_id, fact_id) by one pass over each token's rows in order."""
    out = pa.schema([("kept_id", pa.int64()), ("fact_id", pa.int64())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, postings, last = None, None, None
        for b in batches:
            ids, numbered, words, vectors, good = _columns(b, width)
            keys = list(zip(b.column("token").to_pylist(), b.column("numbers").to_pylist()))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)] if keys else []
            found = []
            for s, e in zip(cuts, cuts[1:]):
                if keys[s] != now:
                    now, postings, last = keys[s], Postings(width), None
                keep = np.r_[ids[s] != last, ids[s + 1 : e] != ids[s : e - 1]]
                last = ids[e - 1]
                at = np.arange(s, e)[keep]
                for fact, kept in postings.walk(ids[at], numbered[at], [words[i] for i in at], vectors[at], good[at], first, cosine):
                    if kept is not None:
                        found.append((kept, fact))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], schema=out)

    return rows.repartition("token").sortWithinPartitions("token", "numbers", "batch", "id").mapInArrow(walk, "kept_id bigint, fact_id bigint")


def _rounds(rows: DataFrame, first: int, cosine: float, width: int, part: int) -> DataFrame:
    """(kept_id, fact_id) as the walk has them, for tokens too large to walk."""
    same = ["token", "numbers", "w1", "w2", "v1", "v2"]
    keyed = rows.withColumn("v1", F.xxhash64("vector")).withColumn("v2", F.xxhash64("vector", F.lit(1)))
    copies = keyed.groupBy(*same).agg(F.min(F.struct("batch", "id")).alias("o")).select(*same, F.col("o.batch").alias("batch"), F.col("o.id").alias("rep"))
    reps = keyed.join(copies.select(F.col("rep").alias("id"), "batch").distinct(), ["id", "batch"], "left_semi").dropDuplicates(["id"])
    reps = checkpointed(reps.select("token", "numbers", "w1", "w2", "vector", "batch", "id"))

    def compare(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
        """(id, name): of each left row the smallest right row it repeats, earlier or the same."""
        parts = reps.groupBy("token", "numbers").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts"))
        own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        one = left.join(parts, ["token", "numbers"]).withColumn("p", own).withColumn("q", other)
        two = right.join(parts, ["token", "numbers"]).withColumn("q", own).withColumn("p", other)
        two = two.select(*[F.col(c).alias(c) for c in two.columns])  # columns of its own: both sides come from one table

        def meet(a: pa.Table, b: pa.Table) -> pa.Table:
            ids, least = [], []
            if a.num_rows and b.num_rows:
                x, xb, xw, xv, xg = _columns(a, width)
                y, yb, yw, yv, yg = _columns(b, width)
                order = np.argsort(y)
                y, yb, yv, yg, yw = y[order], yb[order], yv[order], yg[order], [yw[i] for i in order]
                index: dict = {}
                for i, w in enumerate(yw):
                    if w is not None:
                        index.setdefault(w, []).append(i)
                for s in range(0, len(x), 512):
                    hit = (xv[s : s + 512] @ yv.T >= cosine) & xg[s : s + 512, None] & yg[None, :]
                    for i in range(len(hit)):
                        hit[i, index.get(xw[s + i], [])] = True
                    hit &= (yb[None, :] < xb[s : s + 512, None]) | (yb[None, :] == xb[s : s + 512, None]) & (y[None, :] <= x[s : s + 512, None])
                    some = hit.any(axis=1)
                    ids.append(x[s : s + 512][some])
                    least.append(y[hit.argmax(axis=1)[some]])
            return pa.table({"id": pa.array(np.concatenate(ids) if ids else [], pa.int64()), name: pa.array(np.concatenate(least) if least else [], pa.int64())})

        keys = ["token", "numbers", "p", "q"]
        met = one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInArrow(meet, f"id bigint, {name} bigint")
        return met.groupBy("id").agg(F.min(name).alias(name))

    accepted, open_ = reps.filter(F.col("batch") <= first), reps.filter(F.col("batch") > first)
    while not open_.isEmpty():
        repeats = compare(open_, accepted, "kept")
        left = open_.join(repeats, "id", "left_anti")
        earlier = compare(left, left, "earlier").filter("earlier < id").select("id")
        passed = left.join(earlier, "id", "left_anti")
        accepted = checkpointed(accepted.unionByName(passed))
        open_ = checkpointed(left.join(earlier, "id", "left_semi"))
    kept = compare(reps, accepted, "kept_id").withColumnRenamed("id", "rep")
    members = keyed.select(*same, "batch", "id")
    on = [members[c].eqNullSafe(copies[c]) for c in same]
    joined = members.join(copies.drop("batch"), on).select(members["id"].alias("fact_id"), members["batch"], "rep").join(kept, "rep")
    return joined.filter((F.col("batch") > first) & (F.col("kept_id") != F.col("fact_id"))).select("kept_id", "fact_id").distinct()


def repeated(postings: DataFrame, first: int = 0, cosine: float = COSINE, width: int = 64, hot: int = HOT, part: int = PART) -> DataFrame:
    """(kept_id, fact_id) of every fact that repeats an accepted one.

    ``postings`` as ``indexed`` makes them. Facts are taken by batch, then id. Batches up to ``first`` are accepted whole; a later fact is
    a repeat if an accepted one has the same words in the same order, or the same numbers and a vector at ``cosine`` or more; else it is accepted.
    kept_id is the smallest such accepted id. Facts without words repeat none by words, those without a usable vector none by
    vector; rows repeated with one id count once. An empty table gives an empty result.
    """
    shipped(postings.sparkSession)
    large = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("token")
    large = checkpointed(large)
    if large.isEmpty():
        return _walked(postings, first, cosine, width)
    walked = _walked(postings.join(large, "token", "left_anti"), first, cosine, width)
    return walked.unionByName(_rounds(postings.join(large, "token", "left_semi"), first, cosine, width, part))


def arrive(index: DataFrame | None, batch: DataFrame, cosine: float = COSINE, width: int = 64, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """One batch against a kept index: (repeats, the postings to append). ``index`` holds earlier accepted postings, or is None. The batch must come
    after all of them. Postings whose number of tokens or tokens differ from the batch's are left out where the index is read."""
    if index is None:
        repeats = repeated(batch, first=-1, cosine=cosine, width=width, hot=hot)
    else:
        on = [c for c in ("part", "token", "numbers") if c in index.columns and c in batch.columns]
        probes = batch.select(*on).distinct()
        known = index.join(probes, on, "left_semi").withColumn("batch", F.lit(-1).cast("bigint")).drop("part")
        repeats = repeated(known.unionByName(batch.drop("part")), first=-1, cosine=cosine, width=width, hot=hot)
    repeats = checkpointed(repeats)
    return repeats, batch.join(repeats.select(F.col("fact_id").alias("id")), "id", "left_anti")


class Index:
    """The accepted postings as a stored table in parts by token: ``append`` adds rows, ``postings`` reads what is there. It lies in ``path``,
    or else in the shared folder until the session ends."""

    def __init__(self, spark, path: str | None = None, parts: int = PARTS) -> None:
        self.spark, self.parts = spark, parts
        self.path = path or removed_at_exit(spark, f"{shared_folder(spark)}/textloom/{uuid.uuid4().hex}")

    def placed(self, postings: DataFrame) -> DataFrame:
        return postings.withColumn("part", F.pmod(F.xxhash64("token"), F.lit(self.parts)).cast("int"))

    def append(self, postings: DataFrame) -> None:
        rows = postings if "part" in postings.columns else self.placed(postings)
        rows.repartition(self.parts, "part").sortWithinPartitions("part", "token").write.mode("append").partitionBy("part").parquet(self.path)

    def postings(self) -> DataFrame:
        return self.spark.read.schema(f"{ROW}, part int").parquet(self.path)


def replayed(postings: DataFrame, first: int = 0, cosine: float = COSINE, width: int = 64, index: Index | None = None, hot: int = HOT) -> DataFrame:
    """(kept_id, fact_id) as ``repeated`` has them, by an index that the batches up to ``first`` begin and every later batch probes and then extends.

    Batches are few: beyond MOST_BATCHES an error is raised. With an ``index`` that already holds earlier batches, ``postings`` are the new ones only
    and ``first`` lies before them.
    """
    spark = postings.sparkSession
    shipped(spark)
    numbers = [r[0] for r in postings.select("batch").distinct().limit(MOST_BATCHES + 1).collect()]
    if len(numbers) > MOST_BATCHES:
        raise ValueError(f"more than {MOST_BATCHES} batches")
    kept = index or Index(spark)
    kept.append(postings.filter(F.col("batch") <= first))
    out = spark.createDataFrame([], "kept_id bigint, fact_id bigint")
    for number in sorted(n for n in numbers if n > first):
        repeats, accepted = arrive(kept.postings(), kept.placed(postings.filter(F.col("batch") == number)), cosine, width, hot)
        kept.append(accepted)
        out = out.union(repeats)
    return out
