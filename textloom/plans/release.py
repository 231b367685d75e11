"""A release drawn from a pool so that several axes hold their shares at once: threads whole, twins out, neediest category first.

What the draw chooses between are kinds of threads: threads whose turns lie in the same cells of the axes are alike to it. The cluster counts the kinds and
picks rows of a kind by hash order; the greedy choice itself runs on the counts alone, so its cost is that of the kinds and not of the pool.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from heapq import heappop, heapreplace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.sets import closure
from textloom.operators.windows import hashed
from textloom.plans.selection import apportioned, independent
from textloom.registry import Tables, query
from textloom.session import checkpointed, shipped

AXES = ["difficulty", "question_type", "answerable", "language"]
#: Kinds of threads that are taken to the driver at most; more raise an error.
MOST = 100_000
Cell = tuple[str, str]
Kind = tuple[dict[Cell, int], int, int]


def slack(count: int, tolerance: float) -> int:
    return int(max(1, tolerance * count))


def quota_of(size: int, weights: dict[str, dict[str, float]], supply: dict[Cell, int], tolerance: float) -> dict[Cell, int]:
    """Seats of every category of every axis under its supply; what a category cannot fill goes to the others of its axis, up to their slack."""
    out = {}
    for axis, w in weights.items():
        have = {k: supply.get((axis, k), 0) for k in w}
        whole = sum(w.values()) or 1.0
        room = {k: min(n, round(size * w[k] / whole) + slack(size, tolerance)) for k, n in have.items()}
        out |= {(axis, k): n for k, n in apportioned(w, room, size).items()}
    return out


def ranked(kinds: list[Kind]) -> dict[Cell, list[tuple[float, int]]]:
    """Of each category the kinds that have it, as (-cells a turn, place) in order: a heap of the most that a kind's turns can be needed."""
    out: dict[Cell, list[tuple[float, int]]] = {}
    for i, (cells, turns, _) in enumerate(kinds):
        for c in cells:
            out.setdefault(c, []).append((-sum(cells.values()) / turns, i))
    return {c: sorted(v) for c, v in out.items()}


def choose(kinds: list[Kind], quota: dict[Cell, int], size: int, tolerance: float, by: dict[Cell, list[tuple[float, int]]] | None = None, short: int | None = None) -> list[int] | None:
    """How many threads of each kind are drawn. ``kinds`` are (turns by cell, turns, threads there are). The category that lacks the largest share of its
    quota comes first; of the kinds that have it and overshoot no quota by more than the slack, the one whose turns are needed most is taken, ties by
    place. Some of a kind are taken together while a hundredth of the lack lasts.

    What is needed and left only falls, so a kind that does not fit is out for good and none is needed more than when it was last looked at: the first of
    a category's heap that is needed as much as it says is the best. ``by`` is what ``ranked`` gives; with ``short`` there is no draw (None) as soon as a
    category is certain to lack more than that."""
    need, over = dict(quota), {c: slack(n, tolerance) for c, n in quota.items()}
    taken, left = [0] * len(kinds), size
    heaps: dict[Cell, list[tuple[float, int]]] = {}
    by = ranked(kinds) if by is None else by
    while left > 0:
        done = True
        for c in sorted((c for c, n in need.items() if n > 0), key=lambda c: (-need[c] / quota[c], c)):
            if c not in heaps:
                heaps[c] = list(by.get(c, ()))
            heap = heaps[c]
            while heap:
                said, i = heap[0]
                cells, turns, there = kinds[i]
                if taken[i] >= there or turns > left or not all(n <= need.get(k, 0) + over.get(k, 0) for k, n in cells.items()):
                    heappop(heap)
                    continue
                now = -sum(min(n, max(0, need.get(k, 0))) for k, n in cells.items()) / turns
                if now == said:
                    break
                heapreplace(heap, (now, i))
            if not heap:
                if short is not None and need[c] > short:
                    return None
                continue
            many = min(there - taken[i], left // turns, max(1, need[c] // (100 * cells[c])))
            many = max(1, min([many, *((need.get(k, 0) + over.get(k, 0)) // n for k, n in cells.items())]))
            taken[i] += many
            left -= many * turns
            for k, n in cells.items():
                need[k] = need.get(k, 0) - many * n
            done = False
            break
        if done:
            break
    return taken


def close_enough(taken: list[int], kinds: list[Kind], quota: dict[Cell, int], size: int, tolerance: float) -> bool:
    """The draw has its size and every category lies within the slack of its quota."""
    have: Counter = Counter()
    for n, (cells, _, _) in zip(taken, kinds):
        for c, m in cells.items():
            have[c] += n * m
    drawn = sum(n * turns for n, (_, turns, _) in zip(taken, kinds))
    return drawn >= size - slack(size, tolerance) and all(abs(have[c] - n) <= slack(size, tolerance) for c, n in quota.items())


def first_here(sizes: range, fills: Callable[[int], bool]) -> int:
    return next((s for s in sizes if fills(s)), 0)


def first_on(spark: SparkSession) -> Callable[[range, Callable[[int], bool]], int]:
    """The same with some sizes at a time tried on the cluster, a task for each."""
    sc = spark.sparkContext
    wave = 2 * sc.defaultParallelism

    def first(sizes: range, fills: Callable[[int], bool]) -> int:
        shipped(spark)
        for at in range(0, len(sizes), wave):
            some = sizes[at : at + wave]
            if found := sc.parallelize(list(some), len(some)).filter(fills).collect():
                return max(found)
        return 0

    return first


def largest(kinds: list[Kind], weights: dict[str, dict[str, float]], supply: dict[Cell, int], tolerance: float, first: Callable[[range, Callable[[int], bool]], int] = first_here) -> int:
    """The largest size that a draw fills within the tolerance: a scan downwards by hundredths of the pool from a bound that no release can pass, then by one."""
    bound = sum(turns * there for _, turns, there in kinds)
    for axis, w in weights.items():
        whole = sum(w.values()) or 1.0
        for k, x in w.items():
            if x / whole > tolerance:
                bound = min(bound, int((supply.get((axis, k), 0) + 1) / (x / whole - tolerance)))

    by = ranked(kinds)

    def fills(size: int) -> bool:
        quota = {(a, k): round(size * x / (sum(w.values()) or 1.0)) for a, w in weights.items() for k, x in w.items()}
        taken = choose(kinds, quota, size, tolerance, by, slack(size, tolerance))
        return taken is not None and close_enough(taken, kinds, quota, size, tolerance)

    step = max(1, bound // 100)
    size = first(range(bound, 0, -step), fills)
    return (first(range(min(bound, size + step - 1), size, -1), fills) or size) if size else 0


def threads(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(turns, kinds): the pool's drawable turns with root, hash and axes, and the kinds of threads as counted. A thread leaves the pool if a turn
    of it is the twin of an earlier one (two questions on one fact, by hash order of their threads), or if its root is not in the pool."""
    clean = [F.coalesce(F.lower(F.trim(F.col(a).cast("string"))), F.lit("")).alias(a) for a in AXES]
    pool = t.release_pool.groupBy("id").agg(F.min(F.struct("follows_id", *AXES)).alias("v")).select("id", "v.follows_id", *[F.col(f"v.{a}").alias(a) for a in AXES]).select("id", "follows_id", *clean)
    placed = closure(pool.select("id", "follows_id"), "id", "follows_id").select("id", "root")
    orphans = pool.filter("follows_id IS NOT NULL").join(pool.select(F.col("id").alias("follows_id")), "follows_id", "left_anti").select(F.col("id").alias("root"))
    turns = pool.drop("follows_id").join(placed, "id").join(orphans, "root", "left_anti").withColumn("h", hashed("root"))
    facts = t.question_facts.distinct().select(F.col("question_id").alias("id"), F.col("fact_id").alias("key"))
    kept = independent(turns.select("id", F.col("root").alias("item"), "h").join(facts, "id").select("item", "key", "h").distinct())
    alone = turns.select(F.col("root").alias("item")).distinct().join(turns.join(facts, "id", "left_semi").select(F.col("root").alias("item")), "item", "left_anti")
    turns = checkpointed(turns.join(kept.unionByName(alone).select(F.col("item").alias("root")), "root", "left_semi"))
    cell = F.array_join(F.array(*AXES), "\x1f")
    kinds = turns.groupBy("root", "h").agg(F.array_join(F.array_sort(F.collect_list(cell)), "\x1e").alias("kind"))  # a thread has few turns
    return turns, kinds


def counted(kinds: DataFrame) -> tuple[list[str], list[Kind], dict[Cell, int]]:
    rows = kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).orderBy("kind").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} kinds of threads")
    out, supply = [], Counter()
    for r in rows:
        turns = [x.split("\x1f") for x in r["kind"].split("\x1e")]
        cells = Counter((a, v) for x in turns for a, v in zip(AXES, x) if v)
        out.append((dict(cells), len(turns), r["n"]))
        for c, n in cells.items():
            supply[c] += n * r["n"]
    return [r["kind"] for r in rows], out, dict(supply)


def drawn(t: Tables, share: float = 0.5, tolerance: float = 0.05) -> DataFrame:
    """(id, root, and the axes) of a release of ``share`` of the drawable pool, with the pool's own shares as weights: an even release in every axis but
    answerable would starve small categories, so callers pass weights to ``choose``."""
    turns, kinds = threads(t)
    names, known, supply = counted(kinds)
    weights = {a: {k: float(n) for (axis, k), n in supply.items() if axis == a} for a in AXES}
    size = int(share * sum(m * n for _, m, n in known))
    taken = choose(known, quota_of(size, weights, supply, tolerance), size, tolerance)
    wanted = t.spark.createDataFrame([(k, n) for k, n in zip(names, taken) if n], "kind string, wanted bigint")
    # The first of each kind by hash: counted by slices of the hash, so that no kind is sorted in one task.
    sliced = kinds.withColumn("slice", F.substring("h", 1, 2))
    from pyspark.sql import Window

    before = sliced.groupBy("kind", "slice").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.sum("n").over(Window.partitionBy("kind").orderBy("slice")) - F.col("n")).drop("n")
    placed = sliced.withColumn("r", F.row_number().over(Window.partitionBy("kind", "slice").orderBy("h", "root"))).join(before, ["kind", "slice"])
    roots = placed.join(wanted, "kind").filter(F.col("r") + F.col("before") <= F.col("wanted")).select("root")
    return turns.join(roots, "root", "left_semi").select("id", "root", *AXES)


@query("P08, P10, P11: a release of half the drawable pool that holds the shares of four axes, threads whole, no two questions on one fact", None)
def release_draw(t: Tables) -> DataFrame:
    return drawn(t)


@query("P12, P13: the largest release with even difficulties and the pool's shares elsewhere, found by drawing", None)
def release_size(t: Tables) -> DataFrame:
    _, kinds = threads(t)
    _, known, supply = counted(kinds)
    weights = {a: {k: 1.0 if a == "difficulty" else float(n) for (axis, k), n in supply.items() if axis == a} for a in AXES}
    rows = [(t_, largest(known, weights, supply, t_, first_on(t.spark))) for t_ in (0.02, 0.05, 0.1)]
    return t.spark.createDataFrame(rows, "tolerance double, size bigint")


@query("P15: a release written: the old stamp cleared, the new one set, turns whose parent is not in it dropped", """
WITH n AS (SELECT DISTINCT id, follows_id FROM release_pool WHERE difficulty IS NOT NULL), k AS (SELECT id FROM n WHERE follows_id IS NULL UNION SELECT a.id FROM n a JOIN n b ON b.id = a.follows_id WHERE b.follows_id IS NULL
 UNION SELECT a.id FROM n a JOIN n b ON b.id = a.follows_id JOIN n c ON c.id = b.follows_id WHERE c.follows_id IS NULL UNION SELECT a.id FROM n a JOIN n b ON b.id = a.follows_id JOIN n c ON c.id = b.follows_id JOIN n d ON d.id = c.follows_id WHERE d.follows_id IS NULL)
SELECT q.id, CASE WHEN k.id IS NOT NULL THEN 'new' END AS release FROM questions q LEFT JOIN k USING (id)""")
def release_written(t: Tables) -> DataFrame:
    chosen = t.release_pool.filter("difficulty IS NOT NULL").select("id", "follows_id").distinct()
    placed = closure(chosen, "id", "follows_id")
    parents = chosen.filter("follows_id IS NOT NULL").join(chosen.select(F.col("id").alias("follows_id")), "follows_id", "left_anti").select(F.col("id").alias("root"))
    kept = placed.join(parents, "root", "left_anti").select("id").distinct().withColumn("release", F.lit("new"))
    return t.questions.select("id").join(kept, "id", "left")


@query("P03: each slot's kind and the one it is swapped for in turn", """
SELECT slot, (['atomic', 'summary', 'bridge'])[slot % 3 + 1] AS kind, (['atomic', 'summary', 'bridge'])[(slot + 1 + slot // 3 % 2) % 3 + 1] AS instead FROM (SELECT unnest(range(0, 40)) AS slot)""")
def slot_swaps(t: Tables) -> DataFrame:
    """The swap takes one of the two other kinds, the next in even rounds and the one after it in odd rounds."""
    kinds = F.array(*[F.lit(x) for x in ("atomic", "summary", "bridge")])
    at = lambda i: F.element_at(kinds, (i % 3 + 1).cast("int"))
    turn = F.col("slot") + 1 + F.floor(F.col("slot") / 3) % 2
    return t.spark.range(40).select(F.col("id").alias("slot")).select("slot", at(F.col("slot")).alias("kind"), at(turn).alias("instead"))
