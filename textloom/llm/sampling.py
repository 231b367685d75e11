"""A sample that holds target shares on several axes at once, with a floor for small categories.

Divisor-method priorities: within each cell of the axes the rows are ranked at random and row ``rank`` gets the priority
(rank - 0.5) / weight of the cell; the globally smallest priorities are kept. A cell that runs out simply has no more
priorities, so its seats go to the others by themselves. Rows that fill a category's floor come first. Cell weights are the
targets of all axes raked against the pool, so that every axis holds its shares as far as the pool allows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import stored

#: Rows of targets and cells of the axes that are taken to the driver at most; more raise an error.
MOST = 200_000
#: Rows of one cell that are ranked in one task, about; a larger cell is ranked in slices of the random order.
SLICE = 50_000


def _clean(c: str) -> Column:
    return F.lower(F.trim(F.col(c).cast("string")))


def _few(df: DataFrame) -> list[dict]:
    rows = df.limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} targets or cells")
    return [r.asDict() for r in rows]


def _ranked(rows: DataFrame, keys: list[str], slices: int) -> DataFrame:
    """``rows`` (with id and its random number h) and ``rank``, the place of each within its keys in the order of h. A group is not sorted in
    one task: each slice of the range of h is ranked by itself, after what lies before it."""
    sliced = rows.withColumn("slice", F.floor((F.col("h") / 2.0**64 + 0.5) * F.lit(slices)))
    sizes = sliced.groupBy(*keys, "slice").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy(*keys).orderBy("slice")) - F.col("n")).drop("n")
    ranked = sliced.withColumn("r", F.row_number().over(Window.partitionBy(*keys, "slice").orderBy("h", "id")))
    met = ranked.join(before, _same(ranked, before, keys) & (ranked["slice"] == before["slice"]))
    return met.select(ranked["id"], *[ranked[k] for k in keys], (F.col("r") + F.col("before")).alias("rank"))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def _slices(rows: int) -> int:
    return max(1, rows // SLICE)


def _places(pool: DataFrame, targets: DataFrame, id_col: str) -> DataFrame:
    """Each target row with the size of its release and its places."""
    ids = pool.agg(F.countDistinct(id_col).alias("ids"))
    wanted = targets.select("release_name", "size_pct", "axis", _clean("category").alias("category"), "target_pct", "min_rows").distinct()
    sized = wanted.crossJoin(ids).withColumn("size", F.floor(F.col("ids") * F.col("size_pct") / 100))  # ids is one row
    places = F.greatest(F.floor(F.col("size") * F.col("target_pct") / 100), F.col("min_rows").cast("bigint"))
    return sized.select("release_name", "axis", "category", "size", "target_pct", places.alias("places"))


def _weighted(cells: list[tuple], counts: np.ndarray, own: list[dict], axes: list[str]) -> np.ndarray:
    """Weights of the cells raked to the targets of one release, kept within the range that the priorities resolve."""
    shares = [{r["category"]: float(r["target_pct"] or 0) for r in own if r["axis"] == a and r["category"] is not None} for a in axes]
    kept = [k for k, s in enumerate(shares) if s]
    w = raked([tuple(c[k] for k in kept) for c in cells], counts, [shares[k] for k in kept])
    return np.where(w > 0, np.maximum(w, w.max(initial=0.0) * 1e-9), 0.0)


def placed(pool: DataFrame, wanted: list[dict], axes: list[str], id_col: str = "id", seed: int = 0) -> DataFrame:
    """The draw in which every target row's places are its floor: release (the place of its name in ``names``), id, and for each axis the
    record's categories. ``wanted`` are rows of _places.

    The draw is that of ``draw``: cells of all axes with raked weights, the places that a category still lacks given to its cells by the priorities
    (rank - 0.5) / weight, then the smallest priorities of all cells up to the size, and in each cell the first ranks of its random order. As
    floors come first, the draw grows beyond its size if the places of all axes need more, and a category misses places only when all its
    records are drawn. A record whose rows name several categories of an axis counts for each; categories no target names count for none.
    """
    spark = pool.sparkSession
    own_axis = [sorted({r["category"] for r in wanted if r["axis"] == a and r["category"] is not None}) for a in axes]
    some = [F.when(_clean(a).isin(cs), _clean(a)).alias(a) for a, cs in zip(axes, own_axis)]
    sets = [F.sort_array(F.collect_set(a)).alias(a) for a in axes]
    rows = pool.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), *some).groupBy("id").agg(*sets)
    rows = stored(rows.withColumn("h", F.xxhash64("id", F.lit(seed))))
    found = _few(rows.groupBy(*axes).agg(F.count(F.lit(1)).alias("n")))
    cells = [tuple(tuple(r[a]) for a in axes) for r in found]
    counts = np.array([r["n"] for r in found], dtype=np.int64)
    got = []
    for release, name in enumerate(names(wanted)):
        own = [r for r in wanted if r["release_name"] == name]
        weights = _weighted([tuple(c[0] if c else None for c in cell) for cell in cells], counts, own, axes)
        floors = np.zeros(len(cells), dtype=np.int64)
        members = [np.array([r["axis"] in axes and r["category"] in c[axes.index(r["axis"])] for c in cells], dtype=bool) for r in own]
        asked = [(int(counts[inside].sum()) - (r["places"] or 0), r["places"] or 0, k) for k, (r, inside) in enumerate(zip(own, members)) if inside.any()]
        for _, places, k in sorted(asked):  # the scarcest first; a later row adds what it still lacks
            inside = members[k]
            floors[inside] = seats(counts[inside], np.maximum(weights[inside], 1e-12), floors[inside], max(places, int(floors[inside].sum())))
        size = max(int(floors.sum()), *(r["size"] or 0 for r in own))
        got += [(release, *map(list, c), int(n)) for c, n in zip(cells, seats(counts, weights, floors, size)) if n]
    given = spark.createDataFrame(got, ", ".join(["release int", *(f"{a} array<string>" for a in axes), "seats bigint"]))
    ranked = _ranked(rows, axes, _slices(int(counts.max(initial=0))))
    return ranked.join(given, _same(ranked, given, axes) & (F.col("rank") <= F.col("seats"))).select("release", "id", *[ranked[a] for a in axes])


def names(wanted: list[dict]) -> list[str | None]:
    """The releases' names, each once."""
    return sorted({r["release_name"] for r in wanted}, key=lambda n: (n is not None, n or ""))


def report(pool: DataFrame, targets: DataFrame, axes: list[str], id_col: str = "id", seed: int = 0) -> DataFrame:
    """What the draw over all axes that puts every target row's places first could fill of them: release_name, axis, category, size, places,
    taken, short.

    Pool rows count once per id, null ids not at all; values are compared lower-cased and freed of spaces around them, null
    belongs to no category. Size is size_pct percent of the distinct ids, rounded down; places are target_pct percent of the
    size, rounded down, at least min_rows. The records drawn by ``placed`` are counted: what they fill of a row's places is taken, and a row
    is short if that is less than its places, for which all records of its category must have been drawn.
    """
    wanted = _few(_places(pool, targets, id_col))
    drawn = placed(pool, wanted, axes, id_col, seed)
    values = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("categories")) for a in axes])).alias("v")
    in_each = drawn.select("release", values).select("release", "v.axis", F.explode("v.categories").alias("category"))
    have = in_each.groupBy("release", "axis", "category").agg(F.count(F.lit(1)).alias("drawn"))
    at = {name: k for k, name in enumerate(names(wanted))}
    rows = [(at[r["release_name"]], r["release_name"], r["axis"], r["category"], r["size"], r["places"]) for r in wanted]
    asked = pool.sparkSession.createDataFrame(rows, "release int, release_name string, axis string, category string, size bigint, places bigint")
    both = asked.join(have, ["release", "axis", "category"], "left").withColumn("taken", F.least(F.coalesce("drawn", F.lit(0)), F.col("places")))
    return both.select("release_name", "axis", "category", "size", "places", "taken", (F.col("taken") < F.col("places")).alias("short"))


def shortfalls(drawn: DataFrame, pool: DataFrame, targets: DataFrame, axes: list[str], id_col: str = "id") -> DataFrame:
    """What a joint draw gave every target row: release_name, axis, category, places, drawn, missed. The axes are drawn together, so a
    category may miss places that it could fill alone; here that shows."""
    values = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("category")) for a in axes])
    have = drawn.select("release_name", F.explode(values).alias("v")).groupBy("release_name", "v.axis", "v.category").agg(F.count(F.lit(1)).alias("drawn"))
    both = _places(pool, targets, id_col).join(have, ["release_name", "axis", "category"], "left")
    return both.select("release_name", "axis", "category", "places", F.coalesce("drawn", F.lit(0)).alias("drawn")).withColumn("missed", F.greatest(F.lit(0), F.col("places") - F.col("drawn")))


def seats(counts: np.ndarray, weights: np.ndarray, floors: np.ndarray, size: int) -> np.ndarray:
    """Seats of each cell: its floor first, then the smallest (rank - 0.5) / weight over all cells until ``size`` seats are
    given or the cells are exhausted. Cells without weight come last. Found by bisection on the priority, then one by one."""
    size = int(min(size, counts.sum()))
    least = np.minimum(floors, counts).astype(np.int64)
    if least.sum() >= size:
        order = np.argsort(-least, kind="stable")
        for i in order[::-1]:
            least[i] -= max(0, min(least[i], least.sum() - size))
        return least
    w = np.where(weights > 0, weights, weights[weights > 0].min() * 1e-9 if (weights > 0).any() else 1.0)

    def given(bar: float) -> np.ndarray:
        return np.clip(np.floor(np.minimum(w * bar, counts) + 0.5).astype(np.int64), least, counts)

    low, high = 0.0, (float(counts.max()) + 1) / float(w.min())
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if given(middle).sum() <= size else (low, middle)
    out = given(low)
    while out.sum() < size:
        open_ = out < counts
        nearest = np.where(open_, (out + 0.5) / w, np.inf)
        out[int(np.argmin(nearest))] += 1
    return out


def raked(cells: list[tuple], counts: np.ndarray, shares: list[dict[str, float]], rounds: int = 200) -> np.ndarray:
    """Cell weights with the wanted share of each category on each axis, starting from the pool's own counts."""
    w = counts.astype(float)
    index = [np.array([list(s).index(c[k]) if c[k] in s else -1 for c in cells], dtype=np.int64) for k, s in enumerate(shares)]
    for k in range(len(shares)):
        w[index[k] < 0] = 0.0  # a category that no target names
    for _ in range(rounds):
        for k, s in enumerate(shares):
            want = np.array(list(s.values()))
            have = np.bincount(index[k][index[k] >= 0], w[index[k] >= 0], len(want))
            factor = np.where(have > 0, want / np.maximum(have, 1e-300), 0.0)
            w = np.where(index[k] >= 0, w * factor[index[k]], 0.0)
    return w


def draw(pool: DataFrame, targets: DataFrame, axes: list[str], id_col: str = "id", seed: int = 0) -> DataFrame:
    """The drawn ids of every release: release_name, id, and the cleaned axes.

    Of rows with one id the smallest counts. The order within a cell is random by the hash of id and seed; the draw is the same at any
    partitioning. Where the pool is smaller than the release, all its rows are drawn. An empty pool gives none.
    """
    spark = pool.sparkSession
    named = [_clean(a).alias(a) for a in axes]
    rows = pool.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), *named).groupBy("id").agg(F.min(F.struct(*axes)).alias("v")).select("id", "v.*")
    rows = stored(rows.withColumn("h", F.xxhash64("id", F.lit(seed))))
    found = _few(rows.groupBy(*axes).agg(F.count(F.lit(1)).alias("n")))
    cells = [tuple(r[a] for a in axes) for r in found]
    counts = np.array([r["n"] for r in found], dtype=np.int64)
    wanted = _few(targets.select("release_name", "size_pct", "axis", _clean("category").alias("category"), "target_pct", "min_rows").distinct())
    got = []
    for release in sorted({r["release_name"] for r in wanted}):
        own = [r for r in wanted if r["release_name"] == release]
        shares = [{r["category"]: float(r["target_pct"]) for r in own if r["axis"] == a} for a in axes]
        kept = [k for k, s in enumerate(shares) if s]
        weights = raked([tuple(c[k] for k in kept) for c in cells], counts, [shares[k] for k in kept])
        size, floors = int(counts.sum()) * own[0]["size_pct"] // 100, np.zeros(len(cells), dtype=np.int64)
        for r in own:  # a category's floor, spread over its cells as they are weighted
            inside = np.array([c[axes.index(r["axis"])] == r["category"] for c in cells], dtype=bool)
            if inside.any():
                part = seats(counts[inside], np.maximum(weights[inside], 1e-12), np.zeros(inside.sum(), dtype=np.int64), r["min_rows"] or 0)
                floors[inside] = np.maximum(floors[inside], part)
        got += [(release, *c, int(n)) for c, n in zip(cells, seats(counts, weights, floors, size)) if n]
    spec = ", ".join(["release_name string", *(f"{a} string" for a in axes), "seats bigint"])
    given = spark.createDataFrame(got, spec)
    ranked = _ranked(rows, axes, _slices(int(counts.max() if len(counts) else 0)))
    return ranked.join(given, _same(ranked, given, axes) & (F.col("rank") <= F.col("seats"))).select("release_name", "id", *[ranked[a] for a in axes])
