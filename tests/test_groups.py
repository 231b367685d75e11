import numpy as np
from pyspark.sql import functions as F

from textloom.operators.groups import walked
from textloom.operators.vectors import nearest


def test_groups_are_walked_whole_and_in_order(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), (5000 - F.col("id")).alias("v"))
    got = walked(df, ["k"], ["v"], lambda rows: [(rows[0][0], len(rows), int([r[1] for r in rows] == sorted(r[1] for r in rows)))], "k bigint, n int, sorted int").collect()
    assert sorted(map(tuple, got)) == [(k, len(range(k, 5000, 7)), 1) for k in range(7)]
    assert walked(df.limit(0), ["k"], ["v"], lambda rows: rows, "k bigint, v bigint").count() == 0


def test_nearest_in_blocks_equals_brute_force(spark, monkeypatch):
    from textloom.operators import vectors

    monkeypatch.setattr(vectors, "PART", 60)
    monkeypatch.setattr(vectors, "QUERIES", 40)
    rng = np.random.default_rng(0)
    v = rng.normal(size=(200, 8)).astype(np.float32)
    v[150:] = v[:50]  # copies tie
    rows = [(i, str(i % 3), [float(x) for x in v[i]]) for i in range(200)] + [(900, "0", None), (901, "0", [0.0] * 8), (902, "0", [1.0])]
    df = spark.createDataFrame(rows, "id bigint, key string, vector array<float>")
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    sims = np.round(u @ u.T, 6)
    for same in (None, True, False):
        got: dict = {}
        for r in nearest(df, df, 3, same, width=8).collect():
            got.setdefault(r["query"], {})[r["place"]] = r["id"]
        for i in range(200):
            ok = [j for j in range(200) if j != i and (same is None or (i % 3 == j % 3) == same)]
            want = sorted(ok, key=lambda j: (-sims[i, j], j))[:3]
            assert [got[i][p] for p in (1, 2, 3)] == want
