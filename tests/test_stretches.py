import random

import pytest

from textloom.operators import windows


@pytest.mark.parametrize("seed", range(2))
def test_stretches_equal_one_window(spark, monkeypatch, seed):
    monkeypatch.setattr(windows, "STRETCH", 5)
    rng = random.Random(seed)
    rows = [(k, i, rng.choice([None, None, "a", "b"])) for k in ("x", "y") for i in sorted(rng.sample(range(60), 40))]
    df = spark.createDataFrame(rows, "k string, i int, v string")
    out = windows.carried(windows.carried(windows.ranked(df, "k", "i", "r"), "k", "i", "v", "back"), "k", "i", "v", "next", ahead=True)
    got = {(r["k"], r["i"]): (r["r"], r["back"], r["next"]) for r in out.collect()}
    for k in ("x", "y"):
        own = [r for r in rows if r[0] == k]
        for n, (_, i, _) in enumerate(own):
            back = next((v for _, _, v in reversed(own[: n + 1]) if v), None)
            ahead = next((v for _, _, v in own[n + 1 :] if v), None)
            assert got[k, i] == (n + 1, back, ahead)
    assert windows.ranked(df.limit(0), "k", "i", "r").count() == 0
