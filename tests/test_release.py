"""The release draw, the queue's verbs, numbers, tables and dumps on small made cases."""

import itertools
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions.numbers import adds_up, figures, spelled
from textloom.functions.text import grid_statements
from textloom.plans import models, release
from textloom.plans.selection import independent
from textloom.streaming import queue


@given(st.lists(st.integers(0, 30), max_size=7), st.integers(0, 80))
@settings(max_examples=300, deadline=None)
def test_sums_of_two_to_four_equal_all_combinations(values, answer):
    for terms in (2, 3, 4):
        want = any(sum(c) == answer for n in range(2, terms + 1) for c in itertools.combinations(values, n))
        assert adds_up([float(v) for v in values], float(answer), terms) == want


def test_number_words_by_rule():
    table = spelled()
    assert [table[w] for w in ("seventeen", "twenty-one", "fortieth", "ninety-ninth", "siebzehn", "einundzwanzig", "dritte", "zwanzigsten", "neunundneunzigster", "first", "siebter")] == [17, 21, 40, 99, 17, 21, 3, 20, 99, 1, 7]


def test_figures_under_separators(spark):
    rows = [(1, "de", "1.234,50 und 3,5 und 1.5"), (2, "en", "1,234.50 and 3.5 and 12,345,678"), (3, "de", "am 12.5.2020 um 007"), (4, None, None), (5, "en", "")]
    got = {r["id"]: r["f"] for r in spark.createDataFrame(rows, "id int, l string, t string").select("id", figures(F.col("t"), F.col("l")).alias("f")).collect()}
    assert got == {1: ["1234.5", "3.5", "1.5"], 2: ["1234.5", "3.5", "12345678"], 3: ["7"], 4: [], 5: []}


def test_header_stacks_with_spans(spark):
    cells = [("t", "S", 0, 1, 1, 2, "column", "Year"), ("t", "S", 1, 1, 1, 1, "column", "2019"), ("t", "S", 1, 2, 1, 1, "column", "2020"), ("t", "S", 2, 0, 2, 1, "row", "Boats"), ("t", "S", 2, 1, 1, 1, None, "5"), ("t", "S", 3, 2, 1, 1, None, " 7 "), ("t", "S", 3, 1, 1, 1, None, "")]
    df = spark.createDataFrame(cells, "id string, scope string, row bigint, col bigint, row_span bigint, col_span bigint, header string, text string")
    assert {r["statement"] for r in grid_statements(df, ["id"]).collect()} == {"S - Boats - Year, 2019: 5", "S - Boats - Year, 2020: 7"}
    assert grid_statements(df.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_independent_items_equal_the_walk(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(25), f"{rng.random():.9f}") for i in range(40)]
    rows = [(i, k, h) for i, _, h in rows for k in {rng.randrange(25) for _ in range(rng.randint(1, 3))}]
    taken, want = set(), set()
    for h, i in sorted({(h, i) for i, _, h in rows}):
        keys = {k for j, k, _ in rows if j == i}
        if not keys & taken:
            want.add(i)
            taken |= keys
    df = spark.createDataFrame(rows, "item int, key int, h string")
    assert {r["item"] for r in independent(df).collect()} == want
    assert independent(df.limit(0)).count() == 0


KINDS = [({("d", "easy"): 1, ("l", "de"): 1}, 1, 60), ({("d", "hard"): 1, ("l", "de"): 1}, 1, 10), ({("d", "easy"): 1, ("l", "en"): 1}, 1, 30), ({("d", "hard"): 1, ("l", "en"): 1}, 1, 50), ({("d", "easy"): 1, ("d", "hard"): 1, ("l", "en"): 2}, 2, 10)]


def test_draw_holds_all_axes():
    quota = {("d", "easy"): 40, ("d", "hard"): 40, ("l", "de"): 40, ("l", "en"): 40}
    taken = release.choose(KINDS, quota, 80, 0.05)
    assert all(0 <= n <= k[2] for n, k in zip(taken, KINDS)) and release.close_enough(taken, KINDS, quota, 80, 0.05)
    assert release.choose([], quota, 80, 0.05) == [] and sum(release.choose(KINDS, quota, 0, 0.05)) == 0
    supply = {("d", "easy"): 100, ("d", "hard"): 70, ("l", "de"): 70, ("l", "en"): 100}
    even = {"d": {"easy": 1.0, "hard": 1.0}, "l": {"de": 1.0, "en": 1.0}}
    size = release.largest(KINDS, even, supply, 0.02)
    assert 130 <= size <= 150


def test_draw_is_that_of_a_look_at_every_kind_and_not_slow(spark):
    """The choice as defined, every kind looked at for every thread, and a pool of some thousand kinds in seconds."""

    def plain(kinds, quota, size, tolerance):
        need, over, taken, left = dict(quota), {c: release.slack(n, tolerance) for c, n in quota.items()}, [0] * len(kinds), size
        fit = lambda i: taken[i] < kinds[i][2] and kinds[i][1] <= left and all(n <= need.get(k, 0) + over.get(k, 0) for k, n in kinds[i][0].items())
        while left > 0:
            for c in sorted((c for c, n in need.items() if n > 0), key=lambda c: (-need[c] / quota[c], c)):
                if fits := [i for i in range(len(kinds)) if c in kinds[i][0] and fit(i)]:
                    break
            else:
                break
            best = max(fits, key=lambda i: (sum(min(n, max(0, need.get(k, 0))) for k, n in kinds[i][0].items()) / kinds[i][1], -i))
            cells, turns, there = kinds[best]
            many = max(1, min([there - taken[best], left // turns, max(1, need[c] // (100 * cells[c])), *((need.get(k, 0) + over.get(k, 0)) // n for k, n in cells.items())]))
            taken[best] += many
            left -= many * turns
            for k, n in cells.items():
                need[k] = need.get(k, 0) - many * n
        return taken

    def made(rng, many, there):
        out = []
        for _ in range(many):
            turns = [[("d", rng.choice("abc")), ("q", rng.choice("klmnopqrst")), ("l", rng.choice("xy")), ("v", rng.choice("01"))] for _ in range(rng.choice([1, 1, 2, 3]))]
            cells: dict = {}
            for c in (c for x in turns for c in x if rng.random() < 0.95):
                cells[c] = cells.get(c, 0) + 1
            out.append((cells, len(turns), rng.randint(1, there)))
        supply: dict = {}
        for cells, _, n in out:
            for c, m in cells.items():
                supply[c] = supply.get(c, 0) + n * m
        return out, supply, {a: {k: 1.0 if a == "d" else float(n) for (axis, k), n in supply.items() if axis == a} for a in "dqlv"}

    for seed in range(6):
        kinds, supply, weights = made(random.Random(seed), 60, 20)
        pool = sum(turns * n for _, turns, n in kinds)
        for size in (pool // 3, pool // 2, pool):
            quota = release.quota_of(size, weights, supply, 0.05)
            assert release.choose(kinds, quota, size, 0.05) == plain(kinds, quota, size, 0.05)
        assert release.largest(kinds, weights, supply, 0.05) == release.largest(kinds, weights, supply, 0.05, release.first_on(spark)) > 0
    kinds, supply, weights = made(random.Random(9), 4000, 30)
    size = sum(turns * n for _, turns, n in kinds) // 2
    quota = release.quota_of(size, weights, supply, 0.05)
    began = time.process_time()
    assert sum(n * k[1] for n, k in zip(release.choose(kinds, quota, size, 0.05), kinds)) > 0.9 * size
    assert time.process_time() - began < 3


def test_release_keeps_threads_whole_and_facts_apart(spark):
    from textloom.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.01")
    rows = release.drawn(t).collect()
    turns, _ = release.threads(t)
    by_root = {r["root"]: r["n"] for r in turns.groupBy("root").agg(F.count("id").alias("n")).collect()}
    drawn: dict = {}
    for r in rows:
        drawn[r["root"]] = drawn.get(r["root"], 0) + 1
    assert len({r["id"] for r in rows}) == len(rows) and all(by_root[k] == n for k, n in drawn.items())
    root = {r["id"]: r["root"] for r in rows}
    holders: dict = {}
    for r in t.question_facts.collect():
        if r["question_id"] in root:
            holders.setdefault(r["fact_id"], set()).add(root[r["question_id"]])
    assert all(len(x) == 1 for x in holders.values())


def _queue(spark):
    rows = [(1, "pending", 5), (2, "pending", 3), (3, "in_progress", 1), (4, "in_progress", 9), (5, "done", 2), (6, "failed", 2), (7, "new", 1)]
    df = spark.createDataFrame(rows, "key int, state string, at int")
    at = F.timestamp_add("HOUR", F.col("at"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return df.select("key", "state", at.alias("since"), F.when(F.col("state") == "in_progress", at).alias("claimed_at"), F.lit(None).cast("string").alias("trigger"), F.lit(None).cast("string").alias("note"))


def test_verbs_change_only_what_they_may(spark):
    q, now = _queue(spark), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    states = lambda df: {r["key"]: r["state"] for r in df.collect()}
    before = states(q)
    for name, (leaves, to) in queue.VERBS.items():
        got = states(queue.verb(q, name, at=now))
        assert got == {k: to if s in leaves else s for k, s in before.items()}
    assert states(queue.claimed(q, 1, now)) == before | {2: "in_progress"}
    assert states(queue.swept(q, now, "5 HOURS")) == before | {3: "failed"}
    claims = q.select("key", "claimed_at").filter("claimed_at IS NOT NULL")
    late = claims.withColumn("claimed_at", F.timestamp_add("HOUR", F.lit(-1), "claimed_at"))
    results = lambda c: c.withColumn("outcome", F.lit("done")).withColumn("note", F.lit("x"))
    assert states(queue.finished(q, results(late))) == before and states(queue.finished(q, results(claims))) == before | {3: "done", 4: "done"}
    beat = queue.touched(q, claims.filter("key = 3").withColumn("at", now)).filter("key = 3").first()
    assert beat["claimed_at"].hour == 10 and queue.touched(q, late.withColumn("at", now)).filter("key = 3").first()["claimed_at"].hour == 1
    work = lambda rows: rows.select("key", "claimed_at", F.when(F.col("key") == 1, "failed").otherwise("done").alias("outcome"), F.lit(None).cast("string").alias("note"))
    assert states(queue.drained(q, now, "5 HOURS", work, n=1)) == before | {1: "failed", 2: "done", 3: "failed"}


def test_settings_are_read_anew_and_annotations_flushed(spark):
    seen, written, settings_ = [], [], iter([{"bar": 1}, {"bar": 2}])
    step = queue.reloading(lambda: next(settings_), lambda batch, s: seen.append((s["bar"], batch.count())))
    step(spark.range(3), 0)
    step(spark.range(4), 1)
    assert seen == [(1, 3), (2, 4)]
    keep, flush = queue.flushing(lambda rows: written.append(rows.count()), least=5)
    for n in (2, 2, 2, 1):
        keep(spark.range(n), 0)
    assert written == [6]
    flush()
    assert written == [6, 1]


def test_dumped_models_are_refused_in_another_format(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a", 0, 0.5), ("a", 1, -1.0)], "name string, at int, value double")
    models.dumped(df, str(tmp_path / "m"))
    assert {tuple(r) for r in models.loaded(spark, str(tmp_path / "m")).collect()} == {("a", 0, 0.5), ("a", 1, -1.0)}
    monkeypatch.setattr(models, "MODEL_FORMAT", 2)
    with pytest.raises(ValueError):
        models.loaded(spark, str(tmp_path / "m"))
