"""Invariants of what SQL cannot say: apportionment, graphs, recursion, statistics, state and files."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions.columns import cosine, jaccard, normalised, numbers, words
from textloom.operators.aggregates import welch
from textloom.operators.components import components
from textloom.operators.sets import closure
from textloom.operators.windows import highest_averages, largest_remainder
from textloom.plans.integrity import merged, violations
from textloom.plans.selection import apportioned, largest_fillable
from textloom.sources.files import html_text, media_type, reader, uploads


@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.tuples(st.integers(0, 50), st.integers(0, 30)), min_size=1, max_size=8), st.integers(0, 120))
@settings(max_examples=200, deadline=None)
def test_apportionment_gives_all_that_can_be_given(names, size):
    weights, supply = {k: w for k, (w, _) in names.items()}, {k: s for k, (_, s) in names.items()}
    seats = apportioned(weights, supply, size)
    assert all(0 <= seats[k] <= supply[k] for k in seats)
    assert sum(seats.values()) == min(size, sum(supply[k] for k in names if weights[k] > 0))


def test_largest_fillable_holds_its_shares():
    assert largest_fillable({"a": 1, "b": 1}, {"a": 10, "b": 1000}, 0.0) == 22  # one seat from its share
    assert largest_fillable({"a": 1, "b": 1}, {"a": 0, "b": 0}) == 0


@pytest.mark.parametrize("seed", range(4))
def test_highest_averages_equals_the_iterative_rule(spark, seed):
    rng = random.Random(seed)
    weights = {f"n{i}": rng.randint(0, 40) for i in range(6)}
    taken = dict.fromkeys(weights, 0)
    for _ in range(25):
        if any(weights.values()):
            taken[min((n for n in weights if weights[n] > 0), key=lambda n: (-weights[n] / (2 * taken[n] + 1), n))] += 1
    df = spark.createDataFrame(list(weights.items()), "name string, w int")
    assert {r["name"]: r["seats"] for r in highest_averages(df, "name", "w", 25).collect()} == {n: k for n, k in taken.items() if k}


def test_largest_remainder_sums_to_the_size(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "name string, w int")
    assert {r["name"]: r["seats"] for r in largest_remainder(df, "name", "w", 10).collect()} == {"a": 4, "b": 3, "c": 3}


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)] + [(None, 5), (7, 7)]
    top: dict = {}

    def find(x):
        while top.get(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
            top.setdefault(a, find(a)), top.setdefault(b, find(b))
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in top}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_closure_of_a_long_chain_a_cycle_and_a_missing_parent(spark):
    rows = [(i, i - 1 if i else None) for i in range(150)] + [(500, 999), (501, 500), (700, 701), (701, 700)]
    got = {r["id"]: (r["root"], r["depth"]) for r in closure(spark.createDataFrame(rows, "id bigint, up bigint"), "id", "up").collect()}
    assert got == {**{i: (0, i) for i in range(150)}, 500: (500, 0), 501: (500, 1)}


def test_welch_against_known_values():
    # Two samples of eight with means 5 and 7 and variance 4: t = -2, 14 degrees of freedom.
    assert math.isclose(welch((8, 5.0, 4.0), (8, 7.0, 4.0)), 0.0653, abs_tol=5e-4)
    assert welch((1, 5.0, 0.0), (8, 7.0, 4.0)) is None and welch((3, 1.0, 0.0), (3, 1.0, 0.0)) is None
    assert welch((5, 1.0, 2.0), (9, 1.0, 3.0)) == 1.0


def test_column_readings_of_nulls_and_odd_texts(spark):
    df = spark.createDataFrame([(None,), ("",), ("  Straße  ÜBER\n9 ",), ("a_b 12 007 12",)], "t string")
    rows = df.select(normalised("t").alias("n"), words("t").alias("w"), numbers("t").alias("m")).collect()
    assert [r["n"] for r in rows] == [None, "", "strasse über 9", "a_b 12 007 12"]
    assert [r["w"] for r in rows] == [[], [], ["straße", "über", "9"], ["a", "b", "12", "007", "12"]]
    assert rows[3]["m"] == ["007", "12", "12"]


def test_similarities_abstain(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0]), ([1.0, 1.0], [2.0, 2.0]), ([1.0], [1.0, 0.0]), (None, [1.0])], "a array<double>, b array<double>")
    assert [None if r[0] is None else round(r[0], 9) for r in df.select(cosine("a", "b")).collect()] == [None, 1.0, None, None]
    one = spark.range(1).select(jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("j")).first()
    assert one["j"] is None


def test_merge_and_violations(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string"), spark.createDataFrame([(2, "z"), (3, "w")], "id int, v string")
    assert sorted(map(tuple, merged(a, b, "id").collect())) == [(1, "x"), (2, "z"), (3, "w")]
    found = violations(spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, n int"), "id", {"positive": F.col("n") > 0})
    assert [tuple(r) for r in found.collect()] == [(3, "positive")]


def test_uploads_and_readers(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.7 x")
    (tmp_path / "b.txt").write_text("plain")
    got = {r["path"].rsplit("/", 1)[1]: (r["mime_type"], r["size"]) for r in uploads(spark, str(tmp_path)).collect()}
    assert got == {"a.pdf": ("application/pdf", 10), "b.txt": ("text/plain", 5)}
    page = "<html><script>x</script><h1>T</h1><p>a &amp; b</p></html>"
    assert spark.createDataFrame([(page,)], "h string").select(html_text(F.col("h"))).first()[0] == "T\na & b"
    with pytest.raises(ValueError):
        reader("audio/mpeg")
    assert media_type is not None


def test_sources_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, t string")
    for mime, form in (("application/x-parquet", "parquet"), ("application/json", "json"), ("application/x-orc", "orc")):
        df.write.format(form).save(str(tmp_path / form))
        assert sorted(map(tuple, reader(mime)(spark, str(tmp_path / form)).select("id", "t").collect())) == [(1, "a"), (2, None)]
