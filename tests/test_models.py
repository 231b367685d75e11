import pytest
from pyspark.sql import functions as F

from textloom.plans import models


def test_covered_area_of_overlaps():
    assert models.covered_area([(0, 0, 2, 2), (1, 1, 3, 3), (5, 5, 5, 9)]) == 7.0
    assert models.covered_area([]) == 0.0


def test_best_span():
    assert models.best_span([0.0, 5.0, 1.0], [3.0, 1.0, 2.0]) == (1, 2)  # an end before its start does not count
    assert models.best_span([1.0, 0.0], [0.0, 5.0], longest=1) == (1, 1)
    assert models.best_span([], []) is None


def test_served_retries_then_raises():
    seen = []

    def call(x):
        seen.append(x)
        if len(seen) < 3:
            raise OSError
        return "ok"

    assert models.served(call, 3, 0.0)("p") == "ok" and len(seen) == 3
    with pytest.raises(OSError):
        models.served(lambda _: (_ for _ in ()).throw(OSError()), 1, 0.0)("p")


def test_stand_ins(spark):
    df = spark.createDataFrame([(1, "Der Hof hat 3 Tore. Alles ruht."), (2, ""), (3, None)], "id int, t string")
    rows = models.embedded(df, "t").select("id", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x).alias("n")).collect()
    assert [round(r["n"], 6) for r in rows] == [1.0, 0.0, 0.0]
    assert [r["claim"] for r in models.claims(df, "t").collect()] == ["Der Hof hat 3 Tore."]
    assert models.chained(lambda d: d.filter("id > 1"), lambda d: d.select("id"))(df).count() == 2
