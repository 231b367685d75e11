"""Partners among passages that share a rare term: against all pairs, in blocks, on odd rows, and without a row for each pair."""

import random
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
from verify import rows  # noqa: E402

from textloom.operators import partners  # noqa: E402
from textloom.operators.catalog import ORACLES  # noqa: E402
from textloom.plans import links  # noqa: E402


class Given:
    """Tables made in a test."""

    def __init__(self, spark, **tables):
        self.spark = spark
        self.__dict__.update(tables)


def written(spark) -> int:
    """Rows that shuffles have written in this session."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def tables(spark, vocabulary: list, passages: list | None = None) -> Given:
    v = spark.createDataFrame(vocabulary, "id bigint, language string, lemmas array<string>")
    p = spark.createDataFrame(passages or [(i, "d", i, "", "en", f"1.{i}") for i in sorted({r[0] for r in vocabulary if r[0] is not None})], "id bigint, doc_sha256 string, ordinal int, text string, language string, section_path string")
    return Given(spark, passage_vocabulary=v, passages=p)


def of_sql(t: Given, name: str, tmp_path: Path):
    con = duckdb.connect()
    for table in ("passage_vocabulary", "passages"):
        getattr(t, table).write.mode("overwrite").parquet(str(tmp_path / table))
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path / table}/*.parquet'")
    cursor = con.execute(ORACLES[name])
    return rows([c[0] for c in cursor.description], cursor.fetchall())


def odd(seed: int) -> tuple[list, list]:
    rng = random.Random(seed)
    said = lambda: [rng.choice([" a", "A", "b", "c", "d", "", None, " ", *[f"x{k}" for k in range(40)]]) for _ in range(rng.randint(0, 9))]
    vocabulary = [(i, rng.choice(["de", "en", "en", None]), said()) for i in [*range(70), *range(20), None]] + [(71, "en", None)]
    passages = [(i, rng.choice(["d", "e", None]), rng.randrange(90), rng.choice(["", "see section 2", "Abschnitt 3 und section 1"]), "en", rng.choice([None, "2", f"{rng.randint(1, 3)}.{rng.randint(1, 9)}"])) for i in range(80)]
    return vocabulary, passages


@pytest.mark.parametrize("name", ["head_partners", "grown_pairs", "alike_and_apart"])
def test_links_of_odd_rows_equal_sql(spark, tmp_path, name):
    for seed in range(2):
        t = tables(spark, *odd(seed))
        df = getattr(links, name)(t)
        assert rows(df.columns, [tuple(r) for r in df.collect()]) == of_sql(t, name, tmp_path / str(seed))


@pytest.mark.parametrize("alike, block, slab", [(True, 7, 50), (False, 7, 2_000_000), (False, 2000, 50), (True, 2000, 2_000_000)])
def test_extremes_of_groups_equal_all_pairs(spark, monkeypatch, alike, block, slab):
    monkeypatch.setattr(partners, "SLAB", slab)
    rng = random.Random(block)
    words = {i: rng.sample("abcdefghij", rng.randint(0 if not alike else 1, 6)) for i in range(60)}
    groups = {(1, "g", "one"): [5], (1, "g", "two"): rng.sample(range(60), 30), (2, "g", "two"): rng.sample(range(60), 8), (2, "h", "two"): rng.sample(range(60), 25)}
    want = {}
    for (tier, g, term), ids in groups.items():
        for a in ids:
            found = []
            for b in ids:
                if a != b:
                    n = len({*words[a]} & {*words[b]})
                    found.append((round(n / len({*words[a], *words[b]}) * 1e9) if alike else n, b))
            if found:
                key = (tier, a)
                top, low = min((-s, b) for s, b in found), min(found)
                want[key] = (min(want[key][0], top), min(want[key][1], low)) if key in want else (top, low)
    df = spark.createDataFrame([(*k, i, len(ids), words[i]) for k, ids in groups.items() for i in ids], "tier int, g string, term string, id bigint, df bigint, w array<string>")
    got = {}
    for r in partners.extremes(df, partners.ALIKE if alike else partners.SHARED, block).collect():
        key, top, low = (r["tier"], r["id"]), (-r["most"], r["near"]), (r["least"], r["far"])
        got[key] = (min(got[key][0], top), min(got[key][1], low)) if key in got else (top, low)
    assert {k: v if alike else v[0] for k, v in got.items()} == {k: v if alike else v[0] for k, v in want.items()}


def many(spark) -> Given:
    rng = random.Random(0)
    return tables(spark, [(i, "en", [f"r{i % 200}", *rng.sample([f"f{k}" for k in range(20)], 10)]) for i in range(8000)], [(i, f"d{i}", i, "", "en", "1") for i in range(8000)])


@pytest.mark.parametrize("name", ["head_partners", "grown_pairs", "alike_and_apart"])
def test_no_row_is_made_for_a_pair(spark, name):
    """Two hundred terms of forty passages: 156,000 pairs of about five terms in common."""
    t, before = many(spark), written(spark)
    assert getattr(links, name)(t).count() >= 4000
    assert written(spark) - before < 150_000
