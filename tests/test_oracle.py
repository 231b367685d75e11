"""Every query of the library beside its SQL on the smallest tables, and every other one simply run."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
from verify import rows  # noqa: E402

from textloom.operators.catalog import COVERS, ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLES:
        cursor = db.execute(ORACLES[name])
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows(columns, cursor.fetchall())


def test_every_query_says_what_it_covers():
    assert all(COVERS[n] for n in QUERIES)
    assert set(ORACLES) <= set(QUERIES)
