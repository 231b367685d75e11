"""The register of queries: a name, what it covers, how to run it, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


class Tables:
    """The input tables by name: ``t.facts`` is the table facts."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


def query(covers: str, sql: str | None = None) -> Callable:
    """Registers a function from Tables to a DataFrame under its own name."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        COVERS[f.__name__] = covers
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
