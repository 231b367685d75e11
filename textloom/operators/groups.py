"""Order-dependent work over many small groups, without the cost of a call into Python for each."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from textloom.session import shipped


def walked(df: DataFrame, keys: list[str], order: list[str], step: Callable[[list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """What ``step`` gives for the rows of each group, in order. One shuffle by the keys; a task walks its groups one after the other and
    holds the rows of one group at a time, so groups have to be bounded by the caller."""
    shipped(df.sparkSession)
    names = df.columns
    at = [names.index(k) for k in keys]
    out = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[] for _ in out]
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, out)], schema=out)

        for b in batches:
            found: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                key = tuple(row[i] for i in at)
                if key != now:
                    if held:
                        found.extend(step(held))
                    now, held = key, []
                held.append(row)
            yield emit(found)
        if held:
            yield emit(list(step(held)))

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(walk, schema)
