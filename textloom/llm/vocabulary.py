"""Frequency of every distinct term, counted in burst tries.

A burst trie keeps terms in small containers hung below an access trie; a container that grows past
``BURST`` entries is burst into one container per next character, so the prefixes that route a term are
short where terms are few and long where they are many. Every worker counts its share of the records in
such a trie and emits its containers: a prefix with the sorted terms below it and their two counters.
Containers are routed by the first ROUTE characters of their prefix, by more where very many terms begin so, and a
container above a route is cut along it; so a task holds all workers' subtrees of a route and merges them into
one trie, workers having added up their own records before: a frequent term costs one entry a worker and not one a record.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import shipped, stored

#: Entries of a container before it bursts.
BURST = 1024
#: Distinct terms a worker holds before it emits its trie and starts anew; counters add up, so nothing is lost.
HELD = 400_000
#: Characters of a route, and of one that DEEP entries or more begin with. Such routes are few: at most the entries divided by DEEP.
ROUTE, FURTHER, DEEP = 2, 6, 500_000


class BurstTrie:
    """Terms with an occurrence and a record counter. A node is a dict from character to node; a container
    is a list [dict of suffix to index, occurrences, records]; '' among a node's keys holds the term that ends there."""

    def __init__(self, burst: int = BURST) -> None:
        self.burst, self.size, self.root = burst, 0, [{}, [], []]

    def add(self, term: str, occurrences: int, records: int) -> None:
        node, above, at, depth = self.root, None, "", 0
        while type(node) is dict:
            at = term[depth : depth + 1]
            above = node
            node = node.get(at)
            depth += 1
        if node is None:
            node = above[at] = [{}, [], []]
        index, occ, rec = node
        suffix = term[depth:]
        i = index.get(suffix)
        if i is not None:
            occ[i] += occurrences
            rec[i] += records
            return
        index[suffix] = len(occ)
        occ.append(occurrences)
        rec.append(records)
        self.size += 1
        if len(occ) > self.burst and (above is None or at):
            burst = self._burst(node)
            if above is None:
                self.root = burst
            else:
                above[at] = burst

    @staticmethod
    def _burst(container: list) -> dict:
        node: dict = {}
        index, occ, rec = container
        for suffix, i in index.items():
            child = node.setdefault(suffix[:1], [{}, [], []])
            child[0][suffix[1:]] = len(child[1])
            child[1].append(occ[i])
            child[2].append(rec[i])
        return node

    def containers(self) -> Iterator[tuple[str, list[str], list[int], list[int]]]:
        """Prefix, sorted terms and both counters of each container, in the order of the prefixes."""
        stack: list = [("", self.root)]
        while stack:
            prefix, node = stack.pop()
            if type(node) is dict:
                stack += [(prefix + c, child) for c, child in sorted(node.items(), reverse=True)]
            elif node[0]:
                order = sorted(node[0])
                at = [node[0][s] for s in order]
                yield prefix, [prefix + s for s in order], [node[1][i] for i in at], [node[2][i] for i in at]


    def merge(self, terms: list[str], occurrences: list[int], records: list[int]) -> None:
        """Adds another worker's container."""
        for term, occ, rec in zip(terms, occurrences, records):
            self.add(term, occ, rec)


def cut(prefix: str, terms: list[str], length: int) -> Iterator[tuple[str, int, int]]:
    """(route, first, last + 1) of the runs of sorted ``terms`` of a container with one beginning of ``length`` characters."""
    if len(prefix) >= length:
        yield prefix[:length], 0, len(terms)
        return
    start = 0
    for i in range(1, len(terms) + 1):
        if i == len(terms) or terms[i][:length] != terms[start][:length]:
            yield terms[start][:length], start, i
            start = i


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("language", pa.string()), ("route", pa.string()), ("terms", pa.list_(pa.string())), ("occurrences", pa.list_(pa.int64())), ("records", pa.list_(pa.int64())), ("with_terms", pa.int64())]
    )
    tries: dict[str, BurstTrie] = {}
    with_terms: dict[str, int] = {}

    def emit() -> Iterator[pa.RecordBatch]:
        rows = [(language, route, terms[s:e], occ[s:e], rec[s:e], 0) for language, trie in tries.items() for prefix, terms, occ, rec in trie.containers() for route, s, e in cut(prefix, terms, ROUTE)]
        rows += [(language, None, [], [], [], n) for language, n in with_terms.items()]
        tries.clear()
        with_terms.clear()
        for s in range(0, len(rows), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[s : s + 2000]), schema)], schema=schema)

    for batch in batches:
        lists = batch.column("terms")
        flat, parent = lists.flatten(), pc.list_parent_indices(lists)
        t = pa.table({"record": parent, "term": pc.utf8_trim_whitespace(pc.utf8_lower(flat))})
        t = t.filter(pc.fill_null(pc.greater(pc.utf8_length(t["term"]), 0), False))
        t = t.append_column("language", batch.column("language").take(t["record"]))
        each = t.group_by(["record", "language", "term"]).aggregate([([], "count_all")])
        for row in each.group_by(["record", "language"]).aggregate([]).group_by("language").aggregate([([], "count_all")]).to_pylist():
            with_terms[row["language"]] = with_terms.get(row["language"], 0) + row["count_all"]
        both = each.group_by(["language", "term"]).aggregate([("count_all", "sum"), ("count_all", "count")])
        columns = (both[c].to_pylist() for c in ("language", "term", "count_all_sum", "count_all_count"))
        for language, term, occurrences, records in zip(*columns):
            trie = tries.get(language)
            if trie is None:
                trie = tries[language] = BurstTrie()
            trie.add(term, occurrences, records)
        if sum(x.size for x in tries.values()) > HELD:
            yield from emit()
    yield from emit()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One trie of each (language, route) from all its containers, as rows of terms."""
    schema = pa.schema([("language", pa.string()), ("lemma", pa.string()), ("occurrences", pa.int64()), ("passages", pa.int64())])
    now, trie = None, None

    def emit() -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], []]
        for _, *c in trie.containers():
            for column, values in zip(columns, c):
                column += values
        for s in range(0, len(columns[0]), 10_000):
            part = [c[s : s + 10_000] for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array([now[0]] * len(part[0]), pa.string()), *(pa.array(c, f.type) for c, f in zip(part, list(schema)[1:]))], schema=schema)

    for b in batches:
        for language, route, *container in zip(*(b.column(c).to_pylist() for c in ("language", "route", "terms", "occurrences", "records"))):
            if (language, route) != now:
                if trie is not None:
                    yield from emit()
                now, trie = (language, route), BurstTrie()
            trie.merge(*container)
    if trie is not None:
        yield from emit()


def vocabulary(records: DataFrame, id_col: str = "id", language_col: str = "language", terms_col: str = "lemmas", rare_below: int = 3, common_above: float = 0.5) -> DataFrame:
    """Every distinct term of each language with its occurrences and records, and whether it is too rare or too common.

    Columns out: language, lemma, occurrences, passages, of_passages, rare, common. Terms are lower-cased and freed of
    surrounding spaces; null and blank terms are none. Rows without language are left out; a record delivered
    more than once (same id, null ids being one each) counts once, the first by language, then terms. A term is rare in fewer
    than ``rare_below`` records, common in more than ``common_above`` of the language's records that have any term.
    An empty table gives an empty result; further columns are ignored.
    """
    shipped(records.sparkSession)
    rows = records.select(F.col(id_col).alias("id"), F.col(language_col).alias("language"), F.col(terms_col).alias("terms")).filter("language IS NOT NULL")
    twice = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND id IS NOT NULL").select("id")
    again = rows.join(twice, "id", "left_semi").groupBy("id").agg(F.min(F.struct("language", "terms")).alias("first")).select("first.*")
    once = rows.join(twice, "id", "left_anti").select("language", "terms").unionByName(again)
    spec = "language string, route string, terms array<string>, occurrences array<bigint>, records array<bigint>, with_terms bigint"
    tries = stored(once.mapInArrow(_tries, spec))
    totals = tries.filter("route IS NULL").groupBy("language").agg(F.sum("with_terms").alias("of_passages"))
    containers = tries.filter("route IS NOT NULL").drop("with_terms")
    deep = containers.groupBy("language", "route").agg(F.sum(F.size("terms")).alias("n")).filter(F.col("n") >= DEEP).select("language", "route", F.lit(True).alias("deep"))
    if not deep.isEmpty():  # the entries of such a route go by more characters
        shallow = containers.join(deep, ["language", "route"], "left_anti")
        entries = containers.join(deep, ["language", "route"], "left_semi").select("language", F.inline(F.arrays_zip("terms", "occurrences", "records")))
        one = [F.array(c).alias(c) for c in ("terms", "occurrences", "records")]
        containers = shallow.unionByName(entries.select("language", F.substring("terms", 1, FURTHER).alias("route"), *one))
    merged = containers.repartition("language", "route").sortWithinPartitions("language", "route").mapInArrow(_merged, "language string, lemma string, occurrences bigint, passages bigint")
    return merged.join(totals, "language").select(
        "language", "lemma", "occurrences", "passages", "of_passages",
        (F.col("passages") < rare_below).alias("rare"), (F.col("passages") > common_above * F.col("of_passages")).alias("common"),
    )


def marks(terms: DataFrame) -> DataFrame:
    """One row (language, lemma, mark) for each mark of each term of ``vocabulary``'s result."""
    both = F.array(F.when(F.col("rare"), F.lit("rare")), F.when(F.col("common"), F.lit("common")))
    return terms.select("language", "lemma", F.explode(F.array_compact(both)).alias("mark"))
