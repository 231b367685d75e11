"""Unions, intersections, differences and recursive closures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.registry import Tables, query
from textloom.session import checkpointed


def closure(parents: DataFrame, child: str, parent: str, most: int = 1000) -> DataFrame:
    """(id, root, depth) of every node of a forest given by (child, parent): roots have a null parent or one that is missing. Distances
    double each round, so a chain of n takes log n joins; nodes on a cycle have no root and no row."""
    nodes = parents.select(F.col(child).alias("id"), F.col(parent).alias("up")).distinct()
    known = nodes.select(F.col("id").alias("up"))
    linked = nodes.join(known.distinct().withColumn("there", F.lit(True)), "up", "left")
    now = checkpointed(linked.select("id", F.when(F.col("there"), F.col("up")).alias("up"), F.when(F.col("there"), 1).otherwise(0).alias("depth")).withColumn("root", F.when(F.col("up").isNull(), F.col("id"))))
    steps = 0
    while steps < most.bit_length() + 1:
        over = now.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("root").alias("root2"), F.col("depth").alias("depth2"))
        moved = now.join(over, "up", "left").select(
            "id", F.when(F.col("root").isNull(), F.col("up2")).alias("up"), F.when(F.col("root").isNull(), F.col("depth") + F.col("depth2")).otherwise(F.col("depth")).alias("depth"), F.coalesce("root", "root2").alias("root")
        )
        now = checkpointed(moved)
        if now.filter("root IS NULL").isEmpty():
            break
        steps += 1
    return now.filter("root IS NOT NULL").select("id", "root", "depth")


@query("U02, T05: three kinds with aligned columns, a page over all", """
SELECT kind, id, label FROM (SELECT 'fact' AS kind, id, kind AS label FROM facts UNION ALL SELECT 'question', id, status FROM questions UNION ALL SELECT 'passage', id, block_type FROM passages) ORDER BY id DESC, kind LIMIT 30 OFFSET 10""")
def artefact_page(t: Tables) -> DataFrame:
    rows = t.facts.select(F.lit("fact").alias("kind"), "id", F.col("kind").alias("label")).unionByName(t.questions.select(F.lit("question").alias("kind"), "id", F.col("status").alias("label")))
    return rows.unionByName(t.passages.select(F.lit("passage").alias("kind"), "id", F.col("block_type").alias("label"))).orderBy(F.desc("id"), "kind").offset(10).limit(30)


@query("U04, N15: shared units of facts with one number and the length of their lists", """
SELECT id, list_sort(list_intersect(units_statement, ['3', '21', '29', '40'])) AS shared, len(units_statement) AS n, list_contains(units_statement, '3') AS has FROM facts WHERE list_has_any(units_statement, ['3', '21', '29', '40'])""")
def shared_units(t: Tables) -> DataFrame:
    some = F.array(*[F.lit(x) for x in ("3", "21", "29", "40")])
    return t.facts.filter(F.arrays_overlap("units_statement", some)).select("id", F.array_sort(F.array_intersect("units_statement", some)).alias("shared"), F.size("units_statement").alias("n"), F.array_contains("units_statement", "3").alias("has"))


@query("U05: ids gone between two batches of keys", "SELECT passage_id AS id FROM fact_passages EXCEPT SELECT id FROM passages WHERE block_type = 'text'")
def ids_gone(t: Tables) -> DataFrame:
    return t.fact_passages.select(F.col("passage_id").alias("id")).distinct().join(t.passages.filter("block_type = 'text'").select("id"), "id", "left_anti")


@query("U06, U07, M04: root and depth of every question in its thread", """
WITH RECURSIVE r AS (SELECT q.id, q.id AS root, 0 AS depth FROM questions q WHERE follows_id IS NULL OR follows_id NOT IN (SELECT id FROM questions) UNION ALL SELECT q.id, r.root, r.depth + 1 FROM questions q JOIN r ON q.follows_id = r.id) SELECT * FROM r""")
def thread_roots(t: Tables) -> DataFrame:
    return closure(t.questions, "id", "follows_id")


@query("U08, P15: questions left when only threads with an accepted root stay", """
WITH RECURSIVE r AS (SELECT id FROM questions WHERE follows_id IS NULL AND status = 'accepted' UNION ALL SELECT q.id FROM questions q JOIN r ON q.follows_id = r.id WHERE q.status = 'accepted') SELECT id FROM r""")
def pruned_threads(t: Tables) -> DataFrame:
    kept = t.questions.filter("status = 'accepted'").select("id", "follows_id")
    found = closure(kept, "id", "follows_id")
    roots = kept.filter("follows_id IS NULL").select(F.col("id").alias("root"))
    return found.join(roots, "root", "left_semi").select("id")
