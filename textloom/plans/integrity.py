"""Mutations as new tables, constraint checks, archives and restores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.sets import closure
from textloom.registry import Tables, query


def violations(df: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """(id, broken): each row's constraints that do not hold; a null result counts as held, as in SQL CHECK."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in checks.items()]))
    return df.select(F.col(key).alias("id"), F.explode(broken).alias("broken"))


def merged(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The target with the source's rows in place of those of the same key, and those that are new: MERGE as a plan."""
    return target.join(source.select(key), key, "left_anti").unionByName(source)


@query("M05, N11: constraints of facts that do not hold", """
SELECT id, unnest(list_filter([CASE WHEN NOT coalesce(validated = (rejection_code IS NULL), true) THEN 'verdict' END, CASE WHEN NOT coalesce(confidence BETWEEN 0 AND 1, true) THEN 'range' END, CASE WHEN NOT coalesce(length(statement) <= 60, true) THEN 'length' END], lambda x: x IS NOT NULL)) AS broken FROM facts""")
def fact_violations(t: Tables) -> DataFrame:
    return violations(t.facts, "id", {"verdict": F.col("validated") == F.col("rejection_code").isNull(), "range": F.col("confidence").between(0, 1), "length": F.length("statement") <= 60})


@query("M06: constraints of questions that do not hold", """
SELECT id, unnest(list_filter([CASE WHEN NOT answerable AND trim(coalesce(target_answer, '')) <> '' THEN 'no_key' END, CASE WHEN (follows_id IS NULL) <> (thread_position = 1) THEN 'root' END, CASE WHEN (status = 'rejected') <> (rejected_reason IS NOT NULL) THEN 'reason' END], lambda x: x IS NOT NULL)) AS broken FROM questions""")
def question_violations(t: Tables) -> DataFrame:
    empty = F.trim(F.coalesce("target_answer", F.lit(""))) == ""
    checks = {"no_key": F.col("answerable") | empty, "root": F.col("follows_id").isNull() == (F.col("thread_position") == 1), "reason": (F.col("status") == "rejected") == F.col("rejected_reason").isNotNull()}
    return violations(t.questions, "id", checks)


@query("M01, N12, S24: deleted rows as JSON without their vector", """
SELECT 'facts' AS origin, id AS key, kind, validated FROM facts WHERE rejection_code = 'copied'""")
def archived_rows(t: Tables) -> DataFrame:
    gone = t.facts.filter("rejection_code = 'copied'")
    archive = gone.select(F.lit("facts").alias("origin"), F.to_json(F.struct(*[c for c in gone.columns if c != "embedding"])).alias("payload"))
    return archive.select("origin", F.get_json_object("payload", "$.id").cast("bigint").alias("key"), F.get_json_object("payload", "$.kind").alias("kind"), F.get_json_object("payload", "$.validated").cast("boolean").alias("validated"))


@query("M02, M07: what is left when a source's documents go: passages, links, facts without any passage", """
WITH p AS (SELECT id FROM passages WHERE doc_sha256 NOT IN (SELECT sha256 FROM documents WHERE source = 'harbour-office')), l AS (SELECT DISTINCT fact_id, passage_id FROM fact_passages WHERE passage_id IN (SELECT id FROM p)), f AS (SELECT id FROM facts WHERE id IN (SELECT fact_id FROM l))
SELECT (SELECT count(*) FROM p) AS passages, (SELECT count(*) FROM l) AS links, (SELECT count(*) FROM f) AS facts""")
def cascade_delete(t: Tables) -> DataFrame:
    gone = t.documents.filter("source = 'harbour-office'").select(F.col("sha256").alias("doc_sha256"))
    p = t.passages.join(gone, "doc_sha256", "left_anti").select("id")
    left = t.fact_passages.select("fact_id", "passage_id").distinct().join(p.select(F.col("id").alias("passage_id")), "passage_id", "left_semi")
    f = t.facts.join(left.select(F.col("fact_id").alias("id")), "id", "left_semi")
    parts = [p.agg(F.count(F.lit(1)).alias("passages")), left.agg(F.count(F.lit(1)).alias("links")), f.agg(F.count(F.lit(1)).alias("facts"))]
    return reduce(DataFrame.crossJoin, parts)  # one row each


@query("M03: questions that lose a fact: rejected where none is left, else kept", """
WITH k AS (SELECT qf.question_id, count(DISTINCT qf.fact_id) AS n, count(DISTINCT qf.fact_id) FILTER (f.validated) AS held FROM question_facts qf JOIN facts f ON f.id = qf.fact_id GROUP BY 1) SELECT question_id, CASE WHEN held = 0 THEN 'rejected' WHEN held < n THEN 'thinner' ELSE 'same' END AS effect FROM k""")
def fact_loss(t: Tables) -> DataFrame:
    f = t.facts.select(F.col("id").alias("fact_id"), "validated")
    k = t.question_facts.distinct().join(f, "fact_id").groupBy("question_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("validated").alias("held"))
    return k.select("question_id", F.when(F.col("held") == 0, "rejected").when(F.col("held") < F.col("n"), "thinner").otherwise("same").alias("effect"))


@query("M04, M15: threads that a decision on their root takes along", """
WITH RECURSIVE r AS (SELECT id FROM questions WHERE follows_id IS NULL AND rejected_reason = 'duplicate' UNION ALL SELECT q.id FROM questions q JOIN r ON q.follows_id = r.id) SELECT q.id, 'withdrawn' AS status FROM questions q JOIN r USING (id)""")
def thread_decision(t: Tables) -> DataFrame:
    roots = t.questions.filter("follows_id IS NULL AND rejected_reason = 'duplicate'").select(F.col("id").alias("root"))
    return closure(t.questions, "id", "follows_id").join(roots, "root", "left_semi").select("id", F.lit("withdrawn").alias("status"))


@query("M08, J29: archived rows since a moment that can come back because what they refer to is there", """
SELECT DISTINCT q.id FROM questions q WHERE q.created_at >= (SELECT quantile_disc(created_at, 0.5) FROM questions) AND q.status = 'rejected' AND EXISTS (SELECT 1 FROM question_facts qf JOIN facts f ON f.id = qf.fact_id WHERE qf.question_id = q.id AND f.validated)""")
def restorable_questions(t: Tables) -> DataFrame:
    since = t.questions.filter("created_at IS NOT NULL").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_micros(created_at))").alias("since"))
    archive = t.questions.filter("status = 'rejected'").crossJoin(since).filter(F.expr("unix_micros(created_at) >= since"))  # one row
    held = t.facts.filter("validated").select(F.col("id").alias("fact_id"))
    links = t.question_facts.join(held, "fact_id", "left_semi").select(F.col("question_id").alias("id"))
    return archive.join(links, "id", "left_semi").select("id").distinct()


@query("M09, N19: rows old enough to purge", "SELECT id FROM ingest_events WHERE submitted_at < TIMESTAMPTZ '2031-05-01 00:00:00+00' - INTERVAL 60 DAY AND outcome = 'too_large'")
def purged_rows(t: Tables) -> DataFrame:
    return t.ingest_events.filter((F.col("submitted_at") < F.lit("2031-05-01 00:00:00").cast("timestamp") - F.expr("INTERVAL 60 DAYS")) & (F.col("outcome") == "too_large")).select("id")


@query("M10: a batch of rows written back by key", """
SELECT id, CASE WHEN status = 'draft' THEN 'pending' ELSE status END AS status FROM questions""")
def written_back(t: Tables) -> DataFrame:
    now = t.questions.select("id", "status")
    return merged(now, now.filter("status = 'draft'").select("id", F.lit("pending").alias("status")), "id")


@query("M13: memberships replaced, a person's decision carried where the group is the same", """
SELECT b.p_brand AS grp, count(*) AS members, max(CASE WHEN a.p_size > 25 THEN 'kept' END) AS decision FROM part b LEFT JOIN part a ON a.p_partkey = b.p_partkey AND a.p_partkey % 3 = 0 GROUP BY 1""")
def replaced_memberships(t: Tables) -> DataFrame:
    old = t.part.filter("p_partkey % 3 = 0").groupBy("p_brand").agg(F.max(F.when(F.col("p_size") > 25, "kept")).alias("decision"))
    return t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("members")).join(old, "p_brand", "left").select(F.col("p_brand").alias("grp"), "members", "decision")


@query("M14: version of a configuration: digest of its settings in order", "SELECT sha256(string_agg(concat(container, '=', capacity_tokens), ',' ORDER BY container)) AS version FROM containers")
def configuration_version(t: Tables) -> DataFrame:
    pairs = F.array_sort(F.collect_list(F.struct("container", "capacity_tokens")))  # settings are few
    rows = t.containers.agg(pairs.alias("p"))
    return rows.select(F.sha2(F.array_join(F.transform("p", lambda x: F.concat(x["container"], F.lit("="), x["capacity_tokens"].cast("string"))), ","), 256).alias("version"))
