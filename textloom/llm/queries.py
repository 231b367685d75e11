"""The queries of the ten problems over the project's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import arrivals, mixing, neardup, neighbours, packing, pairs, quality, sampling, scans, vocabulary
from textloom.session import table

AXES = ["difficulty", "question_type", "answerable", "language"]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return vocabulary.marks(vocabulary.vocabulary(table(spark, folder, "passage_vocabulary")))


def p1_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return vocabulary.vocabulary(table(spark, folder, "passage_vocabulary"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return arrivals.replayed(arrivals.indexed(table(spark, folder, "facts")))


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "facts").select("id", F.col("embedding").alias("vector"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    probes = table(spark, folder, "neighbour_probe").filter("id IS NOT NULL AND fact_id IS NOT NULL").distinct()
    vectors = _vectors(spark, folder)
    asked = vectors.join(probes.select(F.col("fact_id").alias("id")).distinct(), "id", "left_semi")
    found = neighbours.nearest(asked, vectors, 5)
    return probes.join(found.select(F.col("query").alias("fact_id"), F.col("id").alias("near")), "fact_id").select("id", F.col("near").alias("fact_id")).distinct()


def p3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten most similar facts of every fact whose id is divisible by 50, against all facts, with relaxed pruning."""
    vectors = _vectors(spark, folder)
    return neighbours.nearest(vectors.filter("id % 50 = 0"), vectors, 10, factor=1.25)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return scans.Scans(table(spark, folder, "passages"), table(spark, folder, "documents")).found()


def p4_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return scans.Scans(table(spark, folder, "passages"), table(spark, folder, "documents")).repaired()


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = sampling.report(table(spark, folder, "release_pool"), table(spark, folder, "release_targets"), AXES)
    return rows.filter("short").select("release_name", "axis", "category").distinct()


def p5_report(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.report(table(spark, folder, "release_pool"), table(spark, folder, "release_targets"), AXES)


def p5_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.draw(table(spark, folder, "release_pool"), table(spark, folder, "release_targets"), AXES)


def p5_shortfalls(spark: SparkSession, folder: str) -> DataFrame:
    """What the draw over all axes together gave every target row."""
    pool, targets = table(spark, folder, "release_pool"), table(spark, folder, "release_targets")
    return sampling.shortfalls(sampling.draw(pool, targets, AXES), pool, targets, AXES)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return pairs.broken_pairs(table(spark, folder, "questions"))


def _fact_groups(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "facts").select("id", F.concat_ws(" ", "statement", "evidence_text").alias("text"))
    return neardup.near_duplicates(texts, 0.7, words=1)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    groups = _fact_groups(spark, folder)
    one, two = groups.select("group", F.col("id").alias("fact_id_a")), groups.select("group", F.col("id").alias("fact_id_b"))
    return one.join(two, "group").filter("fact_id_a < fact_id_b").select("fact_id_a", "fact_id_b")


def p7_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every fact with its group; a fact like none is a group of its own."""
    found = _fact_groups(spark, folder)
    facts = table(spark, folder, "facts").select("id").distinct()
    return facts.join(found, "id", "left").select("id", F.coalesce("group", "id").alias("group"))


def p8_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in every kind of container; near copies (five words, 0.8) never share one."""
    documents = table(spark, folder, "documents")
    # At 0.8 and more, 24 bands of five find a pair with a probability of 0.9999.
    groups = neardup.near_duplicates(documents.select(F.col("doc_id").alias("id"), "text"), 0.8, words=5, bands=24)
    return packing.packed(documents, table(spark, folder, "containers"), clusters=groups)


def p8_filling(spark: SparkSession, folder: str) -> DataFrame:
    return packing.filling(p8_packing(spark, folder))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_shares(spark, folder).filter("short").select("mix_name", "source").distinct()


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[0]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[1]


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.quality(table(spark, folder, "documents"), table(spark, folder, "common_words"))
    return rows.filter("form IS NOT NULL").select("doc_id", "form").distinct()


def p10_statistics(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.quality(table(spark, folder, "documents"), table(spark, folder, "common_words"))
    return rows.select("doc_id", "language", "characters", "words", *quality.STATISTICS, "distance2", "outlier", "form")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_vocabulary, p2_found, p3_found, p3_neighbours, p4_found, p4_repaired, p5_found, p5_report, p5_sample, p5_shortfalls, p6_found, p7_found, p7_groups, p8_packing, p8_filling, p9_found, p9_mix, p9_shares, p10_found, p10_statistics)
}

_TERMS = """
WITH once AS (SELECT DISTINCT id, language, lemmas FROM passage_vocabulary WHERE language IS NOT NULL),
terms AS (SELECT id, language, lower(trim(x)) AS lemma FROM (SELECT id, language, unnest(lemmas) AS x FROM once) WHERE trim(x) <> ''),
totals AS (SELECT language, count(DISTINCT id) AS of_passages FROM terms GROUP BY language),
counted AS (SELECT language, lemma, count(*) AS occurrences, count(DISTINCT id) AS passages FROM terms GROUP BY language, lemma),
marked AS (SELECT language, lemma, occurrences, passages, of_passages, passages < 3 AS rare, passages > 0.5 * of_passages AS common FROM counted JOIN totals USING (language))
"""
_REPORT = """
WITH rows AS (SELECT DISTINCT id, axis, lower(trim(v)) AS category FROM (
  SELECT id, 'difficulty' AS axis, difficulty AS v FROM release_pool UNION ALL SELECT id, 'question_type', question_type FROM release_pool
  UNION ALL SELECT id, 'answerable', CAST(answerable AS VARCHAR) FROM release_pool UNION ALL SELECT id, 'language', language FROM release_pool)),
supply AS (SELECT axis, category, count(*) AS supply FROM rows WHERE category IS NOT NULL AND id IS NOT NULL GROUP BY 1, 2),
ids AS (SELECT count(DISTINCT id) AS ids FROM release_pool),
sized AS (SELECT DISTINCT release_name, axis, lower(trim(category)) AS category, CAST(floor(ids * size_pct / 100) AS BIGINT) AS size, target_pct, min_rows FROM release_targets, ids),
report AS (SELECT release_name, axis, category, size, greatest(CAST(floor(size * target_pct / 100) AS BIGINT), min_rows) AS places, coalesce(supply, 0) AS supply
  FROM sized LEFT JOIN supply USING (axis, category))
"""
_NEAR = """
WITH good AS (SELECT id, CAST(embedding AS DOUBLE[]) AS v FROM facts WHERE len(embedding) = 64 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
pairs AS (SELECT p.id AS probe, b.id AS near, list_cosine_similarity(a.v, b.v) AS s FROM (SELECT DISTINCT id, fact_id FROM neighbour_probe) p
  JOIN good a ON a.id = p.fact_id JOIN good b ON b.id <> a.id)
"""
ORACLES: dict[str, str] = {
    "p1_found": _TERMS + "SELECT language, lemma, 'rare' AS mark FROM marked WHERE rare UNION ALL SELECT language, lemma, 'common' FROM marked WHERE common",
    "p1_vocabulary": _TERMS + "SELECT * FROM marked",
    # The walk in order, one fact a step: a list holds what is accepted.
    "p2_found": r"""
WITH RECURSIVE f AS (SELECT id, batch_no, regexp_extract_all(lower(coalesce(statement, '')), '[\p{L}\p{N}]+') AS w, list_sort(regexp_extract_all(coalesce(statement, ''), '\d+')) AS n,
  CASE WHEN len(embedding) = 64 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0 THEN CAST(embedding AS DOUBLE[]) END AS v FROM (SELECT DISTINCT * FROM facts)),
near AS (SELECT b.id, a.id AS other FROM f a JOIN f b ON a.n = b.n AND (a.batch_no, a.id) < (b.batch_no, b.id) AND b.batch_no > 0
  WHERE (len(a.w) > 0 AND a.w = b.w) OR list_cosine_similarity(a.v, b.v) >= 0.93),
ordered AS (SELECT f.id, row_number() OVER (ORDER BY f.batch_no, f.id) AS r, coalesce(list(near.other) FILTER (near.other IS NOT NULL), []) AS others
  FROM f LEFT JOIN near USING (id) WHERE f.batch_no > 0 GROUP BY f.id, f.batch_no),
walk AS (SELECT CAST(0 AS BIGINT) AS r, (SELECT list(id) FROM f WHERE batch_no = 0) AS accepted
  UNION ALL SELECT o.r, CASE WHEN list_has_any(o.others, w.accepted) THEN w.accepted ELSE list_append(w.accepted, o.id) END FROM walk w JOIN ordered o ON o.r = w.r + 1),
last AS (SELECT accepted FROM walk ORDER BY r DESC LIMIT 1)
SELECT list_min(list_intersect(o.others, l.accepted)) AS kept_id, o.id AS fact_id FROM ordered o, last l WHERE list_has_any(o.others, l.accepted)""",
    "p3_found": _NEAR + "SELECT DISTINCT probe AS id, near AS fact_id FROM (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY s DESC, near) AS r FROM pairs) WHERE r <= 5",
    "p5_found": _REPORT + "SELECT DISTINCT release_name, axis, category FROM report WHERE supply < places",
    # Sizes in characters: no source lies near its limit, so the measure does not matter.
    "p9_found": """
WITH d AS (SELECT source, sum(length(coalesce(text, ''))) AS n FROM documents GROUP BY 1), a AS (SELECT sum(n) AS a FROM d)
SELECT DISTINCT m.mix_name, m.source FROM mix_targets m CROSS JOIN a LEFT JOIN d USING (source) WHERE m.size_share * a * m.target_share > m.max_repeats * coalesce(d.n, 0)""",
    "p5_report": _REPORT + "SELECT release_name, axis, category, size, places, least(supply, places) AS taken, supply < places AS short FROM report",
}
