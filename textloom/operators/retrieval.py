"""Paging and top-k retrieval by vector, by shared terms, and by both."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.columns import cosine, jaccard, numbers, words
from textloom.operators.partners import Score, extremes, shares
from textloom.operators.vectors import nearest
from textloom.registry import Tables, query
from textloom.session import stored

#: Constant of reciprocal rank fusion.
FUSION = 60
#: What two questions meet on: a fact, a passage, or a rare word.
FACT, PASSAGE, WORD = 0, 1, 2
_E = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"


def fused(rankings: list[DataFrame], key: str, rank: str = "rank") -> DataFrame:
    """(key, score): the sum of 1 / (60 + rank) over the rankings."""
    rows = rankings[0].select(key, rank)
    for r in rankings[1:]:
        rows = rows.unionByName(r.select(key, rank))
    return rows.groupBy(key).agg(F.round(F.sum(1.0 / (FUSION + F.col(rank))), 9).alias("score"))


def duplicate_bar(t: float, same_language: Column, same_answerable: Column, near_answerable: Column, facts: Column, passages: Column) -> Column:
    """The similarity from which a question repeats its neighbour; null where it cannot."""
    other = t + (1 - t) / 2
    same = F.when(facts | passages, F.lit(t)).otherwise(F.lit(other))
    return F.when(~same_language, F.lit(None)).when(~same_answerable, F.when(near_answerable & facts, F.lit(t))).otherwise(same)


@query("T03, T04, T12: a page of facts with how many there are", """
SELECT id, kind, n FROM (SELECT id, kind, (SELECT count(*) FROM facts WHERE validated) AS n FROM facts WHERE validated ORDER BY confidence DESC NULLS LAST, id LIMIT 20 OFFSET 40)""")
def fact_page(t: Tables) -> DataFrame:
    rows = t.facts.filter("validated")
    page = rows.select("id", "kind", "confidence").orderBy(F.desc_nulls_last("confidence"), "id").offset(40).limit(20)
    return page.crossJoin(rows.agg(F.count(F.lit(1)).alias("n"))).select("id", "kind", "n")  # one row


@query("T06, A37: nearest validated fact of the same kind that names the same numbers, among the five nearest", """
WITH g AS (SELECT id, kind, CAST(embedding AS DOUBLE[]) AS v, list_sort(regexp_extract_all(statement, '[0-9]+')) AS n FROM facts WHERE validated AND len(embedding) = 64 AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
s AS (SELECT a.id, b.id AS near, round(list_cosine_similarity(a.v, b.v), 6) AS s, a.n = b.n AS same FROM g a JOIN g b ON a.kind = b.kind AND a.id <> b.id WHERE a.id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, near) AS r FROM s) SELECT id, near, s AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY r) AS k FROM r WHERE r <= 5 AND same) WHERE k = 1""")
def nearest_same_numbers(t: Tables) -> DataFrame:
    base = t.facts.filter("validated").select("id", F.col("kind").alias("key"), F.col("embedding").alias("vector"))
    n = t.facts.select("id", F.array_join(numbers("statement"), " ").alias("n"))
    top = nearest(base.filter("id % 50 = 0"), base, 5, same=True).join(n, "id").withColumnRenamed("n", "nb")
    rows = top.join(n.select(F.col("id").alias("query"), F.col("n").alias("na")), "query").filter("na = nb")
    return rows.groupBy(F.col("query").alias("asked")).agg(F.min_by(F.struct("id", "similarity"), "place").alias("b")).select(F.col("asked").alias("id"), F.col("b.id").alias("near"), "b.similarity")


@query("T08: ten nearest vectors to one", f"""
WITH g AS ({_E}) SELECT b.vec_id, round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM g a JOIN g b ON a.vec_id <> b.vec_id WHERE a.vec_id = 7 ORDER BY similarity DESC, b.vec_id LIMIT 10""")
def nearest_ten(t: Tables) -> DataFrame:
    one = t.embeddings.filter("vec_id = 7").select(F.col("embedding").alias("q"))
    rows = t.embeddings.filter("vec_id <> 7").crossJoin(one)  # one row
    return rows.select("vec_id", F.round(cosine("q", "embedding"), 6).alias("similarity")).orderBy(F.desc("similarity"), "vec_id").limit(10)


@query("T09, T19, T20: passages that share most terms with one", """
WITH v AS (SELECT DISTINCT id, lower(trim(x)) AS term FROM (SELECT id, unnest(lemmas) AS x FROM passage_vocabulary) WHERE trim(x) <> ''), q AS (SELECT term FROM v WHERE id = 5)
SELECT id, count(*) AS shared FROM v WHERE id <> 5 AND term IN (SELECT term FROM q) GROUP BY id ORDER BY shared DESC, id LIMIT 10""")
def most_shared_terms(t: Tables) -> DataFrame:
    v = t.passage_vocabulary.select("id", F.explode("lemmas").alias("x")).select("id", F.lower(F.trim("x")).alias("term")).filter("term <> ''").distinct()
    asked = v.filter("id = 5").select("term")
    return v.filter("id <> 5").join(asked, "term", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("shared")).orderBy(F.desc("shared"), "id").limit(10)


@query("T10, T11, J07: vector and word rankings of facts for one question fused, with each fact's share", """
WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v, regexp_extract_all(lower(statement), '[\\p{L}\\p{N}]+') AS w FROM facts WHERE id = 100),
a AS (SELECT id, row_number() OVER (ORDER BY s DESC, id) AS rank FROM (SELECT f.id, round(list_cosine_similarity(q.v, CAST(f.embedding AS DOUBLE[])), 6) AS s FROM facts f, q WHERE f.id <> 100 AND len(f.embedding) = 64 AND list_sum(list_transform(f.embedding, lambda x: abs(x))) > 0 ORDER BY s DESC, id LIMIT 20)),
b AS (SELECT id, row_number() OVER (ORDER BY n DESC, id) AS rank FROM (SELECT f.id, len(list_intersect(q.w, regexp_extract_all(lower(f.statement), '[\\p{L}\\p{N}]+'))) AS n FROM facts f, q WHERE f.id <> 100 ORDER BY n DESC, id LIMIT 20))
SELECT id, round(sum(1.0 / (60 + rank)), 9) AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY id ORDER BY score DESC, id LIMIT 10""")
def hybrid_retrieval(t: Tables) -> DataFrame:
    q = t.facts.filter("id = 100").select(F.col("embedding").alias("qv"), words("statement").alias("qw"))
    rows = t.facts.filter("id <> 100").select("id", "embedding", words("statement").alias("w")).crossJoin(q)  # one row
    good = rows.filter((F.size("embedding") == 64) & F.exists("embedding", lambda x: x != 0))
    by_vector = good.select("id", F.round(cosine("qv", "embedding"), 6).alias("s")).orderBy(F.desc("s"), "id").limit(20)
    by_words = rows.select("id", F.size(F.array_intersect("qw", "w")).alias("s")).orderBy(F.desc("s"), "id").limit(20)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("s"), "id"))  # twenty rows
    return fused([by_vector.withColumn("rank", rank), by_words.withColumn("rank", rank)], "id").orderBy(F.desc("score"), "id").limit(10)


@query("T14, T15, T16, P16: which questions repeat an earlier one: similarity of words against the bar for the facts or passages they share", """
WITH f AS (SELECT question_id AS id, list(DISTINCT fact_id) AS f FROM question_facts GROUP BY 1), c AS (SELECT question_id AS id, list(DISTINCT passage_id) AS p FROM question_facts JOIN fact_passages USING (fact_id) GROUP BY 1),
q AS (SELECT id, language, answerable, list_distinct(regexp_extract_all(lower(question_text), '[\\p{L}\\p{N}]+')) AS w, f, p FROM questions LEFT JOIN f USING (id) LEFT JOIN c USING (id)),
m AS (SELECT a.id, b.id AS near, a.language IS NOT DISTINCT FROM b.language AS sl, a.answerable = b.answerable AS sa, b.answerable AS ba, coalesce(list_has_any(a.f, b.f), false) AS sf, coalesce(list_has_any(a.p, b.p), false) AS sp,
 len(list_intersect(a.w, b.w)) AS i, len(a.w) + len(b.w) AS n FROM q a JOIN q b ON b.id < a.id AND len(a.w) > 0 AND len(b.w) > 0),
s AS (SELECT *, i / (n - i) AS s, CASE WHEN NOT sl THEN NULL WHEN NOT sa THEN CASE WHEN ba AND sf THEN 0.5 END WHEN sf OR sp THEN 0.5 ELSE 0.75 END AS bar FROM m)
SELECT id, near, round(s - bar, 6) AS above FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(s - bar, 6) DESC, near) AS r FROM s WHERE s >= bar) WHERE r = 1""")
def repeated_questions(t: Tables, t_bar: float = 0.5, block: int = 8000) -> DataFrame:
    """(id, near, above) over every question of any difficulty, each compared with every earlier one that can reach its bar. Questions on a fact or passage in
    common meet in its group; the bar of all others is the higher one, and sets of words that overlap so far share one of the rarest
    |x| - ceil(bar |x|) + 1 words of either, whose groups they meet in, so no pair is lost. No row is made for a pair; the work within a group is quadratic in it,
    as a template's questions do repeat each other. Questions without words abstain."""
    facts = t.question_facts.select(F.col("question_id").alias("id"), "fact_id").distinct()
    passages = facts.join(t.fact_passages.select("fact_id", "passage_id").distinct().hint("merge"), "fact_id").select("id", F.col("passage_id").cast("string").alias("term")).filter("term IS NOT NULL").distinct()
    language = F.coalesce(F.concat(F.lit("="), "language"), F.lit("")).alias("g")
    flag = F.coalesce(F.col("answerable").cast("int"), F.lit(-1)).alias("flag")
    q = stored(t.questions.filter("id IS NOT NULL").select("id", language, flag, F.array_distinct(words("question_text")).alias("w")).filter(F.size("w") > 0))
    x = q.select("id", "g", F.explode("w").alias("word"))
    df = x.groupBy("g", "word").agg(F.count(F.lit(1)).alias("df"))
    o = x.join(df.hint("merge"), ["g", "word"]).groupBy("id", "g").agg(F.transform(F.array_sort(F.array_distinct(F.collect_list(F.struct("df", "word")))), lambda e: e["word"]).alias("o"))
    high = t_bar + (1 - t_bar) / 2
    least = F.size("o") - F.ceil(F.size("o") * high - 1e-9).cast("int") + 1
    rare = o.select(F.lit(WORD).alias("tier"), "id", "g", F.explode(F.slice("o", F.lit(1), least)).alias("term"))
    on = lambda tier, rows: rows.join(q.select("id", "g").hint("merge"), "id").select(F.lit(tier).alias("tier"), "id", "g", "term")
    own = stored(rare.unionByName(on(PASSAGE, passages)).unionByName(on(FACT, facts.select("id", F.col("fact_id").cast("string").alias("term")).filter("term IS NOT NULL"))).distinct())
    many = own.groupBy("tier", "g", "term").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    members = own.join(many.hint("merge"), ["tier", "g", "term"]).join(q.hint("merge"), ["id", "g"])

    def of(common, one, two, tier, a, b):
        s, bar = shares(common, one, two), np.where(tier == WORD, high, t_bar)
        return np.floor((s - bar) * 1e6 + 0.5).astype(np.int64), (s >= bar) & ((a == b) | (a < 0) | (b < 0) | (tier == FACT) & (b == 1))

    rows = extremes(members, Score(of), block, earlier=True)
    best = rows.groupBy("id").agg(F.max(F.struct("most", (-F.col("near")).alias("near"))).alias("m"))
    return best.select("id", (-F.col("m.near")).alias("near"), (F.col("m.most") / F.lit(1e6)).alias("above"))


@query("T18: length of the shared beginning of two section paths", """
WITH s AS (SELECT id, string_split(section_path, '.') AS t, lead(string_split(section_path, '.')) OVER (PARTITION BY doc_sha256 ORDER BY ordinal) AS u FROM passages WHERE section_path IS NOT NULL)
SELECT id, CASE WHEN t[1] <> u[1] THEN 0 WHEN t[2] IS DISTINCT FROM u[2] OR t[2] IS NULL THEN 1 ELSE 2 END AS shared FROM s WHERE u IS NOT NULL""")
def shared_beginning(t: Tables) -> DataFrame:
    trail = F.split("section_path", r"\.")
    rows = t.passages.filter("section_path IS NOT NULL").select("id", trail.alias("t"), F.lead(trail).over(Window.partitionBy("doc_sha256").orderBy("ordinal")).alias("u")).filter("u IS NOT NULL")
    same = F.zip_with("t", "u", lambda a, b: a.eqNullSafe(b) & a.isNotNull() & b.isNotNull())
    shared = F.aggregate(same, F.struct(F.lit(True).alias("on"), F.lit(0).alias("n")), lambda s, x: F.struct((s["on"] & x).alias("on"), (s["n"] + (s["on"] & x).cast("int")).alias("n")), lambda s: s["n"])
    return rows.select("id", shared.alias("shared"))


@query("T23, T24, X56: first distinct statements of a question joined into a text", """
SELECT question_id, array_to_string(list_slice(list(statement ORDER BY id), 1, 4), chr(10)) AS text FROM (SELECT DISTINCT question_id, f.id, statement FROM question_facts qf JOIN facts f ON f.id = qf.fact_id) GROUP BY 1""")
def question_context(t: Tables) -> DataFrame:
    facts = t.facts.select(F.col("id").alias("fact_id"), "statement")
    rows = t.question_facts.distinct().join(facts, "fact_id").groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("fact_id", "statement"))).alias("f"))
    return rows.select("question_id", F.array_join(F.transform(F.slice("f", 1, 4), lambda x: x["statement"]), "\n").alias("text"))


@query("T25, D20: latest events of one kind", "SELECT event_id, ts FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id LIMIT 15")
def latest_events(t: Tables) -> DataFrame:
    return t.events.filter("event_type = 'error'").select("event_id", "ts").orderBy(F.desc("ts"), "event_id").limit(15)
