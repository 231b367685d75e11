"""Joins over the domain's tables: stars, bands, similarity joins, links and lineage.

Links repeat in the data and one passage or run may hold a large share of them; every aggregate is taken before its join where that
keeps a hot key from widening the rows, and no side is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.columns import content_digest
from textloom.operators.vectors import nearest
from textloom.registry import Tables, query

_GOOD = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"


def labelled(t: Tables) -> DataFrame:
    """The vectors as (id, key, vector), their label as the key."""
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("label").alias("key"), F.col("embedding").alias("vector"))


def links(t: Tables) -> DataFrame:
    """Distinct (fact_id, passage_id, position)."""
    return t.fact_passages.select("fact_id", "passage_id", "position").distinct()


@query("J02: each fact with its opening passage", """
SELECT DISTINCT f.id, fp.passage_id, p.doc_sha256 FROM facts f JOIN fact_passages fp ON fp.fact_id = f.id AND fp.position = 1 JOIN passages p ON p.id = fp.passage_id""")
def opening_passages(t: Tables) -> DataFrame:
    first = links(t).filter("position = 1").select(F.col("fact_id").alias("id"), "passage_id")
    passages = t.passages.select(F.col("id").alias("passage_id"), "doc_sha256")
    return t.facts.select("id").join(first, "id").join(passages, "passage_id").select("id", "passage_id", "doc_sha256")


@query("J03: facts with their document's title and source", """
SELECT DISTINCT f.id, d.title, d.source FROM facts f JOIN fact_passages fp ON fp.fact_id = f.id JOIN passages p ON p.id = fp.passage_id JOIN documents d ON d.sha256 = p.doc_sha256""")
def fact_sources(t: Tables) -> DataFrame:
    rows = t.facts.select(F.col("id").alias("fact_id"))
    passages = t.passages.select(F.col("id").alias("passage_id"), F.col("doc_sha256").alias("sha256"))
    documents = t.documents.select("sha256", "title", "source")
    return rows.join(links(t), "fact_id").join(passages, "passage_id").join(documents, "sha256").select(F.col("fact_id").alias("id"), "title", "source").distinct()


@query("J04, S14, N16, T23: passages each fact rests on, in order, the first three", """
SELECT fact_id, list_slice(list(passage_id ORDER BY position, passage_id), 1, 3) AS passages, count(*) AS n FROM (SELECT DISTINCT fact_id, passage_id, position FROM fact_passages) GROUP BY fact_id""")
def resting_passages(t: Tables) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("position", "passage_id")))
    rows = links(t).groupBy("fact_id").agg(ordered.alias("p"), F.count(F.lit(1)).alias("n"))
    return rows.select("fact_id", F.slice(F.transform("p", lambda x: x["passage_id"]), 1, 3).alias("passages"), "n")


@query("J05: lines whose part is of a type that another one dominates in their order", """
WITH w AS (SELECT l_orderkey, p_type, sum(l_extendedprice) AS spend FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
d AS (SELECT l_orderkey, p_type FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY spend DESC, p_type) AS r FROM w) WHERE r = 1)
SELECT l.l_orderkey, l.l_linenumber, p.p_type, d.p_type AS dominant FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN d ON d.l_orderkey = l.l_orderkey AND d.p_type <> p.p_type""")
def bridging_lines(t: Tables) -> DataFrame:
    typed = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", F.col("l_partkey").alias("p_partkey")).join(t.part.select("p_partkey", "p_type"), "p_partkey")
    spend = typed.groupBy("l_orderkey", "p_type").agg(F.sum("l_extendedprice").alias("spend"))
    best = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("spend"), "p_type"))
    dominant = spend.withColumn("r", best).filter("r = 1").select("l_orderkey", F.col("p_type").alias("dominant"))
    return typed.join(dominant, "l_orderkey").filter("dominant <> p_type").select("l_orderkey", "l_linenumber", "p_type", "dominant")


@query("J06, J07: passages near those that a run's facts rest on, two places around, without them", """
WITH s AS (SELECT DISTINCT p.doc_sha256, p.ordinal, p.id FROM facts f JOIN fact_passages fp ON fp.fact_id = f.id JOIN passages p ON p.id = fp.passage_id WHERE f.kind = 'bridge')
SELECT p.id FROM passages p WHERE EXISTS (SELECT 1 FROM s WHERE s.doc_sha256 = p.doc_sha256 AND p.ordinal BETWEEN s.ordinal - 2 AND s.ordinal + 2) AND p.id NOT IN (SELECT id FROM s)""")
def neighbour_band(t: Tables) -> DataFrame:
    bridges = t.facts.filter("kind = 'bridge'").select(F.col("id").alias("fact_id"))
    cited = links(t).join(bridges, "fact_id", "left_semi").select(F.col("passage_id").alias("id")).distinct()
    seeds = t.passages.join(cited, "id", "left_semi").select("id", "doc_sha256", "ordinal")
    # The band is an equi-join on the places around each seed, not a range residual on a hot document.
    around = seeds.select("doc_sha256", F.explode(F.sequence(F.col("ordinal") - 2, F.col("ordinal") + 2)).alias("ordinal")).distinct()
    return t.passages.join(around, ["doc_sha256", "ordinal"], "left_semi").join(seeds.select("id"), "id", "left_anti").select("id")


@query("J08: vectors with a near copy of another kind", f"""
WITH g AS ({_GOOD}) SELECT a.vec_id FROM g a WHERE a.vec_id % 50 = 0 AND EXISTS (SELECT 1 FROM g b WHERE b.label <> a.label AND list_cosine_similarity(a.v, b.v) >= 0.3)""")
def cross_label_near(t: Tables) -> DataFrame:
    base = labelled(t)
    return nearest(base.filter("id % 50 = 0"), base, 1, same=False, digits=12).filter("similarity >= 0.3").select(F.col("query").alias("vec_id"))


@query("J09, T07: three nearest of the same kind for each query vector", f"""
WITH g AS ({_GOOD}), s AS (SELECT a.vec_id, b.vec_id AS near, round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT vec_id, near, similarity FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, near) AS r FROM s) WHERE r <= 3""")
def nearest_of_kind(t: Tables) -> DataFrame:
    base = labelled(t)
    return nearest(base.filter("id % 50 = 0"), base, 3, same=True).select(F.col("query").alias("vec_id"), F.col("id").alias("near"), "similarity")


@query("J10, A34, U03: distinct nearest pairs of a set of ids, sought among all vectors", f"""
WITH g AS ({_GOOD}), s AS (SELECT a.vec_id AS x, b.vec_id AS y, round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM g a JOIN g b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY similarity DESC, y) AS r FROM s) WHERE r = 1)
SELECT least(x, y) AS a, greatest(x, y) AS b, max(similarity) AS similarity FROM n GROUP BY 1, 2""")
def closest_pairs(t: Tables) -> DataFrame:
    base = labelled(t)
    best = nearest(base.filter("id % 50 = 0"), base, 1)
    return best.groupBy(F.least("query", "id").alias("a"), F.greatest("query", "id").alias("b")).agg(F.max("similarity").alias("similarity"))


@query("J12, J13: counts of passages without vocabulary, and languages of vocabulary without passages", """
SELECT (SELECT count(*) FROM passages p WHERE NOT EXISTS (SELECT 1 FROM passage_vocabulary v WHERE v.id = p.id)) AS passages_without,
 (SELECT count(DISTINCT language) FROM passage_vocabulary v WHERE language IS NOT NULL AND NOT EXISTS (SELECT 1 FROM passages p WHERE p.language = v.language)) AS languages_without""")
def unplaced_counts(t: Tables) -> DataFrame:
    a = t.passages.join(t.passage_vocabulary.select("id"), "id", "left_anti").agg(F.count(F.lit(1)).alias("passages_without"))
    known = t.passages.select("language").filter("language IS NOT NULL").distinct()
    b = t.passage_vocabulary.filter("language IS NOT NULL").select("language").distinct().join(known, "language", "left_anti").agg(F.count(F.lit(1)).alias("languages_without"))
    return a.crossJoin(b)  # one row each


@query("J14, J19, W02: first upload of each document, unknown ones last", """
SELECT d.doc_id, e.id AS event_id, e.submitted_at FROM documents d LEFT JOIN (SELECT DISTINCT ON (sha256) sha256, id, submitted_at FROM ingest_events WHERE sha256 IS NOT NULL ORDER BY sha256, submitted_at, id) e USING (sha256)""")
def first_uploads(t: Tables) -> DataFrame:
    first = t.ingest_events.filter("sha256 IS NOT NULL").groupBy("sha256").agg(F.min(F.struct("submitted_at", "id")).alias("e"))
    return t.documents.select("doc_id", "sha256").join(first, "sha256", "left").select("doc_id", F.col("e.id").alias("event_id"), F.col("e.submitted_at").alias("submitted_at"))


@query("J15, A44: passages per document, all and by status, counted before the join", """
SELECT d.doc_id, count(p.id) AS passages, count(p.id) FILTER (p.extract_status = 'extracted') AS extracted FROM documents d LEFT JOIN passages p ON p.doc_sha256 = d.sha256 GROUP BY d.doc_id""")
def document_counts(t: Tables) -> DataFrame:
    per = t.passages.groupBy(F.col("doc_sha256").alias("sha256")).agg(F.count("id").alias("passages"), F.count_if(F.col("extract_status") == "extracted").alias("extracted"))
    return t.documents.select("doc_id", "sha256").join(per, "sha256", "left").fillna(0, ["passages", "extracted"]).drop("sha256")


@query("J16, J17, J31: one row per question, fact and passage cited, in document order", """
SELECT DISTINCT qf.question_id, qf.fact_id, p.id AS passage_id, p.doc_sha256, p.ordinal FROM questions q JOIN question_facts qf ON qf.question_id = q.id JOIN fact_passages fp ON fp.fact_id = qf.fact_id JOIN passages p ON p.id = fp.passage_id WHERE q.status = 'accepted'""")
def question_citations(t: Tables) -> DataFrame:
    accepted = t.questions.filter("status = 'accepted'").select(F.col("id").alias("question_id"))
    passages = t.passages.select(F.col("id").alias("passage_id"), "doc_sha256", "ordinal")
    rows = t.question_facts.distinct().join(accepted, "question_id", "left_semi").join(links(t).drop("position").distinct(), "fact_id").join(passages, "passage_id")
    return rows.select("question_id", "fact_id", "passage_id", "doc_sha256", "ordinal")


@query("J18, M12, T13: what the accepted questions lead back to: each kind's first twenty and how many there are", """
WITH q AS (SELECT id FROM questions WHERE status = 'accepted'), f AS (SELECT DISTINCT fact_id AS id FROM question_facts WHERE question_id IN (SELECT id FROM q)),
p AS (SELECT DISTINCT passage_id AS id FROM fact_passages WHERE fact_id IN (SELECT id FROM f)),
d AS (SELECT DISTINCT doc_id AS id FROM documents JOIN passages ON sha256 = doc_sha256 WHERE passages.id IN (SELECT id FROM p)),
a AS (SELECT 'question' AS kind, id FROM q UNION ALL SELECT 'fact', id FROM f UNION ALL SELECT 'passage', id FROM p UNION ALL SELECT 'document', id FROM d)
SELECT kind, id, total FROM (SELECT kind, id, count(*) OVER (PARTITION BY kind) AS total, row_number() OVER (PARTITION BY kind ORDER BY id) AS r FROM a) WHERE r <= 20""")
def lineage_steps(t: Tables) -> DataFrame:
    q = t.questions.filter("status = 'accepted'").select("id")
    f = t.question_facts.join(q.select(F.col("id").alias("question_id")), "question_id", "left_semi").select(F.col("fact_id").alias("id")).distinct()
    p = t.fact_passages.join(f.select(F.col("id").alias("fact_id")), "fact_id", "left_semi").select(F.col("passage_id").alias("id")).distinct()
    shas = t.passages.join(p, "id", "left_semi").select(F.col("doc_sha256").alias("sha256"))
    d = t.documents.join(shas, "sha256", "left_semi").select(F.col("doc_id").alias("id"))
    kinds = [("question", q), ("fact", f), ("passage", p), ("document", d)]
    # Counted and cut per kind before they meet, so that no kind is gathered in one task.
    parts = [k.orderBy("id").limit(20).withColumn("kind", F.lit(name)).crossJoin(k.agg(F.count(F.lit(1)).alias("total"))) for name, k in kinds]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.select("kind", "id", "total")


@query("J20: judgement of each artefact by its kind", """
SELECT 'fact' AS kind, id, CASE WHEN validated THEN 'kept' ELSE rejection_code END AS judgement FROM facts UNION ALL
SELECT 'question', id, CASE status WHEN 'accepted' THEN 'kept' WHEN 'rejected' THEN rejected_reason END FROM questions""")
def judgements(t: Tables) -> DataFrame:
    facts = t.facts.select(F.lit("fact").alias("kind"), "id", F.when(F.col("validated"), "kept").otherwise(F.col("rejection_code")).alias("judgement"))
    judged = F.when(F.col("status") == "accepted", "kept").when(F.col("status") == "rejected", F.col("rejected_reason"))
    return facts.unionByName(t.questions.select(F.lit("question").alias("kind"), "id", judged.alias("judgement")))


@query("J21: pairs of passages that share a rare term of their language", """
WITH v AS (SELECT DISTINCT id, language, lower(trim(x)) AS term FROM (SELECT id, language, unnest(lemmas) AS x FROM passage_vocabulary WHERE language IS NOT NULL) WHERE trim(x) <> ''),
n AS (SELECT language, count(DISTINCT id) AS n FROM v GROUP BY 1), df AS (SELECT language, term, count(*) AS df FROM v GROUP BY 1, 2),
r AS (SELECT language, term FROM df JOIN n USING (language) WHERE df BETWEEN 2 AND greatest(2, ceil(0.005 * n)))
SELECT DISTINCT a.id AS a, b.id AS b FROM v a JOIN r USING (language, term) JOIN v b ON b.language = a.language AND b.term = a.term AND a.id < b.id""")
def rare_term_pairs(t: Tables) -> DataFrame:
    words = t.passage_vocabulary.filter("language IS NOT NULL").select("id", "language", F.explode("lemmas").alias("x"))
    v = words.select("id", "language", F.lower(F.trim("x")).alias("term")).filter("term <> ''").distinct()
    n = v.groupBy("language").agg(F.countDistinct("id").alias("n"))
    df = v.groupBy("language", "term").agg(F.count(F.lit(1)).alias("df")).join(n, "language")
    rare = df.filter((F.col("df") >= 2) & (F.col("df") <= F.greatest(F.lit(2), F.ceil(0.005 * F.col("n"))))).select("language", "term")
    held = v.join(rare, ["language", "term"], "left_semi")
    a, b = held.select("language", "term", F.col("id").alias("a")), held.select("language", "term", F.col("id").alias("b"))
    return a.join(b, ["language", "term"]).filter("a < b").select("a", "b").distinct()


@query("J22: sibling sections of one document: one parent heading, different own ones", """
WITH s AS (SELECT DISTINCT doc_sha256, string_split(section_path, '.')[1] AS parent, section_path AS path FROM passages WHERE section_path LIKE '%.%')
SELECT a.doc_sha256, a.path AS a, b.path AS b FROM s a JOIN s b ON a.doc_sha256 = b.doc_sha256 AND a.parent = b.parent AND a.path < b.path""")
def sibling_sections(t: Tables) -> DataFrame:
    s = t.passages.filter("section_path LIKE '%.%'").select("doc_sha256", F.substring_index("section_path", ".", 1).alias("parent"), F.col("section_path").alias("path")).distinct()
    a, b = s.withColumnRenamed("path", "a"), s.withColumnRenamed("path", "b")
    return a.join(b, ["doc_sha256", "parent"]).filter("a < b").select("doc_sha256", "a", "b")


@query("X45: sections named in a text, and the nearest passage of the document under that section", """
WITH r AS (SELECT id, doc_sha256, ordinal, CAST(unnest(regexp_extract_all(text, '(?:section|Abschnitt) ([0-9]+)', 1)) AS INTEGER) AS label FROM passages),
c AS (SELECT r.id, r.label, p.id AS target, row_number() OVER (PARTITION BY r.id, r.label ORDER BY abs(p.ordinal - r.ordinal), p.id) AS k FROM r JOIN passages p ON p.doc_sha256 = r.doc_sha256 AND p.id <> r.id AND TRY_CAST(string_split(p.section_path, '.')[1] AS INTEGER) = r.label)
SELECT id, label, target FROM c WHERE k = 1""")
def section_references(t: Tables) -> DataFrame:
    found = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("(?:section|Abschnitt) ([0-9]+)"), F.lit(1))))
    named = t.passages.select("id", "doc_sha256", "ordinal", found.alias("label")).withColumn("label", F.col("label").cast("int"))
    targets = t.passages.select(F.col("id").alias("target"), "doc_sha256", F.col("ordinal").alias("o"), F.substring_index("section_path", ".", 1).try_cast("int").alias("label"))
    rows = named.join(targets, ["doc_sha256", "label"]).filter("id <> target").groupBy("id", "label").agg(F.min(F.struct(F.abs(F.col("o") - F.col("ordinal")).alias("d"), "target")).alias("best"))
    return rows.select("id", "label", F.col("best.target").alias("target"))


@query("J26, Q12, U05, S04: rows of a new cut matched to kept ones by content and place among equals", """
WITH o AS (SELECT id, sha256(text) AS h, row_number() OVER (PARTITION BY sha256(text) ORDER BY id) AS k FROM passages WHERE id % 10 <> 3), n AS (SELECT id, sha256(text) AS h, row_number() OVER (PARTITION BY sha256(text) ORDER BY id) AS k FROM passages WHERE id % 10 <> 7)
SELECT o.id AS kept, n.id AS made, CASE WHEN o.id IS NULL THEN 'new' WHEN n.id IS NULL THEN 'gone' ELSE 'same' END AS state FROM o FULL JOIN n USING (h, k)""")
def rechunk_identity(t: Tables) -> DataFrame:
    def cut(without: int, name: str) -> DataFrame:
        rows = t.passages.filter(F.col("id") % 10 != without).select(F.col("id").alias(name), F.sha2("text", 256).alias("h"))
        return rows.withColumn("k", F.row_number().over(Window.partitionBy("h").orderBy(name)))

    state = F.when(F.col("kept").isNull(), "new").when(F.col("made").isNull(), "gone").otherwise("same")
    return cut(3, "kept").join(cut(7, "made"), ["h", "k"], "full").select("kept", "made", state.alias("state"))


@query("A35, A36, J27: exact copies among the documents, by normalised content", """
SELECT sha256(replace(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), 'ß', 'ss')) AS digest, count(*) AS copies, min(doc_id) AS first_id, count(DISTINCT text) AS spellings
FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def doc_exact_dups(t: Tables) -> DataFrame:
    rows = t.documents.filter("text IS NOT NULL").select("doc_id", "text", content_digest("text").alias("digest"))
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"), F.countDistinct("text").alias("spellings")).filter("copies > 1")


@query("J28: clusters of two clusterings that carry over: each holds most of the other", """
WITH a AS (SELECT p_partkey AS item, p_brand AS c FROM part), b AS (SELECT p_partkey AS item, CASE WHEN p_partkey % 5 = 0 THEN 'moved' ELSE p_brand END AS d FROM part),
s AS (SELECT c, d, count(*) AS shared FROM a JOIN b USING (item) GROUP BY 1, 2), x AS (SELECT c, count(*) AS nc FROM a GROUP BY 1), y AS (SELECT d, count(*) AS nd FROM b GROUP BY 1)
SELECT c, d, shared FROM s JOIN x USING (c) JOIN y USING (d) WHERE 2 * shared > nc AND 2 * shared > nd""")
def carried_clusters(t: Tables) -> DataFrame:
    a = t.part.select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("c"))
    b = t.part.select(F.col("p_partkey").alias("item"), F.when(F.col("p_partkey") % 5 == 0, "moved").otherwise(F.col("p_brand")).alias("d"))
    shared = a.join(b, "item").groupBy("c", "d").agg(F.count(F.lit(1)).alias("shared"))
    rows = shared.join(a.groupBy("c").agg(F.count(F.lit(1)).alias("nc")), "c").join(b.groupBy("d").agg(F.count(F.lit(1)).alias("nd")), "d")
    return rows.filter("2 * shared > nc AND 2 * shared > nd").select("c", "d", "shared")


@query("J29, U05: links that can be restored because both ends are there", """
SELECT DISTINCT fact_id, passage_id FROM fact_passages fp WHERE EXISTS (SELECT 1 FROM facts f WHERE f.id = fp.fact_id AND f.validated) AND EXISTS (SELECT 1 FROM passages p WHERE p.id = fp.passage_id AND p.block_type = 'text')""")
def restorable_links(t: Tables) -> DataFrame:
    facts, passages = t.facts.filter("validated").select(F.col("id").alias("fact_id")), t.passages.filter("block_type = 'text'").select(F.col("id").alias("passage_id"))
    return t.fact_passages.select("fact_id", "passage_id").distinct().join(facts, "fact_id", "left_semi").join(passages, "passage_id", "left_semi")


@query("J30: sentences each link points to, one a row, beside the room its passage has", """
SELECT DISTINCT fp.fact_id, fp.passage_id, unnest(fp.sentence_ids) AS sentence FROM fact_passages fp JOIN passages p ON p.id = fp.passage_id""")
def link_sentences(t: Tables) -> DataFrame:
    passages = t.passages.select(F.col("id").alias("passage_id"))
    return t.fact_passages.join(passages, "passage_id", "left_semi").select("fact_id", "passage_id", F.explode("sentence_ids").alias("sentence")).distinct()


@query("J32: head passage of a fact: its stored one, else its opening passage", """
SELECT f.id, coalesce(p.passage_id, o.passage_id) AS head FROM facts f LEFT JOIN (SELECT fact_id, min(passage_id) AS passage_id FROM fact_passages WHERE evidence_start = 0 GROUP BY 1) p ON p.fact_id = f.id
LEFT JOIN (SELECT fact_id, min(passage_id) AS passage_id FROM fact_passages WHERE position = 1 GROUP BY 1) o ON o.fact_id = f.id""")
def head_passages(t: Tables) -> DataFrame:
    least = lambda condition, name: t.fact_passages.filter(condition).groupBy(F.col("fact_id").alias("id")).agg(F.min("passage_id").alias(name))
    rows = t.facts.select("id").join(least("evidence_start = 0", "stored"), "id", "left").join(least("position = 1", "opening"), "id", "left")
    return rows.select("id", F.coalesce("stored", "opening").alias("head"))


@query("J33, J34: facts that rest on any list passage, whole, with all passages they rest on", """
SELECT fact_id, count(DISTINCT passage_id) AS passages FROM fact_passages WHERE fact_id IN (SELECT fact_id FROM fact_passages fp JOIN passages p ON p.id = fp.passage_id WHERE p.block_type = 'list') GROUP BY 1""")
def facts_kept_whole(t: Tables) -> DataFrame:
    lists = t.passages.filter("block_type = 'list'").select(F.col("id").alias("passage_id"))
    chosen = t.fact_passages.join(lists, "passage_id", "left_semi").select("fact_id").distinct()
    return t.fact_passages.join(chosen, "fact_id", "left_semi").groupBy("fact_id").agg(F.countDistinct("passage_id").alias("passages"))
