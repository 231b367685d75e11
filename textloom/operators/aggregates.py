"""Aggregations, distinct counts and statistics over sufficient sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.columns import numbers, share, words
from textloom.operators.windows import first_of, ranked
from textloom.registry import Tables, query

WORDS = "regexp_extract_all(lower(coalesce({}, '')), '[\\p{{L}}\\p{{N}}]+')"


@query("A01, D03, D04: fact quality in one pass", """
SELECT count(*) AS facts, count(*) FILTER (validated) AS valid, count(DISTINCT run_id) AS runs, round(avg(confidence) FILTER (validated), 6) AS sure, count(*) FILTER (confidence IS NULL) AS unmeasured,
 round(100.0 * count(*) FILTER (validated) / nullif(count(*), 0), 1) AS percent FROM facts""")
def fact_quality(t: Tables) -> DataFrame:
    n = F.count(F.lit(1))
    return t.facts.agg(
        n.alias("facts"), F.count_if("validated").alias("valid"), F.countDistinct("run_id").alias("runs"), F.round(F.avg(F.when(F.col("validated"), F.col("confidence"))), 6).alias("sure"),
        F.count_if(F.col("confidence").isNull()).alias("unmeasured"), F.round(100.0 * F.count_if("validated") / F.nullif(n, F.lit(0)), 1).alias("percent"),
    )


@query("A02, A16: spreads of questions over several columns at once", """
SELECT 'difficulty' AS axis, difficulty AS value, count(*) AS n FROM questions GROUP BY ALL UNION ALL SELECT 'question_type', question_type, count(*) FROM questions GROUP BY ALL UNION ALL
SELECT 'answer_form', answer_form, count(*) FROM questions GROUP BY ALL UNION ALL SELECT 'language', language, count(*) FROM questions GROUP BY ALL UNION ALL SELECT 'status', status, count(*) FROM questions GROUP BY ALL""")
def question_spreads(t: Tables) -> DataFrame:
    axes = ["difficulty", "question_type", "answer_form", "language", "status"]
    long = t.questions.select(F.inline(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("value")) for a in axes])))
    return long.groupBy("axis", "value").agg(F.count(F.lit(1)).alias("n"))


@query("A03: coverage funnel from documents to questions", """
SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(DISTINCT doc_sha256) FROM passages) AS with_passages, (SELECT count(DISTINCT passage_id) FROM fact_passages) AS passages_cited,
 (SELECT count(*) FROM facts WHERE validated) AS valid_facts, (SELECT count(DISTINCT fact_id) FROM question_facts) AS facts_asked""")
def coverage_funnel(t: Tables) -> DataFrame:
    parts = [
        t.documents.agg(F.count(F.lit(1)).alias("documents")), t.passages.agg(F.countDistinct("doc_sha256").alias("with_passages")), t.fact_passages.agg(F.countDistinct("passage_id").alias("passages_cited")),
        t.facts.agg(F.count_if("validated").alias("valid_facts")), t.question_facts.agg(F.countDistinct("fact_id").alias("facts_asked")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(p)  # one row each
    return out


@query("A04, A42, A43: shares per group", """
SELECT language, question_type, count(*) AS n, round(avg(confidence), 6) AS mean, round(count(*) FILTER (answer_form = 'value') / count(*), 6) AS values_share,
 round(count(*) FILTER (len(""" + WORDS.format("question_text") + """) BETWEEN 4 AND 14) / count(*), 6) AS in_bounds FROM questions GROUP BY 1, 2""")
def question_shares(t: Tables) -> DataFrame:
    n = F.count(F.lit(1))
    return t.questions.groupBy("language", "question_type").agg(
        n.alias("n"), F.round(F.avg("confidence"), 6).alias("mean"), share(F.count_if(F.col("answer_form") == "value"), n).alias("values_share"), share(F.count_if(F.size(words("question_text")).between(4, 14)), n).alias("in_bounds")
    )


@query("A05, A06, N10: status counts of a queue with a digest of the waiting keys in order", """
WITH b AS (SELECT extract_status AS status, id // 10000 AS k, count(*) AS n, count(*) FILTER (page_from IS NULL) AS u, md5(string_agg(concat(id, ':', coalesce(language, '')), ',' ORDER BY id)) AS d FROM passages GROUP BY 1, 2)
SELECT status, CAST(sum(n) AS BIGINT) AS n, CAST(sum(u) AS BIGINT) AS unplaced, md5(string_agg(d, ',' ORDER BY k)) AS digest FROM b GROUP BY 1""")
def queue_digest(t: Tables) -> DataFrame:
    # Two levels, by ten thousand ids: no status is gathered in one row of keys.
    key = F.concat(F.col("id").cast("string"), F.lit(":"), F.coalesce("language", F.lit("")))
    ordered = lambda k, v: F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k, v.alias("v")))), lambda x: x["v"]), ","))
    rows = t.passages.withColumn("k", F.floor(F.col("id") / 10_000)).groupBy(F.col("extract_status").alias("status"), "k")
    parts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("page_from").isNull()).alias("u"), ordered("id", key).alias("d"))
    return parts.groupBy("status").agg(F.sum("n").alias("n"), F.sum("u").alias("unplaced"), ordered("k", F.col("d")).alias("digest"))


@query("A07, D06: groups with members, distinct documents and mean, each counted before they meet", """
WITH s AS (SELECT string_split(section_path, '.')[1] AS chapter, id, doc_sha256, block_type FROM passages WHERE section_path IS NOT NULL)
SELECT s.chapter, count(DISTINCT s.id) AS passages, count(DISTINCT doc_sha256) AS documents, count(DISTINCT s.id) FILTER (block_type = 'table') AS tables, count(DISTINCT fp.fact_id) AS facts FROM s LEFT JOIN fact_passages fp ON fp.passage_id = s.id GROUP BY 1""")
def chapter_listing(t: Tables) -> DataFrame:
    s = t.passages.filter("section_path IS NOT NULL").select(F.substring_index("section_path", ".", 1).alias("chapter"), "id", "doc_sha256", "block_type")
    own = s.groupBy("chapter").agg(F.count("id").alias("passages"), F.countDistinct("doc_sha256").alias("documents"), F.count_if(F.col("block_type") == "table").alias("tables"))
    facts = t.fact_passages.select("fact_id", F.col("passage_id").alias("id")).distinct().join(s.select("id", "chapter"), "id").groupBy("chapter").agg(F.countDistinct("fact_id").alias("facts"))
    return own.join(facts, "chapter", "left").fillna(0, ["facts"])


@query("A08: per language least and largest length with a fallback where nothing bears a fact", """
WITH b AS (SELECT language, length(text) AS n, EXISTS (SELECT 1 FROM fact_passages fp WHERE fp.passage_id = p.id) AS bearing FROM passages p WHERE language IS NOT NULL)
SELECT language, min(n) AS least, max(n) AS most, coalesce(nullif(count(*) FILTER (bearing), 0), count(*)) AS counted FROM b GROUP BY 1""")
def fit_state(t: Tables) -> DataFrame:
    cited = t.fact_passages.select(F.col("passage_id").alias("id")).distinct().withColumn("bearing", F.lit(True))
    rows = t.passages.filter("language IS NOT NULL").select("id", "language", F.length("text").alias("n")).join(cited, "id", "left")
    some = F.count_if(F.coalesce("bearing", F.lit(False)))
    return rows.groupBy("language").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.coalesce(F.nullif(some, F.lit(0)), F.count(F.lit(1))).alias("counted"))


@query("A09: centroid of each label: the normalised mean of its vectors", """
WITH p AS (SELECT label, unnest(range(1, 65)) AS i, embedding FROM embeddings), m AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM p GROUP BY 1, 2), n AS (SELECT label, sqrt(sum(x * x)) AS n FROM m GROUP BY 1)
SELECT m.label, m.i - 1 AS dim, round(x / n, 6) AS x FROM m JOIN n USING (label)""")
def centroids(t: Tables) -> DataFrame:
    means = t.embeddings.select("label", F.posexplode("embedding").alias("dim", "v")).groupBy("label", "dim").agg(F.avg(F.col("v").cast("double")).alias("x"))
    norms = means.groupBy("label").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("n"))
    return means.join(norms, "label").select("label", "dim", F.round(F.col("x") / F.col("n"), 6).alias("x"))


@query("J11: nearest centroid of each query vector", """
WITH p AS (SELECT label, unnest(range(1, 65)) AS i, embedding FROM embeddings), m AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM p GROUP BY 1, 2),
s AS (SELECT e.vec_id, m.label, sum(m.x * CAST(e.embedding[m.i] AS DOUBLE)) AS dot FROM embeddings e JOIN m ON e.vec_id % 50 = 0 GROUP BY 1, 2), n AS (SELECT label, sqrt(sum(x * x)) AS n FROM m GROUP BY 1)
SELECT vec_id, label FROM (SELECT vec_id, label, row_number() OVER (PARTITION BY vec_id ORDER BY round(dot / n, 9) DESC, label) AS r FROM s JOIN n USING (label)) WHERE r = 1""")
def nearest_centroid(t: Tables) -> DataFrame:
    means = t.embeddings.select("label", F.posexplode("embedding").alias("dim", "v")).groupBy("label", "dim").agg(F.avg(F.col("v").cast("double")).alias("x"))
    norms = means.groupBy("label").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("n"))
    asked = t.embeddings.filter("vec_id % 50 = 0").select("vec_id", F.posexplode("embedding").alias("dim", "q"))
    dots = asked.join(means, "dim").groupBy("vec_id", "label").agg(F.sum(F.col("q").cast("double") * F.col("x")).alias("dot")).join(norms, "label")
    best = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.desc(F.round(F.col("dot") / F.col("n"), 9)), "label"))
    return dots.withColumn("r", best).filter("r = 1").select("vec_id", "label")


@query("A10: languages by frequency", "SELECT lower(lang) AS language, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1 ORDER BY n DESC, language")
def language_frequency(t: Tables) -> DataFrame:
    return t.documents.filter("lang IS NOT NULL").groupBy(F.lower("lang").alias("language")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "language")


@query("A11, A39: agreement of two verdicts; null over no rows", """
SELECT kind, count(*) AS n, count(*) FILTER (validated = (confidence >= 0.75)) AS agreed, round(count(*) FILTER (validated = (confidence >= 0.75)) / nullif(count(*) FILTER (confidence IS NOT NULL), 0), 6) AS rate FROM facts GROUP BY 1""")
def agreement_rate(t: Tables) -> DataFrame:
    agreed = F.count_if(F.col("validated") == (F.col("confidence") >= 0.75))
    return t.facts.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), agreed.alias("agreed"), share(agreed, F.count("confidence")).alias("rate"))


@query("A12, A13, U01, N13: known runs out of live rows and archived JSON, rolled up", """
WITH a AS (SELECT event_type AS run, 1 AS n, event_id AS seen, false AS archived FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_type, CAST(props ->> '$.k' AS INTEGER), event_id, true FROM events WHERE event_id % 2 = 1)
SELECT run, bool_and(archived) AS all_archived, max(seen) AS latest, CAST(sum(n) AS BIGINT) AS total FROM a GROUP BY 1""")
def known_runs(t: Tables) -> DataFrame:
    live = t.events.filter("event_id % 2 = 0").select(F.col("event_type").alias("run"), F.lit(1).alias("n"), F.col("event_id").alias("seen"), F.lit(False).alias("archived"))
    old = t.events.filter("event_id % 2 = 1").select(F.col("event_type").alias("run"), F.get_json_object("props", "$.k").cast("int").alias("n"), F.col("event_id").alias("seen"), F.lit(True).alias("archived"))
    return live.unionByName(old).groupBy("run").agg(F.bool_and("archived").alias("all_archived"), F.max("seen").alias("latest"), F.sum("n").alias("total"))


@query("A14: two runs beside each other, by absolute difference of shares", """
WITH c AS (SELECT batch_no, coalesce(rejection_code, 'kept') AS gate, count(*) AS n FROM facts WHERE batch_no IN (1, 2) GROUP BY 1, 2), s AS (SELECT batch_no, gate, n, n / sum(n) OVER (PARTITION BY batch_no) AS share FROM c)
SELECT gate, coalesce(a.n, 0) AS before, coalesce(b.n, 0) AS after, round(coalesce(b.share, 0) - coalesce(a.share, 0), 6) AS change FROM (SELECT * FROM s WHERE batch_no = 1) a FULL JOIN (SELECT * FROM s WHERE batch_no = 2) b USING (gate)""")
def run_difference(t: Tables) -> DataFrame:
    rows = t.facts.filter("batch_no IN (1, 2)").groupBy(F.coalesce("rejection_code", F.lit("kept")).alias("gate")).pivot("batch_no", [1, 2]).agg(F.count(F.lit(1))).fillna(0, ["1", "2"])
    whole = rows.agg(F.sum("1").alias("t1"), F.sum("2").alias("t2"))
    out = rows.crossJoin(whole)  # one row
    return out.select("gate", F.col("1").alias("before"), F.col("2").alias("after"), F.round(F.col("2") / F.col("t2") - F.col("1") / F.col("t1"), 6).alias("change")).orderBy(F.desc(F.abs("change")), "gate")


@query("A15: holdings by kind", "SELECT outcome, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS bytes, min(submitted_at) AS oldest, max(submitted_at) AS newest FROM ingest_events GROUP BY 1")
def archive_holdings(t: Tables) -> DataFrame:
    return t.ingest_events.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("bytes"), F.min("submitted_at").alias("oldest"), F.max("submitted_at").alias("newest"))


@query("A16: composition of the pool on its axes, categories one by one", """
WITH r AS (SELECT DISTINCT * FROM release_pool), c AS (SELECT 'category' AS axis, lower(trim(x)) AS value FROM (SELECT unnest(categories) AS x FROM r))
SELECT 'difficulty' AS axis, lower(trim(difficulty)) AS value, count(*) AS n FROM r GROUP BY 1, 2 UNION ALL SELECT 'language', lower(trim(language)), count(*) FROM r GROUP BY 1, 2 UNION ALL SELECT axis, value, count(*) FROM c GROUP BY 1, 2""")
def pool_composition(t: Tables) -> DataFrame:
    r = t.release_pool.distinct()
    clean = lambda c: F.lower(F.trim(c))
    some = F.array(F.struct(F.lit("difficulty").alias("axis"), clean(F.col("difficulty")).alias("value")), F.struct(F.lit("language").alias("axis"), clean(F.col("language")).alias("value")))
    own = F.transform(F.coalesce("categories", F.array()), lambda x: F.struct(F.lit("category").alias("axis"), clean(x).alias("value")))
    return r.select(F.inline(F.concat(some, own))).groupBy("axis", "value").agg(F.count(F.lit(1)).alias("n"))


@query("A17: supply per kind with a ceiling on one of them", """
WITH n AS (SELECT count(DISTINCT id) AS n FROM release_pool) SELECT answerable, CASE WHEN answerable THEN count(DISTINCT id) ELSE least(count(DISTINCT id), CAST(floor(max(n) * 0.05) AS BIGINT)) END AS supply FROM release_pool, n GROUP BY 1""")
def capped_supply(t: Tables) -> DataFrame:
    whole = t.release_pool.agg(F.countDistinct("id").alias("n"))
    per = t.release_pool.groupBy("answerable").agg(F.countDistinct("id").alias("s")).crossJoin(whole)  # one row
    return per.select("answerable", F.when(F.col("answerable"), F.col("s")).otherwise(F.least("s", F.floor(F.col("n") * 0.05))).alias("supply"))


@query("A18, A19, G12, W24: margins of several readings against their thresholds, the least of them as confidence", """
WITH r AS (SELECT l_orderkey, l_linenumber, greatest(0, least(1, (l_quantity - 10) / 40)) AS m1, greatest(0, least(1, (0.08 - l_discount) / 0.08)) AS m2, l_tax FROM lineitem)
SELECT l_orderkey, l_linenumber, round(least(m1, m2), 4) AS confidence, CASE WHEN m1 <= 0 THEN 'quantity' WHEN m2 <= 0 THEN 'discount' END AS gate FROM r""")
def least_margin(t: Tables) -> DataFrame:
    def margin(value, threshold: float, safe_end: float):
        room = abs(safe_end - threshold)
        away = (value - threshold) if safe_end > threshold else (threshold - value)
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), away / room)) if room else F.lit(0.0)

    m1, m2 = margin(F.col("l_quantity"), 10, 50), margin(F.col("l_discount"), 0.08, 0.0)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(F.least(m1, m2), 4).alias("confidence"), F.when(m1 <= 0, "quantity").when(m2 <= 0, "discount").alias("gate"))


@query("A20, P19: rows whose recomputed value differs, by a null-safe test", """
SELECT id, confidence, n FROM (SELECT id, confidence, CASE WHEN len(units_statement) = 0 THEN NULL WHEN confidence > 0.9 THEN 0.9 ELSE confidence END AS n FROM facts) WHERE n IS DISTINCT FROM confidence""")
def recalibrated(t: Tables) -> DataFrame:
    n = F.when(F.size("units_statement") == 0, F.lit(None)).when(F.col("confidence") > 0.9, F.lit(0.9)).otherwise(F.col("confidence"))
    return t.facts.select("id", "confidence", n.alias("n")).filter(~F.col("n").eqNullSafe(F.col("confidence")))


@query("A21: n-gram diversity of each language's questions: distinct over all runs of one to four words of the joined texts, summed", """
WITH w AS (SELECT language, flatten(list(list_filter(string_split_regex(trim(question_text), '\\s+'), lambda x: x <> '') ORDER BY id)) AS ws FROM questions WHERE language IS NOT NULL AND question_text IS NOT NULL GROUP BY 1),
g AS (SELECT language, n, array_to_string(ws[i:i + n - 1], ' ') AS gram FROM w, (SELECT unnest([1, 2, 3, 4]) AS n), LATERAL (SELECT unnest(range(1, len(ws) - n + 2)) AS i)),
d AS (SELECT language, n, count(DISTINCT gram) / count(*) AS d FROM g GROUP BY 1, 2) SELECT language, round(sum(d), 6) AS diversity FROM d GROUP BY 1""")
def ngram_diversity(t: Tables) -> DataFrame:
    """The texts are joined in order of id; a run may cross into the next texts, whose first words are brought by rank, not by gathering a language."""
    held = F.filter(F.split(F.trim("question_text"), r"\s+"), lambda x: x != "")
    rows = ranked(t.questions.filter("language IS NOT NULL AND question_text IS NOT NULL").select("language", "id", held.alias("ws")).filter(F.size("ws") > 0), "language", "id", "rank")
    heads = rows.select("language", "rank", F.slice("ws", 1, 3).alias("head"))
    for k in (1, 2, 3):
        rows = rows.join(heads.select("language", (F.col("rank") - k).alias("rank"), F.col("head").alias(f"h{k}")), ["language", "rank"], "left")
    none = F.array().cast("array<string>")
    after = F.slice(F.concat(*[F.coalesce(f"h{k}", none) for k in (1, 2, 3)]), 1, 3)
    rows = rows.select("language", F.size("ws").alias("own"), F.concat("ws", after).alias("ws"), F.explode(F.array(*[F.lit(i) for i in (1, 2, 3, 4)])).alias("n"))
    last = F.least(F.col("own"), F.size("ws") - F.col("n") + 1)
    grams = rows.filter(last >= 1).select("language", "n", F.explode(F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.array_join(F.slice("ws", i, F.col("n")), " ")))).alias("gram"))
    counts = grams.groupBy("language", "n", "gram").agg(F.count(F.lit(1)).alias("c"))  # a hot language is spread by its grams
    each = counts.groupBy("language", "n").agg((F.count(F.lit(1)) / F.sum("c")).alias("d"))
    return each.groupBy("language").agg(F.round(F.sum("d"), 6).alias("diversity"))


@query("A22: share of texts that hold a run of four words another text holds", """
WITH w AS (SELECT id, """ + WORDS.format("statement") + """ AS ws FROM facts), g AS (SELECT DISTINCT id, array_to_string(ws[i:i + 3], ' ') AS gram FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 2)) AS i)),
s AS (SELECT gram, count(*) AS n FROM g GROUP BY 1) SELECT round(count(DISTINCT id) FILTER (n > 1) / (SELECT count(*) FROM facts), 6) AS repetition FROM g JOIN s USING (gram)""")
def self_repetition(t: Tables) -> DataFrame:
    rows = t.facts.select("id", words("statement").alias("ws")).filter(F.size("ws") >= 4)
    grams = rows.select("id", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("ws") - 3), lambda i: F.xxhash64(F.array_join(F.slice("ws", i, 4), " "))))).alias("gram"))
    shared = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    some = grams.join(shared, "gram", "left_semi").agg(F.countDistinct("id").alias("some"))
    return some.crossJoin(t.facts.agg(F.count(F.lit(1)).alias("n"))).select(share(F.col("some"), F.col("n")).alias("repetition"))  # one row each


@query("A24: homogeneity of each label: mean pairwise cosine from the sum of the unit vectors", """
WITH u AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n FROM embeddings),
d AS (SELECT label, unnest(range(1, 65)) AS i, v, n FROM u), s AS (SELECT label, i, sum(v[i] / n) AS x FROM d GROUP BY 1, 2), c AS (SELECT label, count(*) AS k FROM embeddings GROUP BY 1)
SELECT label, round((sum(x * x) - max(k)) / (max(k) * (max(k) - 1)), 6) AS homogeneity FROM s JOIN c USING (label) GROUP BY 1 HAVING max(k) >= 2""")
def homogenization(t: Tables) -> DataFrame:
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = t.embeddings.select("label", norm.alias("n"), F.posexplode("embedding").alias("i", "v")).filter("n > 0")
    sums = rows.groupBy("label", "i").agg(F.sum(F.col("v").cast("double") / F.col("n")).alias("x"), F.count(F.lit(1)).alias("k"))
    k = F.max("k")
    return sums.groupBy("label").agg(F.sum(F.col("x") * F.col("x")).alias("ss"), k.alias("k")).filter("k >= 2").select("label", F.round((F.col("ss") - F.col("k")) / (F.col("k") * (F.col("k") - 1)), 6).alias("homogeneity"))


@query("A28, A29, A30: prediction-powered mean with tuned weight, its standard error and interval", """
WITH r AS (SELECT CASE WHEN validated THEN 1.0 ELSE 0.0 END AS y, coalesce(confidence, 0.5) AS f, batch_no = 1 AS labelled FROM facts),
s AS (SELECT count(*) FILTER (labelled) AS n, count(*) FILTER (NOT labelled) AS m, covar_pop(y, f) FILTER (labelled) AS c, var_samp(f) AS v, avg(f) FILTER (NOT labelled) AS fu FROM r),
w AS (SELECT *, greatest(-1, least(1, c / ((1 + n / m) * v))) AS w FROM s), e AS (SELECT w, fu, n, m, avg(y - w * f) FILTER (labelled) AS d, var_pop(w * f) FILTER (NOT labelled) AS vu, var_pop(y - w * f) FILTER (labelled) AS vl FROM r, w GROUP BY w, fu, n, m)
SELECT round(w, 6) AS weight, round(w * fu + d, 6) AS estimate, round(sqrt(vu / m + vl / n), 6) AS error, round(w * fu + d - 1.959963984540054 * sqrt(vu / m + vl / n), 6) AS low, round(w * fu + d + 1.959963984540054 * sqrt(vu / m + vl / n), 6) AS high FROM e""")
def prediction_powered(t: Tables) -> DataFrame:
    rows = t.facts.select(F.when(F.col("validated"), 1.0).otherwise(0.0).alias("y"), F.coalesce("confidence", F.lit(0.5)).alias("f"), (F.col("batch_no") == 1).alias("labelled"))
    lab = lambda c: F.when(F.col("labelled"), c)
    rest = lambda c: F.when(~F.col("labelled"), c)
    y, f = F.col("y"), F.col("f")
    s = rows.agg(
        F.count(lab(y)).alias("n"), F.count(rest(f)).alias("m"), F.covar_pop(lab(y), lab(f)).alias("c"), F.var_samp(f).alias("v"), F.avg(rest(f)).alias("fu"), F.avg(lab(y)).alias("my"), F.avg(lab(f)).alias("mf"),
        F.var_pop(rest(f)).alias("vf"), F.var_pop(lab(y)).alias("vy"), F.var_pop(lab(f)).alias("vl"),
    )
    w = F.when((F.col("m") == 0) | (F.col("v") == 0), 0.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("c") / ((1 + F.col("n") / F.col("m")) * F.col("v")))))
    s = s.withColumn("w", w)
    estimate = F.col("w") * F.col("fu") + F.col("my") - F.col("w") * F.col("mf")
    # The variance of y - w f from the moments at hand, so that one pass over the rows suffices.
    spread = F.col("vy") + F.col("w") ** 2 * F.col("vl") - 2 * F.col("w") * F.col("c")
    error = F.sqrt(F.col("w") ** 2 * F.col("vf") / F.col("m") + spread / F.col("n"))
    z = 1.959963984540054
    return s.select(F.round("w", 6).alias("weight"), F.round(estimate, 6).alias("estimate"), F.round(error, 6).alias("error"), F.round(estimate - z * error, 6).alias("low"), F.round(estimate + z * error, 6).alias("high"))


@query("A31, A46: estimates of strata pooled by their share", """
WITH s AS (SELECT kind, count(*) AS n, avg(confidence) AS est, sqrt(var_pop(confidence) / count(*)) AS se FROM facts WHERE confidence IS NOT NULL GROUP BY 1 HAVING count(*) >= 2), t AS (SELECT sum(n) AS t FROM s)
SELECT round(sum(n / t * est), 6) AS estimate, round(sqrt(sum(power(n / t, 2) * power(se, 2))), 6) AS error FROM s, t""")
def pooled_strata(t: Tables) -> DataFrame:
    s = t.facts.filter("confidence IS NOT NULL").groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("est"), (F.var_pop("confidence") / F.count(F.lit(1))).alias("v")).filter("n >= 2")
    return s.agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.col("est")).alias("e"), F.sum(F.col("n") ** 2 * F.col("v")).alias("v")).select(F.round(F.col("e") / F.col("t"), 6).alias("estimate"), F.round(F.sqrt("v") / F.col("t"), 6).alias("error"))


@query("A32, G03: terms kept between document-frequency bounds; how many topics their passages give", """
WITH v AS (SELECT DISTINCT id, language, lower(trim(x)) AS term FROM (SELECT id, language, unnest(lemmas) AS x FROM passage_vocabulary WHERE language IS NOT NULL) WHERE trim(x) <> ''), n AS (SELECT language, count(DISTINCT id) AS n FROM v GROUP BY 1),
d AS (SELECT language, term, count(*) AS df FROM v GROUP BY 1, 2) SELECT language, count(*) AS terms, max(n) AS passages, greatest(2, least(12, max(n) // 40)) AS topics FROM d JOIN n USING (language) WHERE df >= 3 AND df <= 0.5 * n GROUP BY 1""")
def term_bounds(t: Tables) -> DataFrame:
    x = t.passage_vocabulary.filter("language IS NOT NULL").select("id", "language", F.explode("lemmas").alias("x"))
    v = x.select("id", "language", F.lower(F.trim("x")).alias("term")).filter("term <> ''").distinct()
    n = v.groupBy("language").agg(F.countDistinct("id").alias("n"))
    d = v.groupBy("language", "term").agg(F.count(F.lit(1)).alias("df")).join(n, "language").filter("df >= 3 AND df <= 0.5 * n")
    return d.groupBy("language").agg(F.count(F.lit(1)).alias("terms"), F.max("n").alias("passages")).withColumn("topics", F.greatest(F.lit(2), F.least(F.lit(12), F.floor(F.col("passages") / 40))))


def weighted(t: Tables) -> DataFrame:
    """(id, language, term, weight): tf times log2(passages / df), document frequencies by language, each passage of unit length."""
    x = t.passage_vocabulary.filter("language IS NOT NULL").distinct().select("id", "language", F.explode("lemmas").alias("x"))
    tf = x.select("id", "language", F.lower(F.trim("x")).alias("term")).filter("term <> ''").groupBy("id", "language", "term").agg(F.count(F.lit(1)).alias("tf"))
    df, n = tf.groupBy("language", "term").agg(F.count(F.lit(1)).alias("df")), tf.groupBy("language").agg(F.countDistinct("id").alias("n"))
    idf = df.join(n, "language").select("language", "term", F.log2(F.col("n") / F.col("df")).alias("idf"))
    w = tf.join(idf, ["language", "term"]).select("id", "language", "term", (F.col("tf") * F.col("idf")).alias("w"))
    length = w.groupBy("id", "language").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l")).filter("l > 0")
    return w.join(length, ["id", "language"]).select("id", "language", "term", (F.col("w") / F.col("l")).alias("weight"))


_WEIGHTS = """
WITH v AS (SELECT id, language, lower(trim(x)) AS term FROM (SELECT id, language, unnest(lemmas) AS x FROM (SELECT DISTINCT * FROM passage_vocabulary) WHERE language IS NOT NULL) WHERE trim(x) <> ''),
tf AS (SELECT id, language, term, count(*) AS tf FROM v GROUP BY 1, 2, 3), n AS (SELECT language, count(DISTINCT id) AS n FROM v GROUP BY 1), df AS (SELECT language, term, count(*) AS df FROM tf GROUP BY 1, 2),
w AS (SELECT id, language, term, tf * log2(n / df) AS w FROM tf JOIN df USING (language, term) JOIN n USING (language)), l AS (SELECT id, language, sqrt(sum(w * w)) AS l FROM w GROUP BY 1, 2),
u AS (SELECT id, language, term, w / l AS weight FROM w JOIN l USING (id, language) WHERE l > 0)
"""


@query("N08: tf-idf weights of every language, normalised over each passage", _WEIGHTS + "SELECT id, language, term, round(weight, 6) AS weight FROM u")
def tfidf_unit(t: Tables) -> DataFrame:
    return weighted(t).select("id", "language", "term", F.round("weight", 6).alias("weight"))


@query("A25: cohesion of clusters of passages: the mean cosine of their pairs on tf-idf vectors, and its mean over clusters of two and more", _WEIGHTS + """,
k AS (SELECT u.*, string_split(section_path, '.')[1] AS cluster FROM u JOIN passages USING (id) WHERE section_path IS NOT NULL), s AS (SELECT u.language, cluster, term, sum(weight) AS s FROM k u GROUP BY 1, 2, 3),
m AS (SELECT language, cluster, count(DISTINCT id) AS members FROM k GROUP BY 1, 2), c AS (SELECT language, cluster, members, (sum(s * s) - members) / (members * (members - 1)) AS cohesion FROM s JOIN m USING (language, cluster) WHERE members > 1 GROUP BY 1, 2, 3)
SELECT language, count(*) AS clusters, round(avg(cohesion), 6) AS cohesion FROM c GROUP BY 1""")
def cohesion(t: Tables) -> DataFrame:
    """(language, clusters, cohesion). The vectors are of unit length, so a cluster's sum of cosines is the square of the length of the sum of its
    vectors less its members; clusters are a language's chapters here."""
    chapters = t.passages.filter("section_path IS NOT NULL").select("id", F.substring_index("section_path", ".", 1).alias("cluster"))
    placed = weighted(t).select("id", "language", "term", "weight").join(chapters, "id")
    squares = placed.groupBy("language", "cluster", "term").agg(F.sum("weight").alias("s")).groupBy("language", "cluster").agg(F.sum(F.col("s") * F.col("s")).alias("squares"))
    members = placed.groupBy("language", "cluster").agg(F.countDistinct("id").alias("members")).filter("members > 1")
    each = squares.join(members, ["language", "cluster"]).withColumn("c", (F.col("squares") - F.col("members")) / (F.col("members") * (F.col("members") - 1)))
    return each.groupBy("language").agg(F.count(F.lit(1)).alias("clusters"), F.round(F.avg("c"), 6).alias("cohesion"))


@query("A32, A33: terms of a language within the bounds of rare and common; a language with too few passages or terms is one topic of its most common terms", """
WITH v AS (SELECT DISTINCT id, language, lower(trim(x)) AS term FROM (SELECT id, language, unnest(lemmas) AS x FROM passage_vocabulary WHERE language IS NOT NULL) WHERE trim(x) <> ''), n AS (SELECT language, count(DISTINCT id) AS n FROM v GROUP BY 1),
d AS (SELECT language, term, count(*) AS df, max(n) AS n FROM v JOIN n USING (language) GROUP BY 1, 2), k AS (SELECT language, count(*) FILTER (df >= CASE WHEN n < 50 THEN 2 ELSE 5 END AND df <= 0.5 * n) AS kept, max(n) AS n FROM d GROUP BY 1),
r AS (SELECT language, term, df, row_number() OVER (PARTITION BY language ORDER BY df DESC, term) AS r FROM d)
SELECT language, n AS passages, kept, n < 50 OR kept < 20 AS single, CASE WHEN n < 50 OR kept < 20 THEN (SELECT list(term ORDER BY r) FROM r WHERE r.language = k.language AND r.r <= 10) END AS terms FROM k""")
def single_topics(t: Tables) -> DataFrame:
    """(language, passages, kept, single, terms). In a small language (under 50 passages) a term counts from two passages on, else from five."""
    x = t.passage_vocabulary.filter("language IS NOT NULL").select("id", "language", F.explode("lemmas").alias("x"))
    v = x.select("id", "language", F.lower(F.trim("x")).alias("term")).filter("term <> ''").distinct()
    n = v.groupBy("language").agg(F.countDistinct("id").alias("n"))
    d = v.groupBy("language", "term").agg(F.count(F.lit(1)).alias("df")).join(n, "language")
    inside = (F.col("df") >= F.when(F.col("n") < 50, 2).otherwise(5)) & (F.col("df") <= 0.5 * F.col("n"))
    k = d.groupBy("language").agg(F.max("n").alias("passages"), F.count_if(inside).alias("kept"))
    top = first_of(d.select("language", "term", "df"), ["language"], [F.desc("df"), "term"], 10).groupBy("language").agg(F.array_sort(F.collect_list(F.struct((-F.col("df")).alias("o"), "term"))).alias("o"))  # ten a language
    single = (F.col("passages") < 50) | (F.col("kept") < 20)
    return k.join(top, "language").select("language", "passages", "kept", single.alias("single"), F.when(single, F.transform("o", lambda e: e["term"])).alias("terms"))


@query("A37, A40: statements that name the same numbers", """
SELECT array_to_string(list_sort(regexp_extract_all(statement, '[0-9]+')), ' ') AS numbers, count(*) AS n, min(id) AS first_id FROM facts WHERE regexp_matches(statement, '[0-9]') GROUP BY 1 HAVING count(*) > 1""")
def number_twins(t: Tables) -> DataFrame:
    rows = t.facts.select("id", F.array_join(numbers("statement"), " ").alias("numbers")).filter("numbers <> ''")
    return rows.groupBy("numbers").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id")).filter("n > 1")


@query("A41: words that only one document of a source has", """
WITH w AS (SELECT DISTINCT source, doc_id, unnest(""" + WORDS.format("text") + """) AS word FROM documents WHERE source IS NOT NULL)
SELECT source, min(doc_id) AS doc_id, word FROM w GROUP BY source, word HAVING count(*) = 1""")
def owned_words(t: Tables) -> DataFrame:
    rows = t.documents.filter("source IS NOT NULL").select("source", "doc_id", F.explode(F.array_distinct(words("text"))).alias("word"))
    return rows.distinct().groupBy("source", "word").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id")).filter("n = 1").select("source", "doc_id", "word")


@query("A45, M02: facts that rest on exactly one passage, and that a list", """
SELECT fact_id FROM fact_passages GROUP BY 1 HAVING count(DISTINCT passage_id) = 1 AND min(passage_id) IN (SELECT id FROM passages WHERE block_type = 'list')""")
def resting_on_one(t: Tables) -> DataFrame:
    one = t.fact_passages.groupBy("fact_id").agg(F.countDistinct("passage_id").alias("n"), F.min("passage_id").alias("id")).filter("n = 1")
    return one.join(t.passages.filter("block_type = 'list'").select("id"), "id", "left_semi").select("fact_id")


@query("A23: compression ratio of each source's text", None)
def compression_ratio(t: Tables) -> DataFrame:
    """Raw over compressed bytes. Texts are compressed in blocks of about a megabyte, so that no source is gathered in one task."""
    import zlib

    import pandas as pd

    size = F.sum(F.length("text")).over(Window.partitionBy("source", "part").orderBy("doc_id"))
    rows = t.documents.filter("text IS NOT NULL").select("source", "doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("part")).withColumn("block", F.floor(size / 1_000_000))

    def ratio(b: pd.DataFrame) -> pd.DataFrame:
        raw = "\n".join(b.sort_values("doc_id")["text"]).encode()
        return pd.DataFrame({"source": b["source"].iloc[:1], "raw": [len(raw)], "packed": [len(zlib.compress(raw, 9))]})

    parts = rows.groupBy("source", "part", "block").applyInPandas(ratio, "source string, raw bigint, packed bigint")
    return parts.groupBy("source").agg(share(F.sum("raw"), F.sum("packed")).alias("ratio"))


def welch(a: tuple[int, float, float], b: tuple[int, float, float]) -> float | None:
    """Two-sided p of Welch's test from (n, mean, sample variance) of either side; None where a side is too small or both are constant."""
    import math

    (n, x, v), (m, y, w) = a, b
    if n < 2 or m < 2 or v / n + w / m == 0:
        return None
    s = v / n + w / m
    free, stat = s * s / ((v / n) ** 2 / (n - 1) + (w / m) ** 2 / (m - 1)), (x - y) / math.sqrt(s)
    # The incomplete beta function at free / (free + stat squared), by its continued fraction.
    p, q, z = free / 2, 0.5, free / (free + stat * stat)

    def fraction(a: float, b: float, x: float) -> float:
        tiny, c = 1e-300, 1.0
        d = 1 / (1 - (a + b) * x / (a + 1) or tiny)
        h = d
        for k in range(1, 300):
            for e in (k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k)), -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))):
                d = 1 / (1 + e * d or tiny)
                c = 1 + e / c or tiny
                h *= d * c
            if abs(d * c - 1) < 1e-12:
                break
        return h

    front = math.exp(math.lgamma(p + q) - math.lgamma(p) - math.lgamma(q) + p * math.log(z) + q * math.log1p(-z)) if 0 < z < 1 else 0.0
    inside = front * fraction(p, q, z) / p if z < (p + 1) / (p + q + 2) else 1 - front * fraction(q, p, 1 - z) / q
    return 1.0 if z >= 1 else inside


@query("A26: Welch's test of confidence between two kinds of facts", None)
def welch_test(t: Tables) -> DataFrame:
    rows = {r["kind"]: r for r in t.facts.filter("kind IN ('atomic', 'bridge') AND confidence IS NOT NULL").groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("m"), F.var_samp("confidence").alias("v")).collect()}
    side = lambda k: (rows[k]["n"], rows[k]["m"], rows[k]["v"] or 0.0) if k in rows else (0, 0.0, 0.0)
    return t.spark.createDataFrame([("atomic", "bridge", welch(side("atomic"), side("bridge")))], "a string, b string, p double")
