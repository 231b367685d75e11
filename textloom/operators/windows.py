"""Ranking, sampling in a fixed order, carried values, islands and apportionment.

Orders are by md5 of the key where the draw should look random, so that they are the same on every engine and at every partitioning.
A rank is taken within keys that bound its window; rankings over a whole table are cut by a top-k first or counted by buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.groups import walked
from textloom.registry import Tables, query


def hashed(c: str) -> Column:
    return F.md5(F.col(c).cast("string"))


def first_of(df: DataFrame, keys: list[str], order: list[Column | str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in the order given."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")


def highest_averages(weights: DataFrame, name: str, weight: str, slots: int) -> DataFrame:
    """(name, seats) by highest averages: seat j of a name has the key weight / (2 j + 1); the largest ``slots`` keys win, ties to the name
    that comes first. Weights of zero or less get none."""
    rows = weights.filter(F.col(weight) > 0).select(F.col(name).alias("name"), F.col(weight).cast("double").alias("w"))
    keys = rows.select("name", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("j"), "w").withColumn("k", F.col("w") / (2 * F.col("j") + 1))
    won = keys.orderBy(F.desc("k"), "name", "j").limit(slots)
    return won.groupBy("name").agg(F.count(F.lit(1)).alias("seats"))


def largest_remainder(weights: DataFrame, name: str, weight: str, size: int) -> DataFrame:
    """(name, seats): the whole part of each share, and the seats left over by largest remainder, then name."""
    rows = weights.select(F.col(name).alias("name"), F.col(weight).cast("double").alias("w"))
    exact = rows.crossJoin(rows.agg(F.sum("w").alias("t"))).withColumn("x", size * F.col("w") / F.col("t"))  # one row
    whole = exact.withColumn("base", F.floor("x")).withColumn("rest", F.round(F.col("x") - F.floor("x"), 9))
    left = whole.agg((F.lit(size) - F.sum("base")).alias("left"))
    r = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("rest"), "name"))  # one row a name, few by nature
    return whole.withColumn("r", r).crossJoin(left).select("name", (F.col("base") + (F.col("r") <= F.col("left")).cast("int")).alias("seats"))


#: Places of one key that a task orders at once; a longer run is ordered by stretches, whose ends are joined.
STRETCH = 10_000


def _stretched(df: DataFrame, key: str, order: str) -> tuple[DataFrame, Window, Window]:
    """``df`` with the stretch of each place, the window within a stretch, and the window over the stretches of a key."""
    rows = df.withColumn("_s", F.floor(F.col(order) / STRETCH))
    return rows, Window.partitionBy(key, "_s").orderBy(order), Window.partitionBy(key).orderBy("_s")


def ranked(df: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """``df`` with its rank from 1 within the key by a whole-numbered, unique place, no key being sorted in one task."""
    rows, within, over = _stretched(df, key, order)
    counts = rows.groupBy(key, "_s").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(over) - F.col("_n")).drop("_n")
    return rows.withColumn("_r", F.row_number().over(within)).join(before, [key, "_s"]).withColumn(name, F.col("_r") + F.col("_before")).drop("_s", "_r", "_before")


def carried(df: DataFrame, key: str, order: str, value: str, name: str, ahead: bool = False) -> DataFrame:
    """``df`` with the last known value up to each place, or the first known after it, in stretches as ``ranked``."""
    rows, within, over = _stretched(df, key, order)
    best = F.min_by if ahead else F.max_by
    ends = rows.groupBy(key, "_s").agg(best(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias("_v"))
    if ahead:
        own = F.first(value, True).over(within.rowsBetween(1, Window.unboundedFollowing))
        other = F.first("_v", True).over(over.rowsBetween(1, Window.unboundedFollowing))
    else:
        own = F.last(value, True).over(within.rowsBetween(Window.unboundedPreceding, 0))
        other = F.last("_v", True).over(over.rowsBetween(Window.unboundedPreceding, -1))
    joined = rows.withColumn("_own", own).join(ends.withColumn("_other", other).drop("_v"), [key, "_s"])
    return joined.withColumn(name, F.coalesce("_own", "_other")).drop("_s", "_own", "_other")


@query("W01: dominant part type of each order, by spend, then name", """
WITH w AS (SELECT l_orderkey, p_type, sum(l_extendedprice) AS spend FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT l_orderkey, p_type, round(spend, 2) AS spend FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY spend DESC, p_type) AS r FROM w) WHERE r = 1""")
def dominant_type(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_extendedprice", F.col("l_partkey").alias("p_partkey")).join(t.part.select("p_partkey", "p_type"), "p_partkey")
    spend = rows.groupBy("l_orderkey", "p_type").agg(F.sum("l_extendedprice").alias("spend"))
    return first_of(spend, ["l_orderkey"], [F.desc("spend"), "p_type"]).select("l_orderkey", "p_type", F.round("spend", 2).alias("spend"))


@query("W03, W04, W05: facts of a passage kept under a cap: those with units first, then by id, room by the sentences cited", """
WITH l AS (SELECT DISTINCT fact_id, passage_id FROM fact_passages WHERE position = 1), s AS (SELECT passage_id, greatest(2, len(list_distinct(flatten(list(sentence_ids))))) AS room FROM fact_passages WHERE sentence_ids IS NOT NULL GROUP BY 1),
r AS (SELECT l.*, row_number() OVER (PARTITION BY passage_id ORDER BY len(f.units_statement) = 0, f.id) AS r FROM l JOIN facts f ON f.id = l.fact_id WHERE f.kind = 'atomic')
SELECT fact_id, r.passage_id, r <= coalesce(room, 2) AS kept FROM r LEFT JOIN s USING (passage_id)""")
def capped_facts(t: Tables) -> DataFrame:
    # Passages with very many facts are ranked only among the rows that can be kept: the order is known before the window.
    links = t.fact_passages.filter("position = 1").select("fact_id", "passage_id").distinct()
    room = t.fact_passages.select("passage_id", F.explode("sentence_ids").alias("s")).distinct().groupBy("passage_id").agg(F.greatest(F.lit(2), F.count(F.lit(1))).alias("room"))
    facts = t.facts.filter("kind = 'atomic'").select(F.col("id").alias("fact_id"), (F.size("units_statement") == 0).alias("bare"))
    r = F.row_number().over(Window.partitionBy("passage_id").orderBy("bare", "fact_id"))
    rows = links.join(facts, "fact_id").withColumn("r", r).join(room, "passage_id", "left")
    return rows.select("fact_id", "passage_id", (F.col("r") <= F.coalesce("room", F.lit(2))).alias("kept"))


@query("W06, N09: enrolment by turns over strata, in hash order", """
SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY difficulty, language ORDER BY md5(CAST(id AS VARCHAR))) AS r, md5(CAST(id AS VARCHAR)) AS h FROM questions) ORDER BY r, h LIMIT 60""")
def stratified_enrolment(t: Tables) -> DataFrame:
    # A stratum can give at most as many as are wanted: the cut comes with the rank.
    rows = t.questions.select("id", "difficulty", "language", hashed("id").alias("h"))
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("difficulty", "language").orderBy("h"))).filter("r <= 60")
    return ranked.orderBy("r", "h").limit(60).select("id")


@query("W07, W08: an even sample of each refusal code", """
WITH c AS (SELECT count(DISTINCT rejection_code) AS k FROM facts), r AS (SELECT id, rejection_code, row_number() OVER (PARTITION BY rejection_code ORDER BY md5(CAST(id AS VARCHAR))) AS r FROM facts WHERE rejection_code IS NOT NULL)
SELECT id, rejection_code FROM r, c WHERE r <= greatest(1, 40 // k)""")
def even_sample(t: Tables) -> DataFrame:
    rows = t.facts.filter("rejection_code IS NOT NULL").select("id", "rejection_code", hashed("id").alias("h"))
    each = rows.agg(F.greatest(F.lit(1), F.floor(F.lit(40) / F.countDistinct("rejection_code"))).alias("each"))
    r = F.row_number().over(Window.partitionBy("rejection_code").orderBy("h"))
    return rows.withColumn("r", r).filter("r <= 40").crossJoin(each).filter("r <= each").select("id", "rejection_code")  # each is one row


@query("W09: latest time of each file", "SELECT submitted_filename, max(submitted_at) AS latest, count(*) AS n FROM ingest_events GROUP BY 1")
def latest_upload(t: Tables) -> DataFrame:
    return t.ingest_events.groupBy("submitted_filename").agg(F.max("submitted_at").alias("latest"), F.count(F.lit(1)).alias("n"))


@query("W10: kinds of facts by turns within a passage", """
WITH l AS (SELECT DISTINCT fp.passage_id, f.id, f.kind, len(f.units_statement) = 0 AS bare FROM fact_passages fp JOIN facts f ON f.id = fp.fact_id), r AS (SELECT *, row_number() OVER (PARTITION BY passage_id, kind ORDER BY bare, id) AS k FROM l)
SELECT passage_id, id, k AS turn FROM r WHERE k <= 3""")
def kind_turns(t: Tables) -> DataFrame:
    facts = t.facts.select(F.col("id").alias("fact_id"), "kind", (F.size("units_statement") == 0).alias("bare"))
    rows = t.fact_passages.select("fact_id", "passage_id").distinct().join(facts, "fact_id")
    turn = F.row_number().over(Window.partitionBy("passage_id", "kind").orderBy("bare", "fact_id"))
    return rows.withColumn("turn", turn).filter("turn <= 3").select("passage_id", F.col("fact_id").alias("id"), "turn")


@query("W11: passages by turns over documents", "SELECT id, r AS turn FROM (SELECT id, row_number() OVER (PARTITION BY doc_sha256 ORDER BY ordinal) AS r FROM passages) WHERE r <= 2")
def document_turns(t: Tables) -> DataFrame:
    return t.passages.withColumn("turn", F.row_number().over(Window.partitionBy("doc_sha256").orderBy("ordinal"))).filter("turn <= 2").select("id", "turn")


@query("W12, W13, W14, N11: a stride through each document's passages: the places that a share of a quarter picks", """
WITH r AS (SELECT id, row_number() OVER (PARTITION BY doc_sha256 ORDER BY ordinal) - 1 AS i FROM passages) SELECT id FROM r WHERE floor((i + 1) * 0.25) > floor(i * 0.25)""")
def stride_sample(t: Tables) -> DataFrame:
    rows = ranked(t.passages.select("id", "doc_sha256", "ordinal"), "doc_sha256", "ordinal", "r")
    return rows.filter(F.floor(F.col("r") * 0.25) > F.floor((F.col("r") - 1) * 0.25)).select("id")


@query("W15, W16, W18: section label carried forward to passages without one, and the next label after them", """
SELECT id, last_value(section_path IGNORE NULLS) OVER (PARTITION BY doc_sha256 ORDER BY ordinal) AS label, first_value(section_path IGNORE NULLS) OVER (PARTITION BY doc_sha256 ORDER BY ordinal ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM passages""")
def carried_labels(t: Tables) -> DataFrame:
    rows = t.passages.select("id", "doc_sha256", "ordinal", "section_path")
    return carried(carried(rows, "doc_sha256", "ordinal", "section_path", "label"), "doc_sha256", "ordinal", "section_path", "next", ahead=True).select("id", "label", "next")


@query("W17: whether the pages of a document's passages follow without a gap", """
SELECT doc_sha256, max(page_from) - min(page_from) + 1 = count(DISTINCT page_from) AS gapless FROM passages WHERE page_from IS NOT NULL GROUP BY 1""")
def page_contiguity(t: Tables) -> DataFrame:
    return t.passages.filter("page_from IS NOT NULL").groupBy("doc_sha256").agg((F.max("page_from") - F.min("page_from") + 1 == F.countDistinct("page_from")).alias("gapless"))


@query("W19, W23: lines of a document with their number and where they start", """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL), e AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, ls FROM l)
SELECT doc_id, i AS line, length(ls[i]) AS n, CAST(sum(length(ls[i]) + 1) OVER (PARTITION BY doc_id ORDER BY i) - length(ls[i]) - 1 AS BIGINT) AS start FROM e""")
def line_offsets(t: Tables) -> DataFrame:
    # The running sum stays inside the row: no window, so a very long text is one row's work and not a sort.
    ls = F.split("text", "\n")
    ends = F.aggregate(ls, F.array().cast("array<struct<n:int,start:bigint>>"), lambda a, x: F.concat(a, F.array(F.struct(F.length(x).alias("n"), F.coalesce(F.try_element_at(a, F.lit(-1))["start"] + F.try_element_at(a, F.lit(-1))["n"] + 1, F.lit(0)).cast("bigint").alias("start")))))
    return t.documents.filter("text IS NOT NULL").select("doc_id", F.posexplode(ends).alias("p", "x")).select("doc_id", (F.col("p") + 1).alias("line"), "x.n", "x.start")


@query("W20, W21: passages of a document merged up to a budget of characters", None)
def budget_chunks(t: Tables, budget: int = 600) -> DataFrame:
    """(doc_sha256, stretch, id, chunk). Consecutive passages of one document and block type are merged while they fit the budget; a longer one stands alone. A
    lead-in (text that ends with a colon) goes with what follows it. A document of more than STRETCH passages is cut there too, so no group is unbounded."""
    rows = t.passages.filter("text IS NOT NULL").select(
        "doc_sha256", F.floor(F.col("ordinal") / STRETCH).alias("stretch"), "ordinal", "id", F.length("text").alias("n"), F.coalesce("block_type", F.lit("text")).alias("b"), F.endswith(F.rtrim("text"), F.lit(":")).alias("lead")
    )

    def cut(group: list[tuple]):
        chunk, used, block, lead = 0, 0, None, False
        for doc, stretch, _, i, n, b, leads in group:
            if not lead and (b != block or used + n > budget):
                chunk, used = chunk + 1, 0
            used, block, lead = used + n, b, leads
            yield doc, stretch, i, chunk

    return walked(rows, ["doc_sha256", "stretch"], ["ordinal"], cut, "doc_sha256 string, stretch bigint, id bigint, chunk int")


@query("W22: runs of one language through a document, an unknown one staying with the run it follows", """
WITH c AS (SELECT id, doc_sha256, ordinal, last_value(language IGNORE NULLS) OVER (PARTITION BY doc_sha256 ORDER BY ordinal) AS l FROM passages),
g AS (SELECT *, lag(l) OVER (PARTITION BY doc_sha256 ORDER BY ordinal) AS b FROM c) SELECT id, l AS language, CAST(sum(CASE WHEN l IS DISTINCT FROM b THEN 1 ELSE 0 END) OVER (PARTITION BY doc_sha256 ORDER BY ordinal) AS BIGINT) AS run FROM g""")
def language_runs(t: Tables) -> DataFrame:
    rows = carried(t.passages.select("id", "doc_sha256", "ordinal", F.col("language").alias("l")), "doc_sha256", "ordinal", "l", "language")
    # The passage before is found by place, not by a window over the whole document.
    placed = ranked(rows, "doc_sha256", "ordinal", "r")
    before = placed.select("doc_sha256", (F.col("r") + 1).alias("r"), F.col("language").alias("b"), F.lit(True).alias("there"))
    # A run that opens with an unknown language is run 0, as a change needs something to change from.
    change = (~F.col("language").eqNullSafe(F.col("b"))).cast("int")
    marked = placed.join(before, ["doc_sha256", "r"], "left").withColumn("c", change)
    rows, within, over = _stretched(marked, "doc_sha256", "ordinal")
    sums = rows.groupBy("doc_sha256", "_s").agg(F.sum("c").alias("_n"))
    ahead = sums.withColumn("_before", F.sum("_n").over(over) - F.col("_n")).drop("_n")
    return rows.withColumn("_c", F.sum("c").over(within)).join(ahead, ["doc_sha256", "_s"]).select("id", "language", (F.col("_c") + F.col("_before")).alias("run"))


@query("W25: first document each question cites", """
SELECT qf.question_id, min(d.doc_id) AS doc_id FROM question_facts qf JOIN fact_passages fp ON fp.fact_id = qf.fact_id JOIN passages p ON p.id = fp.passage_id JOIN documents d ON d.sha256 = p.doc_sha256 GROUP BY 1""")
def first_cited_document(t: Tables) -> DataFrame:
    passages = t.passages.select(F.col("id").alias("passage_id"), F.col("doc_sha256").alias("sha256"))
    rows = t.question_facts.join(t.fact_passages.select("fact_id", "passage_id").distinct(), "fact_id").join(passages, "passage_id").join(t.documents.select("sha256", "doc_id"), "sha256")
    return rows.groupBy("question_id").agg(F.min("doc_id").alias("doc_id"))


@query("W26, P02: seats of the question types by highest averages", """
WITH w AS (SELECT question_type AS name, CAST(count(*) AS DOUBLE) AS w FROM questions GROUP BY 1), k AS (SELECT name, w / (2 * j + 1) AS k, j FROM w, (SELECT unnest(range(0, 50)) AS j))
SELECT name, count(*) AS seats FROM (SELECT * FROM k ORDER BY k DESC, name, j LIMIT 50) GROUP BY 1""")
def seats_highest_averages(t: Tables) -> DataFrame:
    return highest_averages(t.questions.groupBy("question_type").agg(F.count(F.lit(1)).alias("n")), "question_type", "n", 50)


@query("W27, P08: seats of the question types by largest remainder", """
WITH w AS (SELECT question_type AS name, CAST(count(*) AS DOUBLE) AS w FROM questions GROUP BY 1), x AS (SELECT name, 77 * w / sum(w) OVER () AS x FROM w), f AS (SELECT name, floor(x) AS base, round(x - floor(x), 9) AS rest FROM x),
r AS (SELECT *, row_number() OVER (ORDER BY rest DESC, name) AS r, 77 - sum(base) OVER () AS l FROM f) SELECT name, CAST(base + CASE WHEN r <= l THEN 1 ELSE 0 END AS BIGINT) AS seats FROM r""")
def seats_largest_remainder(t: Tables) -> DataFrame:
    return largest_remainder(t.questions.groupBy("question_type").agg(F.count(F.lit(1)).alias("n")), "question_type", "n", 77)


@query("W28: quotas by systematic rounding of the cumulated shares", """
WITH w AS (SELECT difficulty AS name, count(*) AS w FROM questions WHERE difficulty IS NOT NULL GROUP BY 1), c AS (SELECT name, sum(w) OVER (ORDER BY name) / sum(w) OVER () AS c FROM w)
SELECT name, CAST(floor(100 * c + 0.37) - floor(100 * coalesce(lag(c) OVER (ORDER BY name), 0) + 0.37) AS BIGINT) AS quota FROM c""")
def systematic_quota(t: Tables) -> DataFrame:
    w = t.questions.filter("difficulty IS NOT NULL").groupBy(F.col("difficulty").alias("name")).agg(F.count(F.lit(1)).alias("w"))
    by = Window.partitionBy(F.lit(0)).orderBy("name")  # one row a name
    rows = w.crossJoin(w.agg(F.sum("w").alias("t"))).select("name", (F.sum("w").over(by) / F.col("t")).alias("c"))
    return rows.select("name", (F.floor(100 * F.col("c") + 0.37) - F.floor(100 * F.coalesce(F.lag("c").over(by), F.lit(0.0)) + 0.37)).alias("quota"))


@query("W29: categories dealt to slots in hash order", """
SELECT slot, name FROM (SELECT slot, name, row_number() OVER (PARTITION BY slot ORDER BY md5(concat('7~', name, '~', slot))) AS r FROM (SELECT DISTINCT question_type AS name FROM questions), (SELECT unnest(range(0, 20)) AS slot)) WHERE r = 1""")
def dealt_slots(t: Tables) -> DataFrame:
    names = t.questions.select(F.col("question_type").alias("name")).distinct()
    rows = names.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(19))))
    return first_of(rows, ["slot"], [F.md5(F.concat(F.lit("7~"), F.col("name"), F.lit("~"), F.col("slot").cast("string")))]).select("slot", "name")


@query("W30: closeness floor: a quantile of the cosines between query vectors of one label", """
WITH g AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), s AS (SELECT a.label, greatest(0, least(1, list_cosine_similarity(a.v, b.v))) AS c FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT label, round(quantile_cont(c, 0.9), 6) AS closeness FROM s GROUP BY 1""")
def closeness_floor(t: Tables) -> DataFrame:
    from textloom.functions.columns import cosine

    a = t.embeddings.filter("vec_id % 50 = 0").select("label", F.col("vec_id").alias("x"), F.col("embedding").alias("va"))
    b = t.embeddings.select("label", F.col("vec_id").alias("y"), F.col("embedding").alias("vb"))
    c = F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine("va", "vb")))
    return a.join(b, "label").filter("x <> y").groupBy("label").agg(F.round(F.percentile(c, 0.9), 6).alias("closeness"))


@query("W31, T22: heaviest members of each group", """
SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars * coalesce(parse_confidence, 0) DESC, doc_id) AS r FROM documents) WHERE r <= 3""")
def heaviest_members(t: Tables) -> DataFrame:
    return first_of(t.documents.select("source", "doc_id", (F.col("n_chars") * F.coalesce("parse_confidence", F.lit(0.0))).alias("w")), ["source"], [F.desc("w"), "doc_id"], 3).select("source", "doc_id")


@query("W32, A27: five subsamples without replacement, in hash order, and the mean of each", """
WITH d AS (SELECT unnest(range(0, 5)) AS draw), r AS (SELECT draw, confidence, row_number() OVER (PARTITION BY draw ORDER BY md5(concat(draw, '~', id)), id) AS r FROM d, facts WHERE confidence IS NOT NULL) SELECT draw, round(avg(confidence), 6) AS mean FROM r WHERE r <= 200 GROUP BY 1""")
def subsamples(t: Tables) -> DataFrame:
    rows = t.facts.filter("confidence IS NOT NULL").select("id", "confidence", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("draw"))
    ranked = first_of(rows.withColumn("h", F.md5(F.concat(F.col("draw").cast("string"), F.lit("~"), F.col("id").cast("string")))), ["draw"], ["h", "id"], 200)
    return ranked.groupBy("draw").agg(F.round(F.avg("confidence"), 6).alias("mean"))
