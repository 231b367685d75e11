"""Models behind small protocols, with deterministic stand-ins that need neither network nor weights.

A protocol is a function from a table to a table; a served model is put in its place by passing another function with the same columns. The stand-ins are
lexical and say so.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.columns import numbers, share, share_of, words
from textloom.functions.text import CONTENT, content, sentences
from textloom.operators.groups import walked
from textloom.operators.windows import first_of
from textloom.registry import Tables, query
from textloom.session import checkpointed


class Step(Protocol):
    """Anything that makes a table of a table."""

    def __call__(self, rows: DataFrame) -> DataFrame: ...


def chained(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Stages one after the other as one plan: Catalyst sees the whole chain."""

    def run(rows: DataFrame) -> DataFrame:
        for step in steps:
            rows = step(rows)
        return rows

    return run


def served(call: Callable[[str], str], retries: int = 3, wait: float = 0.5) -> Callable[[str], str]:
    """A call with retries and doubling waits; the last failure is raised."""

    def run(prompt: str) -> str:
        for k in range(retries + 1):
            try:
                return call(prompt)
            except Exception:
                if k == retries:
                    raise
                time.sleep(wait * 2**k)
        raise AssertionError

    return run


def embedded(rows: DataFrame, text: str, width: int = 64) -> DataFrame:
    """Stand-in embedder: a bag of words with signs, each word at the place its digest names, of unit length; a text without words has the zero vector."""
    keyed = checkpointed(rows.withColumn("_row", F.monotonically_increasing_id()))
    each = keyed.select("_row", F.explode(words(text)).alias("w")).withColumn("h", F.md5("w"))
    place, sign = F.conv(F.substring("h", 1, 8), 16, 10).cast("bigint") % width, F.when(F.conv(F.substring("h", 9, 1), 16, 10).cast("int") < 8, 1.0).otherwise(-1.0)
    sums = each.groupBy("_row", place.cast("int").alias("at")).agg(F.sum(sign).alias("x")).filter("x <> 0")
    held = sums.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("at", "x"))).alias("m"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("l"))  # at most ``width`` places
    vector = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.try_element_at("m", i) / F.col("l"), F.lit(0.0)))
    return keyed.join(held, "_row", "left").withColumn("vector", vector).drop("_row", "m", "l")


def entailed(premise: Column | str, hypothesis: Column | str, floor: float = 0.8) -> tuple[Column, Column]:
    """Stand-in entailment: (score, label). The score is the share of the hypothesis' content words that the premise has; a hypothesis with a number that
    the premise lacks contradicts it where the words are about the same, and one without content words abstains."""
    score = share_of(content(hypothesis), content(premise))
    strange = F.size(F.array_except(numbers(hypothesis), numbers(premise))) > 0
    return score, F.when(score.isNull(), "abstain").when(strange & (score >= 0.5), "contradiction").when(~strange & (score >= floor), "entailment").otherwise("neutral")


#: Of the format in which a fitted model is dumped; another one is refused when it is read.
MODEL_FORMAT = 1


def dumped(model: DataFrame, path: str) -> None:
    """A fitted model (name, at, value) in long form, one row a weight, with its format beside it."""
    model.select("name", "at", "value").write.mode("overwrite").parquet(f"{path}/weights")
    model.sparkSession.createDataFrame([(MODEL_FORMAT,)], "format int").coalesce(1).write.mode("overwrite").json(f"{path}/format")


def loaded(spark, path: str) -> DataFrame:
    """What ``dumped`` wrote; raises for another format."""
    row = spark.read.schema("format int").json(f"{path}/format").first()
    if row is None or row["format"] != MODEL_FORMAT:
        raise ValueError(f"model format {row and row['format']}, not {MODEL_FORMAT}")
    return spark.read.schema("name string, at int, value double").parquet(f"{path}/weights")


def claims(rows: DataFrame, text: str) -> DataFrame:
    """Stand-in extractor: each sentence with a number or a name is a claim; ``kind`` is atomic."""
    return rows.withColumn("claim", F.explode(sentences(text))).filter(F.col("claim").rlike(r"\d|[^.!?] \p{Lu}")).withColumn("kind", F.lit("atomic"))


def digests(rows: DataFrame, text: str) -> DataFrame:
    """Stand-in digest: the first sentence."""
    return rows.withColumn("claim", F.try_element_at(sentences(text), F.lit(1))).withColumn("kind", F.lit("summary"))


def written_questions(facts: DataFrame, statement: str) -> DataFrame:
    """Stand-in writer: asks which number a statement names, with the number as the answer."""
    number = F.regexp_extract(statement, r"(\d+)", 1)
    return facts.filter(number != "").withColumn("question", F.concat(F.lit("Which number completes: "), F.regexp_replace(statement, r"\d+", "…"), F.lit("?"))).withColumn("answer", number)


def settled(question: Column | str, answer: Column | str, passage: Column | str, floor: float = 0.5) -> Column:
    """Stand-in verifier: the passage has enough of the answer's content words; null, which abstains, for an answer without any."""
    held = share_of(content(answer), content(passage))
    return F.when(held.isNull(), F.lit(None)).otherwise(held >= floor)


def judged(rows: DataFrame, text: str) -> DataFrame:
    """Stand-in judge: (label, score) of a text by its length in words."""
    n = F.size(words(text))
    return rows.withColumn("score", F.round(F.least(F.lit(1.0), n / 20), 6)).withColumn("label", F.when(n >= 8, "clear").otherwise("thin"))


def best_span(starts: list[float], ends: list[float], longest: int = 40) -> tuple[int, int] | None:
    """The (start, end) of highest summed score with the end not before the start and at most ``longest`` places long; None of empty scores."""
    if not starts:
        return None
    s, e = np.asarray(starts), np.asarray(ends)
    total = s[:, None] + e[None, :]
    gap = np.arange(len(e))[None, :] - np.arange(len(s))[:, None]
    total[(gap < 0) | (gap >= longest)] = -np.inf
    return tuple(int(x) for x in np.unravel_index(int(total.argmax()), total.shape))


def covered_area(boxes: Iterable[tuple[float, float, float, float]]) -> float:
    """Area of the union of rectangles (x0, y0, x1, y1), by a sweep over x; degenerate ones cover nothing."""
    boxes = [b for b in boxes if b[2] > b[0] and b[3] > b[1]]
    xs, area = sorted({x for b in boxes for x in (b[0], b[2])}), 0.0
    for a, b in zip(xs, xs[1:]):
        reach, height = float("-inf"), 0.0
        for y0, y1 in sorted((r[1], r[3]) for r in boxes if r[0] <= a and r[2] >= b):
            if y1 > reach:
                height += y1 - max(y0, reach)
                reach = y1
        area += (b - a) * height
    return area


@query("X17: figures, words and references of each passage", """
SELECT id, len(regexp_extract_all(text, '[0-9]+')) AS figures, len(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS words, regexp_matches(text, '(?:section|Abschnitt) [0-9]+') AS refers FROM passages""")
def claim_readings(t: Tables) -> DataFrame:
    return t.passages.select("id", F.size(F.regexp_extract_all("text", F.lit(r"\d+"), F.lit(0))).alias("figures"), F.size(words("text")).alias("words"), F.col("text").rlike("(?:section|Abschnitt) [0-9]+").alias("refers"))


@query("G06, G07: claims and digests that the stand-ins extract from text passages", None)
def extracted_claims(t: Tables) -> DataFrame:
    rows = t.passages.select("id", "text")
    return claims(rows, "text").unionByName(digests(rows, "text")).select("id", "kind", "claim")


@query("G05: statements embedded by the stand-in, one row a place of the vector that is not zero", """
WITH w AS (SELECT id, unnest(regexp_extract_all(lower(coalesce(statement, '')), '[\\p{L}\\p{N}]+')) AS w FROM facts),
p AS (SELECT id, CAST(concat('0x', md5(w)[1:8]) AS BIGINT) % 64 AS at, sum(CASE WHEN CAST(concat('0x', md5(w)[9:9]) AS INTEGER) < 8 THEN 1.0 ELSE -1.0 END) AS x FROM w GROUP BY 1, 2), l AS (SELECT id, sqrt(sum(x * x)) AS l FROM p GROUP BY 1)
SELECT id, "at", round(x / l, 6) AS value FROM p JOIN l USING (id) WHERE x <> 0""")
def embedded_statements(t: Tables) -> DataFrame:
    rows = embedded(t.facts.select("id", "statement"), "statement").select("id", F.posexplode("vector").alias("at", "value"))
    return rows.filter("value <> 0").select("id", F.col("at").cast("bigint").alias("at"), F.round("value", 6).alias("value"))


@query("G08: bridges that the stand-in finds between passages of different documents: the rarest term both have, and the claim that says so", """
WITH v AS (SELECT DISTINCT id, language, lower(trim(x)) AS term FROM (SELECT id, language, unnest(lemmas) AS x FROM passage_vocabulary WHERE language IS NOT NULL) WHERE trim(x) <> ''), n AS (SELECT language, count(DISTINCT id) AS n FROM v GROUP BY 1),
d AS (SELECT language, term, count(*) AS df FROM v GROUP BY 1, 2), r AS (SELECT language, term, df FROM d JOIN n USING (language) WHERE df BETWEEN 2 AND greatest(2, ceil(0.005 * n))),
c AS (SELECT v.id, v.term, v.language, r.df, p.doc_sha256 FROM v JOIN r USING (language, term) JOIN passages p USING (id)),
k AS (SELECT a.id AS a, b.id AS b, a.term, a.df FROM c a JOIN c b ON a.language = b.language AND a.term = b.term AND a.id < b.id AND a.doc_sha256 <> b.doc_sha256)
SELECT a, b, arg_min(term, (df, term)) AS term, concat('Both passages speak of ', arg_min(term, (df, term)), '.') AS claim FROM k GROUP BY 1, 2""")
def bridges(t: Tables) -> DataFrame:
    words_ = t.passage_vocabulary.filter("language IS NOT NULL").select("id", "language", F.explode("lemmas").alias("x"))
    v = words_.select("id", "language", F.lower(F.trim("x")).alias("term")).filter("term <> ''").distinct()
    n = v.groupBy("language").agg(F.countDistinct("id").alias("n"))
    d = v.groupBy("language", "term").agg(F.count(F.lit(1)).alias("df")).join(n, "language")
    rare = d.filter((F.col("df") >= 2) & (F.col("df") <= F.greatest(F.lit(2), F.ceil(0.005 * F.col("n"))))).select("language", "term", "df")
    c = v.join(rare, ["language", "term"]).join(t.passages.select("id", "doc_sha256"), "id")
    one = c.select("language", "term", "df", F.col("id").alias("a"), F.col("doc_sha256").alias("da"))
    two = c.select("language", "term", F.col("id").alias("b"), F.col("doc_sha256").alias("db"))
    k = one.join(two, ["language", "term"]).filter("a < b AND da <> db").groupBy("a", "b").agg(F.min(F.struct("df", "term")).alias("m"))
    return k.select("a", "b", F.col("m.term").alias("term"), F.concat(F.lit("Both passages speak of "), F.col("m.term"), F.lit(".")).alias("claim"))


@query("G15: whether a fact's evidence entails its statement, by the stand-in", f"""
WITH k AS (SELECT id, {CONTENT.format('statement')} AS h, {CONTENT.format('evidence_text')} AS p, regexp_extract_all(coalesce(statement, ''), '[0-9]+') AS n, regexp_extract_all(coalesce(evidence_text, ''), '[0-9]+') AS m FROM facts),
s AS (SELECT id, len(list_intersect(h, p)) / nullif(len(h), 0) AS s, len(list_filter(n, lambda x: NOT list_contains(m, x))) > 0 AS strange FROM k)
SELECT id, round(s, 6) AS score, CASE WHEN s IS NULL THEN 'abstain' WHEN strange AND s >= 0.5 THEN 'contradiction' WHEN NOT strange AND s >= 0.8 THEN 'entailment' ELSE 'neutral' END AS label FROM s""")
def entailment_labels(t: Tables) -> DataFrame:
    score, label = entailed("evidence_text", "statement")
    return t.facts.select("id", F.round(score, 6).alias("score"), label.alias("label"))


@query("S21, S22: centroids of labels dumped in long form with their format, and loaded again", """
SELECT CAST(label AS VARCHAR) AS name, CAST(i - 1 AS INTEGER) AS at, round(avg(CAST(v AS DOUBLE)), 6) AS value FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2""")
def model_loaded(t: Tables) -> DataFrame:
    import uuid

    from textloom.session import removed_at_exit, shared_folder

    fitted = t.embeddings.select(F.col("label").cast("string").alias("name"), F.posexplode("embedding").alias("at", "v")).groupBy("name", "at").agg(F.avg(F.col("v").cast("double")).alias("value"))
    path = removed_at_exit(t.spark, f"{shared_folder(t.spark)}/textloom/{uuid.uuid4().hex}")
    dumped(fitted, path)
    return loaded(t.spark, path).select("name", "at", F.round("value", 6).alias("value"))


@query("G10, G11: questions that the stand-in writes of facts, and whether their evidence settles them", """
SELECT id, concat('Which number completes: ', regexp_replace(statement, '[0-9]+', '…', 'g'), '?') AS question, regexp_extract(statement, '([0-9]+)', 1) AS answer, contains(coalesce(evidence_text, ''), regexp_extract(statement, '([0-9]+)', 1)) AS settled FROM facts WHERE regexp_matches(statement, '[0-9]')""")
def drafted_questions(t: Tables) -> DataFrame:
    rows = written_questions(t.facts.select("id", "statement", "evidence_text"), "statement")
    return rows.select("id", "question", "answer", F.contains(F.coalesce("evidence_text", F.lit("")), F.col("answer")).alias("settled"))


@query("G13, G14: labels and scores of the stand-in judge by question type", """
WITH k AS (SELECT question_type, len(regexp_extract_all(lower(question_text), '[\\p{L}\\p{N}]+')) AS n FROM questions) SELECT question_type, count(*) FILTER (n >= 8) AS clear, round(avg(round(least(1.0, n / 20), 6)), 6) AS mean FROM k GROUP BY 1""")
def judged_questions(t: Tables) -> DataFrame:
    rows = judged(t.questions.select("question_type", "question_text"), "question_text")
    return rows.groupBy("question_type").agg(F.count_if(F.col("label") == "clear").alias("clear"), F.round(F.avg("score"), 6).alias("mean"))


@query("G17: recall and precision of a reading against labels, beside the majority's", """
WITH k AS (SELECT validated AS y, coalesce(confidence, 0) >= 0.7 AS p FROM facts) SELECT round(count(*) FILTER (y AND p) / nullif(count(*) FILTER (y), 0), 6) AS recall, round(count(*) FILTER (y AND p) / nullif(count(*) FILTER (p), 0), 6) AS precision, round(greatest(avg(y::INT), 1 - avg(y::INT)), 6) AS majority FROM k""")
def reading_quality(t: Tables) -> DataFrame:
    rows = t.facts.select(F.col("validated").alias("y"), (F.coalesce("confidence", F.lit(0.0)) >= 0.7).alias("p"))
    hit, mean = F.count_if(F.col("y") & F.col("p")), F.avg(F.col("y").cast("int"))
    return rows.agg(share(hit, F.count_if("y")).alias("recall"), share(hit, F.count_if("p")).alias("precision"), F.round(F.greatest(mean, 1 - mean), 6).alias("majority"))


@query("G04, X55: topics named by their three heaviest terms", """
WITH s AS (SELECT string_split(section_path, '.')[1] AS chapter, id FROM passages WHERE section_path IS NOT NULL), v AS (SELECT s.chapter, lower(trim(x)) AS term FROM (SELECT id, unnest(lemmas) AS x FROM (SELECT DISTINCT id, language, lemmas FROM passage_vocabulary)) JOIN s USING (id) WHERE trim(x) <> ''),
n AS (SELECT chapter, term, count(*) AS n FROM v GROUP BY 1, 2) SELECT chapter, string_agg(term, ', ' ORDER BY r) AS name FROM (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY n DESC, term) AS r FROM n) WHERE r <= 3 GROUP BY 1""")
def topic_names(t: Tables) -> DataFrame:
    s = t.passages.filter("section_path IS NOT NULL").select("id", F.substring_index("section_path", ".", 1).alias("chapter"))
    x = t.passage_vocabulary.select("id", "language", "lemmas").distinct().join(s, "id").select("chapter", F.explode("lemmas").alias("x"))
    n = x.select("chapter", F.lower(F.trim("x")).alias("term")).filter("term <> ''").groupBy("chapter", "term").agg(F.count(F.lit(1)).alias("n"))
    top = first_of(n, ["chapter"], [F.desc("n"), "term"], 3)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "term")))  # three terms a chapter
    return top.groupBy("chapter").agg(ordered.alias("o")).select("chapter", F.array_join(F.transform("o", lambda x: x["term"]), ", ").alias("name"))


@query("N24: best span of two score lists", None)
def best_spans(t: Tables) -> DataFrame:
    """Scores stand in: the two halves of a vector as starts and ends."""
    spec = "vec_id bigint, first int, last int"

    def decode(batches):
        for b in batches:
            spans = [best_span(list(v[:32]), list(v[32:])) for v in b["embedding"]]
            yield pd.DataFrame({"vec_id": b["vec_id"], "first": pd.Series([s[0] for s in spans], dtype="int32"), "last": pd.Series([s[1] for s in spans], dtype="int32")})

    return t.embeddings.select("vec_id", "embedding").mapInPandas(decode, spec)


@query("U09, S12: area of a page that boxes cover", None)
def covered_pages(t: Tables) -> DataFrame:
    """Boxes stand in: a line item's quantity and discount span a rectangle of its order's page."""
    boxes = t.lineitem.select("l_orderkey", (F.col("l_discount") * 100).alias("x0"), (F.col("l_tax") * 100).alias("y0"), (F.col("l_discount") * 100 + 5).alias("x1"), (F.col("l_tax") * 100 + F.col("l_quantity") / 10).alias("y1"))

    pages = boxes.groupBy("l_orderkey").agg(*[F.collect_list(c).alias(c) for c in ("x0", "y0", "x1", "y1")])

    def area(batches):
        for b in batches:
            yield pd.DataFrame({"l_orderkey": b["l_orderkey"], "area": [covered_area(zip(*r)) for r in zip(b["x0"], b["y0"], b["x1"], b["y1"])]})

    return pages.mapInPandas(area, "l_orderkey bigint, area double")


def strongest(rows: list[tuple]) -> list[tuple]:
    """(a, b, n) of one pair of blocks: for each section of either the one of the other block that shares most terms, ties to the lower id. Rows are
    (doc, i, j, block, id, terms) in order of block and id; a pair of a block with itself has its rows once."""
    left = [(r[4], r[5]) for r in rows if r[3] == rows[0][1]]
    right = left if rows[0][1] == rows[0][2] else [(r[4], r[5]) for r in rows if r[3] == rows[0][2]]
    if not right:
        return []
    held: dict[str, list[int]] = {}
    for k, (_, terms) in enumerate(right):
        for x in terms:
            held.setdefault(x, []).append(k)
    postings = {x: np.asarray(v) for x, v in held.items()}
    most, of, out = np.zeros(len(right), dtype=np.int64), np.zeros(len(right), dtype=np.int64), []
    for k, (a, terms) in enumerate(left):
        own = [postings[x] for x in terms if x in postings]
        if not own:
            continue
        n = np.bincount(np.concatenate(own), minlength=len(right))
        if right is left:
            n[k] = 0
        else:
            more = n > most
            most[more], of[more] = n[more], a
        at = int(n.argmax())
        if n[at]:
            out.append((a, right[at][0], int(n[at])))
    return out + [(right[k][0], int(of[k]), int(most[k])) for k in np.flatnonzero(most)]


@query("J24 (extra): best partner of each section of a document by all shared terms, each pair taken once, and the pair grown by its second's best", None)
def section_partners(t: Tables, block: int = 4000) -> DataFrame:
    """(a, b, third): every section is compared with every other of its document. A document is cut into blocks of about ``block`` sections and every pair
    of blocks meets in a task, so the groups are bounded and no pair is lost; the work is quadratic in a document's sections. Best partners that
    name each other share one count, so taking pairs once in order of (count, a) keeps the one with the lower a: a join says it."""
    s = t.passages.filter("section_path IS NOT NULL").select("id", "doc_sha256")
    x = t.passage_vocabulary.select("id", F.explode("lemmas").alias("x")).select("id", F.lower(F.trim("x")).alias("term")).filter("term <> ''")
    w = s.join(x.groupBy("id").agg(F.collect_set("term").alias("w")), "id")
    blocks = s.groupBy("doc_sha256").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("of"), F.count(F.lit(1)).alias("sections")).filter("sections > 1").drop("sections")
    w = w.join(blocks, "doc_sha256").withColumn("own", F.pmod(F.xxhash64("id"), F.col("of")).cast("int"))
    w = w.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    met = w.select("doc_sha256", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "w")
    found = walked(met, ["doc_sha256", "i", "j"], ["own", "id"], strongest, "a bigint, b bigint, n bigint")
    best = checkpointed(found.groupBy("a").agg(F.max(F.struct("n", (-F.col("b")).alias("b"))).alias("m")).select("a", (-F.col("m.b")).alias("b")))
    seconds = best.select(F.col("a").alias("b"), F.col("b").alias("third"))
    pairs = best.join(seconds, "b").filter("third <> a OR a < b")
    return pairs.select("a", "b", F.when(F.col("third") == F.col("a"), F.lit(-1)).otherwise(F.col("third")).cast("bigint").alias("third"))


@query("S23: two coordinates of each label's centroid, from the distances between centroids", None)
def label_layout(t: Tables) -> DataFrame:
    """Labels are few: at most 500 centroids are taken to the driver."""
    rows = t.embeddings.select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("x")).groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("c")).orderBy("label").limit(500).collect()
    m = np.array([r["c"] for r in rows]).reshape(len(rows), -1)
    d = ((m[:, None, :] - m[None, :, :]) ** 2).sum(axis=2)
    j = np.eye(len(m)) - 1 / max(1, len(m))
    values, vectors = np.linalg.eigh(-0.5 * j @ d @ j)
    at = np.argsort(-values)[:2]
    xy = vectors[:, at] * np.sqrt(np.maximum(values[at], 0))
    return t.spark.createDataFrame([(r["label"], *(float(x) for x in p)) for r, p in zip(rows, xy)], "label int, x double, y double")


@query("S27: log records as one JSON object a line", "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'error'")
def log_lines(t: Tables) -> DataFrame:
    lines = t.events.filter("event_type = 'error'").select(F.to_json(F.struct("event_id", "user_id", "event_type")).alias("line"))
    return lines.select(F.from_json("line", "event_id bigint, user_id bigint, event_type string").alias("r")).select("r.*")


@query("Q11: stages chained into one plan", "SELECT count(*) AS n FROM facts WHERE validated AND kind = 'atomic'")
def chained_stages(t: Tables) -> DataFrame:
    return chained(lambda d: d.filter("validated"), lambda d: d.filter("kind = 'atomic'"), lambda d: d.agg(F.count(F.lit(1)).alias("n")))(t.facts)


@query("G11: share of facts whose evidence settles them by the stand-in", None)
def settled_facts(t: Tables) -> DataFrame:
    return t.facts.groupBy("kind").agg(share(F.count_if(settled("statement", "statement", "evidence_text")), F.count(F.lit(1))).alias("settled"))
