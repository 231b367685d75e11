"""Numbers, digests, arrays, JSON, vectors and times as column expressions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.columns import cosine, words
from textloom.functions.text import W, literals, sql_list
from textloom.registry import Tables, query


def canonical(run: Column, language: Column) -> Column:
    """A run of digits, points and commas as a plain decimal string: in German (and where the language is unknown) points group three digits and a comma is
    decimal, in English the other way; a point or comma that can only be decimal is so in any language. Leading zeros of the whole part and closing zeros
    of the fraction go. Null for a run that is no number (a date, a version)."""

    def read(group: str, decimal: str) -> Column:
        g, d = ("[.]" if group == "." else ","), ("[.]" if decimal == "." else ",")
        plain = F.replace(F.replace(run, F.lit(group), F.lit("")), F.lit(decimal), F.lit("."))
        return F.when(run.rlike(rf"^\d{{1,3}}({g}\d{{3}})+({d}\d+)?$"), plain).when(run.rlike(rf"^\d+({d}\d+)?$"), F.replace(run, F.lit(decimal), F.lit("."))).when(run.rlike(rf"^\d+{g}\d+$"), F.replace(run, F.lit(group), F.lit(".")))

    value = F.when(language == "en", read(",", ".")).otherwise(read(".", ","))
    whole = F.regexp_replace(value, r"^0+(\d)", "$1")
    return F.when(F.contains(whole, F.lit(".")), F.regexp_replace(whole, r"[.]?0*$", "")).otherwise(whole)


def figures(text: Column, language: Column) -> Column:
    """Figures of a text in order, as canonical strings."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\d+(?:[.,]\d+)*"), F.lit(0))
    return F.filter(F.transform(found, lambda x: canonical(x, language)), lambda x: x.isNotNull())


def _canonical_sql(x: str, language: str) -> str:
    def read(group: str, decimal: str) -> str:
        g, d = ("[.]" if group == "." else ","), ("[.]" if decimal == "." else ",")
        return (
            f"CASE WHEN regexp_matches({x}, '^[0-9]{{1,3}}({g}[0-9]{{3}})+({d}[0-9]+)?$') THEN replace(replace({x}, '{group}', ''), '{decimal}', '.') "
            f"WHEN regexp_matches({x}, '^[0-9]+({d}[0-9]+)?$') THEN replace({x}, '{decimal}', '.') WHEN regexp_matches({x}, '^[0-9]+{g}[0-9]+$') THEN replace({x}, '{group}', '.') END"
        )

    value = f"CASE WHEN {language} = 'en' THEN {read(',', '.')} ELSE {read('.', ',')} END"
    whole = f"regexp_replace({value}, '^0+([0-9])', '\\1')"
    return f"CASE WHEN contains({whole}, '.') THEN regexp_replace({whole}, '[.]?0*$', '') ELSE {whole} END"


_FIGURES = "list_filter(list_transform(regexp_extract_all(coalesce({0}, ''), '[0-9]+(?:[.,][0-9]+)*'), lambda x: " + _canonical_sql("x", "{1}") .replace("{1,3}", "{{1,3}}").replace("{3}", "{{3}}") + "), lambda x: x IS NOT NULL)"


@query("N01, N02: figures of a text under its language's separators, as canonical strings, and their sum", f"""
WITH k AS (SELECT id, {_FIGURES.format('text', 'lower(language)')} AS figures FROM passages)
SELECT id, figures, round(coalesce(list_sum(list_transform(figures, lambda x: CAST(x AS DOUBLE))), 0), 4) AS total FROM k""")
def statement_figures(t: Tables) -> DataFrame:
    rows = t.passages.select("id", figures(F.col("text"), F.lower("language")).alias("figures"))
    return rows.withColumn("total", F.round(F.aggregate(F.transform("figures", lambda x: x.cast("double")), F.lit(0.0), lambda s, x: s + x), 4))


def spelled() -> dict[str, int]:
    """Cardinal and ordinal words below a hundred in English and German with their numbers, made by rule from the words below twenty and the tens."""
    # Number words from which the others are built.
    en = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
    tens_en = "twenty thirty forty fifty sixty seventy eighty ninety".split()
    de = "null eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn".split()
    tens_de = "zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig".split()
    odd_en = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}
    odd_de = {"eins": "erst", "drei": "dritt", "sieben": "siebt", "acht": "acht"}
    out = {}

    def ordinal_en(w: str) -> str:
        return odd_en.get(w, w[:-1] + "ieth" if w.endswith("y") else w + "th")

    for n in range(100):
        ten, one = divmod(n, 10)
        if n < 20:
            words_en, words_de = (en[n], ordinal_en(en[n])), (de[n], odd_de.get(de[n], de[n] + "t"))
        elif one == 0:
            words_en, words_de = (tens_en[ten - 2], ordinal_en(tens_en[ten - 2])), (tens_de[ten - 2], tens_de[ten - 2] + "st")
        else:
            unit = "ein" if one == 1 else de[one]
            words_en, words_de = (f"{tens_en[ten - 2]}-{en[one]}", f"{tens_en[ten - 2]}-{ordinal_en(en[one])}"), (f"{unit}und{tens_de[ten - 2]}", f"{unit}und{tens_de[ten - 2]}st")
        for w in (*words_en, words_de[0], *(words_de[1] + e for e in ("e", "er", "en", "es", "em"))):
            out.setdefault(w, n)
    return out


@query("N03: cardinal and ordinal words of a text as digits, in order", f"""
WITH n(word, number) AS (VALUES {', '.join(f"('{w}', {n})" for w, n in spelled().items())}),
w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}]+(?:-[\\p{{L}}]+)*')) AS word, generate_subscripts(regexp_extract_all(lower(text), '[\\p{{L}}]+(?:-[\\p{{L}}]+)*'), 1) AS i FROM documents WHERE text IS NOT NULL)
SELECT doc_id, list(number ORDER BY i) AS digits FROM w JOIN n USING (word) GROUP BY 1""")
def number_words(t: Tables) -> DataFrame:
    table = t.spark.createDataFrame(list(spelled().items()), "word string, number int")  # a few hundred rows, by rule
    found = t.documents.filter("text IS NOT NULL").select("doc_id", F.posexplode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+(?:-[\p{L}]+)*"), F.lit(0))).alias("i", "word"))
    rows = found.join(F.broadcast(table), "word").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("i", "number"))).alias("o"))
    return rows.select("doc_id", F.transform("o", lambda e: e["number"]).alias("digits"))


def adds_up(values: list[float], answer: float, terms: int = 4, figures: int = 40) -> bool:
    """Whether two to ``terms`` of the first ``figures`` values total ``answer``: every sum of one or two of them meets what is left of the answer in the
    sums of others, so four terms cost the square of the figures and not their fourth power."""
    v = [round(x, 6) for x in values[:figures]]
    single = [(x, (i,)) for i, x in enumerate(v)]
    double = [(round(x + y, 6), (i, j)) for i, x in enumerate(v) for j, y in enumerate(v[:i])]
    by_sum: dict[float, list[tuple[int, ...]]] = {}
    for s, at in double + (single if terms >= 3 else []):
        by_sum.setdefault(s, []).append(at)
    answer = round(answer, 6)
    if terms >= 2 and any(s == answer for s, _ in double):
        return True
    for s, at in (double if terms >= 4 else single if terms == 3 else []):
        for other in by_sum.get(round(answer - s, 6), ()):
            if not set(at) & set(other) and len(at) + len(other) <= terms:
                return True
    return False


_TERMS = """
WITH e AS (SELECT f.id, unnest(list_slice(regexp_extract_all(evidence_text, '[0-9]+'), 1, 40)) AS x, generate_subscripts(list_slice(regexp_extract_all(evidence_text, '[0-9]+'), 1, 40), 1) AS i FROM facts f),
v AS (SELECT id, i, CAST(x AS DOUBLE) AS v FROM e), a AS (SELECT id, CAST(regexp_extract(statement, '[0-9]+') AS DOUBLE) AS t FROM facts WHERE regexp_matches(statement, '[0-9]')),
d AS (SELECT p.id, p.i AS i, q.i AS j, p.v + q.v AS s FROM v p JOIN v q ON p.id = q.id AND p.i < q.i)
"""


@query("N04: facts whose first number is the total of two to four of the first forty figures of their evidence", _TERMS + """
SELECT DISTINCT a.id FROM a JOIN d ON d.id = a.id AND d.s = a.t UNION
SELECT DISTINCT a.id FROM a JOIN d ON d.id = a.id JOIN v ON v.id = a.id AND v.i NOT IN (d.i, d.j) AND d.s + v.v = a.t UNION
SELECT DISTINCT a.id FROM a JOIN d ON d.id = a.id JOIN d e ON e.id = a.id AND e.i NOT IN (d.i, d.j) AND e.j NOT IN (d.i, d.j) AND d.s + e.s = a.t""")
def sums_of_figures(t: Tables) -> DataFrame:
    held = lambda c: F.transform(F.regexp_extract_all(c, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("double"))
    rows = t.facts.filter(F.col("statement").rlike(r"\d")).select("id", F.get(held("statement"), F.lit(0)).alias("answer"), F.slice(held("evidence_text"), 1, 40).alias("v")).filter(F.size("v") > 1)

    def check(batches):
        for b in batches:
            ok = [adds_up(v, a) for v, a in zip(b.column("v").to_pylist(), b.column("answer").to_pylist())]
            yield b.select(["id"]).filter(pa.array(ok, pa.bool_()))

    return rows.mapInArrow(check, "id bigint")


@query("N11: the slack of a tolerance for each source's documents: a part of their number, one at least", "SELECT source, CAST(greatest(1, floor(0.05 * count(*))) AS BIGINT) AS slack FROM documents GROUP BY 1")
def tolerance_slack(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(F.greatest(F.lit(1), F.floor(0.05 * F.count(F.lit(1)))).alias("slack"))


@query("N05, N06, P19: difficulty of a question from what it rests on", """
WITH c AS (SELECT q.id, count(DISTINCT fp.passage_id) AS p, count(DISTINCT p.doc_sha256) AS d FROM questions q LEFT JOIN question_facts qf ON qf.question_id = q.id LEFT JOIN fact_passages fp ON fp.fact_id = qf.fact_id LEFT JOIN passages p ON p.id = fp.passage_id GROUP BY 1),
s AS (SELECT q.id, (p > 1)::INT + (d > 1)::INT + (length(coalesce(target_answer, '')) >= 60)::INT + (follows_id IS NOT NULL)::INT AS points FROM questions q JOIN c USING (id)) SELECT id, points, CASE WHEN points >= 3 THEN 'hard' WHEN points >= 2 THEN 'medium' ELSE 'easy' END AS band FROM s""")
def difficulty_bands(t: Tables) -> DataFrame:
    passages = t.passages.select(F.col("id").alias("passage_id"), "doc_sha256")
    c = t.question_facts.distinct().join(t.fact_passages.select("fact_id", "passage_id").distinct(), "fact_id").join(passages, "passage_id", "left").groupBy(F.col("question_id").alias("id")).agg(F.countDistinct("passage_id").alias("p"), F.countDistinct("doc_sha256").alias("d"))
    rows = t.questions.select("id", "target_answer", "follows_id").join(c, "id", "left").fillna(0, ["p", "d"])
    one = lambda x: x.cast("int")
    points = one(F.col("p") > 1) + one(F.col("d") > 1) + one(F.length(F.coalesce("target_answer", F.lit(""))) >= 60) + one(F.col("follows_id").isNotNull())
    return rows.select("id", points.alias("points")).withColumn("band", F.when(F.col("points") >= 3, "hard").when(F.col("points") >= 2, "medium").otherwise("easy"))


@query("N07: cosine of neighbouring vectors", """
SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def neighbour_cosines(t: Tables) -> DataFrame:
    b = t.embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return t.embeddings.select("vec_id", F.col("embedding").alias("a")).join(b, "vec_id").select("vec_id", F.round(cosine("a", "b"), 6).alias("cosine"))


@query("N10, S06, S07, S08: digests of parts and the folder a digest lies in", """
SELECT doc_id, md5(concat_ws('~', CAST(doc_id AS VARCHAR), source, lower(coalesce(lang, '')))) AS digest, concat_ws('/', substring(sha256, 1, 2), substring(sha256, 3, 2), sha256) AS key FROM documents""")
def digests(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(F.concat_ws("~", F.col("doc_id").cast("string"), "source", F.lower(F.coalesce("lang", F.lit(""))))).alias("digest"), F.concat_ws("/", F.substring("sha256", 1, 2), F.substring("sha256", 3, 2), "sha256").alias("key"))


@query("N12, N13, N14: readings as JSON and back", """SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k, CAST(props ->> '$.k' AS INTEGER) BETWEEN 0 AND 49 AS small FROM events""")
def json_readings(t: Tables) -> DataFrame:
    packed = t.events.select("event_id", F.to_json(F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"))).alias("j"))
    k = F.from_json("j", "k int")["k"]
    return packed.select("event_id", k.alias("k"), k.between(0, 49).alias("small"))


@query("N17, N19, Q04: rows older than a lease, beside a fixed now", "SELECT id FROM ingest_events WHERE submitted_at < TIMESTAMPTZ '2031-03-01 00:00:00+00' - INTERVAL 5 MINUTE AND outcome <> 'stored'")
def expired_leases(t: Tables) -> DataFrame:
    return t.ingest_events.filter((F.col("submitted_at") < F.lit("2031-03-01 00:00:00").cast("timestamp") - F.expr("INTERVAL 5 MINUTES")) & (F.col("outcome") != "stored")).select("id")


@query("N18, N20: events by minute, shown in ISO form", "SELECT strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S') AS minute, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1")
def minute_history(t: Tables) -> DataFrame:
    return t.events.filter("event_type = 'error'").groupBy(F.date_format(F.date_trunc("minute", "ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("minute")).agg(F.count(F.lit(1)).alias("n"))


STOPS = {"de": "der die das und ist nicht mit von zu wird".split(), "en": "the of and is to in for with that be".split(), "fr": "le la les et est des une du pour dans".split()}


@query("N21, N22: language of a text by its common words, links left out; null below a lead of two", f"""
WITH k AS (SELECT doc_id, {W.format("regexp_replace(text, 'https?://[^ ]+|www[.][^ ]+', ' ', 'g')")} AS w FROM documents), s AS (SELECT doc_id, {', '.join(f"len(list_filter(w, lambda x: list_contains({sql_list(v)}, x))) AS {k}" for k, v in STOPS.items())} FROM k)
SELECT doc_id, CASE WHEN de >= en + 2 AND de >= fr + 2 THEN 'de' WHEN en >= de + 2 AND en >= fr + 2 THEN 'en' WHEN fr >= de + 2 AND fr >= en + 2 THEN 'fr' END AS language FROM s""")
def detected_language(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", words(F.regexp_replace("text", r"https?://[^ ]+|www[.][^ ]+", " ")).alias("w"))
    known = {k: literals(v) for k, v in STOPS.items()}
    rows = rows.select("doc_id", *[F.size(F.filter("w", lambda x: F.array_contains(known[k], x))).alias(k) for k in STOPS])  # noqa: B023
    lead = lambda a, b, c: (F.col(a) >= F.col(b) + 2) & (F.col(a) >= F.col(c) + 2)
    return rows.select("doc_id", F.when(lead("de", "en", "fr"), "de").when(lead("en", "de", "fr"), "en").when(lead("fr", "de", "en"), "fr").alias("language"))


@query("N23: verdict from scores by label", "SELECT id, CASE WHEN confidence IS NULL THEN 'abstain' WHEN confidence >= 0.9 THEN 'entailed' WHEN confidence < 0.6 THEN 'contradicted' ELSE 'neutral' END AS verdict FROM facts")
def entailment_verdict(t: Tables) -> DataFrame:
    scores = F.create_map(F.lit("entailed"), F.col("confidence"), F.lit("contradicted"), 1 - F.col("confidence"))
    e, c = scores["entailed"], scores["contradicted"]
    return t.facts.select("id", F.when(e.isNull(), "abstain").when(e >= 0.9, "entailed").when(c > 0.4, "contradicted").otherwise("neutral").alias("verdict"))


@query("N25, D22: totals of measured calls with their mean", "SELECT event_type, count(*) AS calls, round(sum(value), 4) AS total, round(sum(value) / count(*), 6) AS mean FROM events GROUP BY 1")
def call_totals(t: Tables) -> DataFrame:
    n = F.count(F.lit(1))
    return t.events.groupBy("event_type").agg(n.alias("calls"), F.round(F.sum("value"), 4).alias("total"), F.round(F.sum("value") / n, 6).alias("mean"))

