"""Projections, filters and predicates over the domain's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.columns import matching, normalised
from textloom.registry import Tables, query


def narrowed(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Rows whose column equals a value given as text, cast to the column's type; null asks for nothing. A value
    that the type cannot hold raises an error rather than matching nothing."""
    if value is None:
        return df
    kind = df.schema[column].dataType.simpleString()
    if df.sparkSession.range(1).select(F.lit(value).try_cast(kind)).first()[0] is None:
        raise ValueError(f"{value!r} is no {kind}")
    return df.filter(F.col(column) == F.lit(value).cast(kind))


def scoped(df: DataFrame, scopes: dict[str, object]) -> DataFrame:
    """Rows that equal every scope given; a null scope asks for nothing."""
    for name, value in scopes.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def storable(c: str) -> Column:
    return ~F.contains(F.coalesce(F.col(c), F.lit("")), F.lit("\x00"))


def holds() -> Column:
    """A fact holds if it is validated and nothing rejects it; null codes reject nothing."""
    return F.coalesce(F.col("validated"), F.lit(False)) & ~F.col("rejection_code").eqNullSafe(F.lit("not_atomic"))


@query("F01, F04, T01, T02: documents found by a text in title or source, a page of them, newest first", """
SELECT doc_id, title, source, lang FROM documents WHERE contains(lower(title), 'handbook') OR contains(lower(source), 'harbour') ORDER BY added_at DESC NULLS LAST, doc_id LIMIT 25 OFFSET 5""")
def doc_search_page(t: Tables) -> DataFrame:
    rows = t.documents.filter(matching("handbook", "title") | matching("HARBOUR", "source"))
    return rows.orderBy(F.desc_nulls_last("added_at"), "doc_id").offset(5).limit(25).select("doc_id", "title", "source", "lang")


@query("F01: wildcards of the searched text mean themselves", "SELECT id FROM questions WHERE contains(target_answer, '%') OR contains(lower(question_text), '_')")
def literal_wildcards(t: Tables) -> DataFrame:
    return t.questions.filter(matching("%", "target_answer") | matching("_", "question_text")).select("id")


@query("F02: texts that can be stored", "SELECT doc_id FROM documents WHERE NOT contains(coalesce(text, ''), chr(0))")
def storable_documents(t: Tables) -> DataFrame:
    return t.documents.filter(storable("text")).select("doc_id")


@query("F03: passages by block type and text", "SELECT id, doc_sha256, ordinal FROM passages WHERE block_type = 'list' AND contains(lower(text), 'hand')")
def passage_listing(t: Tables) -> DataFrame:
    return scoped(t.passages, {"block_type": "list", "language": None}).filter(matching("hand", "text")).select("id", "doc_sha256", "ordinal")


@query("F05, F25: facts of documents of one source, by method", """
SELECT id, kind, statement, extraction_method FROM facts f WHERE extraction_method = 'deterministic' AND EXISTS (
  SELECT 1 FROM fact_passages fp JOIN passages p ON p.id = fp.passage_id JOIN documents d ON d.sha256 = p.doc_sha256 WHERE fp.fact_id = f.id AND d.source = 'harbour-office')""")
def fact_listing(t: Tables) -> DataFrame:
    inside = t.documents.filter("source = 'harbour-office'").select(F.col("sha256").alias("doc_sha256"))
    passages = t.passages.join(inside, "doc_sha256", "left_semi").select(F.col("id").alias("passage_id"))
    cited = t.fact_passages.join(passages, "passage_id", "left_semi").select(F.col("fact_id").alias("id"))
    return t.facts.filter("extraction_method = 'deterministic'").join(cited, "id", "left_semi").select("id", "kind", "statement", "extraction_method")


@query("F06, F08: questions by scopes given as text", "SELECT id FROM questions WHERE difficulty = 'hard' AND answerable AND language = 'de' AND thread_position = 1")
def question_scopes(t: Tables) -> DataFrame:
    rows = scoped(t.questions, {"difficulty": "hard", "question_type": None, "language": "de"})
    return narrowed(narrowed(rows, "answerable", "true"), "thread_position", "1").select("id")


@query("F09: facts that hold, by a null-safe test", "SELECT id FROM facts WHERE validated AND rejection_code IS DISTINCT FROM 'not_atomic'")
def facts_that_hold(t: Tables) -> DataFrame:
    return t.facts.filter(holds()).select("id")


@query("F10: passages that assert something", """
SELECT id FROM passages p WHERE EXISTS (SELECT 1 FROM fact_passages fp JOIN facts f ON f.id = fp.fact_id WHERE fp.passage_id = p.id AND f.validated)""")
def passages_asserting(t: Tables) -> DataFrame:
    facts = t.facts.filter("validated").select(F.col("id").alias("fact_id"))
    cited = t.fact_passages.join(facts, "fact_id", "left_semi").select(F.col("passage_id").alias("id"))
    return t.passages.join(cited, "id", "left_semi").select("id")


@query("F11, S13: passages with a fact, of languages that have any; else all of the language", """
WITH b AS (SELECT id, language, EXISTS (SELECT 1 FROM fact_passages fp WHERE fp.passage_id = p.id) AS bearing FROM passages p WHERE language IS NOT NULL)
SELECT id, language FROM b WHERE bearing OR language NOT IN (SELECT language FROM b WHERE bearing)""")
def bearing_passages(t: Tables) -> DataFrame:
    cited = t.fact_passages.select(F.col("passage_id").alias("id")).distinct().withColumn("bearing", F.lit(True))
    rows = t.passages.filter("language IS NOT NULL").select("id", "language").join(cited, "id", "left").withColumn("bearing", F.coalesce("bearing", F.lit(False)))
    some = rows.groupBy("language").agg(F.bool_or("bearing").alias("some"))
    return rows.join(some, "language").filter("bearing OR NOT some").select("id", "language")


@query("F12: facts not yet asked about", """
SELECT id FROM facts f WHERE validated AND NOT EXISTS (SELECT 1 FROM question_facts qf JOIN questions q ON q.id = qf.question_id WHERE qf.fact_id = f.id AND q.status = 'accepted')""")
def facts_not_asked(t: Tables) -> DataFrame:
    accepted = t.questions.filter("status = 'accepted'").select(F.col("id").alias("question_id"))
    asked = t.question_facts.join(accepted, "question_id", "left_semi").select(F.col("fact_id").alias("id"))
    return t.facts.filter("validated").join(asked, "id", "left_anti").select("id")


@query("F13, F14: rows told apart by null columns", "SELECT id, page_from IS NOT NULL AS placed, block_type IS NULL AND language IS NULL AS unread FROM passages")
def discriminators(t: Tables) -> DataFrame:
    return t.passages.select("id", F.col("page_from").isNotNull().alias("placed"), (F.col("block_type").isNull() & F.col("language").isNull()).alias("unread"))


@query("F15, F16: verdict derived by case", """
SELECT id, CASE WHEN rejected_reason IS NOT NULL THEN 'refused' WHEN confidence IS NULL THEN 'unmeasured' WHEN confidence >= 0.8 THEN 'sure' ELSE 'unsure' END AS verdict FROM questions WHERE status <> 'draft'""")
def derived_verdict(t: Tables) -> DataFrame:
    verdict = F.when(F.col("rejected_reason").isNotNull(), "refused").when(F.col("confidence").isNull(), "unmeasured").when(F.col("confidence") >= 0.8, "sure").otherwise("unsure")
    return t.questions.filter("status <> 'draft'").select("id", verdict.alias("verdict"))


@query("F07, F17: approval only where enough was measured", """
SELECT f.id, CASE WHEN count(fp.passage_id) < 2 THEN NULL ELSE f.validated END AS approved, count(fp.passage_id) AS measured FROM facts f LEFT JOIN (SELECT DISTINCT fact_id, passage_id FROM fact_passages) fp ON fp.fact_id = f.id
GROUP BY f.id, f.validated""")
def thin_verdict(t: Tables) -> DataFrame:
    counts = t.fact_passages.select("fact_id", "passage_id").distinct().groupBy(F.col("fact_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    return t.facts.join(counts, "id", "left").select("id", F.when(n >= 2, F.col("validated")).alias("approved"), n.alias("measured"))


SKIP = """CASE WHEN trim(coalesce(text, '')) = '' THEN 'empty' WHEN lower(trim(text)) = lower(trim(coalesce(section_path, ''))) THEN 'heading'
 WHEN n_cells >= 6 AND codes * 2 > n_cells THEN 'code_grid' WHEN n_words >= 1 AND digit_words > 0.4 * n_words THEN 'references' WHEN NOT regexp_matches(text, '[.!?]') THEN 'no_claims' END"""


@query("F18, F19, F20, F21: why a passage is skipped, the first reason that holds", f"""
WITH w AS (SELECT id, text, section_path, list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS ws,
  list_filter(list_transform(string_split_regex(coalesce(text, ''), '[|\\n]'), lambda x: trim(x)), lambda x: x <> '') AS cells FROM passages),
c AS (SELECT id, text, section_path, len(ws) AS n_words, len(list_filter(ws, lambda x: regexp_matches(x, '[0-9]'))) AS digit_words, len(cells) AS n_cells,
  len(list_filter(cells, lambda x: regexp_matches(x, '^[0-9]+$|[A-Z]{{2}}-[0-9]+$'))) AS codes FROM w)
SELECT id, {SKIP} AS reason FROM c""")
def passage_skips(t: Tables) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    ws = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    cells = F.filter(F.transform(F.split(text, r"[|\n]"), lambda x: F.trim(x)), lambda x: x != "")
    rows = t.passages.select("id", text.alias("text"), F.coalesce("section_path", F.lit("")).alias("path"), ws.alias("ws"), cells.alias("cells"))
    codes, digits = F.size(F.filter("cells", lambda x: x.rlike(r"^[0-9]+$|[A-Z]{2}-[0-9]+$"))), F.size(F.filter("ws", lambda x: x.rlike("[0-9]")))
    reason = (
        F.when(F.trim("text") == "", "empty")
        .when(F.lower(F.trim("text")) == F.lower(F.trim("path")), "heading")
        .when((F.size("cells") >= 6) & (codes * 2 > F.size("cells")), "code_grid")
        .when((F.size("ws") >= 1) & (digits > 0.4 * F.size("ws")), "references")
        .when(~F.col("text").rlike("[.!?]"), "no_claims")
    )
    return rows.select("id", reason.alias("reason"))


@query("F22: facts that quote with an elision or within quotation marks", "SELECT id FROM facts WHERE regexp_matches(statement, '…|\\.\\.\\.|^[„“\"»]')")
def quoting_facts(t: Tables) -> DataFrame:
    return t.facts.filter(F.col("statement").rlike('…|\\.\\.\\.|^[„“"»]')).select("id")


@query("F23: share of capitalised word pairs, a stand-in for named parties", None)
def party_density(t: Tables) -> DataFrame:
    pairs = F.size(F.regexp_extract_all("statement", F.lit(r"\p{Lu}\p{Ll}+[- ]\p{Lu}\p{Ll}+"), F.lit(0)))
    alpha = F.size(F.regexp_extract_all("statement", F.lit(r"\p{L}+"), F.lit(0)))
    return t.facts.filter("statement IS NOT NULL").select("id", F.round(pairs / F.nullif(alpha, F.lit(0)), 6).alias("density"))


@query("F24, J01, S15: questions with what they rest on, aggregated over the outer joins", """
SELECT q.id, q.status, count(DISTINCT qf.fact_id) AS facts, count(DISTINCT fp.passage_id) AS passages, count(DISTINCT p.doc_sha256) AS documents, min(p.page_from) AS first_page, max(f.confidence) AS best
FROM questions q LEFT JOIN question_facts qf ON qf.question_id = q.id LEFT JOIN facts f ON f.id = qf.fact_id LEFT JOIN fact_passages fp ON fp.fact_id = f.id LEFT JOIN passages p ON p.id = fp.passage_id GROUP BY q.id, q.status""")
def question_listing(t: Tables) -> DataFrame:
    facts = t.facts.select(F.col("id").alias("fact_id"), F.col("confidence").alias("c"))
    passages = t.passages.select(F.col("id").alias("passage_id"), "doc_sha256", "page_from")
    links = t.fact_passages.select("fact_id", "passage_id").distinct()  # repeated links only widen the join
    rows = t.question_facts.distinct().join(facts, "fact_id", "left").join(links, "fact_id", "left").join(passages, "passage_id", "left")
    per = rows.groupBy(F.col("question_id").alias("id")).agg(
        F.countDistinct("fact_id").alias("facts"), F.countDistinct("passage_id").alias("passages"), F.countDistinct("doc_sha256").alias("documents"), F.min("page_from").alias("first_page"), F.max("c").alias("best")
    )
    return t.questions.select("id", "status").join(per, "id", "left").fillna(0, ["facts", "passages", "documents"])


@query("F26: label of one key out of stored categories", """
SELECT id, list_extract(list_filter(list_transform(categories, lambda x: lower(trim(x))), lambda x: starts_with(x, 'season=')), 1) AS season FROM (SELECT DISTINCT * FROM release_pool)""")
def category_label(t: Tables) -> DataFrame:
    cleaned = F.transform("categories", lambda x: F.lower(F.trim(x)))
    return t.release_pool.distinct().select("id", F.try_element_at(F.filter(cleaned, lambda x: F.startswith(x, F.lit("season="))), F.lit(1)).alias("season"))


@query("F27, S17: labels cut to length, lists as text", """
SELECT id, CASE WHEN length(s) > 60 THEN concat(substring(s, 1, 60), '…') ELSE s END AS label, array_to_string(units, '; ') AS units FROM (
SELECT id, trim(regexp_replace(statement, '\\s+', ' ', 'g')) AS s, units_statement AS units FROM facts)""")
def fact_labels(t: Tables) -> DataFrame:
    rows = t.facts.select("id", F.trim(F.regexp_replace("statement", r"\s+", " ")).alias("s"), "units_statement")
    return rows.select("id", F.when(F.length("s") > 60, F.concat(F.substring("s", 1, 60), F.lit("…"))).otherwise(F.col("s")).alias("label"), F.array_join("units_statement", "; ").alias("units"))


@query("F28, F29, X09: section path to its headings and back", """
SELECT id, string_split(section_path, '.') AS trail, list_extract(string_split(section_path, '.'), 1) AS chapter, array_to_string(string_split(section_path, '.'), ' > ') AS shown FROM passages WHERE section_path IS NOT NULL""")
def section_trails(t: Tables) -> DataFrame:
    trail = F.split("section_path", r"\.")
    return t.passages.filter("section_path IS NOT NULL").select("id", trail.alias("trail"), trail[0].alias("chapter"), F.array_join(trail, " > ").alias("shown"))


@query("X01, X10: normalised text and its key without spaces", """
SELECT id, replace(lower(trim(regexp_replace(statement, '\\s+', ' ', 'g'))), 'ß', 'ss') AS normal, lower(regexp_replace(statement, '\\s', '', 'g')) AS bare FROM facts""")
def normalised_statements(t: Tables) -> DataFrame:
    return t.facts.select("id", normalised("statement").alias("normal"), F.lower(F.regexp_replace("statement", r"\s", "")).alias("bare"))
