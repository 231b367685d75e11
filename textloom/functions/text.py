"""Text readings as column expressions: repair, tokens, sentences, overlaps, checks of claims and questions, tables, references.

Readings that need a grammar are lexical stand-ins here and say so; an annotator may supply the columns instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.columns import col, jaccard, normalised, numbers, share_of, words
from textloom.registry import Tables, query

W = "regexp_extract_all(lower(coalesce({}, '')), '[\\p{{L}}\\p{{N}}]+')"
# Words that ask.
INTERROGATIVES = "wer was wann wo warum wie welche welches welcher worin wieviel who what when where why how which whose qui que quand où pourquoi comment quel quelle".split()
# Common short words, left out of content words.
STOP = ("als auch auf bei das dem den der des die ein eine einem einen einer für im in ist man mit muss nach nicht oder sich und von vor wenn werden wird zu zum zur " "a after an and are as at be before by can does every for from has have how if in is it may must no not of on one or someone that the this to when which who with").split()
# Openings and the kind of question they mostly begin.
OPENINGS = [("why", "reason"), ("warum", "reason"), ("how", "procedure"), ("wie", "procedure"), ("what", "entity"), ("was", "entity"), ("who", "entity"), ("wer", "entity"), ("when", "temporal"), ("wann", "temporal"), ("seit", "temporal"), ("since", "temporal")]
LANGUAGES = {"de": "German", "en": "English", "fr": "French"}


def sql_list(items) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


def literals(items) -> Column:
    return F.array(*[F.lit(x) for x in items])


def content(c: Column | str) -> Column:
    """Distinct words that are no stop words: the stand-in for content lemmas."""
    return F.array_except(F.array_distinct(words(c)), literals(STOP))


def folded(c: Column | str) -> Column:
    """Curly quotes and dashes as plain ones."""
    return F.translate(col(c), "„“”»«‚‘’–—", "\"\"\"\"\"'''--")


def sentences(c: Column | str) -> Column:
    """Sentences of a text: cut after a full stop, question or exclamation mark that a capital or digit follows, unless a digit stands before
    the mark (dates and ordinals)."""
    return F.filter(F.split(F.trim(F.regexp_replace(col(c), r"\s+", " ")), r"(?<=[^\d][.!?]) (?=[\p{Lu}\d])"), lambda x: x != "")


CONTENT = "list_filter(list_distinct(" + W + "), lambda x: NOT list_contains(" + sql_list(STOP) + ", x))"


@query("X02, X54: quotes folded, and the quoted spans of a text", r"""
SELECT id, regexp_extract_all(regexp_replace(statement, '[„“”»«]', chr(34), 'g'), concat(chr(34), '([^', chr(34), ']+)', chr(34)), 1) AS quoted FROM facts WHERE regexp_matches(statement, '[„“]')""")
def quoted_spans(t: Tables) -> DataFrame:
    return t.facts.filter(F.col("statement").rlike("[„“]")).select("id", F.regexp_extract_all(folded("statement"), F.lit('"([^"]+)"'), F.lit(1)).alias("quoted"))


@query("X03, X04: passages that hold a fact's quoted pieces, each as whole words, and the longest piece", r"""
WITH f AS (SELECT id, list_filter(list_transform(string_split_regex(lower(regexp_replace(evidence_text, '\s+', ' ', 'g')), '…|\.\.\.|(?:[.!?] )'), lambda x: trim(rtrim(trim(x), '.!?'))), lambda x: len(x) >= 20) AS pieces FROM facts WHERE evidence_text IS NOT NULL),
p AS (SELECT id, concat(' ', trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), '\s+', ' ', 'g')), ' ') AS t FROM passages WHERE text IS NOT NULL),
k AS (SELECT DISTINCT fp.fact_id AS id, fp.passage_id, f.pieces, p.t FROM fact_passages fp JOIN f ON f.id = fp.fact_id JOIN p ON p.id = fp.passage_id WHERE len(f.pieces) > 0),
h AS (SELECT id, passage_id, len(pieces) AS pieces, len(list_filter(pieces, lambda x: contains(t, concat(' ', trim(regexp_replace(x, '[^\p{L}\p{N}]+', ' ', 'g')), ' ')))) AS held FROM k)
SELECT id, list_sort(list(passage_id) FILTER (held = pieces)) AS whole, max(held) AS most, max(pieces) AS pieces FROM h GROUP BY 1""")
def holding_passages(t: Tables) -> DataFrame:
    """(id, whole, most, pieces): the passages a fact rests on that hold every sentence of its evidence (of twenty characters and more, between ellipses and
    full stops) as whole words, and how many the best one holds; null where none holds all."""
    parts = F.split(F.lower(F.regexp_replace("evidence_text", r"\s+", " ")), r"…|\.\.\.|(?:[.!?] )")
    pieces = F.filter(F.transform(parts, lambda x: F.trim(F.rtrim(F.trim(x), F.lit(".!?")))), lambda x: F.length(x) >= 20)
    spaced = lambda c: F.concat(F.lit(" "), F.trim(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    facts = t.facts.filter("evidence_text IS NOT NULL").select(F.col("id").alias("fact_id"), pieces.alias("pieces")).filter(F.size("pieces") > 0)
    passages = t.passages.filter("text IS NOT NULL").select(F.col("id").alias("passage_id"), spaced(F.lower("text")).alias("t"))
    rows = t.fact_passages.select("fact_id", "passage_id").distinct().join(facts, "fact_id").join(passages, "passage_id")
    held = rows.select("fact_id", "passage_id", F.size("pieces").alias("n"), F.size(F.filter("pieces", lambda x: F.contains(F.col("t"), spaced(x)))).alias("held"))
    whole = F.collect_list(F.when(F.col("held") == F.col("n"), F.col("passage_id")))
    found = held.groupBy(F.col("fact_id").alias("id")).agg(whole.alias("w"), F.max("held").alias("most"), F.max("n").alias("pieces"))
    return found.select("id", F.when(F.size("w") > 0, F.array_sort("w")).alias("whole"), "most", "pieces")


@query("X08: words hyphenated at a line end rejoined, soft hyphens and control signs removed", """
SELECT id, regexp_replace(regexp_replace(text, '[\\x{00AD}\\x{200B}\\x{0080}-\\x{009F}]', '', 'g'), '([a-zäöüß])- ?\\n\\s*([a-zäöüß])', '\\1\\2', 'g') AS text FROM passages WHERE contains(text, '-') OR contains(text, chr(173))""")
def rejoined_lines(t: Tables) -> DataFrame:
    clean = F.regexp_replace("text", "[\u00ad\u200b\u0080-\u009f]", "")
    return t.passages.filter(F.contains("text", F.lit("-")) | F.contains("text", F.lit("\u00ad"))).select("id", F.regexp_replace(clean, r"([a-zäöüß])- ?\n\s*([a-zäöüß])", "$1$2").alias("text"))


@query("X05, X06: words that the line end parts, rejoined unless the collection prints them with their hyphen", r"""
WITH l AS (SELECT unnest(regexp_extract_all(text, '[\p{L}]+- ?\n\s*[\p{L}]+')) AS x FROM passages), b AS (SELECT lower(regexp_extract(x, '^([\p{L}]+)-', 1)) AS l, lower(regexp_extract(x, '([\p{L}]+)$', 1)) AS r FROM l),
w AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[\p{L}]+-[\p{L}]+'))) AS whole FROM passages)
SELECT concat(l, '-', r) AS parted, whole IS NOT NULL AS printed, CASE WHEN whole IS NULL THEN concat(l, r) ELSE whole END AS word, count(*) AS n FROM b LEFT JOIN w ON whole = concat(l, '-', r) GROUP BY ALL""")
def parted_words(t: Tables) -> DataFrame:
    x = t.passages.select(F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}]+- ?\n\s*[\p{L}]+"), F.lit(0))).alias("x"))
    b = x.select(F.lower(F.regexp_extract("x", r"^([\p{L}]+)-", 1)).alias("l"), F.lower(F.regexp_extract("x", r"([\p{L}]+)$", 1)).alias("r")).groupBy("l", "r").agg(F.count(F.lit(1)).alias("n"))
    whole = t.passages.select(F.explode(F.regexp_extract_all("text", F.lit(r"[\p{L}]+-[\p{L}]+"), F.lit(0))).alias("w")).select(F.lower("w").alias("parted")).distinct().withColumn("printed", F.lit(True))
    rows = b.withColumn("parted", F.concat_ws("-", "l", "r")).join(whole, "parted", "left")
    return rows.select("parted", F.coalesce("printed", F.lit(False)).alias("printed"), F.when(F.col("printed"), F.col("parted")).otherwise(F.concat("l", "r")).alias("word"), "n")


@query("X09, X10: lines cut into fields at bars or gaps, and each field's key without spaces", r"""
WITH l AS (SELECT id, unnest(string_split(text, chr(10))) AS line FROM passages) , f AS (SELECT id, line, list_filter(list_transform(string_split_regex(line, '\s*[|·•]\s*|\s{2,}|\t'), lambda x: trim(x)), lambda x: x <> '') AS fields FROM l)
SELECT id, line, fields, list_transform(fields, lambda x: regexp_replace(lower(x), '\s+', '', 'g')) AS keys FROM f WHERE len(fields) > 1""")
def line_fields(t: Tables) -> DataFrame:
    line = t.passages.select("id", F.explode(F.split("text", "\n")).alias("line"))
    fields = F.filter(F.transform(F.split("line", r"\s*[|·•]\s*|\s{2,}|\t"), lambda x: F.trim(x)), lambda x: x != "")
    return line.withColumn("fields", fields).filter(F.size("fields") > 1).withColumn("keys", F.transform("fields", lambda x: F.regexp_replace(F.lower(x), r"\s+", "")))


@query("X15, X16, M11: vocabulary of a passage: its lemmas and the forms it prints, links left out, written back where the stored lemmas differ", f"""
WITH v AS (SELECT id, list_sort(list_distinct(flatten(list(list_filter(list_transform(coalesce(lemmas, []), lambda x: lower(trim(x))), lambda x: x IS NOT NULL AND x <> ''))))) AS lemmas FROM passage_vocabulary GROUP BY id),
p AS (SELECT id, list_sort(list_filter(list_distinct({W.format("regexp_replace(text, 'https?://[^ ]+|www[.][^ ]+', ' ', 'g')")}), lambda x: NOT list_contains({sql_list(STOP)}, x))) AS forms FROM passages)
SELECT p.id, coalesce(v.lemmas, []) AS lemmas, p.forms, coalesce(v.lemmas, []) <> p.forms AS written FROM p LEFT JOIN v USING (id)""")
def vocabulary_forms(t: Tables) -> DataFrame:
    """(id, lemmas, forms, written). A stand-in for a grammar: the forms printed, without stop words and links, are what a new reading writes back; ``written``
    says whether the row changes."""
    clean = F.filter(F.transform(F.coalesce("lemmas", F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & (x != ""))
    v = t.passage_vocabulary.select("id", F.explode(clean).alias("x")).groupBy("id").agg(F.array_sort(F.collect_set("x")).alias("lemmas"))
    forms = F.array_sort(content(F.regexp_replace("text", r"https?://[^ ]+|www[.][^ ]+", " ")))
    rows = t.passages.select("id", forms.alias("forms")).join(v, "id", "left").withColumn("lemmas", F.coalesce("lemmas", F.array().cast("array<string>")))
    return rows.select("id", "lemmas", "forms", (F.col("lemmas") != F.col("forms")).alias("written"))


@query("X07, X53: titles that end on a stop word, and languages by name", f"""
SELECT doc_id, list_contains({sql_list(STOP)}, {W.format('title')}[-1]) AS open_end, CASE lower(lang) WHEN 'de' THEN 'German' WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' ELSE lower(lang) END AS language FROM documents WHERE title IS NOT NULL""")
def title_ends(t: Tables) -> DataFrame:
    names = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    code = F.lower("lang")
    return t.documents.filter("title IS NOT NULL").select("doc_id", F.array_contains(literals(STOP), F.try_element_at(words("title"), F.lit(-1))).alias("open_end"), F.coalesce(F.try_element_at(names, code), code).alias("language"))


@query("X11, X12: lines repeated over a document's passages, their numbers masked", """
WITH l AS (SELECT id, doc_sha256, trim(unnest(string_split(text, chr(10)))) AS line FROM passages WHERE doc_sha256 IS NOT NULL), k AS (SELECT DISTINCT id, doc_sha256, regexp_replace(line, '[0-9]+', '#', 'g') AS shape FROM l WHERE length(line) BETWEEN 1 AND 80)
SELECT doc_sha256, shape, count(*) AS passages FROM k GROUP BY 1, 2 HAVING count(*) >= 3""")
def repeated_lines(t: Tables) -> DataFrame:
    line = t.passages.filter("doc_sha256 IS NOT NULL").select("id", "doc_sha256", F.explode(F.split("text", "\n")).alias("l")).select("id", "doc_sha256", F.trim("l").alias("l")).filter(F.length("l").between(1, 80))
    k = line.select("id", "doc_sha256", F.regexp_replace("l", "[0-9]+", "#").alias("shape")).distinct()
    return k.groupBy("doc_sha256", "shape").agg(F.count(F.lit(1)).alias("passages")).filter("passages >= 3")


@query("X13: the longest run of consecutive first letters of the titles of a source, in order of letter", """
WITH d AS (SELECT DISTINCT source, ascii(upper(title[1])) AS a FROM documents WHERE regexp_matches(title, '^[A-Za-z]')), g AS (SELECT source, a, a - row_number() OVER (PARTITION BY source ORDER BY a) AS island FROM d)
SELECT source, max(n) AS longest FROM (SELECT source, island, count(*) AS n FROM g GROUP BY 1, 2) GROUP BY 1""")
def letter_runs(t: Tables) -> DataFrame:
    d = t.documents.filter(F.col("title").rlike("^[A-Za-z]")).select("source", F.ascii(F.upper(F.substring("title", 1, 1))).alias("a")).distinct()
    g = d.withColumn("island", F.col("a") - F.row_number().over(Window.partitionBy("source").orderBy("a")))
    return g.groupBy("source", "island").agg(F.count(F.lit(1)).alias("n")).groupBy("source").agg(F.max("n").alias("longest"))


@query("X14, X43: sentences and list items of a passage", """
SELECT id, len(regexp_extract_all(trim(regexp_replace(text, '\\s+', ' ', 'g')), '[^0-9][.!?] [\\p{Lu}0-9]')) + 1 AS sentences, len(list_filter(string_split(text, chr(10)), lambda x: starts_with(x, '- '))) AS items FROM passages WHERE block_type = 'list' OR text NOT LIKE '%' || chr(10) || '%'""")
def sentence_counts(t: Tables) -> DataFrame:
    items = F.size(F.filter(F.split("text", "\n"), lambda x: F.startswith(x, F.lit("- "))))
    return t.passages.filter("block_type = 'list' OR NOT contains(text, '\n')").select("id", F.size(sentences("text")).alias("sentences"), items.alias("items"))


@query("X15, X25, X26: questions whose content words and numbers another question has too", f"""
WITH k AS (SELECT id, list_sort({CONTENT.format('question_text')}) AS c FROM questions) SELECT array_to_string(c, ' ') AS content, count(*) AS n, min(id) AS first_id FROM k WHERE len(c) > 0 GROUP BY 1 HAVING count(*) > 1""")
def same_content(t: Tables) -> DataFrame:
    rows = t.questions.select("id", F.array_join(F.array_sort(content("question_text")), " ").alias("content")).filter("content <> ''")
    return rows.groupBy("content").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id")).filter("n > 1")


@query("X18: units of a statement that its evidence does not have", """
SELECT id, list_filter(list_distinct(units_statement), lambda x: NOT list_contains(regexp_extract_all(coalesce(evidence_text, ''), '[0-9]+'), x)) AS added FROM facts WHERE len(list_filter(list_distinct(units_statement), lambda x: NOT list_contains(regexp_extract_all(coalesce(evidence_text, ''), '[0-9]+'), x))) > 0""")
def units_added(t: Tables) -> DataFrame:
    return t.facts.select("id", F.array_except("units_statement", numbers("evidence_text")).alias("added")).filter(F.size("added") > 0)


@query("X19, X20, X21, X22: share of a question's content that its answer and its facts have; null abstains", f"""
WITH f AS (SELECT question_id, string_agg(statement, ' ' ORDER BY f.id) AS s FROM (SELECT DISTINCT * FROM question_facts) qf JOIN facts f ON f.id = qf.fact_id GROUP BY 1),
k AS (SELECT q.id, {CONTENT.format('question_text')} AS c, {CONTENT.format('s')} AS e FROM questions q LEFT JOIN f ON f.question_id = q.id)
SELECT id, round(len(list_intersect(c, e)) / nullif(len(c), 0), 6) AS held, coalesce(len(list_intersect(c, e)) / nullif(len(c), 0) < 0.2, false) AS off_topic FROM k""")
def held_share(t: Tables) -> DataFrame:
    facts = t.facts.select(F.col("id").alias("fact_id"), "statement")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("fact_id", "statement"))), lambda x: x["statement"]), " ")
    f = t.question_facts.distinct().join(facts, "fact_id").groupBy(F.col("question_id").alias("id")).agg(joined.alias("s"))
    rows = t.questions.select("id", content("question_text").alias("c")).join(f, "id", "left")
    held = share_of(F.col("c"), content("s"))
    return rows.select("id", F.round(held, 6).alias("held"), F.coalesce(held < 0.2, F.lit(False)).alias("off_topic"))


@query("X23, X24: overlap of neighbouring passages' words", """
WITH v AS (SELECT id, list_distinct(list_filter(list_transform(lemmas, lambda x: lower(trim(x))), lambda x: x <> '')) AS w FROM (SELECT DISTINCT id, lemmas FROM passage_vocabulary WHERE lemmas IS NOT NULL)), p AS (SELECT p.id, p.doc_sha256, p.ordinal, w FROM passages p JOIN v USING (id))
SELECT a.id, b.id AS next, round(len(list_intersect(a.w, b.w)) / nullif(len(list_distinct(list_concat(a.w, b.w))), 0), 6) AS overlap FROM p a JOIN p b ON a.doc_sha256 = b.doc_sha256 AND b.ordinal = a.ordinal + 1""")
def passage_overlap(t: Tables) -> DataFrame:
    v = t.passage_vocabulary.filter("lemmas IS NOT NULL").select("id", "lemmas").distinct().select("id", F.array_distinct(F.filter(F.transform("lemmas", lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & (x != ""))).alias("w"))
    p = t.passages.select("id", "doc_sha256", "ordinal").join(v, "id")
    b = p.select("doc_sha256", (F.col("ordinal") - 1).alias("ordinal"), F.col("id").alias("next"), F.col("w").alias("wb"))
    return p.join(b, ["doc_sha256", "ordinal"]).select("id", "next", F.round(jaccard(F.col("w"), F.col("wb")), 6).alias("overlap"))


@query("X27, X28, X32: what a question asks by, and the type its opening gives", f"""
SELECT id, list_sort(list_distinct(list_filter({W.format('question_text')}, lambda x: list_contains({sql_list(INTERROGATIVES)}, x)))) AS asks,
 CASE {W.format('question_text')}[1] {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in OPENINGS)} END AS opening FROM questions""")
def question_openings(t: Tables) -> DataFrame:
    w = words("question_text")
    first, opening = F.try_element_at(w, F.lit(1)), F.lit(None).cast("string")
    for a, b in OPENINGS:
        opening = F.when(first == a, b).otherwise(opening)
    return t.questions.select("id", F.array_sort(F.array_distinct(F.filter(w, lambda x: F.array_contains(literals(INTERROGATIVES), x)))).alias("asks"), opening.alias("opening"))


@query("X29, X30, X31, X50: first structural failure of a question, and the first form its answer fits", f"""
WITH k AS (SELECT id, question_text AS q, trim(coalesce(target_answer, '')) AS a, len({W.format('question_text')}) AS n, len({W.format('target_answer')}) AS m FROM questions)
SELECT id, CASE WHEN q NOT LIKE '%?' THEN 'malformed' WHEN n < 4 THEN 'short' WHEN n > 20 THEN 'long' WHEN length(q) - length(replace(q, '?', '')) > 1 THEN 'compound' END AS failure,
 CASE WHEN m = 0 THEN NULL WHEN contains(a, ';') OR contains(a, chr(10)) THEN 'list' WHEN m <= 6 THEN 'value' ELSE 'explanation' END AS fits FROM k""")
def structural_gate(t: Tables) -> DataFrame:
    q, a, n, m = F.col("question_text"), F.trim(F.coalesce("target_answer", F.lit(""))), F.size(words("question_text")), F.size(words("target_answer"))
    failure = F.when(~F.endswith(q, F.lit("?")), "malformed").when(n < 4, "short").when(n > 20, "long").when(F.length(q) - F.length(F.replace(q, F.lit("?"), F.lit(""))) > 1, "compound")
    fits = F.when(m == 0, F.lit(None)).when(F.contains(a, F.lit(";")) | F.contains(a, F.lit("\n")), "list").when(m <= 6, "value").otherwise("explanation")
    return t.questions.select("id", failure.alias("failure"), fits.alias("fits"))


@query("X33: statements that name their source instead of the matter", "SELECT id FROM facts WHERE regexp_matches(lower(statement), '^(laut|according to|says|gemäß|as stated)|says the|laut aushang')")
def source_attribution(t: Tables) -> DataFrame:
    return t.facts.filter(F.lower("statement").rlike("^(laut|according to|says|gemäß|as stated)|says the|laut aushang")).select("id")


@query("X34: answers with few words new to the question, numbers exempt", f"""
WITH k AS (SELECT id, target_answer AS a, {CONTENT.format('target_answer')} AS c, {CONTENT.format('question_text')} AS q FROM questions)
SELECT id FROM k WHERE len(c) > 0 AND NOT regexp_matches(a, '[0-9]') AND len(list_filter(c, lambda x: NOT list_contains(q, x))) < 0.3 * len(c)""")
def restating_answers(t: Tables) -> DataFrame:
    c, q = content("target_answer"), content("question_text")
    return t.questions.filter((F.size(c) > 0) & ~F.col("target_answer").rlike("[0-9]") & (F.size(F.array_except(c, q)) < 0.3 * F.size(c))).select("id")


_RECOVERED = f"""
WITH f AS (SELECT question_id, string_agg(concat(coalesce(statement, ''), ' ', coalesce(evidence_text, '')), ' ' ORDER BY f.id) AS s, string_agg(coalesce(statement, ''), ' ' ORDER BY f.id) AS r FROM (SELECT DISTINCT * FROM question_facts) qf JOIN facts f ON f.id = qf.fact_id GROUP BY 1),
k AS (SELECT q.id, answer_form, {CONTENT.format('target_answer')} AS c, {CONTENT.format('s')} AS s, {CONTENT.format('r')} AS r, {CONTENT.format('question_text')} AS q, regexp_extract_all(coalesce(target_answer, ''), '[0-9]+') AS n, regexp_extract_all(coalesce(s, ''), '[0-9]+') AS m FROM questions q LEFT JOIN f ON f.question_id = q.id),
v AS (SELECT id, answer_form, len(list_intersect(c, s)) / nullif(len(c), 0) AS recall, len(list_filter(n, lambda x: NOT list_contains(m, x))) = 0 AS carried, CASE WHEN len(r) <= len(c) THEN 1.0 ELSE len(list_intersect(c, r)) / len(r) END AS held,
 len(list_filter(r, lambda x: NOT list_contains(c, x) AND NOT list_contains(q, x))) > 0 AS more, len(c) > 0 AND len(list_filter(c, lambda x: NOT list_contains(s, x))) = 0 AS inside FROM k)
"""


@query("X35, X36, X37, X59: an answer recovered from its facts: how much of it, whether its numbers, what share of the recovery the answer holds; agreement, and incomplete lists", _RECOVERED + """
SELECT id, round(recall, 6) AS recall, carried, round(held, 6) AS held, carried AND (coalesce(recall >= 0.5, false) OR inside) AS agrees, coalesce(answer_form = 'list', false) AND held < 0.5 AND more AS incomplete FROM v""")
def round_trip(t: Tables) -> DataFrame:
    """The statements of a question's facts stand in for a recovered answer. It agrees if it carries the answer's numbers and half of its content words, or
    all of them; a list is incomplete if the answer holds less than half of the recovery, which names a word that neither answer nor question has."""
    said = lambda *cs: F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in cs])
    facts = t.facts.select(F.col("id").alias("fact_id"), said("statement", "evidence_text").alias("s"), F.coalesce("statement", F.lit("")).alias("r"))
    joined = lambda c: F.array_join(F.transform(F.col("o"), lambda x: x[c]), " ").alias(c)
    f = t.question_facts.distinct().join(facts, "fact_id").groupBy(F.col("question_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("fact_id", "s", "r"))).alias("o")).select("id", joined("s"), joined("r"))
    rows = t.questions.select("id", "target_answer", "question_text", "answer_form").join(f, "id", "left")
    rows = rows.select("id", "answer_form", content("target_answer").alias("c"), content("s").alias("sw"), content("r").alias("rw"), content("question_text").alias("q"), F.size(F.array_except(numbers("target_answer"), numbers("s"))).alias("lost"))
    carried, recall = F.col("lost") == 0, share_of(F.col("c"), F.col("sw"))
    held = F.when(F.size("rw") <= F.size("c"), F.lit(1.0)).otherwise(F.size(F.array_intersect("c", "rw")) / F.nullif(F.size("rw"), F.lit(0)))
    inside = (F.size("c") > 0) & (F.size(F.array_except("c", "sw")) == 0)
    more = F.size(F.array_except(F.array_except("rw", "c"), F.col("q"))) > 0
    return rows.select(
        "id", F.round(recall, 6).alias("recall"), carried.alias("carried"), F.round(held, 6).alias("held"),
        (carried & (F.coalesce(recall >= 0.5, F.lit(False)) | inside)).alias("agrees"), (F.coalesce(F.col("answer_form") == "list", F.lit(False)) & (held < 0.5) & more).alias("incomplete"),
    )


@query("X38: items that an answer sets apart", """
SELECT id, list_filter(list_transform(regexp_split_to_array(target_answer, '[;\\n]'), lambda x: trim(x)), lambda x: x <> '') AS items FROM questions WHERE contains(target_answer, ';')""")
def answer_items(t: Tables) -> DataFrame:
    return t.questions.filter(F.contains("target_answer", F.lit(";"))).select("id", F.filter(F.transform(F.split("target_answer", r"[;\n]"), lambda x: F.trim(x)), lambda x: x != "").alias("items"))


@query("X39, X57: follow-ups: a fact the parent did not cite, and words the parent did not have", f"""
WITH c AS (SELECT question_id, list(DISTINCT fact_id) AS f FROM question_facts GROUP BY 1), k AS (SELECT q.id, q.follows_id, c.f, {CONTENT.format('target_answer')} AS w, {CONTENT.format('question_text')} AS x FROM questions q LEFT JOIN c ON c.question_id = q.id)
SELECT a.id, coalesce(len(list_filter(a.f, lambda x: NOT list_contains(coalesce(b.f, []), x))), 0) > 0 AS reaches, round(len(list_filter(a.w, lambda y: NOT list_contains(list_concat(b.w, b.x), y))) / nullif(len(a.w), 0), 6) AS new_share FROM k a JOIN k b ON b.id = a.follows_id""")
def follow_ups(t: Tables) -> DataFrame:
    c = t.question_facts.groupBy(F.col("question_id").alias("id")).agg(F.collect_set("fact_id").alias("f"))
    k = t.questions.select("id", "follows_id", content("target_answer").alias("w"), content("question_text").alias("x")).join(c, "id", "left").withColumn("f", F.coalesce("f", F.array().cast("array<bigint>")))
    b = k.select(F.col("id").alias("follows_id"), F.col("f").alias("bf"), F.concat("w", "x").alias("bw"))
    rows = k.filter("follows_id IS NOT NULL").join(b, "follows_id")
    return rows.select("id", (F.size(F.array_except("f", "bf")) > 0).alias("reaches"), F.round(F.size(F.array_except("w", "bw")) / F.nullif(F.size("w"), F.lit(0)), 6).alias("new_share"))


@query("X58: whether a follow-up rests on a passage that its parent used; where either has none, it may", """
WITH c AS (SELECT question_id AS id, list(DISTINCT passage_id) AS p FROM question_facts JOIN fact_passages USING (fact_id) GROUP BY 1)
SELECT q.id, a.p IS NULL OR b.p IS NULL OR list_has_any(a.p, b.p) AS same_material FROM questions q LEFT JOIN c a ON a.id = q.id LEFT JOIN c b ON b.id = q.follows_id WHERE q.follows_id IS NOT NULL""")
def follow_up_material(t: Tables) -> DataFrame:
    cited = t.question_facts.distinct().join(t.fact_passages.select("fact_id", "passage_id").distinct(), "fact_id").select(F.col("question_id").alias("id"), "passage_id").distinct()
    turns = t.questions.filter("follows_id IS NOT NULL").select("id", "follows_id")
    # Joined link by link, so that no question's passages are gathered.
    own = turns.join(cited, "id").select("id", "follows_id", "passage_id")
    parent = turns.join(cited.withColumnRenamed("id", "follows_id"), "follows_id").select("id").distinct().withColumn("has_parent", F.lit(True))
    shared = own.join(cited.withColumnRenamed("id", "follows_id"), ["follows_id", "passage_id"]).select("id").distinct().withColumn("shares", F.lit(True))
    rows = turns.join(own.select("id").distinct().withColumn("has_own", F.lit(True)), "id", "left").join(parent, "id", "left").join(shared, "id", "left")
    return rows.select("id", (F.col("has_own").isNull() | F.col("has_parent").isNull() | F.col("shares").isNotNull()).alias("same_material"))


@query("X40, X41, X42, X44, X46: first failing check of a fact by its kind", f"""
WITH s AS (SELECT fact_id, count(DISTINCT passage_id) AS n FROM fact_passages GROUP BY 1)
SELECT id, coalesce(CASE WHEN trim(coalesce(statement, '')) = '' THEN 'no_claim' END, CASE WHEN contains(lower(evidence_text), lower(statement)) THEN 'copied' END, CASE WHEN kind = 'bridge' AND coalesce(n, 0) < 2 THEN 'one_source' END,
 CASE WHEN kind = 'summary' AND length(statement) > 0.8 * length(evidence_text) THEN 'not_condensed' END, CASE WHEN kind = 'atomic' AND contains(statement, ';') THEN 'not_atomic' END) AS failure FROM facts LEFT JOIN s ON s.fact_id = id""")
def fact_checks(t: Tables) -> DataFrame:
    s = t.fact_passages.groupBy(F.col("fact_id").alias("id")).agg(F.countDistinct("passage_id").alias("n"))
    st, kind = F.col("statement"), F.col("kind")
    checks = [
        F.when(F.trim(F.coalesce(st, F.lit(""))) == "", "no_claim"), F.when(F.contains(F.lower("evidence_text"), F.lower(st)), "copied"), F.when((kind == "bridge") & (F.coalesce("n", F.lit(0)) < 2), "one_source"),
        F.when((kind == "summary") & (F.length(st) > 0.8 * F.length("evidence_text")), "not_condensed"), F.when((kind == "atomic") & F.contains(st, F.lit(";")), "not_atomic"),
    ]
    return t.facts.select("id", "kind", "statement", "evidence_text").join(s, "id", "left").select("id", F.coalesce(*checks).alias("failure"))


def grid_statements(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row, col, statement) of a table's value cells, from (keys, scope, row, col, row_span, col_span, header, text).

    ``header`` is 'column', 'row' or null. A column's label is the stack of the column headers above it from the top, a row's that of the row headers
    beside it from the left; a header with spans stands for every row and column it covers, and a label that repeats the one before it in the stack is said once. The
    statement is "scope - row - column: value" of what is known; empty cells and headers state nothing.
    """
    live = cells.filter(F.trim("text") != "").withColumn("text", F.trim("text"))

    def stack(kind: str, over: str, span: str, along: str) -> DataFrame:
        places = F.explode(F.sequence(F.col(over), F.col(over) + F.greatest(F.lit(1), F.coalesce(span, F.lit(1))) - 1))
        labels = live.filter(F.col("header") == kind).select(*keys, places.alias(over), along, "text").groupBy(*keys, over).agg(F.array_sort(F.collect_set(F.struct(along, "text"))).alias("o"))
        texts = F.transform("o", lambda e: e["text"])
        once = F.filter(texts, lambda x, i: (i == 0) | (x != F.get(texts, F.greatest(i - 1, F.lit(0)))))
        return labels.select(*keys, over, F.array_join(once, ", ").alias(f"{kind}_label"))

    values = live.filter("header IS NULL")
    rows = values.join(stack("column", "col", "col_span", "row"), [*keys, "col"], "left").join(stack("row", "row", "row_span", "col"), [*keys, "row"], "left")
    head = F.concat_ws(" - ", F.when(F.col("scope") != "", F.col("scope")), "row_label", "column_label")
    return rows.select(*keys, "row", "col", F.when(head == "", F.col("text")).otherwise(F.concat(head, F.lit(": "), "text")).alias("statement"))


@query("X47, X48, X49, G09: cells of table passages as statements of section, row, column and value", """
WITH l AS (SELECT id, coalesce(section_path, '') AS scope, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM passages WHERE text IS NOT NULL),
c AS (SELECT id, scope, i, list_transform(string_split(line, '|'), lambda x: trim(x)) AS c FROM l WHERE contains(line, '|')), r AS (SELECT *, unnest(range(2, len(c) + 1)) AS j FROM c)
SELECT id, i AS row, j AS col, concat(CASE WHEN scope <> '' THEN concat(scope, ' - ') ELSE '' END, CASE WHEN c[1] <> '' THEN concat(c[1], ' - ') ELSE '' END, 'column ', j, ': ', c[j]) AS statement FROM r WHERE c[j] <> ''""")
def table_statements(t: Tables) -> DataFrame:
    """The tables here print no column headers, so a column is named by its number; the first cell of a line heads its row."""
    line = t.passages.filter("text IS NOT NULL").select("id", F.coalesce("section_path", F.lit("")).alias("scope"), F.posexplode(F.split("text", "\n")).alias("i", "line")).filter(F.contains("line", F.lit("|")))
    cells = line.select("id", "scope", (F.col("i") + 1).cast("bigint").alias("row"), F.posexplode(F.split("line", r"\|")).alias("j", "text")).withColumn("col", (F.col("j") + 1).cast("bigint"))
    one = F.lit(1).cast("bigint")
    marked = cells.select("id", "scope", "row", "col", one.alias("row_span"), one.alias("col_span"), F.when(F.col("col") == 1, "row").alias("header"), "text")
    widths = cells.groupBy("id", "scope").agg(F.max("col").alias("most"))
    heads = widths.select("id", "scope", F.lit(0).cast("bigint").alias("row"), F.explode(F.sequence(F.lit(2).cast("bigint"), F.greatest(F.lit(2).cast("bigint"), "most"))).alias("col"))
    named = heads.select("id", "scope", "row", "col", one.alias("row_span"), one.alias("col_span"), F.lit("column").alias("header"), F.concat(F.lit("column "), F.col("col").cast("string")).alias("text"))
    return grid_statements(marked.unionByName(named), ["id"])


@query("X51: answer forms as factual or open", """
SELECT id, CASE answer_form WHEN 'value' THEN 'factoid' WHEN 'list' THEN 'factoid' WHEN 'explanation' THEN 'open-ended' END AS factuality FROM questions""")
def factuality(t: Tables) -> DataFrame:
    form = F.col("answer_form")
    return t.questions.select("id", F.when(form.isin("value", "list"), "factoid").when(form == "explanation", "open-ended").alias("factuality"))


@query("X52: ranges of pages as text", """
SELECT id, CASE WHEN page_from IS NULL THEN NULL WHEN page_from = page_to THEN CAST(page_from AS VARCHAR) ELSE concat(page_from, '-', page_to) END AS pages FROM passages""")
def page_ranges(t: Tables) -> DataFrame:
    first, last = F.col("page_from"), F.col("page_to")
    return t.passages.select("id", F.when(first.isNull(), F.lit(None)).when(first == last, first.cast("string")).otherwise(F.concat(first.cast("string"), F.lit("-"), F.coalesce(last.cast("string"), F.lit("")))).alias("pages"))


@query("X55: last words that more than a tenth of the titles of a language share", f"""
WITH k AS (SELECT lower(lang) AS l, {W.format('title')} AS w FROM documents WHERE title IS NOT NULL AND lang IS NOT NULL), n AS (SELECT l, count(*) AS n FROM k GROUP BY 1) SELECT l AS language, w[1] AS word, count(*) AS titles FROM k JOIN n USING (l) GROUP BY 1, 2, n HAVING count(*) > 0.1 * n""")
def shared_title_words(t: Tables) -> DataFrame:
    k = t.documents.filter("title IS NOT NULL AND lang IS NOT NULL").select(F.lower("lang").alias("language"), F.try_element_at(words("title"), F.lit(1)).alias("word"))
    n = k.groupBy("language").agg(F.count(F.lit(1)).alias("n"))
    return k.groupBy("language", "word").agg(F.count(F.lit(1)).alias("titles")).join(n, "language").filter("titles > 0.1 * n").select("language", "word", "titles")
