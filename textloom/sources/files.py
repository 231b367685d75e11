"""Sources and sinks: uploads by content, admission, formats, exports, and the readers a media type calls for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.registry import Tables, query

# Leading bytes (hex) and the media type they show.
MAGIC = [("255044462d", "application/pdf"), ("504b0304", "application/zip"), ("89504e47", "image/png"), ("ffd8ff", "image/jpeg"), ("49492a00", "image/tiff"), ("4d4d002a", "image/tiff"), ("3c21646f", "text/html"), ("3c68746d", "text/html")]
#: Largest upload that is taken, in bytes, and what is taken.
CEILING = 100_000_000
ALLOWED = ("pdf", "html", "tiff", "txt")
#: Text longer than this is cut in a workbook's cell.
CELL = 32_000


def media_type(content: Column) -> Column:
    """Media type of a file's leading bytes; text where nothing else shows."""
    head = F.lower(F.hex(F.substring(content, 1, 8)))
    out = F.lit("text/plain")
    for sign, name in reversed(MAGIC):
        out = F.when(F.startswith(head, F.lit(sign)), name).otherwise(out)
    return out


def uploads(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, size, mime_type) of the files under a folder; contents stay in the scan."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"), media_type(F.col("content")).alias("mime_type"))


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "application/x-parquet": lambda s, p: s.read.parquet(p),
    "application/json": lambda s, p: s.read.json(p),
    "application/x-orc": lambda s, p: s.read.orc(p),
    "text/csv": lambda s, p: s.read.option("header", True).csv(p),
    "text/plain": lambda s, p: s.read.text(p, wholetext=True),
    "text/html": lambda s, p: s.read.text(p, wholetext=True).select(html_text(F.col("value")).alias("value")),
}


def reader(mime: str) -> Callable[[SparkSession, str], DataFrame]:
    """The reader of a media type; an unknown one raises."""
    if mime not in READERS:
        raise ValueError(f"no reader for {mime}")
    return READERS[mime]


def html_text(c: Column) -> Column:
    """Text of a page: scripts and styles dropped, blocks on lines of their own, tags removed, the common entities read."""
    out = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?i)</(p|div|h[1-6]|li|tr)>|<br\s*/?>", "\n")
    out = F.regexp_replace(out, r"<[^>]+>", "")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.btrim(F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\s*\n\s*", "\n"), F.lit(" \n"))


def printable(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def cell(c: Column) -> Column:
    """A value as a workbook's text: lists joined, control characters out, cut to length."""
    return F.substring(printable(c.cast("string")), 1, CELL)


def workbook(t: Tables) -> dict[str, DataFrame]:
    """The sheets of an export, each a table of its own."""
    q = t.questions.select("id", cell(F.col("question_text")).alias("question"), cell(F.col("target_answer")).alias("answer"), "question_type", "status")
    cites = t.question_facts.distinct().join(t.facts.select(F.col("id").alias("fact_id"), cell(F.col("statement")).alias("statement")), "fact_id")
    judged = t.questions.select("id", F.when(F.col("status") == "rejected", F.col("rejected_reason")).otherwise("sound").alias("verdict"))
    summary = t.questions.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return {"Questions": q, "Citations": cites, "Assessment": judged, "Summary": summary}


def written(sheets: dict[str, DataFrame], folder: str, form: str = "parquet") -> None:
    for name, df in sheets.items():
        df.write.mode("overwrite").format(form).save(f"{folder}/{name}")


@query("S01, S03: outcome of each upload attempt, decided again from its file and size", """
WITH f AS (SELECT *, lower(list_extract(string_split(submitted_filename, '.'), -1)) AS ext FROM (SELECT DISTINCT * FROM ingest_events))
SELECT id, CASE WHEN size_bytes > 100000000 THEN 'too_large' WHEN ext NOT IN ('pdf', 'html', 'tiff', 'txt') THEN 'unsupported' WHEN sha256 IS NULL THEN 'unreadable' WHEN row_number() OVER (PARTITION BY sha256 ORDER BY submitted_at, id) > 1 THEN 'held' ELSE 'stored' END AS outcome FROM f""")
def admission(t: Tables) -> DataFrame:
    rows = t.ingest_events.distinct().withColumn("ext", F.lower(F.substring_index("submitted_filename", ".", -1)))
    # The first row of each digest by an aggregate: a digest uploaded very often costs no window.
    first = rows.filter("sha256 IS NOT NULL").groupBy("sha256").agg(F.min(F.struct("submitted_at", "id")).alias("o")).select("sha256", F.col("o.id").alias("first_id"))
    joined = rows.join(first, "sha256", "left")
    outcome = F.when(F.col("size_bytes") > CEILING, "too_large").when(~F.col("ext").isin(*ALLOWED), "unsupported").when(F.col("sha256").isNull(), "unreadable").when(F.col("id") != F.col("first_id"), "held").otherwise("stored")
    return joined.select("id", outcome.alias("outcome"))


@query("S11: documents that hold too little text for their pages to be read from text", """
SELECT doc_id, round(coalesce(n_chars / nullif(page_count, 0), 0), 6) AS per_page FROM documents WHERE coalesce(n_chars / nullif(page_count, 0), 0) < 250""")
def scanned_documents(t: Tables) -> DataFrame:
    per = F.coalesce(F.col("n_chars") / F.nullif(F.col("page_count"), F.lit(0)), F.lit(0.0))
    return t.documents.select("doc_id", F.round(per, 6).alias("per_page")).filter(per < 250)


@query("S04, S05, Q12: documents inserted if absent, by digest", """
SELECT sha256, min(id) AS event_id FROM ingest_events WHERE sha256 IS NOT NULL AND sha256 NOT IN (SELECT sha256 FROM documents) GROUP BY 1""")
def inserted_if_absent(t: Tables) -> DataFrame:
    new = t.ingest_events.filter("sha256 IS NOT NULL").groupBy("sha256").agg(F.min("id").alias("event_id"))
    return new.join(t.documents.select("sha256"), "sha256", "left_anti").select("sha256", "event_id")


@query("S09: reader that each document's media type calls for", "SELECT mime_type, CASE WHEN mime_type = 'text/html' THEN 'html' WHEN mime_type LIKE 'image/%' THEN 'image' WHEN mime_type = 'application/pdf' THEN 'pdf' END AS reader, count(*) AS n FROM documents GROUP BY 1")
def reader_dispatch(t: Tables) -> DataFrame:
    kind = F.when(F.col("mime_type") == "text/html", "html").when(F.startswith("mime_type", F.lit("image/")), "image").when(F.col("mime_type") == "application/pdf", "pdf")
    return t.documents.groupBy("mime_type").agg(F.count(F.lit(1)).alias("n")).select("mime_type", kind.alias("reader"), "n")


@query("S12: text of pages as HTML, built and read back", """
SELECT doc_id, trim(regexp_replace(regexp_replace(concat(title, chr(10), text), '[ \\t]+', ' ', 'g'), '\\s*\\n\\s*', chr(10), 'g')) AS text FROM documents WHERE mime_type = 'text/html' AND title IS NOT NULL AND text IS NOT NULL""")
def page_texts(t: Tables) -> DataFrame:
    rows = t.documents.filter("mime_type = 'text/html' AND title IS NOT NULL AND text IS NOT NULL")
    marked = lambda c: F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    page = F.concat(F.lit("<html><style>p {}</style><h1>"), marked("title"), F.lit("</h1><p>"), marked("text"), F.lit("</p></html>"))
    return rows.select("doc_id", html_text(page).alias("text"))


@query("S16, S17, S18: the summary and question sheets of an export as one table of cells", """
SELECT 'Questions' AS sheet, CAST(id AS VARCHAR) AS key, substring(coalesce(target_answer, ''), 1, 32000) AS value FROM questions UNION ALL SELECT 'Summary', status, CAST(count(*) AS VARCHAR) FROM questions GROUP BY 2""")
def export_cells(t: Tables) -> DataFrame:
    sheets = workbook(t)
    q = sheets["Questions"].select(F.lit("Questions").alias("sheet"), F.col("id").cast("string").alias("key"), F.coalesce("answer", F.lit("")).alias("value"))
    return q.unionByName(sheets["Summary"].select(F.lit("Summary").alias("sheet"), F.col("status").alias("key"), F.col("n").cast("string").alias("value")))


@query("S19: questions by language and category, categories one a row", """
SELECT DISTINCT p.id, lower(trim(language)) AS language, lower(trim(unnest(categories))) AS category FROM release_pool p WHERE language IS NOT NULL""")
def questions_by_category(t: Tables) -> DataFrame:
    return t.release_pool.filter("language IS NOT NULL").select("id", F.lower(F.trim("language")).alias("language"), F.explode("categories").alias("c")).select("id", "language", F.lower(F.trim("c")).alias("category")).distinct()


@query("S20, S25: labels as JSON lines written and read under a schema that fails on what does not fit", "SELECT id, question_text AS question, status = 'accepted' AS label FROM questions")
def label_lines(t: Tables) -> DataFrame:
    import uuid

    from textloom.session import shared_folder

    path = f"{shared_folder(t.spark)}/labels-{uuid.uuid4().hex}"
    t.questions.select("id", F.col("question_text").alias("question"), (F.col("status") == "accepted").alias("label")).write.json(path)
    return t.spark.read.schema("id bigint, question string, label boolean").option("mode", "FAILFAST").json(path)


@query("S26: stratified records to push to reviewers", """
SELECT id, difficulty FROM (SELECT id, difficulty, row_number() OVER (PARTITION BY difficulty ORDER BY md5(CAST(id AS VARCHAR))) AS r FROM questions WHERE difficulty IS NOT NULL) WHERE r <= 10""")
def review_push(t: Tables) -> DataFrame:
    r = F.row_number().over(Window.partitionBy("difficulty").orderBy(F.md5(F.col("id").cast("string"))))
    return t.questions.filter("difficulty IS NOT NULL").withColumn("r", r).filter("r <= 10").select("id", "difficulty")
