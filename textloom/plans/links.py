"""Links between sections: references, siblings and shared rare terms, the best partner of each, and partners near and far."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.groups import walked
from textloom.operators.partners import ALIKE, SHARED, extremes
from textloom.operators.windows import first_of
from textloom.registry import Tables, query
from textloom.session import checkpointed, stored

#: Tiers of links, the strongest first.
REFERENCE, SIBLING, TERM = 0, 1, 2


def terms_of(t: Tables) -> DataFrame:
    x = t.passage_vocabulary.select("id", F.explode("lemmas").alias("x")).select("id", F.lower(F.trim("x")).alias("term"))
    return x.filter("term <> ''").distinct()


def heads(t: Tables) -> DataFrame:
    """(id, doc_sha256, path, parent): the first passage of each section."""
    s = t.passages.filter("section_path IS NOT NULL").groupBy("doc_sha256", F.col("section_path").alias("path")).agg(F.min(F.struct("ordinal", "id")).alias("o"))
    return s.select(F.col("o.id").alias("id"), F.col("o.ordinal").alias("ordinal"), "doc_sha256", "path", F.substring_index("path", ".", 1).alias("parent"))


def worded(t: Tables) -> DataFrame:
    """(id, v, w): each passage's distinct (language, term) and distinct terms."""
    terms = F.array_distinct(F.filter(F.transform("lemmas", lambda x: F.lower(F.trim(x))), lambda x: x != ""))
    rows = t.passage_vocabulary.select("id", "language", terms.alias("w")).filter(F.size("w") > 0).groupBy("id").agg(F.collect_list(F.struct("language", "w")).alias("r"))
    v = F.flatten(F.transform("r", lambda r: F.transform(r["w"], lambda x: F.struct(r["language"].alias("language"), x.alias("term")))))
    return stored(rows.select("id", F.when(F.size("r") > 1, F.array_distinct(v)).otherwise(v).alias("v"), F.array_distinct(F.flatten("r.w")).alias("w")))


def holders(own: DataFrame) -> DataFrame:
    """(language, term, id, df) of the passages in ``own`` that hold each rare term (of two passages at least, half a percent of the language at most).
    What a thousandth of all passages have and is not rare leaves before the shuffle: of such terms there are a thousand times those of a passage at most."""
    v = own.select("id", F.explode("v").alias("x")).select("id", "x.language", "x.term").filter("language IS NOT NULL")
    languages = own.select("id", F.explode(F.array_distinct("v.language")).alias("language")).groupBy("language").agg(F.count("id").alias("n"))
    every = own.agg(F.count(F.lit(1)).alias("every"))
    most = F.greatest(F.lit(2), F.ceil(0.005 * F.col("n")))
    df = checkpointed(v.groupBy("language", "term").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").join(languages, "language").withColumn("rare", F.col("df") <= most).crossJoin(every))
    frequent = df.filter("NOT rare AND df * 1000 > every").select("language", "term")
    rare = df.filter("rare").select("language", "term", "df")
    return v.filter("id IS NOT NULL").join(F.broadcast(frequent), ["language", "term"], "left_anti").join(rare.hint("merge"), ["language", "term"])


def references(t: Tables, h: DataFrame) -> DataFrame:
    """(a, b): section heads and those they name, either way round."""
    found = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("(?:section|Abschnitt) ([0-9]+)"), F.lit(1))))
    named = t.passages.select("id", found.alias("label")).join(h.select("id", "doc_sha256", "ordinal"), "id").withColumn("label", F.col("label").cast("bigint"))
    target = h.select(F.col("id").alias("b"), "doc_sha256", F.col("ordinal").alias("o"), F.col("parent").try_cast("bigint").alias("label"))
    near = named.join(target, ["doc_sha256", "label"]).filter("id <> b").groupBy(F.col("id").alias("a"), "label").agg(F.min(F.struct(F.abs(F.col("o") - F.col("ordinal")).alias("d"), "b")).alias("m"))
    one = near.select("a", F.col("m.b").alias("b"))
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


_RARE = r"""
WITH v AS (SELECT DISTINCT id, language, lower(trim(x)) AS term FROM (SELECT id, language, unnest(lemmas) AS x FROM passage_vocabulary WHERE language IS NOT NULL) WHERE trim(x) <> ''),
n AS (SELECT language, count(DISTINCT id) AS n FROM v GROUP BY 1), df AS (SELECT language, term, count(*) AS df FROM v GROUP BY 1, 2),
r AS (SELECT language, term FROM df JOIN n USING (language) WHERE df BETWEEN 2 AND greatest(2, ceil(0.005 * n))),
s0 AS (SELECT DISTINCT a.id AS a, b.id AS b FROM v a JOIN r USING (language, term) JOIN v b ON b.language = a.language AND b.term = a.term AND a.id <> b.id),
w AS (SELECT id, list(DISTINCT lower(trim(x))) AS w FROM (SELECT id, unnest(lemmas) AS x FROM passage_vocabulary) WHERE trim(x) <> '' GROUP BY 1)
"""
_EDGES = _RARE + r""",
h AS (SELECT arg_min(id, (ordinal, id)) AS id, min(ordinal) AS ordinal, doc_sha256, section_path AS path, string_split(section_path, '.')[1] AS parent FROM passages WHERE section_path IS NOT NULL GROUP BY doc_sha256, section_path),
l AS (SELECT h.id, h.doc_sha256, h.ordinal, CAST(unnest(list_distinct(regexp_extract_all(p.text, '(?:section|Abschnitt) ([0-9]+)', 1))) AS BIGINT) AS label FROM h JOIN passages p USING (id)),
f0 AS (SELECT a, b FROM (SELECT l.id AS a, h.id AS b, row_number() OVER (PARTITION BY l.id, l.label ORDER BY abs(h.ordinal - l.ordinal), h.id) AS k FROM l JOIN h ON h.doc_sha256 = l.doc_sha256 AND TRY_CAST(h.parent AS BIGINT) = l.label AND h.id <> l.id) WHERE k = 1),
e AS (SELECT a, b, min(tier) AS tier FROM (SELECT a, b, 0 AS tier FROM f0 UNION ALL SELECT b, a, 0 FROM f0
 UNION ALL SELECT x.id, y.id, 1 FROM h x JOIN h y ON x.doc_sha256 = y.doc_sha256 AND x.parent = y.parent AND x.path <> y.path AND contains(x.path, '.') AND contains(y.path, '.')
 UNION ALL SELECT a, b, 2 FROM s0 WHERE a IN (SELECT id FROM h) AND b IN (SELECT id FROM h)) GROUP BY 1, 2),
k AS (SELECT a, b, tier, coalesce(len(list_intersect(x.w, y.w)), 0) AS shared FROM e LEFT JOIN w x ON x.id = a LEFT JOIN w y ON y.id = b),
best AS (SELECT a, b, tier, shared FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY tier, shared DESC, b) AS r FROM k) WHERE r = 1)
"""


def partners(t: Tables) -> DataFrame:
    """(a, b, tier, shared): each head's best partner: the strongest tier, then most terms in common, then the lower id."""
    h, own = stored(heads(t)), worded(t)
    w = own.select("id", "w")
    inside = h.select("id").distinct()
    rare = holders(own).withColumnRenamed("language", "g").join(inside.hint("merge"), "id", "left_semi").withColumn("tier", F.lit(TERM))
    parted = h.filter(F.contains("path", F.lit(".")) & F.col("doc_sha256").isNotNull() & F.col("id").isNotNull())
    many = parted.groupBy("doc_sha256", "parent").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    siblings = parted.join(many.hint("merge"), ["doc_sha256", "parent"]).select(F.lit(SIBLING).alias("tier"), F.col("doc_sha256").alias("g"), F.col("parent").alias("term"), "id", "df")
    members = rare.select("tier", "g", "term", "id", "df").unionByName(siblings).join(w.hint("merge"), "id", "left").withColumn("w", F.coalesce("w", F.array().cast("array<string>")))
    grouped = extremes(members, SHARED).select(F.col("id").alias("a"), "tier", (-F.col("most")).alias("n"), F.col("near").alias("b"))
    named = references(t, h).join(w.select(F.col("id").alias("a"), F.col("w").alias("wa")).hint("merge"), "a", "left").join(w.select(F.col("id").alias("b"), F.col("w").alias("wb")).hint("merge"), "b", "left")
    common = F.coalesce(F.size(F.array_intersect("wa", "wb")).cast("bigint"), F.lit(0))
    either = grouped.unionByName(named.select("a", F.lit(REFERENCE).alias("tier"), F.when(F.col("wa").isNull() | F.col("wb").isNull(), F.lit(0)).otherwise(-common).cast("bigint").alias("n"), "b"))
    best = either.groupBy("a").agg(F.min(F.struct("tier", "n", "b")).alias("m"))
    return best.select("a", F.col("m.b").alias("b"), F.col("m.tier").alias("tier"), (-F.col("m.n")).alias("shared"))


@query("J23, J24, T17: the best partner of each section's head by reference, sibling or shared rare term", _EDGES + "SELECT a, b, tier, shared FROM best")
def head_partners(t: Tables) -> DataFrame:
    return partners(t)


@query("J24, J25: pairs of heads, one that is the best of both taken once, and grown to three by the partner's own best", _EDGES + """
SELECT x.a, x.b, CASE WHEN y.b <> x.a THEN y.b END AS third FROM best x LEFT JOIN best y ON y.a = x.b WHERE y.b IS NULL OR y.b <> x.a OR x.a < x.b""")
def grown_pairs(t: Tables) -> DataFrame:
    best = checkpointed(partners(t).select("a", "b"))
    rows = best.join(best.select(F.col("a").alias("b"), F.col("b").alias("c")).hint("merge"), "b", "left")
    return rows.filter("c IS NULL OR c <> a OR a < b").select("a", "b", F.when(F.col("c") != F.col("a"), F.col("c")).alias("third"))


@query("T19, T20: each passage's most and least alike partners among those that share a rare term", _RARE + """,
k AS (SELECT a, b, len(list_intersect(x.w, y.w)) / len(list_distinct(list_concat(x.w, y.w))) AS s FROM s0 JOIN w x ON x.id = a JOIN w y ON y.id = b)
SELECT a AS id, arg_min(b, (-round(s, 9), b)) AS most, arg_min(b, (round(s, 9), b)) AS least FROM k GROUP BY 1""")
def alike_and_apart(t: Tables) -> DataFrame:
    own = worded(t)
    members = holders(own).withColumnRenamed("language", "g").withColumn("tier", F.lit(TERM)).join(own.select("id", "w").hint("merge"), "id")
    found = extremes(members, ALIKE).groupBy("id").agg(F.min(F.struct((-F.col("most")).alias("s"), "near")).alias("most"), F.min(F.struct("least", "far")).alias("least"))
    return found.select("id", F.col("most.near").alias("most"), F.col("least.far").alias("least"))


@query("T22: the five terms that most passages of a chapter have", """
WITH v AS (SELECT DISTINCT id, lower(trim(x)) AS term FROM (SELECT id, unnest(lemmas) AS x FROM passage_vocabulary) WHERE trim(x) <> ''),
n AS (SELECT string_split(section_path, '.')[1] AS chapter, term, count(*) AS n FROM v JOIN passages USING (id) WHERE section_path IS NOT NULL GROUP BY 1, 2)
SELECT chapter, term, n FROM (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY n DESC, term) AS r FROM n) WHERE r <= 5""")
def chapter_terms(t: Tables) -> DataFrame:
    chapters = t.passages.filter("section_path IS NOT NULL").select("id", F.substring_index("section_path", ".", 1).alias("chapter"))
    n = terms_of(t).join(chapters, "id").groupBy("chapter", "term").agg(F.count(F.lit(1)).alias("n"))
    return first_of(n, ["chapter"], [F.desc("n"), "term"], 5).select("chapter", "term", "n")


def _alike(rows: list[tuple]) -> list[tuple]:
    """(a, b, n, distance) of one pair of blocks: for each passage of either the one of the other with most terms in common, then the nearest by ordinal,
    then the lower id. Rows are (doc, i, j, block, id, ordinal, terms) in order of block and id."""
    left = [r[4:] for r in rows if r[3] == rows[0][1]]
    right = left if rows[0][1] == rows[0][2] else [r[4:] for r in rows if r[3] == rows[0][2]]
    if not right:
        return []
    held: dict[str, list[int]] = {}
    for k, (_, _, terms) in enumerate(right):
        for x in terms:
            held.setdefault(x, []).append(k)
    postings = {x: np.asarray(v) for x, v in held.items()}
    ids, at = np.array([r[0] for r in right]), np.array([r[1] for r in right])
    most, gap, of, out = np.full(len(right), -1), np.zeros(len(right), dtype=np.int64), np.zeros(len(right), dtype=np.int64), []
    for k, (a, ordinal, terms) in enumerate(left):
        own = [postings[x] for x in terms if x in postings]
        n = np.bincount(np.concatenate(own), minlength=len(right)) if own else np.zeros(len(right), dtype=np.int64)
        d = np.abs(at - ordinal)
        if right is left:
            n[k] = -1
        else:
            better = (n > most) | (n == most) & ((d < gap) | (d == gap) & (a < of))
            most[better], gap[better], of[better] = n[better], d[better], a
        among = np.flatnonzero(n == n.max())
        b = among[np.lexsort((ids[among], d[among]))[0]]
        if n[b] >= 0:
            out.append((a, int(ids[b]), int(n[b]), int(d[b])))
    return out + [(int(ids[k]), int(of[k]), int(most[k]), int(gap[k])) for k in np.flatnonzero(most >= 0)]


@query("T21: same-document passage with most shared terms, then the nearest, then by id", """
WITH v AS (SELECT DISTINCT id, lower(trim(x)) AS term FROM (SELECT id, unnest(lemmas) AS x FROM passage_vocabulary) WHERE trim(x) <> ''), p AS (SELECT p.id, p.doc_sha256, p.ordinal, list(term) AS w FROM passages p JOIN v USING (id) GROUP BY 1, 2, 3)
SELECT id, near FROM (SELECT a.id, b.id AS near, row_number() OVER (PARTITION BY a.id ORDER BY len(list_intersect(a.w, b.w)) DESC, abs(a.ordinal - b.ordinal), b.id) AS r FROM p a JOIN p b ON a.doc_sha256 = b.doc_sha256 AND a.id <> b.id) WHERE r = 1""")
def document_partner(t: Tables, block: int = 4000) -> DataFrame:
    """A document is cut into blocks of about ``block`` passages and every pair of blocks meets in a task, so groups are bounded; the work is quadratic in a
    document's passages, as the comparison with all of them is."""
    v = terms_of(t).groupBy("id").agg(F.collect_set("term").alias("w"))
    p = t.passages.filter("ordinal IS NOT NULL").select("id", "doc_sha256", F.col("ordinal").cast("bigint").alias("ordinal")).join(v, "id")
    parts = p.groupBy("doc_sha256").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("of"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    w = p.join(parts, "doc_sha256").withColumn("own", F.pmod(F.xxhash64("id"), F.col("of")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    met = w.select("doc_sha256", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "ordinal", "w")
    found = walked(met, ["doc_sha256", "i", "j"], ["own", "id"], _alike, "a bigint, b bigint, n bigint, d bigint")
    best = found.groupBy(F.col("a").alias("id")).agg(F.max(F.struct("n", (-F.col("d")).alias("d"), (-F.col("b")).alias("b"))).alias("m"))
    return best.select("id", (-F.col("m.b")).alias("near"))
