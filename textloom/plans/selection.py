"""Plans of slots, quotas and order-dependent selection.

What a closed form can say is a plan of columns. What depends on order (a greedy choice) runs within groups that bound it, in the order its
definition names, and its result is checked by invariants.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.groups import walked
from textloom.operators.windows import hashed
from textloom.registry import Tables, query
from textloom.session import checkpointed, stored


def apportioned(weights: dict[str, float], supply: dict[str, int], size: int) -> dict[str, int]:
    """Seats by largest remainder under each name's supply; what a name cannot take goes to the others by their weights, again and again
    until all are given or nothing is left."""
    out = dict.fromkeys(weights, 0)
    left = min(size, sum(supply.get(k, 0) for k in weights))
    while left:
        open_ = {k: w for k, w in weights.items() if w > 0 and out[k] < supply.get(k, 0)}
        if not open_:
            break
        whole = sum(open_.values())
        exact = {k: left * w / whole for k, w in open_.items()}
        give = {k: min(supply[k] - out[k], math.floor(x + 1e-9)) for k, x in exact.items()}
        if not any(give.values()):
            give = {}
            for k in sorted(open_, key=lambda k: (-(exact[k] % 1), k))[:left]:
                give[k] = 1
        for k, n in give.items():
            out[k] += n
            left -= n
    return out


def largest_fillable(weights: dict[str, float], supply: dict[str, int], tolerance: float = 0.05) -> int:
    """The largest size at which every name's share stays within the tolerance of its weight, by a scan downwards from a bound that no larger
    size can meet."""
    whole = sum(w for w in weights.values() if w > 0)
    bound = min([int((supply.get(k, 0) + 1) / max(1e-9, w / whole - tolerance)) for k, w in weights.items() if w / whole > tolerance] + [sum(supply.values())])
    for size in range(bound, 0, -1):
        seats = apportioned(weights, supply, size)
        if sum(seats.values()) == size and all(abs(seats[k] - size * w / whole) <= max(1, tolerance * size) for k, w in weights.items()):
            return size
    return 0


@query("P01, P02: slots with a type by highest averages, a band by position and a kind in turn", """
WITH w AS (SELECT question_type AS name, CAST(count(*) AS DOUBLE) AS w FROM questions GROUP BY 1), k AS (SELECT name, j, row_number() OVER (ORDER BY w / (2 * j + 1) DESC, name, j) - 1 AS slot FROM w, (SELECT unnest(range(0, 40)) AS j))
SELECT slot, name AS type, CASE WHEN floor((slot + 1) * 0.25) > floor(slot * 0.25) THEN 'hard' WHEN floor((slot + 1) * 0.5) > floor(slot * 0.5) THEN 'medium' ELSE 'easy' END AS band, (['atomic', 'summary', 'bridge'])[slot % 3 + 1] AS kind FROM k WHERE slot < 40""")
def slot_plan(t: Tables) -> DataFrame:
    w = t.questions.groupBy(F.col("question_type").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("w"))
    keys = w.select("name", "w", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("j")).withColumn("k", F.col("w") / (2 * F.col("j") + 1)).orderBy(F.desc("k"), "name", "j").limit(40)
    rows = keys.withColumn("slot", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("k"), "name", "j")) - 1)  # forty rows
    spread = lambda s: F.floor((F.col("slot") + 1) * s) > F.floor(F.col("slot") * s)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("atomic", "summary", "bridge")]), (F.col("slot") % 3 + 1).cast("int"))
    return rows.select("slot", F.col("name").alias("type"), F.when(spread(0.25), "hard").when(spread(0.5), "medium").otherwise("easy").alias("band"), kind.alias("kind"))


@query("P07: facts with the same evidence", """
SELECT a.id AS a, b.id AS b FROM facts a JOIN facts b ON md5(a.evidence_text) = md5(b.evidence_text) AND a.id < b.id""")
def evidence_siblings(t: Tables) -> DataFrame:
    rows = t.facts.filter("evidence_text IS NOT NULL").select("id", F.md5("evidence_text").alias("h"))
    return rows.select("h", F.col("id").alias("a")).join(rows.select("h", F.col("id").alias("b")), "h").filter("a < b").select("a", "b")


@query("P09, P17: seats of the pool's bands under their supply, and the largest size they can fill", None)
def pool_quota(t: Tables) -> DataFrame:
    """Bands are few by nature: their counts, at most 1,000, are taken to the driver."""
    rows = t.release_pool.select("id", F.lower(F.trim("difficulty")).alias("d")).filter("d IS NOT NULL").distinct().groupBy("d").agg(F.count(F.lit(1)).alias("n")).limit(1000).collect()
    supply = {r["d"]: r["n"] for r in rows}
    weights = {k: 1.0 for k in supply}
    size = largest_fillable(weights, supply)
    seats = apportioned(weights, supply, sum(supply.values()) // 2)
    return t.spark.createDataFrame([(k, supply[k], seats[k], size) for k in sorted(supply)], "difficulty string, supply bigint, seats bigint, fillable bigint")


@query("P11: whether each axis of the pool holds its shares within a tolerance", """
WITH r AS (SELECT DISTINCT id, lower(trim(language)) AS l FROM release_pool WHERE language IS NOT NULL), s AS (SELECT l, count(*) / sum(count(*)) OVER () AS s FROM r GROUP BY 1) SELECT bool_and(abs(s - 0.5) <= 0.05) AS held FROM s""")
def shares_within(t: Tables) -> DataFrame:
    per = t.release_pool.filter("language IS NOT NULL").select("id", F.lower(F.trim("language")).alias("l")).distinct().groupBy("l").agg(F.count(F.lit(1)).alias("n"))
    rows = per.crossJoin(per.agg(F.sum("n").alias("t")))  # one row
    return rows.agg(F.bool_and(F.abs(F.col("n") / F.col("t") - 0.5) <= 0.05).alias("held"))


def independent(rows: DataFrame) -> DataFrame:
    """(item) of the items that a walk in order of h keeps, when each takes its keys and one whose key is taken is left: rows are (item, key, h), h one
    an item. Every round keeps the items that come first at all their keys and drops those they exclude, which decides as the walk does without
    walking; rounds are logarithmic in practice, and no pair of items is formed."""
    alive, kept = checkpointed(rows), []
    while not alive.isEmpty():
        best = alive.groupBy("key").agg(F.min("h").alias("best"))
        first = alive.join(best, "key").groupBy("item").agg(F.bool_and(F.col("h") == F.col("best")).alias("wins")).filter("wins").select("item")
        first = checkpointed(first)
        kept.append(first)
        taken = alive.join(first, "item", "left_semi").select("key").distinct()
        out = alive.join(taken, "key", "left_semi").select("item").distinct()
        alive = checkpointed(alive.join(out, "item", "left_anti"))
    whole = rows.select("item").limit(0)
    for x in kept:
        whole = whole.unionByName(x)
    return whole


@query("P14: accepted questions that a walk in hash order keeps, none on a fact of another", """
WITH RECURSIVE q AS (SELECT DISTINCT question_id AS id, fact_id, md5(CAST(question_id AS VARCHAR)) AS h FROM question_facts JOIN questions ON id = question_id WHERE status = 'accepted'),
o AS (SELECT id, h, row_number() OVER (ORDER BY h) AS r, list(DISTINCT fact_id) AS f FROM q GROUP BY id, h),
w AS (SELECT CAST(0 AS BIGINT) AS r, CAST([] AS BIGINT[]) AS taken, CAST([] AS BIGINT[]) AS kept
 UNION ALL SELECT o.r, CASE WHEN list_has_any(w.taken, o.f) THEN w.taken ELSE list_concat(w.taken, o.f) END, CASE WHEN list_has_any(w.taken, o.f) THEN w.kept ELSE list_append(w.kept, o.id) END FROM w JOIN o ON o.r = w.r + 1)
SELECT unnest(kept) AS question_id FROM (SELECT kept FROM w ORDER BY r DESC LIMIT 1)""")
def drawable(t: Tables) -> DataFrame:
    accepted = t.questions.filter("status = 'accepted'").select(F.col("id").alias("question_id"))
    rows = t.question_facts.distinct().join(accepted, "question_id", "left_semi").select(F.col("question_id").alias("item"), F.col("fact_id").alias("key"), hashed("question_id").alias("h"))
    return independent(rows).select(F.col("item").alias("question_id"))


@query("P04, P05, P06: facts dealt to questions by document: rounds over its passages, each fact spent once, a sample widened while it is small", None)
def dealt_samples(t: Tables, size: int = 3, stretch: int = 2000) -> DataFrame:
    """(doc_sha256, sample, fact_id). Within a document, passages are taken in turns by ordinal and each gives its unspent facts up to ``size``; a sample
    with one fact takes more from the next passage. A fact belongs to the first passage that has it, whatever the document's size. Documents are walked in
    stretches of ordinals, so no group is unbounded: a stretch only has to know whether a sample of one fact is open where it starts and how many are
    closed, so each stretch is summed up for either case first, and the summaries are strung together."""
    passages = t.passages.select(F.col("id").alias("passage_id"), "doc_sha256", "ordinal")
    cited = t.fact_passages.select("fact_id", "passage_id").distinct().join(passages, "passage_id")
    first = cited.groupBy("doc_sha256", "fact_id").agg(F.min(F.struct("ordinal", "passage_id")).alias("p"))
    rows = checkpointed(first.select("doc_sha256", F.coalesce(F.floor(F.col("p.ordinal") / stretch), F.lit(-1)).alias("stretch"), F.col("p.ordinal").alias("ordinal"), F.col("p.passage_id").alias("passage_id"), "fact_id"))

    def closed(open_: int, new: int) -> tuple[int, int]:
        full, left = divmod(open_ + new, size)
        return (0, full + 1) if left > 1 else (left, full)

    def summed(group: list[tuple]):
        doc, at, ends = group[0][0], group[0][1], []
        for open_ in (0, 1):
            done = 0
            for *_, n in group:
                open_, more = closed(open_, n)
                done += more
            ends += [open_, done]
        yield doc, at, *ends

    def strung(group: list[tuple]):
        open_, done = 0, 0
        for doc, at, *ends in group:
            yield doc, at, open_, done
            open_, more = ends[2 * open_ : 2 * open_ + 2]
            done += more

    def deal(group: list[tuple]):
        doc, open_, sample = group[0][0], group[0][5], group[0][6]
        for _, part in itertools.groupby(group, key=lambda r: (r[2], r[3])):
            for r in part:
                yield doc, sample, r[4]
                open_ += 1
                if open_ == size:
                    open_, sample = 0, sample + 1
            if open_ > 1:
                open_, sample = 0, sample + 1

    counts = rows.groupBy("doc_sha256", "stretch", "ordinal", "passage_id").agg(F.count(F.lit(1)).alias("n"))
    ends = walked(counts, ["doc_sha256", "stretch"], ["ordinal", "passage_id"], summed, "doc_sha256 string, stretch bigint, open0 int, done0 bigint, open1 int, done1 bigint")
    starts = walked(ends, ["doc_sha256"], ["stretch"], strung, "doc_sha256 string, stretch bigint, open int, done bigint")
    dealt = rows.join(starts, ["doc_sha256", "stretch"]).select("doc_sha256", "stretch", "ordinal", "passage_id", "fact_id", "open", "done")
    return walked(dealt, ["doc_sha256", "stretch"], ["ordinal", "passage_id", "fact_id"], deal, "doc_sha256 string, sample bigint, fact_id bigint")


@query("P16: pairs of accepted questions whose words overlap beyond the bar, among those on one fact", """
WITH w AS (SELECT id, list_distinct(regexp_extract_all(lower(question_text), '[\\p{L}\\p{N}]+')) AS w FROM questions WHERE status = 'accepted') SELECT DISTINCT a.question_id AS a, b.question_id AS b FROM question_facts a JOIN question_facts b ON a.fact_id = b.fact_id AND a.question_id < b.question_id
JOIN w x ON x.id = a.question_id JOIN w y ON y.id = b.question_id WHERE len(list_intersect(x.w, y.w)) >= 0.5 * len(list_distinct(list_concat(x.w, y.w)))""")
def twin_questions(t: Tables) -> DataFrame:
    from textloom.functions.columns import jaccard, words

    w = t.questions.filter("status = 'accepted'").select("id", F.array_distinct(words("question_text")).alias("w"))
    x = t.question_facts.distinct().join(w.select(F.col("id").alias("question_id"), "w"), "question_id")
    a, b = x.select("fact_id", F.col("question_id").alias("a"), F.col("w").alias("wa")), x.select("fact_id", F.col("question_id").alias("b"), F.col("w").alias("wb"))
    return a.join(b, "fact_id").filter("a < b").filter(jaccard(F.col("wa"), F.col("wb")) >= 0.5).select("a", "b").distinct()


@query("P18, P20, G12: gates in order, the first that fails, and those that ran", """
WITH k AS (SELECT id, [question_text NOT LIKE '%?', length(question_text) > 90, coalesce(confidence, 1) < 0.6, answerable AND trim(coalesce(target_answer, '')) = ''] AS f FROM questions), p AS (SELECT id, coalesce(nullif(list_position(f, true), 0), 5) AS p FROM k)
SELECT id, (['malformed', 'long', 'unsure', 'no_key', NULL])[p] AS reason, list_slice(['malformed', 'long', 'unsure', 'no_key'], 1, p) AS ran FROM p""")
def gate_pipeline(t: Tables) -> DataFrame:
    names = ["malformed", "long", "unsure", "no_key"]
    fails = [~F.endswith("question_text", F.lit("?")), F.length("question_text") > 90, F.coalesce("confidence", F.lit(1.0)) < 0.6, F.col("answerable") & (F.trim(F.coalesce("target_answer", F.lit(""))) == "")]
    place = F.array_position(F.array(*fails), True)
    at = F.when(place > 0, place).otherwise(len(names) + 1)
    all_ = F.array(*[F.lit(n) for n in names])
    return t.questions.select("id", F.try_element_at(all_, at.cast("int")).alias("reason"), F.slice(all_, F.lit(1), F.least(at, F.lit(len(names))).cast("int")).alias("ran"))


@query("P21, J33: facts on several passages unfolded into one row a passage, the first kept as head", """
WITH l AS (SELECT DISTINCT fact_id, passage_id, position FROM fact_passages) SELECT fact_id, passage_id, position = min(position) OVER (PARTITION BY fact_id) AS head FROM l WHERE fact_id IN (SELECT fact_id FROM l GROUP BY 1 HAVING count(*) > 1)""")
def unfolded_citations(t: Tables) -> DataFrame:
    l = t.fact_passages.select("fact_id", "passage_id", "position").distinct()  # noqa: E741
    several = l.groupBy("fact_id").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first")).filter("n > 1")
    return l.join(several, "fact_id").select("fact_id", "passage_id", (F.col("position") == F.col("first")).alias("head"))


@query("A38, Q13: statements of a batch kept one by one in order, those refused that repeat a kept one's numbers and words", None)
def sequential_dedup(t: Tables, floor: float = 0.8) -> DataFrame:
    """(id, kept_id): facts of the later batches that a kept one repeats, in order of id, within the facts that name the same numbers; those that
    name none are compared among themselves. Copies are walked once and each is given its copy's answer. Pairs that reach the floor are found by an
    exact prefix filter: sets that overlap so far share one of the rarest words of either, |x| - ceil(floor |x|) + 1 of them. The walk
    goes over the components of these pairs. Statements without words abstain."""
    from textloom.functions.columns import jaccard, numbers, words
    from textloom.operators.components import components

    rows = t.facts.filter("statement IS NOT NULL").select("id", F.array_join(numbers("statement"), " ").alias("n"), F.array_join(F.array_sort(F.array_distinct(words("statement"))), " ").alias("k")).filter("k <> ''")
    rows = rows.withColumn("h", F.unhex(F.sha2(F.concat_ws("\n", "n", "k"), 256)))
    first = stored(rows.groupBy("h").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("k").alias("k")))
    several = first.groupBy("n").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("g")).filter("c > 1").select("n", "g")
    met = stored(first.join(several, "n").select("g", "id", F.split("k", " ").alias("w")))  # g stands for the numbers
    df = met.select(F.explode("w").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    ranked = met.select("g", "id", F.explode("w").alias("word")).join(df, "word").groupBy("g", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "word"))), lambda x: x["word"]).alias("o"))
    least = F.size("o") - F.ceil(F.size("o") * floor - 1e-9).cast("int") + 1
    prefix = ranked.select("g", "id", F.size("o").alias("size"), F.posexplode(F.slice("o", F.lit(1), least)).alias("at", "word"))
    a, b = prefix.withColumnRenamed("id", "a"), prefix.select("g", "word", F.col("id").alias("b"), F.col("size").alias("other"), F.col("at").alias("there"))
    reach = F.least(F.col("size") - F.col("at"), F.col("other") - F.col("there"))  # words shared at most, if this is the first of them
    near = a.join(b, ["g", "word"]).filter((F.col("b") < F.col("a")) & (reach >= floor * (F.col("size") + F.col("other") - reach) - 1e-9)).select("a", "b").distinct()
    near = near.join(met.select(F.col("id").alias("a"), F.col("w").alias("wa")), "a").join(met.select(F.col("id").alias("b"), F.col("w").alias("wb")), "b")
    near = checkpointed(near.filter(jaccard(F.col("wa"), F.col("wb")) >= floor).select("a", "b"))

    def keep(group: list[tuple]):
        refused = set()
        for i, pairs in itertools.groupby(group, key=lambda r: r[1]):
            hit = next((k for *_, k in pairs if k not in refused), None)
            if hit is not None:
                refused.add(i)
                yield i, hit

    joined = near.join(components(near).withColumnRenamed("id", "a"), "a").select("component", "a", "b")
    refused = walked(joined, ["component"], ["a", "b"], keep, "first_id bigint, hit bigint")
    members = rows.select("id", "h").join(first.select("h", F.col("id").alias("first_id")), "h").join(refused, "first_id", "left")
    return members.filter("hit IS NOT NULL OR id <> first_id").select("id", F.coalesce("hit", "first_id").alias("kept_id"))


#: Passages that a fit holds at once; the rest waits in a local file.
FIT_BLOCK = 20_000


def factored(vectors, block: int, topics: int, draw: int, passes: int = 30):
    """(cohesion, k x terms factors of unit length) of one seeded draw. ``vectors`` is (ends, at, w): the passages' unit vectors one after the
    other. Each pass solves the passages' weights block by block under the factors and gathers the two sums that the factors' updates need."""
    import numpy as np

    ends, at, w = vectors
    k, width = min(topics, len(ends)), int(at.max()) + 1
    h = (np.random.default_rng(draw).random((k, width)) + 0.1).astype(np.float32)

    def solved():
        ht, hh = np.ascontiguousarray(h.T), h @ h.T
        for s in range(0, len(ends), block):
            e, start = ends[s : s + block], int(ends[s - 1]) if s else 0
            terms, values, sizes = np.asarray(at[start : e[-1]]), np.asarray(w[start : e[-1]]), np.diff(e, prepend=start)
            goal = np.add.reduceat(ht[terms] * values[:, None], e - sizes - start)
            own = np.full((len(e), k), 1 / k, dtype=np.float32)
            for _ in range(15):
                own *= goal / np.maximum(own @ hh, 1e-9)
            yield terms, values, np.repeat(np.arange(len(e)), sizes), own

    for _ in range(passes):
        inner, outer = np.zeros((k, k)), np.zeros((k, width))
        for terms, values, row, own in solved():
            inner += own.T @ own
            for j in range(k):
                outer[j] += np.bincount(terms, own[row, j] * values, width)
        for _ in range(3):
            h = (h * outer / np.maximum(inner @ h, 1e-9)).astype(np.float32)
    summed, count = np.zeros((k, width)), np.zeros(k)
    for terms, values, row, own in solved():
        of = own.argmax(axis=1)
        count += np.bincount(of, minlength=k)
        summed += np.bincount(of[row] * width + terms, values, k * width).reshape(k, width)
    cohesion = float(np.mean([((x**2).sum() - c) / (c * (c - 1)) for x, c in zip(summed, count) if c > 1] or [0]))
    return cohesion, h / np.maximum(np.linalg.norm(h, axis=1, keepdims=True), 1e-12)


def fits(topics: int, block: int):
    """For mapInArrow: (language, draw, cohesion, topic, at, h) of rows (language, draw, at, w) in order of language and draw."""
    import tempfile

    import numpy as np
    import pyarrow as pa

    def fit(batches):
        now, files, sizes = None, None, []

        def done():
            for f in files:
                f.flush()
            vectors = [np.memmap(f, dtype=d, mode="r") for f, d in zip(files, (np.int32, np.float32))]
            cohesion, h = factored((np.cumsum(np.concatenate(sizes)), *vectors), block, topics, now[1])
            kept = [np.flatnonzero(x > 1e-6) for x in h]
            for f in files:
                f.close()
            return pa.RecordBatch.from_pylist([{"language": now[0], "draw": now[1], "cohesion": cohesion, "topic": j, "at": x, "h": h[j, x].astype(float)} for j, x in enumerate(kept)], schema=pa.schema([("language", pa.string()), ("draw", pa.int32()), ("cohesion", pa.float64()), ("topic", pa.int32()), ("at", pa.list_(pa.int32())), ("h", pa.list_(pa.float64()))]))

        for b in batches:
            keys = list(zip(b["language"].to_pylist(), b["draw"].to_pylist()))
            s = 0
            while s < len(keys):
                e = next((i for i in range(s, len(keys)) if keys[i] != keys[s]), len(keys))
                if keys[s] != now:
                    if now is not None:
                        yield done()
                    now, files, sizes = keys[s], (tempfile.TemporaryFile(), tempfile.TemporaryFile()), []
                part = b.slice(s, e - s)
                files[0].write(part["at"].flatten().to_numpy().astype(np.int32).tobytes())
                files[1].write(part["w"].flatten().to_numpy().astype(np.float32).tobytes())
                sizes.append(part["at"].value_lengths().to_numpy().astype(np.int64))
                s = e
        if now is not None:
            yield done()

    return fit


@query("G01, G02: topics of each language by non-negative factors of tf-idf, memberships above a floor", None)
def topic_memberships(t: Tables, topics: int = 8, floor: float = 0.15, draws: int = 8) -> DataFrame:
    """(id, language, topic, weight). The factors are fitted per language on all its passages and all terms within the document-frequency bounds, in
    ``draws`` seeded draws, of which the one with the most cohesive topics is kept; a task makes one draw of one language and keeps the passages in a
    local file, so that it holds a block of them and the factors only."""
    x = t.passage_vocabulary.filter("language IS NOT NULL").select("id", "language", F.explode("lemmas").alias("x")).select("id", "language", F.lower(F.trim("x")).alias("term")).filter("term <> ''")
    tf = x.groupBy("id", "language", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("language", "term").agg(F.count(F.lit(1)).alias("df"))
    n = tf.groupBy("language").agg(F.countDistinct("id").alias("n"))
    kept = df.join(n, "language").filter("df >= 3 AND df <= 0.5 * n").withColumn("at", F.row_number().over(Window.partitionBy("language").orderBy("term")) - 1)
    weighted = tf.join(kept.select("language", "term", "at", F.log2(F.col("n") / F.col("df")).alias("idf")), ["language", "term"]).select("id", "language", "at", (F.col("tf") * F.col("idf")).alias("w"))
    v = weighted.groupBy("id", "language").agg(F.array_sort(F.collect_list(F.struct("at", "w"))).alias("v"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("l"))
    rows = stored(v.select("id", "language", F.transform("v", lambda e: e["at"]).alias("at"), F.transform("v", lambda e: (e["w"] / F.col("l")).cast("float")).alias("w")))
    languages = rows.select("language").distinct().limit(1000).count()
    each = rows.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1)))).repartitionByRange(max(1, languages * draws), "language", "draw")
    found = checkpointed(each.sortWithinPartitions("language", "draw", "id").select("language", "draw", "at", "w").mapInArrow(fits(topics, FIT_BLOCK), "language string, draw int, cohesion double, topic int, at array<int>, h array<double>"))
    best = found.groupBy("language").agg(F.max(F.struct("cohesion", (-F.col("draw")).alias("draw"))).alias("m")).select("language", (-F.col("m.draw")).alias("draw"))
    factors = found.join(best, ["language", "draw"]).select("language", "topic", F.explode(F.arrays_zip("at", "h")).alias("e")).select("language", "topic", "e.at", "e.h")
    units = rows.select("id", "language", F.explode(F.arrays_zip("at", "w")).alias("e")).select("id", "language", "e.at", F.col("e.w").cast("double").alias("w"))
    placed = units.join(factors, ["language", "at"]).groupBy("id", "language", "topic").agg(F.sum(F.col("w") * F.col("h")).alias("dot"))
    return placed.select("id", "language", "topic", F.least(F.lit(1.0), F.round("dot", 6)).alias("weight")).filter(F.col("weight") >= floor)
