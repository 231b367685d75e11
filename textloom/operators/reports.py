"""Dashboard and report queries: counts by stage and state, time buckets with gaps filled, percentiles and totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.registry import Tables, query


@query("D01, D02, A44: depth of each stage by state, in order of the stages, with what failed", """
SELECT 0 AS stage, parse_status AS state, count(*) AS n, count(*) FILTER (parse_status = 'failed') AS failed FROM documents GROUP BY 2 UNION ALL SELECT 1, extract_status, count(*), count(*) FILTER (extract_status = 'failed') FROM passages GROUP BY 2
UNION ALL SELECT 2, status, count(*), count(*) FILTER (status = 'rejected') FROM questions GROUP BY 2""")
def stage_depths(t: Tables) -> DataFrame:
    def depth(stage: int, df: DataFrame, state: str, failed: str) -> DataFrame:
        return df.groupBy(F.col(state).alias("state")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(state) == failed).alias("failed")).select(F.lit(stage).alias("stage"), "state", "n", "failed")

    parts = [depth(0, t.documents, "parse_status", "failed"), depth(1, t.passages, "extract_status", "failed"), depth(2, t.questions, "status", "rejected")]
    return reduce(DataFrame.unionByName, parts).orderBy("stage", "state")


@query("D03: refused facts by reason", "SELECT rejection_code, count(*) AS n FROM facts WHERE NOT validated GROUP BY 1 ORDER BY n DESC, rejection_code")
def refused_facts(t: Tables) -> DataFrame:
    return t.facts.filter("NOT validated").groupBy("rejection_code").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "rejection_code")


@query("D04, D07: facts by kind with the share accepted", "SELECT kind, count(*) AS n, count(*) FILTER (validated) AS accepted, round(100.0 * count(*) FILTER (validated) / nullif(count(*), 0), 1) AS percent FROM facts GROUP BY 1")
def facts_by_kind(t: Tables) -> DataFrame:
    n = F.count(F.lit(1))
    return t.facts.groupBy("kind").agg(n.alias("n"), F.count_if("validated").alias("accepted"), F.round(100.0 * F.count_if("validated") / F.nullif(n, F.lit(0)), 1).alias("percent"))


@query("D05, D09: questions by status and gate", "SELECT status, coalesce(rejected_reason, status) AS gate, count(*) AS n FROM questions GROUP BY 1, 2")
def questions_by_gate(t: Tables) -> DataFrame:
    return t.questions.groupBy("status", F.coalesce("rejected_reason", "status").alias("gate")).agg(F.count(F.lit(1)).alias("n"))


@query("D07, D08: a run's facts, what was accepted, and the spread of their confidence", """
SELECT run_id, count(*) AS written, count(*) FILTER (validated) AS accepted, round(quantile_cont(confidence, 0.95), 6) AS p95, round(sum(confidence), 4) AS total FROM facts WHERE run_id IS NOT NULL GROUP BY 1""")
def run_figures(t: Tables) -> DataFrame:
    return t.facts.filter("run_id IS NOT NULL").groupBy("run_id").agg(F.count(F.lit(1)).alias("written"), F.count_if("validated").alias("accepted"), F.round(F.percentile("confidence", 0.95), 6).alias("p95"), F.round(F.sum("confidence"), 4).alias("total"))


@query("D10, D11: events by type and attribute out of JSON, names stripped by pattern", """
SELECT trim(both 's' FROM event_type) AS shape, CAST(props ->> '$.k' AS INTEGER) // 10 AS model, count(*) AS calls, round(sum(value), 2) AS spend, round(avg(value), 6) AS mean, min(ts) AS first, max(ts) AS last FROM events WHERE regexp_replace(event_type, '[aeiou]', '', 'g') <> 'clck' GROUP BY 1, 2""")
def calls_by_shape(t: Tables) -> DataFrame:
    rows = t.events.filter(F.regexp_replace("event_type", "[aeiou]", "") != "clck")
    k = F.get_json_object("props", "$.k").cast("int")
    return rows.groupBy(F.btrim("event_type", F.lit("s")).alias("shape"), F.floor(k / 10).alias("model")).agg(
        F.count(F.lit(1)).alias("calls"), F.round(F.sum("value"), 2).alias("spend"), F.round(F.avg("value"), 6).alias("mean"), F.min("ts").alias("first"), F.max("ts").alias("last")
    )


@query("D12: scores by the kind of question and whether it is accepted, over four tables", """
SELECT q.question_type, f.kind, count(*) AS n, round(avg(f.confidence), 6) AS mean FROM questions q JOIN (SELECT DISTINCT * FROM question_facts) qf ON qf.question_id = q.id JOIN facts f ON f.id = qf.fact_id WHERE q.status = 'accepted' AND EXISTS (SELECT 1 FROM fact_passages fp WHERE fp.fact_id = f.id) GROUP BY 1, 2""")
def scores_by_kind(t: Tables) -> DataFrame:
    q = t.questions.filter("status = 'accepted'").select(F.col("id").alias("question_id"), "question_type")
    f = t.facts.join(t.fact_passages.select(F.col("fact_id").alias("id")), "id", "left_semi").select(F.col("id").alias("fact_id"), "kind", "confidence")
    return t.question_facts.distinct().join(q, "question_id").join(f, "fact_id").groupBy("question_type", "kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean"))


@query("D13, D16, D17, D18: events by hour and type", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, count(*) FILTER (value > 50) AS large FROM events GROUP BY 1, 2")
def hourly_events(t: Tables) -> DataFrame:
    return t.events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") > 50).alias("large")).select(F.col("w.start").alias("hour"), "event_type", "n", "large")


@query("D14, D15: percentiles and sums by day", """
SELECT date_trunc('day', ts) AS day, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, round(sum(value), 4) AS total FROM events GROUP BY 1""")
def daily_percentiles(t: Tables) -> DataFrame:
    p = F.percentile("value", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    rows = t.events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(p.alias("p"), F.round(F.sum("value"), 4).alias("total"))
    return rows.select("day", *[F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(("p50", "p95", "p99"))], "total")


@query("D19: errors by hour, hours without any kept as zero", """
WITH b AS (SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM events), (SELECT date_trunc('hour', max(ts)) FROM events), INTERVAL 1 HOUR)) AS hour), e AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT hour, coalesce(n, 0) AS n FROM b LEFT JOIN e USING (hour)""")
def errors_by_hour(t: Tables) -> DataFrame:
    ends = t.events.agg(F.date_trunc("hour", F.min("ts")).alias("a"), F.date_trunc("hour", F.max("ts")).alias("b"))
    hours = ends.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("hour")).select(F.col("hour").cast("timestamp_ntz").alias("hour"))
    e = t.events.filter("event_type = 'error'").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return hours.join(e, "hour", "left").fillna(0, ["n"])


@query("D21: spend by type and decile with a total row", """
SELECT CASE WHEN grouping(event_type) = 1 THEN 'TOTAL' ELSE event_type END AS type, CAST(floor(value / 100) AS BIGINT) AS band, round(sum(value), 3) AS spend FROM events GROUP BY GROUPING SETS ((event_type, floor(value / 100)), ())""")
def spend_with_total(t: Tables) -> DataFrame:
    rows = t.events.select("event_type", F.floor(F.col("value") / 100).alias("band"), "value").groupBy("event_type", "band").agg(F.sum("value").alias("s"))
    total = rows.agg(F.sum("s").alias("s")).select(F.lit("TOTAL").alias("type"), F.lit(None).cast("bigint").alias("band"), F.round("s", 3).alias("spend"))
    return rows.select(F.col("event_type").alias("type"), "band", F.round("s", 3).alias("spend")).unionByName(total)
