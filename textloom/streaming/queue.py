"""Verbs of a work queue as transformations of its table, one micro-batch each.

A queue is (key, state, since, claimed_at, trigger, note). A verb changes only the rows that are in a state it may leave; all others pass through as they are,
so a verb that comes too late changes nothing. Workers are Spark tasks and need no row locks: a batch claims its rows by one transformation, and a
result lands only while its row is still held under the same claim time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.registry import Tables, query
from textloom.streaming.states import folded

# The states each verb may leave, and the state it leads to.
VERBS = {"start": (("new",), "pending"), "claim": (("pending",), "in_progress"), "finish": (("in_progress",), "done"), "fail": (("in_progress",), "failed"), "stop": (("pending", "in_progress"), "new"), "retry": (("failed",), "pending"), "reclaim": (("in_progress",), "pending"), "reset": (("done", "failed"), "new")}
COLUMNS = ["key", "state", "since", "claimed_at", "trigger", "note"]


def may(verb: str) -> Column:
    return F.col("state").isin(*VERBS[verb][0])


def changed(rows: DataFrame, where: Column, **values: Column) -> DataFrame:
    """``rows`` with ``values`` in the columns named where ``where`` holds; null counts as not."""
    on = F.coalesce(where, F.lit(False))
    return rows.select(*[F.when(on, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in rows.columns])


def verb(rows: DataFrame, name: str, where: Column | None = None, at: Column | None = None, trigger: str | None = None, note: Column | None = None) -> DataFrame:
    """One verb on the rows that it may change and ``where`` selects. Whatever leaves 'in_progress' gives up its claim."""
    values = {"state": F.lit(VERBS[name][1]), "claimed_at": at if VERBS[name][1] == "in_progress" else F.lit(None).cast("timestamp_ntz")}
    if trigger is not None:
        values["trigger"] = F.lit(trigger)
    values["note"] = note if note is not None else F.lit(None).cast("string")
    return changed(rows, may(name) & (F.lit(True) if where is None else where), **values)


def claimed(rows: DataFrame, n: int, now: Column) -> DataFrame:
    """The ``n`` pending rows that wait longest (ties by key) are claimed at once; the rest is left."""
    first = rows.filter(may("claim")).orderBy("since", "key").limit(n).select("key", F.lit(True).alias("mine"))
    return verb(rows.join(first, "key", "left"), "claim", F.col("mine"), now).select(*COLUMNS)


def touched(rows: DataFrame, beats: DataFrame) -> DataFrame:
    """Heartbeats (key, claimed_at, at) renew the claims that they hold."""
    last = beats.groupBy("key", "claimed_at").agg(F.max("at").alias("at")).select(F.col("key").alias("of"), F.col("claimed_at").alias("under"), "at")
    held = rows.join(last, (rows["key"] == F.col("of")) & (rows["claimed_at"] == F.col("under")), "left")
    return changed(held, may("finish") & F.col("at").isNotNull(), claimed_at=F.greatest("at", "claimed_at")).select(*COLUMNS)


def finished(rows: DataFrame, results: DataFrame) -> DataFrame:
    """Results (key, claimed_at, outcome, note) land while their row is held under the same claim; others are late and dropped. ``outcome`` is done or
    failed; of several for one claim the smallest counts."""
    one = results.groupBy("key", "claimed_at").agg(F.min(F.struct("outcome", "note")).alias("r")).select(F.col("key").alias("of"), F.col("claimed_at").alias("under"), "r")
    met = rows.join(one, (rows["key"] == F.col("of")) & (rows["claimed_at"] == F.col("under")), "left")
    lands = may("finish") & F.col("of").isNotNull()
    return changed(met, lands, state=F.col("r.outcome"), note=F.col("r.note"), claimed_at=F.lit(None).cast("timestamp_ntz")).select(*COLUMNS)


def swept(rows: DataFrame, now: Column, lease: str) -> DataFrame:
    """Claims older than the lease fail as abandoned."""
    return verb(rows, "fail", F.col("claimed_at") < now - F.expr(f"INTERVAL {lease}"), note=F.lit("abandoned"))


def drained(rows: DataFrame, now: Column, lease: str, work: Callable[[DataFrame], DataFrame], n: int = 1_000_000) -> DataFrame:
    """Sweeps abandoned claims first, then claims what is pending, ``n`` rows at a time, until nothing is; ``work`` makes results of claimed rows."""
    from textloom.session import checkpointed

    rows = checkpointed(swept(rows, now, lease))
    while not rows.filter(may("claim")).isEmpty():
        rows = checkpointed(claimed(rows, n, now))
        rows = checkpointed(finished(rows, work(rows.filter((F.col("state") == "in_progress") & (F.col("claimed_at") == now)))))
    return rows


def reloading(load: Callable[[], dict], step: Callable[[DataFrame, dict], None]) -> Callable[[DataFrame, int], None]:
    """A step of foreachBatch that reads the settings anew for each micro-batch."""

    def run(batch: DataFrame, epoch: int) -> None:
        step(batch, load())

    return run


def flushing(write: Callable[[DataFrame], None], least: int = 1000) -> tuple[Callable[[DataFrame, int], None], Callable[[], None]]:
    """(step, flush): annotations of micro-batches are kept as a stored table until ``least`` rows wait, then written at once; ``flush`` writes what waits."""
    from textloom.session import stored

    waiting: list[DataFrame] = []

    def flush() -> None:
        if waiting:
            rows = waiting[0]
            for more in waiting[1:]:
                rows = rows.unionByName(more)
            write(rows)
            waiting.clear()

    def step(batch: DataFrame, epoch: int) -> None:
        kept = stored(batch)
        waiting.append(kept)
        if sum(x.count() for x in waiting) >= least:
            flush()

    return step, flush


def queue(t: Tables) -> DataFrame:
    """The states of the log's keys as a queue; a row in progress is claimed since its last event."""
    rows = folded(t.events).select(F.col("user_id").alias("key"), "state", F.col("since").cast("timestamp_ntz").alias("since"))
    none = F.lit(None).cast("string")
    return rows.select("key", "state", "since", F.when(F.col("state") == "in_progress", F.col("since")).alias("claimed_at"), none.alias("trigger"), none.alias("note"))


def latest(t: Tables) -> Column:
    return F.lit(t.events.agg(F.max("ts").cast("timestamp_ntz")).first()[0]).cast("timestamp_ntz")


_QUEUE = """
WITH s AS (SELECT user_id AS key, arg_max(event_type, (ts, event_id)) AS e, max(ts) AS since FROM events GROUP BY 1),
q AS (SELECT key, CASE e WHEN 'signup' THEN 'new' WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'done' ELSE 'failed' END AS state, since FROM s),
r AS (SELECT key, state, since, CASE WHEN state = 'in_progress' THEN since END AS claimed_at, CAST(NULL AS VARCHAR) AS trigger, CAST(NULL AS VARCHAR) AS note FROM q), n AS (SELECT max(ts) AS now FROM events)
"""
_REST = "key, {} AS state, since, {} AS claimed_at, {} AS trigger, {} AS note"


@query("Q02: the rows that wait longest, claimed at once", _QUEUE + ", f AS (SELECT key FROM r WHERE state = 'pending' ORDER BY since, key LIMIT 50) SELECT " + _REST.format("CASE WHEN f.key IS NULL THEN state ELSE 'in_progress' END", "CASE WHEN f.key IS NULL THEN claimed_at ELSE now END", "trigger", "note") + " FROM r LEFT JOIN f USING (key), n")
def queue_claim(t: Tables) -> DataFrame:
    return claimed(queue(t), 50, latest(t))


@query("Q03: heartbeats renew the claims they hold; those under an older claim do nothing", _QUEUE + ", b AS (SELECT DISTINCT user_id AS of_key, ts AS under FROM events WHERE event_type = 'click') SELECT " + _REST.format("state", "CASE WHEN b.of_key IS NULL THEN claimed_at ELSE now END", "trigger", "note") + " FROM r LEFT JOIN b ON b.of_key = r.key AND b.under = r.claimed_at, n")
def queue_touch(t: Tables) -> DataFrame:
    clicks = t.events.filter("event_type = 'click'").select(F.col("user_id").alias("key"), F.col("ts").cast("timestamp_ntz").alias("claimed_at"), latest(t).alias("at"))
    return touched(queue(t), clicks)


@query("Q17, Q18: results land while their claim is held and leave a note; late ones are dropped", _QUEUE + ", b AS (SELECT DISTINCT user_id AS of_key, ts AS under FROM events WHERE event_type = 'click') SELECT " + _REST.format("CASE WHEN of_key IS NULL THEN state ELSE 'done' END", "CASE WHEN of_key IS NULL THEN claimed_at END", "trigger", "CASE WHEN of_key IS NULL THEN note ELSE 'by click' END") + " FROM r LEFT JOIN b ON of_key = r.key AND under = r.claimed_at")
def queue_finish(t: Tables) -> DataFrame:
    clicks = t.events.filter("event_type = 'click'").select(F.col("user_id").alias("key"), F.col("ts").cast("timestamp_ntz").alias("claimed_at"), F.lit("done").alias("outcome"), F.lit("by click").alias("note"))
    return finished(queue(t), clicks)


@query("Q05: failed rows queued again with what caused it", _QUEUE + "SELECT " + _REST.format("CASE WHEN state = 'failed' THEN 'pending' ELSE state END", "claimed_at", "CASE WHEN state = 'failed' THEN 'settings' END", "note") + " FROM r")
def queue_requeue(t: Tables) -> DataFrame:
    return verb(queue(t), "retry", trigger="settings")


@query("Q06: rows claimed long ago taken back", _QUEUE + "SELECT " + _REST.format("CASE WHEN old THEN 'pending' ELSE state END", "CASE WHEN NOT old THEN claimed_at END", "CASE WHEN old THEN 'reclaimed' END", "note") + " FROM (SELECT *, coalesce(state = 'in_progress' AND claimed_at < now - INTERVAL 2 DAY, false) AS old FROM r, n)")
def queue_reclaim(t: Tables) -> DataFrame:
    return verb(queue(t), "reclaim", F.col("claimed_at") < latest(t) - F.expr("INTERVAL 2 DAYS"), trigger="reclaimed")


@query("Q07, Q08: abandoned claims fail first, then all that is pending is claimed and worked off", _QUEUE + "SELECT " + _REST.format("CASE WHEN old THEN 'failed' WHEN state = 'pending' THEN 'done' ELSE state END", "CASE WHEN NOT old AND state = 'in_progress' THEN claimed_at END", "trigger", "CASE WHEN old THEN 'abandoned' WHEN state = 'pending' THEN 'worked' END") + " FROM (SELECT *, coalesce(state = 'in_progress' AND claimed_at < now - INTERVAL 2 DAY, false) AS old FROM r, n)")
def queue_drain(t: Tables) -> DataFrame:
    def work(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("note").isNull()).select("key", "claimed_at", F.lit("done").alias("outcome"), F.lit("worked").alias("note"))

    now = latest(t)
    rows = queue(t)
    # What was in progress before keeps its claim: only rows claimed at this moment are worked off.
    pending = rows.filter(F.col("state") == "pending")
    others = swept(rows.filter(F.col("state") != "pending"), now, "2 DAYS")
    return others.unionByName(drained(pending, now, "2 DAYS", work))
