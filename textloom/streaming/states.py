"""Row states folded out of an event log, in batch and as Structured Streaming.

The stream functions take a streaming DataFrame; each also runs over a batch one, which is how the queries check them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.registry import Tables, query

# The state that each verb leaves a row in.
LEAVES = {"signup": "new", "view": "pending", "click": "in_progress", "purchase": "done", "error": "failed"}


def folded(log: DataFrame) -> DataFrame:
    """(user_id, state, since, changes): the latest state of every key; of simultaneous events the one with the largest id counts."""
    state = F.create_map(*[F.lit(x) for kv in LEAVES.items() for x in kv])[F.col("event_type")]
    last = F.max(F.struct("ts", "event_id", state.alias("state")))
    return log.groupBy("user_id").agg(last.alias("last"), F.count(F.lit(1)).alias("changes")).select("user_id", F.col("last.state").alias("state"), F.col("last.ts").alias("since"), "changes")


def tumbling(log: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts by window and type; over a stream, windows close as the watermark passes them."""
    return log.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def expiring(log: DataFrame, lease_ms: int = 300_000) -> DataFrame:
    """(user_id, outcome) over a stream: a key claimed by 'click' that nothing releases within the lease, by event time, expires; a release in time
    is on time. State is the claim time of a key alone."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key, batches, state: GroupState):
        claim = state.get[0] if state.exists else None
        out = []
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"user_id": [key[0]], "outcome": ["expired"]})
            return
        rows = pd.concat(list(batches)).sort_values("ts")
        for at, verb in zip(rows["ts"], rows["event_type"]):
            ms = int(at.timestamp() * 1000)
            if claim is not None and ms - claim > lease_ms:
                out.append("expired")
                claim = None
            if verb == "click":
                claim = ms
            elif claim is not None and verb in ("purchase", "error"):
                out.append("on_time")
                claim = None
        if claim is None:
            if state.exists:
                state.remove()
        else:
            state.update((claim,))
            state.setTimeoutTimestamp(max(claim + lease_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"user_id": [key[0]] * len(out), "outcome": out})

    return log.withWatermark("ts", "10 minutes").groupBy("user_id").applyInPandasWithState(step, "user_id bigint, outcome string", "claim bigint", "append", GroupStateTimeout.EventTimeTimeout)


@query("Q01: state of every key folded from the log", """
SELECT user_id, CASE arg_max(event_type, (ts, event_id)) WHEN 'signup' THEN 'new' WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'done' ELSE 'failed' END AS state, max(ts) AS since, count(*) AS changes FROM events GROUP BY 1""")
def status_fold(t: Tables) -> DataFrame:
    return folded(t.events)


@query("Q04, N17: claims that nothing released within a lease, and results that came too late", """
WITH n AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_at, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events)
SELECT event_id, user_id, next_type IN ('purchase', 'error') AS late_result FROM n WHERE event_type = 'click' AND (next_at IS NULL OR next_at > ts + INTERVAL 5 MINUTE)""")
def lease_expiry(t: Tables) -> DataFrame:
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = t.events.withColumn("next_at", F.lead("ts").over(by)).withColumn("next_type", F.lead("event_type").over(by))
    late = F.col("next_at").isNull() | (F.col("next_at") > F.col("ts") + F.expr("INTERVAL 5 MINUTES"))
    return rows.filter((F.col("event_type") == "click") & late).select("event_id", "user_id", F.col("next_type").isin("purchase", "error").alias("late_result"))


@query("Q10: hours in which more was done than in the hour before", """
WITH h AS (SELECT date_trunc('hour', ts) AS hour, count(*) FILTER (event_type = 'purchase') AS done FROM events GROUP BY 1), d AS (SELECT hour, done, done - lag(done, 1, 0) OVER (ORDER BY hour) AS rise FROM h) SELECT hour, done, rise FROM d WHERE rise > 0""")
def progress_rises(t: Tables) -> DataFrame:
    h = t.events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count_if(F.col("event_type") == "purchase").alias("done"))
    by = Window.partitionBy(F.lit(0)).orderBy("hour")  # one row an hour
    return h.withColumn("rise", F.col("done") - F.lag("done", 1, 0).over(by)).filter("rise > 0")


@query("Q09, Q12: events of a second delivery that the first did not have", "SELECT event_id FROM events WHERE event_id % 3 <> 0 EXCEPT SELECT event_id FROM events WHERE event_id % 2 = 0")
def new_arrivals(t: Tables) -> DataFrame:
    first, second = t.events.filter("event_id % 2 = 0").select("event_id"), t.events.filter("event_id % 3 <> 0").select("event_id")
    return second.join(first, "event_id", "left_anti")


@query("Q16 (extra): sliding windows over the log", """
WITH w AS (SELECT event_id, event_type, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS start FROM events) SELECT start, event_type, count(*) AS n FROM w GROUP BY 1, 2""")
def sliding_counts(t: Tables) -> DataFrame:
    return t.events.groupBy(F.window("ts", "2 hours", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


@query("Q16 (extra): sessions of each user, half an hour apart", """
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def sessions(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def streamed(t: Tables, name: str, plan, mode: str) -> DataFrame:
    """Runs a plan over the event table as a stream to its end and gives what it wrote, kept in the shared folder."""
    import uuid

    from textloom.session import shared_folder

    folder = f"{shared_folder(t.spark)}/streams/{name}-{uuid.uuid4().hex}"
    source = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    out = plan(source.withColumn("ts", F.col("ts").cast("timestamp")))
    writer = out.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{folder}/state")
    if mode == "append":
        writer.outputMode("append").format("parquet").start(f"{folder}/out").awaitTermination()
        return t.spark.read.schema(out.schema).parquet(f"{folder}/out")
    written: list[str] = []

    def keep(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/out/{epoch}")
        written.append(f"{folder}/out/{epoch}")

    writer.outputMode("complete").foreachBatch(keep).start().awaitTermination()
    return t.spark.read.schema(out.schema).parquet(written[-1]) if written else t.spark.createDataFrame([], out.schema)


@query("Q07, D13: hourly counts as a stream, drained", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_hourly(t: Tables) -> DataFrame:
    return streamed(t, "hourly", tumbling, "complete").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("Q01: states as a stream, drained", """
SELECT user_id, CASE arg_max(event_type, (ts, event_id)) WHEN 'signup' THEN 'new' WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'done' ELSE 'failed' END AS state, max(ts) AS since, count(*) AS changes FROM events GROUP BY 1""")
def stream_states(t: Tables) -> DataFrame:
    return streamed(t, "states", folded, "complete").withColumn("since", F.col("since").cast("timestamp_ntz"))


@query("Q04: leases by event time in a stateful stream", None)
def stream_leases(t: Tables) -> DataFrame:
    return streamed(t, "leases", expiring, "append")
