"""Streams over the events table, run to their end, with late rows dropped.

The events arrive in five files by event_id. One row in 37 is told to have
happened ten days earlier, so it comes late.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quern.plans.registry import query
from quern.runtime import shared_dir, table
from quern.streaming import engine as S

BATCHES, LATE = 5, "1 day"


def _events(spark, d):
    """The events as a stream of BATCHES files in the order of arrival."""
    e = table(spark, d, "events")
    most = e.agg(F.max("event_id")).first()[0] or 0
    e = e.withColumn("ts", F.when(F.col("event_id") % 37 == 5, F.col("ts") - F.expr("INTERVAL 10 DAYS")).otherwise(F.col("ts")))
    path = f"{shared_dir(spark)}/quern/arrivals-{uuid.uuid4().hex}"
    e = e.withColumn("_b", F.least(F.floor(F.col("event_id") * BATCHES / (most + 1)), F.lit(BATCHES - 1)))
    for k in range(BATCHES):
        e.where(F.col("_b") == k).drop("_b").coalesce(1).write.mode("append").parquet(path)
    return S.event_stream(spark, path)


# rows, the file they come in, and what is known of time when a file is worked on: a file's own rows count from the next one on, and late rows are told by the file before that
_E = """e AS (SELECT event_id, user_id, event_type, value, CASE WHEN event_id % 37 = 5 THEN ts - INTERVAL 10 DAY ELSE ts END AS ts, least(event_id * 5 // (SELECT max(event_id) + 1 FROM events), 4) AS b FROM events),
m AS (SELECT b, max(ts) AS m FROM e GROUP BY b), w AS (SELECT b.b, (SELECT max(m.m) FROM m WHERE m.b <= b.b - 2) - INTERVAL 1 DAY AS mark FROM m b)"""


@query("stream_tumbling", f"WITH {_E} SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM e JOIN w USING (b) WHERE mark IS NULL OR time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 DAY > mark GROUP BY ALL")
def _(spark, d):
    s = S.tumbling(_events(spark, d), "ts", "1 day", ["event_type"], F.count("*").alias("n"), F.sum("value").alias("total"), late=LATE)
    return S.run(s, ["start", "event_type"]).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("stream_sliding", f"WITH {_E}, s AS (SELECT time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') - to_hours(12 * k) AS start, mark FROM e JOIN w USING (b), (SELECT unnest([0, 1]) AS k)) SELECT start, count(*) AS n FROM s WHERE mark IS NULL OR start + INTERVAL 1 DAY > mark GROUP BY start")
def _(spark, d):
    s = S.tumbling(_events(spark, d), "ts", "1 day", [], F.count("*").alias("n"), late=LATE, slide="12 hours")
    return S.run(s, ["start"]).select(F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("stream_gap_state", f"WITH {_E} SELECT user_id::VARCHAR AS key, count(*) AS hits, list(event_id ORDER BY b DESC, ts DESC, event_id DESC)[1:5] AS last_ids, list_sort(list_distinct(list(event_type))) AS signals, 'open' AS status FROM e WHERE user_id IS NOT NULL GROUP BY user_id")
def _(spark, d):
    return S.run(S.gap_state(_events(spark, d), "user_id", "ts", "event_id", "event_type"), ["key"])


@query("stream_join", f"WITH {_E}, k AS (SELECT e.*, mark FROM e JOIN w USING (b) WHERE mark IS NULL OR ts > mark) SELECT a.event_id, b.event_id AS before_id FROM k a JOIN k b ON a.user_id = b.user_id AND a.event_type = 'purchase' AND b.event_type = 'click' AND b.ts <= a.ts AND b.ts >= a.ts - INTERVAL 1 HOUR")
def _(spark, d):
    e = _events(spark, d)
    a = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    b = e.where("event_type = 'click'").select(F.col("event_id").alias("before_id"), F.col("user_id").alias("r_user_id"), F.col("ts").alias("r_ts"))
    return S.run(S.interval_join(a, b, "user_id", "ts", "r_ts", "1 HOUR", late=LATE), [], "append").select("event_id", "before_id")


@query("stream_without_repeats", f"WITH {_E} SELECT DISTINCT event_id FROM e JOIN w USING (b) WHERE mark IS NULL OR ts > mark")
def _(spark, d):
    return S.run(S.without_repeats(_events(spark, d), "ts", ["event_id"], late=LATE).select("event_id"), [], "append")
