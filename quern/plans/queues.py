"""Logs, queues, memories and proposals."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import pipeline as P
from quern.operators import queues as Q
from quern.plans.registry import query
from quern.runtime import table


def _ts(s):
    return F.lit(s).cast("timestamp_ntz")


@query("log_append", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2, event_id) - 1 AS \"offset\" FROM events WHERE user_id IS NOT NULL")
def _(spark, d):
    e = table(spark, d, "events").where("user_id is not null").select("user_id", "event_id")
    empty = e.limit(0).withColumn("offset", F.lit(0).cast("long"))
    log = Q.append(empty, e.where("event_id % 2 = 0"), "user_id", ["event_id"])
    return Q.append(log, e.where("event_id % 2 = 1"), "user_id", ["event_id"])


@query("log_tail", "WITH l AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS o FROM events WHERE user_id IS NOT NULL) SELECT user_id, event_id FROM l WHERE o >= user_id % 7 AND user_id IN (SELECT user_id FROM l GROUP BY 1 HAVING max(ts) > TIMESTAMP '2024-01-29')")
def _(spark, d):
    e = table(spark, d, "events").where("user_id is not null").select("user_id", "event_id", "ts")
    log = Q.append(e.limit(0).withColumn("offset", F.lit(0).cast("long")), e, "user_id", ["event_id"])
    readers = e.select("user_id", (F.col("user_id") % 7).alias("from_offset")).distinct()
    return Q.tail(log, "user_id", readers, "ts", _ts("2024-01-30"), 86400).select("user_id", "event_id")


_QUEUE = "q AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2024-01-02' WHEN o_orderkey % 7 = 0 THEN TIMESTAMP '2024-01-01' END AS claimed_at FROM orders), f AS (SELECT o_custkey FROM q GROUP BY 1 HAVING count(*) FILTER (WHERE claimed_at >= TIMESTAMP '2024-01-01 12:00:00') = 0 ORDER BY min(o_orderkey), o_custkey LIMIT 40)"


@query("queue_claim", f"WITH {_QUEUE} SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT o_custkey FROM f) THEN TIMESTAMP '2024-01-03' ELSE claimed_at END AS claimed_at FROM q")
def _(spark, d):
    k = F.col("o_orderkey")
    q = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(k % 5 == 0, _ts("2024-01-02")).when(k % 7 == 0, _ts("2024-01-01")).alias("claimed_at"))
    return Q.claim(q, "o_custkey", "o_orderkey", "claimed_at", _ts("2024-01-03"), _ts("2024-01-01 12:00:00"), 40).select("o_orderkey", "claimed_at")


@query("queue_release", "SELECT o_orderkey FROM orders WHERE o_custkey % 3 <> 0")
def _(spark, d):
    q = table(spark, d, "orders")
    return Q.release(q, "o_custkey", "o_orderdate", q.where("o_custkey % 3 = 0")).select("o_orderkey")


def _outbox(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", (k % 9).cast("int").alias("attempts"), F.when(k % 4 == 0, _ts("2024-01-01")).alias("delivered_at"), F.when(k % 3 == 0, _ts("2024-02-01")).when(k % 3 == 1, _ts("2024-01-01")).alias("next_at"))


@query("outbox_due", "SELECT o_orderkey FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderkey % 3 <> 0")
def _(spark, d):
    return Q.due(_outbox(spark, d), "delivered_at", "next_at", _ts("2024-01-15")).select("o_orderkey")


@query("outbox_delivered", "WITH o AS (SELECT o_orderkey AS k, (o_orderkey % 9)::INT AS a, CASE WHEN o_orderkey % 4 = 0 THEN TIMESTAMP '2024-01-01' END AS dv, CASE o_orderkey % 3 WHEN 0 THEN TIMESTAMP '2024-02-01' WHEN 1 THEN TIMESTAMP '2024-01-01' END AS nx FROM orders), r AS (SELECT *, CASE WHEN dv IS NULL AND (nx IS NULL OR nx <= TIMESTAMP '2024-01-15') THEN k % 2 = 0 END AS ok FROM o) SELECT k AS o_orderkey, CASE WHEN ok = false THEN a + 1 ELSE a END AS attempts, CASE WHEN ok THEN TIMESTAMP '2024-01-15' ELSE dv END AS delivered_at, CASE WHEN ok = false THEN TIMESTAMP '2024-01-15' + to_seconds(least(30 * 2 ** a, 3600)::BIGINT) ELSE nx END AS next_at FROM r")
def _(spark, d):
    o = _outbox(spark, d)
    sent = Q.due(o, "delivered_at", "next_at", _ts("2024-01-15")).select("o_orderkey", (F.col("o_orderkey") % 2 == 0).alias("ok"))
    return Q.delivered(o, sent, "o_orderkey", _ts("2024-01-15"))


@query("dead_letters", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber >= 5 AND l_returnflag = 'R'")
def _(spark, d):
    x = table(spark, d, "lineitem").withColumn("ok", F.col("l_returnflag") != "R")
    return Q.dead_letters(x, "l_orderkey", "l_linenumber", "ok", 5).select("l_orderkey", "l_linenumber")


@query("memory_consolidated", "WITH m AS (SELECT user_id, event_id, value, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS g FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL), s AS (SELECT user_id, g, sum(round(value)::BIGINT) AS t FROM m GROUP BY ALL), c AS (SELECT *, sum(t) OVER (PARTITION BY user_id ORDER BY g DESC ROWS UNBOUNDED PRECEDING) AS after, sum(t) OVER (PARTITION BY user_id) AS total FROM s) SELECT event_id, (total <= 3000 * 0.5 OR after <= 600) AS kept FROM m JOIN c USING (user_id, g)")
def _(spark, d):
    e = table(spark, d, "events").where("user_id is not null and value is not null").withColumn("tokens", F.round("value").cast("long")).withColumn("role", F.when(F.col("event_type") == "error", "tool").otherwise("user"))
    return Q.consolidated(e, "user_id", "event_id", "tokens", "role", 3000, 0.5, 600).select("event_id", "kept")


@query("mapping_proposal", "WITH k AS (SELECT DISTINCT field_id AS key, regexp_replace(lower(trim(field_id)), '[\\s_\\-]+', '', 'g') AS k FROM golden_records WHERE field_id IS NOT NULL), n AS (SELECT DISTINCT field_id AS f, regexp_replace(lower(trim(x)), '[\\s_\\-]+', '', 'g') AS n, x FROM (SELECT field_id, unnest([field_id || '_text', field_name, replace(field_id, '_', ' ')]) AS x FROM golden_records WHERE field_id IS NOT NULL) WHERE x IS NOT NULL), e AS (SELECT key, f, 0.9 AS s FROM k JOIN n ON k = n UNION ALL SELECT key, f, 0.6 FROM k JOIN n ON (contains(k, n) OR contains(n, k)) AND len(list_intersect(list_filter(regexp_split_to_array(lower(key), '[\\s_\\-]+'), lambda w: w <> ''), list_filter(regexp_split_to_array(lower(x), '[\\s_\\-]+'), lambda w: w <> ''))) > 0), b AS (SELECT key, f, max(s) AS s FROM e GROUP BY ALL), t AS (SELECT key, max(s) AS s FROM b GROUP BY 1) SELECT key, min(f) AS field_id, s::DOUBLE AS score, count(*) > 1 AS ambiguous FROM b JOIN t USING (key, s) GROUP BY key, s")
def _(spark, d):
    g = table(spark, d, "golden_records").where("field_id is not null")
    fields = g.select("field_id", F.array(F.concat("field_id", F.lit("_text")), F.col("field_name"), F.replace(F.col("field_id"), F.lit("_"), F.lit(" "))).alias("names")).distinct()
    return P.mapping_proposal(g.select(F.col("field_id").alias("key")), fields, "key", "field_id", "names").withColumn("score", F.col("score").cast("double"))


@query("pipeline_stages", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY 1")
def _(spark, d):
    p = P.Pipeline().add("filter", lambda x: x.where("o_totalprice > 1000")).add_if(False, "never", lambda x: x.limit(0)).add("count", lambda x: x.groupBy("o_orderstatus").agg(F.count("*").alias("n")))
    return p.run(table(spark, d, "orders"))


@query("parallel_map", "SELECT p_partkey, length(p_name)::INT AS result FROM part")
def _(spark, d):
    return P.parallel_map(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", lambda xs: [len(x) for x in xs], "int").select("p_partkey", "result")
