"""Logs, claims, deliveries and memories kept in tables; every step gives the next state of its table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def append(log: DataFrame, new: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``log`` (key, offset, ..) with the rows of ``new`` behind it: each key's offsets go on from its last one, from 0."""
    last = log.groupBy(key).agg((F.max("offset") + 1).alias("_next"))
    n = new.withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1).join(last, key, "left")
    return log.unionByName(n.withColumn("offset", (F.coalesce("_next", F.lit(0)) + F.col("_i")).cast(log.schema["offset"].dataType)).drop("_i", "_next").select(*log.columns))


def tail(log: DataFrame, key: str, offsets: DataFrame, touched: str | None = None, now=None, ttl_seconds: int | None = None) -> DataFrame:
    """Rows at or after each reader's offset (key, from_offset); with a lifetime, keys whose last append is older are gone."""
    out = log.join(offsets, key).where(F.col("offset") >= F.col("from_offset")).drop("from_offset")
    if touched and ttl_seconds is not None:
        live = log.groupBy(key).agg(F.max(touched).alias("_t")).where(F.unix_seconds(F.col("_t").cast("timestamp")) + ttl_seconds > F.unix_seconds(F.lit(now).cast("timestamp"))).select(key)
        out = out.join(live, key, "left_semi")
    return out


def claim(queue: DataFrame, key: str, order: str, claimed_at: str, now, stale_before, limit: int) -> DataFrame:
    """The queue with ``claimed_at`` set to ``now`` for all rows of the first ``limit`` keys none of whose rows is held by a live claim; a claim before ``stale_before`` is dead."""
    t = queue.schema[claimed_at].dataType
    held = F.max((F.col(claimed_at).isNotNull() & (F.col(claimed_at) >= F.lit(stale_before).cast(t))).cast("int"))
    free = queue.groupBy(key).agg(held.alias("_h"), F.min(order).alias("_o")).where("_h = 0").orderBy("_o", key).limit(limit).select(key, F.lit(True).alias("_mine"))
    return queue.join(free, key, "left").withColumn(claimed_at, F.when(F.col("_mine"), F.lit(now).cast(t)).otherwise(F.col(claimed_at))).drop("_mine").select(*queue.columns)


def release(queue: DataFrame, key: str, claimed_at: str, done: DataFrame) -> DataFrame:
    """The queue without the rows of keys that are done."""
    return queue.join(done.select(key).distinct(), key, "left_anti")


def due(outbox: DataFrame, delivered: str, next_at: str, now) -> DataFrame:
    """Rows that aren't delivered and whose time has come (null: at once)."""
    return outbox.where(F.col(delivered).isNull() & (F.col(next_at).isNull() | (F.col(next_at) <= F.lit(now))))


def delivered(outbox: DataFrame, results: DataFrame, key: str, now, base_seconds: int = 30, most_seconds: int = 3600) -> DataFrame:
    """The outbox after a round (key, ok): delivered rows get their time, failed ones one attempt more and a pause that doubles up to a bound; others stay, so no failure blocks them."""
    t = outbox.schema["delivered_at"].dataType
    r = results.groupBy(key).agg(F.max("ok").alias("_ok"))
    j = outbox.join(r, key, "left")
    tries = F.col("attempts") + F.when(~F.col("_ok"), 1).otherwise(0)
    pause = F.least(F.lit(base_seconds) * F.pow(F.lit(2), F.col("attempts")), F.lit(most_seconds)).cast("long")
    later = F.timestamp_seconds(F.unix_seconds(F.lit(now).cast("timestamp")) + pause).cast(t)
    return j.select(*(
        F.when(F.col("_ok"), F.lit(now).cast(t)).otherwise(F.col(c)).alias(c) if c == "delivered_at" else
        F.coalesce(tries, F.col(c)).cast(outbox.schema[c].dataType).alias(c) if c == "attempts" else
        F.when(~F.col("_ok"), later).otherwise(F.col(c)).alias(c) if c == "next_at" else F.col(c) for c in outbox.columns
    ))


def dead_letters(attempts: DataFrame, key: str, attempt: str, ok: str, most: int) -> DataFrame:
    """The failed rows of the last attempt that is allowed; earlier failures are retried, not kept."""
    return attempts.where((F.col(attempt) >= most) & ~F.col(ok))


def consolidated(messages: DataFrame, key: str, order: str, tokens: str, role: str, limit: int, threshold: float, keep: int) -> DataFrame:
    """``kept``: whether a message stays as it is or goes into the summary of the head.

    Only conversations of more than ``limit`` * ``threshold`` tokens are cut. The
    newest messages within ``keep`` tokens stay; an assistant's message and the
    tool answers that follow it stay or go together.
    """
    w = Window.partitionBy(key).orderBy(order)
    up_to = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = messages.withColumn("_g", F.sum(F.when(F.col(role) == "tool", 0).otherwise(1)).over(up_to))
    g = m.groupBy(key, "_g").agg(F.sum(tokens).alias("_t"))
    back = Window.partitionBy(key).orderBy(F.desc("_g")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = g.withColumn("_after", F.sum("_t").over(back)).withColumn("_all", F.sum("_t").over(Window.partitionBy(key)))
    return m.join(g.select(key, "_g", "_after", "_all"), [key, "_g"]).withColumn("kept", (F.col("_all") <= limit * threshold) | (F.col("_after") <= keep)).drop("_g", "_after", "_all")

