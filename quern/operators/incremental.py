"""Cursors, differences, versions and per-key state of growing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def after_cursor(df: DataFrame, ts: str, id_col: str, cursor: tuple | None) -> DataFrame:
    """Rows strictly after the cursor (timestamp, id), of rows of one id the latest, then the one with the greater hash; null takes all."""
    if cursor is not None:
        t, i = F.lit(cursor[0]).cast(df.schema[ts].dataType), cursor[1]
        df = df.where((F.col(ts) > t) | ((F.col(ts) == t) & (F.col(id_col) > i)))
    tie = F.xxhash64(*df.columns)
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc_nulls_last(ts), F.desc(tie)))).where("_r = 1").drop("_r")


def watermark(df: DataFrame, ts: str, id_col: str, cursor: tuple | None = None) -> tuple | None:
    """The greatest (timestamp, id) of a batch, never before the cursor."""
    m = df.agg(F.max(F.struct(ts, id_col)).alias("m")).first()["m"]
    new = (m[ts], m[id_col]) if m is not None else None
    return cursor if new is None or cursor is not None and cursor >= new else new


def gaps(df: DataFrame, key: str, ts: str, id_col: str, signal: str, samples: int = 5) -> DataFrame:
    """key, hits, signals, last_ids (at most ``samples``), first_seen, last_seen: the state of each key."""
    df = df.where(F.col(key).isNotNull())
    # the latest ids are cut before they are collected, the rest is partial aggregates: a hot key stays small
    g = df.groupBy(key).agg(F.count("*").alias("hits"), F.array_sort(F.collect_set(signal)).alias("signals"), F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"))
    return g.join(last_ids(df, key, ts, id_col, samples).withColumnRenamed("ids", "last_ids"), key).select(key, "hits", "signals", "last_ids", "first_seen", "last_seen")


def last_ids(df: DataFrame, key: str, ts: str, id_col: str, n: int = 5) -> DataFrame:
    """key, ids: the ``n`` latest ids of each key, cut before they are collected, so a hot key stays small."""
    r = df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(ts), F.desc(id_col)))).where(F.col("_r") <= n)
    return r.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", id_col))), lambda s: s[id_col]).alias("ids"))


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """keys, action: ``add``, ``remove``, ``change`` or ``same`` for every key of either side; nulls equal each other."""
    h = lambda d, n: d.select(*keys, F.struct(*values).alias(n), F.lit(True).alias(f"_{n}"))
    j = h(old, "a").join(h(new, "b"), list(keys), "full")
    act = F.when(F.col("_a").isNull(), "add").when(F.col("_b").isNull(), "remove").when(F.col("a").eqNullSafe(F.col("b")), "same").otherwise("change")
    return j.select(*keys, act.alias("action"))


def _one_each(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of each key, the greatest in the order of the other columns."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_m")).select(*(F.col(c) if c in keys else F.col(f"_m.{c}").alias(c) for c in df.columns))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with equal keys; of several new rows of a key the greatest in the order of its columns."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(_one_each(new, keys))


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` and those rows of ``new`` whose keys it hasn't."""
    return old.unionByName(_one_each(new, keys).join(old.select(*keys).distinct(), list(keys), "left_anti"))


def unchanged_suppressed(seen: DataFrame, batch: DataFrame, key: str, content: str) -> DataFrame:
    """Rows of a batch whose key is new or whose content's fingerprint differs from the one seen."""
    s = seen.select(key, F.col("fingerprint").alias("_old"))
    b = batch.withColumn("fingerprint", F.sha2(F.coalesce(F.col(content).cast("string"), F.lit("")), 256))
    return b.join(s, key, "left").where(F.col("_old").isNull() | (F.col("_old") != F.col("fingerprint"))).drop("_old")


def versions(df: DataFrame, key: str, order: Sequence[str], content: str) -> DataFrame:
    """``version`` from 1 for each change of content of a key, in order; equal neighbours share one."""
    w = Window.partitionBy(key).orderBy(*order)
    new = F.when(F.lag(content).over(w).eqNullSafe(F.col(content)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_n", new).withColumn("version", F.sum("_n").over(w).cast("int")).drop("_n")


def as_of(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str, value: str) -> DataFrame:
    """``left`` with the ``value`` of the latest row of ``right`` at or before it; one sort for both sides, no range join."""
    u = left.select("*", F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.col(lts).alias("_t"), F.lit(1).alias("_side"))
    r = right.select(*(F.col(key) if c == key else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns), F.col(value).alias("_v"), F.col(rts).alias("_t"), F.lit(0).alias("_side"))
    w = Window.partitionBy(key).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return u.unionByName(r).withColumn(value, F.last("_v", ignorenulls=True).over(w)).where("_side = 1").select(*left.columns, value)


def sliding_limit(df: DataFrame, key: str, ts: str, seconds: int, most: int) -> DataFrame:
    """``admitted``: greedy sliding-window admission in order of time; rejected rows don't count."""
    cols = [f.name for f in df.schema]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", admitted boolean"

    def one(pdf):
        from collections import deque

        pdf = pdf.sort_values([ts], kind="stable")
        held, out = deque(), []
        for t in pdf[ts]:
            while held and (t - held[0]).total_seconds() >= seconds:
                held.popleft()
            out.append(len(held) < most)
            if out[-1]:
                held.append(t)
        return pdf[cols].assign(admitted=out)

    return df.groupBy(key).applyInPandas(one, schema)


def retain(df: DataFrame, ts: str, cutoff) -> DataFrame:
    """Rows at or after the cutoff; rows without a time stay."""
    return df.where(F.col(ts).isNull() | (F.col(ts) >= F.lit(cutoff)))
