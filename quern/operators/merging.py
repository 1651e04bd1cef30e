"""Interval merging, neighbours, overlap-aware joining, budgets and carried headers."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: Sequence[str], start: str, end: str, *aggs: Column, gap: int = 0) -> DataFrame:
    """keys, start, end, n and ``aggs`` of each run of intervals that overlap or touch (within ``gap``)."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    far = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    g = df.withColumn("_new", F.when(far.isNull() | (F.col(start) > far + gap), 1).otherwise(0)).withColumn("_run", F.sum("_new").over(w))
    return g.groupBy(*keys, "_run").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n"), *aggs).drop("_run")


def sessions(df: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """key, started, ended, n: runs of events no further apart than the gap."""
    w = Window.partitionBy(key).orderBy(ts)
    t = F.col(ts).cast("timestamp")
    new = F.when(F.unix_micros(t) - F.unix_micros(F.lag(t).over(w)) > gap_seconds * 1_000_000, 1).otherwise(0)
    s = df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    return s.groupBy(key, "_run").agg(F.min(ts).alias("started"), F.max(ts).alias("ended"), F.count("*").alias("n")).drop("_run")


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], id_col: str) -> DataFrame:
    """The rows with the id before and after each in its group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("prev_id", F.lag(id_col).over(w)).withColumn("next_id", F.lead(id_col).over(w))


def expand_text(df: DataFrame, keys: Sequence[str], order: Sequence[str], text: str, least: int = 350, most: int = 850) -> DataFrame:
    """``expanded``: a text shorter than ``least`` with neighbours of its group, nearest first, until it is long enough or the group ends, cut at ``most``; longer texts stay whole."""
    own = F.coalesce(F.col(text), F.lit(""))
    w = Window.partitionBy(*keys).orderBy(*order)
    # no walk goes past a text of ``least``, and each other one adds its length and a line end, so a range of summed lengths holds all it can meet
    g = df.withColumn("_p", F.row_number().over(w)).withColumn("_s", F.sum(F.when(own != "", F.least(F.length(own), F.lit(least)) + 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    near = Window.partitionBy(*keys).orderBy("_s").rangeBetween(-2 * least - 1, 2 * least + 1)
    g = g.withColumn("_near", F.collect_list(F.when(own != "", F.struct("_p", F.substring(own, 1, max(least, most)).alias("t")))).over(near))
    met = F.array_sort(F.transform(F.filter("_near", lambda x: x["_p"] != F.col("_p")), lambda x: F.struct(F.abs(x["_p"] - F.col("_p")).alias("d"), (x["_p"] > F.col("_p")).alias("after"), x["t"].alias("t"))))
    # the two neighbours at one distance come together
    start = F.struct(own.alias("out"), F.lit(0).alias("d"), F.lit(True).alias("on"))

    def step(s: Column, x: Column) -> Column:
        on = F.when(x["d"] == s["d"], s["on"]).otherwise(F.length(s["out"]) < least)
        out = F.when(~on, s["out"]).when(x["after"], F.concat(s["out"], F.lit("\n"), x["t"])).otherwise(F.concat(x["t"], F.lit("\n"), s["out"]))
        return F.struct(out.alias("out"), x["d"].alias("d"), on.alias("on"))

    full = F.aggregate(met, start, step, lambda s: s["out"])
    return g.withColumn("expanded", F.when(F.length(own) < least, F.substring(full, 1, most)).otherwise(own)).drop("_p", "_s", "_near")


def join_overlapping(a: str, b: str, least: int = 1, window: int = 2000) -> str:
    """``a`` and ``b`` with the longest end of ``a`` that ``b`` begins with kept once."""
    tail = a[-window:]
    for n in range(min(len(tail), len(b)), least - 1, -1):
        if tail.endswith(b[:n]):
            return a + b[n:]
    return a + b


def stitch(df: DataFrame, key: str, order: str, text: str, least: int = 1) -> DataFrame:
    """key, text: the pieces of each key in order, joined with what they share once; a key's pieces make up one text."""
    kind = df.schema[key].dataType.simpleString()

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out = ""
        for t in pdf.sort_values(order)[text]:
            out = join_overlapping(out, t or "", least)
        return pd.DataFrame({key: [pdf[key].iloc[0]], text: [out]})

    return df.select(key, order, text).groupBy(key).applyInPandas(one, f"{key} {kind}, {text} string")


def batches(df: DataFrame, key: str, order: Sequence[str], size: str, budget: int) -> DataFrame:
    """``batch``: rows in order put together until the next would pass the budget; one larger than it stands alone."""
    cols = [*df.columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", batch int"

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable")
        out, used, b = [], 0, 0
        for s in pdf[size]:
            s = int(s or 0)
            if used and used + s > budget:
                b, used = b + 1, 0
            used += s
            out.append(b)
        return pdf[cols].assign(batch=out)

    return df.groupBy(key).applyInPandas(one, schema)


def fair_shares(needs: Sequence[int], total: int) -> list[int]:
    """Max-min fair whole shares: small needs are met, the rest is split evenly, earlier ones first for what remains."""
    shares, left, open_ = [0] * len(needs), total, sorted(range(len(needs)), key=lambda i: (needs[i], i))
    while open_:
        each = left // len(open_)
        if needs[open_[0]] <= each:
            i = open_.pop(0)
            shares[i] = max(0, needs[i])
            left -= shares[i]
        else:
            extra = left - each * len(open_)
            for k, i in enumerate(sorted(open_)):
                shares[i] = each + (1 if k < extra else 0)
            break
    return shares


def breadcrumbs(lines: DataFrame, doc: str, no: str, text: str, levels: int = 3) -> DataFrame:
    """``crumb``: the headings in force at each line, outermost first, parted by `` > ``."""
    w = Window.partitionBy(doc).orderBy(no).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = lines.withColumn("_lv", F.length(F.regexp_extract(text, r"^(#{1,6}) ", 1)))
    crumbs = []
    for lv in range(1, levels + 1):
        # the last heading of this level, unless a higher one came after it
        own = F.max(F.when(F.col("_lv") == lv, F.struct(F.col(no).alias("n"), F.regexp_replace(text, r"^#{1,6} +", "").alias("t")))).over(w)
        above = F.max(F.when((F.col("_lv") > 0) & (F.col("_lv") < lv), F.col(no))).over(w)
        crumbs.append(F.when(above.isNull() | (own["n"] > above), own["t"]))
    return out.withColumn("crumb", F.concat_ws(" > ", *crumbs)).drop("_lv")


def table_headers(lines: DataFrame, doc: str, no: str, text: str) -> DataFrame:
    """``header``: for a row of a Markdown table, the header row of that table."""
    w = Window.partitionBy(doc).orderBy(no)
    row = F.coalesce(F.col(text).rlike(r"^\s*\|.*\|\s*$"), F.lit(False))
    l1 = lines.withColumn("_row", row).withColumn("_first", F.col("_row") & ~F.coalesce(F.lag("_row").over(w), F.lit(False)))
    l2 = l1.withColumn("header", F.when(F.col("_row"), F.last(F.when(F.col("_first"), F.col(text)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return l2.drop("_row", "_first")
