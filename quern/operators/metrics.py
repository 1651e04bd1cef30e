"""Retrieval, generation and extraction metrics."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _hits(found: Column, truth: Column) -> Column:
    return F.size(F.filter(found, lambda x: F.array_contains(truth, x)))


def precision_recall(found: Column, truths: Column) -> tuple[Column, Column]:
    """Means over the truth sets (array of arrays); empty lists have 0."""
    n, k = F.size(found), F.size(truths)
    p = F.aggregate(truths, F.lit(0.0), lambda s, t: s + F.when(n > 0, _hits(found, t) / n).otherwise(0.0))
    r = F.aggregate(truths, F.lit(0.0), lambda s, t: s + F.when(F.size(t) > 0, _hits(found, t) / F.size(t)).otherwise(0.0))
    return F.when(k > 0, p / k).otherwise(0.0), F.when(k > 0, r / k).otherwise(0.0)


def reciprocal_rank(found: Column, truths: Column) -> Column:
    """Mean over the truth sets of one over the first hit's place."""
    first = lambda t: F.aggregate(F.transform(found, lambda x, i: F.when(F.array_contains(t, x), 1 / (i + 1)).otherwise(0.0)), F.lit(0.0), lambda s, x: F.greatest(s, x))
    return F.when(F.size(truths) > 0, F.aggregate(truths, F.lit(0.0), lambda s, t: s + first(t)) / F.size(truths)).otherwise(0.0)


def average_precision(found: Column, truths: Column) -> Column:
    """Mean over the truth sets of the precision at each hit, divided by the hits found (not by the size of the truth)."""

    def ap(t: Column) -> Column:
        s = F.aggregate(found, F.struct(F.lit(0).alias("i"), F.lit(0).alias("h"), F.lit(0.0).alias("s")), lambda a, x: F.struct((a.i + 1).alias("i"), F.when(F.array_contains(t, x), a.h + 1).otherwise(a.h).alias("h"), F.when(F.array_contains(t, x), a.s + (a.h + 1) / (a.i + 1)).otherwise(a.s).alias("s")))
        return F.when(s.h > 0, s.s / s.h).otherwise(0.0)

    return F.when(F.size(truths) > 0, F.aggregate(truths, F.lit(0.0), lambda s, t: s + ap(t)) / F.size(truths)).otherwise(0.0)


def ndcg(found: Column, truths: Column, k: int) -> Column:
    """Gain 1 for any relevant id, discounted by log2, over the best order of as many relevant ids."""
    every = F.flatten(truths)
    some = F.slice(found, 1, k)
    disc = lambda i: 1 / F.log2(i + F.lit(2.0))
    dcg = F.aggregate(F.transform(some, lambda x, i: F.when(F.array_contains(every, x), disc(i)).otherwise(0.0)), F.lit(0.0), lambda s, x: s + x)
    n = F.least(F.size(F.array_distinct(every)), F.lit(k))
    ideal = F.aggregate(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), disc), F.lit(0.0), lambda s, x: s + x)
    return F.when(n > 0, dcg / ideal).otherwise(0.0)


def bleu(hypothesis: list[str], reference: list[str], n: int) -> float:
    """BLEU of orders 1..n over tokens in lower case, with one added to every count; orders with no match are skipped."""
    h, r = [x.lower() for x in hypothesis], [x.lower() for x in reference]
    if not h or not r:
        return 0.0
    logs = 0.0
    for k in range(1, n + 1):
        a, b = Counter(zip(*(h[i:] for i in range(k)))), Counter(zip(*(r[i:] for i in range(k))))
        p = (sum((a & b).values()) + 1) / (sum(a.values()) + 1)
        if p > 0:
            logs += math.log(p) / n
    return (math.exp(1 - len(r) / len(h)) if len(h) <= len(r) else 1.0) * math.exp(logs)


def rouge_n(hypothesis: list[str], reference: list[str], n: int) -> float:
    """F of distinct n-grams."""
    a, b = set(zip(*(hypothesis[i:] for i in range(n)))), set(zip(*(reference[i:] for i in range(n))))
    if not a or not b:
        return 0.0
    p, r = len(a & b) / len(a), len(a & b) / len(b)
    return 2 * p * r / (p + r + 1e-8)


def rouge_l(hypothesis: list[str], reference: list[str]) -> float:
    """F of the longest common subsequence."""
    if not hypothesis or not reference:
        return 0.0
    row = [0] * (len(reference) + 1)
    for x in hypothesis:
        prev = 0
        for j, y in enumerate(reference, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    p, r = row[-1] / len(hypothesis), row[-1] / len(reference)
    return 2 * p * r / (p + r + 1e-8)


def generation_scores(df: DataFrame, hypothesis: str, reference: str, *keys: str) -> DataFrame:
    """keys, bleu1, bleu2, bleu4, rouge1, rouge2, rougel of two token arrays."""

    @F.pandas_udf("bleu1 double, bleu2 double, bleu4 double, rouge1 double, rouge2 double, rougel double")
    def score(h: pd.Series, r: pd.Series) -> pd.DataFrame:
        rows = []
        for a, b in zip(h, r):
            a, b = list(a) if a is not None else [], list(b) if b is not None else []
            rows.append((bleu(a, b, 1), bleu(a, b, 2), bleu(a, b, 4), rouge_n(a, b, 1), rouge_n(a, b, 2), rouge_l(a, b)))
        return pd.DataFrame(rows, columns=["bleu1", "bleu2", "bleu4", "rouge1", "rouge2", "rougel"])

    return df.select(*keys, score(hypothesis, reference).alias("s")).select(*keys, "s.*")


def ppm(num: Column, den: Column) -> Column:
    """num * 1,000,000 // den as whole numbers; null where den is 0."""
    return F.when(den != 0, F.floor(num.cast("long") * 1_000_000 / den.cast("long")).cast("long"))


def iou_ppm(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of two boxes (x0, y0, x1, y1) in whole parts per million; null for empty boxes."""
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0))
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return ppm(w * h, area(a) + area(b) - w * h)


def extraction_eval(gold: DataFrame, predicted: DataFrame, keys: list[str], state: str = "tri_state", value: str = "value", by: str | None = None) -> DataFrame:
    """by, tp, fp, fn, hallucinated: a full outer alignment of gold and predicted fields.

    present on both sides with equal value is a hit, with another value both a
    false and a missed one; only gold present is missed; only predicted present
    is false, and hallucinated if gold has no value to base it on.
    """
    g = gold.select(*keys, F.col(state).alias("gs"), F.col(value).alias("gv"))
    p = predicted.select(*keys, F.col(state).alias("ps"), F.col(value).alias("pv"))
    j = g.join(p, keys, "full").withColumns({"gs": F.coalesce("gs", F.lit("unknown")), "ps": F.coalesce("ps", F.lit("unknown"))})
    gp, pp = F.col("gs") == "present", F.col("ps") == "present"
    same = F.coalesce(F.lower(F.trim("gv")) == F.lower(F.trim("pv")), F.lit(False))
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    grouped = j.groupBy(by) if by else j.groupBy()
    return grouped.agg(n(gp & pp & same).alias("tp"), n(pp & ~(gp & same)).alias("fp"), n(gp & ~(pp & same)).alias("fn"), n(pp & ~gp & F.col("gv").isNull()).alias("hallucinated"))


def confusion(gold: DataFrame, predicted: DataFrame, keys: list[str], state: str = "tri_state") -> DataFrame:
    """gold_state, predicted_state, n: the cells of the confusion of states, missing rows as unknown."""
    j = gold.select(*keys, F.col(state).alias("g")).join(predicted.select(*keys, F.col(state).alias("p")), keys, "full")
    return j.groupBy(F.coalesce("g", F.lit("unknown")).alias("gold_state"), F.coalesce("p", F.lit("unknown")).alias("predicted_state")).agg(F.count("*").alias("n"))


def majority(df: DataFrame, keys: list[str], value: str, least: int = 2) -> DataFrame:
    """keys, value, votes: the most frequent value of each key with at least ``least`` votes, ties by the lesser value."""
    v = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("votes"))
    best = v.groupBy(*keys).agg(F.min(F.struct((-F.col("votes")).alias("m"), F.col(value).alias("v"))).alias("b"))
    return best.where(-F.col("b.m") >= least).select(*keys, F.col("b.v").alias(value), (-F.col("b.m")).alias("votes"))


def regression(now: DataFrame, base: DataFrame, key: str, metric: str, tolerance: float) -> DataFrame:
    """key, now, base, verdict: ``fail`` if a metric fell by more than the tolerance or is missing now, ``skip`` without a base, else ``pass``."""
    j = base.select(key, F.col(metric).alias("base")).join(now.select(key, F.col(metric).alias("now")), key, "full")
    return j.withColumn("verdict", F.when(F.col("base").isNull(), "skip").when(F.col("now").isNull() | (F.col("base") - F.col("now") > tolerance), "fail").otherwise("pass"))
