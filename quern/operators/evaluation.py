"""Question-answer sets for evaluation: queries, corpus, answers and the relations between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def qa_pairs(queries: DataFrame, corpus: DataFrame, answers: DataFrame, qrels: DataFrame, qas: DataFrame) -> DataFrame:
    """qid, question, answer, pids, passages: of each query its answer ('' for none, of several the least id) and its passages in order of their ids.

    Relations to unknown passages or answers are left out; repeated ones count once.
    """
    a = qas.join(answers.select(F.col("id").alias("aid"), F.col("text").alias("answer")), "aid").groupBy("qid").agg(F.min(F.struct("aid", "answer"))["answer"].alias("answer"))
    p = qrels.select("qid", "pid").distinct().join(corpus.select(F.col("id").alias("pid"), F.col("text").alias("passage")), "pid")
    p = p.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("pid", "passage"))).alias("p"))
    q = queries.select(F.col("id").alias("qid"), F.col("text").alias("question")).join(a, "qid", "left").join(p, "qid", "left")
    none = lambda t: F.array().cast(t)
    return q.select("qid", "question", F.coalesce("answer", F.lit("")).alias("answer"), F.coalesce("p.pid", none(f"array<{corpus.schema['id'].dataType.simpleString()}>")).alias("pids"), F.coalesce("p.passage", none("array<string>")).alias("passages"))


def averages(results: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """keys, n and the mean of each metric over the queries; 0 over none."""
    g = results.groupBy(*keys) if keys else results
    return g.agg(F.count("*").alias("n"), *(F.coalesce(F.avg(m), F.lit(0.0)).alias(m) for m in metrics))


def statistics(queries: DataFrame, corpus: DataFrame, answers: DataFrame, qrels: DataFrame, qas: DataFrame) -> DataFrame:
    """One row: queries, passages, answers, relations, mean_passages of the queries that have any, answered (percent of all queries)."""
    one = lambda df, n: df.agg(F.count("*").alias(n))
    per = qrels.select("qid", "pid").distinct().groupBy("qid").agg(F.count("*").alias("n")).agg(F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean_passages"))
    out = one(queries, "queries")
    for df in (one(corpus, "passages"), one(answers, "answers"), one(qrels.distinct(), "relations"), per, qas.select("qid").distinct().agg(F.count("*").alias("_a"))):
        out = out.crossJoin(df)  # all of one row
    return out.withColumn("answered", F.when(F.col("queries") > 0, F.col("_a") * 100 / F.col("queries")).otherwise(F.lit(0.0))).drop("_a")


def sampled(queries: DataFrame, corpus: DataFrame, qrels: DataFrame, nq: int, extra: float = 0.2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(queries, corpus, qrels): the ``nq`` queries with the most relations (ties by id), their passages, and a share of further passages chosen by the hash of their id."""
    known = qrels.join(queries.select(F.col("id").alias("qid")), "qid", "left_semi").join(corpus.select(F.col("id").alias("pid")), "pid", "left_semi").select("qid", "pid").distinct()
    best = known.groupBy("qid").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "qid").limit(nq).select("qid")
    rel = known.join(best, "qid", "left_semi")
    used = rel.select(F.col("pid").alias("id")).distinct()
    other = corpus.join(used, "id", "left_anti").where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(extra * 1_000_000))
    return queries.join(best.withColumnRenamed("qid", "id"), "id", "left_semi"), corpus.join(used, "id", "left_semi").unionByName(other), rel
