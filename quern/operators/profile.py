"""Profiles of columns and keyword frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, n, nulls, total, mean, least, most, sd (population), all columns in one pass."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("n"), F.count_if(x.isNull()).alias("nulls"), F.sum(x).alias("total"), F.avg(x).alias("mean"), F.min(x).alias("least"), F.max(x).alias("most"), F.stddev_pop(x).alias("sd")))
    return df.agg(F.array(*aggs).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def quartiles(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, n, q1, median, q3 by place n // 4 and 3n // 4 in order (null below five values); the median is the mean of the middle two."""
    v = df.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("v"))
    w = Window.partitionBy(*keys)
    r = v.withColumn("i", F.row_number().over(w.orderBy("v")) - 1).withColumn("n", F.count("*").over(w))
    pick = lambda at: F.max(F.when(F.col("i") == at, F.col("v")))
    n = F.col("n")
    return r.groupBy(*keys, "n").agg(
        F.when(n >= 5, pick(F.floor(n / 4))).alias("q1"), ((pick(F.floor((n - 1) / 2)) + pick(F.floor(n / 2))) / 2).alias("median"), F.when(n >= 5, pick(F.floor(3 * n / 4))).alias("q3")
    )


def text_profile(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, n, chars, words, mean_chars, mean_words, distinct texts."""
    t = df.where(F.col(column).isNotNull()).select(*keys, F.length(column).alias("c"), F.size(T.words(F.col(column))).alias("w"), F.xxhash64(column).alias("h"))
    return t.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("c").alias("chars"), F.sum("w").alias("words"), F.avg("c").alias("mean_chars"), F.avg("w").alias("mean_words"), F.countDistinct("h").alias("n_distinct"))


def keyword_frequency(df: DataFrame, column: str, k: int = 20, keys: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most frequent words (Latin from three letters, Han runs from two), ties by word."""
    w = df.select(*keys, F.explode(F.regexp_extract_all(F.lower(F.col(column)), F.lit(r"([\x{4E00}-\x{9FFF}]{2,}|[a-zäöüßéèêàâçñáíóú]{3,})"), 1)).alias("word"))
    n = w.groupBy(*keys, "word").agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "word"))).where(F.col("rank") <= k)


def record_profile(df: DataFrame) -> DataFrame:
    """field, kind, n, nulls, n_distinct (estimated) of every column, in one pass."""
    aggs = [F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("kind"), F.count(F.col(f"`{f.name}`")).alias("n"), F.count_if(F.col(f"`{f.name}`").isNull()).alias("nulls")) for f in df.schema]
    return df.agg(F.array(*aggs).alias("p")).select(F.explode("p").alias("p")).select("p.*")
