"""Sinks: versioned tables, row batches and bounded bulk payloads."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.runtime import _hadoop


def write_version(df: DataFrame, path: str, keep: int = 3) -> int:
    """Write ``df`` as the next version under ``path`` and drop those beyond the ``keep`` latest; readers of ``latest`` never see half a version."""
    spark = df.sparkSession
    have = versions(spark, path)
    n = (have[-1] if have else 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/v{n:08d}")
    fs, _ = _hadoop(spark, path)
    for old in [*have, n][: -max(1, keep)]:
        fs.delete(_hadoop(spark, f"{path}/v{old:08d}")[1], True)
    return n


def versions(spark: SparkSession, path: str) -> list[int]:
    """The whole versions under ``path``, oldest first."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and fs.exists(_hadoop(spark, f"{path}/{n}/_SUCCESS")[1]))


def latest(spark: SparkSession, path: str) -> DataFrame:
    have = versions(spark, path)
    if not have:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/v{have[-1]:08d}")


def write_batches(df: DataFrame, send: Callable[[list[dict]], None], size: int = 40) -> None:
    """Hand the rows to ``send`` in lists of at most ``size``; at least once, so ``send`` should replace by key."""

    def part(rows: Iterator) -> None:
        held: list[dict] = []
        for r in rows:
            held.append(r.asDict(recursive=True))
            if len(held) == size:
                send(held)
                held = []
        if held:
            send(held)

    df.foreachPartition(part)


def bulk_payloads(df: DataFrame, id_col: str, max_bytes: int = 1_000_000) -> DataFrame:
    """payload, n: lines of an action and its row in JSON, each payload within ``max_bytes`` (a single larger row alone)."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, used, n = [], 0, 0
        for pdf in it:
            out = []
            for key, row in zip(pdf["_id"], pdf["_row"]):
                line = json.dumps({"index": {"_id": key}}) + "\n" + row + "\n"
                b = len(line.encode())
                if held and used + b > max_bytes:
                    out.append(("".join(held), n))
                    held, used, n = [], 0, 0
                held.append(line)
                used, n = used + b, n + 1
            yield pd.DataFrame(out, columns=["payload", "n"])
        if held:
            yield pd.DataFrame([("".join(held), n)], columns=["payload", "n"])

    return df.select(F.col(id_col).cast("string").alias("_id"), F.to_json(F.struct(*df.columns)).alias("_row")).mapInPandas(run, "payload string, n int")


def vector_text(c: Column) -> Column:
    """A vector as the text that databases read: ``[1.0,2.0]``."""
    return F.when(c.isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: x.cast("string")), ","), F.lit("]")))


def relational_rows(index: DataFrame, embedding: str = "embedding") -> DataFrame:
    """Index rows for a relational store: the vector as text with its dimension, one row for each (source_id, chunk_id), the first by content."""
    cols = [c for c in index.columns if c != embedding]
    one = index.groupBy("source_id", "chunk_id").agg(F.min_by(F.struct(*index.columns), F.coalesce("content", F.lit(""))).alias("r")).select("r.*")
    return one.select(*cols, F.size(embedding).alias("dimension"), vector_text(F.col(embedding)).alias(embedding))


def search_tables(index: DataFrame, id_col: str, text: str, embedding: str) -> dict[str, DataFrame]:
    """``postings`` (term, id, tf) and one ``vectors_<dimension>`` table (id, embedding) for each dimension: what a full-text and vector store keeps beside its rows."""
    t = index.select(F.col(id_col).alias("id"), F.explode(T.cjk_tokens(F.col(text))).alias("term")).groupBy("term", "id").agg(F.count("*").alias("tf"))
    dims = [r["n"] for r in index.where(F.size(embedding) > 0).select(F.size(embedding).alias("n")).distinct().limit(101).collect()]
    if len(dims) > 100:
        raise ValueError("more than 100 dimensions")
    return {"postings": t, **{f"vectors_{n}": index.where(F.size(embedding) == n).select(F.col(id_col).alias("id"), embedding) for n in sorted(dims)}}


def sparse_vectors(docs: DataFrame, id_col: str, text: str, k1: float = 1.2, b: float = 0.75, buckets: int = 1 << 20) -> DataFrame:
    """id, sparse (a sorted array of (place, weight)): the BM25 weights of a document's words without their rarity, which the query side brings, at hashed places."""
    w = docs.select(F.col(id_col).alias("id"), T.words(F.col(text)).alias("ws")).where(F.size("ws") > 0)
    mean = w.agg(F.avg(F.size("ws")).alias("_mean"))
    tf = w.select("id", F.size("ws").alias("n"), F.explode("ws").alias("term")).groupBy("id", "n", F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("place")).agg(F.count("*").alias("tf"))
    weight = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n") / F.col("_mean")))
    return tf.crossJoin(F.broadcast(mean)).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", weight.alias("weight")))).alias("sparse"))  # mean is one row


def load_payloads(df: DataFrame, columns: list[str], max_bytes: int = 8_000_000) -> DataFrame:
    """payload, n, columns: rows as JSON lines within ``max_bytes`` for a store that loads streams; with ``columns`` alone other fields of its rows stay as they are."""
    lines = df.select(*columns)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, used = [], 0
        for pdf in it:
            out = []
            for row in pdf["_row"]:
                b = len(row.encode()) + 1
                if held and used + b > max_bytes:
                    out.append(("\n".join(held), len(held)))
                    held, used = [], 0
                held.append(row)
                used += b
            yield pd.DataFrame(out, columns=["payload", "n"])
        if held:
            yield pd.DataFrame([("\n".join(held), len(held))], columns=["payload", "n"])

    return lines.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("_row")).mapInPandas(run, "payload string, n int").withColumn("columns", F.lit(",".join(columns)))


def put_object(spark: SparkSession, path: str, content: bytes) -> str:
    """Write bytes to any file system that Spark knows (file, hdfs, s3a, gs, abfs, ..), whole or not at all; gives the path."""
    fs, p = _hadoop(spark, path)
    _, part = _hadoop(spark, f"{path}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"{path} was not written")
    return path


def get_object(spark: SparkSession, path: str) -> bytes:
    """The bytes of one object; an unknown path is an error."""
    rows = spark.read.format("binaryFile").load(path).select("content").limit(2).collect()
    if len(rows) != 1:
        raise FileNotFoundError(path)
    return bytes(rows[0]["content"])
