"""Chunks of documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.operators import chunking as C
from quern.plans.registry import query
from quern.runtime import table


@query("chunks")
def _(spark, d):
    return C.chunks(table(spark, d, "documents")).select("doc_id", "seq", "start_at", "end_at", "strategy", "context", F.md5("content").alias("h"))


@query("chunk_coverage", "SELECT doc_id, length(text)::INT AS covered FROM documents WHERE length(text) > 0")
def _(spark, d):
    c = C.chunks(table(spark, d, "documents"))
    return c.groupBy("doc_id").agg(F.max("end_at").alias("covered"))


@query("parent_child_chunks")
def _(spark, d):
    return C.parent_child(table(spark, d, "documents")).groupBy("doc_id", "parent_seq").agg(F.count("*").alias("n"), F.max("end_at").alias("end_at"))


@query("chunks_rebuilt", "SELECT doc_id, md5(text) AS digest, TRUE AS within, TRUE AS linked FROM documents WHERE length(text) > 0")
def _(spark, d):
    """The chunks of each text make the text again, none is larger than its limit, and their links name their neighbours."""
    c = C.chunks(table(spark, d, "documents"))
    w = Window.partitionBy("doc_id").orderBy("seq")
    far = F.max("end_at").over(w.rowsBetween(Window.unboundedPreceding, -1))
    own = F.expr("substring(content, greatest(coalesce(_far, 0) - start_at, 0) + 1)")
    g = c.withColumn("_far", far).withColumn("own", own).withColumn("ok", F.lag("seq").over(w).eqNullSafe(F.col("prev_seq")) & F.lead("seq").over(w).eqNullSafe(F.col("next_seq")))
    g = g.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "own"))).alias("p"), (F.max(F.length("content")) <= C.HARD_LIMIT).alias("within"), F.min("ok").alias("linked"))
    return g.select("doc_id", F.md5(F.array_join("p.own", "")).alias("digest"), "within", "linked")


@query("children_inside", "SELECT doc_id, length(text)::INT AS covered, TRUE AS within FROM documents WHERE length(text) > 0")
def _(spark, d):
    """Children of parent chunks cover the text, and none is larger than its limit."""
    c = C.parent_child(table(spark, d, "documents"))
    return c.groupBy("doc_id").agg(F.max("end_at").alias("covered"), (F.max(F.length("content")) <= C.HARD_LIMIT).alias("within"))


@query("embedding_contents", "SELECT doc_id, md5(CASE WHEN title IS NOT NULL AND trim(title, ' ') <> '' THEN trim(title, ' ') || chr(10) || chr(10) ELSE '' END || trim(text, ' ')) AS h FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(C.embedding_content(F.col("title"), F.col("text"))).alias("h"))
