"""Maintenance of an index table (chunk_id, source_id, knowledge_id, knowledge_base_id, content, embedding, is_enabled, tag_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delete_keys(index: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The index without rows whose ``column`` is among the keys; a null key deletes nothing."""
    return index.join(keys.select(column).where(F.col(column).isNotNull()).distinct(), column, "left_anti")


def translated_source(source: Column, chunk: Column, target: Column) -> Column:
    """The source id of a copied row: its chunk's becomes the target chunk's, one made from it (``chunk-n``) keeps its ending, any other gets one of its own, made from both ids."""
    own = F.concat(F.substring(F.sha2(F.concat_ws("\0", source, target), 256), 1, 32))
    return F.when(source == chunk, target).when(F.startswith(source, F.concat(chunk, F.lit("-"))), F.concat(target, F.substring(source, F.length(chunk) + 1, F.length(source)))).otherwise(own)


def copy_index(index: DataFrame, chunk_map: DataFrame, document_map: DataFrame, target_base: str) -> DataFrame:
    """Rows for another base: ids translated by (chunk_id, new_chunk_id) and (knowledge_id, new_knowledge_id), embeddings as they are; rows without a translation are left out."""
    j = index.join(chunk_map, "chunk_id").join(document_map, "knowledge_id")
    source = translated_source(F.col("source_id"), F.col("chunk_id"), F.col("new_chunk_id"))
    new = {"source_id": source, "chunk_id": F.col("new_chunk_id"), "knowledge_id": F.col("new_knowledge_id"), "knowledge_base_id": F.lit(target_base)}
    return j.select(*(new.get(c, F.col(c)).alias(c) for c in index.columns))


def update_field(index: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """The index with ``column`` from (key, column) rows where there is one; of several changes of a key the greatest value holds."""
    c = changes.groupBy(key).agg(F.max(column).alias("_new"))
    return index.join(c, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new").select(*index.columns)


def storage_size(index: DataFrame, content: str = "content", embedding: str = "embedding") -> DataFrame:
    """rows, bytes: contents in UTF-8, six bytes a dimension (a half-precision vector and its graph) and 200 for each row."""
    one = F.coalesce(F.octet_length(content), F.lit(0)) + 6 * F.greatest(F.coalesce(F.size(embedding), F.lit(0)), F.lit(0)) + 200
    return index.agg(F.count("*").alias("rows"), F.coalesce(F.sum(one.cast("long")), F.lit(0).cast("long")).alias("bytes"))
