"""Readings of texts and answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import extraction as X
from quern.operators import knowledge as K
from quern.plans.registry import query
from quern.runtime import table


@query("graph_parsed", "SELECT product_id, 1 + (canonical_name <> space_id)::INT AS n_nodes, (canonical_name <> space_id AND category IN ('life', 'travel'))::INT AS n_relations FROM insurance_products WHERE canonical_name <> space_id AND category IN ('life', 'travel') UNION ALL SELECT product_id, 1, 0 FROM insurance_products WHERE NOT (canonical_name <> space_id AND category IN ('life', 'travel'))")
def _(spark, d):
    p = table(spark, d, "insurance_products")
    node = F.array(F.struct(F.col("canonical_name").alias("name")), F.struct(F.col("canonical_name").alias("name")))
    rel = F.array(F.struct(F.col("canonical_name").alias("source"), F.col("space_id").alias("target"), F.col("category").alias("type")), F.struct(F.col("space_id").alias("source"), F.col("space_id").alias("target"), F.lit("life").alias("type")))
    a = p.select("product_id", F.concat(F.lit("```json\n"), F.to_json(F.struct(node.alias("nodes"), rel.alias("relations"))), F.lit("\n```")).alias("answer"))
    return X.parsed_graphs(a, "product_id", "answer", ["life", "travel"]).select("product_id", F.size("nodes").alias("n_nodes"), F.size("relations").alias("n_relations"))


_KW = ["premium", "form", "insured", "rider", "contract"]


@query("keyword_density", "WITH c AS (SELECT doc_id, length(text) AS n, list_transform(['premium', 'form', 'insured', 'rider', 'contract'], lambda k: (length(lower(text)) - length(replace(lower(text), k, ''))) // length(k)) AS h FROM documents) SELECT doc_id FROM c WHERE list_sum(h) >= greatest(4, n // 400) AND len(list_filter(h, lambda x: x > 0)) >= 3")
def _(spark, d):
    return table(spark, d, "documents").where(X.dense_in(F.col("text"), _KW)).select("doc_id")


@query("text_feedability", r"SELECT doc_id, round(((length(regexp_replace(text, '\s', '', 'g')) > 0)::INT + (length(text) - length(regexp_replace(text, '[\x{FFFD}\x{0000}-\x{0008}\x{000E}-\x{001F}]', '', 'g')) <= 0.01 * length(text))::INT + (length(text) <= 200000)::INT + regexp_matches(trim(text, ' '), '[.!?。！？|:：)）\]»”\"'']\s*$')::INT + regexp_matches(text, '(?m)^#{1,6} ')::INT) / 5, 6) AS score FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(X.feedability(F.col("text"))["score"], 6).alias("score"))


@query("value_options", "SELECT o_orderkey, CASE WHEN lower(trim(o_orderpriority)) IN ('1-urgent', '2-high') THEN upper(o_orderpriority) END AS v FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.constrained(F.lower("o_orderpriority"), "one of: 1-URGENT / 2-HIGH").alias("v"))


@query("curated_fallback", "SELECT o_custkey, o_orderkey, true AS curated FROM orders WHERE o_orderkey % 11 = 0 UNION ALL SELECT o_custkey, o_orderkey, false FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 11 = 0)")
def _(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return X.curated_or_raw(o.where("o_orderkey % 11 = 0"), o, "o_custkey")


@query("trace_alignment")
def _(spark, d):
    docs = table(spark, d, "documents")
    hits = K.dictionary_match(docs, table(spark, d, "insurance_products"), "doc_id", "text", "product_id", "canonical_name").select(F.col("id").alias("doc_id"), F.col("name_id").alias("product_id"))
    return X.aligned(hits, docs, "doc_id", "product_id").groupBy("reason").agg(F.count("*").alias("n"))
