"""Results assembled from hits, scopes and index maintenance.

The tables hold no chunks, sessions or index of their own; documents, events,
faq entries and embeddings stand in for them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import assembly as A
from quern.operators import indexing as X
from quern.plans.registry import query
from quern.plans.retrieval import _HYBRID, hybrid
from quern.runtime import table

# a document's source stands for the kind of its chunk
_KIND = "CASE source WHEN 'wiki_sync' THEN 'wiki_page' WHEN 'chat_export' THEN 'faq' WHEN 'mail_import' THEN 'table_summary' WHEN 'file_upload' THEN 'text' ELSE 'image_ocr' END"


def _chunks(spark, d):
    return table(spark, d, "documents").select("doc_id", F.col("knowledge_base_id"), F.col("title"), F.expr(_KIND).alias("chunk_type"), F.length("text").alias("n"), "source", "lang")


@query("search_assembled", f"WITH {_HYBRID} SELECT query_id, id, round(score, 9) AS score, rank, {_KIND} AS chunk_type, title, k.name AS base, k.kb_type FROM hy JOIN documents d ON d.doc_id = hy.id JOIN knowledge_bases k USING (knowledge_base_id)")
def _(spark, d):
    kb = table(spark, d, "knowledge_bases").select("knowledge_base_id", F.col("name").alias("base"), "kb_type")
    chunks = _chunks(spark, d).select(F.col("doc_id").alias("id"), "knowledge_base_id", "chunk_type", "title")
    return A.assemble(hybrid(spark, d), chunks, kb, "id", "knowledge_base_id").select("query_id", "id", "score", "rank", "chunk_type", "title", "base", "kb_type")


_BOOST = f"WITH {_HYBRID}, b AS (SELECT query_id, id, rank AS before, CASE WHEN {_KIND} = 'wiki_page' THEN 1.3 ELSE 1 END * CASE WHEN {_KIND} = 'faq' THEN least(round(score, 9) * 1.2, 1) ELSE round(score, 9) END AS score FROM hy JOIN documents d ON d.doc_id = hy.id WHERE {_KIND} IN ('text', 'summary', 'table_column', 'table_summary', 'faq', 'image_ocr', 'image_caption', 'wiki_page') AND {_KIND} <> 'table_summary')"


@query("search_boosted", _BOOST + " SELECT query_id, id, round(score, 9) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, before) AS rank FROM b")
def _(spark, d):
    h = hybrid(spark, d).join(_chunks(spark, d).select(F.col("doc_id").alias("id"), "chunk_type"), "id")
    h = A.without_table_chunks(h.where(A.searchable(F.col("chunk_type")) | (F.col("chunk_type") == "wiki_page")))
    h = h.withColumn("score", F.round(A.faq_boost(F.col("score"), F.col("chunk_type"), 1.2), 12))
    boosted = A.wiki_boost(h.withColumn("score", F.col("score")), "score")
    return boosted.select("query_id", "id", F.round("score", 9).alias("score"), "rank")


@query("search_breakdown", f"WITH {_HYBRID} SELECT query_id, count(*) AS total, count(*) FILTER (WHERE source = 'web_crawl') AS web, count(*) - count(*) FILTER (WHERE source = 'web_crawl') AS documents FROM hy JOIN documents d ON d.doc_id = hy.id GROUP BY query_id")
def _(spark, d):
    h = hybrid(spark, d).join(table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.when(F.col("source") == "web_crawl", "web").otherwise(F.col("source")).alias("origin")), "id")
    return A.breakdown(h)


@query("searchable_chunks", f"SELECT chunk_type, count(*) AS n FROM (SELECT {_KIND} AS chunk_type FROM documents) WHERE chunk_type IN ('text', 'summary', 'table_column', 'table_summary', 'faq', 'image_ocr', 'image_caption') GROUP BY 1")
def _(spark, d):
    return _chunks(spark, d).where(A.searchable(F.col("chunk_type"))).groupBy("chunk_type").agg(F.count("*").alias("n"))


@query("chunks_without_tables", f"SELECT doc_id FROM documents WHERE {_KIND} NOT IN ('table_column', 'table_summary')")
def _(spark, d):
    return A.without_table_chunks(_chunks(spark, d)).select("doc_id")


@query("data_files", "SELECT doc, regexp_matches(lower(doc), '\\.(csv|xlsx|xls)$') AS is_data FROM (SELECT DISTINCT doc FROM golden_records UNION SELECT DISTINCT file_name FROM read_requests)")
def _(spark, d):
    f = table(spark, d, "golden_records").select("doc").union(table(spark, d, "read_requests").select("file_name")).distinct()
    return f.select("doc", A.is_data_file(F.col("doc")).alias("is_data"))


_SCOPES = [{"base": "K0", "tenant": 10001}, {"base": "K1", "documents": [1, 2, 3, 50]}, {"base": "K2", "tags": ["tag01", "tag03"]}]


@query("scope_disjunction", """WITH k AS (SELECT knowledge_base_id, tenant_id, row_number() OVER (ORDER BY knowledge_base_id) % 3 AS g FROM knowledge_bases), t AS (SELECT knowledge_base_id, list_distinct(list(tag_name)) AS tags FROM faq_entries WHERE tag_name IS NOT NULL GROUP BY 1)
SELECT doc_id FROM documents JOIN k USING (knowledge_base_id) LEFT JOIN t USING (knowledge_base_id) WHERE (g = 0 AND tenant_id = 10001) OR (g = 1 AND doc_id IN (1, 2, 3, 50)) OR (g = 2 AND (list_contains(tags, 'tag01') OR list_contains(tags, 'tag03')))""")
def _(spark, d):
    from pyspark.sql import Window

    k = table(spark, d, "knowledge_bases").select("knowledge_base_id", "tenant_id", F.concat(F.lit("K"), F.row_number().over(Window.orderBy("knowledge_base_id")) % 3).alias("base"))
    docs = A.with_tags(table(spark, d, "documents").join(k, "knowledge_base_id"), table(spark, d, "faq_entries"), "knowledge_base_id", "tag_name")
    return docs.where(A.scope_condition(_SCOPES, "base", "tenant_id", "doc_id", "tags")).select("doc_id")


@query("scope_empty", "SELECT doc_id FROM documents WHERE false")
def _(spark, d):
    return table(spark, d, "documents").where(A.scope_condition([])).select("doc_id")


@query("tag_semi_join", "SELECT knowledge_base_id FROM knowledge_bases WHERE knowledge_base_id IN (SELECT knowledge_base_id FROM faq_entries WHERE tag_name IN ('tag02', 'tag07'))")
def _(spark, d):
    return A.any_tag(table(spark, d, "knowledge_bases"), table(spark, d, "faq_entries"), "knowledge_base_id", "tag_name", ["tag02", "tag07"]).select("knowledge_base_id")


@query("soft_deleted", "SELECT doc_id FROM documents WHERE product_id IS NULL")
def _(spark, d):
    return A.not_deleted(table(spark, d, "documents"), "product_id").select("doc_id")


@query("query_token_match", "SELECT doc_id FROM documents WHERE contains(lower(title), 'premium receipt') OR contains(lower(title), 'rider') OR contains(lower(title), 'beitrag')")
def _(spark, d):
    hit = A.matches_queries(F.col("title"), F.array(F.lit("Premium Receipt"), F.lit(" ")), F.array(F.lit("rider"), F.lit("BEITRAG"), F.lit("")))
    return table(spark, d, "documents").where(hit).select("doc_id")


@query("capability_filter", "SELECT knowledge_base_id FROM knowledge_bases WHERE kb_type IN ('wiki', 'faq')")
def _(spark, d):
    have = F.when(F.col("kb_type") == "document", F.array(F.lit("vector"), F.lit("keyword"))).otherwise(F.array(F.col("kb_type")))
    return table(spark, d, "knowledge_bases").where(A.any_capability(have, ["wiki_read", "faq_search", "unknown_tool"])).select("knowledge_base_id")


@query("intent_gate", "SELECT event_id FROM events WHERE event_type IN ('view', 'click') OR (event_type = 'purchase' AND user_id % 2 = 0)")
def _(spark, d):
    need = A.needs_retrieval(F.col("event_type"), F.col("user_id") % 2 == 0, ("view", "click"), ("purchase",))
    return table(spark, d, "events").where(need).select("event_id")


@query("recall_override", "SELECT event_id FROM events WHERE value >= CASE WHEN event_type = 'view' THEN 0 ELSE 50 END")
def _(spark, d):
    return table(spark, d, "events").where(F.col("value") >= A.recall_threshold(F.col("event_type") == "view", 50)).select("event_id")


@query("engine_scores", "SELECT event_id, round(CASE WHEN event_type = 'click' THEN value ELSE CASE WHEN event_type = 'view' THEN (value / 100 + 1) / 2 ELSE least(greatest(value / 100, 0), 1) END END, 9) AS score FROM events WHERE value IS NOT NULL")
def _(spark, d):
    e = table(spark, d, "events").where("value is not null")
    kind, engine = F.when(F.col("event_type") == "click", "keywords").otherwise("vector"), F.when(F.col("event_type") == "view", "milvus").otherwise("other")
    return e.select("event_id", F.round(A.engine_score(F.when(F.col("event_type") == "click", F.col("value")).otherwise(F.col("value") / 100), kind, engine), 9).alias("score"))


@query("own_then_shared", "SELECT c_custkey AS k, c_custkey % 3 = 0 AS shared_row FROM customer WHERE c_custkey <= 500 AND (c_custkey % 3 <> 0 OR c_custkey % 2 = 0)")
def _(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return A.own_then_shared(c.where("k <= 500"), c.where("k % 3 <> 0"), c.where("k % 2 = 0"), "k")


@query("grandparents", "SELECT a.nid AS id, coalesce(g.name, p.name, a.name) AS content, CASE WHEN g.name IS NOT NULL THEN 2 WHEN p.name IS NOT NULL THEN 1 ELSE 0 END AS hops FROM (SELECT l_orderkey * 10 + l_linenumber AS nid, 'line' AS name, l_orderkey AS pid FROM lineitem) a LEFT JOIN (SELECT o_orderkey AS id, o_orderpriority AS name, o_custkey AS up FROM orders WHERE o_orderkey % 5 <> 0) p ON p.id = a.pid LEFT JOIN (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 3 <> 0) g ON g.id = p.up")
def _(spark, d):
    line = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.concat(F.lit("o"), "l_orderkey").alias("parent_id"), F.lit("line").alias("content"))
    o = table(spark, d, "orders").where("o_orderkey % 5 <> 0").select(F.concat(F.lit("o"), "o_orderkey").alias("id"), F.concat(F.lit("c"), "o_custkey").alias("parent_id"), F.col("o_orderpriority").alias("content"))
    c = table(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("c_name").alias("content"))
    return A.with_grandparent(line, o.unionByName(c)).select("id", "content", "hops")


@query("enrichment_ids", "WITH h AS (SELECT * FROM orders WHERE o_orderkey % 10 = 0), x AS (SELECT 'c' || o_custkey AS id, 0 AS o FROM h UNION ALL SELECT 'o' || (o_orderkey + 5), 1 FROM h UNION ALL SELECT 'o' || (o_orderkey + 10), 1 FROM h UNION ALL SELECT 'o' || (o_orderkey - 1), 2 FROM h UNION ALL SELECT 'o' || (o_orderkey + 1), 2 FROM h) SELECT id, CASE min(o) WHEN 0 THEN 'parent' WHEN 1 THEN 'related' ELSE 'nearby' END AS reason FROM x WHERE id NOT IN (SELECT 'o' || o_orderkey FROM h) GROUP BY id")
def _(spark, d):
    o = F.col("o_orderkey")
    key = lambda c: F.concat(F.lit("o"), c.cast("string"))
    h = table(spark, d, "orders").where("o_orderkey % 10 = 0").select(key(o).alias("id"), F.concat(F.lit("c"), "o_custkey").alias("parent"), F.to_json(F.array(key(o + 5), key(o + 10))).alias("related"), key(o - 1).alias("prev"), key(o + 1).alias("next"))
    return A.enrichment_ids(h, "id", "parent", "related", "prev", "next")


@query("graph_unseen_chunks", "SELECT DISTINCT doc AS chunk_id, 1.0::DOUBLE AS score FROM golden_records WHERE doc IS NOT NULL AND doc NOT IN (SELECT doc FROM golden_records WHERE record_id % 97 = 0 AND doc IS NOT NULL)")
def _(spark, d):
    g = table(spark, d, "golden_records")
    nodes = g.groupBy("product_id").agg(F.collect_set("doc").alias("chunks"))
    return A.unseen_graph_chunks(nodes, g.where("record_id % 97 = 0 and doc is not null").select(F.col("doc").alias("chunk_id")))


@query("graph_delete_namespace", "SELECT 'node' AS part, count(*) AS n FROM insurance_products WHERE category IS NULL OR category NOT IN ('life', 'travel') UNION ALL SELECT 'edge', count(*) FROM insurance_products WHERE category IS NULL OR category NOT IN ('life', 'travel')")
def _(spark, d):
    p = table(spark, d, "insurance_products")
    nodes, edges = A.delete_namespace(p.select("category", "product_id"), p.select("category", "space_id", "product_id"), spark.createDataFrame([("life",), ("travel",)], "category string"), ["category"])
    n = lambda df, k: df.agg(F.lit(k).alias("part"), F.count("*").alias("n"))
    return n(nodes, "node").unionByName(n(edges, "edge"))


@query("message_sessions", "SELECT event_id, c_name FROM events JOIN customer ON c_custkey = user_id WHERE c_nationkey % 4 <> 0")
def _(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", F.when(F.col("c_nationkey") % 4 == 0, F.lit("gone")).alias("deleted_at"))
    return A.with_session(table(spark, d, "events"), c, "user_id").select("event_id", "c_name")


@query("session_origins", "SELECT c_custkey, s_name AS origin FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey WHERE (s_name IS NULL AND contains(lower(c_name), '7'))")
def _(spark, d):
    m = table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("origin"))
    s = A.with_origin(table(spark, d, "customer"), m, "c_custkey")
    return A.session_filter(s, "web", "7", title="c_name").select("c_custkey", "origin")


@query("pinned_first", "SELECT o_orderkey FROM orders ORDER BY o_orderstatus = 'P' DESC, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END DESC NULLS LAST, o_orderdate DESC, o_orderkey LIMIT 30")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("pinned", F.col("o_orderstatus") == "P").withColumn("pinned_at", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate")))
    return o.orderBy(*A.pinned_first("pinned", "pinned_at", "o_orderdate"), "o_orderkey").limit(30).select("o_orderkey")


@query("faq_rendered", "SELECT id, md5('Q: ' || standard_question || CASE WHEN len(a) > 0 THEN chr(10) || 'A: ' || array_to_string(a, chr(10)) ELSE '' END) AS h FROM (SELECT DISTINCT id, standard_question, list_filter(coalesce(answers, []), lambda x: trim(coalesce(x, ''), ' ') <> '') AS a FROM faq_entries)")
def _(spark, d):
    f = table(spark, d, "faq_entries").select("id", "standard_question", "answers").distinct()
    return f.select("id", F.md5(A.rendered_faq(F.col("standard_question"), F.col("answers"))).alias("h")).distinct()


@query("retriever_split", "SELECT 'vector' AS list, count(*) AS n FROM events WHERE event_type = 'view' UNION ALL SELECT 'keywords', count(*) FROM events WHERE event_type = 'click'")
def _(spark, d):
    e = table(spark, d, "events").withColumn("retriever", F.when(F.col("event_type") == "view", "vector").when(F.col("event_type") == "click", "keywords"))
    v, k = A.by_retriever(e)
    n = lambda df, x: df.agg(F.lit(x).alias("list"), F.count("*").alias("n"))
    return A.fan_out([n(v, "vector"), n(k, "keywords")])


@query("merged_images", "WITH e AS (SELECT product_id, record_id, unnest(evidence) AS e, generate_subscripts(evidence, 1) AS pos FROM (SELECT DISTINCT product_id, record_id, evidence FROM golden_records WHERE product_id IS NOT NULL)), f AS (SELECT product_id, e.chunk_id AS u, arg_min(e.quote, (record_id, pos)) AS q FROM e GROUP BY ALL) SELECT product_id, count(*) AS n, count(q) AS quoted FROM f GROUP BY 1")
def _(spark, d):
    g = table(spark, d, "golden_records").where("product_id is not null").select("product_id", "record_id", "evidence").distinct()
    m = A.merged_images(g, "product_id", "record_id", "evidence", "chunk_id")
    return m.select("product_id", F.size("evidence").cast("long").alias("n"), F.size(F.filter("evidence", lambda x: x["quote"].isNotNull())).cast("long").alias("quoted"))


@query("tenants_of_targets", "SELECT knowledge_base_id, arg_min(tenant_id, created_at) AS tenant_id FROM knowledge_bases GROUP BY 1")
def _(spark, d):
    return A.tenants_of(table(spark, d, "knowledge_bases"), "knowledge_base_id", "tenant_id", "created_at")


@query("result_union", "WITH u AS (SELECT 1 AS query_id, o_orderkey AS id, o_totalprice AS score, o_orderpriority || (o_custkey % 50) AS c FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 1, o_orderkey, o_totalprice / 2, o_orderpriority || (o_custkey % 50) FROM orders WHERE o_orderkey % 3 = 0), a AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC) = 1) SELECT id, score FROM a QUALIFY row_number() OVER (PARTITION BY lower(c) ORDER BY score DESC, id) = 1")
def _(spark, d):
    o = table(spark, d, "orders").select(F.lit(1).alias("query_id"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"), F.concat("o_orderpriority", F.col("o_custkey") % 50).alias("c"))
    return A.union_results([o.where("id % 2 = 0"), o.where("id % 3 = 0").withColumn("score", F.col("score") / 2)], content="c").select("id", "score")


@query("faq_filtered_topk", "SELECT user_id AS query_id, event_id AS id, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL AND event_type <> 'error') WHERE rank <= 3")
def _(spark, d):
    e = table(spark, d, "events").where("user_id is not null").select(F.col("user_id").alias("query_id"), F.col("event_id").alias("id"), F.col("value").alias("score"), "event_type")
    return A.filtered_topk(e.where("score is not null"), e.where("event_type = 'error'"), 3).select("query_id", "id", "rank")


def _index(spark, d):
    """Every fourth faq row is made from the one before, so sources are a chunk's own, derived from it, or foreign."""
    f = table(spark, d, "faq_entries").dropDuplicates(["id"])
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    src = F.when(F.col("id") % 3 == 0, F.col("chunk_id")).when(F.col("id") % 3 == 1, F.concat("chunk_id", F.lit("-q"), F.col("id"))).otherwise(F.lit("other"))
    return f.join(e, "id", "left").select("chunk_id", src.alias("source_id"), "knowledge_id", "knowledge_base_id", F.col("standard_question").alias("content"), "embedding", "is_enabled", "tag_id", "id")


_INDEX = "i AS (SELECT f.chunk_id, CASE f.id % 3 WHEN 0 THEN f.chunk_id WHEN 1 THEN f.chunk_id || '-q' || f.id ELSE 'other' END AS source_id, f.knowledge_id, f.knowledge_base_id, f.standard_question AS content, e.embedding, f.is_enabled, f.tag_id, f.id FROM (SELECT * FROM faq_entries QUALIFY row_number() OVER (PARTITION BY id) = 1) f LEFT JOIN embeddings e ON e.vec_id = f.id)"


@query("index_delete", f"WITH {_INDEX} SELECT id FROM i WHERE chunk_id IS NULL OR chunk_id NOT IN (SELECT chunk_id FROM faq_entries WHERE id % 9 = 0 AND chunk_id IS NOT NULL)")
def _(spark, d):
    i = _index(spark, d)
    return X.delete_keys(i, table(spark, d, "faq_entries").where("id % 9 = 0"), "chunk_id").select("id")


@query("index_copy", f"WITH {_INDEX} SELECT id, 'new-' || chunk_id AS chunk_id, CASE id % 3 WHEN 0 THEN 'new-' || chunk_id WHEN 1 THEN 'new-' || chunk_id || '-q' || id ELSE substring(sha256('other' || chr(0) || 'new-' || chunk_id), 1, 32) END AS source_id, 'kb-target' AS knowledge_base_id FROM i WHERE id % 2 = 0 AND knowledge_id IS NOT NULL")
def _(spark, d):
    i = _index(spark, d)
    chunks = i.where("id % 2 = 0").select("chunk_id", F.concat(F.lit("new-"), "chunk_id").alias("new_chunk_id")).distinct()
    docs = i.where("knowledge_id is not null").select("knowledge_id", F.concat(F.lit("new-"), "knowledge_id").alias("new_knowledge_id")).distinct()
    return X.copy_index(i, chunks, docs, "kb-target").select("id", "chunk_id", "source_id", "knowledge_base_id")


@query("index_update", f"WITH {_INDEX} SELECT id, CASE WHEN id % 4 = 0 THEN false ELSE is_enabled END AS is_enabled FROM i")
def _(spark, d):
    i = _index(spark, d)
    return X.update_field(i, i.where("id % 4 = 0").select("id", F.lit(False).alias("is_enabled")), "id", "is_enabled").select("id", "is_enabled")


@query("index_storage", f"WITH {_INDEX} SELECT count(*) AS rows, sum(coalesce(octet_length(encode(content)), 0) + 6 * coalesce(len(embedding), 0) + 200)::BIGINT AS bytes FROM i")
def _(spark, d):
    return X.storage_size(_index(spark, d))
