"""Search over documents and embeddings. Queries are every row whose id is divisible by 100."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.functions import vector as V
from quern.operators import retrieval as R
from quern.plans.registry import query
from quern.runtime import table

_COS = "list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[])"


def _vec_queries(spark, d):
    return table(spark, d, "embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))


def _text_queries(spark, d):
    return table(spark, d, "eval_items").select(F.col("item_id").alias("query_id"), F.col("question").alias("query"))


@query("vector_topk", f"SELECT query_id, id, round(score, 6) AS score, rank FROM (SELECT q.vec_id AS query_id, e.vec_id AS id, {_COS} AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY {_COS} DESC, e.vec_id) AS rank FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0) WHERE rank <= 50")
def _(spark, d):
    return R.vector_topk(table(spark, d, "embeddings"), _vec_queries(spark, d)).withColumn("score", F.round("score", 6))


@query("vector_threshold", f"SELECT q.vec_id AS query_id, count(*) AS n FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0 AND {_COS} >= 0.15 GROUP BY q.vec_id")
def _(spark, d):
    return R.vector_scores(table(spark, d, "embeddings"), _vec_queries(spark, d), R.VECTOR_THRESHOLD).groupBy("query_id").agg(F.count("*").alias("n"))


@query("vector_valid", "SELECT count(*) AS n, round(sum(n1), 4) AS norms FROM (SELECT sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n1 FROM embeddings) WHERE n1 > 0")
def _(spark, d):
    e = table(spark, d, "embeddings").where(V.valid(F.col("embedding")))
    return e.agg(F.count("*").alias("n"), F.round(F.sum(V.norm(F.col("embedding"))), 4).alias("norms"))


@query("vector_centroids", "SELECT label, round(list_sum(c), 6) AS s FROM (SELECT label, list(m ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding::DOUBLE[]) AS x FROM embeddings) GROUP BY label, i) GROUP BY label)")
def _(spark, d):
    e = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    return e.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m")).groupBy("label").agg(F.round(F.sum("m"), 6).alias("s"))


_BM = r"""
toks AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents),
dd AS (SELECT id, ws, len(ws) AS n FROM toks WHERE len(ws) > 0), st AS (SELECT count(*) AS docs, avg(n) AS avg_len FROM dd),
q AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(question), '[\p{L}\p{N}]+')) AS term FROM eval_items),
tf AS (SELECT id, n, term, count(*) AS tf FROM (SELECT id, n, unnest(ws) AS term FROM dd) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
bm AS (SELECT query_id, id, sum(ln((docs - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / avg_len))) AS score FROM tf JOIN df USING (term) JOIN q USING (term), st GROUP BY query_id, id)"""


def _bm25(spark, d):
    return R.bm25(table(spark, d, "documents"), _text_queries(spark, d))


@query("keyword_bm25_topk", f"WITH {_BM} SELECT query_id, id, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS r FROM bm) WHERE r <= 10")
def _(spark, d):
    s = _bm25(spark, d)
    return R.top(s, 10, [F.desc(F.round("score", 9)), F.col("id")]).select("query_id", "id", F.round("score", 6).alias("score"))


@query("keyword_normalised", f"WITH {_BM}, o AS (SELECT query_id, list(score ORDER BY score) AS a FROM bm GROUP BY query_id), b AS (SELECT query_id, CASE WHEN len(a) >= 10 THEN a[floor((len(a) - 1) * 0.05)::INT + 1] ELSE a[1] END AS lo, CASE WHEN len(a) >= 10 THEN a[floor((len(a) - 1) * 0.95)::INT + 1] ELSE a[-1] END AS hi FROM o) SELECT query_id, round(avg(CASE WHEN hi <= lo THEN 1.0 ELSE least(greatest((score - lo) / (hi - lo), 0), 1) END), 6) AS mean FROM bm JOIN b USING (query_id) GROUP BY query_id")
def _(spark, d):
    return R.normalise_keyword(_bm25(spark, d)).groupBy("query_id").agg(F.round(F.avg("normalised"), 6).alias("mean"))


@query("keyword_any", "SELECT doc_id AS id, 1.0::DOUBLE AS score FROM documents WHERE contains(lower(text), 'premium') OR contains(lower(text), 'beitrag')")
def _(spark, d):
    return R.keyword_any(table(spark, d, "documents"), ["premium", "Beitrag"])


def _lists(spark, d):
    """A vector list and a keyword list of documents: queries are those whose id is divisible by 100, by embedding and by title."""
    docs, e = table(spark, d, "documents"), table(spark, d, "embeddings")
    items = e.join(docs.select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi")
    q = docs.where("doc_id % 100 = 0")
    vq = e.join(q.select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    v = R.vector_scores(items, vq, R.VECTOR_THRESHOLD).withColumn("score", F.round("score", 9))
    k = R.bm25(docs, q.where("title is not null").select(F.col("doc_id").alias("query_id"), F.col("title").alias("query"))).withColumn("score", F.round("score", 9))
    by = [F.desc("score"), F.col("id")]
    return R.top(v, R.EMBEDDING_TOP_K, by), R.top(k, R.EMBEDDING_TOP_K, by)


_HYBRID = f"""{_BM.replace("SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(question), '[\\p{L}\\p{N}]+')) AS term FROM eval_items", "SELECT DISTINCT doc_id AS query_id, unnest(regexp_extract_all(lower(title), '[\\p{L}\\p{N}]+')) AS term FROM documents WHERE doc_id % 100 = 0")},
kw AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rk FROM bm QUALIFY rk <= 50),
vs AS (SELECT q.vec_id AS query_id, e.vec_id AS id, round({_COS}, 9) AS score, {_COS} AS raw FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0 AND e.vec_id IN (SELECT doc_id FROM documents) AND q.vec_id IN (SELECT doc_id FROM documents)),
vv AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rv FROM vs WHERE raw >= 0.15 QUALIFY rv <= 50),
fu AS (SELECT query_id, id, coalesce(0.7 / (rv + 60), 0) + coalesce(0.3 / (rk + 60), 0) AS score FROM vv FULL JOIN kw USING (query_id, id)),
hy AS (SELECT query_id, id, round(score, 9) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) AS rank FROM fu QUALIFY rank <= 10)"""


def hybrid(spark, d):
    v, k = _lists(spark, d)
    f = R.fuse(v, k)
    return R.top(f, R.RERANK_TOP_K, [F.desc(F.round("score", 12)), F.col("id")]).select("query_id", "id", F.round("score", 9).alias("score"), "rank")


@query("hybrid_search", f"WITH {_HYBRID} SELECT * FROM hy")
def _(spark, d):
    return hybrid(spark, d)


@query("best_per_key", "SELECT user_id, arg_max(event_id, (value, -event_id)) AS event_id, max(value) AS value FROM events WHERE value IS NOT NULL GROUP BY user_id")
def _(spark, d):
    return R.best_per_key(table(spark, d, "events").where("value is not null").select("user_id", "event_id", "value"), ["user_id"], "value", "event_id")


@query("composite_score", "SELECT l_orderkey, l_linenumber, l_partkey, round(least(greatest((0.6 * l_discount * 10 + 0.3 * l_tax * 10 + 0.1 * CASE WHEN l_returnflag = 'R' THEN 0.95 ELSE 1 END) * (1 + least(greatest(1 - l_linenumber / (l_quantity + 1), -0.05), 0.05)), 0), 1), 9) AS score FROM lineitem")
def _(spark, d):
    x = table(spark, d, "lineitem")
    s = R.composite(F.col("l_discount") * 10, F.col("l_tax") * 10, F.col("l_returnflag") == "R", F.col("l_linenumber"), F.col("l_quantity"))
    return x.select("l_orderkey", "l_linenumber", "l_partkey", F.round(s, 9).alias("score"))


@query("threshold_fallback", "SELECT user_id AS query_id, event_id AS id FROM (SELECT *, max(value) OVER (PARTITION BY user_id) AS b FROM events WHERE value IS NOT NULL) WHERE value >= CASE WHEN b >= 90 THEN 90 WHEN b >= 63 THEN 63 WHEN b >= 0.15 THEN b END")
def _(spark, d):
    e = table(spark, d, "events").where("value is not null").select(F.col("user_id").alias("query_id"), F.col("event_id").alias("id"), F.col("value").alias("score"))
    return R.threshold_with_fallback(e, threshold=90.0).select("query_id", "id")


@query("scope_filter", "SELECT DISTINCT id FROM faq_entries WHERE tag_name IN ('tag01', 'tag02', 'tag05') AND (is_enabled IS NULL OR is_enabled) AND (tag_id IS NULL OR tag_id NOT IN (5))")
def _(spark, d):
    f = R.scope(table(spark, d, "faq_entries"), tag_name=["tag01", "tag02", "tag05"], knowledge_base_id=[])
    return R.exclude(f.where(R.enabled(F.col("is_enabled"))), tag_id=[5]).select("id").distinct()


@query("filter_ast", "SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_totalprice BETWEEN 1000 AND 50000) AND o_orderpriority NOT IN ('5-LOW') AND NOT o_custkey < 50 AND o_orderpriority LIKE '%-%'")
def _(spark, d):
    ast = {
        "op": "and",
        "args": [
            {"op": "or", "args": [{"op": "eq", "field": "o_orderstatus", "value": "F"}, {"op": "between", "field": "o_totalprice", "value": [1000, 50000]}]},
            {"op": "not_in", "field": "o_orderpriority", "value": ["5-LOW"]},
            {"op": "not", "arg": {"op": "lt", "field": "o_custkey", "value": 50}},
            {"op": "like", "field": "o_orderpriority", "value": "%-%"},
        ],
    }
    return table(spark, d, "orders").where(R.condition(ast)).select("o_orderkey")


@query("negative_question_filter", "SELECT DISTINCT f.id, e.item_id FROM faq_entries f JOIN eval_items e ON lower(trim(f.standard_question)) = lower(trim(e.question)) WHERE NOT list_contains(list_transform(coalesce(f.negative_questions, []), lambda x: lower(trim(x))), lower(trim(e.question)))")
def _(spark, d):
    f, e = table(spark, d, "faq_entries"), table(spark, d, "eval_items")
    j = f.join(e, F.lower(F.trim("standard_question")) == F.lower(F.trim("question")))
    neg = F.exists(F.coalesce("negative_questions", F.array().cast("array<string>")), lambda x: F.lower(F.trim(x)) == F.lower(F.trim(F.col("question"))))
    return j.where(~F.coalesce(neg, F.lit(False))).select("id", "item_id").distinct()


@query("cap_per_group", "SELECT o_custkey AS query_id, o_orderkey AS id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS g FROM orders) WHERE g <= 2) WHERE r <= 5")
def _(spark, d):
    o = table(spark, d, "orders").withColumnsRenamed({"o_custkey": "query_id", "o_orderkey": "id"})
    return R.cap_per_group(o, "o_orderpriority", 2, 5, [F.desc("o_totalprice"), F.col("id")]).select("query_id", "id")


@query("round_robin", "SELECT o_custkey AS query_id, o_orderkey AS id, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY g, o_totalprice DESC, o_orderkey) AS r FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS g FROM orders)) WHERE r <= 6")
def _(spark, d):
    o = table(spark, d, "orders").withColumnsRenamed({"o_custkey": "query_id", "o_orderkey": "id"})
    return R.round_robin(o, "o_orderpriority", [F.desc("o_totalprice"), F.col("id")], 6).select("query_id", "id", "rank")


@query("keyset_page", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey < 1000 ORDER BY o_orderkey DESC LIMIT 20")
def _(spark, d):
    return R.keyset_page(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 1000)


@query("offset_page", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 60")
def _(spark, d):
    return R.offset_page(table(spark, d, "orders"), [F.desc("o_totalprice"), F.col("o_orderkey")], 4).select("o_orderkey")


@query("mmr_diversity")
def _(spark, d):
    s = R.top(_bm25(spark, d), 50, [F.desc(F.round("score", 9)), F.col("id")])
    s = R.normalise_keyword(s.select("query_id", "id", "score"))
    toks = table(spark, d, "documents").select(F.col("doc_id").alias("id"), T.word_set(F.col("text")).alias("tokens"))
    return R.mmr(s.join(toks, "id").select("query_id", "id", F.col("normalised").alias("score"), "tokens"))


@query("contained_results")
def _(spark, d):
    s = R.top(_bm25(spark, d), 50, [F.desc(F.round("score", 9)), F.col("id")]).select("query_id", "id", "score")
    toks = table(spark, d, "documents").select(F.col("doc_id").alias("id"), T.word_set(F.col("text")).alias("tokens"))
    return R.drop_contained(s.join(toks, "id"), "query_id", "id", "score", "tokens").select("query_id", "id")
