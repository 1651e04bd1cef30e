"""Facts, evaluation sets and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import evaluation as E
from quern.operators import facts as K
from quern.plans.registry import query
from quern.runtime import table


def _qa(spark, d):
    """queries, corpus, answers, qrels, qas of the evaluation items: each question is answered by its item; passages relate to the questions of their suite and language."""
    e = table(spark, d, "eval_items")
    q = e.select(F.col("item_id").alias("id"), F.col("question").alias("text"))
    c = e.select(F.col("item_id").alias("id"), F.col("passage").alias("text"))
    a = e.where("item_id % 5 <> 0").select(F.col("item_id").alias("id"), F.col("answer").alias("text"))
    rel = e.select(F.col("item_id").alias("qid"), F.explode(F.array(F.col("item_id"), F.col("item_id") + 1, F.col("item_id") * 1000)).alias("pid")).where("qid % 7 <> 0")
    return q, c, a, rel, e.select(F.col("item_id").alias("qid"), F.col("item_id").alias("aid"))


_QA = "q AS (SELECT item_id AS id, question AS text FROM eval_items), c AS (SELECT item_id AS id, passage AS text FROM eval_items), a AS (SELECT item_id AS id, answer AS text FROM eval_items WHERE item_id % 5 <> 0), rel AS (SELECT item_id AS qid, unnest([item_id, item_id + 1, item_id * 1000]) AS pid FROM eval_items WHERE item_id % 7 <> 0), qas AS (SELECT item_id AS qid, item_id AS aid FROM eval_items)"


@query("qa_pairs", f"WITH {_QA} SELECT q.id AS qid, md5(q.text) AS question, coalesce(any_value(a.text), '') AS answer, coalesce(list(r.pid ORDER BY r.pid) FILTER (WHERE r.pid IS NOT NULL), []) AS pids, md5(coalesce(string_agg(r.text, '|' ORDER BY r.pid), '')) AS passages FROM q LEFT JOIN qas ON qas.qid = q.id LEFT JOIN a ON a.id = qas.aid LEFT JOIN (SELECT DISTINCT rel.qid, c.id AS pid, c.text FROM rel JOIN c ON c.id = rel.pid) r ON r.qid = q.id GROUP BY q.id, q.text")
def _(spark, d):
    return E.qa_pairs(*_qa(spark, d)).select("qid", F.md5("question").alias("question"), "answer", "pids", F.md5(F.array_join("passages", "|")).alias("passages"))


@query("qa_statistics", f"WITH {_QA}, s AS (SELECT qid, count(DISTINCT pid) AS n FROM rel GROUP BY qid) SELECT (SELECT count(*) FROM q) AS queries, (SELECT count(*) FROM c) AS passages, (SELECT count(*) FROM a) AS answers, (SELECT count(*) FROM (SELECT DISTINCT * FROM rel)) AS relations, (SELECT avg(n) FROM s) AS mean_passages, (SELECT count(DISTINCT qid) FROM qas) * 100.0 / (SELECT count(*) FROM q) AS answered")
def _(spark, d):
    return E.statistics(*_qa(spark, d))


@query("qa_sampled", f"WITH {_QA}, k AS (SELECT DISTINCT rel.qid, rel.pid FROM rel JOIN q ON q.id = rel.qid JOIN c ON c.id = rel.pid), b AS (SELECT qid FROM (SELECT qid, count(*) AS n FROM k GROUP BY qid) ORDER BY n DESC, qid LIMIT 50) SELECT qid, pid FROM k WHERE qid IN (SELECT qid FROM b)")
def _(spark, d):
    q, c, _, rel, _ = _qa(spark, d)
    return E.sampled(q, c, rel, 50)[2]


@query("metric_averages", "SELECT event_type, count(*) AS n, coalesce(avg(value), 0) AS value, coalesce(avg(value * 2), 0) AS twice FROM events GROUP BY event_type")
def _(spark, d):
    return E.averages(table(spark, d, "events").withColumn("twice", F.col("value") * 2), ["value", "twice"], ["event_type"])


@query("multiset_atoms", "WITH a AS (SELECT o_custkey AS k, o_orderpriority AS x, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL), b AS (SELECT o_custkey AS k, o_orderpriority AS x, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL), j AS (SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS p, coalesce(b.n, 0) AS q FROM a FULL JOIN b ON a.k = b.k AND a.x = b.x) SELECT k, sum(least(p, q))::INT AS shared, sum(greatest(p - q, 0))::INT AS missing, sum(greatest(q - p, 0))::INT AS extra FROM j GROUP BY k")
def _(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus in ('F', 'O')")
    side = lambda s: F.collect_list(F.when(F.col("o_orderstatus") == s, F.col("o_orderpriority")))
    g = o.groupBy(F.col("o_custkey").alias("k")).agg(side("F").alias("a"), side("O").alias("b"))
    return g.select("k", *(c.alias(n) for n, c in K.multiset(F.col("a"), F.col("b")).items()))


@query("fact_hashes", r"SELECT record_id, sha256(coalesce(tri_state, '') || chr(0) || trim(regexp_replace(lower(coalesce(value, '')), '[ \t\n\r\f\x0B]+', ' ', 'g'), ' ')) AS h FROM (SELECT DISTINCT record_id, tri_state, value FROM golden_records)")
def _(spark, d):
    g = table(spark, d, "golden_records").select("record_id", "tri_state", "value").distinct()
    return g.select("record_id", K.state_hash(F.col("tri_state"), F.col("value")).alias("h"))


@query("authority_pairs", "WITH g AS (SELECT DISTINCT record_id, product_id, doc, field_id, annotator_model AS r, created_at AS at FROM golden_records) SELECT a.record_id AS a, b.record_id AS b, CASE WHEN (a.r = 'hand') AND b.r IS DISTINCT FROM 'hand' THEN 'higher' WHEN b.r = 'hand' AND a.r IS DISTINCT FROM 'hand' THEN 'lower' WHEN a.at IS NOT DISTINCT FROM b.at THEN 'equal' WHEN b.at IS NULL OR a.at > b.at THEN 'higher' ELSE 'lower' END AS relation FROM g a JOIN g b ON a.product_id = b.product_id AND a.doc = b.doc AND a.field_id = b.field_id AND a.record_id < b.record_id")
def _(spark, d):
    g = table(spark, d, "golden_records").select("record_id", "product_id", "doc", "field_id", F.coalesce("annotator_model", F.lit("")).alias("r"), F.col("created_at").alias("at")).distinct()
    b = g.select(F.col("record_id").alias("b"), "product_id", "doc", "field_id", F.col("r").alias("r2"), F.col("at").alias("at2"))
    j = g.withColumnRenamed("record_id", "a").join(b, ["product_id", "doc", "field_id"]).where("a < b")
    return j.select("a", "b", K.authority(F.col("r"), F.col("at"), F.col("r2"), F.col("at2"), ["hand"]).alias("relation"))


@query("retractable_facts", "WITH s AS (SELECT product_id, field_id, min(doc) AS doc, max(doc) AS l, max(CASE WHEN annotator_model = 'hand' THEN 2 ELSE 1 END) AS r FROM golden_records WHERE schema_version = '1.1' AND product_id IS NOT NULL GROUP BY ALL), n AS (SELECT product_id, field_id, max(CASE WHEN annotator_model = 'hand' THEN 2 ELSE 1 END) AS r FROM golden_records WHERE schema_version = '2.0' AND product_id IS NOT NULL GROUP BY ALL) SELECT product_id, field_id, doc FROM s JOIN n USING (product_id, field_id) WHERE doc = l AND n.r > s.r")
def _(spark, d):
    g = table(spark, d, "golden_records").where("product_id is not null").withColumn("rank", F.when(F.col("annotator_model") == "hand", 2).otherwise(1))
    return K.retractable(g.where("schema_version = '1.1'"), ["product_id", "field_id"], "doc", "rank", g.where("schema_version = '2.0'"))


@query("stuck_rows", "SELECT c_custkey AS user_id FROM customer LEFT JOIN (SELECT user_id, max(ts) AS t FROM events GROUP BY 1) ON user_id = c_custkey WHERE t IS NULL OR t <= TIMESTAMP '2024-01-28 00:00:00'")
def _(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return K.stuck(c, table(spark, d, "events"), "user_id", "ts", F.lit("2024-01-28 00:00:00").cast("timestamp_ntz"))


@query("schema_drift", "WITH e AS (SELECT DISTINCT n_nationkey AS k FROM nation WHERE n_nationkey % 3 <> 1), a AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_nationkey % 5 <> 2) SELECT k, 'missing' AS drift FROM e WHERE k NOT IN (SELECT k FROM a) UNION ALL SELECT k, 'unexpected' FROM a WHERE k NOT IN (SELECT k FROM e)")
def _(spark, d):
    return K.drift(table(spark, d, "nation").select(F.col("n_nationkey").alias("k")).where("k % 3 <> 1"), table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).where("k % 5 <> 2"), ["k"])


@query("fact_snapshot", "WITH e AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linenumber > 2 GROUP BY 1) SELECT o_orderkey, coalesce(n, 0) AS n_evidence, (c_custkey IS NOT NULL AND coalesce(n, 0) > 0) AS complete FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 <> 0) ON c_custkey = o_custkey LEFT JOIN e ON l_orderkey = o_custkey")
def _(spark, d):
    claims = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("rev"))
    revs = table(spark, d, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("rev"), "c_name")
    ev = table(spark, d, "lineitem").where("l_linenumber > 2").select(F.col("l_orderkey").alias("rev"))
    return K.snapshot(claims, revs, ev, "o_orderkey", "rev").select("o_orderkey", "n_evidence", "complete")


@query("json_semi_join", "SELECT event_id FROM events WHERE json_extract_string(props, '$.k') IN (SELECT p_size::VARCHAR FROM part WHERE p_size < 20)")
def _(spark, d):
    return K.json_semi(table(spark, d, "events"), "props", "$.k", table(spark, d, "part").where("p_size < 20"), "p_size").select("event_id")


@query("model_usage", "SELECT event_id FROM events WHERE user_id = 7 OR json_extract_string(props, '$.k') = '7'")
def _(spark, d):
    return table(spark, d, "events").where(K.refers_to("7", ["user_id"], {"props": ["$.k", "$.model"]})).select("event_id")


@query("sync_plan", "WITH f AS (SELECT DISTINCT id, is_enabled, is_recommended, tag_name FROM faq_entries), j AS (SELECT b.id AS target_id, a.is_enabled AS e1, b.is_enabled AS e2, a.tag_name AS t1, b.tag_name AS t2 FROM f a JOIN f b ON b.id = a.id + 1 WHERE a.id % 2 = 1) SELECT target_id, 'is_enabled' AS field, e1::VARCHAR AS value FROM j WHERE e1 IS DISTINCT FROM e2 UNION ALL SELECT target_id, 'tag_name', t1 FROM j WHERE t1 IS DISTINCT FROM t2")
def _(spark, d):
    f = table(spark, d, "faq_entries").select("id", "is_enabled", "is_recommended", "tag_name").distinct()
    pairs = f.where("id % 2 = 1").select(F.col("id").alias("source_id"), (F.col("id") + 1).alias("target_id")).distinct()
    return K.sync_plan(f, f, pairs, ["is_enabled", "tag_name"])


_GRID = "g AS (SELECT p.product_id, f.field_id, coalesce(s.st, 'unknown') AS tri_state FROM (SELECT DISTINCT product_id FROM insurance_products) p CROSS JOIN (SELECT DISTINCT field_id FROM golden_records WHERE field_id IS NOT NULL) f LEFT JOIN (SELECT product_id, field_id, arg_min(tri_state, CASE tri_state WHEN 'absent_explicitly' THEN 0 WHEN 'present' THEN 1 ELSE 2 END) AS st FROM golden_records GROUP BY ALL) s ON s.product_id = p.product_id AND s.field_id = f.field_id)"


def _grid(spark, d):
    g = table(spark, d, "golden_records")
    return K.matrix(table(spark, d, "insurance_products"), g.where("field_id is not null"), g, "product_id", "field_id", "tri_state", ["absent_explicitly", "present"])


@query("state_matrix", f"WITH {_GRID} SELECT * FROM g")
def _(spark, d):
    return _grid(spark, d).select("product_id", "field_id", "tri_state")


@query("gap_cells", f"WITH {_GRID} SELECT product_id, field_id FROM g WHERE tri_state = 'unknown'")
def _(spark, d):
    return K.gap_cells(_grid(spark, d), "tri_state", ["unknown"]).select("product_id", "field_id")


_CLQ = """e AS (SELECT DISTINCT doc, e.quote, e.page FROM (SELECT doc, unnest(evidence) AS e FROM golden_records) WHERE e.quote IS NOT NULL AND e.page IS NOT NULL AND doc IS NOT NULL), p AS (SELECT doc, page, string_agg(CASE WHEN page % 4 = 0 THEN replace(quote, ' ', '  ') ELSE quote END, chr(10) ORDER BY quote) AS t FROM e GROUP BY ALL),
h AS (SELECT e.doc, e.quote, e.page AS loc, count(DISTINCT CASE WHEN contains(t, quote) THEN p.page END) AS n, max((contains(t, quote) AND p.page = e.page)::INT) AS named FROM e JOIN p ON p.doc = e.doc AND (contains(t, quote) OR contains(regexp_replace(lower(t), '\\s+', '', 'g'), regexp_replace(lower(quote), '\\s+', '', 'g'))) GROUP BY ALL)"""


@query("quote_classes", f"WITH {_CLQ} SELECT CASE WHEN n = 1 OR (n > 1 AND named = 1) THEN 'verified' WHEN n > 1 THEN 'ambiguous' WHEN n = 0 THEN 'normalised' ELSE 'unlocated' END AS status, count(*) AS n FROM e LEFT JOIN h ON e.doc = h.doc AND e.quote = h.quote AND e.page = h.loc GROUP BY 1")
def _(spark, d):
    e = table(spark, d, "golden_records").select("doc", F.explode("evidence").alias("e")).select("doc", "e.quote", "e.page").where("quote is not null and page is not null and doc is not null").distinct()
    shown = F.when(F.col("page") % 4 == 0, F.replace(F.col("quote"), F.lit(" "), F.lit("  "))).otherwise(F.col("quote"))
    pages = e.groupBy("doc", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("quote", shown.alias("s")))), lambda x: x["s"]), "\n").alias("text"))
    q = e.withColumnRenamed("page", "locator")
    return K.classify_quote(q, pages, "doc", "quote", "page", "text", "locator").groupBy("status").agg(F.count("*").alias("n"))


@query("master_compared", "SELECT DISTINCT record_id, CASE WHEN m.product_id IS NULL THEN false WHEN field_id = 'product_code' THEN lower(trim(coalesce(value, ''))) <> lower(trim(product_code)) WHEN field_id = 'grace_period' AND owner IS NOT NULL THEN lower(trim(coalesce(value, ''))) <> lower(trim(owner)) ELSE false END AS disputed FROM golden_records g LEFT JOIN insurance_products m ON m.product_id = g.product_id")
def _(spark, d):
    g = table(spark, d, "golden_records").select("record_id", "product_id", "field_id", "value").distinct()
    return K.compared_with(g, table(spark, d, "insurance_products"), "product_id", "field_id", "value", {"product_code": "product_code", "grace_period": "owner"}).select("record_id", "disputed")


@query("quality_profile", "WITH g AS (SELECT DISTINCT record_id, product_id, doc, field_id, tri_state, value FROM golden_records), a AS (SELECT product_id, doc, field_id, arg_min(tri_state, record_id) AS gs, arg_min(ROW(value), record_id)[1] AS gv, arg_max(tri_state, record_id) AS ps, arg_max(ROW(value), record_id)[1] AS pv FROM g WHERE product_id IS NOT NULL AND doc IS NOT NULL AND field_id IS NOT NULL GROUP BY ALL), e AS (SELECT *, coalesce(lower(trim(gv)) = lower(trim(pv)), false) AS same FROM a) SELECT field_id, count(*) AS pairs, count(*) FILTER (WHERE gs = ps AND (gs <> 'present' OR same)) AS correct, round(CASE WHEN count(*) FILTER (WHERE ps = 'present') + count(*) FILTER (WHERE gs = 'present') > 0 THEN 2.0 * count(*) FILTER (WHERE gs = 'present' AND ps = 'present' AND same) / (count(*) FILTER (WHERE ps = 'present') + count(*) FILTER (WHERE gs = 'present')) ELSE 0 END, 9) AS f1, count(*) FILTER (WHERE gs <> 'present' AND ps = 'present') AS hallucinations FROM e GROUP BY field_id")
def _(spark, d):
    k = ["product_id", "doc", "field_id"]
    g = table(spark, d, "golden_records").select("record_id", *k, "tri_state", "value").distinct()
    pick = lambda f: g.groupBy(*k).agg(f(F.struct("record_id", "tri_state", "value")).alias("m")).select(*k, "m.tri_state", "m.value")
    return K.quality_profile(pick(F.min), pick(F.max), k, "field_id").withColumn("f1", F.round("f1", 9))


@query("miss_attribution", "SELECT CASE WHEN record_id % 11 = 0 THEN 'cleaning_kill' WHEN p IS NULL THEN 'no_evidence_page' WHEN p % 2 = 1 OR p > 40 THEN 'routing_miss' ELSE 'extract_empty' END AS reason, count(*) AS n FROM (SELECT DISTINCT record_id, evidence[1].page AS p FROM golden_records) GROUP BY 1")
def _(spark, d):
    g = table(spark, d, "golden_records").select("record_id", F.get("evidence", F.lit(0))["page"].alias("p")).distinct()
    g = g.withColumn("cleaned", F.col("record_id") % 11 == 0).withColumn("routed", F.sequence(F.lit(0), F.lit(40), F.lit(2)))
    return g.select(K.attributed(g, "cleaned", "routed", "p").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("gap_report", "SELECT user_id, count(*) AS hits FROM events WHERE user_id IS NOT NULL GROUP BY 1 ORDER BY hits DESC, user_id LIMIT 10")
def _(spark, d):
    g = table(spark, d, "events").where("user_id is not null").groupBy("user_id").agg(F.count("*").alias("hits"), F.min("ts").alias("opened"), F.max("ts").alias("closed"), F.max("event_type").alias("status"))
    return K.roll_up(g, "user_id", "status", "hits", "opened", "closed")[1].select("user_id", "hits")


@query("closure_days", "SELECT round(avg(epoch(b - a) / 86400), 4) AS days FROM (SELECT user_id, date_trunc('second', min(ts)) AS a, date_trunc('second', max(ts)) AS b FROM events WHERE user_id IS NOT NULL GROUP BY 1)")
def _(spark, d):
    g = table(spark, d, "events").where("user_id is not null").groupBy("user_id").agg(F.count("*").alias("hits"), F.min("ts").alias("opened"), F.max("ts").alias("closed"), F.max("event_type").alias("status"))
    return K.roll_up(g, "user_id", "status", "hits", "opened", "closed")[2].select(F.round("days", 4).alias("days"))


@query("job_metrics", "SELECT o_orderpriority AS space, count(*) FILTER (WHERE o_orderstatus = 'F') AS \"F\", count(*) FILTER (WHERE o_orderstatus = 'O') AS \"O\", count(*) FILTER (WHERE o_orderstatus = 'Z') AS \"Z\", sum(o_custkey)::BIGINT AS attempts, count(*) FILTER (WHERE o_orderdate <= TIMESTAMP '1995-06-01') AS expired FROM orders GROUP BY ROLLUP (o_orderpriority)")
def _(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_orderpriority", "space")
    return K.job_metrics(o, "space", "o_orderstatus", "o_custkey", "o_orderdate", F.lit("1995-06-01").cast("timestamp_ntz"), ["F", "O", "Z"])


@query("audit_count", "SELECT count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND user_id = 5 AND event_type = 'view'")
def _(spark, d):
    return K.count_since(table(spark, d, "events"), F.lit("2024-01-10").cast("timestamp_ntz"), "ts", user_id=5, event_type="view")


@query("sample_titles", "SELECT knowledge_base_id, list(title ORDER BY o, title)[1:5] AS titles FROM (SELECT knowledge_base_id, title, min(doc_id) AS o FROM documents WHERE title IS NOT NULL GROUP BY ALL) GROUP BY 1")
def _(spark, d):
    return K.sample_titles(table(spark, d, "documents"), "knowledge_base_id", "title", "doc_id")
