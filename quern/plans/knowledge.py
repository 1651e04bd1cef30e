"""Records of knowledge."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import knowledge as K
from quern.plans.registry import query
from quern.runtime import table


@query("parent_content", "SELECT o_orderkey AS id, coalesce(c_name, 'own') AS content FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) ON c_custkey = o_custkey")
def _(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("oid"), F.col("o_custkey").alias("parent"), F.lit("own").alias("content"))
    c = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("content"))
    return K.with_parent(o, c, "parent").select(F.col("oid").alias("id"), "content")


@query("page_hints", "SELECT a.l_orderkey AS doc, b.l_linenumber AS page, count(*) AS n FROM (SELECT l_orderkey, min(l_linenumber) AS lo, min(l_linenumber) + 1 AS hi FROM lineitem GROUP BY 1) a JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber BETWEEN a.lo - 1 AND a.hi + 1 GROUP BY ALL")
def _(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"))
    a = x.groupBy("doc").agg(F.min("page").alias("lo"), (F.min("page") + 1).alias("hi"))
    return K.page_hints(a, x.distinct(), "doc", "lo", "hi", "page").groupBy("doc", "page").agg(F.count("*").alias("n"))


@query("evidence_adjacent", "WITH g AS (SELECT record_id, any_value(product_id) AS p, any_value(doc) AS d, any_value(field_id) AS f, any_value(list_transform(coalesce(evidence, []), lambda e: e.page)) AS pages FROM golden_records GROUP BY record_id) SELECT a.record_id AS a, b.record_id AS b, (len(a.pages) = 0 OR len(b.pages) = 0 OR len(list_filter(a.pages, lambda x: len(list_filter(b.pages, lambda y: abs(x - y) <= 1)) > 0)) > 0) AS near FROM g a JOIN g b ON a.p = b.p AND a.d = b.d AND a.f = b.f AND a.record_id < b.record_id")
def _(spark, d):
    g = table(spark, d, "golden_records").dropDuplicates(["record_id"]).select("record_id", "product_id", "doc", "field_id", F.transform(F.coalesce("evidence", F.array()), lambda e: e.page).alias("pages"))
    b = g.select(F.col("record_id").alias("b"), "product_id", "doc", "field_id", F.col("pages").alias("pb"))
    j = g.withColumnRenamed("record_id", "a").join(b, ["product_id", "doc", "field_id"]).where("a < b")
    return j.select("a", "b", K.adjacent(F.col("pages"), F.col("pb")).alias("near"))


@query("quote_verdicts", "SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN q IS NULL OR value IS NULL OR trim(q) = '' THEN 'no_evidence' WHEN contains(regexp_replace(lower(q), '\\s+', '', 'g'), regexp_replace(lower(value), '\\s+', '', 'g')) THEN 'verified' ELSE 'quote_mismatch' END AS verdict FROM (SELECT record_id, value, unnest(evidence).quote AS q FROM golden_records) WHERE value IS NULL OR trim(value) <> '') GROUP BY verdict")
def _(spark, d):
    g = table(spark, d, "golden_records").select("value", F.explode("evidence").alias("e")).where("value is null or trim(value) <> ''")
    return g.select(K.quote_verdict(F.col("value"), F.col("e.quote")).alias("verdict")).groupBy("verdict").agg(F.count("*").alias("n"))


@query(
    "quote_lineage",
    r"""WITH q AS (SELECT doc, e.chunk_id, e.quote FROM (SELECT doc, unnest(evidence) AS e FROM golden_records)), c AS (SELECT doc, chunk_id, string_agg(DISTINCT quote, chr(10) ORDER BY quote) AS content FROM q WHERE quote IS NOT NULL AND chunk_id IS NOT NULL AND doc IS NOT NULL GROUP BY ALL),
u AS (SELECT DISTINCT doc, quote FROM q WHERE quote IS NOT NULL), h AS (SELECT u.doc, u.quote, count(DISTINCT c.chunk_id) AS n FROM u JOIN c ON c.doc = u.doc AND contains(regexp_replace(lower(c.content), '\s+', '', 'g'), regexp_replace(lower(u.quote), '\s+', '', 'g')) GROUP BY ALL)
SELECT CASE WHEN n = 1 THEN 'linked' WHEN n > 1 THEN 'ambiguous' ELSE 'page_only' END AS status, count(*) AS n FROM u LEFT JOIN h ON u.doc IS NOT DISTINCT FROM h.doc AND u.quote = h.quote GROUP BY 1""",
)
def _(spark, d):
    # a chunk is all that is quoted from it
    g = table(spark, d, "golden_records").select("doc", F.explode("evidence").alias("e")).select("doc", F.col("e.chunk_id").alias("chunk_id"), F.col("e.quote").alias("quote")).where("quote is not null")
    chunks = g.where("chunk_id is not null and doc is not null").groupBy("doc", "chunk_id").agg(F.array_join(F.array_sort(F.collect_set("quote")), "\n").alias("content"))
    return K.lineage(g.select("doc", "quote"), chunks, "doc", "quote", "content", "chunk_id").groupBy("status").agg(F.count("*").alias("n"))


@query("dictionary_match", r"WITH d AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), ' ') || ' ' AS t FROM documents), n AS (SELECT DISTINCT product_id, trim(regexp_replace(lower(canonical_name), '\s+', ' ', 'g'), ' ') AS n, ' ' || array_to_string(regexp_extract_all(lower(canonical_name), '[\p{L}\p{N}]+'), ' ') || ' ' AS w FROM insurance_products WHERE length(trim(canonical_name)) > 0), m AS (SELECT doc_id, product_id, n FROM d JOIN n ON contains(t, w)) SELECT doc_id, product_id AS name_id FROM m WHERE NOT EXISTS (SELECT 1 FROM m x WHERE x.doc_id = m.doc_id AND x.n <> m.n AND contains(' ' || x.n || ' ', ' ' || m.n || ' '))")
def _(spark, d):
    return K.dictionary_match(table(spark, d, "documents"), table(spark, d, "insurance_products"), "doc_id", "text", "product_id", "canonical_name").select(F.col("id").alias("doc_id"), "name_id")


@query("resolve_tiers", "WITH c AS (SELECT DISTINCT product_id, field_id, CASE schema_version WHEN '2.0' THEN 1 ELSE 2 END AS tier, tri_state AS v FROM golden_records WHERE product_id IS NOT NULL AND field_id IS NOT NULL), t AS (SELECT product_id, field_id, min(tier) AS b FROM c GROUP BY ALL), s AS (SELECT product_id, field_id, list_distinct(list(v) FILTER (WHERE tier = b)) AS x, coalesce(list_distinct(list(v) FILTER (WHERE tier <> b)), []) AS y FROM c JOIN t USING (product_id, field_id) GROUP BY ALL) SELECT product_id, field_id, CASE WHEN len(x) <> 1 THEN 'ambiguous' WHEN len(y) > 0 AND len(list_intersect(x, y)) = 0 THEN 'contradicted' ELSE 'resolved' END AS reason FROM s")
def _(spark, d):
    g = table(spark, d, "golden_records").where("product_id is not null and field_id is not null")
    c = g.select(F.struct("product_id", "field_id").alias("fact"), F.when(F.col("schema_version") == "2.0", 1).otherwise(2).alias("tier"), F.col("tri_state").alias("v"))
    return K.resolve_tiers(c, "fact", "tier", "v").select("fact.product_id", "fact.field_id", "reason")


@query("state_counts", "SELECT product_id, count(*) FILTER (WHERE tri_state = 'present') AS present, count(*) FILTER (WHERE tri_state = 'unknown') AS \"unknown\", count(*) FILTER (WHERE tri_state = 'none') AS \"none\" FROM golden_records GROUP BY product_id")
def _(spark, d):
    return K.zero_filled(table(spark, d, "golden_records"), ["product_id"], "tri_state", ["present", "unknown", "none"])


@query("pattern_hits", "SELECT knowledge_base_id, count(*) AS chunks, sum(a + b)::BIGINT AS hits, sum(a)::BIGINT AS p0, sum(b)::BIGINT AS p1 FROM (SELECT knowledge_base_id, (length(lower(text)) - length(replace(lower(text), 'premium', ''))) // 7 AS a, (length(lower(text)) - length(replace(lower(text), 'claim form', ''))) // 10 AS b FROM documents) WHERE a + b > 0 GROUP BY 1")
def _(spark, d):
    return K.pattern_hits(table(spark, d, "documents"), "knowledge_base_id", "text", ["premium", "claim form"])


@query("fielded_score", "SELECT doc_id, (greatest(CASE WHEN contains(lower(coalesce(title, '')), 'premium') THEN 8 ELSE 0 END, CASE WHEN contains(lower(text), 'premium') THEN 3 ELSE 0 END) + greatest(CASE WHEN contains(lower(coalesce(title, '')), 'loan') THEN 8 ELSE 0 END, CASE WHEN contains(lower(text), 'loan') THEN 3 ELSE 0 END))::INT AS score FROM documents")
def _(spark, d):
    s = K.fielded_score({"title": (F.col("title"), 8), "text": (F.col("text"), 3)}, ["premium", "loan"])
    return table(spark, d, "documents").select("doc_id", s.cast("int").alias("score"))


@query("key_point_coverage")
def _(spark, d):
    return table(spark, d, "eval_items").select("item_id", F.round(K.key_point_coverage(F.col("passage"), F.concat_ws(" ", "question", "passage")), 6).alias("coverage"))


@query("bit_flags", "SELECT l_linenumber AS n, (l_linenumber & 2) <> 0 AS has, l_linenumber | 8 AS added, l_linenumber & ~1 AS cleared, xor(l_linenumber, 4) AS toggled FROM (SELECT DISTINCT l_linenumber FROM lineitem)")
def _(spark, d):
    c = F.col("l_linenumber")
    x = table(spark, d, "lineitem").select("l_linenumber").distinct()
    return x.select(c.alias("n"), K.has_flag(c, 2).alias("has"), K.set_flag(c, 8).alias("added"), K.clear_flag(c, 1).alias("cleared"), K.toggle_flag(c, 4).alias("toggled"))


@query("anchors_per_key", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1 ORDER BY o_orderdate, o_orderkey LIMIT 25")
def _(spark, d):
    return K.anchors_per_key(table(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], 25).select("o_custkey", "o_orderkey")


@query("values_equal", r"WITH g AS (SELECT DISTINCT record_id, product_id, doc, field_id, value FROM golden_records), n AS (SELECT *, trim(regexp_replace(lower(value), '\s+', ' ', 'g'), ' ') AS nv, regexp_replace(trim(value, ' '), '[,\s]', '', 'g') AS t, regexp_extract(trim(value, ' '), '^([0-9]{4})[-/.年]([0-9]{1,2})[-/.月]([0-9]{1,2})日?$', 0) AS p FROM g), m AS (SELECT *, CASE WHEN regexp_full_match(t, '-?[0-9]+(\.[0-9]+)?') THEN try_cast(t AS DOUBLE) WHEN regexp_full_match(t, '-?[0-9]+(\.[0-9]+)?%') THEN try_cast(replace(t, '%', '') AS DOUBLE) / 100 WHEN regexp_full_match(t, '-?[0-9]+(\.[0-9]+)?万') THEN try_cast(replace(t, '万', '') AS DOUBLE) * 10000 END AS num, try_cast(CASE WHEN p <> '' THEN replace(regexp_replace(p, '[/.年月]', '-', 'g'), '日', '') END AS DATE) AS dt FROM n) SELECT a.record_id AS a, b.record_id AS b, ((a.value IS NULL AND b.value IS NULL) OR coalesce(a.nv = b.nv, false) OR coalesce(abs(a.num - b.num) < 1e-9, false) OR coalesce(a.dt = b.dt, false)) AS same FROM m a JOIN m b ON a.product_id = b.product_id AND a.doc = b.doc AND a.field_id = b.field_id AND a.record_id < b.record_id")
def _(spark, d):
    g = table(spark, d, "golden_records").dropDuplicates(["record_id"]).select("record_id", "product_id", "doc", "field_id", "value")
    b = g.select(F.col("record_id").alias("b"), "product_id", "doc", "field_id", F.col("value").alias("vb"))
    j = g.withColumnRenamed("record_id", "a").join(b, ["product_id", "doc", "field_id"]).where("a < b")
    return j.select("a", "b", K.values_equal(F.col("value"), F.col("vb")).alias("same"))


@query("placeholder_cleaning", "SELECT record_id, CASE WHEN lower(trim(value)) IN ('', '-', '--', '/', 'n/a', 'na', 'null', 'none', 'tbd', '无', '暂无', '不适用', '未知') THEN NULL ELSE trim(value) END AS value FROM (SELECT DISTINCT record_id, value FROM golden_records)")
def _(spark, d):
    return table(spark, d, "golden_records").select("record_id", "value").distinct().select("record_id", K.clean_placeholder(F.col("value")).alias("value"))


@query("cursor_codec", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '|' || event_id AS cursor FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", K.cursor_encode(F.col("ts"), F.col("event_id")).alias("cursor"))


@query("page_revisions", "SELECT p_partkey, 2 - (p_partkey % 3 <> 0)::INT AS version FROM part")
def _(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("content"), F.lit(1).alias("version"))
    new = table(spark, d, "part").where("p_partkey % 3 = 0").select("p_partkey", F.concat("p_name", F.lit("!")).alias("content"))
    return K.revisions(p, new, "p_partkey", "content")[0].select("p_partkey", "version")


@query("tag_counts", "SELECT t.tag_name, count(DISTINCT f.id) FILTER (WHERE f.is_enabled IS NULL OR f.is_enabled) AS n FROM (SELECT DISTINCT tag_name FROM faq_entries WHERE tag_name IS NOT NULL) t LEFT JOIN faq_entries f ON f.tag_name = t.tag_name AND f.is_recommended GROUP BY 1")
def _(spark, d):
    f = table(spark, d, "faq_entries")
    tags = f.where("tag_name is not null").select("tag_name").distinct()
    hit = f.where("is_recommended and (is_enabled is null or is_enabled)").select("tag_name", "id").distinct()
    return tags.join(hit, "tag_name", "left").groupBy("tag_name").agg(F.count("id").alias("n"))


@query("unused_bases", "SELECT knowledge_base_id FROM knowledge_bases WHERE knowledge_base_id NOT IN (SELECT knowledge_base_id FROM documents WHERE knowledge_base_id IS NOT NULL)")
def _(spark, d):
    return table(spark, d, "knowledge_bases").join(table(spark, d, "documents"), "knowledge_base_id", "left_anti").select("knowledge_base_id")


@query("faq_clone_diff", "WITH h AS (SELECT DISTINCT knowledge_base_id AS kb, md5(lower(trim(standard_question))) AS h FROM faq_entries WHERE knowledge_base_id IS NOT NULL), k AS (SELECT kb, lead(kb) OVER (ORDER BY kb) AS nxt FROM (SELECT DISTINCT kb FROM h)), a AS (SELECT kb, h FROM h JOIN k USING (kb) WHERE nxt IS NOT NULL), b AS (SELECT k.kb, h.h FROM k JOIN h ON h.kb = k.nxt) SELECT kb, h, CASE WHEN a.kb IS NULL THEN 'add' WHEN b.kb IS NULL THEN 'remove' ELSE 'same' END AS action FROM a FULL JOIN b USING (kb, h)")
def _(spark, d):
    from pyspark.sql import Window

    from quern.operators.incremental import diff

    # each base against the next one
    f = table(spark, d, "faq_entries").where("knowledge_base_id is not null").select(F.col("knowledge_base_id").alias("kb"), F.md5(F.lower(F.trim("standard_question"))).alias("h")).distinct()
    nxt = f.select("kb").distinct().withColumn("nxt", F.lead("kb").over(Window.orderBy("kb"))).where("nxt is not null")
    old = f.join(nxt, "kb").select("kb", "h", F.lit(1).alias("v"))
    new = nxt.join(f.withColumnRenamed("kb", "nxt"), "nxt").select("kb", "h", F.lit(1).alias("v"))
    return diff(old, new, ["kb", "h"], ["v"])


@query("history_filter", r"WITH q AS (SELECT item_id, list_distinct(regexp_extract_all(lower(question), '[\p{L}\p{N}]+')) AS a FROM eval_items WHERE item_id % 100 = 0), h AS (SELECT item_id AS hid, list_distinct(regexp_extract_all(lower(question), '[\p{L}\p{N}]+')) AS b FROM eval_items) SELECT item_id, hid, round(j * 0.6, 6) AS score FROM (SELECT *, len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))) AS j FROM q, h WHERE hid <> item_id) WHERE j >= 0.15 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY round(j, 9) DESC, hid) <= 3")
def _(spark, d):
    from quern.operators.retrieval import top

    e = table(spark, d, "eval_items").select("item_id", T.word_set(F.col("question")).alias("a"))
    q = e.where("item_id % 100 = 0")
    h = e.select(F.col("item_id").alias("hid"), F.col("a").alias("b"))
    j = h.join(q, F.col("hid") != F.col("item_id")).withColumn("j", T.jaccard(F.col("a"), F.col("b"))).where("j >= 0.15")
    return top(j, 3, [F.desc(F.round("j", 9)), F.col("hid")], ["item_id"]).select("item_id", "hid", F.round(F.col("j") * 0.6, 6).alias("score"))
