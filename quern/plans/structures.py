"""Merging, graphs and incremental state."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import graph as G
from quern.operators import incremental as I
from quern.operators import merging as M
from quern.operators.components import components
from quern.plans.registry import query
from quern.runtime import table

_ISL = "SELECT l_suppkey, min(s) AS s, max(e) AS e, count(*) AS n FROM (SELECT *, sum(nw) OVER (PARTITION BY l_suppkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT l_suppkey, s, e, CASE WHEN max(e) OVER w IS NULL OR s > max(e) OVER w THEN 1 ELSE 0 END AS nw FROM (SELECT l_suppkey, epoch(l_shipdate)::BIGINT // 86400 AS s, epoch(l_shipdate)::BIGINT // 86400 + l_linenumber AS e FROM lineitem) WINDOW w AS (PARTITION BY l_suppkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))) GROUP BY l_suppkey, run"


@query("interval_islands", _ISL)
def _(spark, d):
    x = table(spark, d, "lineitem").select("l_suppkey", F.floor(F.unix_seconds(F.col("l_shipdate").cast("timestamp")) / 86400).alias("s"), "l_linenumber")
    return M.islands(x.withColumn("e", F.col("s") + F.col("l_linenumber")), ["l_suppkey"], "s", "e")


@query("sessions", "SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS n FROM (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) > 1800000000 THEN 1 ELSE 0 END AS nw FROM events)) GROUP BY user_id, run")
def _(spark, d):
    return M.sessions(table(spark, d, "events"), "user_id", "ts", 1800)


@query("neighbours", "SELECT doc_id, lag(doc_id) OVER w AS prev_id, lead(doc_id) OVER w AS next_id FROM documents WINDOW w AS (PARTITION BY knowledge_base_id ORDER BY doc_id)")
def _(spark, d):
    return M.neighbours(table(spark, d, "documents").select("doc_id", "knowledge_base_id"), ["knowledge_base_id"], ["doc_id"], "doc_id").select("doc_id", "prev_id", "next_id")


@query("neighbour_expansion")
def _(spark, d):
    x = table(spark, d, "documents").select("doc_id", "knowledge_base_id", "text")
    return M.expand_text(x, ["knowledge_base_id"], ["doc_id"], "text").select("doc_id", F.length("expanded").alias("n"))


@query("budget_batches", "WITH RECURSIVE o AS (SELECT coalesce(knowledge_base_id, '') AS kb, n_chars AS s, row_number() OVER (PARTITION BY coalesce(knowledge_base_id, '') ORDER BY doc_id) AS i FROM documents WHERE n_chars IS NOT NULL), r AS (SELECT kb, i, s, s AS used, 0 AS batch FROM o WHERE i = 1 UNION ALL SELECT o.kb, o.i, o.s, CASE WHEN r.used > 0 AND r.used + o.s > 8000 THEN o.s ELSE r.used + o.s END, CASE WHEN r.used > 0 AND r.used + o.s > 8000 THEN r.batch + 1 ELSE r.batch END FROM r JOIN o ON o.kb = r.kb AND o.i = r.i + 1) SELECT kb, batch, count(*) AS n, sum(s)::BIGINT AS chars FROM r GROUP BY ALL")
def _(spark, d):
    x = table(spark, d, "documents").where("n_chars is not null").select("doc_id", F.coalesce("knowledge_base_id", F.lit("")).alias("kb"), "n_chars")
    return M.batches(x, "kb", ["doc_id"], "n_chars", 8000).groupBy("kb", "batch").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def _lines(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("no", "line"))


@query("heading_breadcrumbs", r"""WITH l AS (SELECT doc_id, unnest(range(len(ls))) AS no, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
v AS (SELECT *, length(regexp_extract(line, '^(#{1,6}) ', 1)) AS lv FROM l),
c AS (SELECT doc_id, no, max(CASE WHEN lv = 1 THEN no END) OVER w AS n1, max(CASE WHEN lv = 2 THEN no END) OVER w AS n2, max(CASE WHEN lv = 3 THEN no END) OVER w AS n3 FROM v WINDOW w AS (PARTITION BY doc_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
h AS (SELECT doc_id, no AS k, regexp_replace(line, '^#{1,6} +', '') AS t FROM v WHERE lv > 0)
SELECT c.doc_id, concat_ws(' > ', a.t, b.t, e.t) AS crumb, count(*) AS n FROM c LEFT JOIN h a ON a.doc_id = c.doc_id AND a.k = n1 LEFT JOIN h b ON b.doc_id = c.doc_id AND b.k = n2 AND (n1 IS NULL OR n2 > n1) LEFT JOIN h e ON e.doc_id = c.doc_id AND e.k = n3 AND n3 > greatest(coalesce(n1, -1), coalesce(n2, -1)) GROUP BY ALL""")
def _(spark, d):
    return M.breadcrumbs(_lines(spark, d), "doc_id", "no", "line").groupBy("doc_id", "crumb").agg(F.count("*").alias("n"))


@query("table_headers", r"WITH l AS (SELECT doc_id, unnest(range(len(ls))) AS no, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)), r AS (SELECT *, regexp_full_match(line, '\s*\|.*\|\s*') AS row FROM l), f AS (SELECT *, row AND NOT coalesce(lag(row) OVER (PARTITION BY doc_id ORDER BY no), false) AS first FROM r), h AS (SELECT doc_id, row, last_value(CASE WHEN first THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY no ROWS UNBOUNDED PRECEDING) AS header FROM f) SELECT doc_id, header, count(*) AS n FROM h WHERE row GROUP BY ALL")
def _(spark, d):
    return M.table_headers(_lines(spark, d), "doc_id", "no", "line").where("header is not null").groupBy("doc_id", "header").agg(F.count("*").alias("n"))


def _edges(spark, d):
    """Products that share an owner's or a category's record: space -> product, by category."""
    p = table(spark, d, "insurance_products")
    return p.select(F.col("space_id").alias("src"), F.col("product_id").alias("dst"), F.col("category").alias("type"))


_E = "e AS (SELECT space_id AS src, product_id AS dst, category AS type FROM insurance_products)"


@query("graph_clean_edges", f"WITH {_E} SELECT src, dst, type, count(*) AS weight FROM e WHERE src IS NOT NULL AND dst IS NOT NULL AND src <> dst GROUP BY ALL")
def _(spark, d):
    return G.clean_edges(_edges(spark, d))


@query("graph_degrees", f"WITH {_E} SELECT node, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree, count(*) AS degree FROM (SELECT src AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst, 0, 1 FROM e) GROUP BY node")
def _(spark, d):
    return G.degrees(_edges(spark, d))


@query("graph_merge_nodes", "SELECT product_id AS name, list_sort(list_distinct(list(doc))) AS chunks FROM golden_records WHERE product_id IS NOT NULL GROUP BY product_id")
def _(spark, d):
    g = table(spark, d, "golden_records").where("product_id is not null").select(F.col("product_id").alias("name"), F.array("doc").alias("chunks"))
    return G.merge_nodes(g)


@query("graph_match", f"WITH {_E}, n AS (SELECT DISTINCT src AS name FROM e WHERE contains(lower(src), 'a1')) SELECT DISTINCT name, type, neighbour FROM n JOIN (SELECT src AS name, type, dst AS neighbour FROM e UNION ALL SELECT dst, type, src FROM e) USING (name)")
def _(spark, d):
    e = _edges(spark, d)
    return G.match(e.select(F.col("src").alias("name")).distinct(), e, ["A1"])


@query("graph_components", "WITH RECURSIVE e AS (SELECT DISTINCT lower(trim(release_id)) AS a, lower(trim(base_release_id)) AS b FROM wiki_releases WHERE trim(coalesce(base_release_id, '')) <> ''), b2 AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS node, a AS c FROM b2 UNION SELECT r.node, b2.b FROM r JOIN b2 ON r.c = b2.a) SELECT node, min(c) AS component FROM r GROUP BY node")
def _(spark, d):
    w = table(spark, d, "wiki_releases").select(F.lower(F.trim("release_id")).alias("src"), F.lower(F.trim("base_release_id")).alias("dst")).where("dst <> ''")
    return components(w)


@query("graph_link_repair")
def _(spark, d):
    p = table(spark, d, "insurance_products")
    pages = p.select(T.slug(F.col("canonical_name")).alias("slug"), F.col("canonical_name").alias("title")).where("slug <> ''").dropDuplicates(["slug"])
    links = table(spark, d, "golden_records").select(F.col("product_name").alias("link")).where("link is not null").distinct()
    return G.resolve_links(links, pages)


@query("wiki_health", "WITH p AS (SELECT DISTINCT lower(trim(release_id)) AS slug, candidate_digest AS content FROM wiki_releases), l AS (SELECT DISTINCT lower(trim(release_id)) AS src, lower(trim(base_release_id)) AS dst FROM wiki_releases WHERE trim(coalesce(base_release_id, '')) <> ''), a AS (SELECT (SELECT count(*) FROM p) AS pages, (SELECT count(*) FROM p WHERE length(content) < 50) AS short, (SELECT count(*) FROM p WHERE slug NOT IN (SELECT dst FROM l)) AS orphans, (SELECT count(*) FROM l WHERE dst NOT IN (SELECT slug FROM p)) AS broken, (SELECT count(*) FROM l) AS links) SELECT *, round(100 - 100 * (orphans / pages + broken / links + short / pages) / 3, 4) AS score FROM a")
def _(spark, d):
    w = table(spark, d, "wiki_releases")
    pages = w.select(F.lower(F.trim("release_id")).alias("slug"), F.col("candidate_digest").alias("content")).distinct()
    links = w.select(F.lower(F.trim("release_id")).alias("src"), F.lower(F.trim("base_release_id")).alias("dst")).where("dst <> ''").distinct()
    return G.health(pages, links)


@query("similar_names", "WITH g AS (SELECT product_id AS id, list_distinct(list_transform(range(1, greatest(length(t) - 1, 1) + 1), lambda i: substring(t, i, 2))) AS b FROM (SELECT product_id, regexp_replace(lower(canonical_name), '\\s+', '', 'g') AS t FROM insurance_products)) SELECT x.id AS id_a, y.id AS id_b, round(len(list_intersect(x.b, y.b))::DOUBLE / len(list_distinct(list_concat(x.b, y.b))), 6) AS score FROM g x JOIN g y ON x.id < y.id WHERE len(list_intersect(x.b, y.b))::DOUBLE / len(list_distinct(list_concat(x.b, y.b))) >= 0.6 - 1e-9")
def _(spark, d):
    p = table(spark, d, "insurance_products").select("product_id", T.char_bigrams(F.col("canonical_name")).alias("b"))
    return G.similar_pairs(p, "product_id", "b", 0.6).withColumn("score", F.round("score", 6))


@query("cursor_increment", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00' OR (ts = TIMESTAMP '2024-01-15 00:00:00' AND event_id > 10)")
def _(spark, d):
    return I.after_cursor(table(spark, d, "events"), "ts", "event_id", ("2024-01-15 00:00:00", 10)).select("event_id")


@query("gap_aggregate", "SELECT user_id, count(*) AS hits, list_sort(list_distinct(list(event_type))) AS signals, list(event_id ORDER BY ts DESC, event_id DESC)[1:5] AS last_ids, min(ts) AS first_seen, max(ts) AS last_seen FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def _(spark, d):
    return I.gaps(table(spark, d, "events"), "user_id", "ts", "event_id", "event_type")


@query("last_ids", "SELECT event_type, list(event_id ORDER BY ts DESC, event_id DESC)[1:5] AS ids FROM events GROUP BY event_type")
def _(spark, d):
    return I.last_ids(table(spark, d, "events"), "event_type", "ts", "event_id")


@query("fact_diff", "WITH a AS (SELECT DISTINCT product_id, doc, field_id, value FROM golden_records WHERE schema_version = '1.1'), b AS (SELECT DISTINCT product_id, doc, field_id, value FROM golden_records WHERE schema_version = '2.0'), x AS (SELECT product_id, doc, field_id, min(value) AS v FROM a GROUP BY ALL), y AS (SELECT product_id, doc, field_id, min(value) AS v FROM b GROUP BY ALL) SELECT CASE WHEN x.doc IS NULL THEN 'add' WHEN y.doc IS NULL THEN 'remove' WHEN x.v IS NOT DISTINCT FROM y.v THEN 'same' ELSE 'change' END AS action, count(*) AS n FROM x FULL JOIN y ON x.product_id = y.product_id AND x.doc = y.doc AND x.field_id = y.field_id GROUP BY 1")
def _(spark, d):
    g = table(spark, d, "golden_records")
    side = lambda v: g.where(F.col("schema_version") == v).groupBy("product_id", "doc", "field_id").agg(F.min("value").alias("v"))
    return I.diff(side("1.1"), side("2.0"), ["product_id", "doc", "field_id"], ["v"]).groupBy("action").agg(F.count("*").alias("n"))


@query("upsert", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0 UNION ALL SELECT o_orderkey, 'X' FROM orders WHERE o_orderkey % 7 = 0")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return I.upsert(o, o.where("o_orderkey % 7 = 0").withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"])


@query("insert_ignore", "SELECT DISTINCT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def _(spark, d):
    c, s = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).distinct(), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    return I.insert_ignore(c, s, ["k"])


@query("unchanged_suppressed", "SELECT DISTINCT g.record_id FROM golden_records g LEFT JOIN (SELECT DISTINCT record_id, sha256(CASE WHEN record_id % 3 = 0 THEN 'before' ELSE coalesce(value, '') END) AS f FROM golden_records WHERE record_id % 5 <> 0) s ON s.record_id = g.record_id WHERE s.f IS NULL OR s.f <> sha256(coalesce(g.value, ''))")
def _(spark, d):
    g = table(spark, d, "golden_records").select("record_id", "value").distinct()
    # what was seen before: some records are new since, of others the value was another
    before = F.when(F.col("record_id") % 3 == 0, "before").otherwise(F.coalesce("value", F.lit("")))
    seen = g.where("record_id % 5 <> 0").select("record_id", F.sha2(before, 256).alias("fingerprint"))
    return I.unchanged_suppressed(seen, g, "record_id", "value").select("record_id")


@query("versions", "SELECT user_id, max(v)::INT AS versions FROM (SELECT user_id, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS v FROM (SELECT *, CASE WHEN row_number() OVER w > 1 AND lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))) GROUP BY user_id")
def _(spark, d):
    return I.versions(table(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type").groupBy("user_id").agg(F.max("version").alias("versions"))


@query("as_of_join", "SELECT a.event_id, b.value FROM (SELECT * FROM events WHERE event_type = 'purchase') a ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'click' AND value IS NOT NULL GROUP BY ALL) b ON a.user_id = b.user_id AND a.ts >= b.ts")
def _(spark, d):
    e = table(spark, d, "events")
    right = e.where("event_type = 'click' and value is not null").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return I.as_of(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), right, "user_id", "ts", "ts", "value").select("event_id", "value")


@query("sliding_limit", "WITH RECURSIVE o AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events WHERE user_id IS NOT NULL), r AS (SELECT user_id, i, [ts] AS held, true AS ok FROM o WHERE i = 1 UNION ALL SELECT o.user_id, o.i, CASE WHEN len(list_filter(r.held, lambda x: o.ts - x < INTERVAL 1 HOUR)) < 3 THEN list_append(list_filter(r.held, lambda x: o.ts - x < INTERVAL 1 HOUR), o.ts) ELSE list_filter(r.held, lambda x: o.ts - x < INTERVAL 1 HOUR) END, len(list_filter(r.held, lambda x: o.ts - x < INTERVAL 1 HOUR)) < 3 FROM r JOIN o ON o.user_id = r.user_id AND o.i = r.i + 1) SELECT user_id, count(*) FILTER (WHERE ok) AS admitted, count(*) AS n FROM r GROUP BY user_id")
def _(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    return I.sliding_limit(e, "user_id", "ts", 3600, 3).groupBy("user_id").agg(F.count_if("admitted").alias("admitted"), F.count("*").alias("n"))
