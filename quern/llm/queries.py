"""The queries of this subpackage, over the whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import defects, leakage, lookalikes, packing, pigeonring, residue, splitting
from quern.runtime import table


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_requests(splitting.latest_requests(table(spark, d, "read_requests")), table(spark, d, "knowledge_bases"))


def p1_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """What the pieces of each request must keep: their own parts make the text again, none is too large, each has its overlap."""
    bases = table(spark, d, "knowledge_bases").select("knowledge_base_id", "chunk_size", "chunk_overlap")
    asked = splitting.latest_requests(table(spark, d, "read_requests")).join(bases, "knowledge_base_id", "left").select("request_id", F.when(F.col("chunk_size") >= 1, F.col("chunk_size")).otherwise(512).alias("size"), F.coalesce("chunk_overlap", F.lit(80)).alias("overlap"))
    own = F.struct("core_at", F.expr("substring(text, core_at - start_at + 1)").alias("own"))
    per = p1_pieces(spark, d).join(asked, "request_id").groupBy("request_id").agg(
        F.max(F.col("n_chars") - F.col("size")).alias("over"), F.min(F.col("core_at") - F.col("start_at") - F.least("overlap", "core_at")).alias("spare"), F.array_sort(F.collect_list(own)).alias("parts"), F.max("end_at").alias("chars")
    )
    return per.select("request_id", "chars", (F.col("over") <= 0).alias("fits"), (F.col("spare") >= 0).alias("overlaps"), F.md5(F.array_join("parts.own", "")).alias("digest"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized(splitting.split_requests(table(spark, d, "read_requests"), table(spark, d, "knowledge_bases")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return defects.defective_answers(table(spark, d, "faq_entries"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.alike_pairs(table(spark, d, "golden_records"))


def p4_forms(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.record_forms(table(spark, d, "golden_records")).select("record_id", "field", "page", "form").distinct()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pigeonring.near_pairs(table(spark, d, "faq_entries"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return pigeonring.near_groups(table(spark, d, "faq_entries"))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), table(spark, d, "pack_budgets"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_documents(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_clean(spark: SparkSession, d: str) -> DataFrame:
    return leakage.without_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue_documents(table(spark, d, "documents"))


def p8_messages(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue_messages(table(spark, d, "documents"))


def p8_decided(spark: SparkSession, d: str) -> DataFrame:
    """How many documents the shape of a message decides, and how many its recurrence."""
    m = residue.residue_messages(table(spark, d, "documents"))
    per = m.groupBy("doc_id").agg(F.max(F.col("decided") == "shape").alias("shape"), F.max(F.col("decided") == "recurrence").alias("recurrence"))
    return per.groupBy("shape", "recurrence").agg(F.count("*").alias("n_docs"))


def p8_groups(spark: SparkSession, d: str) -> DataFrame:
    return residue.message_groups(table(spark, d, "documents")).groupBy("n_docs", "n_sources").agg(F.count("*").alias("n_groups"))


_TERMS = r"""
WITH e AS (SELECT id, arg_max(list_concat([standard_question], coalesce(similar_questions, [])), coalesce(updated_at, TIMESTAMP '0001-01-01')) AS qs FROM faq_entries GROUP BY id),
q AS (SELECT id, lower(unnest(qs)) AS q FROM e), w AS (SELECT id, q, regexp_extract_all(q, '[\p{L}\p{N}_]+') AS ws FROM q WHERE q IS NOT NULL),
t AS (SELECT DISTINCT id, unnest(CASE WHEN regexp_matches(q, '[\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}]') THEN list_transform(range(1, length(array_to_string(ws, ''))), lambda i: substring(array_to_string(ws, ''), i, 2)) ELSE ws END) AS term FROM w),
n AS (SELECT id, count(*) AS n FROM t GROUP BY id), s AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS k FROM t a JOIN t b ON a.term = b.term AND a.id < b.id GROUP BY ALL)"""
# Only exact, regular facts are said in SQL; the rest is tested against brute force in tests/llm.
ORACLE = {
    "p1_found": r"""
WITH r AS (SELECT DISTINCT request_id, knowledge_base_id, decode(file_content) AS raw FROM read_requests WHERE octet_length(file_content) > 0),
t AS (SELECT request_id, CASE WHEN starts_with(raw, chr(65279)) THEN substring(raw, 2) ELSE raw END AS x, CASE WHEN chunk_size >= 1 THEN chunk_size ELSE 512 END AS size, separators FROM r LEFT JOIN knowledge_bases USING (knowledge_base_id))
SELECT request_id, CASE WHEN list_max(list_transform(string_split(list_reduce(list_concat([x], separators), lambda a, s: replace(a, s, chr(1))), chr(1)), lambda p: length(p))) > size THEN 'forced' ELSE 'natural' END AS cut FROM t WHERE length(x) > size""",
    "p1_rebuilt": """
WITH r AS (SELECT DISTINCT request_id, decode(file_content) AS raw FROM read_requests WHERE octet_length(file_content) > 0),
t AS (SELECT request_id, CASE WHEN starts_with(raw, chr(65279)) THEN substring(raw, 2) ELSE raw END AS x FROM r)
SELECT request_id, length(x)::INT AS chars, TRUE AS fits, TRUE AS overlaps, md5(x) AS digest FROM t WHERE x <> ''""",
    "p5_found": _TERMS + """
SELECT id_a, id_b FROM s JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE k >= 0.75 * (x.n + y.n - k) - 1e-9""",
    "p5_groups": _TERMS.replace("WITH", "WITH RECURSIVE", 1) + """,
l AS (SELECT id_a, id_b FROM s JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE k >= 0.75 * (x.n + y.n - k) - 1e-9),
b AS (SELECT id_a AS a, id_b AS b FROM l UNION ALL SELECT id_b, id_a FROM l),
c AS (SELECT id AS i, id AS r FROM e WHERE id IS NOT NULL UNION SELECT c.i, b.b FROM c JOIN b ON b.a = c.r),
v AS (SELECT id, hash(list_sort(list(term))) AS sid FROM t GROUP BY id),
k AS (SELECT b.a AS id, count(DISTINCT y.sid) AS n_links FROM b JOIN v x ON x.id = b.a JOIN v y ON y.id = b.b WHERE x.sid <> y.sid GROUP BY 1)
SELECT i AS id, min(r) AS group_id, coalesce(any_value(n_links), 0)::BIGINT AS n_links FROM c LEFT JOIN k ON k.id = c.i GROUP BY i""",
    "p7_found": r"""
WITH w AS (SELECT item_id, list_transform(regexp_extract_all(passage, '[\p{L}\p{N}_]+'), lambda x: lower(x)) AS ws FROM eval_items),
g AS (SELECT DISTINCT item_id, ' ' || array_to_string(ws[i:i + 12], ' ') || ' ' AS gram FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
d AS (SELECT doc_id, ' ' || array_to_string(list_transform(regexp_extract_all(text, '[\p{L}\p{N}_]+'), lambda x: lower(x)), ' ') || ' ' AS t FROM documents)
SELECT DISTINCT d.doc_id, g.item_id FROM d JOIN g ON contains(d.t, g.gram)""",
}


def _p4_sql() -> str:
    """Pairs by the expression over DuckDB's own functions, with the fixed tables alone, and a join of all records of one fact."""
    form = lookalikes._sql(*lookalikes.tables())
    return f"""
WITH r AS (SELECT DISTINCT record_id, product_id, doc, field_id, product_name, value, evidence FROM golden_records WHERE record_id IS NOT NULL),
q AS (SELECT record_id, product_id, doc, field_id, unnest(evidence) AS e FROM r),
x AS (SELECT record_id, product_id, doc, field_id, 'product_name' AS field, -1 AS page, product_name AS t FROM r UNION ALL SELECT record_id, product_id, doc, field_id, 'value', -1, value FROM r UNION ALL SELECT record_id, product_id, doc, field_id, 'quote', coalesce(e.page, -1), e.quote FROM q),
n AS MATERIALIZED (SELECT DISTINCT record_id, product_id, doc, field_id, field, page, t, {form} AS c FROM x WHERE t IS NOT NULL)
SELECT DISTINCT a.record_id AS record_id_a, b.record_id AS record_id_b, a.field FROM n a JOIN n b ON a.product_id = b.product_id AND a.doc = b.doc AND a.field_id = b.field_id AND a.field = b.field AND a.page = b.page AND a.c = b.c AND a.t <> b.t AND a.record_id < b.record_id"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {k: v.strip() for k, v in {**ORACLE, "p4_found": _p4_sql(), "p4_forms": _p4_sql().partition("SELECT DISTINCT a.record_id")[0] + "SELECT DISTINCT record_id, field, nullif(page, -1) AS page, c AS form FROM n"}.items()}
