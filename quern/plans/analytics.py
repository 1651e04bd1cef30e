"""Profiles, metrics and votes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import metrics as M
from quern.operators import profile as P
from quern.plans.registry import query
from quern.runtime import table

_PRODUCT = ["product_id", "space_id", "product_code", "canonical_name", "category", "status", "filing_no", "owner", "created_at"]
_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("profile_numeric", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, count(*) - count({c}) AS nulls, round(sum({c}), 2) AS total, round(avg({c}), 6) AS mean, min({c}) AS least, max({c}) AS most, round(stddev_pop({c}), 6) AS sd FROM lineitem" for c in _NUM))
def _(spark, d):
    p = P.numeric_profile(table(spark, d, "lineitem"), _NUM)
    return p.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 6), "sd": F.round("sd", 6)})


@query("profile_quartiles", "SELECT p_brand, n, CASE WHEN n >= 5 THEN a[n // 4 + 1] END AS q1, (a[(n - 1) // 2 + 1] + a[n // 2 + 1]) / 2 AS median, CASE WHEN n >= 5 THEN a[3 * n // 4 + 1] END AS q3 FROM (SELECT p_brand, count(*) AS n, list(p_retailprice ORDER BY p_retailprice) AS a FROM part GROUP BY p_brand)")
def _(spark, d):
    return P.quartiles(table(spark, d, "part"), "p_retailprice", ["p_brand"])


@query("profile_text", r"SELECT source, count(*) AS n, sum(length(text))::BIGINT AS chars, sum(len(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')))::BIGINT AS words, round(avg(length(text)), 6) AS mean_chars, round(avg(len(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))), 6) AS mean_words, count(DISTINCT text) AS n_distinct FROM documents GROUP BY source")
def _(spark, d):
    return P.text_profile(table(spark, d, "documents"), "text", ["source"]).withColumns({"mean_chars": F.round("mean_chars", 6), "mean_words": F.round("mean_words", 6)})


@query("profile_keywords", "SELECT lang, word, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank FROM (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '[\\x{4E00}-\\x{9FFF}]{2,}|[a-zäöüßéèêàâçñáíóú]{3,}')) AS word FROM documents) GROUP BY ALL)) WHERE rank <= 20")
def _(spark, d):
    return P.keyword_frequency(table(spark, d, "documents"), "text", keys=["lang"])


@query("profile_records", " UNION ALL ".join(f"SELECT '{c}' AS field, count({c}) AS n, count(*) - count({c}) AS nulls FROM insurance_products" for c in _PRODUCT))
def _(spark, d):
    return P.record_profile(table(spark, d, "insurance_products")).select("field", "n", "nulls")


_RANKED = """r AS (SELECT o_custkey AS q, list(o_orderkey ORDER BY o_totalprice DESC, o_orderkey)[1:10] AS found, list(o_orderkey) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS t FROM orders GROUP BY 1),
h AS (SELECT q, found, coalesce(t, []) AS t, list_transform(found, lambda x: CASE WHEN list_contains(coalesce(t, []), x) THEN 1 ELSE 0 END) AS rel FROM r),
s AS (SELECT q, found, t, rel, list_sum(rel) AS hits, least(len(t), 3) AS n3, least(len(t), 10) AS n10 FROM h)"""


def _ranked(spark, d):
    o = table(spark, d, "orders")
    top = o.withColumn("r", F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")))
    g = top.groupBy(F.col("o_custkey").alias("q")).agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("r") <= 10, F.struct("r", "o_orderkey")))), lambda x: x.o_orderkey).alias("found"),
        F.collect_list(F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderkey"))).alias("t"),
    )
    return g.withColumn("truths", F.array("t"))


@query(
    "ir_metrics",
    f"""WITH {_RANKED} SELECT q, round(hits / len(found), 6) AS p, round(CASE WHEN len(t) > 0 THEN hits / len(t) ELSE 0 END, 6) AS r,
round(coalesce(1.0 / nullif(list_position(rel, 1), 0), 0), 6) AS mrr,
round(CASE WHEN hits > 0 THEN list_sum(list_transform(range(1, len(rel) + 1), lambda i: CASE WHEN rel[i] = 1 THEN list_sum(rel[1:i])::DOUBLE / i ELSE 0 END)) / hits ELSE 0 END, 6) AS map,
round(CASE WHEN n3 > 0 THEN list_sum(list_transform(range(1, least(len(rel), 3) + 1), lambda i: rel[i] / log2(i + 1))) / list_sum(list_transform(range(1, n3 + 1), lambda i: 1 / log2(i + 1))) ELSE 0 END, 6) AS ndcg3,
round(CASE WHEN n10 > 0 THEN list_sum(list_transform(range(1, len(rel) + 1), lambda i: rel[i] / log2(i + 1))) / list_sum(list_transform(range(1, n10 + 1), lambda i: 1 / log2(i + 1))) ELSE 0 END, 6) AS ndcg10 FROM s""",
)
def _(spark, d):
    g = _ranked(spark, d)
    f, t = F.col("found"), F.col("truths")
    p, r = M.precision_recall(f, t)
    return g.select("q", F.round(p, 6).alias("p"), F.round(r, 6).alias("r"), F.round(M.reciprocal_rank(f, t), 6).alias("mrr"), F.round(M.average_precision(f, t), 6).alias("map"), F.round(M.ndcg(f, t, 3), 6).alias("ndcg3"), F.round(M.ndcg(f, t, 10), 6).alias("ndcg10"))


def _versions(spark, d):
    """Of each fact the first annotation as gold, and the last as predicted."""
    g = table(spark, d, "golden_records").select("record_id", "product_id", "doc", "field_id", "tri_state", "value").distinct()
    k = ["product_id", "doc", "field_id"]
    pick = lambda f: g.groupBy(*k).agg(f(F.struct("record_id", "tri_state", "value")).alias("m")).select(*k, "m.tri_state", "m.value")
    return pick(F.min), pick(F.max), k


_GP = """g AS (SELECT DISTINCT record_id, product_id, doc, field_id, tri_state, value FROM golden_records),
a AS (SELECT product_id, doc, field_id, arg_min(tri_state, record_id) AS gs, arg_min(ROW(value), record_id)[1] AS gv, arg_max(tri_state, record_id) AS ps, arg_max(ROW(value), record_id)[1] AS pv FROM g GROUP BY ALL)"""


@query("extraction_eval", f"WITH {_GP}, e AS (SELECT *, coalesce(lower(trim(gv)) = lower(trim(pv)), false) AS same FROM a) SELECT field_id, sum((gs = 'present' AND ps = 'present' AND same)::INT)::BIGINT AS tp, sum((ps = 'present' AND NOT (gs = 'present' AND same))::INT)::BIGINT AS fp, sum((gs = 'present' AND NOT (ps = 'present' AND same))::INT)::BIGINT AS fn, sum((ps = 'present' AND gs <> 'present' AND gv IS NULL)::INT)::BIGINT AS hallucinated FROM e GROUP BY field_id")
def _(spark, d):
    gold, pred, k = _versions(spark, d)
    return M.extraction_eval(gold, pred, k, by="field_id")


@query("state_confusion", f"WITH {_GP} SELECT gs AS gold_state, ps AS predicted_state, count(*) AS n FROM a GROUP BY ALL")
def _(spark, d):
    gold, pred, k = _versions(spark, d)
    return M.confusion(gold, pred, k)


@query("majority_vote", "WITH v AS (SELECT product_id, doc, field_id, value, count(*) AS votes FROM (SELECT DISTINCT record_id, product_id, doc, field_id, value FROM golden_records) WHERE value IS NOT NULL GROUP BY ALL) SELECT product_id, doc, field_id, value, votes FROM v QUALIFY row_number() OVER (PARTITION BY product_id, doc, field_id ORDER BY votes DESC, value) = 1 AND votes >= 2")
def _(spark, d):
    g = table(spark, d, "golden_records").select("record_id", "product_id", "doc", "field_id", "value").distinct()
    return M.majority(g, ["product_id", "doc", "field_id"], "value")


@query("ppm_ratios", "SELECT product_id, CASE WHEN count(*) <> 0 THEN (sum((tri_state = 'present')::INT) * 1000000 // count(*))::BIGINT END AS present_ppm FROM golden_records GROUP BY product_id")
def _(spark, d):
    g = table(spark, d, "golden_records").groupBy("product_id").agg(F.count_if(F.col("tri_state") == "present").alias("a"), F.count("*").alias("b"))
    return g.select("product_id", M.ppm(F.col("a"), F.col("b")).alias("present_ppm"))


@query("box_iou", "SELECT p_partkey, CASE WHEN u <> 0 THEN (i * 1000000 // u)::BIGINT END AS iou FROM (SELECT p_partkey, i, 100 * 100 + s * s - i AS u FROM (SELECT p_partkey, p_size::BIGINT AS s, greatest(least(100, 50 + p_size) - 50, 0) * greatest(least(100, 80 + p_size) - 80, 0) AS i FROM part))")
def _(spark, d):
    s = F.col("p_size").cast("long")
    n = lambda v: F.lit(v).cast("long")
    return table(spark, d, "part").select("p_partkey", M.iou_ppm([n(0), n(0), n(100), n(100)], [n(50), n(80), 50 + s, 80 + s]).alias("iou"))


@query("regression_gate", "WITH b AS (SELECT l_returnflag AS k, avg(l_discount) AS base FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1), n AS (SELECT l_returnflag AS k, avg(l_discount) AS now FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) SELECT k, CASE WHEN base IS NULL THEN 'skip' WHEN now IS NULL OR base - now > 0.0001 THEN 'fail' ELSE 'pass' END AS verdict FROM b FULL JOIN n USING (k)")
def _(spark, d):
    x = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("k"), "l_linestatus").agg(F.avg("l_discount").alias("m"))
    return M.regression(x.where("l_linestatus = 'F'"), x.where("l_linestatus = 'O'"), "k", "m", 0.0001).select("k", "verdict")


@query("generation_scores")
def _(spark, d):
    e = table(spark, d, "eval_items").select("item_id", T.words(F.col("passage")).alias("h"), T.words(F.concat_ws(" ", "question", "answer")).alias("r"))
    s = M.generation_scores(e, "h", "r", "item_id")
    return s.select("item_id", *(F.round(c, 6).alias(c) for c in s.columns[1:]))


@query("rouge1_sets", r"SELECT item_id, round(CASE WHEN i > 0 THEN 2 * (i / a) * (i / b) / (i / a + i / b + 1e-8) ELSE 0 END, 6) AS rouge1 FROM (SELECT item_id, len(list_intersect(x, y))::DOUBLE AS i, len(x)::DOUBLE AS a, len(y)::DOUBLE AS b FROM (SELECT item_id, list_distinct(regexp_extract_all(lower(passage), '[\p{L}\p{N}]+')) AS x, list_distinct(regexp_extract_all(lower(question || ' ' || answer), '[\p{L}\p{N}]+')) AS y FROM eval_items))")
def _(spark, d):
    e = table(spark, d, "eval_items").select("item_id", T.words(F.col("passage")).alias("h"), T.words(F.concat_ws(" ", "question", "answer")).alias("r"))
    return M.generation_scores(e, "h", "r", "item_id").select("item_id", F.round("rouge1", 6).alias("rouge1"))
