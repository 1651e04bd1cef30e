"""JSON of models, images, phrases and other marks in texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import jsontext as J
from quern.functions import markup as M
from quern.plans.registry import query
from quern.runtime import table


@query("json_repaired", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_valid(props)")
def _(spark, d):
    e = table(spark, d, "events").where(F.try_parse_json("props").isNotNull())
    # fenced, with a comma too many, without its last bracket, or with words around it
    i = F.col("event_id") % 4
    broken = F.when(i == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(i == 1, F.replace(F.col("props"), F.lit("}"), F.lit(",}"))).when(i == 2, F.replace(F.col("props"), F.lit("}"), F.lit(""))).otherwise(F.concat(F.lit("Here it is: "), "props", F.lit(" Anything else?")))
    return e.select("event_id", J.response(broken, "k bigint")["k"].alias("k"))


@query("json_nested_set", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id AS u FROM events WHERE user_id IS NOT NULL AND json_valid(props)")
def _(spark, d):
    e = table(spark, d, "events").where(F.col("user_id").isNotNull() & F.try_parse_json("props").isNotNull())
    s = J.with_path(F.col("props"), ["a", "b"], F.col("user_id").cast("string"))
    return e.select("event_id", s.alias("j")).select("event_id", F.get_json_object("j", "$.k").cast("long").alias("k"), F.get_json_object("j", "$.a.b").cast("long").alias("u"))


@query("json_rewrite", "SELECT item_id, question AS query, suite AS intent FROM eval_items")
def _(spark, d):
    e = table(spark, d, "eval_items")
    q = F.when(F.col("item_id") % 2 == 0, F.to_json(F.struct(F.col("question").alias("rewritten_query"), F.col("suite").alias("intent_type")))).otherwise(F.concat(F.lit("```\n"), F.to_json(F.struct(F.col("question").alias("query"), F.col("suite").alias("intent"))), F.lit("\n```")))
    return e.select("item_id", J.rewrite_output(q).alias("r")).select("item_id", "r.query", "r.intent")


@query("text_slug_valid", r"SELECT product_id, CASE WHEN regexp_full_match(s, '[a-z0-9一-鿿-]+(/[a-z0-9一-鿿-]+)*') THEN s END AS slug FROM (SELECT product_id, regexp_replace(lower(trim(canonical_name, ' ')), '[ \t\n\r\f\x0B]+', '-', 'g') AS s FROM insurance_products)")
def _(spark, d):
    return table(spark, d, "insurance_products").select("product_id", M.slug_or_null(F.col("canonical_name")).alias("slug"))


@query("text_for_embedding", r"SELECT doc_id, md5(left(regexp_replace(text || ' data:image/png;base64,AAAA', 'data:image/[a-zA-Z0-9.+-]+;base64,[A-Za-z0-9+/=\s]+', '[image]', 'g'), 20000)) AS h FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(M.for_embedding(F.concat("text", F.lit(" data:image/png;base64,AAAA")))).alias("h"))


@query("text_image_refs", r"SELECT doc_id, 'a(' || doc_id || ').png' AS url, coalesce(lang, '') AS alt FROM documents")
def _(spark, d):
    t = F.concat("text", F.lit("\n!["), F.coalesce("lang", F.lit("")), F.lit("](a("), F.col("doc_id"), F.lit(').png "x")'))
    return table(spark, d, "documents").select("doc_id", F.element_at(M.image_refs(t), -1).alias("r")).select("doc_id", "r.url", "r.alt")


@query("text_phrases", r"SELECT item_id, list_distinct(list_filter(list_transform(regexp_extract_all(question, '[\"“”「『]([^\"“”「」『』\n]+)[\"“”」』]', 1), lambda x: trim(x, ' ')), lambda x: octet_length(encode(x)) > 2)).len()::INT AS n, len(list_distinct(list_filter(list_transform(regexp_split_to_array(question, '[,，;；、。！？!?\s]+'), lambda x: trim(x, ' ')), lambda x: octet_length(encode(x)) > 5)))::INT AS parts FROM eval_items")
def _(spark, d):
    return table(spark, d, "eval_items").select("item_id", F.size(M.phrases(F.col("question"))).alias("n"), F.size(M.segments(F.col("question"))).alias("parts"))


@query("text_expansions")
def _(spark, d):
    return table(spark, d, "eval_items").select("item_id", M.expansions(F.col("question")).alias("variants"))


@query("text_pruned_images", "SELECT doc_id, md5(trim(regexp_replace(text || chr(10) || '![k](keep.png)', '\n{3,}', chr(10) || chr(10), 'g'), ' ')) AS h FROM documents WHERE NOT contains(text, '![')")
def _(spark, d):
    t = F.concat("text", F.lit("\n![k](keep.png)![x](drop(1).png)"))
    return table(spark, d, "documents").where(~F.contains("text", F.lit("!["))).select("doc_id", F.md5(M.prune_images(t, F.array(F.lit("keep.png")))).alias("h"))


@query("text_image_info", "SELECT doc_id, md5(text || chr(10) || chr(10) || '[image] u.png' || CASE WHEN title IS NOT NULL AND title <> '' THEN chr(10) || 'caption: ' || title ELSE '' END || chr(10) || 'text: t') AS h FROM documents")
def _(spark, d):
    i = F.array(F.struct(F.lit("u.png").alias("url"), F.col("title").alias("caption"), F.lit("t").alias("ocr_text")), F.struct(F.lit("v.png").alias("url"), F.lit(None).cast("string").alias("caption"), F.lit("").alias("ocr_text")))
    return table(spark, d, "documents").select("doc_id", F.md5(M.with_image_info(F.col("text"), i)).alias("h"))


@query("text_ocr_clean", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN '' WHEN 2 THEN '' ELSE event_type || ' and more text' END AS t FROM events")
def _(spark, d):
    e, t = F.col("event_id") % 4, F.col("event_type")
    raw = F.when(e == 0, F.concat(F.lit("```text\n"), t, F.lit("\n```"))).when(e == 1, F.lit("No text found.")).when(e == 2, F.lit("<div><p>ab</p></div>")).otherwise(F.concat(F.lit("<p>"), t, F.lit("</p> <b>and more text</b>")))
    return table(spark, d, "events").select("event_id", M.clean_ocr(raw).alias("t"))


@query("name_aliases", r"SELECT product_id, list_sort(list_distinct(list_filter([b, s], lambda x: length(x) >= 4 AND x <> trim(canonical_name, ' ')))) AS aliases FROM (SELECT product_id, canonical_name, b, trim(regexp_replace(b, '\s*(?:Family Shield|Travel Cover)$', ''), ' ') AS s FROM (SELECT product_id, canonical_name, trim(regexp_replace(canonical_name, '[（(][^（）()]*[）)]', '', 'g'), ' ') AS b FROM insurance_products))")
def _(spark, d):
    return table(spark, d, "insurance_products").select("product_id", F.array_sort(M.aliases(F.col("canonical_name"), (), ("Family Shield", "Travel Cover"))).alias("aliases"))


@query("trace_signals", "SELECT event_id, list_filter([CASE WHEN contains(event_type, 'err') THEN 'refusal' END, CASE WHEN value < 50 THEN 'low_score' END, CASE WHEN user_id % 3 = 0 OR user_id IS NULL THEN 'no_reference' END, CASE WHEN event_type = 'click' THEN 'negative_annotation' END], lambda x: x IS NOT NULL) AS signals FROM events")
def _(spark, d):
    refs = F.when((F.col("user_id") % 3 == 0) | F.col("user_id").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.lit("r")))
    return table(spark, d, "events").select("event_id", M.signals(F.col("event_type"), F.col("value"), refs, F.when(F.col("event_type") == "click", "negative"), ("ERR",), 50).alias("signals"))


@query("html_tables", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '<table><tr><td colspan=\"2\">x</td></tr></table>' ELSE chr(10) || '| a | ' || o_orderpriority || ' |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || o_custkey || ' | y\\|z |' || chr(10) END AS t FROM orders")
def _(spark, d):
    t = F.when(F.col("o_orderkey") % 5 == 0, F.lit('<table class="k"><tr><td colspan="2" style="w">x</td></tr></table>')).otherwise(F.concat(F.lit("<table><tr><th>a</th><th>"), "o_orderpriority", F.lit("</th></tr><tr><td><b>"), F.col("o_custkey"), F.lit("</b></td><td>y|z</td></tr></table>")))
    return table(spark, d, "orders").select("o_orderkey", M.table_blocks(t).alias("t"))
