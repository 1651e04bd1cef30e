"""Text functions over documents and questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.plans.registry import query
from quern.runtime import table

_W = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}]+')"


def w(c: str) -> str:
    return _W.format(c=c)


def _docs(spark, d):
    return table(spark, d, "documents")


@query("text_normalise", r"SELECT doc_id, md5(trim(regexp_replace(lower(text), '[ \t\n\r\f\x0B]+', ' ', 'g'), ' ')) AS h FROM documents")
def _(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(T.normalise(F.col("text"))).alias("h"))


@query("text_signature_dedup", r"SELECT sig, min(doc_id) AS doc_id, count(*) AS copies FROM (SELECT doc_id, md5(trim(regexp_replace(lower(text), '[ \t\n\r\f\x0B]+', ' ', 'g'), ' ')) AS sig FROM documents) GROUP BY sig")
def _(spark, d):
    return _docs(spark, d).select("doc_id", T.signature(F.col("text")).alias("sig")).groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("text_words", f"SELECT doc_id, len({w('text')})::INT AS n, len(list_distinct({w('text')}))::INT AS n_distinct FROM documents")
def _(spark, d):
    return _docs(spark, d).select("doc_id", F.size(T.words(F.col("text"))).alias("n"), F.size(T.word_set(F.col("text"))).alias("n_distinct"))


@query("text_ngrams", f"SELECT g, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(ws)), lambda i: array_to_string(ws[i:i+1], ' '))) AS g FROM (SELECT {w('title')} AS ws FROM documents)) GROUP BY g")
def _(spark, d):
    return _docs(spark, d).select(F.explode(T.ngrams(T.words(F.col("title")), 2)).alias("g")).groupBy("g").agg(F.count("*").alias("n"))


@query("text_char_bigrams", "SELECT product_id, list_sort(list_distinct(list_transform(range(1, greatest(length(t) - 1, 1) + 1), lambda i: substring(t, i, 2)))) AS grams FROM (SELECT product_id, regexp_replace(lower(canonical_name), '\\s+', '', 'g') AS t FROM insurance_products)")
def _(spark, d):
    return table(spark, d, "insurance_products").select("product_id", F.array_sort(T.char_bigrams(F.col("canonical_name"))).alias("grams"))


@query("text_slug", "SELECT product_id, regexp_replace(regexp_replace(regexp_replace(lower(trim(canonical_name)), '\\s+', '-', 'g'), '[^a-z0-9/一-鿿-]', '', 'g'), '^[-/]+|[-/]+$', '', 'g') AS slug FROM insurance_products")
def _(spark, d):
    return table(spark, d, "insurance_products").select("product_id", T.slug(F.col("canonical_name")).alias("slug"))


@query(
    "text_language",
    r"""SELECT doc_id, CASE WHEN han >= 0.15 AND lat >= 0.15 THEN 'mixed' WHEN han > 0.3 THEN 'zh' WHEN regexp_matches(text, '[äöüßÄÖÜ]') OR regexp_matches(lower(text), '\b(der|die|das|und|nicht|wird)\b') THEN 'de' ELSE 'en' END AS language
FROM (SELECT doc_id, text, (n - length(regexp_replace(text, '[\s一-鿿]', '', 'g')))::DOUBLE / n AS han, (n - length(regexp_replace(text, '[\sA-Za-zÄÖÜäöüß]', '', 'g')))::DOUBLE / n AS lat FROM (SELECT doc_id, text, length(regexp_replace(text, '\s', '', 'g')) AS n FROM documents))""",
)
def _(spark, d):
    return _docs(spark, d).select("doc_id", T.language(F.col("text")).alias("language"))


@query(
    "text_token_estimate",
    r"""SELECT item_id, greatest(floor(length(question) / CASE WHEN han >= 0.15 AND lat >= 0.15 THEN 3.0 WHEN han > 0.3 THEN 1.7 WHEN regexp_matches(question, '[äöüßÄÖÜ]') OR regexp_matches(lower(question), '\b(der|die|das|und|nicht|wird)\b') THEN 4.5 ELSE 4.0 END + 0.5), 1)::INT AS n
FROM (SELECT item_id, question, (n - length(regexp_replace(question, '[\s一-鿿]', '', 'g')))::DOUBLE / n AS han, (n - length(regexp_replace(question, '[\sA-Za-zÄÖÜäöüß]', '', 'g')))::DOUBLE / n AS lat FROM (SELECT item_id, question, length(regexp_replace(question, '\s', '', 'g')) AS n FROM eval_items))""",
)
def _(spark, d):
    return table(spark, d, "eval_items").select("item_id", T.token_estimate(F.col("question")).alias("n"))


@query("text_redact", r"SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '[0-9]{17}[0-9Xx]', '[ID]', 'g'), '1[3-9][0-9]{9}', '[PHONE]', 'g'), '[0-9]{10,}', '[POLICY]', 'g')) AS h FROM documents")
def _(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(T.redact(F.col("text"))).alias("h"))


for _kind in ("number", "iso_date", "percent", "code"):

    def _f(spark, d, k=_kind):
        return _docs(spark, d).select("doc_id", F.size(T.entities(F.col("text"), k)).alias("n"))

    query(f"text_entities_{_kind}", f"SELECT doc_id, len(regexp_extract_all(text, '{T.ENTITIES[_kind]}'))::INT AS n FROM documents")(_f)


@query("text_strip_tags", r"SELECT doc_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(text, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '""'), '&#39;', ''''), '&amp;', '&'), '[ \t\n\r\f\x0B]+', ' ', 'g'), ' ')) AS h FROM documents".replace('\'""\'', "'\"'"))
def _(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(T.strip_tags(F.col("text"))).alias("h"))


def _nested(text: str, steps) -> str:
    for rx, to in steps:
        text = f"regexp_replace({text}, '{rx}', {to}, 'g')"
    return text


_P1 = _nested("text", [("(?s)```.*?```", "''"), (r"(?s)\$\$.+?\$\$", "''"), (r"!\[[^\]\n]*\]\([^()\n]*\)", "''"), (r"\[([^\]\n]+)\]\([^()\n]*\)", r"'\1'"), (r"https?://\S+", "''"), (r"<[^<>\n]+>", "''"), (r"(?m)^[ \t]*\|[ \t:|-]+\|[ \t]*$", "''")])
_P2 = r"array_to_string(list_transform(string_split(t, chr(10)), lambda x: CASE WHEN regexp_full_match(x, '[ \t]*\|.*\|[ \t]*') THEN array_to_string(list_transform(string_split(regexp_replace(x, '^[ \t]*\||\|[ \t]*$', '', 'g'), '|'), lambda y: trim(y, ' ')), ', ') ELSE x END), chr(10))"
_P3 = _nested("u", [(r"(?m)^#{1,6}[ ]+", "''"), (r"(?m)^>[ ]?", "''"), (r"(?m)^[ \t]*(?:[-*+]|[0-9]+\.)[ ]+", "''"), (r"\*{1,3}([^*\n]+)\*{1,3}", r"'\1'"), (r"\n{3,}", "chr(10) || chr(10)")])


@query("text_clean_passage", f"SELECT doc_id, md5(trim({_P3}, ' ')) AS h FROM (SELECT doc_id, {_P2} AS u FROM (SELECT doc_id, {_P1} AS t FROM documents))")
def _(spark, d):
    return _docs(spark, d).select("doc_id", F.md5(T.clean_passage(F.col("text"))).alias("h"))


@query("text_truncate", "SELECT doc_id, CASE WHEN length(text) <= 50 THEN text ELSE substring(text, 1, 40) || '…' || right(text, 10) END AS t FROM documents")
def _(spark, d):
    return _docs(spark, d).select("doc_id", T.truncate(F.col("text"), 40, 10).alias("t"))


@query("text_key_points", r"SELECT doc_id, len(list_distinct(list_filter(list_transform(regexp_split_to_array(text, '[;；。\n]'), lambda s: trim(regexp_replace(s, '^\s*(?:[-*•]|[0-9]+[.)、]|[（(][0-9]+[)）])\s*', ''), ' ')), lambda s: length(s) >= 2)))::INT AS n FROM documents")
def _(spark, d):
    return _docs(spark, d).select("doc_id", F.size(T.key_points(F.col("text"))).alias("n"))


@query("text_profile", r"SELECT doc_id, len(ls)::INT AS lines, len(list_filter(ls, lambda s: regexp_matches(s, '^#{1,6} ')))::INT AS headings, len(list_filter(ls, lambda s: regexp_matches(s, '^\s*[-*] ')))::INT AS items, len(list_filter(ls, lambda s: regexp_matches(s, '^\|.*\|$')))::INT AS table_rows, len(list_filter(ls, lambda s: regexp_matches(s, '^\s*$')))::INT AS blanks FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)")
def _(spark, d):
    p = T.profile(F.col("text"))
    return _docs(spark, d).select("doc_id", *(p[k].alias(k) for k in ("lines", "headings", "items", "table_rows", "blanks")))


@query("text_fingerprint", r"SELECT doc_id, substring(sha256(array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '^#{1,6} ')), lambda s: regexp_replace(s, '[0-9\s]', '', 'g')), '|')), 1, 12) AS fp FROM documents")
def _(spark, d):
    return _docs(spark, d).select("doc_id", T.fingerprint(F.col("text")).alias("fp"))


@query("text_jaccard_titles", f"SELECT doc_id, round(CASE WHEN len(u) > 0 THEN len(list_intersect(a, b))::DOUBLE / len(u) ELSE 0 END, 9) AS j, round(CASE WHEN least(len(a), len(b)) > 0 THEN len(list_intersect(a, b))::DOUBLE / least(len(a), len(b)) ELSE 0 END, 9) AS o FROM (SELECT doc_id, a, b, list_distinct(list_concat(a, b)) AS u FROM (SELECT doc_id, list_distinct({w('text')}) AS a, list_distinct({w('title')}) AS b FROM documents WHERE title IS NOT NULL))")
def _(spark, d):
    a, b = T.word_set(F.col("text")), T.word_set(F.col("title"))
    return _docs(spark, d).where("title is not null").select("doc_id", F.round(T.jaccard(a, b), 9).alias("j"), F.round(T.overlap_coefficient(a, b), 9).alias("o"))


@query("text_sentences", r"SELECT doc_id, len(list_filter(list_transform(regexp_split_to_array(text, '[。.]'), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> ''))::INT AS n FROM documents")
def _(spark, d):
    return _docs(spark, d).select("doc_id", F.size(T.sentences(F.col("text"))).alias("n"))


@query("text_escape", r"SELECT DISTINCT source, replace(replace(replace(source, '\', '\\'), '%', '\%'), '_', '\_') AS like_safe, replace(source, '''', '''''') AS quoted FROM documents")
def _(spark, d):
    return _docs(spark, d).select("source", T.like_escape(F.col("source")).alias("like_safe"), T.sql_quote(F.col("source")).alias("quoted")).distinct()


@query("text_human_size", "SELECT request_id, CASE WHEN n < 1024 THEN n || ' B' ELSE printf('%.1f KB', n / 1024.0) END AS size FROM (SELECT DISTINCT request_id, octet_length(file_content) AS n FROM read_requests WHERE file_content IS NOT NULL)")
def _(spark, d):
    r = table(spark, d, "read_requests").where("file_content is not null").select("request_id", F.octet_length("file_content").alias("n")).distinct()
    return r.select("request_id", T.human_size(F.col("n")).alias("size"))


@query("text_tagged_hash", "SELECT DISTINCT release_id, sha256('release' || chr(0) || '1' || chr(0) || candidate_digest) AS h FROM wiki_releases")
def _(spark, d):
    return table(spark, d, "wiki_releases").select("release_id", T.tagged_hash("release", 1, F.col("candidate_digest")).alias("h")).distinct()


@query("text_cjk_tokens", r"SELECT doc_id, (coalesce(list_sum(list_transform(regexp_extract_all(lower(text), '[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}]+'), lambda r: greatest(length(r) - 1, 1))), 0) + len(regexp_extract_all(regexp_replace(lower(text), '[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}]+', ' ', 'g'), '[\p{L}\p{N}]+')))::INT AS n FROM documents")
def _(spark, d):
    return _docs(spark, d).select("doc_id", F.size(T.cjk_tokens(F.col("text"))).alias("n"))


@query("text_query_terms", f"SELECT item_id, list_filter(list_distinct({w('question')}), lambda x: length(x) > 1 AND NOT list_contains({list(dict.fromkeys(T.STOP_WORDS))!r}, x)).list_sort() AS terms FROM eval_items")
def _(spark, d):
    return table(spark, d, "eval_items").select("item_id", F.array_sort(T.query_terms(F.col("question"))).alias("terms"))
