"""From hits to results: scopes, score adjustment, joins with chunks and documents, and results of several searches put together."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.retrieval import top

# Kinds of chunks that a search may return, and those that only describe tables.
SEARCHABLE = ("text", "summary", "table_column", "table_summary", "faq", "image_ocr", "image_caption")
TABLE_KINDS = ("table_column", "table_summary")
# What tools ask of a base.
TOOL_CAPABILITIES = {"vector_search": ("vector",), "keyword_search": ("keyword",), "grep_chunks": ("keyword", "vector"), "wiki_read": ("wiki",), "graph_query": ("graph",), "faq_search": ("faq",)}
WIKI_BOOST = 1.3


def scope_condition(targets: Iterable[Mapping], base: str = "knowledge_base_id", tenant: str = "tenant_id", document: str = "knowledge_id", tagged: str | None = None) -> Column:
    """Targets joined by OR; each is ``{"base": .., "tenant": .., "documents": [..], "tags": [..]}`` whose parts hold together; no target means no row.

    ``tagged`` is an array column with the tags of the row's document (see
    ``with_tags``); without it a target with tags holds for no row.
    """
    out = F.lit(False)
    for t in targets:
        c = F.col(base) == t["base"]
        if t.get("tenant") is not None:
            c = c & (F.col(tenant) == t["tenant"])
        if t.get("documents"):
            c = c & F.col(document).isin(list(t["documents"]))
        if t.get("tags"):
            c = c & (F.arrays_overlap(F.col(tagged), F.array(*map(F.lit, t["tags"]))) if tagged else F.lit(False))
        out = out | F.coalesce(c, F.lit(False))
    return out


def with_tags(df: DataFrame, relations: DataFrame, document: str, tag: str, into: str = "tags") -> DataFrame:
    """``df`` with the distinct tags of each row's document, an empty array for none."""
    t = relations.where(F.col(tag).isNotNull()).groupBy(document).agg(F.array_sort(F.collect_set(tag)).alias(into))
    return df.join(t, document, "left").withColumn(into, F.coalesce(into, F.array().cast(t.schema[into].dataType)))


def not_deleted(df: DataFrame, deleted_at: str = "deleted_at") -> DataFrame:
    """Rows that weren't soft-deleted; tables without such a column stay whole."""
    return df.where(F.col(deleted_at).isNull()) if deleted_at in df.columns else df


def any_tag(documents: DataFrame, relations: DataFrame, document: str, tag: str, tags: Sequence) -> DataFrame:
    """Documents that have any of the tags; no tags, no documents."""
    return documents.join(relations.where(F.col(tag).isin(list(tags))).select(document), document, "left_semi")


def searchable(kind: Column) -> Column:
    return kind.isin(*SEARCHABLE)


def without_table_chunks(df: DataFrame, kind: str = "chunk_type") -> DataFrame:
    return df.where(F.col(kind).isNull() | ~F.col(kind).isin(*TABLE_KINDS))


def is_data_file(name: Column) -> Column:
    return F.lower(name).rlike(r"\.(csv|xlsx|xls)$")


def matches_queries(text: Column, phrases: Column, tokens: Column) -> Column:
    """Whether a text holds any phrase or any token as a substring, whatever the case; blank ones match nothing."""
    low = F.lower(text)
    hit = lambda x: (F.trim(x) != "") & F.contains(low, F.lower(F.trim(x)))
    return F.exists(phrases, hit) | F.exists(tokens, hit)


def any_capability(have: Column, tools: Iterable[str]) -> Column:
    """Whether a base has any of the capabilities that the tools ask for; tools that ask for none pass every base."""
    need = sorted({c for t in tools for c in TOOL_CAPABILITIES.get(t, ())})
    return F.arrays_overlap(have, F.array(*map(F.lit, need))) if need else F.lit(True)


def needs_retrieval(intent: Column, web: Column, kinds: Sequence[str] = ("kb_search", "mixed", "follow_up"), web_kinds: Sequence[str] = ("web_search",)) -> Column:
    """Whether a query's intent needs retrieval; web intents only with the web flag."""
    return intent.isin(*kinds) | (intent.isin(*web_kinds) & F.coalesce(web, F.lit(False)))


def recall_threshold(explicit: Column, threshold: float) -> Column:
    """0 for a scope of named documents or tags, else the threshold."""
    return F.when(explicit, F.lit(0.0)).otherwise(F.lit(float(threshold)))


def engine_score(score: Column, retriever: Column, engine: Column, engines: int = 2) -> Column:
    """Scores of several engines on one scale: keyword scores stay, milvus cosines go from -1..1 to 0..1, others are clamped; with one engine nothing changes."""
    if engines < 2:
        return score
    clamped = F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
    return F.when(retriever == "keywords", score).when(engine == "milvus", (score + 1) / 2).otherwise(clamped)


def faq_boost(score: Column, kind: Column, boost: float) -> Column:
    """Scores of faq chunks times the boost, at most 1; a boost of 1 or less changes nothing."""
    return F.when(kind == "faq", F.least(score * boost, F.lit(1.0))).otherwise(score) if boost > 1 else score


def wiki_boost(df: DataFrame, score: str = "score", kind: str = "chunk_type", order: str = "rank", key: str = "query_id", boost: float = WIKI_BOOST) -> DataFrame:
    """Scores of wiki pages times the boost, and ranks anew; equal scores keep their order."""
    s = df.withColumn(score, F.when(F.col(kind) == "wiki_page", F.col(score) * boost).otherwise(F.col(score)))
    return s.withColumn(order, F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), order)))


def assemble(hits: DataFrame, chunks: DataFrame, documents: DataFrame, chunk: str = "chunk_id", document: str = "knowledge_id") -> DataFrame:
    """Hits with their chunk's and document's columns; hits without either are dropped. Columns of one name are the hit's, then the chunk's."""
    c = chunks.select(chunk, *(x for x in chunks.columns if x != chunk and x not in hits.columns))
    j = hits.join(c, chunk)
    d = documents.select(document, *(x for x in documents.columns if x != document and x not in j.columns))
    return j.join(d, document)


def own_then_shared(ids: DataFrame, own: DataFrame, shared: DataFrame, key: str) -> DataFrame:
    """Rows of ``own`` for the ids, and for those it hasn't the rows of ``shared`` (already cut to what may be read); ``shared_row`` tells which."""
    first = own.join(ids.select(key).distinct(), key, "left_semi")
    rest = ids.select(key).distinct().join(own.select(key), key, "left_anti")
    return first.withColumn("shared_row", F.lit(False)).unionByName(shared.join(rest, key, "left_semi").withColumn("shared_row", F.lit(True)))


def with_grandparent(images: DataFrame, chunks: DataFrame, parent: str = "parent_id", id_col: str = "id", content: str = "content") -> DataFrame:
    """``content`` from the parent's parent, else the parent, else the row's own (image, text, parent); ``hops`` tells how far."""
    p = chunks.select(F.col(id_col).alias(parent), F.col(parent).alias("_up"), F.col(content).alias("_c1"))
    g = chunks.select(F.col(id_col).alias("_up"), F.col(content).alias("_c2"))
    j = images.join(p, parent, "left").join(g, "_up", "left")
    hops = F.when(F.col("_c2").isNotNull(), 2).when(F.col("_c1").isNotNull(), 1).otherwise(0)
    return j.withColumn("hops", hops).withColumn(content, F.coalesce("_c2", "_c1", content)).drop("_up", "_c1", "_c2")


def enrichment_ids(hits: DataFrame, chunk: str, parent: str, related: str, before: str, after: str) -> DataFrame:
    """id, reason of the chunks to fetch beside the hits: parent, related (a JSON array) and neighbours, none that is a hit itself; the first reason holds."""
    rel = F.from_json(related, "array<string>")
    some = F.concat(F.array(F.struct(F.lit(0).alias("o"), F.col(parent).alias("id"))), F.transform(F.coalesce(rel, F.array().cast("array<string>")), lambda x: F.struct(F.lit(1).alias("o"), x.alias("id"))), F.array(F.struct(F.lit(2).alias("o"), F.col(before).alias("id")), F.struct(F.lit(2).alias("o"), F.col(after).alias("id"))))
    all_ = hits.select(F.explode(some).alias("x")).select("x.*").where("id is not null and id <> ''")
    new = all_.join(hits.select(F.col(chunk).alias("id")), "id", "left_anti").groupBy("id").agg(F.min("o").alias("o"))
    return new.select("id", F.element_at(F.array(F.lit("parent"), F.lit("related"), F.lit("nearby")), F.col("o") + 1).alias("reason"))


def unseen_graph_chunks(nodes: DataFrame, seen: DataFrame, chunks: str = "chunks", id_col: str = "chunk_id") -> DataFrame:
    """chunk_id of the chunks of graph nodes that aren't among the results yet, with score 1."""
    g = nodes.select(F.explode(chunks).alias(id_col)).where(F.col(id_col).isNotNull()).distinct()
    return g.join(seen.select(id_col), id_col, "left_anti").withColumn("score", F.lit(1.0))


def delete_namespace(nodes: DataFrame, edges: DataFrame, spaces: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges without those of the given namespaces."""
    return nodes.join(spaces, list(keys), "left_anti"), edges.join(spaces, list(keys), "left_anti")


def with_session(messages: DataFrame, sessions: DataFrame, key: str = "session_id") -> DataFrame:
    """Messages with their session; those of deleted or unknown sessions are dropped."""
    return messages.join(not_deleted(sessions), key)


def with_origin(sessions: DataFrame, mapping: DataFrame, key: str = "session_id") -> DataFrame:
    """Sessions with the columns of their mapping, null where there is none."""
    return sessions.join(mapping, key, "left")


def session_filter(df: DataFrame, source: str | None = None, keyword: str | None = None, origin: str = "origin", title: str = "title") -> DataFrame:
    """Sessions of a source (``web`` means without an origin, else a prefix of the origin) whose title holds a keyword."""
    if source == "web":
        df = df.where(F.col(origin).isNull())
    elif source:
        df = df.where(F.startswith(F.col(origin), F.lit(source)))
    if keyword:
        df = df.where(F.contains(F.lower(F.col(title)), F.lit(keyword.lower())))
    return df


def pinned_first(pinned: str, pinned_at: str, updated: str) -> list[Column]:
    return [F.desc(F.coalesce(F.col(pinned), F.lit(False))), F.desc_nulls_last(pinned_at), F.desc_nulls_last(updated)]


def rendered_faq(question: Column, answers: Column) -> Column:
    """``Q: ..`` and, if there are answers, ``A: ..`` with one line for each."""
    some = F.filter(F.coalesce(answers, F.array().cast("array<string>")), lambda x: F.coalesce(F.trim(x), F.lit("")) != "")
    return F.concat_ws("\n", F.concat(F.lit("Q: "), question), F.when(F.size(some) > 0, F.concat(F.lit("A: "), F.array_join(some, "\n"))))


def by_retriever(results: DataFrame, column: str = "retriever") -> tuple[DataFrame, DataFrame]:
    """(vector, keyword) results."""
    return results.where(F.col(column) == "vector"), results.where(F.col(column) == "keywords")


def breakdown(results: DataFrame, origin: str = "origin", keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """keys, total, web, documents: how many results come from where."""
    web = F.count_if(F.coalesce(F.col(origin) == "web", F.lit(False)))
    return results.groupBy(*keys).agg(F.count("*").alias("total"), web.alias("web"), (F.count("*") - web).alias("documents"))


def merged_images(df: DataFrame, key: str, order: str, images: str, url: str = "url") -> DataFrame:
    """key, images: the union of the rows' arrays of images, of each address the first in the order of rows and of the array."""
    e = df.select(key, F.col(order).alias("_row"), F.posexplode(images).alias("_at", "_i"))
    one = e.groupBy(key, F.col(f"_i.{url}").alias("_u")).agg(F.min(F.struct("_row", "_at", "_i")).alias("m"))
    return one.groupBy(key).agg(F.array_sort(F.collect_list("m")).alias("a")).select(key, F.transform("a", lambda x: x["_i"]).alias(images))


def tenants_of(targets: DataFrame, base: str, tenant: str, order: str) -> DataFrame:
    """base, tenant: each base once, with the tenant of its first target."""
    return targets.groupBy(base).agg(F.min_by(tenant, order).alias(tenant))


def fan_out(parts: Sequence[DataFrame]) -> DataFrame:
    """The results of all stores; one that fails lets the whole query fail."""
    return reduce(DataFrame.unionByName, parts)


def union_results(parts: Sequence[DataFrame], id_col: str = "id", content: str | None = None, score: str = "score", key: str = "query_id") -> DataFrame:
    """Results of several searches together: of one id, then of one content, the best score (then the least id) holds."""
    u = fan_out(parts)
    keep = lambda df, by: df.withColumn("_r", F.row_number().over(Window.partitionBy(key, *by).orderBy(F.desc(score), id_col))).where("_r = 1").drop("_r")
    u = keep(u, [F.col(id_col)])
    return keep(u, [F.md5(F.trim(F.regexp_replace(F.lower(F.col(content)), r"\s+", " ")))]) if content else u


def filtered_topk(hits: DataFrame, negatives: DataFrame, k: int, key: str = "query_id", id_col: str = "id", score: str = "score") -> DataFrame:
    """The best ``k`` ids of each query that aren't among its negatives, each id once.

    One pass: what deepening a search round by round finds, and also hits that
    its last round would not reach.
    """
    best = hits.groupBy(key, id_col).agg(F.max(score).alias(score))
    return top(best.join(negatives.select(key, id_col).distinct(), [key, id_col], "left_anti"), k, [F.desc(score), F.col(id_col)], [key])


def knn_request(vector: Sequence[float], k: int, threshold: float = 0.0, filters: Mapping | None = None) -> dict:
    """The body of a filtered nearest-neighbour request; ``min_score`` only for a threshold above 0."""
    body = {"size": k, "query": {"knn": {"embedding": {"vector": list(vector), "k": k, "filter": {"bool": {"filter": [{"terms": {c: list(v)}} for c, v in sorted((filters or {}).items()) if v]}}}}}}
    return {**body, "min_score": threshold} if threshold > 0 else body


def match_request(text: str, k: int, threshold: float = 0.0, filters: Mapping | None = None) -> dict:
    """The body of a filtered BM25 request."""
    body = {"size": k, "query": {"bool": {"must": [{"match": {"content": text}}], "filter": [{"terms": {c: list(v)}} for c, v in sorted((filters or {}).items()) if v]}}}
    return {**body, "min_score": threshold} if threshold > 0 else body
