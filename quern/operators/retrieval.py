"""Retrieval: scopes, vector and keyword search, fusion, rescoring, diversity, thresholds."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.functions import vector as V

# The defaults of search.
RRF_K, VECTOR_WEIGHT, KEYWORD_WEIGHT = 60, 0.7, 0.3
EMBEDDING_TOP_K, VECTOR_THRESHOLD, KEYWORD_THRESHOLD = 50, 0.15, 0.3
RERANK_TOP_K, RERANK_THRESHOLD, MMR_LAMBDA = 10, 0.2, 0.7
BM25_K1, BM25_B = 1.2, 0.75


def scope(df: DataFrame, **lists: Sequence | None) -> DataFrame:
    """Rows whose columns are in the given lists; an empty or missing list sets no bound."""
    for c, values in lists.items():
        if values:
            df = df.where(F.col(c).isin(list(values)))
    return df


def exclude(df: DataFrame, **lists: Sequence | None) -> DataFrame:
    """Rows whose columns are in none of the lists; null is in no list."""
    for c, values in lists.items():
        if values:
            df = df.where(F.col(c).isNull() | ~F.col(c).isin(list(values)))
    return df


def enabled(c: Column) -> Column:
    """Null counts as enabled."""
    return c.isNull() | c


def budget(k: int, n_bases: int = 1) -> int:
    """How many rows each retriever fetches for ``k`` results."""
    return min(500, max(5 * k, 50) * n_bases)


def condition(ast: dict) -> Column:
    """A filter tree as a column.

    Nodes: ``{"op": "and"|"or", "args": [...]}``, ``{"op": "not", "arg": ...}``, and
    comparisons ``{"op": eq|ne|gt|gte|lt|lte|in|not_in|like|not_like|between, "field": ..., "value": ...}``.
    """
    op = ast["op"]
    if op in ("and", "or"):
        parts = [condition(x) for x in ast["args"]]
        out = F.lit(op == "and") if not parts else parts[0]
        for p in parts[1:]:
            out = out & p if op == "and" else out | p
        return out
    if op == "not":
        return ~condition(ast["arg"])
    c, v = F.col(ast["field"]), ast.get("value")
    plain = {"eq": c == v, "ne": c != v} if not isinstance(v, (list, tuple)) else {}
    if op in ("gt", "gte", "lt", "lte"):
        return {"gt": c > v, "gte": c >= v, "lt": c < v, "lte": c <= v}[op]
    if op in ("in", "not_in"):
        return c.isin(list(v)) if op == "in" else ~c.isin(list(v))
    if op in ("like", "not_like"):
        return c.like(v) if op == "like" else ~c.like(v)
    if op == "between":
        return c.between(*v)
    if op not in plain:
        raise ValueError(f"unknown operator {op}")
    return plain[op]


#: Queries whose vectors are broadcast at once; more are worked off in blocks.
QUERY_BLOCK = 10_000


def vector_scores(items: DataFrame, queries: DataFrame, threshold: float | None = None, id_col: str = "vec_id", vec_col: str = "embedding", qid_col: str = "query_id", qvec_col: str = "query") -> DataFrame:
    """query_id, id, score: the cosine of every item and every row of a stated query set, at or above the threshold if there is one.

    The queries are counted, and broadcast in blocks of QUERY_BLOCK at most.
    """
    q = queries.select(F.col(qid_col).alias("query_id"), F.col(qvec_col).alias("q"))
    blocks = max(1, -(-q.count() // QUERY_BLOCK))
    out = None
    for b in range(blocks):
        part = q if blocks == 1 else q.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)
        j = items.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).join(F.broadcast(part))
        s = j.select("query_id", "id", V.cosine(F.col("v"), F.col("q")).alias("score"))
        if threshold is not None:
            s = s.where(F.col("score") >= threshold)
        out = s if out is None else out.unionByName(s)
    return out


def vector_topk(items: DataFrame, queries: DataFrame, k: int = EMBEDDING_TOP_K, threshold: float | None = None, id_col: str = "vec_id", vec_col: str = "embedding", qid_col: str = "query_id", qvec_col: str = "query") -> DataFrame:
    """query_id, id, score, rank: exact cosine top ``k`` of each query row, ties by id; each partition keeps its own top ``k`` before anything is shuffled."""
    s = vector_scores(items, queries, threshold, id_col, vec_col, qid_col, qvec_col)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, term, tf, len: how often each document holds each word."""
    t = docs.select(F.col(id_col).alias("id"), T.words(F.col(text_col)).alias("ws")).where(F.size("ws") > 0)
    return t.select("id", F.size("ws").alias("len"), F.explode("ws").alias("term")).groupBy("id", "term", "len").agg(F.count("*").alias("tf"))


def bm25(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", qid_col: str = "query_id", qtext_col: str = "query", k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """query_id, id, score: BM25 of every document that shares a word with a query."""
    p = postings(docs, id_col, text_col)
    q = queries.select(F.col(qid_col).alias("query_id"), F.explode(T.word_set(F.col(qtext_col))).alias("term"))
    stats = docs.select(F.size(T.words(F.col(text_col))).alias("n")).where("n > 0").agg(F.count("*").alias("docs"), F.avg("n").alias("avg_len"))
    hits = p.join(q.select("term").distinct(), "term", "left_semi")
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    j = hits.join(df, "term").join(q, "term").crossJoin(F.broadcast(stats))  # stats is one row
    idf = F.log((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    tf = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avg_len")))
    return j.groupBy("query_id", "id").agg(F.sum(idf * tf).alias("score"))


def keyword_any(docs: DataFrame, words: Sequence[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score 1.0 of the documents that hold any of the words as substrings, whatever the case."""
    cond = F.lit(False)
    for w in words:
        cond = cond | F.contains(F.lower(F.col(text_col)), F.lit(w.lower()))
    return docs.where(cond).select(F.col(id_col).alias("id"), F.lit(1.0).alias("score"))


def top(df: DataFrame, k: int, by: Sequence[Column], keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """The first ``k`` rows of each key in the given order, with their rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where(F.col("rank") <= k)


def fuse(vector: DataFrame, keyword: DataFrame, k: int = RRF_K, wv: float = VECTOR_WEIGHT, wk: float = KEYWORD_WEIGHT) -> DataFrame:
    """query_id, id, score: weighted reciprocal ranks of two lists (query_id, id, score), a list's first place of an id counting."""

    def ranks(df: DataFrame, name: str) -> DataFrame:
        best = df.groupBy("query_id", "id").agg(F.max("score").alias("s"))
        return best.select("query_id", "id", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("s"), "id")).alias(name))

    j = ranks(vector, "rv").join(ranks(keyword, "rk"), ["query_id", "id"], "full")
    return j.select("query_id", "id", (F.coalesce(F.lit(wv) / (F.col("rv") + k), F.lit(0.0)) + F.coalesce(F.lit(wk) / (F.col("rk") + k), F.lit(0.0))).alias("score"), "rv", "rk")


def normalise_keyword(df: DataFrame, score: str = "score", key: str = "query_id") -> DataFrame:
    """Scores of each query to 0..1: one row or equal scores 1; from ten rows on within the 5th and 95th place; else by least and most."""
    # the bounds by rank, in a window that may spill; nothing is collected
    n = df.groupBy(key).agg(F.count("*").alias("_n"))
    r = df.select(key, score).withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(score))).join(n, key)
    many = F.col("_n") >= 10
    low, high = F.when(many, F.floor((F.col("_n") - 1) * 0.05) + 1).otherwise(1), F.when(many, F.floor((F.col("_n") - 1) * 0.95) + 1).otherwise(F.col("_n"))
    b = r.groupBy(key).agg(F.max(F.when(F.col("_r") == low, F.col(score))).alias("lo"), F.max(F.when(F.col("_r") == high, F.col(score))).alias("hi"))
    s = F.when(F.col("hi") <= F.col("lo"), F.lit(1.0)).otherwise(T.clamp((F.col(score) - F.col("lo")) / (F.col("hi") - F.col("lo")), 0.0, 1.0))
    return df.join(b, key).withColumn("normalised", s).drop("lo", "hi")


def best_per_key(df: DataFrame, keys: Sequence[str], score: str = "score", tie: str = "id") -> DataFrame:
    """The row with the best score of each key, ties by the least ``tie``."""
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(score), -F.col(tie))).alias("r"))
    return g.select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest))


def composite(model: Column, base: Column, web: Column, start: Column, end: Column) -> Column:
    """Rerank score: 0.6 model + 0.3 base + 0.1 source weight, times a small prior for early passages, in 0..1."""
    source = F.when(web, 0.95).otherwise(1.0)
    prior = 1 + T.clamp(1 - start / (end + 1), -0.05, 0.05)
    return T.clamp((0.6 * model + 0.3 * base + 0.1 * source) * prior, 0.0, 1.0)


def threshold_with_fallback(df: DataFrame, score: str = "score", threshold: float = RERANK_THRESHOLD, explicit: bool = False, key: str = "query_id") -> DataFrame:
    """Rows at or above the threshold; for queries without any, at max(0.3, 0.7 t) if t > 0.3; else their best row if at least 0.15 (any, with an explicit scope)."""
    w = Window.partitionBy(key)
    lower = max(0.3, 0.7 * threshold) if threshold > 0.3 else threshold
    d = df.withColumn("_best", F.max(score).over(w))
    cut = F.when(F.col("_best") >= threshold, F.lit(threshold)).when(F.col("_best") >= lower, F.lit(lower)).when(F.col("_best") >= (0.0 if explicit else 0.15), F.col("_best"))
    return d.where(F.col(score) >= cut).drop("_best")


def mmr(df: DataFrame, k: int = RERANK_TOP_K, lam: float = MMR_LAMBDA, key: str = "query_id", id_col: str = "id", score: str = "score", tokens: str = "tokens") -> DataFrame:
    """query_id, id, rank: greedy selection by lam * score - (1 - lam) * greatest Jaccard to what is chosen; ties to the earlier row.

    A query's rows are a list of results: cut to what its retrieval budget allows
    (``budget``, 500 at most) before, not here, so no row is left out.
    """
    kind, qkind = df.schema[id_col].dataType.simpleString(), df.schema[key].dataType.simpleString()
    some = df.select(key, id_col, score, tokens)

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([score, id_col], ascending=[False, True])
        sets = [set(t) if t is not None else set() for t in pdf[tokens]]
        scores, near, left, out = pdf[score].tolist(), [0.0] * len(pdf), list(range(len(pdf))), []
        while left and len(out) < k:
            best = max(left, key=lambda i: (lam * scores[i] - (1 - lam) * near[i], -i))
            if lam * scores[best] - (1 - lam) * near[best] <= -1:
                break
            out.append(best)
            left.remove(best)
            for i in left:
                u = len(sets[i] | sets[best])
                near[i] = max(near[i], len(sets[i] & sets[best]) / u if u else 0.0)
        return pd.DataFrame({key: pdf[key].iloc[out].tolist(), id_col: pdf[id_col].iloc[out].tolist(), "rank": range(1, len(out) + 1)})

    return some.groupBy(key).applyInPandas(pick, f"{key} {qkind}, {id_col} {kind}, rank int")


def cap_per_group(df: DataFrame, group: str, per: int, total: int, order: Sequence[Column], key: str = "query_id") -> DataFrame:
    """At most ``per`` rows of each group and ``total`` of each query, best first."""
    a = df.withColumn("_g", F.row_number().over(Window.partitionBy(key, group).orderBy(*order))).where(F.col("_g") <= per)
    return a.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= total).drop("_g")


def round_robin(df: DataFrame, group: str, order: Sequence[Column], k: int, key: str = "query_id") -> DataFrame:
    """The best of each group first, then the second best of each, up to ``k`` rows."""
    a = df.withColumn("_g", F.row_number().over(Window.partitionBy(key, group).orderBy(*order)))
    return a.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("_g", *order))).where(F.col("rank") <= k).drop("_g")


def keyset_page(df: DataFrame, key: str, cursor, size: int = 20) -> DataFrame:
    """The ``size`` newest rows whose key is below the cursor (all, if it is null)."""
    return (df if cursor is None else df.where(F.col(key) < cursor)).orderBy(F.desc(key)).limit(size)


def offset_page(df: DataFrame, order: Sequence[Column], page: int = 1, size: int = 20) -> DataFrame:
    """One page of a total order; page at least 1, size 20 if not positive, at most 1000."""
    size = min(size if size > 0 else 20, 1000)
    return df.orderBy(*order).offset((max(page, 1) - 1) * size).limit(size)


def drop_contained(df: DataFrame, key: str, id_col: str, score: str, tokens: str, limit: float = 0.85) -> DataFrame:
    """Without rows whose words overlap a better row's by at least ``limit`` of the smaller set; ties go to the longer, then the lesser id. The rows of a query are a list of results, as for ``mmr``."""
    some = df.withColumn("_long", -F.size(tokens))
    cols = some.columns

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([score, "_long", id_col], ascending=[False, True, True]).reset_index(drop=True)
        sets, kept = [set(t) if t is not None else set() for t in pdf[tokens]], []
        for i, s in enumerate(sets):
            if not any(s and sets[j] and len(s & sets[j]) / min(len(s), len(sets[j])) >= limit for j in kept):
                kept.append(i)
        return pdf.iloc[kept][cols]

    return some.groupBy(key).applyInPandas(one, some.schema).drop("_long")
