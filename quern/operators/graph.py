"""Graphs of names: merging, matching, link repair and the health of linked pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T


def merge_nodes(nodes: DataFrame, keys: Sequence[str] = ("name",), lists: Sequence[str] = ("chunks",)) -> DataFrame:
    """One node for each key with the union of its lists, sorted."""
    return nodes.groupBy(*keys).agg(*(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in lists))


def clean_edges(edges: DataFrame) -> DataFrame:
    """src, dst, type, weight: edges without loops and null ends, equal ones once with their number as weight."""
    return edges.where("src is not null and dst is not null and src <> dst").groupBy("src", "dst", "type").agg(F.count("*").alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """node, out_degree, in_degree, degree."""
    e = edges.select(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return e.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), F.count("*").alias("degree"))


def match(nodes: DataFrame, edges: DataFrame, terms: Sequence[str], name: str = "name") -> DataFrame:
    """name, type, neighbour: nodes whose name holds a term, with their relations in either direction."""
    hit = F.lit(False)
    for t in terms:
        hit = hit | F.contains(F.lower(F.col(name)), F.lit(t.lower()))
    n = nodes.where(hit).select(F.col(name).alias("name"))
    both = edges.select(F.col("src").alias("name"), "type", F.col("dst").alias("neighbour")).unionByName(edges.select(F.col("dst").alias("name"), "type", F.col("src").alias("neighbour")))
    return n.join(both, "name").distinct()


def _rare_first(sets: DataFrame, freq: DataFrame, threshold: float) -> DataFrame:
    """id, t, g: of each set (id, t) its elements in order of ``freq`` (g, df), rare ones first, with a row for each of those that a set overlapping by ``threshold`` must share one of."""
    o = sets.select("id", F.explode("t").alias("g")).join(freq, "g", "left").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "g"))), lambda s: s.g).alias("t"))
    n = F.size("t")
    return o.select("id", "t", F.explode(F.slice("t", F.lit(1), (n - F.ceil(n * threshold - 1e-9) + 1).cast("int"))).alias("g"))


def resolve_links(links: DataFrame, pages: DataFrame, threshold: float = 0.8) -> DataFrame:
    """link, slug, how: each link's page by its slug, by its normalised title, or by the best overlap of bigrams.

    The fuzzy step meets pages by shared bigrams only among links that the exact
    steps left over.
    """
    norm = lambda c: F.regexp_replace(F.lower(c), r"[\s_-]+", "")
    p = pages.select("slug", norm(F.col("slug")).alias("ns"), norm(F.col("title")).alias("nt"), T.char_bigrams(F.col("title")).alias("pb"))
    lk = links.select("link").distinct()
    a = lk.join(p.select(F.col("slug"), F.col("slug").alias("link")), "link").select("link", "slug", F.lit("exact").alias("how"))
    rest = lk.join(a, "link", "left_anti").withColumn("n", norm(F.col("link")))
    b = rest.join(p.select("slug", F.explode(F.array_distinct(F.array("ns", "nt"))).alias("n")), "n").groupBy("link").agg(F.min("slug").alias("slug")).select("link", "slug", F.lit("normalised").alias("how"))
    rest = rest.join(b, "link", "left_anti").select("link", T.char_bigrams(F.col("link")).alias("lb"))
    # two sets that overlap so share a pair among the rarest few of each, so frequent pairs bring nobody together
    freq = p.select(F.explode("pb").alias("g")).groupBy("g").agg(F.count("*").alias("df"))
    left = _rare_first(rest.select(F.col("link").alias("id"), F.col("lb").alias("t")), freq, threshold).select(F.col("id").alias("link"), F.col("t").alias("lb"), "g")
    right = _rare_first(p.select(F.col("slug").alias("id"), F.col("pb").alias("t")).distinct(), freq, threshold).select(F.col("id").alias("slug"), F.col("t").alias("pb"), "g")
    best = left.join(right, "g").drop("g").distinct()
    best = best.withColumn("s", T.jaccard(F.col("lb"), F.col("pb"))).where(F.col("s") >= threshold)
    c = best.withColumn("r", F.row_number().over(Window.partitionBy("link").orderBy(F.desc("s"), "slug"))).where("r = 1").select("link", "slug", F.lit("fuzzy").alias("how"))
    return a.unionByName(b).unionByName(c)


def health(pages: DataFrame, links: DataFrame, least_chars: int = 50) -> DataFrame:
    """One row: pages, orphans, broken links, short pages and a score of 100 less 100 times the mean of their shares."""
    ids = pages.select("slug")
    real = links.join(ids.withColumnRenamed("slug", "dst"), "dst", "left_semi")
    orphans = ids.join(real.select(F.col("dst").alias("slug")).distinct(), "slug", "left_anti").agg(F.count("*").alias("orphans"))
    broken = links.join(ids.withColumnRenamed("slug", "dst"), "dst", "left_anti").agg(F.count("*").alias("broken"))
    n = pages.agg(F.count("*").alias("pages"), F.count_if(F.length(F.coalesce("content", F.lit(""))) < least_chars).alias("short"))
    m = links.agg(F.count("*").alias("links"))
    j = n.crossJoin(orphans).crossJoin(broken).crossJoin(m)  # one row each
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return j.withColumn("score", F.round(100 - 100 * (share("orphans", "pages") + share("broken", "links") + share("short", "pages")) / 3, 4))


def similar_pairs(items: DataFrame, id_col: str, tokens: str, threshold: float) -> DataFrame:
    """id_a, id_b, score: pairs of distinct rows whose sets overlap by at least ``threshold``, meeting by shared prefix tokens, rare ones first."""
    x = items.select(F.col(id_col).alias("id"), F.array_distinct(tokens).alias("t")).where(F.size("t") > 0)
    df = x.select(F.explode("t").alias("g")).groupBy("g").agg(F.count("*").alias("df"))
    pre = _rare_first(x, df, threshold)
    a, b = pre.select(F.col("id").alias("id_a"), F.col("t").alias("ta"), "g"), pre.select(F.col("id").alias("id_b"), F.col("t").alias("tb"), "g")
    c = a.join(b, "g").where("id_a < id_b and size(tb) >= size(ta) * {0} and size(ta) >= size(tb) * {0}".format(threshold)).drop("g").dropDuplicates(["id_a", "id_b"])
    return c.withColumn("score", T.jaccard(F.col("ta"), F.col("tb"))).where(F.col("score") >= threshold - 1e-9).select("id_a", "id_b", "score")
