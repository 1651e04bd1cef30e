"""Records of knowledge: parents and children, evidence, matching of names, votes and rollups, flags and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as T


def with_parent(children: DataFrame, parents: DataFrame, key: str, id_col: str = "id", content: str = "content") -> DataFrame:
    """``content`` from the parent where there is one, the child's own else; the child's score stays."""
    p = parents.select(F.col(id_col).alias(key), F.col(content).alias("_content"))
    return children.join(p, key, "left").withColumn(content, F.coalesce("_content", content)).drop("_content")


def page_hints(anchors: DataFrame, pages: DataFrame, doc: str, lo: str, hi: str, page: str, slack: int = 1) -> DataFrame:
    """Pages within ``slack`` of an anchor's range; the range is turned into its pages first, so the join is by equality."""
    a = anchors.withColumn(page, F.explode(F.sequence(F.col(lo) - slack, F.col(hi) + slack)))
    return a.join(pages, [doc, page]).dropDuplicates()


def adjacent(a: Column, b: Column, most: int = 1) -> Column:
    """Whether any two pages of two lists are at most ``most`` apart; an empty or null side is true."""
    near = F.exists(a, lambda x: F.exists(b, lambda y: F.abs(x - y) <= most))
    return F.coalesce(F.size(a) <= 0, F.lit(True)) | F.coalesce(F.size(b) <= 0, F.lit(True)) | near


def squeeze(c: Column) -> Column:
    """Without white space, in lower case: what quotes are compared by."""
    return F.regexp_replace(F.lower(c), r"\s+", "")


def lineage(quotes: DataFrame, chunks: DataFrame, doc: str, quote: str, content: str, chunk_id: str) -> DataFrame:
    """``status`` and ``chunk_id`` of each quote: ``linked`` if one chunk of its document holds it, ``ambiguous`` if more do, else ``page_only``."""
    q = quotes.select(doc, quote).distinct()
    c = chunks.select(doc, F.col(chunk_id).alias("_id"), squeeze(F.col(content)).alias("_c"))
    hits = q.join(c, doc).where(F.contains("_c", squeeze(F.col(quote)))).groupBy(doc, quote).agg(F.countDistinct("_id").alias("_n"), F.min("_id").alias("_id"))
    j = q.join(hits, [doc, quote], "left")
    return j.select(doc, quote, F.when(F.col("_n") == 1, "linked").when(F.col("_n") > 1, "ambiguous").otherwise("page_only").alias("status"), F.when(F.col("_n") == 1, F.col("_id")).alias("chunk_id"))


def quote_verdict(quote: Column, page_text: Column) -> Column:
    """``verified``, ``no_evidence`` (no quote or no page) or ``quote_mismatch``."""
    return F.when(quote.isNull() | page_text.isNull() | (F.trim(quote) == ""), "no_evidence").when(F.contains(squeeze(page_text), squeeze(quote)), "verified").otherwise("quote_mismatch")


def dictionary_match(texts: DataFrame, names: DataFrame, id_col: str, text: str, name_id: str, name: str) -> DataFrame:
    """id, name_id, name: names that a text holds as whole words, longer names before those inside them.

    Texts and names meet by their words: a name is looked for only in texts that hold its rarest word.
    """
    n = names.where(F.length(F.trim(name)) > 0).select(F.col(name_id).alias("name_id"), F.col(name).alias("name"), T.normalise(F.col(name)).alias("_n"), T.word_set(F.col(name)).alias("_w")).where(F.size("_w") > 0).distinct()
    df = n.select(F.explode("_w").alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    key = n.select("name_id", "name", "_n", F.explode("_w").alias("w")).join(df, "w").groupBy("name_id", "name", "_n").agg(F.min(F.struct("df", "w")).alias("k")).select("name_id", "name", "_n", F.col("k.w").alias("w"))
    t = texts.select(F.col(id_col).alias("id"), F.concat(F.lit(" "), F.array_join(T.words(F.col(text)), " "), F.lit(" ")).alias("_t"), F.explode(T.word_set(F.col(text))).alias("w"))
    m = t.join(key, "w").where(F.contains("_t", F.concat(F.lit(" "), F.array_join(T.words(F.col("name")), " "), F.lit(" "))))
    # a name inside a longer one that matched the same text is dropped
    g = m.groupBy("id").agg(F.collect_set(F.struct("name_id", "name", "_n")).alias("all"))
    keep = F.filter("all", lambda x: ~F.exists("all", lambda y: (y._n != x._n) & F.contains(F.concat(F.lit(" "), y._n, F.lit(" ")), F.concat(F.lit(" "), x._n, F.lit(" ")))))
    return g.select("id", F.explode(keep).alias("m")).select("id", "m.name_id", "m.name")


def resolve_tiers(candidates: DataFrame, key: str, tier: str, value: str) -> DataFrame:
    """key, value, reason: the value of the least tier if it is one and no higher tier contradicts it, else null with ``ambiguous`` or ``contradicted``."""
    best = candidates.groupBy(key).agg(F.min(tier).alias("_t"))
    j = candidates.join(best, key).groupBy(key).agg(F.collect_set(F.when(F.col(tier) == F.col("_t"), F.col(value))).alias("a"), F.collect_set(F.when(F.col(tier) != F.col("_t"), F.col(value))).alias("b"))
    ok, clash = F.size("a") == 1, (F.size("b") > 0) & (F.size(F.array_intersect("a", "b")) == 0)
    return j.select(key, F.when(ok & ~clash, F.element_at("a", 1)).alias(value), F.when(~ok, "ambiguous").when(clash, "contradicted").otherwise("resolved").alias("reason"))


def zero_filled(df: DataFrame, keys: Sequence[str], kind: str, kinds: Sequence[str]) -> DataFrame:
    """keys and one count for each kind, 0 where there is none."""
    return df.groupBy(*keys).agg(*(F.count_if(F.col(kind) == k).alias(k) for k in kinds))


def pattern_hits(df: DataFrame, doc: str, text: str, patterns: Sequence[str]) -> DataFrame:
    """doc, chunks with a hit, total hits and hits of each pattern (as words or phrases, whatever the case)."""
    hits = [F.regexp_count(F.lower(F.col(text)), F.lit(r"\Q" + p.lower() + r"\E")) for p in patterns]
    h = df.select(doc, *(x.alias(f"p{i}") for i, x in enumerate(hits)))
    total = sum((F.col(f"p{i}") for i in range(1, len(patterns))), F.col("p0"))
    return h.where(total > 0).groupBy(doc).agg(F.count("*").alias("chunks"), F.sum(total).alias("hits"), *(F.sum(f"p{i}").alias(f"p{i}") for i in range(len(patterns))))


def fielded_score(fields: dict[str, tuple[Column, int]], terms: Sequence[str]) -> Column:
    """The sum over terms of the weight of the best field that holds the term."""
    out = F.lit(0)
    for t in terms:
        out = out + F.greatest(F.lit(0), F.lit(0), *(F.when(F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(t.lower())), w).otherwise(0) for c, w in fields.values()))
    return out


def key_point_coverage(expected: Column, answer: Column, threshold: float = 0.8) -> Column:
    """Share of key points that an answer holds as a text, or by so many of their bigrams; null without any."""
    grams = T.char_bigrams(answer)
    held = lambda p: F.contains(squeeze(answer), squeeze(p)) | (F.size(F.array_intersect(T.char_bigrams(p), grams)) >= threshold * F.size(T.char_bigrams(p)))
    points = T.key_points(expected)
    return F.when(F.size(points) > 0, F.size(F.filter(points, held)) / F.size(points))


def has_flag(c: Column, bit: int) -> Column:
    return c.bitwiseAND(bit) != 0


def set_flag(c: Column, bit: int) -> Column:
    return c.bitwiseOR(bit)


def clear_flag(c: Column, bit: int) -> Column:
    return c.bitwiseAND(~bit)


def toggle_flag(c: Column, bit: int) -> Column:
    return c.bitwiseXOR(bit)


def anchors_per_key(df: DataFrame, key: str, order: Sequence[str], k: int) -> DataFrame:
    """The first row of each of the first ``k`` keys."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r").orderBy(*order).limit(k)


def queue_order(df: DataFrame, count: str, risk: str, ranks: Sequence[str], updated: str) -> list[Column]:
    """Most triggers first, then the gravest risk, then the latest."""
    rank = F.coalesce(*(F.when(F.col(risk) == r, F.lit(i)) for i, r in enumerate(ranks)), F.lit(len(ranks)))
    return [F.desc(count), rank, F.desc_nulls_last(updated)]


def values_equal(a: Column, b: Column) -> Column:
    """Equal texts, numbers (thousands parted, 30万 = 300000, 85% = 0.85) or dates; null equals only null."""

    def number(c: Column) -> Column:
        t = F.regexp_replace(F.trim(c), r"[,\s]", "")
        return (
            F.when(t.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), t.cast("double"))
            .when(t.rlike(r"^-?[0-9]+(\.[0-9]+)?%$"), F.regexp_replace(t, "%", "").cast("double") / 100)
            .when(t.rlike(r"^-?[0-9]+(\.[0-9]+)?万$"), F.regexp_replace(t, "万", "").cast("double") * 10_000)
        )

    def date(c: Column) -> Column:
        p = F.regexp_extract(F.trim(c), r"^([0-9]{4})[-/.年]([0-9]{1,2})[-/.月]([0-9]{1,2})日?$", 0)
        d = F.regexp_replace(F.regexp_replace(p, r"[/.年月]", "-"), "日", "")
        return F.when(p != "", F.try_to_date(d, "y-M-d"))

    same = F.coalesce(T.normalise(a) == T.normalise(b), F.lit(False))
    return (a.isNull() & b.isNull()) | same | F.coalesce(F.abs(number(a) - number(b)) < 1e-9, F.lit(False)) | F.coalesce(date(a) == date(b), F.lit(False))


# Texts that stand for no value.
PLACEHOLDERS = ("", "-", "--", "/", "n/a", "na", "null", "none", "tbd", "无", "暂无", "不适用", "未知")


def clean_placeholder(c: Column) -> Column:
    return F.when(F.lower(F.trim(c)).isin(*PLACEHOLDERS), F.lit(None)).otherwise(F.trim(c))


def cursor_encode(ts: Column, id_: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit("|"), id_.cast("string"))


def cursor_decode(c: Column) -> tuple[Column, Column]:
    return F.to_timestamp(F.substring_index(c, "|", 1), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"), F.substring_index(c, "|", -1)


def revisions(old: DataFrame, new: DataFrame, key: str, content: str, version: str = "version") -> tuple[DataFrame, DataFrame]:
    """(pages, revisions): pages with ``new`` in place of changed ones and their version raised, and one revision for each version that was replaced."""
    n = new.select(key, F.col(content).alias("_new"))
    j = old.join(n, key, "full")
    changed = F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col(content))
    pages = j.select(key, F.when(F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col(content)).alias(content), F.when(F.col(version).isNull(), 1).when(changed, F.col(version) + 1).otherwise(F.col(version)).cast("int").alias(version))
    return pages, j.where(changed & F.col(version).isNotNull()).select(key, version, content)
