"""Facts with evidence: multisets of atoms, authority, retraction, drift, stale rows and roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def multiset(a: Column, b: Column) -> dict[str, Column]:
    """``shared``, ``missing`` (of a) and ``extra`` (of b): sizes by how often each element stands in either array."""
    both = F.array_distinct(F.concat(a, b))
    times = lambda arr, x: F.size(F.filter(arr, lambda y: y.eqNullSafe(x)))
    total = lambda f: F.aggregate(both, F.lit(0), lambda s, x: s + f(x))
    return {
        "shared": total(lambda x: F.least(times(a, x), times(b, x))),
        "missing": total(lambda x: F.greatest(times(a, x) - times(b, x), F.lit(0))),
        "extra": total(lambda x: F.greatest(times(b, x) - times(a, x), F.lit(0))),
    }


def normalised_value(c: Column) -> Column:
    """Trimmed, white space collapsed, lower case; null becomes ''."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " "))


def state_hash(state: Column, value: Column) -> Column:
    """sha256 over the state and the normalised value."""
    return F.sha2(F.concat_ws("\0", F.coalesce(state, F.lit("")), normalised_value(value)), 256)


def authority(role: Column, at: Column, other_role: Column, other_at: Column, primary: Sequence[str]) -> Column:
    """``higher``, ``lower`` or ``equal``: a primary role outranks others; among the same rank the later time wins (null is before any)."""
    a, b = role.isin(*primary).cast("int"), other_role.isin(*primary).cast("int")
    later = F.when(at.eqNullSafe(other_at), "equal").when(other_at.isNull() | (at > other_at), "higher").otherwise("lower")
    return F.when(a > b, "higher").when(a < b, "lower").otherwise(later)


def retractable(support: DataFrame, fact: Sequence[str], source: str, rank: str, replacement: DataFrame) -> DataFrame:
    """fact, source of the facts that their only source supports and for which ``replacement`` (fact, rank) has a greater rank."""
    one = support.groupBy(*fact).agg(F.min(source).alias(source), F.max(source).alias("_last"), F.max(rank).alias("_rank")).where(F.col(source) == F.col("_last"))
    new = replacement.groupBy(*fact).agg(F.max(rank).alias("_new"))
    return one.join(new, list(fact)).where(F.col("_new") > F.col("_rank")).select(*fact, source)


def stuck(rows: DataFrame, spans: DataFrame, key: str, updated: str, cutoff) -> DataFrame:
    """Rows whose latest span is at or before the cutoff, or that have none."""
    last = spans.groupBy(key).agg(F.max(updated).alias("_last"))
    return rows.join(last, key, "left").where(F.col("_last").isNull() | (F.col("_last") <= F.lit(cutoff))).drop("_last")


def drift(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, drift: ``missing`` for what only the expected side has, ``unexpected`` for what only the actual one has."""
    e, a = expected.select(*keys).distinct(), actual.select(*keys).distinct()
    return e.join(a, list(keys), "left_anti").withColumn("drift", F.lit("missing")).unionByName(a.join(e, list(keys), "left_anti").withColumn("drift", F.lit("unexpected")))


def snapshot(claims: DataFrame, revisions: DataFrame, evidence: DataFrame, key: str, revision: str) -> DataFrame:
    """Claims with their current revision and number of evidences, and ``complete``: whether no required side is missing."""
    e = evidence.groupBy(revision).agg(F.count("*").alias("n_evidence"))
    j = claims.join(revisions.select(revision, *(c for c in revisions.columns if c not in claims.columns), F.lit(True).alias("_r")), revision, "left").join(e, revision, "left")
    return j.withColumn("complete", F.coalesce(F.col("_r"), F.lit(False)) & (F.coalesce("n_evidence", F.lit(0)) > 0)).withColumn("n_evidence", F.coalesce("n_evidence", F.lit(0))).drop("_r")


def json_semi(rows: DataFrame, column: str, path: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose JSON holds one of the keys at a path."""
    j = rows.withColumn("_k", F.get_json_object(column, path))
    return j.join(keys.select(F.col(key).cast("string").alias("_k")).distinct(), "_k", "left_semi").drop("_k")


def refers_to(value: str, scalars: Sequence[str], documents: Mapping[str, Sequence[str]]) -> Column:
    """Whether any scalar column, or any path of a JSON column, is the value."""
    out = F.lit(False)
    for c in scalars:
        out = out | F.coalesce(F.col(c).cast("string") == value, F.lit(False))
    for c, paths in documents.items():
        for p in paths:
            out = out | F.coalesce(F.get_json_object(c, p) == value, F.lit(False))
    return out


def sync_plan(source: DataFrame, target: DataFrame, pairs: DataFrame, fields: Sequence[str], key: str = "id") -> DataFrame:
    """target id, field, value: what has to change for matched pairs (source_id, target_id) to have equal fields; null equals null."""
    s = source.select(F.col(key).alias("source_id"), *(F.col(f).alias(f"_s_{f}") for f in fields))
    t = target.select(F.col(key).alias("target_id"), *(F.col(f).alias(f"_t_{f}") for f in fields))
    j = pairs.join(s, "source_id").join(t, "target_id")
    change = lambda f: F.when(~F.col(f"_s_{f}").eqNullSafe(F.col(f"_t_{f}")), F.struct(F.lit(f).alias("field"), F.col(f"_s_{f}").cast("string").alias("value")))
    return j.select("target_id", F.explode(F.array_compact(F.array(*map(change, fields)))).alias("c")).select("target_id", "c.*")


def matrix(rows: DataFrame, columns: DataFrame, cells: DataFrame, row: str, column: str, state: str, ranks: Sequence[str], missing: str = "unknown") -> DataFrame:
    """row, column, state of every cell of a grid: of several states the one named first in ``ranks``, ``missing`` for none; null is no state.

    Only the distinct rows and columns are crossed, however many there are; Spark's size check decides whether a side is broadcast.
    """
    rank = F.coalesce(*(F.when(F.col(state) == r, F.lit(i)) for i, r in enumerate(ranks)), F.lit(len(ranks)))
    best = cells.where(F.col(state).isNotNull()).groupBy(row, column).agg(F.min(F.struct(rank.alias("r"), F.col(state).alias("s")))["s"].alias(state))
    grid = rows.select(row).distinct().crossJoin(columns.select(column).distinct())
    return grid.join(best, [row, column], "left").withColumn(state, F.coalesce(state, F.lit(missing)))


def gap_cells(grid: DataFrame, state: str, open_states: Sequence[str]) -> DataFrame:
    return grid.where(F.col(state).isin(*open_states))


def classify_quote(quotes: DataFrame, pages: DataFrame, doc: str, quote: str, page: str, text: str, locator: str) -> DataFrame:
    """quotes with ``status`` and ``page``: ``verified`` if one page of the document holds the quote as it is, or the locator names one of several; else ``ambiguous``; ``normalised`` if a page holds it but for white space and case; else ``unlocated``."""
    squeeze = lambda c: F.regexp_replace(F.lower(c), r"\s+", "")
    q = quotes.select(doc, quote, locator).distinct()
    p = pages.select(doc, F.col(page).alias("_p"), F.col(text).alias("_t"))
    hit = q.join(p, doc).withColumn("_exact", F.contains("_t", F.col(quote))).where(F.col("_exact") | F.contains(squeeze(F.col("_t")), squeeze(F.col(quote))))
    g = hit.groupBy(doc, quote, locator).agg(F.countDistinct(F.when(F.col("_exact"), F.col("_p"))).alias("_n"), F.min(F.when(F.col("_exact"), F.col("_p"))).alias("_one"), F.max((F.col("_exact") & (F.col("_p") == F.col(locator))).cast("int")).alias("_named"), F.min("_p").alias("_any"))
    j = q.join(g, [doc, quote, locator], "left")
    status = F.when(F.col("_n") == 1, "verified").when((F.col("_n") > 1) & (F.col("_named") == 1), "verified").when(F.col("_n") > 1, "ambiguous").when(F.col("_any").isNotNull(), "normalised").otherwise("unlocated")
    at = F.when(F.col("_n") == 1, F.col("_one")).when((F.col("_n") > 1) & (F.col("_named") == 1), F.col(locator)).when(F.col("_n") == 0, F.col("_any"))
    return j.select(doc, quote, locator, status.alias("status"), at.alias("page"))


def compared_with(records: DataFrame, master: DataFrame, key: str, field: str, value: str, fields: Mapping[str, str]) -> DataFrame:
    """records with ``disputed``: whether the master row has another value for the field; fields that aren't mapped, or null in the master, aren't compared."""
    pairs = [x for f, c in fields.items() for x in (F.lit(f), F.col(c).cast("string"))]
    m = master.select(key, F.create_map(*pairs).alias("_m"))
    j = records.join(m, key, "left").withColumn("_v", F.try_element_at("_m", F.col(field)))
    same = F.lower(F.trim(F.coalesce(F.col(value), F.lit("")))) == F.lower(F.trim("_v"))
    return j.withColumn("disputed", F.col("_v").isNotNull() & ~same).drop("_m", "_v")


def quality_profile(gold: DataFrame, pred: DataFrame, keys: Sequence[str], by: str, state: str = "tri_state", value: str = "value") -> DataFrame:
    """by, pairs, correct, f1, hallucinations of the aligned records; a present prediction on gold that isn't present is a hallucination, whatever its value."""
    g = gold.select(*keys, F.col(state).alias("gs"), F.col(value).alias("gv"))
    j = g.join(pred.select(*keys, F.col(state).alias("ps"), F.col(value).alias("pv")), list(keys))
    same = F.coalesce(F.lower(F.trim("gv")) == F.lower(F.trim("pv")), F.lit(False))
    gp, pp = F.col("gs") == "present", F.col("ps") == "present"
    tp, ps, gs = F.count_if(gp & pp & same), F.count_if(pp), F.count_if(gp)
    right = F.count_if((F.col("gs") == F.col("ps")) & (~gp | same))
    return j.groupBy(by).agg(F.count("*").alias("pairs"), right.alias("correct"), F.when(ps + gs > 0, 2 * tp / (ps + gs)).otherwise(F.lit(0.0)).alias("f1"), F.count_if(~gp & pp).alias("hallucinations"))


def attributed(misses: DataFrame, cleaned: str, routed: str, evidence_page: str) -> Column:
    """Why a value was missed: cleaned away, no page with evidence, the page not routed to, or nothing extracted from it."""
    return F.when(F.col(cleaned), "cleaning_kill").when(F.col(evidence_page).isNull(), "no_evidence_page").when(~F.coalesce(F.array_contains(routed, F.col(evidence_page)), F.lit(False)), "routing_miss").otherwise("extract_empty")


def roll_up(gaps: DataFrame, key: str, status: str, hits: str, opened: str, closed: str, n: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts by status, the ``n`` keys with the most hits, mean days to closure)."""
    days = F.avg(F.when(F.col(closed).isNotNull(), (F.unix_seconds(F.col(closed).cast("timestamp")) - F.unix_seconds(F.col(opened).cast("timestamp"))) / 86400))
    return gaps.groupBy(status).agg(F.count("*").alias("n")), gaps.orderBy(F.desc(hits), key).limit(n), gaps.agg(days.alias("days"))


def job_metrics(jobs: DataFrame, space: str, state: str, attempts: str, lease: str, now, states: Sequence[str]) -> DataFrame:
    """A row for each space and one for all (null): jobs in each state, attempts and expired leases, by one grouping-sets aggregate."""
    expired = F.count_if(F.col(lease).isNotNull() & (F.col(lease) <= F.lit(now)))
    return jobs.rollup(space).agg(*(F.count_if(F.col(state) == s).alias(s) for s in states), F.sum(attempts).alias("attempts"), expired.alias("expired"))


def count_since(log: DataFrame, since, ts: str, **equals) -> DataFrame:
    """n: rows at or after a time with the given values."""
    for c, v in equals.items():
        log = log.where(F.col(c) == v)
    return log.where(F.col(ts) >= F.lit(since)).agg(F.count("*").alias("n"))


def sample_titles(df: DataFrame, key: str, title: str, order: str, n: int = 5) -> DataFrame:
    """key, titles: the first ``n`` distinct titles, cut before they are collected."""
    first = df.where(F.col(title).isNotNull()).groupBy(key, title).agg(F.min(order).alias("_o"))
    cut = first.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("_o", title))).where(F.col("_r") <= n)
    return cut.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", title))), lambda x: x[title]).alias("titles"))
