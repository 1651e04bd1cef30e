"""Hierarchies of wiki releases."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators.hierarchy import descendants, hierarchy, paths
from quern.plans.registry import query
from quern.runtime import settle, table

_NODES = r"""
n AS (SELECT regexp_replace(lower(release_id), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS k, min(release_id) AS id, min(nullif(regexp_replace(lower(base_release_id), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '')) AS up FROM wiki_releases WHERE release_id IS NOT NULL GROUP BY 1),
e AS (SELECT n.k, n.id, p.k AS up FROM n LEFT JOIN n p ON p.k = n.up),
t AS (SELECT k, id AS root, 0 AS depth, [id] AS path FROM e WHERE up IS NULL UNION ALL SELECT e.k, t.root, t.depth + 1, list_append(t.path, e.id) FROM e JOIN t ON e.up = t.k)
"""


def _tree(spark, d):
    return hierarchy(table(spark, d, "wiki_releases"), "release_id", "base_release_id")


@query(
    "p3_found",
    f"""WITH RECURSIVE {_NODES},
lost AS (SELECT e.k, e.id, e.up FROM e WHERE e.k NOT IN (SELECT k FROM t)),
r AS (SELECT k AS a, up AS b FROM lost UNION SELECT r.a, lost.up FROM r JOIN lost ON r.b = lost.k)
SELECT e.id AS release_id, t.root AS root_release_id, t.depth::INT AS depth, 'rooted' AS state FROM t JOIN e ON e.k = t.k
UNION ALL SELECT id, '', -1, CASE WHEN EXISTS (SELECT 1 FROM r WHERE r.a = lost.k AND r.b = lost.k) THEN 'on_cycle' ELSE 'into_cycle' END FROM lost""",
)
def p3_found(spark, d):
    return _tree(spark, d).select(F.col("id").alias("release_id"), F.col("root_id").alias("root_release_id"), "depth", "state")


@query(
    "p3_paths",
    f"""WITH RECURSIVE {_NODES}
SELECT e.id AS release_id, array_to_string(t.path, '/') AS path, (SELECT count(*) FROM t d WHERE d.depth > t.depth AND d.path[t.depth + 1] = e.id) AS n_descendants FROM t JOIN e ON e.k = t.k""",
)
def p3_paths(spark, d):
    tree = settle(_tree(spark, d), "tree")
    p = paths(tree).select("id", F.array_join("path", "/").alias("path"))
    return p.join(tree.where("state = 'rooted'").select("id", "n_descendants"), "id").withColumnRenamed("id", "release_id")


@query(
    "p3_descendants",
    f"""WITH RECURSIVE {_NODES}
SELECT a AS ancestor_id, id AS release_id, (depth - i + 1)::INT AS distance FROM (SELECT e.id, t.depth, unnest(t.path[:-2]) AS a, generate_subscripts(t.path[:-2], 1) AS i FROM t JOIN e ON e.k = t.k)""",
)
def p3_descendants(spark, d):
    return descendants(settle(_tree(spark, d), "tree")).withColumnRenamed("id", "release_id")
