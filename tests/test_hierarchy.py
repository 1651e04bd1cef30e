import random

import pytest

from quern.operators.components import components
from quern.operators.hierarchy import descendants, hierarchy, paths


def tree(spark, rows):
    return hierarchy(spark.createDataFrame(rows, "id string, up string, depth int"), "id", "up")


def brute(rows):
    up = {}
    for i, p, *_ in rows:
        if i is not None and i.strip():
            k = i.strip().lower()
            p = (p or "").strip().lower() or None
            up[k] = min(x for x in (up.get(k), p) if x is not None) if p or up.get(k) else None
    out = {}
    for k in up:
        seen, cur = [k], up[k]
        while cur in up and cur not in seen:
            seen.append(cur)
            cur = up[cur]
        out[k] = (seen[-1], len(seen) - 1, "rooted") if cur not in up else ("", -1, "on_cycle" if cur == k else "into_cycle")
    return out


def test_shapes(spark):
    rows = [("a", None, 1), ("b", " A ", 1), ("b", "a", 1), ("c", "B", None), ("d", "gone", 1), ("e", "", 1), ("x", "y", 1), ("y", "x", 1), ("z", "x", 1), ("w", "z", 1), ("s", "s", 1), (None, "a", 1), (" ", "a", 1)]
    got = {r.id: (r.root_id, r.depth, r.state) for r in tree(spark, rows).collect()}
    assert got == brute(rows)
    assert got["c"] == ("a", 2, "rooted") and got["s"][2] == "on_cycle" and got["w"][2] == "into_cycle" and got["d"] == ("d", 0, "rooted")


def test_paths_and_descendants(spark):
    rows = [("r", None, 0), *((f"n{i}", "r" if i % 7 == 0 else f"n{i - 1}", 0) for i in range(1, 60))]
    t = tree(spark, rows).cache()
    up = {i: p for i, p, _ in rows}
    for block in (1, 4, 8192):
        p = {r.id: r.path for r in paths(t, block).collect()}
        assert len(p) == 60
        for k, v in p.items():
            assert v[-1] == k and all(up[b] == a for a, b in zip(v, v[1:])) and up[v[0]] in (None, "n0")
    pairs = {(r.ancestor_id, r.id): r.distance for r in descendants(t, 8).collect()}
    assert len(pairs) == sum(len(v) - 1 for v in p.values())
    n = {r.id: r.n_descendants for r in t.collect()}
    assert all(n[a] == sum(1 for x, _ in pairs if x == a) for a in n)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("finish", [1 << 20, 20])
def test_random(spark, seed, finish):
    """Also with so small a limit of the last task that peeling and contraction need many rounds."""
    rng = random.Random(seed)
    rows = [(f"k{i}", None if rng.random() < 0.1 else f"k{rng.randrange(200)}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "id string, up string, depth int")
    small, large = hierarchy(df, "id", "up", finish).collect(), hierarchy(df, "id", "up").collect()
    assert {r.id: (r.root_id, r.depth, r.state) for r in small} == brute(rows)
    assert sorted(small, key=repr) == sorted(large, key=repr)


def test_long_chain_and_wide_star(spark):
    n = 100_000
    chain = spark.range(n).selectExpr("'c' || id as id", "case when id > 0 then 'c' || (id - 1) end as up")
    star = spark.range(10 * n).selectExpr("'s' || id as id", "case when id > 0 then 's0' end as up")
    ring = spark.range(1000).selectExpr("'r' || id as id", "'r' || ((id + 1) % 1000) as up")
    got = hierarchy(chain.unionAll(star).unionAll(ring), "id", "up").groupBy("state", "root_id").agg({"*": "count", "depth": "max", "n_descendants": "max", "exit_at": "max"}).collect()
    assert {(r.state, r.root_id, r["count(1)"], r["max(depth)"], r["max(n_descendants)"], r["max(exit_at)"]) for r in got} == {
        ("rooted", "c0", n, n - 1, n - 1, 2 * n - 1), ("rooted", "s0", 10 * n, 1, 10 * n - 1, 20 * n - 1), ("on_cycle", "", 1000, -1, None, None),
    }


def test_one_parent_of_many_and_empty(spark):
    rows = [("top", None, 0), *((f"c{i}", "top", 0) for i in range(500))]
    got = tree(spark, rows).collect()
    assert next(r for r in got if r.id == "top").n_descendants == 500 and sorted(r.enter_at for r in got)[1] == 1
    assert tree(spark, []).count() == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(5, 5), (None, 1), (7, None)]
    par = {}

    def f(x):
        while par.setdefault(x, x) != x:
            x = par[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = f(a), f(b)
            par[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {x: f(x) for x in list(par)}
    assert components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0
