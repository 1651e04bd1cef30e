"""Parent-child rows to full hierarchies: paths, depth, roots, descendants and cycles.

The forest is never walked level by level. Three phases do the work:

1. *Peeling.* Nodes without children are leaves; round k peels 2^k layers of
   them at once, as only nodes that are someone's 2^k-th ancestor stay. What
   can't be peeled lies on cycles. Cycles are then cut open: each of their nodes
   is the root of what hangs on it.
2. *Euler tour and list ranking.* Each node has an enter and an exit event;
   linking them gives one list a tree. Lists are contracted: in every round the
   events with the least random number among their neighbours leave, about a
   third. When few are left they are ranked, and the others come back in
   reverse order with a rank that their predecessor tells. The two ranks of a
   node are its interval.
3. *Intervals.* A node's depth, root and number of descendants follow from its
   interval. Paths are read off in blocks of tour positions, each block starting
   with the intervals that are open where it begins.

Both first phases shrink what they work on, and finish in one task once at most
``FINISH`` rows are left. Children are ordered inside hashed buckets, so that a
parent of very many children doesn't become one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.runtime import discard, settle

#: Buckets of the children of one parent.
BUCKETS = 1024
BLOCK = 8192
#: Rows that one task may peel or rank at last: three or four columns of 8 bytes.
FINISH = 1 << 20


def link_key(c: Column) -> Column:
    """A key without letter case and surrounding blanks; blank keys become null."""
    k = F.lower(F.regexp_replace(c.cast("string"), r"(?U)^[\s\x{feff}]+|[\s\x{feff}]+$", ""))
    return F.when(k != "", k)


def _nodes(df: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """nid, key, id, pid: one row a key, with the number of its parent, null for roots."""
    one = (
        df.select(link_key(F.col(id_col)).alias("key"), F.col(id_col).cast("string").alias("id"), link_key(F.col(parent_col)).alias("up"))
        .where("key is not null")
        .groupBy("key")
        .agg(F.min("id").alias("id"), F.min("up").alias("up"))
    )
    n = settle(one.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    up = n.select(F.col("key").alias("up"), F.col("nid").alias("pid"))
    out = settle(n.join(up, "up", "left").select("nid", "id", "pid"), "links")
    discard(n)
    return out


def _column(batches: list[pa.RecordBatch], k: int) -> np.ndarray:
    return np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in batches])


def _one_task(df: DataFrame) -> DataFrame:
    """``df`` in one partition; only for frames that were counted."""
    return df.repartition(1)


def _peel_all(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """v of the nodes on cycles, from all (v, f) rows: leaf after leaf goes, with its layer."""
    batches = [b for b in it if b.num_rows]
    if not batches:
        return
    v, f = _column(batches, 0), _column(batches, 1)
    order = np.argsort(v)
    v, f = v[order], f[order]
    at = np.searchsorted(v, f)
    live = (at < len(v)) & (v[np.minimum(at, len(v) - 1)] == f)  # a pointer may lead to a root, which has no row
    up = np.where(live, at, -1)
    kids = np.bincount(up[live], minlength=len(v))
    gone = np.zeros(len(v), bool)
    leaves = np.flatnonzero(kids == 0)
    while len(leaves):
        gone[leaves] = True
        above = up[leaves]
        above = above[above >= 0]
        np.subtract.at(kids, above, 1)
        above = np.unique(above)
        leaves = above[(kids[above] == 0) & ~gone[above]]
    yield pa.RecordBatch.from_arrays([pa.array(v[~gone])], ["v"])


def _peel(nodes: DataFrame, finish: int = FINISH) -> DataFrame:
    """v of the nodes that lie on cycles: those that peeling leaves, 2^k layers in round k, never reaches."""
    cur = settle(nodes.where("pid is not null").select(F.col("nid").alias("v"), F.col("pid").alias("f")), "peel")
    n = cur.count()
    while n > finish:
        # nodes with a live descendant 2^k steps below stay; their pointers go on twice as far
        stay = cur.select(F.col("f").alias("v")).distinct()
        left = cur.join(stay, "v", "left_semi")
        on = cur.select(F.col("v").alias("f"), F.col("f").alias("g"))
        nxt = settle(left.join(on, "f").select("v", F.col("g").alias("f")), "peel")
        m = nxt.count()
        discard(cur)
        cur, before, n = nxt, n, m
        if m == before:
            # nothing was peeled: all that is left lies on cycles
            return cur.select("v")
    return _one_task(cur).mapInArrow(_peel_all, "v bigint")


def _tour(nodes: DataFrame) -> DataFrame:
    """e, prv, nxt, w, root: the neighbours of each event, and what the step to it adds to the depth; node v enters as 2v and leaves as 2v + 1.

    root stands only at the head of each list: the root's id, behind 1 if it lies on a cycle, else 0.
    """
    kids = nodes.where("pid is not null").select("nid", "pid", F.pmod(F.hash("nid"), F.lit(BUCKETS)).alias("b"))
    w = Window.partitionBy("pid", "b").orderBy("nid")
    inner = kids.select("nid", F.lag("nid").over(w).alias("bef"), F.lead("nid").over(w).alias("aft"), "pid", "b")
    ends = kids.groupBy("pid", "b").agg(F.min("nid").alias("first"), F.max("nid").alias("last"))
    wb = Window.partitionBy("pid").orderBy("b")
    ends = ends.select("first", "last", F.lag("last").over(wb).alias("bef2"), F.lead("first").over(wb).alias("aft2"), "pid")
    # siblings inside a bucket, and across the ends of buckets
    sib = (
        inner.join(ends.select(F.col("first").alias("nid"), "bef2"), "nid", "left").join(ends.select(F.col("last").alias("nid"), "aft2"), "nid", "left")
        .select("nid", F.coalesce("bef", "bef2").alias("bef"), F.coalesce("aft", "aft2").alias("aft"))
    )
    kin = kids.groupBy("pid").agg(F.min(F.struct("b", "nid")).alias("lo"), F.max(F.struct("b", "nid")).alias("hi")).select(F.col("pid").alias("nid"), F.col("lo.nid").alias("first"), F.col("hi.nid").alias("last"))
    j = nodes.select("nid", "pid", F.when(F.col("pid").isNull(), F.concat(F.col("cyc").cast("int").cast("string"), "id")).alias("root")).join(kin, "nid", "left").join(sib, "nid", "left")
    event = lambda e, p, n, w, r: F.struct(e.alias("e"), p.alias("prv"), n.alias("nxt"), w.alias("w"), r.alias("root"))
    enter, leave = F.col("nid") * 2, F.col("nid") * 2 + 1
    # coming from the parent goes one down, from the sibling's exit one up and one down again
    goes_in = event(enter, F.coalesce(F.col("bef") * 2 + 1, F.col("pid") * 2), F.coalesce(F.col("first") * 2, leave), F.when(F.col("bef").isNull(), 1).otherwise(0), F.col("root"))
    goes_out = event(leave, F.coalesce(F.col("last") * 2 + 1, enter), F.coalesce(F.col("aft") * 2, F.col("pid") * 2 + 1), F.when(F.col("last").isNull(), 0).otherwise(-1), F.lit(None).cast("string"))
    return j.select(F.explode(F.array(goes_in, goes_out)).alias("x")).select("x.*")


_RANKED = "e bigint, root string, hops bigint, total bigint"


def _rank_all(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """e, root, hops, total of all (e, prv, hops, total, root) rows by pointer jumping; prv is null at the head, which names the root."""
    batches = [b for b in it if b.num_rows]
    if not batches:
        return
    e = _column(batches, 0)
    prv = np.concatenate([b.column(1).fill_null(-1).to_numpy() for b in batches])
    hops, total = _column(batches, 2).copy(), _column(batches, 3).copy()
    order = np.argsort(e)
    e, prv, hops, total = e[order], prv[order], hops[order], total[order]
    roots = pa.chunked_array([b.column(4) for b in batches]).take(pa.array(order)).combine_chunks()
    at = np.where(prv < 0, np.arange(len(e)), np.searchsorted(e, prv))
    while True:
        far = at[at]
        if (far == at).all():
            break
        # the head itself counts 0
        hops, total, at = hops + hops[at], total + total[at], far
    yield pa.RecordBatch.from_arrays([pa.array(e), roots.take(pa.array(at)), pa.array(hops), pa.array(total)], ["e", "root", "hops", "total"])


def _rank(tour: DataFrame, finish: int = FINISH) -> DataFrame:
    """e, root, hops, total: how many steps lie between each event and the head of its list, the sum of their weights, and what the head says of its root.

    ``tour`` has e, prv and nxt (null at the ends), the weight w of the step from prv, and root, null but for heads.
    """
    cur = settle(tour.select("e", "prv", "nxt", F.when(F.col("prv").isNull(), 0).otherwise(1).cast("long").alias("hops"), F.when(F.col("prv").isNull(), 0).otherwise(F.col("w")).cast("long").alias("total"), "root"), "rank")
    gone: list[DataFrame] = []
    while cur.where("prv is not null").count() > finish:
        draw = lambda c: F.xxhash64(F.col(c), F.lit(len(gone)))  # noqa: B023,E731
        leaves = F.col("prv").isNotNull() & (draw("e") < draw("prv")) & (F.col("nxt").isNull() | (draw("e") < draw("nxt")))
        out = settle(cur.where(leaves), "gone")
        stay = cur.where(~leaves)
        before = out.select(F.col("e").alias("prv"), F.col("prv").alias("prv2"), F.col("hops").alias("hops2"), F.col("total").alias("total2"))
        after = out.select(F.col("e").alias("nxt"), F.col("nxt").alias("nxt2"), F.lit(True).alias("left"))
        j = stay.join(before, "prv", "left").join(after, "nxt", "left")
        nxt = settle(
            j.select("e", F.coalesce("prv2", "prv").alias("prv"), F.when(F.col("left"), F.col("nxt2")).otherwise(F.col("nxt")).alias("nxt"), (F.col("hops") + F.coalesce("hops2", F.lit(0))).alias("hops"), (F.col("total") + F.coalesce("total2", F.lit(0))).alias("total"), "root"), "rank"
        )
        discard(cur)
        cur = nxt
        gone.append(out)
    # lists that are contracted to their head are done, however many there are
    alone = F.col("prv").isNull() & F.col("nxt").isNull()
    ranked = _one_task(cur.where(~alone).select("e", "prv", "hops", "total", "root")).mapInArrow(_rank_all, _RANKED).unionByName(cur.where(alone).select("e", "root", "hops", "total"))
    for out in reversed(gone):
        ranked = settle(ranked, "ranked")
        p = ranked.select(F.col("e").alias("prv"), "root", F.col("hops").alias("h"), F.col("total").alias("t"))
        ranked = ranked.unionByName(out.drop("root").join(p, "prv").select("e", "root", (F.col("hops") + F.col("h")).alias("hops"), (F.col("total") + F.col("t")).alias("total")))
    return ranked


def hierarchy(df: DataFrame, id_col: str, parent_col: str, finish: int = FINISH) -> DataFrame:
    """One row for each node with its place in the hierarchy.

    Columns: id string, root_id string, depth int, state string (``rooted``,
    ``on_cycle``, ``into_cycle``), enter_at and exit_at bigint (positions on the
    tour of the tree), n_descendants bigint.

    Keys match without regard to letter case and surrounding blanks. A null,
    blank or unknown parent makes a root. Rows without an id are no nodes and
    give no row; repeated rows count once (of different parents the least one
    holds). On and below cycles root_id is '', depth -1, the rest null. An empty
    table gives no row; other columns are not read.
    """
    nodes = _nodes(df, id_col, parent_col)
    cyc = settle(_peel(nodes, finish), "cycles")
    # a node on a cycle is the root of what hangs on it
    forest = settle(nodes.join(cyc.select(F.col("v").alias("nid"), F.lit(True).alias("cyc")), "nid", "left").select("nid", "id", F.when(F.col("cyc").isNull(), F.col("pid")).alias("pid"), F.coalesce("cyc", F.lit(False)).alias("cyc")), "forest")
    ranked = _rank(_tour(forest), finish)
    is_in = F.col("e") % 2 == 0
    per = ranked.groupBy(F.floor(F.col("e") / 2).alias("nid")).agg(
        F.max("root").alias("root"), F.max(F.when(is_in, F.col("hops"))).alias("enter_at"), F.max(F.when(~is_in, F.col("hops"))).alias("exit_at"), F.max(F.when(is_in, F.col("total"))).alias("depth")
    )
    out = per.join(forest.select("nid", "id", "cyc"), "nid").withColumns({"loose": F.col("root").startswith("1"), "root_id": F.expr("substring(root, 2)")})
    kept = lambda c, other: F.when(F.col("loose"), F.lit(other)).otherwise(F.col(c))
    return out.select(
        "id", kept("root_id", "").alias("root_id"), kept("depth", -1).cast("int").alias("depth"),
        F.when(F.col("cyc"), "on_cycle").when(F.col("loose"), "into_cycle").otherwise("rooted").alias("state"),
        kept("enter_at", None).cast("long").alias("enter_at"), kept("exit_at", None).cast("long").alias("exit_at"),
        F.when(~F.col("loose"), (F.col("exit_at") - F.col("enter_at") - 1) / 2).cast("long").alias("n_descendants"),
    )


def _walk(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Preorder rows of blocks, sorted: the path of a row is the stack cut to its depth."""
    at, stack = None, []
    for pdf in it:
        ids, paths = [], []
        for node, root, block, depth, carried in zip(pdf["id"], pdf["root_id"], pdf["block"], pdf["depth"], pdf["carried"]):
            if at != (root, block):
                at, stack = (root, block), []
            del stack[depth:]
            stack.append(node)
            if not carried:
                ids.append(node)
                paths.append(list(stack))
        yield pd.DataFrame({"id": ids, "path": paths})


def paths(tree: DataFrame, block: int = BLOCK) -> DataFrame:
    """id, path array<string> from the root to the node, of the rooted rows of ``hierarchy``.

    The tour of a tree is cut into blocks of ``block`` positions; a block starts
    from the intervals open at its first position, so no task needs a whole tree.
    """
    t = tree.where("state = 'rooted'").select("id", "root_id", "depth", "enter_at", "exit_at")
    own = t.select("id", "root_id", "depth", "enter_at", F.floor(F.col("enter_at") / block).alias("block"), F.lit(False).alias("carried"))
    first, last = F.floor(F.col("enter_at") / block) + 1, F.floor(F.col("exit_at") / block)
    carried = t.where(first <= last).select("id", "root_id", "depth", "enter_at", F.explode(F.sequence(first, last)).alias("block"), F.lit(True).alias("carried"))
    rows = own.unionByName(carried).repartition("root_id", "block").sortWithinPartitions("root_id", "block", "enter_at")
    return rows.mapInPandas(_walk, "id string, path array<string>")


def descendants(tree: DataFrame, block: int = BLOCK) -> DataFrame:
    """ancestor_id, id, distance int: one row for each node and each of its ancestors."""
    p = paths(tree, block)
    e = p.select("id", F.size("path").alias("n"), F.posexplode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("at", "ancestor_id"))
    return e.select("ancestor_id", "id", (F.col("n") - 1 - F.col("at")).cast("int").alias("distance"))


def rounds(n: int) -> int:
    """Upper bound of list-ranking rounds for ``n`` nodes."""
    return max(1, math.ceil(math.log2(max(2, 2 * n))))
