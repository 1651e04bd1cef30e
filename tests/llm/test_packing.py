from pyspark.sql import functions as F

from quern.llm.packing import HASHED, TOKENIZER, TOKENIZER_DIR, _encoder, hilbert, pack, places, walk
from quern.runtime import table


def test_hilbert_is_a_curve():
    import numpy as np

    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = hilbert(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        walk = cells[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_nothing_is_lost_and_nothing_overflows(spark, sf):
    docs, budgets = table(spark, sf.replace("0.001", "0.01"), "documents"), table(spark, sf, "pack_budgets")
    p = pack(docs, budgets).cache()
    c = p.where("container_id <> ''").groupBy("budget", "capacity", "container_id").agg(F.sum("n_tokens").alias("n"))
    assert c.where("n > capacity").count() == 0
    fill = {r.budget: r.f for r in c.groupBy("budget").agg((F.sum("n") / F.sum("capacity")).alias("f")).collect()}
    assert fill["small"] > 0.96 and fill["medium"] > 0.97
    total = {r.n for r in p.groupBy("budget").agg(F.sum("n_tokens").alias("n")).collect()}
    assert len(total) == 1
    per = p.groupBy("budget", "doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("k"), F.max("capacity").alias("c"))
    assert per.where("k > 1 and n <= c").count() == 0  # only oversized texts are split
    assert p.select("budget", "doc_id").distinct().count() == 3 * docs.count()


def test_edges(spark):
    b = spark.createDataFrame([("s", 4), ("none", None), (None, 3), ("zero", 0)], "budget string, capacity_tokens int")
    d = spark.createDataFrame([(1, "a b c d e f g h i j", 0), (2, None, 0), (3, "", 0), (None, "a", 0), (4, "a", 0), (4, "a", 0)], "doc_id bigint, text string, n_tokens int")
    got = sorted((r.doc_id, r.piece_no, r.from_token, r.n_tokens) for r in pack(d, b).collect())
    assert got == [(1, 1, 0, 4), (1, 2, 4, 4), (1, 3, 8, 2), (2, 1, 0, 0), (3, 1, 0, 0), (4, 1, 0, 1), (4, 1, 0, 1)]
    assert pack(d.limit(0), b).count() == 0
    same = spark.createDataFrame([(i, "one text for all of them") for i in range(500)], "doc_id bigint, text string")
    assert pack(same, b, window=64).agg(F.sum("n_tokens")).first()[0] == 500 * 6


def test_neighbours_on_the_curve_share_containers(sf):
    """Texts of one container are nearly as alike as by taking them one after the other, and far more alike than by chance."""
    import duckdb
    import numpy as np

    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{sf.replace('0.001', '0.1')}/documents.parquet' WHERE text <> '' ORDER BY doc_id LIMIT 3000").fetchall()]
    enc = _encoder(TOKENIZER_DIR, TOKENIZER)
    tokens = [np.array(enc.encode_ordinary(t), np.int32) for t in texts]
    size = np.array([len(t) for t in tokens])
    row, flat = np.repeat(np.arange(len(tokens)), size), np.concatenate(tokens).astype(np.int64)
    v = np.log1p(np.bincount(row * HASHED + (flat * 0x9E3779B1 >> 7) % HASHED, minlength=len(tokens) * HASHED).reshape(-1, HASHED))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    capacity = 2048
    ok = np.flatnonzero(size <= capacity)
    curve, chance = ok[np.argsort(places(tokens)[ok], kind="stable")], np.random.default_rng(1).permutation(ok)

    def next_fit(s):
        out, k, room = [], 0, capacity
        for x in s:
            if x > room:
                k, room = k + 1, capacity
            out.append(k)
            room -= x
        return np.array(out)

    def alike(order, container):
        total = pairs = 0
        for k in np.unique(container):
            m = v[order[container == k]]
            total, pairs = total + (m.sum(0) @ m.sum(0) - len(m)), pairs + len(m) * (len(m) - 1)
        return total / pairs

    mine, n = walk(size[curve], capacity)
    assert size[curve].sum() / n / capacity > 0.98
    assert np.bincount(mine, weights=size[curve]).max() <= capacity
    assert alike(curve, mine) > 0.95 * alike(curve, next_fit(size[curve]))
    assert alike(curve, mine) > 1.2 * alike(chance, walk(size[chance], capacity)[0])


def test_partitions_do_not_matter(spark, sf):
    docs, budgets = table(spark, sf, "documents"), table(spark, sf, "pack_budgets")
    rows = [sorted(map(tuple, pack(d, budgets, weight=20_000).collect()), key=repr) for d in (docs, docs.repartition(7))]
    assert rows[0] == rows[1] and len({r[1] for r in rows[0]}) > 10
