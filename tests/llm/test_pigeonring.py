import random
import time

import numpy as np
import pytest

from quern.llm.pigeonring import MAX_COUNTERS, Keys, _match, counters, hashed_terms, keyed, near_groups, near_pairs, question_terms, term_sets

SCHEMA = "id bigint, standard_question string, similar_questions array<string>, updated_at timestamp_ntz, extra string"


def brute(rows, t=0.75):
    sets = {}
    for i, q, s, at, _ in sorted(rows, key=lambda r: str(r[3] or "")):
        if i is not None:
            sets[i] = question_terms([q, *(s or [])])
    ids = sorted(i for i in sets if sets[i])
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9}


def made(n, seed, vocabulary, length):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            ws = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(4)):
                ws[rng.randrange(len(ws))] = f"w{rng.randrange(vocabulary)}"
            rng.shuffle(ws)
        else:
            ws = [f"w{min(rng.randrange(vocabulary), rng.randrange(vocabulary))}" for _ in range(rng.randrange(3, length))]
        rows.append((i + 1, " ".join(ws), None, None, None))
    return rows


def test_terms():
    assert question_terms(["Ab a_1, AB!", None, "", "那 是什么?"]) == {"ab", "a_1", "那是", "是什", "什么"}
    assert question_terms(["中"]) == set()


@pytest.mark.parametrize(("seed", "vocabulary", "length", "hot"), [(1, 60, 25, 1500), (2, 30, 40, 8), (3, 15, 12, 3), (4, 400, 120, 20)])
def test_no_pair_is_lost(spark, seed, vocabulary, length, hot):
    rows = made(250, seed, vocabulary, length)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in near_pairs(df, hot=hot).collect()}
    assert got == brute(rows)


def test_edges_and_groups(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [
        (1, "a b c d", None, t, "x"), (2, "d c b A", [], t, "x"), (2, "d c b A", [], t, "x"), (3, "a b c e", ["d"], t, None), (4, None, None, None, None), (5, "", ["", None], t, None), (None, "a b c d", None, t, None),
        (6, "p q r s", None, t, None), (6, "v w x y", None, t + dt.timedelta(1), None), (7, "p q r s", None, t, None), (8, "long " * 5000 + "z", None, t, None), (9, "long z", None, t, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in near_pairs(df).collect()}
    assert got == {(1, 2), (1, 3), (2, 3), (8, 9)} == brute(rows)
    g = {r.id: (r.group_id, r.n_links) for r in near_groups(df).collect()}
    assert g == {1: (1, 1), 2: (1, 1), 3: (1, 1), 4: (4, 0), 5: (5, 0), 6: (6, 0), 7: (7, 0), 8: (8, 0), 9: (8, 0)}
    assert near_pairs(df.limit(0)).count() == 0 and near_groups(df.limit(0)).count() == 0


def test_a_third_are_copies(spark):
    rows = [(i, "one and the same question about the same thing" if i % 3 == 0 else f"question {i} {i * 7} {i * 13} of its own", None, None, None) for i in range(1, 301)]
    g = near_groups(spark.createDataFrame(rows, SCHEMA), hot=10).collect()
    assert {r.group_id for r in g if r.id % 3 == 0} == {3} and all(r.n_links == 0 for r in g)


def test_fold_never_exceeds_the_distance():
    from quern.llm.pigeonring import _fold

    rng = np.random.default_rng(0)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, 60, dtype=np.uint64))
        b = np.unique(np.concatenate([a[:40], rng.integers(0, 2**63, 15, dtype=np.uint64)]))
        d = len(np.setxor1d(a, b))
        assert np.bitwise_count((_fold(a) ^ _fold(b)).view(np.uint64)).sum() <= d


def test_counters_follow_the_data():
    assert counters(1000) == (1 << 16, 1500)
    n, hot = counters(10**9)
    assert hot == 1500 and 10**9 / n <= 1500 / 8
    n, hot = counters(10**12)
    assert n == MAX_COUNTERS and 10**12 / n <= hot / 8


def test_keys_grow_with_the_records(spark):
    """With counters far too few for one size fits all, twice the records still give about twice the rows."""

    def rows(n):
        rng = random.Random(5)
        return spark.createDataFrame([(i, " ".join(f"w{int(4000 * rng.random() ** 2)}" for _ in range(20)), None, None, None) for i in range(n)], SCHEMA)

    sets = [term_sets(rows(n), "id", ["standard_question"], None).cache() for n in (3000, 6000)]
    few, many = (keyed(x, hot=60).count() for x in sets)
    assert many < 2.6 * few


def test_many_members_are_paired_in_parts(spark, monkeypatch):
    monkeypatch.setattr("quern.llm.pigeonring.MEMBERS", 7)
    rows = [(i, "a b c d e f g h" if i % 2 else "a b c d e f g h i", None, None, None) for i in range(60)]
    assert near_pairs(spark.createDataFrame(rows, SCHEMA)).distinct().count() == 60 * 59 // 2


ODD = ["Straße ΑΣ ΑΣΣ. Σ", "İstanbul ıI ǅ", "中文ab 12中", "中", "a\nb_c", "½ ² ١٢ Ⅷ", "", None, "𠀀𠀁 x", "é é", "_ __ a__", "ﬁ ﬂ", "x" * 3000, "中 文，a", "ab", "AB 中", "a b\n", "!?"]


def test_hashed_terms_are_the_question_terms():
    rng = random.Random(3)
    rows = [[rng.choice(ODD) for _ in range(rng.randrange(5))] for _ in range(300)] + [[]]
    rows += [["".join(chr(rng.choice([32, 97, 0x4E2D, rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x30000)])) for _ in range(30))] for _ in range(300)]

    def hashed(rows):
        flat, n = hashed_terms([q for r in rows for q in r], np.repeat(np.arange(len(rows)), [len(r) for r in rows]), len(rows))
        return np.split(flat, np.cumsum(n)[:-1])

    want = [question_terms(r) for r in rows]
    words = sorted(set().union(*want))
    # a term alone is its own term, but for one Chinese character
    alone = {w: int(h[0]) for w, h in zip(words, hashed([[w] for w in words])) if question_terms([w]) == {w}}
    assert len(set(alone.values())) == len(alone) > 2000
    n_whole = 0
    for terms, got in zip(want, hashed(rows)):
        assert len(terms) == len(got) and (got[1:] > got[:-1]).all()
        if terms <= alone.keys():
            n_whole += 1
            assert {alone[t] for t in terms} == set(got.tolist())
    assert n_whole > 500


def some_sets(n, seed=2):
    rng = np.random.default_rng(seed)
    words = rng.integers(0, 2**64, 150, dtype=np.uint64)
    return [np.unique(words[(150 * rng.random(int(rng.integers(1, 60))) ** 2).astype(int)]) for _ in range(n)]


def some_levels(sets, n, size=1 << 12):
    first = np.bincount((np.concatenate(sets) & np.uint64(size - 1)).astype(int), minlength=size).astype(np.uint32)
    return [first, *(np.random.default_rng(k).integers(0, 6, size).astype(np.uint32) for k in range(n - 1))]


def test_keys_of_many_sets_are_those_of_each():
    sets = some_sets(60)
    flat, lens = np.concatenate(sets), np.array([len(x) for x in sets])
    for level in (None, 2, 3):
        make = Keys(0.75, 2, some_levels(sets, level or 4))
        keys, row, small, cnt = make(flat, lens, level)
        wide = Keys(0.75, 2, make.levels)
        wide.most = 1 << 62  # counts too wide to be sorted along with the rest
        assert all(np.array_equal(a, b) for a, b in zip(wide(flat, lens, level), (keys, row, small, cnt)))
        got = sorted(zip(row.tolist(), keys.tolist(), small.tolist(), cnt.tolist()))
        want = []
        for i, x in enumerate(sets):
            k, _, s, c = make(x, np.array([len(x)]), level)
            want += zip([i] * len(k), k.tolist(), s.tolist(), c.tolist())
        assert got == sorted(want) and got


def test_groups_of_any_size_keep_all_pairs_within_the_budget():
    rng = np.random.default_rng(4)
    for n in (2, 20, 33, 400):
        bits = rng.integers(0, 2**64, (n, 4), dtype=np.uint64)
        for i in range(n // 2):
            bits[n // 2 + i] = bits[i] ^ (np.uint64(1) << rng.integers(0, 63, 4, dtype=np.uint64)) * (rng.random(4) < 0.7)
        size, sid = rng.integers(4, 40, n), np.arange(n) + 7
        meta = (2 * size + (rng.random(n) < 0.3)).astype(np.int32)
        got = {tuple(x) for x in _match(np.zeros(n, np.int64), sid, meta, bits.view(np.uint32), 0.75).tolist()}
        want = set()
        for i in range(n):
            for j in range(i + 1, n):
                a, b = (i, j) if meta[i] <= meta[j] else (j, i)
                if not meta[a] & 1 and size[b] <= size[a] / 0.75 + 1e-9 and np.bitwise_count(bits[i] ^ bits[j]).sum() <= (size[i] + size[j]) // 7:
                    want.add((int(sid[i]), int(sid[j])))
        assert len(want) > n // 20
        assert got == want


def test_keys_cost_less_than_the_terms():
    """Keys are made of many sets at once: set by set they cost several times as much as finding the words."""
    rng = random.Random(6)
    texts = [[" ".join(f"w{int(4000 * rng.random() ** 2)}" for _ in range(100))] for _ in range(3000)]
    flat, lens = hashed_terms([q for x in texts for q in x], np.arange(len(texts)), len(texts))
    make = Keys(0.75, 60, some_levels([flat], 3))

    def cost(f):
        best = 1e9
        for _ in range(3):
            at = time.process_time()
            f()
            best = min(best, time.process_time() - at)
        return best

    assert cost(lambda: make(flat, lens)) < cost(lambda: [question_terms(x) for x in texts])


def test_only_chinese_is_cut_into_pairs():
    assert question_terms(["한국어 질문", "ꀀꀁꀂ"]) == {"한국어", "질문", "ꀀꀁꀂ"}
    assert question_terms(["\uf900\uf901 x"]) == {"\uf900\uf901", "\uf901x"}
    assert hashed_terms(["한국어 질문"], np.array([0]), 1)[1].tolist() == [2]


def test_shuffle_files_of_candidates_go_away(spark):
    from quern.llm.pigeonring import near_sets

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    sets = term_sets(spark.createDataFrame(made(100, 1, 60, 25), SCHEMA), "id", ["standard_question"], None)
    before = spark.conf.get(key, None)
    spark.sparkContext._jvm.System.gc()
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def blocks():
        return {int(x.split("_")[1]) for x in held.getAllBlocks().mkString(" ").split() if x.startswith("shuffle_")}

    old = blocks()
    near = near_sets(sets)  # kept, so that nothing is collected
    for _ in range(50):
        if not (left := blocks() - old):
            break
        time.sleep(0.2)
    assert near.count() > 0 and len(left) <= 3  # those of the counts alone
    assert spark.conf.get(key, None) == before
