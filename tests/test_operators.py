import math

import pytest
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.functions import vector as V
from quern.operators import chunking as C
from quern.operators import incremental as I
from quern.operators import merging as M
from quern.operators import metrics as X
from quern.operators import retrieval as R
from quern.operators import sqlguard as G
from quern.streaming.engine import TagSplitter


def one(spark, c, **cols):
    d = spark.range(1)
    for k, v in cols.items():
        d = d.withColumn(k, v if not isinstance(v, (str, float, int)) else F.lit(v))
    return d.select(c.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("sql", "why"),
    [
        ("", "empty"), ("SELEC 1", "not one valid"), ("SELECT 1; SELECT 2", "not one valid"), ("DROP TABLE part", "read-only"), ("INSERT INTO part SELECT * FROM part", "read-only"), ("SELECT * FROM secret", "not allowed"), ("SELECT * FROM part WHERE 1=1", "constants"), ("SELECT * FROM part WHERE p_size > 1 OR 'a' = 'a'", "constants"),
        ("SELECT * FROM part WHERE true", "constants"), ("SELECT * FROM (SELECT * FROM secret) t", "not allowed"), ("WITH c AS (SELECT * FROM secret) SELECT * FROM c", "not allowed"), ("SELECT reflect('java.lang.System', 'exit') FROM part", "not allowed"), ("SELECT * FROM part WHERE p_partkey IN (SELECT k FROM secret)", "not allowed"), ("SELECT (SELECT max(k) FROM secret) FROM part", "not allowed"),
        ("SELECT * FROM part WHERE EXISTS (SELECT 1 FROM secret)", "not allowed"), ("SELECT * FROM parquet.`/etc`", "not allowed"), ("SET x = 1", "read-only"), ("CACHE TABLE part", "read-only"),
    ],
)
def test_guard_rejects(spark, sql, why):
    with pytest.raises(G.Rejected, match=why):
        G.validate(spark, sql, ["part"])


@pytest.mark.parametrize("sql", [
    "SELECT * FROM orders WHERE o_custkey > 18 AND o_orderstatus = 'F'", "SELECT * FROM orders WHERE o_orderstatus = 'x or 1=1'", "SELECT * FROM orders WHERE o_custkey = 1", "SELECT o_custkey, count(*) FROM orders GROUP BY o_custkey HAVING count(*) > 2",
    "WITH a AS (SELECT * FROM orders) SELECT max(o_custkey) FROM a WHERE o_orderkey IN (SELECT o_orderkey FROM a)", "SELECT row_number() OVER (ORDER BY o_orderkey) FROM orders", "SELECT upper(trim(o_orderstatus)), date_trunc('month', o_orderdate) FROM orders /* note */",
])
def test_guard_accepts(spark, sql):
    G.validate(spark, sql, ["orders"])


@pytest.mark.parametrize("sql", [
    "SELECT * FROM orders WHERE o_custkey = 1 OR 1=1", "SELECT * FROM orders WHERE o_orderstatus = 'a' OR '1'='1'", "SELECT * FROM orders WHERE 0=0", "SELECT * FROM orders WHERE true", "SELECT * FROM orders WHERE ''=''", "SELECT * FROM orders WHERE 1=0", "SELECT * FROM orders WHERE false",
    "SELECT * FROM orders WHERE o_custkey = 1 AND 1=1", "SELECT * FROM orders WHERE 2>1", "SELECT * FROM orders WHERE o_custkey = o_custkey", "SELECT * FROM orders WHERE 'a' <> 'b'", "SELECT * FROM orders WHERE NOT (1 = 2)", "SELECT * FROM orders a JOIN orders b ON 1 = 1",
    "SELECT o_custkey FROM orders GROUP BY o_custkey HAVING 1 = 1", "SELECT * FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE 3 = 3)", "SELECT reflect('java.lang.System', 'exit', 0)", "SELECT made_up(o_custkey) FROM orders", "SELECT input_file_name() FROM orders", "SELECT * FROM orders WHERE 1 + 1 = 2",
])
def test_guard_rejects_what_no_row_decides(spark, sql):
    with pytest.raises(G.Rejected):
        G.validate(spark, sql, ["orders"])


def test_guard_scopes_do_not_meet(spark):
    t = spark.range(10).selectExpr("id", "id % 2 as tenant")
    spark.range(3).createOrReplaceTempView("t")  # a view of the session under the same name
    a, b = (G.run(spark, "SELECT count(*) AS n, min(tenant) AS m FROM t", {"t": t}, {"t": f"tenant = {k}"}) for k in (0, 1))
    assert [tuple(x.first()) for x in (a, b)] == [(5, 0), (5, 1)]
    c = G.run(spark, "WITH x AS (SELECT * FROM T WHERE id > 5) SELECT count(*) AS n FROM x", {"t": t}, {"t": "tenant = 1"})
    assert c.first().n == 2


def test_guard_scopes(spark):
    part = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "k int, tenant string")
    got = G.run(spark, "WITH t AS (SELECT * FROM part) SELECT k FROM t UNION SELECT k FROM part", {"part": part}, {"part": "tenant = 'a'"})
    assert {r.k for r in got.collect()} == {1, 3}
    st = G.validate(spark, "SELECT upper(tenant) FROM part WHERE k > 1", ["part"])
    assert st.tables == ["part"] and st.functions == ["upper"] and st.has_where


def test_text(spark):
    assert one(spark, T.normalise(F.lit("  A  b\n C "))) == "a b c"
    assert one(spark, T.signature(F.lit("   "))) == ""
    assert one(spark, T.cjk_tokens(F.lit("保险A1 费"))) == ["保险", "a1", "费"]
    assert one(spark, T.char_bigrams(F.lit("a b"))) == ["ab"] and one(spark, T.char_bigrams(F.lit("a"))) == ["a"]
    assert one(spark, T.language(F.lit("这是一个保险条款"))) == "zh" and one(spark, T.language(F.lit("保险 insurance"))) == "mixed"
    assert one(spark, T.redact(F.lit("id 12345678901234567X tel 13812345678 no 1234567890"))) == "id [ID] tel [PHONE] no [POLICY]"
    assert one(spark, T.strip_thoughts(F.lit("<think>x</think>yes<think>open"))) == "yes"
    assert one(spark, T.slug(F.lit(" Ab  c/1! "))) == "ab-c/1"
    assert one(spark, T.like_escape(F.lit(r"5%_\ "))) == r"5\%\_\\ "
    assert one(spark, T.key_points(F.lit("1. one；two\n- two"))) == ["one", "two"]
    assert one(spark, T.ngrams(F.array(F.lit("a"), F.lit("b"), F.lit("c")), 2)) == ["a b", "b c"]
    assert one(spark, T.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>"))) == 0
    assert one(spark, T.repair_json(F.lit('```json\n{"a": [1,],}\n```'))) == '{"a": [1]}'
    assert one(spark, T.relevance_label(F.lit(0.61))) == "Medium"


def test_vector(spark):
    a = F.array(F.lit(3.0), F.lit(4.0))
    assert one(spark, V.norm(a)) == 5 and abs(one(spark, V.cosine(a, a)) - 1) < 1e-12
    assert one(spark, V.cosine(a, F.array(F.lit(1.0)))) == 0 and one(spark, V.valid(F.array(F.lit(float("nan"))))) is False
    assert one(spark, V.literal(F.lit("[1,2.5]"))) == [1.0, 2.5]


def test_metric_goldens(spark):
    """Closed-form cases: truth sets, found ids, mean average precision."""
    for truths, found, want in [([[2, 4, 6]], [2, 4, 6], 1.0), ([[1, 2]], [3, 4], 0.0), ([[1, 2, 3]], [2, 5, 1, 3], 0.805556), ([], [1], 0.0), ([[1, 2], [3, 4]], [1, 3, 2, 4], 0.666667)]:
        d = spark.createDataFrame([(found, truths)], "f array<int>, t array<array<int>>")
        assert abs(d.select(X.average_precision(F.col("f"), F.col("t"))).first()[0] - want) < 1e-5
    d = spark.createDataFrame([([2, 9, 1], [[1, 2]])], "f array<int>, t array<array<int>>")
    p, r = X.precision_recall(F.col("f"), F.col("t"))
    row = d.select(p.alias("p"), r.alias("r"), X.reciprocal_rank(F.col("f"), F.col("t")).alias("m"), X.ndcg(F.col("f"), F.col("t"), 3).alias("n")).first()
    assert abs(row.p - 2 / 3) < 1e-9 and row.r == 1 and row.m == 1 and abs(row.n - (1 + 1 / 2) / (1 + 1 / math.log2(3))) < 1e-9


def test_generation_metrics():
    a = "the cat sat on the mat".split()
    assert abs(X.bleu(a, a, 4) - 1) < 1e-9 and X.bleu([], a, 2) == 0
    assert abs(X.rouge_l(a, a) - 1) < 1e-6 and abs(X.rouge_n(a, "the dog".split(), 1) - 2 * 0.2 * 0.5 / 0.7) < 1e-6


def test_merging(spark):
    assert M.join_overlapping("abcde", "cdefg") == "abcdefg" and M.join_overlapping("ab", "cd") == "abcd" and M.join_overlapping("ab", "bc", 2) == "abbc"
    assert M.fair_shares([5, 100, 100], 65) == [5, 30, 30] and M.fair_shares([10, 10], 7) == [4, 3] and M.fair_shares([], 5) == []
    d = spark.createDataFrame([("k", 2, "world"), ("k", 1, "hello wor"), ("e", 1, None)], "key string, seq int, text string")
    assert {r.key: r.text for r in M.stitch(d, "key", "seq", "text").collect()} == {"k": "hello world", "e": ""}
    d = spark.createDataFrame([("k", i, s) for i, s in enumerate([3, 3, 9, 1, 1])], "key string, seq int, n int")
    assert [r.batch for r in M.batches(d, "key", ["seq"], "n", 6).orderBy("seq").collect()] == [0, 0, 1, 2, 2]


def test_retrieval(spark):
    d = spark.createDataFrame([(1, 1, 0.9, ["a", "b"]), (1, 2, 0.89, ["a", "b"]), (1, 3, 0.5, ["c"]), (2, 4, 0.05, [])], "query_id int, id int, score double, tokens array<string>")
    assert [r.id for r in R.mmr(d, 2).where("query_id = 1").orderBy("rank").collect()] == [1, 3]
    assert sorted(r.id for r in R.threshold_with_fallback(d, threshold=0.6).collect()) == [1, 2]
    assert sorted(r.id for r in R.threshold_with_fallback(d, threshold=0.6, explicit=True).collect()) == [1, 2, 4]
    assert sorted(r.id for r in R.drop_contained(d, "query_id", "id", "score", "tokens").collect()) == [1, 3, 4]
    assert R.budget(10) == 50 and R.budget(50, 9) == 500
    f = R.fuse(d.where("id < 3"), d.where("id > 1 and query_id = 1")).where("query_id = 1")
    assert {r.id: round(r.score, 6) for r in f.collect()} == {1: round(0.7 / 61, 6), 2: round(0.7 / 62 + 0.3 / 61, 6), 3: round(0.3 / 62, 6)}
    with pytest.raises(ValueError):
        R.condition({"op": "near", "field": "id", "value": 1})


def test_incremental(spark):
    import datetime as dt

    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    d = spark.createDataFrame([("k", t(i), i) for i in range(6)], "key string, ts timestamp, id int")
    got = I.sliding_limit(d, "key", "ts", 3, 2).orderBy("id").collect()
    assert [r.admitted for r in got] == [True, True, False, True, True, False]
    assert I.watermark(d, "ts", "id") == (t(5), 5) and I.watermark(d.limit(0), "ts", "id", ("x", 1)) == ("x", 1)
    a, b = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, v string"), spark.createDataFrame([(2, None), (3, "y"), (4, "n")], "k int, v string")
    assert {r.k: r.action for r in I.diff(a, b, ["k"], ["v"]).collect()} == {1: "remove", 2: "same", 3: "change", 4: "add"}
    assert {tuple(r) for r in I.upsert(a, b, ["k"]).collect()} == {(1, "x"), (2, None), (3, "y"), (4, "n")}


def test_tag_splitter():
    s = TagSplitter()
    out = [x for p in ["a<th", "ink>b", "c</thi", "nk>d<", "e"] for x in s.feed(p)] + s.close()
    joined = {k: "".join(t for kind, t in out if kind == k) for k in ("think", "answer")}
    assert joined == {"think": "bc", "answer": "ad<e"}


def test_chunking(spark):
    text = "# A\n\n" + "word " * 200 + "\n\n## B\n\n" + "| a | b |\n|---|---|\n| 1 | 2 |\n" * 3 + "\n## C\n\nshort\n"
    name, got, _ = C.chunk(text, 200, 40)
    assert name == "heading" and got[0][0] == 0 and got[-1][1] == len(text) and all(a < b for a, b, _ in got)
    assert {c for _, _, c in got} >= {"A", "A > C"} or any("A" in c for _, _, c in got)
    cover = set()
    for a, b, _ in C.recursive("x" * 1000 + "\n" + "y" * 10, 100, 20):
        cover.update(range(a, b))
    assert cover == set(range(1011))
    assert C.inject_links("see Foo Bar and `Foo` Foo", {"Foo": "/f", "Foo Bar": "/fb"}) == "see [Foo Bar](/fb) and `Foo` [Foo](/f)"
    d = spark.createDataFrame([(1, None), (2, ""), (3, "a\n\nb")], "doc_id int, text string")
    assert [(r.doc_id, r.content) for r in C.chunks(d).collect()] == [(3, "a\n\nb")]


def test_expand_text(spark):
    texts = {"a": [*(f"{i:03d}" for i in range(300)), "", None, "x" * 5000, "y" * 349, "z" * 900, "", "end"], "b": ["alone"], None: ["n" * 350, "m"]}
    rows = [(k, i, t) for k, ts in texts.items() for i, t in enumerate(ts)]

    def brute(ts, i, least=350, most=850):
        out = ts[i] or ""
        if len(out) >= least:
            return out
        k = 0
        while len(out) < least and (i - k > 0 or i + k < len(ts) - 1):
            k += 1
            before, after = (ts[j] or "" if 0 <= j < len(ts) else "" for j in (i - k, i + k))
            out = before + "\n" * bool(before) + out + "\n" * bool(after) + after
        return out[:most]

    got = M.expand_text(spark.createDataFrame(rows, "g string, i int, t string"), ["g"], ["i"], "t").collect()
    assert {(r.g, r.i): r.expanded for r in got} == {(k, i): brute(ts, i) for k, ts in texts.items() for i in range(len(ts))}


def test_quote_lineage_takes_whole_quotes(spark, tmp_path):
    from quern.plans import registry

    registry.load()
    same = "the waiting period counts from the day on which"
    e = [("a", f"{same} the policy begins"), ("b", f"{same} the form is signed"), (None, "in no chunk at all")]
    rows = [("d", [(c, q)]) for c, q in e]
    spark.createDataFrame(rows, "doc string, evidence array<struct<chunk_id:string,quote:string>>").write.parquet(f"{tmp_path}/golden_records.parquet")
    got = {r.status: r.n for r in registry.QUERIES["quote_lineage"](spark, str(tmp_path)).collect()}
    assert got == {"linked": 2, "page_only": 1}


@pytest.mark.parametrize("name", ["gap_cells", "state_matrix"])
@pytest.mark.parametrize("fields", [16, 10_500])
def test_grid_of_many_rows_and_many_fields(spark, tmp_path, name, fields):
    import duckdb

    from quern.plans import registry

    registry.load()
    g = spark.range(12_000).selectExpr("'p' || id % 7 AS product_id", f"'f' || id % {fields} AS field_id", "element_at(array('unknown', 'present', 'absent_explicitly'), cast(id % 11 % 3 AS int) + 1) AS tri_state")
    g.write.parquet(f"{tmp_path}/golden_records.parquet")
    spark.range(4, 9).selectExpr("'p' || id AS product_id").write.parquet(f"{tmp_path}/insurance_products.parquet")
    con = duckdb.connect()
    for t in ("golden_records", "insurance_products"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = [tuple(r) for r in registry.QUERIES[name](spark, str(tmp_path)).collect()]
    assert len(got) >= 2 * fields and sorted(got) == sorted(con.sql(registry.ORACLE[name]).fetchall())


def test_grid_takes_null_for_no_state(spark):
    from quern.operators import facts as K

    g = spark.createDataFrame([("p", "f", None), ("p", "f", "other"), ("p", "g", None), ("q", "f", "present"), ("q", "f", None), ("q", "f", "other")], "r string, c string, s string")
    got = {tuple(x) for x in K.matrix(g, g, g, "r", "c", "s", ["present"]).collect()}
    assert got == {("p", "f", "other"), ("p", "g", "unknown"), ("q", "f", "present"), ("q", "g", "unknown")}


@pytest.mark.parametrize(("text", "plain"), [
    ("这是一段普通的文本内容", "这是一段普通的文本内容"), ("前文 ![图片说明](https://example.com/img.png) 后文", "前文  后文"), ("请参考 [官方文档](https://docs.example.com) 了解详情", "请参考 官方文档 了解详情"), ("访问 https://example.com/path?q=1&b=2 获取更多信息", "访问  获取更多信息"),
    ("示例代码：\n```python\nprint('hello')\n```\n以上是示例", "示例代码：\n\n以上是示例"), ("公式如下 $$E=mc^2$$ 其中E是能量", "公式如下  其中E是能量"), ("| 名称 | 值 |\n| --- | --- |\n| A | 1 |", "名称, 值\n\nA, 1"), ("## 第二章 概述\n### 2.1 背景", "第二章 概述\n2.1 背景"),
    ("> 这是一段引用\n> 第二行引用", "这是一段引用\n第二行引用"), ("这是 **加粗** 和 *斜体* 以及 ***粗斜体*** 文本", "这是 加粗 和 斜体 以及 粗斜体 文本"), ("- 项目一\n- 项目二\n1. 有序一\n2. 有序二", "项目一\n项目二\n有序一\n有序二"), ("文本<br>换行<div class=\"test\">内容</div>结尾", "文本换行内容结尾"), ("段落一\n\n\n\n\n段落二", "段落一\n\n段落二"),
])
def test_clean_passage(spark, text, plain):
    assert one(spark, T.clean_passage(F.lit(text))) == plain


def test_redact_touching_letters(spark):
    assert one(spark, T.redact(F.lit("电话13812345678号, id_11010119900101123X, no2024000012345, 90 days"))) == "电话[PHONE]号, id_[ID], no[POLICY], 90 days"
