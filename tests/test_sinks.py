import json

from pyspark.sql import functions as F

from quern.functions import models
from quern.sources import sinks


def test_versions(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert sinks.versions(spark, path) == []
    for i in range(1, 6):
        assert sinks.write_version(spark.range(i), path, keep=2) == i
    assert sinks.versions(spark, path) == [4, 5] and sinks.latest(spark, path).count() == 5


def test_bulk(spark):
    d = spark.createDataFrame([(i, "x" * 50, None) for i in range(20)] + [(99, "y" * 500, "z")], "id int, text string, extra string").coalesce(1)
    got = sinks.bulk_payloads(d, "id", 300).collect()
    assert sum(r.n for r in got) == 21 and all(len(r.payload) <= 300 or r.n == 1 for r in got)
    assert {json.loads(x)["id"] for r in got for x in r.payload.splitlines()[1::2]} == {*range(20), 99}
    assert sinks.bulk_payloads(d.limit(0), "id").count() == 0


def test_models(spark):
    d = spark.createDataFrame([("a b", "A **b** c"), ("", None), (None, "x")], "query string, passage string")
    got = models.rerank(d).collect()
    assert [r.model_score for r in got] == [1.0, 0.0, 0.0]
    e = d.select(models.embed(F.col("query")).alias("v")).collect()
    assert len(e[0].v) == 64 and abs(sum(x * x for x in e[0].v) - 1) < 1e-6 and not any(e[1].v)


def test_rows_for_stores(spark, tmp_path):
    import pytest

    i = spark.createDataFrame([("s", "c", "Premium due 保险金", [1.0, 2.5]), ("s", "c", "again", [1.0, 2.5]), ("t", "d", "premium", [1.0, 2.0, 3.0]), ("u", "e", None, None)], "source_id string, chunk_id string, content string, embedding array<double>")
    got = {r.source_id: (r.content, r.dimension, r.embedding) for r in sinks.relational_rows(i).collect()}
    assert got["s"] == ("Premium due 保险金", 2, "[1.0,2.5]") and got["u"][2] is None and len(got) == 3
    t = sinks.search_tables(i, "source_id", "content", "embedding")
    assert sorted(t) == ["postings", "vectors_2", "vectors_3"] and {(r.term, r.id, r.tf) for r in t["postings"].collect()} >= {("premium", "s", 1), ("保险", "s", 1), ("险金", "s", 1), ("premium", "t", 1)}
    s = {r.id: r.sparse for r in sinks.sparse_vectors(i, "source_id", "content").collect()}
    assert set(s) == {"s", "t"} and all(x.weight > 0 for x in s["t"]) and [x.place for x in s["s"]] == sorted(x.place for x in s["s"])
    p = sinks.load_payloads(i, ["chunk_id", "content"], 60).collect()
    assert sum(r.n for r in p) == 4 and all(len(r.payload.encode()) <= 60 or r.n == 1 for r in p) and p[0].columns == "chunk_id,content"
    path = sinks.put_object(spark, f"file://{tmp_path}/o.bin", b"\x00\xffab")
    assert sinks.get_object(spark, path) == b"\x00\xffab" and sinks.put_object(spark, path, b"new") and sinks.get_object(spark, path) == b"new"
    with pytest.raises(Exception):
        sinks.get_object(spark, f"file://{tmp_path}/none")
