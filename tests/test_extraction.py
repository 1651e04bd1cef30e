"""Readings of answers and texts by literal cases."""

from pyspark.sql import functions as F

from quern.operators import extraction as X


def test_graph_of():
    nodes, rel = X.graph_of('```json\n{"nodes": [{"name": "A", "attributes": ["x"]}, {"name": "A", "attributes": ["y"]}, {"name": ""}], "relations": [{"source": "A", "target": "B", "type": "owns"}, {"source": "A", "target": "A", "type": "owns"}, {"source": "A", "target": "C", "type": "odd"}, {"source": "", "target": "B"}],}\n```', ["owns"])
    assert nodes == [{"name": "A", "attributes": ["x"]}, {"name": "B", "attributes": []}] and rel == [{"source": "A", "target": "B", "type": "owns"}]
    assert X.graph_of("no json") == ([], []) and X.graph_of('[{"name": "Z"}]')[0][0]["name"] == "Z"


def test_options(spark):
    assert X.options("one of: a / b") == ("single", ["a", "b"]) and X.options("多选：甲、乙")[0] == "multi" and X.options("any text") == X.options(None) == ("free", [])
    df = spark.createDataFrame([(" B ",), ("a, b",), ("c",), (None,)], "v string")
    assert [r.x for r in df.select(X.constrained(F.col("v"), "one of: a / b").alias("x")).collect()] == ["b", None, None, None]
    assert [r.x for r in df.select(X.constrained(F.col("v"), "any of: a / b").alias("x")).collect()] == ["b", "a/b", None, None]


def test_induced():
    ex = [("Name: x\nGrace period: 30 days\nend", "30 days"), ("intro\nGrace  period: 60 days\n", "60 days")]
    rx = X.induced(ex)
    import re

    assert rx and all(re.search(rx, t)[1] == v for t, v in ex)
    assert X.induced(ex[:1]) is None and X.induced([("a 1", "1"), ("b 2", "2")]) is None and X.induced([("x: 1", "9"), ("x: 2", "2")]) is None


def test_anchor_and_report(spark):
    rx = X.induced([("Sum: 1 Taler.", "1 Taler"), ("The Sum: 22 Taler.", "22 Taler")])
    df = spark.createDataFrame([("so Sum: 5 Taler. More",), ("none",)], "t string")
    got = [r.x for r in df.select(X.by_anchor(F.col("t"), rx).alias("x")).collect()]
    assert got == ["5 Taler", None]
    rows, text = X.report(spark.range(5).withColumn("b", F.lit("x").cast("binary")), most=3)
    assert rows[0] == {"id": 0, "b": "x"} and text.startswith("3 rows, more left out\n1. id=0, b=x")
