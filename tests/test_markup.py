"""JSON and marks in texts by literal cases."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from quern.functions import jsontext as J
from quern.functions import markup as M


@pytest.mark.parametrize(
    ("broken", "fixed"),
    [
        ('{"a": 1}', '{"a": 1}'), ('```json\n{"a": [1, 2,],}\n```', '{"a": [1, 2]}'), ('{"a": "C:\\dir\\x"}', '{"a": "C:\\\\dir\\\\x"}'), ('{"a": {"b": [1, 2', '{"a": {"b": [1, 2]}}'), ('{"a": "open', '{"a": "open"}'), ('{"a": 1} and more', '{"a": 1}'),
        ('so: {"a": "x\ny"}', '{"a": "x\\ny"}'), ('{"a": "1, ]"}', '{"a": "1, ]"}'), ('{"a":', '{"a": null}'), ("nothing", None), ('{"u": "\\u12"}', '{"u": "\\\\u12"}'), ("[1, 2", "[1, 2]"), ('{"a": [1}', '{"a": [1]}'),
    ],
)
def test_repaired(broken, fixed):
    assert J.repaired(broken) == fixed


def test_set_path():
    assert J.set_path('{"a": 1}', ["a", "b"], 2) == '{"a":{"b":2}}' and J.set_path("[]", ["x"], None) == '{"x":null}' and J.set_path(None, ["x", "y"], "z") == '{"x":{"y":"z"}}'


def test_canonical():
    z = dt.timezone(dt.timedelta(hours=2))
    assert J.canonical({"b": [True, None, 3], "a": {"z", "y"}, "\U0001f600": decimal.Decimal("1.50"), "\uffff": dt.datetime(2024, 1, 1, 2, 0, 0, 500000, z)}) == '{"a":["y","z"],"b":[true,null,3],"\U0001f600":"1.5","\uffff":"2024-01-01T00:00:00.5Z"}'
    for bad in (1.5, "e\u0301", 2**53, dt.datetime(2024, 1, 1), object()):
        with pytest.raises(ValueError):
            J.canonical(bad)


def test_params():
    schema = {"required": ["q", "n"], "properties": {"q": {"type": "string"}, "n": {"type": "integer", "minimum": 1, "maximum": 9}, "deep": {"type": "boolean"}, "ids": {"type": "array", "items": {"type": "integer"}}, "mode": {"type": "string", "enum": ["a", "b"]}, "o": {"type": "object", "properties": {"x": {"type": "number"}}}}}
    got = J.cast_params({"q": 5, "n": "3", "deep": "Yes", "ids": '["1", 2]', "mode": "a", "o": {"x": "1.5"}, "other": [1]}, schema)
    assert got == {"q": "5", "n": 3, "deep": True, "ids": [1, 2], "mode": "a", "o": {"x": 1.5}, "other": [1]} and J.violations(got, schema) == []
    assert J.cast_params({"n": 3.0, "ids": 7, "deep": 0}, schema) == {"n": 3, "ids": [7], "deep": False}
    assert J.violations({"n": 10, "mode": "c", "ids": ["x"], "deep": "maybe", "o": {"x": "y"}}, schema) == ["q: missing", "n: out of range", "mode: not one of the listed values", "ids.0: not of type integer", "deep: not of type boolean", "o.x: not of type number"]


def test_columns(spark):
    one = lambda c, *v: spark.createDataFrame([v], ["a", "b"][: len(v)]).select(c.alias("r")).first().r
    a = F.col("a")
    assert one(M.phrases(a), 'find "two words" and “one” or "x"') == ["two words", "one"]
    assert one(M.segments(a), "first part, second; ab") == ["second"] and one(M.segments(a), "plain") == []
    got = one(M.expansions(a), 'What is the "grace period" for late premiums?')
    assert len(got) <= 5 and got[0] == "grace period late premiums" and "grace period" in got and len({x.lower() for x in got}) == len(got)
    assert one(M.slug_or_null(a), " My Page/Sub ") == "my-page/sub" and one(M.slug_or_null(a), "a//b") is None and one(M.slug_or_null(a), "/a") is None and one(M.slug_or_null(a), "é") is None and one(M.slug_or_null(a), "年金/x") == "年金/x"
    assert one(M.clean_ocr(a), "```\nline\n```") == "line" and one(M.clean_ocr(a), "无。") == "" and one(M.clean_ocr(a), "<table><tr><td>some longer text</td></tr></table>") == "some longer text"
    assert [tuple(r) for r in one(M.image_refs(a), "![a](b(1).png) ![](c.jpg \"t\") [n](x)")] == [("a", "b(1).png"), ("", "c.jpg")]
    assert one(M.table_blocks(a), "x<table><tr><td>1</td><td>2</td></tr></table>y") == "x\n| 1 | 2 |\n| --- | --- |\ny"
    assert one(M.table_blocks(a), '<table width="9"><tr><td rowspan="2" style="c">1</td></tr></table>') == '<table><tr><td rowspan="2">1</td></tr></table>'
    import re

    assert re.search(M.tolerant_pattern("a (b"), "x a  ( b y") and not re.search(M.tolerant_pattern("a (b"), "a b")
    rows = spark.createDataFrame([([(0, 5, "a"), (5, 9, "b"), (9, 12, "c")],)], "i array<struct<start_pos:int,end_pos:int,url:string>>")
    assert [x.url for x in rows.select(M.images_within(F.col("i"), F.lit(5), F.lit(10)).alias("r")).first().r] == ["b", "c"]
