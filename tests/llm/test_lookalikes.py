from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import Row

from quern.llm import lookalikes
from quern.llm.lookalikes import _normalise, alike_pairs, confusable, one_form

SCHEMA = "record_id bigint, product_id string, doc string, field_id string, product_name string, value string, evidence array<struct<page:int,quote:string,knowledge_id:string,chunk_id:string,lineage_status:string>>, x string"


def forms(*texts):
    return _normalise(pa.array(texts, pa.string())).to_pylist()


def test_alike():
    for a, b in [("Ａｂ－１２", "Ab-12"), ("Кеstrа", "Kestra"), ("étе́", "été"), ("oﬃce", "office"), ("a b c", "a b c"), ("so­ft​", "soft"), ("⾦⽉", "金月"), ("｡，", "。,"), ("ｶﾞ", "ガ"), ("Ⅳ", "IV"), ("Å", "Å")]:
        x, y = forms(a, b)
        assert x == y, (a, b, x, y)


def test_visible_differences_stay():
    for a, b in [("m²", "m2"), ("½", "1/2"), ("é", "e"), ("A", "a"), ("7", "1"), ("Nº", "No"), ("ß", "ss"), ("①", "1")]:
        x, y = forms(a, b)
        assert x != y, (a, b, x, y)
    assert forms(None, "", "​", "plain") == [None, "", "", "plain"]


def test_confusable_letters_of_the_unicode_data(spark):
    known = tuple(sorted(confusable(spark).items()))
    assert len(known) > 1000
    pairs = ["ѵv", "αa", "ıi", "ɑa", "ᎳW", "ᖯb", "ⲞO", "ⲟo", "𝐀A", "ℎh", "ＡA", "ΡР", "кκ", "ӧö", "Ӑ\u0102", "㈠(一)"]
    other = ["Aa", "éе", "ßs", "ºo", "②2", "oO", "Il", "1l", "0O", "öo", "жx", "№N", "ǎă"]
    same = lambda t: len(set(_normalise(pa.array([t[0], t[1:]]), known).to_pylist())) == 1
    assert [p for p in pairs if not same(p)] == []
    assert [p for p in other if same(p)] == []
    once = _normalise(pa.array([k for k, _ in known]), known)
    assert _normalise(once, known).equals(once)


def test_without_unicode_data_there_is_no_result(spark, monkeypatch):
    with pytest.raises(RuntimeError, match="ICU"):
        confusable(SimpleNamespace(_jvm=spark._jvm.no.such.classes))
    df = spark.createDataFrame([(1, "p", "d", "f", "ѵalue", "v", None, None), (2, "p", "d", "f", "value", "v", None, None)], SCHEMA)
    assert {tuple(r) for r in alike_pairs(df).collect()} == {(1, 2, "product_name")}  # not in the fixed lists
    monkeypatch.setattr(lookalikes, "_letters", lambda: ("a\n", "b"))
    with pytest.raises(RuntimeError, match="3 skeletons for 2 letters"):
        alike_pairs(df)


def test_one_form_is_stable():
    texts = ["Ｖіе ", "ﬁﬂ", "Ζ⼀", "ä‍"]
    once = forms(*texts)
    assert forms(*once) == once


def test_columns(spark):
    df = spark.createDataFrame([Row(a="Ａ", b=["ｂ", None, ""], a_form="clash"), Row(a=None, b=None, a_form=None), Row(a="x" * 100_000, b=[], a_form="")], "a string, b array<string>, a_form string")
    got = one_form(df, ["a", "b"]).collect()
    assert [(r.a_form if len(r.a_form or "") < 9 else len(r.a_form), r.b_form) for r in got] == [("A", ["b", None, ""]), (None, None), (100_000, [])]


def test_pairs(spark):
    e = lambda p, q: (p, q, "k", "c", "linked")
    rows = [
        (1, "p", "d", "f", "Name A", "v", [e(1, "q one"), e(2, "other")], "x"),
        (2, "p", "d", "f", "Name A", "v", [e(1, "q one"), e(1, "zzz")], "x"),
        (2, "p", "d", "f", "Name A", "v", [e(1, "q one"), e(1, "zzz")], "x"),
        (3, "p", "d", "f", "NAME A", None, None, None),
        (4, "p", "d", "g", "Name A", "v​", [], None),
        (5, None, "d", "f", "Name A", "v​", None, None),
        (None, "p", "d", "f", "Name A", "v", None, None),
        (6, "p", "d", "f", "Ｎame A", "​v", [e(9, "q one")], None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in alike_pairs(df).collect()}
    assert got == {(1, 2, "product_name"), (1, 6, "product_name"), (2, 6, "product_name"), (1, 6, "value"), (2, 6, "value"), (1, 2, "quote")}
    assert alike_pairs(df.limit(0)).count() == 0
