import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from quern.llm.splitting import latest_requests, oversized, split_requests, split_text

REQ = T.StructType([T.StructField("request_id", T.StringType()), T.StructField("knowledge_base_id", T.StringType()), T.StructField("file_content", T.BinaryType()), T.StructField("text", T.StringType())])
KB = "knowledge_base_id string, chunk_size int, chunk_overlap int, separators array<string>, text string"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n.。", max_size=300), st.integers(1, 40), st.integers(0, 60), st.lists(st.sampled_from(["\n\n", "\n", "。", ". ", " "]), max_size=4))
def test_pieces_cover_the_text(text, size, overlap, seps):
    cuts, forced = split_text(text, size, overlap, seps)
    assert "".join(text[c:b] for _, c, b, _ in cuts) == text
    assert all(0 < b - a <= size for a, _, b, _ in cuts)
    overlap = min(overlap, size - 1)
    slack = min(32, (size - overlap) // 4)
    for (_, _, e, _), (a, c, b, _) in zip(cuts, cuts[1:]):
        # every piece has the overlap that was asked for, or a little more to begin with a word
        assert c == e and min(overlap, c) <= c - a <= overlap + slack
        at = c - overlap
        if 0 < overlap < c and any(not (text[p - 1].isalnum() and text[p].isalnum()) for p in range(max(1, at - slack), at + 1)):
            assert not (text[a - 1].isalnum() and text[a].isalnum()) or a == 0
    if len(text) > size:
        parts = re.split("|".join(map(re.escape, sorted(seps, key=len, reverse=True))), text) if seps else [text]
        assert forced == any(len(p) > size for p in parts)


def test_natural_boundaries_are_kept():
    text = "aaaa\n\nbb\ncc\n\ndddd"
    cuts, forced = split_text(text, 8, 0, ["\n\n", "\n"])
    assert not forced and [text[c:b] for _, c, b, _ in cuts] == ["aaaa\n\n", "bb\ncc\n\n", "dddd"]


def test_table(spark):
    rows = [("a", "k", b"\xef\xbb\xbf" + b"x" * 10, "clash"), ("a", "k", b"\xef\xbb\xbf" + b"x" * 10, "clash"), ("b", "k", b"ab\ncd\nef\ngh", None), ("c", "k", None, None), ("d", "k", b"", None), ("e", None, b"y" * 600, None), (None, "none", b"z" * 513, None), ("f", "k", b"\xff\xfe", None)]
    kb = spark.createDataFrame([("k", 6, 2, ["\n"], "clash")], KB)
    df = spark.createDataFrame(rows, REQ)
    p = split_requests(df, kb)
    assert all(r.n_chars <= 512 for r in p.collect())
    got = {(r.request_id, r.cut) for r in oversized(p).collect()}
    assert got == {("a", "forced"), ("b", "natural"), ("e", "forced"), (None, "forced")}
    assert split_requests(df.limit(0), kb).count() == 0
    assert oversized(split_requests(df, kb.limit(0))).count() == 2


def test_latest_request_counts(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [("a", "k", b"old " * 10, t), ("a", "k", b"new", t + dt.timedelta(1)), ("a", "k", b"new", t + dt.timedelta(1)), ("b", "k", b"x", None), (None, None, None, None)]
    got = {(r.request_id, bytes(r.file_content or b"")) for r in latest_requests(spark.createDataFrame(rows, "request_id string, knowledge_base_id string, file_content binary, received_at timestamp_ntz")).collect()}
    assert got == {("a", b"new"), ("b", b"x"), (None, b"")}


def test_long_text_is_fast():
    text = ("word " * 9 + "\n") * 20_000
    cuts, _ = split_text(text, 512, 80, ["\n\n", "\n"])
    assert "".join(text[c:b] for _, c, b, _ in cuts) == text
