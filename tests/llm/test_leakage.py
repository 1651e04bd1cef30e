import pytest

from quern.llm.leakage import leaked_documents, leaked_spans, without_leaks

P = " ".join(f"w{i}" for i in range(30))


def frames(spark):
    items = spark.createDataFrame([(1, P, "x"), (2, "zu kurz für alles", "x"), (3, None, "x"), (None, P, "x"), (4, " ".join(f"w{i}" for i in range(10, 24)), "x")], "item_id bigint, passage string, text string")
    docs = spark.createDataFrame(
        [
            (1, "before " + P.upper().replace(" ", " - ") + " after"), (2, " ".join(f"w{i}" for i in range(12))), (3, "Intro. " + " ".join(f"w{i}" for i in range(5, 18)) + " end"), (4, None), (5, ""), (None, P), (6, "w0 " * 50),
            (7, "İ " + P), (7, "İ " + P), (8, " ".join(f"w{i}" for i in range(10)) + " gap " + " ".join(f"w{i}" for i in range(10, 30))), (9, "a\x00" + P),
        ],
        "doc_id bigint, text string",
    )
    return docs, items


@pytest.mark.parametrize("most", [1_000_000, 3])
def test_found(spark, most):
    docs, items = frames(spark)
    got = {tuple(r) for r in leaked_documents(docs, items, max_ngrams=most).collect()}
    assert got == {(1, 1), (1, 4), (3, 1), (7, 1), (7, 4), (8, 1), (8, 4), (9, 1), (9, 4)}


def test_spans_are_the_same_in_parts(spark):
    docs, items = frames(spark)
    a = sorted(map(tuple, leaked_spans(docs, items).distinct().collect()))
    assert a == sorted(map(tuple, leaked_spans(docs, items, max_ngrams=4).distinct().collect()))
    assert (1, 1, 1, 31) in a and (3, 1, 1, 14) in a


def test_cut_and_empty(spark):
    docs, items = frames(spark)
    left = {r.doc_id: r.text for r in without_leaks(docs, items).collect()}
    assert left[1] == "before  after" and left[3] == "Intro.  end" and left[4] is None and left[None] == P and left[7] == "İ "
    assert {r.doc_id for r in without_leaks(docs, items, whole=True).collect()} == {2, 4, 5, None, 6}
    assert leaked_documents(docs.limit(0), items).count() == 0 and leaked_documents(docs, items.limit(0)).count() == 0
