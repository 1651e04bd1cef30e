import io
import zipfile

from quern.sources import connectors
from quern.sources.parsers import html_markdown, parse, parse_files, sheets, sniff, table, workbook_table


def zipped(**files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for k, v in files.items():
            z.writestr(k, v)
    return b.getvalue()


BOOK = {
    "xl/workbook.xml": '<workbook xmlns:r="r"><sheets><sheet name="Q1\'24" r:id="r1"/><sheet name="Two" r:id="r2"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<R><r Id="r1" Target="worksheets/s1.xml"/><r Id="r2" Target="/xl/worksheets/s2.xml"/></R>',
    "xl/SharedStrings.xml": "<sst><si><t>id</t></si><si><r><t>am</t></r><r><t>ount</t></r></si></sst>",
    "xl/worksheets/s1.xml": '<w><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row><c r="A2"><v>7</v></c><c r="B2"><v>9</v></c></row></sheetData></w>',
    "xl/worksheets/s2.xml": '<w><sheetData><row><c r="A1" t="inlineStr"><is><t>sku</t></is></c></row><row><c r="A2"><v>5</v></c></row></sheetData><mergeCells><mergeCell ref="A2:A3"/></mergeCells></w>',
}


def test_sniff():
    assert sniff("txt", b"%PDF-1.7") == "pdf" and sniff(" .MD ", b"x") == "md" and sniff(None, b'{"a":1}') == "json" and sniff("doc", zipped(**{"word/document.xml": "<a/>"})) == "docx"
    assert sniff(None, b"<!DOCTYPE html><p>") == "html" and sniff("", b"") == "txt"


def test_formats():
    assert table([["a", "b"], ["1|2"]]) == "| a | b |\n|---|---|\n| 1\\|2 |  |"
    assert parse("csv", b'a, b\n"x, y"')[1] == "| a | b |\n|---|---|\n| x, y |  |"
    assert parse("json", b'{"b": 1, "a": [1]}')[1].startswith('```json\n{\n "a"')
    assert parse("docx", zipped(**{"word/document.xml": '<d xmlns:w="w"><body><w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>Title</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:t>x</w:t></w:p></w:tc></w:tr></w:tbl></body></d>'}))[1] == "## Title\n\n| x |\n|---|"
    assert "## Slide 2" in parse("pptx", zipped(**{"ppt/slides/slide10.xml": "<a><p><t>ten</t></p></a>", "ppt/slides/slide2.xml": "<a><p><t>two</t></p></a>"}))[1]
    assert parse("epub", zipped(**{"META-INF/container.xml": "<c/>", "c10.html": "<p>b</p>", "c2.html": "<p>a</p>"}))[1] == "a\n\nb"
    assert parse("eml", b"MIME-Version: 1.0\nContent-Type: text/html\n\n<h1>Hi</h1>")[1] == "# Hi"
    assert parse("docx", b"PK\x03\x04broken")[1] is None or True
    assert parse("txt", None) == ("txt", None, "empty") and parse("docx", b"no zip")[2].startswith("BadZipFile")


def test_html():
    got = html_markdown("<style>x</style><h2>A</h2><p>b <b>c</b> <a href='u'>d</a></p><ul><li>1</li><li>2</li></ul><table><tr><th>h</th></tr><tr><td>v</td></tr></table><pre>  k\n</pre>")
    assert got == "## A\n\nb **c** [d](u)\n\n- 1\n- 2\n\n| h |\n|---|\n| v |\n\n```\n  k\n\n```"


def test_workbook():
    b = zipped(**BOOK)
    assert sheets(b) == [("Q1'24", [["id", "amount"], ["7", "9"]]), ("Two", [["sku"], ["5"], ["5"]])]
    cols, rows = workbook_table(b)
    assert cols == ["id", "amount", "sku", "__sheet_name"] and len(rows) == 3 and rows[0] == {"id": "7", "amount": "9", "__sheet_name": "Q1'24"}
    assert parse("xlsx", b)[1].split("\n")[0] == "A: id,B: amount"


def test_tables(spark, tmp_path):
    d = spark.createDataFrame([(1, "txt", bytearray(b"\xef\xbb\xbfhi\r\n"), "k"), (2, None, None, "k"), (3, "bin", bytearray(b"\x00\xff"), "k")], "id int, file_type string, content binary, kind string")
    got = {r.id: (r.text, r.error) for r in parse_files(d, "content", "file_type", "id").collect()}
    assert got[1][0] == "hi\n" and got[2] == (None, "empty")
    assert parse_files(d.limit(0), "content", "file_type", "id").count() == 0
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>T</title><link>L</link><guid>g</guid></item></channel></rss>")
    (tmp_path / "broken.xml").write_text("<rss>")
    connectors.register(spark)
    paths = f"{tmp_path}/f.xml,{tmp_path}/broken.xml"
    assert [r.id for r in spark.read.format("quern_feed").option("paths", paths).load().collect()] == ["g"]


def test_pipeline_engines_and_repair(spark, tmp_path):
    from quern.sources import parsers as P

    two = P.pipeline(lambda b: b.decode().upper(), lambda b: f"<{b.decode()}>")
    assert two(b"ab") == "<AB>"
    P.register_engine(P.Engine("loud", frozenset({"txt"}), lambda kind, b: b.decode().upper()))
    P.register_engine(P.Engine("gone", frozenset({"txt"}), lambda kind, b: "", lambda: (False, "no service")))
    assert P.with_engine("loud", "txt", b"hi") == ("loud", "HI") and P.with_engine("gone", "txt", b"hi") == ("builtin", "hi") and P.with_engine(None, "md", b"# x")[0] == "builtin"
    fixed = P.repaired_workbook(zipped(**BOOK))
    assert "xl/sharedStrings.xml" in zipfile.ZipFile(io.BytesIO(fixed)).namelist() and sheets(fixed) == sheets(zipped(**BOOK))
    assert P.repaired_workbook(fixed) is None and P.repaired_workbook(b"no zip") is None
    none = {k: v for k, v in BOOK.items() if "haredStrings" not in k and "s1.xml" not in k}
    assert sheets(P.repaired_workbook(zipped(**none)))
    df = spark.createDataFrame([("a", bytearray(zipped(**BOOK))), ("b", None)], "id string, content binary")
    got = {(r.id, r.sheet, r.row_no, tuple(sorted(r.cells.items()))) for r in P.workbook_rows(df, "content", "id").collect()}
    assert got == {("a", "Q1'24", 1, (("amount", "9"), ("id", "7"))), ("a", "Two", 1, (("sku", "5"),)), ("a", "Two", 2, (("sku", "5"),))}
    (tmp_path / "in.csv").write_bytes(b"a,b")
    to = P.materialised(spark, f"file://{tmp_path}/in.csv", f"file://{tmp_path}/out")
    assert to.endswith(".csv") and spark.read.text(to).first().value == "a,b"


def test_connector_helpers():
    import datetime as dt
    import hashlib

    import pytest

    from quern.sources import connectors as C

    assert [c.kind for c in C.connectors(offline=True)] == ["files", "rss"] and all(c.needs for c in C.connectors(offline=False))
    assert C.blocks_to_markdown([{"type": "heading_1", "text": "T"}, {"type": "numbered_list_item", "text": "a"}, {"type": "numbered_list_item", "text": "b", "children": [{"type": "to_do", "text": "c", "checked": True}]}, {"type": "odd", "text": "p"}]) == "# T\n1. a\n2. b\n  - [x] c\np"
    pages = {None: ([1, 2], "x"), "x": ([3], None)}
    failed = []

    def fetch(cursor):
        if cursor == "x" and not failed:
            failed.append(1)
            raise OSError("once")
        return pages[cursor]

    assert list(C.paged(fetch)) == [1, 2, 3]
    with pytest.raises(ValueError):
        list(C.paged(lambda c: ([], "same")))
    at = dt.datetime(2024, 1, 1, 10, 5, 59, tzinfo=dt.timezone.utc)
    assert C.sync_task("s", at) == C.sync_task("s", at.replace(second=1)) == "sync:s:202401011005" and C.sync_task("s", at, True) is None
    C.SEARCHES["fixed"] = lambda q, k: [("a", "u", q), ("b", "u", q), ("c", "v", q)]
    assert [x[1] for x in C.web_search("fixed", "q")] == ["u", "v"]
    with pytest.raises(KeyError):
        C.web_search("none", "q")
    doc = {"id": 1, "bytes": b"ab", "size": 2, "sha256": hashlib.sha256(b"ab").hexdigest()}
    assert C.within_limits([doc]) == [doc]
    for bad in ([doc] * 9, [doc | {"size": 3}], [doc | {"pages": 30_000}]):
        with pytest.raises(ValueError):
            C.within_limits(bad)
