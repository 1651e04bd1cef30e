import pytest

from quern.llm.residue import _look, form, kind_of_group, masked, message_groups, residue_documents, residue_messages, without_residue

BAD = [
    "Dear {{first_name}},", "Your contract [[branch]] was signed.", "We paid <<amount>> on time.", "Hola «nombre»:", "Please call ${agent} soon.", "Wir haben %BETRAG% überwiesen.", "Kind regards, <?= $agent ?>", "Kind regards, __agent__", "Bonjour @@prenom@@,", "The sum #amount# is due.",
    "Dear [customer_name],", "Hello {branch}!", "Dear <customer.name>,", "请在（请填写日期）之前联系。", "[insert name here]", "[gueltig_bis hier einsetzen]", "until %(capital)s",
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "Sample text goes here.", "Hier steht später Ihr Text.", "内容待补充。",
    "404 Not Found", "<h1>502 Bad Gateway</h1>\n<p>x</p>", "Traceback (most recent call last):\n  File \"a.py\", line 3", "java.lang.NullPointerException\n\tat a.b.C.d(12)", '{"error": {"code": 500}}', "Access denied (403) You do not have permission to open this item.", "系统发生未知错误。", "Home | Search | Login 503 Service Unavailable",
    "<noscript>Please enable JavaScript to view this page.</noscript>", "Skripte sind abgeschaltet.", "Los scripts están desactivados. Actívelos y recargue.", "浏览器未执行脚本，内容无法显示。", "Real content stands here.\n\nYour session has ended, sign in again.",
]
GOOD = [
    "In the letter template the field `{{policy_no}}` is filled in by the print server before dispatch.", "The placeholder ${premium} in the sample offer stands for the yearly amount.", "Write the tag [NAME] only in the master file; the mail run puts the real name there.", "See note [89] and table <230> of the annex.", 'A report with "500 Internal Server Error" in its log goes to the service team.',
    "If the portal shows error 404 after the upload, repeat the step.", "The upload page only works when JavaScript is switched on in the browser.", "The draft brochure still had lorem ipsum on page 9; the final version replaced it.", "信函模板中的字段`{{保单号}}`由打印服务器在寄出前填入。", "宣传册草稿第3页曾有占位文字，定稿改成了费率表。", "He wrote [sic] on [p. 4], 5% of #1.", "See [the guide](http://x.y/z) and <b>this</b>.", "", "|---|---|",
]


# Common residue that stands in no table of the tests.
UNSEEN = [
    "JavaScript must be enabled to use this portal.", "Connection timed out", "503 Backend fetch failed", "TBD", "Cette page n'existe plus.", "页面走丢了", "La sessione è scaduta.", "Diese Website benötigt JavaScript.", "The server encountered an internal error.", "Your content here", "Service temporarily unavailable", "A página não foi encontrada",
]
#: Ordinary sentences that recur in many documents.
ORDINARY = ["Please send the form to your branch.", "The premium is due on the first of the month.", "Bitte senden Sie das Formular an die Filiale.", "Si la garantie a expiré, le service des primes vous écrit.", "The service team answers within two days.", "如果地址已经失效，请通知客服团队。", "Sign here"]


def recurs(text):
    """Whether a text is residue if it stands in many documents."""
    seen, sure = _look(text)
    return bool(sure) or any(may and kind_of_group(m) for m, may in seen.items())


@pytest.mark.parametrize("text", BAD + UNSEEN)
def test_residue(text):
    assert recurs(text)


@pytest.mark.parametrize("text", GOOD + ORDINARY)
def test_content(text):
    assert not recurs(text)


def test_only_shapes_hold_in_a_single_document():
    assert [k for k, _ in _look("Dear {{first_name}},")[1]] == ["slot"]
    assert [k for k, _ in _look("Lorem ipsum dolor sit amet.")[1]] == ["filler"]
    assert not _look("404 Not Found")[1]


def test_masks():
    assert form(masked("See http://a.b/c at 12:30 on 2024-01-02, call 5.5!")) == "see <addr> at #:# on <date>, call #"
    assert form(masked("Error 502")) == "error <code>" and form(masked("at app.xx.Main.run(33)")) == form(masked("at org.yy.zz.View(7)"))
    assert form(masked("KeyError: 'a_b'")) == form(masked("KeyError: 'c'"))


def test_table(spark):
    rows = [(1, "Dear {{x}},", "a", "m"), (1, "Dear {{x}},", "a", "m"), (2, None, "a", "m"), (3, "", None, "m"), (None, "404 Not Found", "a", "m"), (4, "fine " * 100_000, "b", "m")]
    rows += [(10 + i, f"Content {i}.\nText to follow.", "ab"[i % 2], "m") for i in range(3)]
    # of one source only, or in too few documents: nothing that recurs widely
    rows += [(20, "Page not found", "a", "m"), (21, "Page not found", "a", "m"), (22, "Page not found", "a", "m"), (23, "The server is busy", "a", "m"), (24, "The server is busy", None, "m")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, message string")
    got = {tuple(r) for r in residue_messages(df).select("doc_id", "kind", "decided", "n_docs", "n_sources").collect()}
    assert got == {(1, "slot", "shape", None, None), (10, "filler", "recurrence", 3, 2), (11, "filler", "recurrence", 3, 2), (12, "filler", "recurrence", 3, 2)}
    assert {r.doc_id for r in without_residue(df).collect()} == {2, 3, None, 4, 20, 21, 22, 23, 24}
    assert residue_documents(df.limit(0)).count() == 0
    assert {tuple(r) for r in message_groups(df, 2, 2).select("n_docs", "n_sources").collect()} == {(3, 2), (2, 2)}
