"""Splitters by their properties."""

from hypothesis import given, settings
from hypothesis import strategies as st

from quern.operators import chunking as C


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["Chapter 1", "1.2 Name", "word " * 9, "- item", "", "---", "\f", "第3章 总则", "Ein Satz. Noch einer."]), max_size=40), st.integers(30, 200), st.integers(0, 20))
def test_heuristic_covers_and_bounds(lines, size, overlap):
    text = "\n".join(lines)
    got = C.heuristic(text, size, overlap)
    if got:
        assert C.restored([(a, b, text[a:b]) for a, b, _ in got]) == text
        assert all(0 < b - a <= size for a, b, _ in got) and all(c < e for (_, c, _), (_, e, _) in zip(got, got[1:]))
        assert all(c - a <= overlap for (_, c, _), (a, _, _) in zip(got, got[1:]))


def test_strong_marks_win():
    text = "Chapter 1\n" + "a b c. " * 10 + "\nChapter 2\n" + "d e f. " * 10 + "\nChapter 3\n" + "g h i. " * 10
    cuts = [text[a:b].split("\n")[0] for a, b, _ in C.heuristic(text, 100, 20)]
    assert cuts == ["Chapter 1", "Chapter 2", "Chapter 3"]
    assert C.heuristic("plain text. " * 50, 100, 20) == [] and C.chunk("plain text. " * 50, 100)[0] == "recursive" and C.chunk(text, 100)[0] == "heuristic"


def test_header_is_carried():
    table = "| a | b |\n|---|---|\n" + "".join(f"| {i} | {i} |\n" for i in range(30))
    text = "before\n\n" + table
    row = text.index("| 9 |")
    assert C.carried_header(text, row) == "| a | b |\n|---|---|" and C.carried_header(text, 0) == "" and C.carried_header(text, row + 2) == "" and C.carried_header(text, text.index("| a")) == ""


def test_sections_keep_pages():
    pages = [(1, "# One\n" + "x\n" * 300), (2, "more\n# Two\n" + "y\n" * 300), (3, "# Three\nz")]
    got = C.sections(pages, target=500, least=50)
    assert [(t, p, q) for t, p, q, _ in got][0] == ("One", 1, 2) and {t for t, *_ in got} >= {"One", "Two"} and all(len(x) <= 500 for *_, x in got)
    assert "".join(x.replace("\n", "") for *_, x in got) == "".join(t.replace("\n", "") for _, t in pages)
