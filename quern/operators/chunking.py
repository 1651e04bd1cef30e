"""Splitting documents into chunks: by separators, by headings, with protected spans and carried context."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The defaults of the project, and what is never cut.
SIZE, OVERLAP, SEPARATORS, HARD_LIMIT = 512, 80, ("\n\n", "\n", "。"), 7500
PROTECTED = re.compile(r"```.*?```|\$\$.*?\$\$|!\[[^\]\n]*\]\([^)\n]*\)|\[[^\]\n]+\]\([^)\n]*\)|(?:^\|[^\n]*\|[ \t]*(?:\n|\Z))+", re.S | re.M)
HEADING = re.compile(r"^(#{1,6}) +(.+?)\s*$", re.M)


def units(text: str, separators: Sequence[str], size: int) -> list[tuple[int, int]]:
    """Spans that cover the text: protected ones whole, the rest cut at the separators in turn, recursing only into what is too large."""
    out: list[tuple[int, int]] = []

    def cut(a: int, b: int, level: int) -> None:
        if b - a <= size or level == len(separators):
            out.extend((i, min(b, i + size)) for i in range(a, b, size))
            return
        sep, at = separators[level], a
        while at < b:
            k = text.find(sep, at, b)
            end = b if k < 0 else k + len(sep)
            cut(at, end, level + 1)
            at = end

    at = 0
    for m in PROTECTED.finditer(text):
        if m.start() > at:
            cut(at, m.start(), 0)
        if m.end() > m.start():
            out.extend((i, min(m.end(), i + HARD_LIMIT)) for i in range(m.start(), m.end(), HARD_LIMIT))
        at = max(at, m.end())
    if at < len(text):
        cut(at, len(text), 0)
    return out


def merge_units(spans: list[tuple[int, int]], size: int, overlap: int) -> list[tuple[int, int]]:
    """Neighbouring spans put together up to ``size``; a chunk begins with whole spans of the one before, up to ``overlap``."""
    out, cur = [], []
    for s in spans:
        if cur and s[1] - cur[0][0] > size:
            out.append((cur[0][0], cur[-1][1]))
            keep: list[tuple[int, int]] = []
            for p in reversed(cur):
                if s[0] - p[0] > overlap or s[1] - p[0] > size:
                    break
                keep.insert(0, p)
            cur = keep
        cur.append(s)
    if cur:
        out.append((cur[0][0], cur[-1][1]))
    return out


def recursive(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: Sequence[str] = SEPARATORS) -> list[tuple[int, int, str]]:
    """(start, end, context) of the chunks."""
    return [(a, b, "") for a, b in merge_units(units(text, separators, size), size, overlap)]


def by_headings(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: Sequence[str] = SEPARATORS, tiny: int = 60) -> list[tuple[int, int, str]]:
    """Sections at the most frequent heading level, each with the headings above it as context; tiny ones join the next, large ones are split further."""
    heads = [(m.start(), len(m[1]), m[2]) for m in HEADING.finditer(text)]
    if len(heads) < 2:
        return []
    levels = [lv for _, lv, _ in heads]
    main = min(set(levels), key=lambda lv: (-levels.count(lv), lv))
    starts = sorted({0, *(p for p, lv, _ in heads if lv <= main)})
    out: list[tuple[int, int, str]] = []
    trail: dict[int, str] = {}
    begin = None
    for a, b in zip(starts, [*starts[1:], len(text)]):
        for p, lv, name in heads:
            if p == a:
                trail = {k: v for k, v in trail.items() if k < lv} | {lv: name}
        begin = a if begin is None else begin
        if b - begin < tiny and b < len(text):
            continue
        crumb = " > ".join(trail[k] for k in sorted(trail))
        if b - begin <= size:
            out.append((begin, b, crumb))
        else:
            out.extend((begin + x, begin + y, crumb) for x, y, _ in recursive(text[begin:b], size, overlap, separators))
        begin = None
    return out


# What marks a boundary in a text without Markdown headings, strongest first.
MARKS = [
    re.compile(r"\f"), re.compile(r"^(?:第[0-9一二三四五六七八九十百]+[章节条]|(?:chapter|section|kapitel|abschnitt|chapitre|capítulo)\s+\w+|[0-9]+(?:\.[0-9]+)*[.、]?\s+\S[^\n]{0,60}$)", re.M | re.I), re.compile(r"^(?:-{3,}|\*{3,}|_{3,}|={3,})[ \t]*$", re.M),
    re.compile(r"\n[ \t]*\n+"), re.compile(r"^(?=[-*•] |\d+[.)] )", re.M), re.compile(r"\n"), re.compile(r"(?<=[.!?。！？])(?:\s+|(?=[^\s]))"),
]
STRONG = 3


def boundaries(text: str) -> dict[int, int]:
    """Place of each possible cut with its priority (0 the strongest); a mark that begins a line is cut before it, one between lines behind it."""
    out: dict[int, int] = {}
    for k, rx in enumerate(MARKS):
        for m in rx.finditer(text):
            at = m.start() if k in (1, 2, 4) else m.end()
            if 0 < at < len(text):
                out[at] = min(k, out.get(at, k))
    return out


def heuristic(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: Sequence[str] = SEPARATORS) -> list[tuple[int, int, str]]:
    """Chunks of texts whose structure isn't in Markdown: as much as fits, cut at the strongest boundary in the second half, the next one beginning at a boundary within the overlap; nothing without two strong marks."""
    # the few strong marks are looked for first
    if len(text) <= size or len({m.start() for rx in MARKS[:STRONG] for m in rx.finditer(text)}) < 2:
        return []
    at = boundaries(text)
    if sum(k < STRONG for k in at.values()) < 2:
        return []
    places = sorted(at)
    out, a, done = [], 0, 0
    while len(text) - a > size:
        some = places[max(bisect_left(places, a + size // 2), bisect_right(places, done)) : bisect_right(places, a + size)]
        end = max(some, key=lambda p: (-at[p], p)) if some else a + size
        out.append((a, end, ""))
        done = end
        if some and at[end] < STRONG:
            a = end  # nothing is carried over a strong boundary
            continue
        back = [p for p in places[bisect_left(places, end - min(overlap, size - 1)) : bisect_left(places, end)] if p > a]
        a = back[0] if back else end
    out.append((a, len(text), ""))
    return out


_TABLE = re.compile(r"(?:^\|[^\n]*\|[ \t]*(?:\n|\Z)){2,}", re.M)


def carried_header(text: str, start: int) -> str:
    """The header rows of the Markdown table that a chunk begins inside of, '' if it doesn't."""
    for m in _TABLE.finditer(text):
        if m.start() < start < m.end():
            lines = m[0].split("\n")
            head = lines[:2] if len(lines) > 1 and re.fullmatch(r"\|[\s:|-]+\|[ \t]*", lines[1]) else lines[:1]
            at_row = start == m.start() or text[start - 1] == "\n"
            return "\n".join(head) if at_row and start - m.start() > sum(len(x) + 1 for x in head) - 1 else ""
        if m.start() >= start:
            break
    return ""


def restored(text_chunks: Sequence[tuple[int, int, str]]) -> str:
    """The text of (start, end, content) pieces that overlap."""
    out, at = [], 0
    for a, b, t in sorted(text_chunks):
        if b > at:
            out.append(t[max(0, at - a) :])
            at = b
    return "".join(out)


def sections(pages: Sequence[tuple[int, str]], target: int = 3000, least: int = 400) -> list[tuple[str, int, int, str]]:
    """(title, first page, last page, text) of the sections of a document of pages: cut before headings, small ones joined to the next up to the target, larger ones cut at line ends."""
    blocks: list[tuple[str, int, int, str]] = []
    title, lines, first, last = "", [], None, None

    def close() -> None:
        nonlocal lines, first
        if lines:
            blocks.append((title, first, last, "\n".join(lines)))
        lines, first = [], None

    for no, text in pages:
        for line in text.split("\n"):
            head = line.strip()
            if head and len(head) <= 60 and (HEADING.match(line) or MARKS[1].match(head)):
                close()
                title = head.lstrip("# ").strip()
            first = no if first is None else first
            last = no
            lines.append(line)
    close()
    joined: list[tuple[str, int, int, str]] = []
    for b in blocks:
        if joined and len(joined[-1][3]) < least and len(joined[-1][3]) + len(b[3]) < target:
            t, p, _, text = joined[-1]
            joined[-1] = (t or b[0], p, b[2], f"{text}\n{b[3]}")
        else:
            joined.append(b)
    out = []
    for t, p, q, text in joined:
        while len(text) > target:
            cut = text.rfind("\n", target // 2, target)
            cut = target if cut < 0 else cut + 1
            out.append((t, p, q, text[:cut]))
            text = text[cut:]
        out.append((t, p, q, text))
    return out


def embedding_content(context: Column, body: Column) -> Column:
    """What is embedded of a chunk: its context, a blank line, and its trimmed text; without a context the text alone."""
    return F.concat_ws("\n\n", F.when(F.coalesce(F.trim(context), F.lit("")) != "", F.trim(context)), F.trim(body))


def problems(chunks: list[tuple[int, int, str]], text: str, size: int) -> list[str]:
    """Why a set of chunks is not fit, if so."""
    out = []
    if text.strip() and not chunks:
        out.append("no chunk")
    if any(b - a > HARD_LIMIT for a, b, _ in chunks):
        out.append("a chunk is too large")
    if len(chunks) > 4 and sum(b - a for a, b, _ in chunks) / len(chunks) < size / 20:
        out.append("chunks are too small")
    return out


def chunk(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: Sequence[str] = SEPARATORS) -> tuple[str, list[tuple[int, int, str]], list[str]]:
    """(strategy, chunks, why others were rejected): by headings where there are some, by other marks of structure, else by separators, which always holds."""
    why = []
    for name, f in (("heading", by_headings), ("heuristic", heuristic), ("recursive", recursive)):
        got = f(text, size, overlap, separators)
        bad = problems(got, text, size)
        if not bad or name == "recursive":
            return name, got, why
        why.append(f"{name}: {', '.join(bad)}")
    raise AssertionError


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, overlap: int = OVERLAP, separators: Sequence[str] = SEPARATORS) -> DataFrame:
    """id, seq, start_at, end_at, strategy, context, content, prev_seq, next_seq of the chunks of each text; null and empty texts give no row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for i, t in zip(pdf[id_col], pdf[text_col]):
                if t:
                    name, got, _ = chunk(t, size, overlap, separators)
                    # a chunk that begins inside a table carries its header rows
                    if len(got) > 1 and (t[0] == "|" or "\n|" in t):
                        spans = [m.span() for m in _TABLE.finditer(t)]
                        got = [(a, b, "\n".join(x for x in (c, carried_header(t, a) if any(x < a < y for x, y in spans) else "") if x)) for a, b, c in got]
                    rows += [(i, k, a, b, name, c, t[a:b], k - 1 if k else None, k + 1 if k + 1 < len(got) else None) for k, (a, b, c) in enumerate(got)]
            yield pd.DataFrame(rows, columns=[id_col, "seq", "start_at", "end_at", "strategy", "context", "content", "prev_seq", "next_seq"]).astype({"prev_seq": "Int32", "next_seq": "Int32"})

    return docs.select(id_col, text_col).mapInPandas(run, f"{id_col} {kind}, seq int, start_at int, end_at int, strategy string, context string, content string, prev_seq int, next_seq int")


def parent_child(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parent: int = 2048, child: int = 384, overlap: int = 60) -> DataFrame:
    """id, parent_seq, child_seq (over the whole text), start_at, end_at, content: children cut from each parent chunk."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for i, t in zip(pdf[id_col], pdf[text_col]):
                n = 0
                for p, (a, b, _) in enumerate(chunk(t, parent, 0)[1] if t else []):
                    for x, y, _ in recursive(t[a:b], child, overlap):
                        rows.append((i, p, n, a + x, a + y, t[a + x : a + y]))
                        n += 1
            yield pd.DataFrame(rows, columns=[id_col, "parent_seq", "child_seq", "start_at", "end_at", "content"])

    return docs.select(id_col, text_col).mapInPandas(run, f"{id_col} {kind}, parent_seq int, child_seq int, start_at int, end_at int, content string")


def inject_links(text: str, names: dict[str, str]) -> str:
    """The first safe mention of each name as a Markdown link to its page, longest names first; code and links stay as they are."""
    for name in sorted(names, key=lambda x: (-len(x), x)):
        taken = [m.span() for m in re.finditer(r"```.*?```|`[^`\n]*`|!?\[[^\]\n]*\]\([^)\n]*\)", text, re.S)]
        edge = (r"(?<!\w)", r"(?!\w)") if name.isascii() else ("", "")
        for m in re.finditer(edge[0] + re.escape(name) + edge[1], text):
            if not any(a <= m.start() < b for a, b in taken):
                text = f"{text[: m.start()]}[{name}]({names[name]}){text[m.end() :]}"
                break
    return text
