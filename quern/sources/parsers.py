"""Files of many kinds to text, behind one registry, inside Arrow batches of a binary scan."""

from __future__ import annotations

import csv
import email
import email.policy
import io
import json
import re
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Parser = Callable[[bytes], str]
REGISTRY: dict[str, list[Parser]] = {}

# What files of a kind begin with.
MAGIC = ((b"%PDF-", "pdf"), (b"\x89PNG\r\n\x1a\n", "png"), (b"\xff\xd8\xff", "jpg"), (b"GIF8", "gif"), (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "ole"), (b"{\\rtf", "rtf"), (b"RIFF", "riff"), (b"ID3", "mp3"))


class Unreadable(ValueError):
    """No parser gave a text."""


def parser(*kinds: str) -> Callable[[Parser], Parser]:
    """Register a parser for file types; of several the first that gives a text holds."""

    def add(f: Parser) -> Parser:
        for k in kinds:
            REGISTRY.setdefault(k, []).append(f)
        return f

    return add


def sniff(declared: str | None, content: bytes) -> str:
    """The type the bytes have, whatever they are called; the declared one (lower case, no dot) where they don't tell."""
    named = (declared or "").strip().lower().lstrip(".")
    for magic, kind in MAGIC:
        if content.startswith(magic):
            return {"ole": named if named in ("doc", "xls", "ppt") else "doc"}.get(kind, kind)
    if content.startswith(b"PK\x03\x04"):
        try:
            names = zipfile.ZipFile(io.BytesIO(content)).namelist()
        except zipfile.BadZipFile:
            return named or "zip"
        for start, kind in (("word/", "docx"), ("xl/", "xlsx"), ("ppt/", "pptx"), ("META-INF/container.xml", "epub")):
            if any(n.startswith(start) for n in names):
                return kind
        return "zip"
    head = content[:512].lstrip(b"\xef\xbb\xbf \t\r\n").lower()
    if head.startswith((b"<!doctype html", b"<html")):
        return "html"
    if not named and head[:1] in (b"{", b"["):
        return "json"
    return named or "txt"


def decode(content: bytes) -> str:
    """UTF-8 without its mark, or UTF-16 by its mark, or else Latin-1; line ends as one sign."""
    if content[:2] in (b"\xff\xfe", b"\xfe\xff"):
        text = content.decode("utf-16", "replace")
    else:
        try:
            text = content.decode("utf-8-sig")
        except UnicodeDecodeError:
            text = content.decode("latin-1")
    return text.replace("\r\n", "\n").replace("\r", "\n")


@parser("txt", "text", "log", "md", "markdown")
def plain(content: bytes) -> str:
    return decode(content)


def table(rows: list[list[str]]) -> str:
    """A Markdown table; short rows are padded, bars and line ends escaped."""
    if not rows:
        return ""
    width = max(map(len, rows))
    cell = lambda x: str(x).strip().replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join([*map(cell, r), *[""] * (width - len(r))]) + " |" for r in rows]
    return "\n".join([lines[0], "|" + "---|" * width, *lines[1:]])


@parser("csv", "tsv")
def csv_table(content: bytes) -> str:
    text = decode(content)
    sep = "\t" if "\t" in text.split("\n", 1)[0] and "," not in text.split("\n", 1)[0] else ","
    return table([r for r in csv.reader(io.StringIO(text), delimiter=sep, skipinitialspace=True) if any(c.strip() for c in r)])


@parser("json")
def json_blocks(content: bytes, limit: int = 2000) -> str:
    """Fenced blocks of sorted JSON, split at its members until each is small, with the path kept."""
    blocks: list[str] = []

    def wrap(path: list[str], v):
        for k in reversed(path):
            v = {k: v}
        return v

    def walk(v, path: list[str]) -> None:
        text = json.dumps(wrap(path, v), ensure_ascii=False, sort_keys=True, indent=1)
        if isinstance(v, list):
            v = {str(i): x for i, x in enumerate(v)}
        if len(text) <= limit or not isinstance(v, dict) or not v:
            blocks.append(f"```json\n{text}\n```")
        else:
            for k in sorted(v):
                walk(v[k], [*path, k])

    walk(json.loads(decode(content)), [])
    return "\n\n".join(blocks)


class _Html(HTMLParser):
    """Headings, lists, tables, code and links as Markdown."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0
        self.rows: list[list[str]] | None = None
        self.cell: list[str] | None = None
        self.links: list[tuple[str, int]] = []
        self.pre = 0
        self.lists: list[str] = []

    def put(self, s: str) -> None:
        (self.cell if self.cell is not None else self.out).append(s)

    def handle_starttag(self, tag: str, attrs) -> None:
        a = dict(attrs)
        if tag in ("script", "style", "noscript", "template"):
            self.skip += 1
        elif self.skip:
            return
        elif re.fullmatch("h[1-6]", tag):
            self.put("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("p", "div", "section", "article", "ul", "ol", "blockquote"):
            self.put("\n\n" if tag not in ("ul", "ol") or not self.lists else "\n")
            if tag in ("ul", "ol"):
                self.lists.append(tag)
        elif tag == "li":
            self.put("\n" + "  " * max(0, len(self.lists) - 1) + ("1. " if self.lists[-1:] == ["ol"] else "- "))
        elif tag == "br":
            self.put("\n")
        elif tag == "pre":
            self.pre += 1
            self.put("\n\n```\n")
        elif tag in ("b", "strong"):
            self.put("**")
        elif tag == "a" and a.get("href"):
            self.links.append((a["href"], len(self.cell if self.cell is not None else self.out)))
            self.put("[")
        elif tag == "img" and a.get("src"):
            self.put(f"![{a.get('alt') or ''}]({a['src']})")
        elif tag == "table":
            self.rows = []
        elif tag == "tr" and self.rows is not None:
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self.cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "noscript", "template"):
            self.skip = max(0, self.skip - 1)
        elif self.skip:
            return
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self.put("\n```\n\n")
        elif tag in ("b", "strong"):
            self.put("**")
        elif tag == "a" and self.links:
            self.put(f"]({self.links.pop()[0]})")
        elif tag in ("td", "th") and self.cell is not None and self.rows:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None
        elif tag == "table" and self.rows is not None:
            got, self.rows, self.cell = [r for r in self.rows if r], None, None
            self.put("\n\n" + table(got) + "\n\n")

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.put(data if self.pre else re.sub(r"\s+", " ", data))


@parser("html", "htm", "xhtml")
def html_markdown(content: bytes | str) -> str:
    p = _Html()
    p.feed(content if isinstance(content, str) else decode(content))
    p.close()
    text = "".join(p.out)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", text)).strip()


@parser("mhtml", "mht", "eml")
def mhtml(content: bytes) -> str:
    """The largest HTML part, else the largest plain one."""
    m = email.message_from_bytes(content, policy=email.policy.default)
    parts = [(p.get_content_type(), p.get_content()) for p in m.walk() if p.get_content_maintype() == "text"]
    pages = [c for t, c in parts if t == "text/html"]
    if pages:
        return html_markdown(max(pages, key=len))
    if parts:
        return max((c for _, c in parts), key=len)
    raise Unreadable("no text part")


def _xml(z: zipfile.ZipFile, name: str) -> ElementTree.Element:
    return ElementTree.fromstring(z.read(name))


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


@parser("docx")
def docx(content: bytes) -> str:
    """Paragraphs with headings by their style, and tables."""
    body = _xml(zipfile.ZipFile(io.BytesIO(content)), "word/document.xml")[0]
    text = lambda e: "".join("\n" if _local(x.tag) == "br" else x.text or "" for x in e.iter() if _local(x.tag) in ("t", "br"))
    out = []
    for e in body:
        if _local(e.tag) == "p":
            style = next((v for x in e.iter() if _local(x.tag) == "pStyle" for k, v in x.attrib.items() if _local(k) == "val"), "")
            level = re.search(r"[Hh]eading ?(\d)", style)
            if t := text(e).strip():
                out.append("#" * int(level[1]) + " " + t if level else t)
        elif _local(e.tag) == "tbl":
            out.append(table([[text(c).strip() for c in r if _local(c.tag) == "tc"] for r in e if _local(r.tag) == "tr"]))
    return "\n\n".join(out)


@parser("pptx")
def pptx(content: bytes) -> str:
    z = zipfile.ZipFile(io.BytesIO(content))
    names = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
    slides = []
    for i, n in enumerate(names, 1):
        paras = ["".join(t.text or "" for t in p.iter() if _local(t.tag) == "t") for p in _xml(z, n).iter() if _local(p.tag) == "p"]
        slides.append(f"## Slide {i}\n\n" + "\n".join(x for x in paras if x.strip()))
    return "\n\n".join(slides)


@parser("epub")
def epub(content: bytes) -> str:
    """The chapters in the order of the spine, else of their file names' numbers."""
    z = zipfile.ZipFile(io.BytesIO(content))
    names: list[str] = []
    try:
        root = next(x.attrib["full-path"] for x in _xml(z, "META-INF/container.xml").iter() if _local(x.tag) == "rootfile")
        opf = _xml(z, root)
        items = {x.attrib["id"]: x.attrib["href"] for x in opf.iter() if _local(x.tag) == "item"}
        base = root.rpartition("/")[0]
        names = [f"{base}/{items[x.attrib['idref']]}".lstrip("/") for x in opf.iter() if _local(x.tag) == "itemref" and x.attrib["idref"] in items]
    except (KeyError, StopIteration, ElementTree.ParseError):
        names = sorted((n for n in z.namelist() if n.endswith((".xhtml", ".html", ".htm"))), key=lambda n: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", n)])
    return "\n\n".join(html_markdown(z.read(n)) for n in names if n in z.namelist())


def sheets(content: bytes) -> list[tuple[str, list[list[str | None]]]]:
    """(name, rows) of each sheet of a workbook, all values as text; merged cells hold the value of their first."""
    z = zipfile.ZipFile(io.BytesIO(content))
    shared: list[str] = []
    found = next((n for n in z.namelist() if n.lower().endswith("sharedstrings.xml")), None)
    if found:
        shared = ["".join(t.text or "" for t in si.iter() if _local(t.tag) == "t") for si in _xml(z, found)]
    rels = {x.attrib["Id"]: x.attrib["Target"] for x in _xml(z, "xl/_rels/workbook.xml.rels")} if "xl/_rels/workbook.xml.rels" in z.namelist() else {}
    number = lambda ref: sum((ord(c) - 64) * 26**i for i, c in enumerate(reversed(re.match("[A-Z]+", ref)[0]))) - 1
    out = []
    for s in (x for x in _xml(z, "xl/workbook.xml").iter() if _local(x.tag) == "sheet"):
        target = next((rels[v] for k, v in s.attrib.items() if _local(k) == "id" and v in rels), "")
        path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        if path not in z.namelist():
            continue
        root, grid = _xml(z, path), {}
        for row in (x for x in root.iter() if _local(x.tag) == "row"):
            for c in row:
                ref = c.attrib.get("r", "")
                v = next((x.text for x in c if _local(x.tag) == "v"), None)
                if c.attrib.get("t") == "s" and v is not None:
                    v = shared[int(v)]
                elif c.attrib.get("t") == "inlineStr":
                    v = "".join(t.text or "" for t in c.iter() if _local(t.tag) == "t")
                if ref and v is not None:
                    grid[(int(re.search(r"\d+", ref)[0]) - 1, number(ref))] = v
        for m in (x for x in root.iter() if _local(x.tag) == "mergeCell"):
            a, _, b = m.attrib["ref"].partition(":")
            first = (int(re.search(r"\d+", a)[0]) - 1, number(a))
            for r in range(first[0], int(re.search(r"\d+", b or a)[0])):
                for c in range(first[1], number(b or a) + 1):
                    if first in grid:
                        grid.setdefault((r, c), grid[first])
        width = max((c for _, c in grid), default=-1) + 1
        out.append((s.attrib.get("name", ""), [[grid.get((r, c)) for c in range(width)] for r in sorted({r for r, _ in grid})]))
    return out


@parser("xlsx", "xlsm")
def xlsx(content: bytes) -> str:
    """Each row that isn't empty as ``A: value,B: value``."""
    letter = lambda i: (letter(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)
    return "\n".join(",".join(f"{letter(i)}: {v}" for i, v in enumerate(r) if v not in (None, "")) for _, rows in sheets(content) for r in rows if any(v not in (None, "") for v in r))


@parser("png", "jpg", "jpeg", "gif", "mp3", "wav", "riff")
def media(content: bytes) -> str:
    """A mark that a later model stage may replace by what is seen or heard."""
    return f"[media {len(content)} bytes]"


def parse(declared: str | None, content: bytes | None) -> tuple[str, str | None, str | None]:
    """(type, text, error): the first registered parser that gives a text; unknown types are read as text."""
    if not content:
        return sniff(declared, b""), None, "empty"
    kind, why = sniff(declared, content), "no parser"
    for p in REGISTRY.get(kind) or [plain]:
        try:
            if (text := p(content)).strip():
                return kind, text, None
            why = "no text"
        except Exception as e:  # a broken file must not end the job
            why = f"{type(e).__name__}: {e}"[:200]
    return kind, None, why


def parse_files(df: DataFrame, content: str = "content", declared: str = "file_type", *keys: str) -> DataFrame:
    """keys, kind, text, error for each row's bytes."""
    src = df.select(*keys, F.col(declared).alias("_declared"), F.col(content).alias("_content"))
    head = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            got = [parse(d, bytes(c) if c is not None else None) for d, c in zip(pdf["_declared"], pdf["_content"])]
            yield pdf[list(keys)].assign(kind=[g[0] for g in got], text=[g[1] for g in got], error=[g[2] for g in got])

    return src.mapInPandas(run, f"{head}{', ' if head else ''}kind string, text string, error string")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """path, kind, text, error of all files under a path."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return parse_files(b.withColumn("file_type", F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)), "content", "file_type", "path")


def workbook_table(contents: bytes) -> tuple[list[str], list[dict[str, str | None]]]:
    """The rows of all sheets by column name, with ``__sheet_name``; columns a sheet hasn't are missing."""
    columns: dict[str, None] = {}
    rows = []
    for name, grid in sheets(contents):
        if grid:
            header = [str(h) for h in grid[0]]
            columns.update(dict.fromkeys(header))
            rows += [dict(zip(header, r)) | {"__sheet_name": name} for r in grid[1:]]
    return [*columns, "__sheet_name"], rows


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows, columns by name, missing ones null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out




def pipeline(*steps: Callable[[bytes], str]) -> Callable[[bytes], str]:
    """One parser out of several: the text of each is the input of the next."""

    def run(content: bytes) -> str:
        for step in steps:
            content = step(content if isinstance(content, bytes) else content.encode())
        return content if isinstance(content, str) else content.decode("utf-8", "replace")

    return run


@dataclass(frozen=True)
class Engine:
    """A named set of parsers for some types; ``available`` tells whether it can run here (and why not)."""

    name: str
    types: frozenset[str]
    parse: Callable[[str, bytes], str]
    available: Callable[[], tuple[bool, str]] = lambda: (True, "")


#: Engines by name; those that need services or programs of their own are registered from outside.
ENGINES: dict[str, Engine] = {}


def register_engine(engine: Engine) -> None:
    ENGINES[engine.name] = engine


def with_engine(name: str | None, kind: str, content: bytes) -> tuple[str, str]:
    """(engine, text) by the named engine if it knows the type and is available, else by the parsers of the registry."""
    e = ENGINES.get(name or "")
    if e is not None and kind in e.types and e.available()[0]:
        return e.name, e.parse(kind, content)
    _, text, error = parse(kind, content)
    if text is None:
        raise ValueError(error)
    return "builtin", text


def repaired_workbook(content: bytes) -> bytes | None:
    """A workbook whose shared strings are missing or stand under a name in other case, mended; None if nothing was to mend or it is no archive."""
    want = "xl/sharedStrings.xml"
    try:
        src = zipfile.ZipFile(io.BytesIO(content))
    except zipfile.BadZipFile:
        return None
    names = src.namelist()
    if want in names:
        return None
    other = next((n for n in names if n.lower() == want.lower() or n.lower().rpartition("/")[2] == "sharedstrings.xml"), None)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n in names:
            if n != other:
                z.writestr(n, src.read(n))
        z.writestr(want, src.read(other) if other else b'<?xml version="1.0"?><sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" count="0" uniqueCount="0"/>')
    return out.getvalue()


def materialised(spark: SparkSession, path: str, folder: str) -> str:
    """A copy of a file of any file system in a shared folder, its ending kept; an error of reading comes through."""
    from quern.runtime import _hadoop

    ending = re.search(r"\.[A-Za-z0-9]+$", path)
    to = f"{folder.rstrip('/')}/{uuid.uuid4().hex}{ending[0] if ending else ''}"
    fs, p = _hadoop(spark, path)
    tfs, t = _hadoop(spark, to)
    tfs.mkdirs(t.getParent())
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, tfs, t, False, spark._jsparkSession.sessionState().newHadoopConf())
    return to


def workbook_rows(df: DataFrame, content: str, *keys: str) -> DataFrame:
    """keys, sheet, row_no, cells (map of column to text) of all rows below the header of every sheet, read where the bytes lie."""
    head = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for values in pdf.itertuples(index=False):
                raw = values[len(keys)]
                rows = []
                for name, grid in sheets(repaired_workbook(bytes(raw)) or bytes(raw)) if raw is not None else ():
                    header = [str(h) for h in grid[0]] if grid else []
                    rows += [(*values[: len(keys)], name, i, {h: (None if v is None else str(v)) for h, v in zip(header, r)}) for i, r in enumerate(grid[1:], 1)]
                yield pd.DataFrame(rows, columns=[*keys, "sheet", "row_no", "cells"])

    return df.select(*keys, content).mapInPandas(run, f"{head}{', ' if head else ''}sheet string, row_no int, cells map<string,string>")
