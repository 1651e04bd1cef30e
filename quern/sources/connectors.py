"""Connectors as Python data sources: full and incremental reads behind one interface."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

@dataclass(frozen=True)
class Connector:
    """What is known of a kind of source: whether it can be read here, and how."""

    kind: str
    name: str
    offline: bool
    incremental: bool
    deletes: bool = False
    needs: tuple[str, ...] = ()


# Known kinds of sources; those that need a network are interfaces to be registered.
CATALOGUE = {
    c.kind: c
    for c in (
        Connector("rss", "RSS and Atom feeds", True, True), Connector("files", "Folders", True, True), Connector("crawler", "Web pages", False, False, needs=("fetch",)), Connector("wiki", "Wiki trees", False, True, True, ("fetch", "token")), Connector("notes", "Block documents", False, True, True, ("fetch", "token")),
        Connector("repository", "Source repositories", False, True, True, ("fetch", "token")), Connector("drive", "Shared drives", False, True, True, ("fetch", "token")), Connector("chat", "Chats", False, True, needs=("fetch", "token")), Connector("mail", "Mailboxes", False, True, needs=("fetch", "token")),
    )
}


def connectors(offline: bool | None = None, incremental: bool | None = None) -> list[Connector]:
    """Known connectors, by kind, that have what is asked for."""
    return [c for _, c in sorted(CATALOGUE.items()) if (offline is None or c.offline == offline) and (incremental is None or c.incremental == incremental)]


def blocks_to_markdown(blocks: list[dict], depth: int = 0) -> str:
    """The Markdown of a tree of blocks ``{"type", "text", "children", "checked", "language"}``; unknown kinds give their text."""
    out, number = [], 0
    for b in blocks:
        kind, text, pad = b.get("type", ""), b.get("text", "") or "", "  " * depth
        number = number + 1 if kind == "numbered_list_item" else 0
        line = {
            "heading_1": f"# {text}", "heading_2": f"## {text}", "heading_3": f"### {text}", "bulleted_list_item": f"{pad}- {text}", "numbered_list_item": f"{pad}{number}. {text}", "to_do": f"{pad}- [{'x' if b.get('checked') else ' '}] {text}",
            "quote": f"> {text}", "code": f"```{b.get('language', '')}\n{text}\n```", "divider": "---",
        }.get(kind, f"{pad}{text}")
        out.append(line)
        if b.get("children"):
            out.append(blocks_to_markdown(b["children"], depth + 1))
    return "\n".join(x for x in out if x)


def paged(fetch: Callable[[str | None], tuple[list, str | None]], tries: int = 3, pause: Callable[[int], None] = lambda n: None) -> Iterator:
    """All items of a source that gives pages and a cursor; a page that fails is tried again, a cursor that comes back ends it with an error."""
    cursor, seen = None, set()
    while True:
        for n in range(tries):
            try:
                items, nxt = fetch(cursor)
                break
            except OSError:
                if n + 1 == tries:
                    raise
                pause(n)
        yield from items
        if nxt is None:
            return
        if nxt in seen:
            raise ValueError(f"cursor {nxt} came back")
        seen.add(nxt)
        cursor = nxt


def sync_task(source_id: str, at: dt.datetime, running: bool = False) -> str | None:
    """The id of a timed pull: one a minute and source, so replicas that fire together enqueue it once; none while one runs."""
    return None if running else f"sync:{source_id}:{at.astimezone(dt.timezone.utc):%Y%m%d%H%M}"


#: Web search by name: a function of (query, k) that gives (title, url, snippet); ``fixed`` answers from a list, for work without a network.
SEARCHES: dict[str, Callable[[str, int], list[tuple[str, str, str]]]] = {}


def web_search(name: str, query: str, k: int = 5) -> list[tuple[str, str, str]]:
    """The results of a registered provider, each address once; an unknown provider is an error."""
    if name not in SEARCHES:
        raise KeyError(f"no web search {name}; known: {sorted(SEARCHES)}")
    out, seen = [], set()
    for title, url, text in SEARCHES[name](query, k):
        if url not in seen and len(out) < k:
            seen.add(url)
            out.append((title, url, text))
    return out


def within_limits(documents: list[dict], most: int = 8, most_bytes: int = 256 << 20, most_pages: int = 20_000) -> list[dict]:
    """A batch of documents (bytes, size, pages, sha256) as it is, or an error for all of it: beyond a limit, or where bytes aren't what their description says."""
    if len(documents) > most or sum(d["size"] for d in documents) > most_bytes or sum(d.get("pages", 0) for d in documents) > most_pages:
        raise ValueError("the batch is beyond a limit")
    for d in documents:
        if len(d["bytes"]) != d["size"] or hashlib.sha256(d["bytes"]).hexdigest() != d["sha256"]:
            raise ValueError(f"{d.get('id')} isn't what its description says")
    return documents


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


def feed_items(text: str) -> Iterator[tuple[str, str, str, str, str]]:
    """id, title, link, summary, fingerprint of the items of an RSS or Atom feed; a broken feed has none."""
    try:
        root = ElementTree.fromstring(text)
    except ElementTree.ParseError:
        return
    local = lambda e: e.tag.rpartition("}")[2]
    for item in root.iter():
        if local(item) in ("item", "entry"):
            got = {local(c): (c.text or c.attrib.get("href") or "").strip() for c in item}
            title, link = got.get("title", ""), got.get("link", "")
            body = got.get("description") or got.get("summary") or got.get("content") or ""
            key = got.get("guid") or got.get("id") or link or title
            yield key, title, link, body, hashlib.sha256(f"{title}\0{link}\0{body}".encode()).hexdigest()


class FeedSource(DataSource):
    """``spark.read.format("quern_feed").option("paths", "a.xml,b.xml")``: the items of feeds, one partition a file; paths without a scheme are local ones.

    As a stream it gives, on each pull, the items of one more file.
    """

    @classmethod
    def name(cls) -> str:
        return "quern_feed"

    def schema(self) -> str:
        return "id string, title string, link string, summary string, fingerprint string, feed string"

    def _paths(self) -> list[str]:
        return [p.strip() for p in self.options.get("paths", "").split(",") if p.strip()]

    def reader(self, schema) -> DataSourceReader:
        return _FeedReader(self._paths())

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _FeedStream(self._paths())


def _read(path: str) -> Iterator[tuple]:
    if "://" in path:
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(path)
        with store.open_input_file(name) as f:
            text = f.read().decode("utf-8", "replace")
    else:
        with open(path, encoding="utf-8") as f:
            text = f.read()
    for item in feed_items(text):
        yield (*item, path)


def read_feeds(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The items of feeds on any file system that Spark knows; the files are read by Spark's own scan."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [(*item, p) for p, c in zip(pdf["path"], pdf["content"]) for item in feed_items(bytes(c).decode("utf-8", "replace"))]
            yield pd.DataFrame(rows, columns=["id", "title", "link", "summary", "fingerprint", "feed"])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, "id string, title string, link string, summary string, fingerprint string, feed string")


class _FeedReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.paths]

    def read(self, partition: _File) -> Iterator[tuple]:
        yield from _read(partition.path)


class _FeedStream(SimpleDataSourceStreamReader):
    """The cursor is the number of files read, so a pull that times out goes on where it was."""

    def __init__(self, paths: list[str]):
        self.paths = paths

    def initialOffset(self) -> dict:
        return {"at": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        at = start["at"]
        return (_read(self.paths[at]), {"at": at + 1}) if at < len(self.paths) else (iter(()), start)

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for p in self.paths[start["at"] : end["at"]]:
            yield from _read(p)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FeedSource)
