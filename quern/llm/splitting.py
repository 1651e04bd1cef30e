"""Splitting oversized texts at natural boundaries by agglomerative merging.

A text is first cut at every separator into atoms. All adjacent pairs lie in a
heap by the strength of the boundary between them; the weakest boundary goes
first, and a pair merges as long as the result, with the overlap that will
precede it, still fits. What is left are the pieces. The overlap is never cut.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The project's defaults.
DEFAULT_SIZE = 512
DEFAULT_OVERLAP = 80
DEFAULT_SEPARATORS = ("\n\n", "\n", "。")
#: Characters of pieces that are handed back at once.
BATCH_CHARS = 4_000_000

PIECE_SCHEMA = "request_id string, piece_no int, n_pieces int, start_at int, core_at int, end_at int, boundary string, cut string, n_chars int, text string"


@lru_cache(maxsize=512)
def _pattern(separators: tuple[str, ...]) -> tuple[re.Pattern, dict[str, int]]:
    """Longest separator first; strength by place in the list, the first the strongest."""
    pat = re.compile("|".join(re.escape(s) for s in sorted(separators, key=len, reverse=True)))
    return pat, {s: len(separators) + 1 - i for i, s in reversed(list(enumerate(separators)))}


_HAN = re.compile(r"[㐀-鿿豈-﫿぀-ヿ가-힣]")


def _inside_word(text: str, at: int) -> bool:
    """Whether a cut before ``at`` would go through a word."""
    a, b = text[at - 1], text[at]
    return a.isalnum() and b.isalnum() and not (_HAN.match(a) or _HAN.match(b))


class Plan:
    """Where the pieces of one text may begin: a piece at ``core`` starts with the end of the one before."""

    def __init__(self, text: str, size: int, overlap: int):
        self.text, self.size = text, size
        self.overlap = min(overlap, size - 1)
        #: How far an overlap may reach back further to begin with a word.
        self.slack = min(32, (size - self.overlap) // 4)
        self.known: dict[int, int] = {}

    def lead(self, core: int) -> int:
        """The overlap of a piece at ``core``: what was asked for, or more to the beginning of a word."""
        if core <= self.overlap:
            return core
        got = self.known.get(core)
        if got is None:
            at = core - self.overlap
            got = self.overlap
            if self.overlap:
                for back in range(min(self.slack, at) + 1):
                    if at == back or not _inside_word(self.text, at - back):
                        got += back
                        break
            self.known[core] = got
        return got

    def room(self, core: int) -> int:
        return self.size - self.lead(core)


def atoms(plan: Plan, separators: Sequence[str]) -> tuple[list[int], list[int], bool]:
    """Ends of the atoms, the strength of the boundary at each end, and whether some stretch without separators is longer than the size.

    A separator stays with the text before it, unless that alone fills the room.
    A stretch longer than the room that its overlap leaves is cut as often as
    needed, at white space in the second half of the room where there is some;
    such cuts have strength 0.
    """
    text, size, room = plan.text, plan.size, plan.room
    ends: list[int] = []
    force: list[int] = []
    forced = False

    def stretch(a: int, b: int) -> int:
        """Cut from ``a`` on until the rest up to ``b`` fits; where the rest begins."""
        while b - a > room(a):
            most = room(a)
            a = max(text.rfind(" ", a + most // 2, a + most), text.rfind("\t", a + most // 2, a + most)) + 1 or a + most
            ends.append(a)
            force.append(0)
        return a

    at = 0
    last = 0  # the end of the last separator
    if separators:
        pat, rank = _pattern(tuple(separators))
        for m in pat.finditer(text):
            a, b = m.span()
            forced |= a - last > size
            last = b
            at = stretch(at, a)
            if b - at > room(at) and a > at:  # the separator doesn't fit behind its stretch
                ends.append(a)
                force.append(rank[m[0]])
                at = a
            while b - at > room(at):  # nor anywhere
                at += room(at)
                ends.append(at)
                force.append(0)
            ends.append(b)
            force.append(rank[m[0]])
            at = b
    forced |= len(text) - last > size
    at = stretch(at, len(text))
    if at < len(text):
        ends.append(len(text))
        force.append(0)
    return ends, force, forced


def split_text(text: str, size: int, overlap: int, separators: Sequence[str]) -> tuple[list[tuple[int, int, int, str]], bool]:
    """Pieces as (start with overlap, start of its own part, end, kind of the boundary at its end), and whether some stretch without separators is longer than the size."""
    if len(text) <= size:
        return ([(0, 0, len(text), "end")] if text else []), False
    plan = Plan(text, size, overlap)
    room = plan.room
    ends, force, forced = atoms(plan, separators)
    n = len(ends)
    begin = [0, *ends[:-1]]
    finish = list(ends)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    stamp = [0] * n
    heap = [(force[i], finish[i + 1] - begin[i], i, 0, 0) for i in range(n - 1) if finish[i + 1] - begin[i] <= room(begin[i])]
    heapq.heapify(heap)
    while heap:
        strength, total, i, a, b = heapq.heappop(heap)
        j = right[i] if alive[i] else n
        if j >= n or stamp[i] != a or stamp[j] != b or total > room(begin[i]):
            continue
        finish[i], force[i], alive[j] = finish[j], force[j], False
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        stamp[i] += 1
        for p, q in ((left[i], i), (i, right[i])):
            if p >= 0 and q < n and (t := finish[q] - begin[p]) <= room(begin[p]):
                heapq.heappush(heap, (force[p], t, p, stamp[p], stamp[q]))
    out = []
    for i in range(n):
        if alive[i]:
            out.append((begin[i] - plan.lead(begin[i]), begin[i], finish[i], "end" if finish[i] == len(text) else "separator" if force[i] else "forced"))
    return out, forced


def _decode(raw: bytes | None) -> str:
    """UTF-8 without one leading byte order mark; broken bytes become U+FFFD."""
    if not raw:
        return ""
    text = bytes(raw).decode("utf-8", "replace")
    return text[1:] if text.startswith("﻿") else text


def _pieces(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["request_id", "piece_no", "n_pieces", "start_at", "core_at", "end_at", "boundary", "cut", "n_chars", "text"]
    kinds = [pa.string(), *[pa.int32()] * 5, pa.string(), pa.string(), pa.int32(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in it:
        rows, held = [], 0
        for rid, raw, size, overlap, seps in zip(*(batch.column(i) for i in range(5))):
            text = _decode(raw.as_py())
            cuts, forced = split_text(text, size.as_py(), overlap.as_py(), [s for s in seps.as_py() or () if s])
            kind = "whole" if len(cuts) < 2 else "forced" if forced else "natural"
            for k, (a, core, b, edge) in enumerate(cuts):
                rows.append((rid.as_py(), k + 1, len(cuts), a, core, b, edge, kind, b - a, text[a:b]))
                held += b - a
                if held > BATCH_CHARS:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)


def latest_requests(requests: DataFrame) -> DataFrame:
    """request_id, knowledge_base_id, file_content: of several rows of one request the latest by received_at (null before any time), then the one with the greater hash."""
    order = F.struct(F.coalesce(F.col("received_at").cast("string"), F.lit("")).alias("at"), F.xxhash64("file_content", "knowledge_base_id").alias("h"))
    one = requests.groupBy("request_id").agg(F.max_by(F.struct("knowledge_base_id", "file_content"), order).alias("r"))
    return one.select("request_id", "r.knowledge_base_id", "r.file_content")


def split_requests(requests: DataFrame, bases: DataFrame) -> DataFrame:
    """Pieces of ``file_content`` under the chunk_size of the request's knowledge base.

    One row a piece: request_id, piece_no (from 1), n_pieces, start_at, core_at
    and end_at (code points; core_at - start_at is the overlap with the piece
    before), boundary at its end (``separator``, ``forced``, ``end``), cut of the
    whole text (``whole``, ``natural``, ``forced``), n_chars, text.

    chunk_size null or below 1 means 512, chunk_overlap null 80 and below 0 none;
    one of the whole size or more counts as one less. Every piece but the first
    starts with the chunk_overlap characters before it (all there are, near the
    beginning of the text), and up to 32 more, or a quarter of what is left of
    the size, to begin with a word. A stretch that fits the size, but not the
    room that the overlap leaves, is cut, though ``cut`` then says ``natural``.
    Separators null mean the default ones, empty ones are ignored, and without
    any every cut is forced. Unknown bases have the defaults. Requests with null
    or empty content give no row; repeated rows give their pieces again.
    """
    kb = bases.groupBy("knowledge_base_id").agg(F.min(F.struct("chunk_size", "chunk_overlap", "separators")).alias("k")).select("knowledge_base_id", "k.*")
    r = requests.select("request_id", "knowledge_base_id", F.col("file_content").alias("content")).where("length(content) > 0")
    size = F.when(F.col("chunk_size") >= 1, F.col("chunk_size")).otherwise(F.lit(DEFAULT_SIZE))
    seps = F.coalesce("separators", F.array(*map(F.lit, DEFAULT_SEPARATORS)))
    j = r.join(kb, "knowledge_base_id", "left").select(
        "request_id", "content", size.alias("size"), F.greatest(F.coalesce("chunk_overlap", F.lit(DEFAULT_OVERLAP)), F.lit(0)).alias("overlap"), seps.alias("seps")
    )
    return j.select("request_id", "content", "size", "overlap", "seps").mapInArrow(_pieces, PIECE_SCHEMA)


def oversized(pieces: DataFrame) -> DataFrame:
    """request_id, cut of the requests that had to be split; of differing repeated rows ``forced`` holds."""
    return pieces.where("n_pieces > 1 and piece_no = 1").groupBy("request_id").agg(F.min("cut").alias("cut"))
