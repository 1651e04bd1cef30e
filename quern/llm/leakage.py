"""Evaluation passages leaking into training text.

Every run of ``width`` consecutive words of an evaluation passage is hashed, and
each training text's word windows are rolled over in numpy and looked up, in one
pass over the texts. A set of bounded size goes to all executors with its words,
so hits are verified, and leaked stretches cut out, on the spot. Of a larger set
only a bitmap of hashes, itself of bounded size, goes to the executors; windows
that it lets through are joined with the set by a shuffle on hash and words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.runtime import discard, settle, spread

WIDTH = 13
#: Distinct n-grams that are broadcast with their words: 13 numbers of 4 bytes each, their vocabulary and items, some 100 MB.
MAX_NGRAMS = 500_000
#: Bits of the bitmap for larger sets: 32 MB.
BITMAP = 1 << 28
#: Characters of texts that are worked on at once.
STEP_CHARS = 2_000_000

_WORD = re.compile(r"\w+")
_MARK = "\x00"
_WORD_OR_MARK = re.compile(r"\w+|\x00")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores in lower case."""
    return list(map(str.lower, _WORD.findall(text))) if text else []


def _roll(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash of every window of ``width`` ids."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    x = ids.astype(np.uint64)
    for k in range(width):
        h *= _BASE
        h += x[k : k + n]
        h ^= h >> np.uint64(29)
    return h


class Ngrams:
    """The broadcast set: word numbers, and for each n-gram its words and items."""

    def __init__(self, grams: pa.Table, width: int):
        """``grams`` has gram (a list of ``width`` words) and item_ids."""
        self.width = width
        words = pc.list_flatten(grams.column("gram")).combine_chunks().dictionary_encode() if grams.num_rows else pa.array([], pa.string()).dictionary_encode()
        self.number = {w: i + 1 for i, w in enumerate(words.dictionary.to_pylist())}
        rows = (words.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1).reshape(-1, width)
        h = np.zeros(len(rows), np.uint64)
        for k in range(width):
            h *= _BASE
            h += rows[:, k].astype(np.uint64)
            h ^= h >> np.uint64(29)
        order = np.argsort(h, kind="stable")
        self.hashes, self.rows = h[order], rows[order]
        self.items = grams.column("item_ids").combine_chunks().take(pa.array(order)) if len(rows) else pa.array([], pa.list_(pa.int64()))

    def scan(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text number, n-gram number, first word and last word + 1 of every verified hit."""
        joined = _MARK.join((t or "").replace(_MARK, " ") for t in texts)
        tokens = _WORD_OR_MARK.findall(joined)
        get = self.number.get
        ids = np.fromiter((get(t, 0) for t in map(str.lower, tokens)), np.int32, len(tokens))
        if len(ids) < self.width or not len(self.hashes):
            z = np.empty(0, np.int64)
            return z, z, z, z
        # a window counts only if all its words are known: count unknown ones by a running sum
        unknown = np.concatenate(([0], np.cumsum(ids == 0)))
        n = len(ids) - self.width + 1
        at = np.flatnonzero(unknown[self.width : self.width + n] == unknown[:n])
        if not len(at):
            z = np.empty(0, np.int64)
            return z, z, z, z
        h = _roll(ids, self.width)[at]
        lo, hi = np.searchsorted(self.hashes, h, "left"), np.searchsorted(self.hashes, h, "right")
        marks = np.flatnonzero(np.fromiter((t == _MARK for t in tokens), bool, len(tokens)))
        hit_at, gram = [], []
        for p, a, b in zip(at[hi > lo], lo[hi > lo], hi[hi > lo]):
            for g in range(a, b):
                if np.array_equal(self.rows[g], ids[p : p + self.width]):
                    hit_at.append(p)
                    gram.append(g)
        hit_at = np.array(hit_at, np.int64)
        doc = np.searchsorted(marks, hit_at, "right")
        start = np.concatenate(([0], marks + 1))[doc]
        return doc, np.array(gram, np.int64), hit_at - start, hit_at - start + self.width


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about STEP_CHARS of a text column."""
    size = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // STEP_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def _spans(s: Ngrams, texts: list[str | None]) -> dict[tuple[int, int], list[list[int]]]:
    """The stretches of words of each (text, item), overlapping and adjoining ones joined."""
    doc, gram, a, b = s.scan(texts)
    spans: dict[tuple[int, int], list[list[int]]] = {}
    for d, g, x, y in sorted(zip(doc.tolist(), gram.tolist(), a.tolist(), b.tolist()), key=lambda r: (r[0], r[2])):
        for item in s.items[g].as_py():
            runs = spans.setdefault((d, item), [])
            if runs and x <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], y)
            else:
                runs.append([x, y])
    return spans


def cut_spans(text: str, spans) -> str:
    """``text`` without the stretches (first word, end word), from the first to the last word of each."""
    at = [m.span() for m in _WORD.finditer(text)]
    kept, pos = [], 0
    for a, b in sorted(spans):
        if at[a][0] >= pos:
            kept.append(text[pos : at[a][0]])
        pos = max(pos, at[b - 1][1])
    return "".join([*kept, text[pos:]])


def _word_hash(words: list[str], known: dict[str, int]) -> np.ndarray:
    if len(known) > 1_000_000:
        known.clear()
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh64_intdigest(w)
        out[i] = h
    return out


def ngrams(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """h bigint, gram array<string>, item_ids array<bigint>: the distinct runs of ``width`` words of all passages, and their hash."""

    def rows(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for pdf in it:
            out = []
            for k, p in zip(pdf["item_id"], pdf["passage"]):
                w = words(p)
                h = _roll(_word_hash(w, known), width).view(np.int64).tolist()
                out += [(h[i], w[i : i + width], int(k)) for i in range(len(h))]
            yield pd.DataFrame(out, columns=["h", "gram", "item_id"])

    g = items.where("item_id is not null").select("item_id", "passage").mapInPandas(rows, "h bigint, gram array<string>, item_id bigint")
    return g.groupBy("h", "gram").agg(F.collect_set("item_id").alias("item_ids"))


def _bitmap(grams: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the hashes, put together of packed blocks, so what comes to the driver is bounded by its size."""
    block = 1 << 16

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        a = np.zeros(block, bool)
        a[pdf["bit"].to_numpy(np.int64) % block] = True
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "packed": [np.packbits(a).tobytes()]})

    rows = grams.select(F.expr(f"h & {bits - 1}L").alias("bit")).distinct().withColumn("block", F.shiftright("bit", 16))
    out = np.zeros(bits // 8, np.uint8)
    for r in rows.groupBy("block").applyInPandas(pack, "block bigint, packed binary").collect():
        out[r["block"] * (block // 8) : (r["block"] + 1) * (block // 8)] = np.frombuffer(bytes(r["packed"]), np.uint8)
    return out


def _through_bitmap(src: DataFrame, grams: DataFrame, width: int, kind: str, bits: int) -> DataFrame:
    """doc_id, item_id, first_word, end_word by a bitmap and a join."""
    held = src.sparkSession.sparkContext.broadcast(_bitmap(grams, bits))

    def look(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for whole in it:
            for batch in _parts(whole, 1):
                at, first, hashes, texts = [], [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    w = words(text)
                    h = _roll(_word_hash(w, known), width)
                    bit = (h & np.uint64(bits - 1)).astype(np.int64)
                    for p in np.flatnonzero((held.value[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1).tolist():
                        at.append(i)
                        first.append(p)
                        hashes.append(int(h[p : p + 1].view(np.int64)[0]))
                        texts.append(w[p : p + width])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(first, pa.int32()), pa.array(hashes, pa.int64()), pa.array(texts, pa.list_(pa.string()))], ["doc_id", "first_word", "h", "gram"])

    hits = src.mapInArrow(look, f"doc_id {kind}, first_word int, h bigint, gram array<string>")
    out = hits.join(grams, ["h", "gram"]).select("doc_id", F.explode("item_ids").alias("item_id"), "first_word", (F.col("first_word") + width).alias("end_word")).distinct()
    # join what overlaps or adjoins
    w = Window.partitionBy("doc_id", "item_id").orderBy("first_word", "end_word")
    far = F.max("end_word").over(w.rowsBetween(Window.unboundedPreceding, -1))
    g = out.withColumn("new", (far.isNull() | (F.col("first_word") > far)).cast("int")).withColumn("run", F.sum("new").over(w))
    return g.groupBy("doc_id", "item_id", "run").agg(F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word")).drop("run")


def leaked_spans(docs: DataFrame, items: DataFrame, width: int = WIDTH, max_ngrams: int = MAX_NGRAMS, id_col: str = "doc_id", text_col: str = "text", bits: int = BITMAP) -> DataFrame:
    """doc_id, item_id, first_word, end_word: the stretches of words a text shares with a passage.

    Overlapping and adjoining hits of one item come out as one stretch, words
    counting from 0. Case and whatever stands between words are ignored. Null and
    empty texts and passages of fewer than ``width`` words give no row; rows
    without an id are left out; repeated documents give their rows again, but
    once only where there are more than ``max_ngrams`` n-grams.
    """
    grams = settle(ngrams(items, width), "grams")
    kind = docs.schema[id_col].dataType.simpleString()
    src = spread(docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    if grams.count() > max_ngrams:
        return _through_bitmap(src, grams, width, kind, bits)
    held = docs.sparkSession.sparkContext.broadcast(Ngrams(grams.select("gram", "item_ids").toArrow(), width))
    discard(grams)

    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for batch in _parts(whole, 1):
                flat = [(d, i, x, y) for (d, i), runs in _spans(held.value, batch.column(1).to_pylist()).items() for x, y in runs]
                take = pa.array([f[0] for f in flat], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), *(pa.array([f[j] for f in flat], t) for j, t in ((1, pa.int64()), (2, pa.int32()), (3, pa.int32())))], ["doc_id", "item_id", "first_word", "end_word"])

    return src.mapInArrow(scan, f"doc_id {kind}, item_id bigint, first_word int, end_word int")


def leaked_documents(docs: DataFrame, items: DataFrame, width: int = WIDTH, max_ngrams: int = MAX_NGRAMS) -> DataFrame:
    """doc_id, item_id: each document and each item it leaks, once."""
    return leaked_spans(docs, items, width, max_ngrams).select("doc_id", "item_id").distinct()


def without_leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, whole: bool = False, max_ngrams: int = MAX_NGRAMS) -> DataFrame:
    """``docs`` without leaking documents (``whole``), or with the leaked stretches cut out of their text.

    Cutting replaces each stretch, from its first to its last word, by nothing.
    Documents without a leak, also those with null text or id, stay as they are.
    """
    if whole:
        return docs.join(leaked_documents(docs, items, width, max_ngrams).select("doc_id").distinct(), "doc_id", "left_anti")
    grams = settle(ngrams(items, width), "grams")
    if grams.count() <= max_ngrams:
        held = docs.sparkSession.sparkContext.broadcast(Ngrams(grams.select("gram", "item_ids").toArrow(), width))
        discard(grams)
        id_at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")

        def clean(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Find the stretches and cut them in one pass; only texts with a leak are written anew."""
            for whole_batch in it:
                for batch in _parts(whole_batch, text_at):
                    texts, some = batch.column(text_at).to_pylist(), batch.column(id_at).is_valid().to_pylist()
                    spans: dict[int, list] = {}
                    for (d, _), runs in _spans(held.value, [t if ok else None for t, ok in zip(texts, some)]).items():
                        spans.setdefault(d, []).extend(map(tuple, runs))
                    arrays = list(batch.columns)
                    if spans:
                        for d, cuts in spans.items():
                            texts[d] = cut_spans(texts[d], cuts)
                        arrays[text_at] = pa.array(texts, batch.column(text_at).type)
                    yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

        return spread(docs).mapInArrow(clean, docs.schema)
    per = leaked_spans(docs, items, width, max_ngrams).groupBy("doc_id").agg(F.collect_set(F.struct("first_word", "end_word")).alias("_spans"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or s is None else cut_spans(t, [(x["first_word"], x["end_word"]) for x in s]) for t, s in zip(text, spans)], dtype=object)

    j = docs.join(per, "doc_id", "left")
    return j.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut("text", "_spans"))).drop("_spans").select(*docs.columns)
