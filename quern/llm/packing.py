"""Packing texts into containers of fixed capacity along a space-filling curve.

Each text becomes its tokens in a public tokenizer. The tokens, hashed into a
vector and projected to a few dimensions, give a place on a Hilbert curve. The
curve is cut into segments of about equal weight, by counts alone, so the result
doesn't depend on partitions. Along a segment a container takes the texts as
they come; where the next one doesn't fit, the room left is filled with the best
fitting ones of a small window ahead. Only a text larger than the capacity is
split.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.runtime import settle, spread

#: Where the public tokenizers lie; a parameter, as their files are no part of this library.
TOKENIZER_DIR = os.environ.get("QUERN_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = "byte_bpe_50k.tiktoken"
# Fixed value: the public pre-tokenisation pattern of that vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

HASHED, DIMS, BITS = 512, 4, 8
#: Texts ahead on the curve that may fill the room that a container has left.
WINDOW = 128
#: Tokens in a segment of the curve; the last container of each may stay unfilled.
SEGMENT = 1 << 20
#: The curve is counted in so many cells.
CELL_BITS = 16


@lru_cache(maxsize=2)
def _encoder(folder: str, name: str):
    """The number of tokens and the tokens of texts, by ``tiktoken``."""
    import tiktoken

    with open(os.path.join(folder, name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(f"quern-{name}", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    """HASHED x DIMS signs, from a fixed rule."""
    i = np.arange(HASHED * DIMS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    i ^= i >> np.uint64(29)
    i *= np.uint64(0xBF58476D1CE4E5B9)
    return np.where((i >> np.uint64(40)) & np.uint64(1), 1.0, -1.0).reshape(HASHED, DIMS)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of cells (n, dims), by Skilling's transpose."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def places(tokens: list[np.ndarray]) -> np.ndarray:
    """The place on the curve of each text from its tokens."""
    n = len(tokens)
    if not n:
        return np.empty(0, np.int64)
    row = np.repeat(np.arange(n), [len(t) for t in tokens])
    flat = np.concatenate(tokens).astype(np.int64) if len(row) else np.empty(0, np.int64)
    hashed = (flat * 0x9E3779B1 >> 7) % HASHED
    v = np.bincount(row * HASHED + hashed, minlength=n * HASHED).reshape(n, HASHED)
    v = np.log1p(v)
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    p = (v / np.where(norm == 0, 1, norm)) @ _projection()
    cells = np.clip((np.tanh(p * 1.2) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert(cells, BITS)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZER_DIR, name: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens, place: the size of each text in tokens and its place on the curve."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(folder, name)
        for batch in it:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                tokens = [np.array(enc.encode_ordinary(t), np.int32) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in tokens], pa.int32()), pa.array(places(tokens))], ["doc_id", "n_tokens", "place"])

    src = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return spread(src).mapInArrow(run, f"doc_id {kind}, n_tokens int, place bigint")


def walk(sizes: np.ndarray, capacity: int, window: int = WINDOW) -> tuple[np.ndarray, int]:
    """The container of each item (none larger than the capacity) in the order of the curve, and how many there are."""
    n = len(sizes)
    out = np.empty(n, np.int64)
    ahead = np.arange(min(n, window))
    size = sizes[ahead]
    nxt, k = len(ahead), 0
    while len(ahead):
        # the run of next items that fit
        total = np.cumsum(size)
        run = int(np.searchsorted(total, capacity, "right"))
        taken = np.zeros(len(ahead), bool)
        taken[:run] = True
        room = capacity - int(total[run - 1])
        while room > 0:
            fits = np.where(~taken & (size <= room), size, 0)
            best = int(fits.argmax())  # the nearest of the best fitting
            if not fits[best]:
                break
            taken[best] = True
            room -= int(size[best])
        out[ahead[taken]] = k
        k += 1
        more = np.arange(nxt, min(n, nxt + int(taken.sum())))
        nxt += len(more)
        ahead = np.concatenate([ahead[~taken], more])
        size = sizes[ahead]
    return out, k


def segments(m: DataFrame, weight: int = SEGMENT) -> DataFrame:
    """``m`` with segment bigint: contiguous cells of the curve of about ``weight`` tokens together; a cell heavier than that is cut by a hash of the ids."""
    cell = F.shiftright("place", DIMS * BITS - CELL_BITS).cast("int")
    spark = m.sparkSession
    # at most 2^CELL_BITS rows
    cells = sorted((r["cell"], r["n"]) for r in m.groupBy(cell.alias("cell")).agg(F.sum(F.greatest("n_tokens", F.lit(1))).alias("n")).collect())
    rows, at, held = [], -1, weight
    for c, n in cells:
        if held + n > weight:
            at, held = at + 1, 0
        cut = -(-n // weight)
        rows.append((c, at, cut))
        held += n
        if cut > 1:
            at, held = at + cut - 1, weight
    plan = spark.createDataFrame(rows, "cell int, segment bigint, cuts bigint")
    j = m.withColumn("cell", cell).join(F.broadcast(plan), "cell")
    return j.withColumn("segment", F.col("segment") + F.pmod(F.xxhash64("doc_id"), F.col("cuts"))).drop("cell", "cuts")


def pack(docs: DataFrame, budgets: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZER_DIR, name: str = TOKENIZER, window: int = WINDOW, weight: int = SEGMENT) -> DataFrame:
    """budget, container_id, doc_id, piece_no, from_token, n_tokens, capacity: the container of each text, for each budget.

    A text within the capacity is one piece and never split; a larger one gives
    pieces of the whole capacity, each a container of its own, and a rest that is
    packed like a text. Texts without tokens (null, empty) come with n_tokens 0
    and take no room, in container '' of their own. Repeated rows are packed as
    often as they stand there; rows without an id, and budgets that are null or
    below 1, give no row. Budgets are a small table: its size is checked.
    """
    caps = [(str(r["budget"]), int(r["capacity_tokens"])) for r in budgets.where("budget is not null and capacity_tokens >= 1").select("budget", "capacity_tokens").distinct().orderBy("budget", "capacity_tokens").limit(1001).collect()]
    if len(caps) > 1000:
        raise ValueError("more than 1000 budgets")
    kind = docs.schema[id_col].dataType.simpleString()

    def flush(segment: int, ids: pa.Array, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        for budget, cap in caps:
            full = size // cap
            rest = size - full * cap
            # whole pieces have a container each; a text of exactly the capacity is one piece
            whole = np.repeat(np.arange(len(size)), full)
            first = np.concatenate(([0], np.cumsum(full)))[:-1]
            no = np.arange(len(whole)) - np.repeat(first, full)
            some = np.flatnonzero(rest)
            held, n_held = walk(rest[some], cap, window)
            none = np.flatnonzero(size == 0)
            at = np.concatenate([whole, some, none])
            c = [f"{budget}-{segment}-{k}" for k in np.concatenate([n_held + np.arange(len(whole)), held]).tolist()] + [""] * len(none)
            piece = np.concatenate([no + 1, full[some] + 1, np.ones(len(none), np.int64)])
            n = np.concatenate([np.full(len(whole), cap), rest[some], np.zeros(len(none), np.int64)])
            start = np.concatenate([no * cap, full[some] * cap, np.zeros(len(none), np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([budget] * len(at), pa.string()), pa.array(c, pa.string()), ids.take(pa.array(at)), pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(np.full(len(at), cap, np.int32))],
                ["budget", "container_id", "doc_id", "piece_no", "from_token", "n_tokens", "capacity"],
            )

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in it:
            of = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(of)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(of)]):
                if lo == hi:
                    continue
                if held and of[lo] != now:
                    t = pa.Table.from_batches(held).combine_chunks()
                    yield from flush(int(now), t.column(1).combine_chunks(), t.column(2).to_numpy().astype(np.int64))
                    held = []
                now = of[lo]
                held.append(batch.slice(lo, hi - lo))
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            yield from flush(int(now), t.column(1).combine_chunks(), t.column(2).to_numpy().astype(np.int64))

    # the tokens are counted only once
    m = settle(measured(docs, id_col, text_col, folder, name), "measured")
    # equal places are ordered by a hash; a segment, at most twice its weight, is one group
    s = segments(m, weight).withColumn("salt", F.xxhash64("doc_id"))
    ordered = s.repartition("segment").sortWithinPartitions("segment", "place", "salt", "doc_id", "n_tokens").select("segment", "doc_id", "n_tokens")
    return ordered.mapInArrow(run, f"budget string, container_id string, doc_id {kind}, piece_no int, from_token int, n_tokens int, capacity int")
