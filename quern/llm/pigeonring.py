"""Near-duplicate records by set overlap, with pigeonring filtering.

A record is the set of its terms. Two sets x and y overlap by at least t (shared
over all terms) exactly if their Hamming distance, the number of terms that only
one of them has, is at most H = (1 - t) / (1 + t) * (|x| + |y|).

Candidates meet in groups that share a rare term: terms are ordered by how many
records hold them, and two sets within H share a term among the first few of
each. A term held by too many records is extended by the next shared one, and
again, so that groups stay small; what stays large at the last level is checked
in blocks.

Inside a group the terms of a set, folded into 256 bits, make a ring of segments
whose bits differ in at most as many places as the sets do. A pair is kept only
if some chain of consecutive segments, going round the ring, keeps its
cumulative difference within its proportional share of H at every length. Only
such pairs reach the full Hamming check on the terms. No step loses a pair.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.runtime import discard, settle, spread

THRESHOLD = 0.75
#: A term (or chain of terms) that more records hold is extended by another one; more in data so large that counters are full.
HOT = 1500
#: Counters of each level are sized by the data, LOAD terms to a counter at most hot / LOAD times, up to this many of 4 bytes.
MAX_COUNTERS, LOAD = 1 << 25, 8
#: Chains are extended until none is held by too many records, but no further.
DEPTH = 5
SEGMENTS = 8
BITS = 256
#: Groups of up to so many sets are checked together, larger ones one by one.
SMALL_GROUP = 32
#: Members of one set that a task pairs at once with those of another.
MEMBERS = 512
#: Texts whose terms are hashed at once, and sets whose keys are made at once.
CHUNK_BYTES, CHUNK_SETS = 1 << 20, 1024

_WORD = re.compile(r"\w+")
_HAN_RANGES = (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)
_HAN = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _HAN_RANGES) + "]")
_MIX = 0x9E3779B97F4A7C15


def question_terms(questions) -> set[str]:
    """The terms of an entry: words in lower case, or pairs of neighbouring characters of a question with Chinese ones."""
    out: set[str] = set()
    for q in questions:
        if not q:
            continue
        w = _WORD.findall(q.lower())
        if not q.isascii() and _HAN.search(q):
            s = "".join(w)
            out.update(map("".join, zip(s, s[1:])))
        else:
            out.update(w)
    return out


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each character a random odd number, 0 if it is in no word, and whether it is Chinese."""
    chars = [chr(c) for c in range(0x110000)]
    word = np.fromiter((c.isalnum() for c in chars), bool, len(chars))
    word[ord("_")] = True
    han = np.zeros(len(chars), bool)
    for a, b in _HAN_RANGES:
        han[a : b + 1] = True
    return np.where(word, _random(np.arange(len(chars), dtype=np.uint64)), np.uint64(0)), han


def _random(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(1)) * np.uint64(_MIX)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


def _places(n: int) -> np.ndarray:
    return _random(np.arange(1 << 32, (1 << 32) + n, dtype=np.uint64))


def _shares(letter: np.ndarray, place: np.ndarray) -> np.ndarray:
    """What letters at places of a term add to its hash; 0 for what is in no word."""
    v = letter * place
    v ^= v >> np.uint64(32)
    return v


def hashed_terms(questions: list[str | None], row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``question_terms`` of rows as sorted 64-bit hashes, one row after the other, and their numbers; row: that of each question, ascending."""
    letters, han = _letters()
    low = [q.lower() if q else "" for q in questions]
    lens = np.fromiter(map(len, low), np.int64, len(low)) + 1
    chars = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le"), np.uint32)
    first = np.cumsum(lens) - lens
    letter = letters[chars]
    word = letter != 0
    word[1:] &= ~word[:-1]
    starts = np.flatnonzero(word)
    chinese = np.zeros(len(low), bool)
    chinese[np.searchsorted(first, np.flatnonzero(han[chars]), "right") - 1] = True
    # words, up to the next one: blanks between add nothing
    per = np.diff(np.append(np.searchsorted(starts, first), len(starts)))
    hashes = np.empty(0, np.uint64)
    if len(starts):
        at = np.arange(starts[0], len(chars)) - np.repeat(starts, np.diff(np.append(starts, len(chars))))
        at[letter[starts[0] :] == 0] = 0
        hashes = np.add.reduceat(_shares(letter[starts[0] :], _places(int(at.max()) + 1)[at]), starts - starts[0])
    rows = np.repeat(row, per)
    if chinese.any():
        keep = np.repeat(~chinese, per)
        hashes, rows = hashes[keep], rows[keep]
        own = np.flatnonzero((letter != 0) & np.repeat(chinese, lens))
        q = np.searchsorted(first, own, "right") - 1
        near = q[1:] == q[:-1]
        two = _places(2)
        pairs, r = (_shares(letter[own[:-1]], two[:1]) + _shares(letter[own[1:]], two[1:]))[near], row[q[1:][near]]
        words, both = np.bincount(rows, minlength=n_rows), np.bincount(r, minlength=n_rows)
        total = words + both
        base = np.cumsum(total) - total
        out = np.empty(len(hashes) + len(pairs), np.uint64)
        out[base[rows] + np.arange(len(rows)) - (np.cumsum(words) - words)[rows]] = hashes
        out[base[r] + words[r] + np.arange(len(r)) - (np.cumsum(both) - both)[r]] = pairs
        hashes = out
    else:
        total = np.bincount(rows, minlength=n_rows)
    hashes = hashes * np.uint64(_MIX)
    hashes ^= hashes >> np.uint64(31)
    ends = np.cumsum(total)
    for a, b in zip((ends - total).tolist(), ends.tolist()):
        hashes[a:b].sort()
    rows = np.repeat(np.arange(n_rows), total)
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[new], np.bincount(rows[new], minlength=n_rows)


def _batch_terms(col: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Terms and their numbers of so many rows at once, and the first of these rows."""
    texts, n = col.flatten(), col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    last = np.cumsum(n)
    size = np.concatenate(([0], np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))))[last]
    lo = 0
    while lo < len(n):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + CHUNK_BYTES, "right")))
        a, b = int(last[lo] - n[lo]), int(last[hi - 1])
        yield *hashed_terms(texts.slice(a, b - a).to_pylist(), np.repeat(np.arange(hi - lo), n[lo:hi]), hi - lo), lo
        lo = hi


def term_sets(df: DataFrame, id_col: str, text_cols: list[str], order_col: str | None) -> DataFrame:
    """id, at, sid, terms: the set of each row's terms as sorted 64-bit hashes, and the hash of the set; rows without terms or id are left out.

    ``text_cols`` are strings or arrays of strings; ``order_col`` tells which of several rows of one id is the latest.
    """
    cols = [F.col(c) if df.schema[c].dataType.simpleString() != "string" else F.array(c) for c in text_cols]
    texts = F.concat(*(F.coalesce(c.cast("array<string>"), F.array().cast("array<string>")) for c in cols))
    at = F.col(order_col).cast("string") if order_col else F.lit("")
    src = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(at, F.lit("")).alias("at"), texts.alias("texts"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for flat, lens, lo in _batch_terms(batch.column(2)):
                keep = np.flatnonzero(lens)
                ends = np.concatenate(([0], np.cumsum(lens[keep])))
                sids = [xxhash.xxh64_intdigest(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                take = pa.array(keep + lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.array(sids, np.uint64).view(np.int64)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat.view(np.int64)))], ["id", "at", "sid", "terms"]
                )

    return spread(src).mapInArrow(run, "id bigint, at string, sid bigint, terms array<bigint>")


def _flat(col: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All terms of a column, and how many each row has."""
    return col.flatten().to_numpy(zero_copy_only=False).view(np.uint64), col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _unseen(batch: pa.RecordBatch, seen: set[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """sids, terms and their numbers of the sets of a batch that its task hasn't seen, some at once."""
    sids = batch.column(0).to_numpy(zero_copy_only=False)
    flat, lens = _flat(batch.column(1))
    new = np.zeros(len(sids), bool)
    for i, sid in enumerate(sids.tolist()):
        if sid not in seen:
            seen.add(sid)
            new[i] = True
    if len(seen) > 300_000:
        seen.clear()
    flat, sids, lens = flat[np.repeat(new, lens)], sids[new], lens[new]
    ends = np.concatenate(([0], np.cumsum(lens)))
    for lo in range(0, len(sids), CHUNK_SETS):
        hi = min(len(sids), lo + CHUNK_SETS)
        yield sids[lo:hi], flat[ends[lo] : ends[hi]], lens[lo:hi]


def _extend(key: np.ndarray, term: np.ndarray) -> np.ndarray:
    h = (key ^ (term >> np.uint64(17))) * np.uint64(_MIX) + term
    return h ^ (h >> np.uint64(31))


def _least(x: np.ndarray) -> np.ndarray:
    return np.ceil(x - 1e-9).astype(np.int64)


class Keys:
    """The keys of sets: chains of their first terms, extended while too many records hold them."""

    def __init__(self, threshold: float, hot: int, levels: list[np.ndarray]):
        self.t, self.hot, self.levels = threshold, hot, levels
        self.mask = np.uint64(len(levels[0]) - 1)
        self.most = int(levels[0].max(initial=0))

    def reach(self, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """How many first terms hold the k first shared ones: for the smaller set of a pair, and for either."""
        small = n - _least(2 * self.t / (1 + self.t) * n) + k
        return np.minimum(n, small), np.minimum(n, n - _least(self.t * n) + k)

    def _counted(self, level: int, keys: np.ndarray) -> np.ndarray:
        return self.levels[level][(keys & self.mask).astype(np.int64)].astype(np.int64)

    def _ordered(self, terms: np.ndarray, lens: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms and counts of each set by count; the terms of a set come sorted."""
        row, first = np.repeat(np.arange(len(lens)), lens), np.cumsum(lens) - lens
        at = np.arange(len(terms)) - first[row]
        bits = [int(x).bit_length() for x in (len(lens), self.most, lens.max(initial=0))]
        if sum(bits) > 64:
            order = np.lexsort((at, freq, row))
        else:
            packed = np.sort((((row << bits[1]) | freq).astype(np.uint64) << np.uint64(bits[2])) | at.astype(np.uint64))
            order = first[row] + (packed & np.uint64((1 << bits[2]) - 1)).astype(np.int64)
        return terms[order], freq[order]

    def __call__(self, terms: np.ndarray, lens: np.ndarray, count_level: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys of sets (their terms one after the other), the number of the set of each, whether it lies within the reach of a smaller set, and its count at the last level (0 below it).

        With ``count_level`` r only the keys of level r that come from hot ones are given, to be counted.
        """
        sets = np.arange(len(lens))
        freq = self._counted(0, terms)
        if count_level:
            # only sets whose first terms reach a hot one go on
            cool = np.bincount(np.repeat(sets, lens)[freq <= self.hot], minlength=len(lens))
            some = cool < self.reach(lens, 1)[1]
            own = np.repeat(some, lens)
            terms, freq, lens, sets = terms[own], freq[own], lens[some], sets[some]
        ordered, freq = self._ordered(terms, lens, freq)
        last, first = len(self.levels), np.cumsum(lens) - lens
        small, far = self.reach(lens, 1)
        row = np.repeat(np.arange(len(lens)), far)
        at = np.arange(len(row)) - (np.cumsum(far) - far)[row]
        keys, cnt = ordered[first[row] + at], freq[first[row] + at]
        # a pair shares at least ``own`` terms; where a smaller partner can share too few for a longer chain, both keep this one
        own = _least(self.t * lens)
        shares = _least(self.t * own)
        out: list[tuple[np.ndarray, ...]] = []
        for r in range(1, last + 1):
            full = cnt > self.hot
            if r == last:
                out.append((keys, row, at < small[row], np.where(full, cnt, 0)))
                break
            keep = ~full | (shares[row] <= r)
            out.append((keys[keep], row[keep], at[keep] < small[row[keep]], np.where(full, cnt, 0)[keep]))
            go = full & (own[row] > r)
            keys, at, row = keys[go], at[go], row[go]
            small, far = self.reach(lens, r + 1)
            more = np.maximum(far[row] - 1 - at, 0)
            i = np.repeat(np.arange(len(keys)), more)
            at = at[i] + 1 + np.arange(len(i)) - (np.cumsum(more) - more)[i]
            row = row[i]
            keys = _extend(keys[i], ordered[first[row] + at])
            cnt = self._counted(r, keys)
        if count_level:
            out = [(keys, row, at < small[row], cnt)]
        # keys of one set stay together, so that its bits are packed well where rows are shuffled
        keys, row, near, cnt = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(row, kind="stable")
        return keys[order], sets[row[order]], near[order], cnt[order]


def counters(total: int, hot: int = HOT) -> tuple[int, int]:
    """How many counters for ``total`` terms, a power of two, and the count from which a term is hot."""
    n = 1 << max(16, math.ceil(math.log2(max(1, total * LOAD / hot))))
    n = min(n, MAX_COUNTERS)
    return n, max(hot, -(-total * LOAD // n))


_BLOCK = 1 << 14


def _counts(buckets: DataFrame, size: int) -> np.ndarray:
    """An array of ``size`` sums from (b, n) rows; it comes to the driver in packed blocks of bounded number."""

    def pack(pdf):
        import pandas as pd

        a = np.zeros(_BLOCK, np.uint32)
        a[pdf["b"].to_numpy(np.int64) % _BLOCK] = np.minimum(pdf["n"].to_numpy(np.int64), 0xFFFFFFFF)
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "sums": [a.tobytes()]})

    rows = buckets.groupBy("b").agg(F.sum("n").alias("n")).withColumn("block", F.shiftright("b", 14))
    out = np.zeros(size, np.uint32)
    for r in rows.groupBy("block").applyInPandas(pack, "block bigint, sums binary").collect():
        out[r["block"] * _BLOCK : (r["block"] + 1) * _BLOCK] = np.frombuffer(bytes(r["sums"]), np.uint32)
    return out


def _count_level(sets: DataFrame, level: int, t: float, hot: int, levels: list[np.ndarray]) -> np.ndarray:
    size = len(levels[0])
    held = sets.sparkSession.sparkContext.broadcast([*levels, np.zeros(size, np.uint32)])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Keys(t, hot, held.value)
        seen: set[int] = set()
        for batch in it:
            got = [np.empty(0, np.int64)]
            for _, terms, lens in _unseen(batch, seen):
                got.append((make(terms, lens, level)[0] & make.mask).astype(np.int64))
            b, n = np.unique(np.concatenate(got), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(n.astype(np.int64))], ["b", "n"])

    return _counts(sets.select("sid", "terms").mapInArrow(run, "b bigint, n bigint"), size)


def _folds(terms: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Each set as BITS bits: each term flips one, so sets that differ in d terms differ in at most d bits."""
    place = ((terms >> np.uint64(40)) & np.uint64(BITS - 1)).astype(np.int64) + BITS * np.repeat(np.arange(len(lens)), lens)
    odd = np.bincount(place, minlength=BITS * len(lens)).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(lens), BITS), axis=1, bitorder="little").view(np.int64)


def _fold(terms: np.ndarray) -> np.ndarray:
    return _folds(terms, np.array([len(terms)]))[0]


def _ring(diff: np.ndarray, budget: np.ndarray) -> np.ndarray:
    """Whether some chain round the ring stays within its share of the budget at every length; diff: (SEGMENTS, pairs)."""
    share = budget / SEGMENTS
    out = np.zeros(diff.shape[1], bool)
    twice = np.concatenate([diff, diff[:-1]])
    for start in range(SEGMENTS):
        live = np.flatnonzero(~out & (diff[start] <= share + 1e-4))
        total = diff[start, live].astype(np.float32)
        for k in range(1, SEGMENTS):
            total += twice[start + k, live]
            ok = total <= share[live] * (k + 1) + 1e-4
            live, total = live[ok], total[ok]
            if not len(live):
                break
        out[live] = True
    return out


def _budget(t: float, total: np.ndarray) -> np.ndarray:
    return np.floor((1 - t) / (1 + t) * total + 1e-9).astype(np.float32)


def _first_links(bits: np.ndarray, size: np.ndarray, small: np.ndarray, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions i < j of the pairs of one large group that may begin a chain, part by part; sorted by size, index keys first."""
    n = len(size)
    step = max(8, (1 << 16) // n)
    far = np.searchsorted(size, np.floor(size / t + 1e-9), "right")
    # no partner gives a set a larger share
    share = np.minimum(np.floor(_budget(t, size + size[far - 1]) / SEGMENTS + 1e-4), 255).astype(np.uint8)
    parts = np.ascontiguousarray(bits.T)
    for lo in range(0, n, step):
        rows = np.arange(lo, min(n, lo + step))
        rows = rows[small[rows]]
        if not len(rows):
            continue
        end = int(far[rows].max())
        # the first link of a chain: one segment within its share
        least = np.bitwise_count(parts[0, rows][:, None] ^ parts[0, None, lo:end])
        for s in range(1, SEGMENTS):
            np.minimum(least, np.bitwise_count(parts[s, rows][:, None] ^ parts[s, None, lo:end]), out=least)
        i, j = np.nonzero(least <= share[rows][:, None])
        i, j = rows[i], j + lo
        keep = (j > i) & (j < far[i])
        yield i[keep], j[keep]


def _grouped(key: np.ndarray, sid: np.ndarray, meta: np.ndarray) -> np.ndarray:
    """The order by sorted key, then meta, then sid, as far as bits are left for it: equal rows come together but for a rare few."""
    group = np.cumsum(np.concatenate(([False], key[1:] != key[:-1]))).astype(np.uint64)
    a, b, c = (int(x).bit_length() for x in (group[-1], meta.max(), len(key)))
    if a + b + c > 64:
        return np.lexsort((sid, meta, key))
    spare = 64 - a - b - c
    packed = (group << np.uint64(b)) | meta.astype(np.uint64)
    if spare:
        packed = (packed << np.uint64(spare)) | (sid.view(np.uint64) >> np.uint64(64 - spare))
    packed = np.sort((packed << np.uint64(c)) | np.arange(len(key), dtype=np.uint64))
    return (packed & np.uint64((1 << c) - 1)).astype(np.int64)


def _match(key: np.ndarray, sid: np.ndarray, meta: np.ndarray, bits: np.ndarray, t: float) -> np.ndarray:
    """The pairs (n, 2) of sids that whole groups of equal keys keep; meta: twice the size, odd for keys beyond the reach of a smaller set."""
    order = _grouped(key, sid, meta)
    key, sid, meta = key[order], sid[order], meta[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (sid[1:] != sid[:-1]) | (meta[1:] != meta[:-1])))
    order, key, sid, meta = order[new], key[new], sid[new], meta[new]
    cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    length = np.diff(np.append(cut, len(key)))
    size, small = meta >> 1, (meta & 1) == 0
    got = []

    def chains(i: np.ndarray, j: np.ndarray) -> None:
        for at in range(0, len(i), 500_000):
            a, b = i[at : at + 500_000], j[at : at + 500_000]
            ok = _ring(np.bitwise_count(bits[order[a]] ^ bits[order[b]]).T, _budget(t, size[a] + size[b]))
            got.append(np.stack([sid[a[ok]], sid[b[ok]]], 1))

    some = np.flatnonzero(np.repeat((length > 1) & (length <= SMALL_GROUP), length))
    for step in range(1, SMALL_GROUP):
        some = some[some + step < len(key)]
        some = some[key[some + step] == key[some]]
        if not len(some):
            break
        i = some[small[some] & (size[some + step] <= size[some] / t + 1e-9)]
        if len(i):
            chains(i, i + step)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n_held = 0
    for a, n in zip(cut[length > SMALL_GROUP], length[length > SMALL_GROUP]):
        own = slice(a, a + n)
        for i, j in _first_links(bits[order[own]], size[own], small[own], t):
            held.append((a + i, a + j))
            n_held += len(i)
            if n_held > 500_000:
                chains(*(np.concatenate(x) for x in zip(*held)))
                held, n_held = [], 0
    if held:
        chains(*(np.concatenate(x) for x in zip(*held)))
    if not got:
        return np.empty((0, 2), np.int64)
    both = np.concatenate(got)
    both = both[both[:, 0] != both[:, 1]]
    return np.unique(np.sort(both, 1), axis=0)


def keyed(sets: DataFrame, t: float = THRESHOLD, hot: int = HOT) -> DataFrame:
    """key, sid, meta, b0.. of every set and key: the rows whose groups meet; meta is twice the size, odd for keys beyond the reach of a smaller set."""
    spark = sets.sparkSession
    total = sets.agg(F.sum(F.size("terms"))).first()[0] or 0
    size, hot = counters(total, hot)
    first = sets.select(F.explode("terms").alias("x")).groupBy(F.col("x").bitwiseAND(size - 1).alias("b")).agg(F.count("*").alias("n"))
    levels = [_counts(first, size)]
    while len(levels) < DEPTH and levels[-1].max(initial=0) > hot:
        levels.append(_count_level(sets, len(levels) + 1, t, hot, levels))
    held = spark.sparkContext.broadcast(levels)

    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Keys(t, hot, held.value)
        seen: set[int] = set()  # copies of a set in one task are sent once
        for batch in it:
            for sids, terms, lens in _unseen(batch, seen):
                keys, row, small, cnt = make(terms, lens)
                blocks = -(-cnt // hot)
                if (blocks > 1).any():
                    # a group that stays large is cut into blocks, and every two blocks meet once
                    rep = np.maximum(blocks, 1)
                    idx = np.repeat(np.arange(len(keys)), rep)
                    other = np.arange(len(idx)) - (np.cumsum(rep) - rep)[idx]
                    keys, row, small, rep = keys[idx], row[idx], small[idx], rep[idx]
                    own = (sids[row].view(np.uint64) % rep.astype(np.uint64)).astype(np.int64)
                    cell = np.minimum(own, other) * 1_000_003 + np.maximum(own, other)
                    keys = np.where(rep > 1, _extend(keys, cell.astype(np.uint64) + np.uint64(1)), keys)
                bits = _folds(terms, lens)
                meta = (lens[row] * 2 + ~small).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(sids[row]), pa.array(meta), *(pa.array(bits[row, k]) for k in range(BITS // 64))], ["key", "sid", "meta", *names])

    names = [f"b{k}" for k in range(BITS // 64)]
    return sets.select("sid", "terms").mapInArrow(emit, "key bigint, sid bigint, meta int, " + ", ".join(f"{x} bigint" for x in names))


def candidates(sets: DataFrame, t: float = THRESHOLD, hot: int = HOT) -> DataFrame:
    """sid_a, sid_b (a < b): the pairs of different sets that the keys and chains keep, a superset of those within the threshold."""

    def match(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_rows: list[np.ndarray] | None = None
        for batch in it:
            if not batch.num_rows:
                continue
            part = [batch.column(k).to_numpy() for k in range(3 + BITS // 64)]
            if held_rows is not None:
                part = [np.concatenate(x) for x in zip(held_rows, part)]
            whole = int(np.searchsorted(part[0], part[0][-1], "left"))  # the last group may go on
            held_rows = [x[whole:] for x in part]
            if whole:
                yield out(part, whole)
        if held_rows is not None:
            yield out(held_rows, len(held_rows[0]))

    def out(part: list[np.ndarray], n: int) -> pa.RecordBatch:
        bits = np.ascontiguousarray(np.stack([x[:n] for x in part[3:]], 1)).view(np.uint32)
        both = _match(part[0][:n], part[1][:n], part[2][:n], bits, t)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))], ["sid_a", "sid_b"])

    return keyed(sets, t, hot).repartition("key").sortWithinPartitions("key").mapInArrow(match, "sid_a bigint, sid_b bigint").distinct()


def _settle_once(df: DataFrame, tag: str) -> DataFrame:
    """``settle`` for a frame that is of no use afterwards: its shuffle files go away with it, before the next ones are written."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return settle(df, tag)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def near_sets(sets: DataFrame, t: float = THRESHOLD, hot: int = HOT) -> DataFrame:
    """sid_a, sid_b, shared, total: every two different sets whose overlap is at least ``t``, after the full check."""
    cand = _settle_once(candidates(sets, t, hot), "candidates")
    need = cand.select(F.explode(F.array("sid_a", "sid_b")).alias("sid")).distinct()
    some = _settle_once(sets.select("sid", "terms").join(need, "sid", "left_semi").dropDuplicates(["sid"]), "sets")
    a, b = some.select(F.col("sid").alias("sid_a"), F.col("terms").alias("ta")), some.select(F.col("sid").alias("sid_b"), F.col("terms").alias("tb"))
    j = cand.join(a, "sid_a").join(b, "sid_b")
    # the full Hamming check: terms that only one of the two sets has
    j = j.withColumn("shared", F.size(F.array_intersect("ta", "tb"))).withColumn("total", F.size("ta") + F.size("tb") - F.col("shared"))
    out = _settle_once(j.where(F.col("shared") >= F.lit(t) * F.col("total") - 1e-9).select("sid_a", "sid_b", "shared", "total"), "near")
    discard(cand)
    discard(some)
    return out


def latest(sets: DataFrame) -> DataFrame:
    """id, sid: the set of each id, of several rows the latest (then the one with the greater hash)."""
    return sets.groupBy("id").agg(F.max(F.struct("at", "sid")).alias("m")).select("id", F.col("m.sid").alias("sid"))


def near_pairs(entries: DataFrame, id_col: str = "id", text_cols: tuple[str, ...] = ("standard_question", "similar_questions"), order_col: str | None = "updated_at", t: float = THRESHOLD, hot: int = HOT) -> DataFrame:
    """id_a, id_b (a < b): every two entries whose terms overlap by at least ``t``, exactly.

    Null and empty texts have no terms, and an entry without terms is in no pair;
    rows without an id are left out; of several rows of one id the latest counts
    (null before any time). Entries with equal terms are paired, too.
    """
    sets = settle(term_sets(entries, id_col, list(text_cols), order_col), "terms")
    links, who = near_sets(sets, t, hot), settle(latest(sets), "latest")
    discard(sets)
    # up to here equal texts are one node; the members of a set of very many are paired in parts
    cuts = who.groupBy("sid").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("cuts"), F.count("*").alias("n"))
    part = settle(who.join(cuts, "sid").select("id", "sid", "cuts", "n", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int").alias("part")), "members")
    discard(who)
    cuts = part.select("sid", "cuts", "n").distinct()
    loops = cuts.where("n > 1").select(F.col("sid").alias("sid_a"), F.col("sid").alias("sid_b"))
    both = links.select("sid_a", "sid_b").unionByName(loops)
    both = _in_parts(_in_parts(both, cuts, "a"), cuts, "b")
    a, b = (part.select(F.col("id").alias(x), F.col("sid").alias(f"sid_{x}"), F.col("part").alias(f"part_{x}")) for x in "ab")
    near = both.join(a, ["sid_a", "part_a"]).join(b, ["sid_b", "part_b"]).where((F.col("sid_a") != F.col("sid_b")) | (F.col("a") < F.col("b")))
    return near.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))


def _in_parts(pairs: DataFrame, cuts: DataFrame, side: str) -> DataFrame:
    """``pairs`` of sets with a row for each part of the members of one side."""
    c = cuts.select(F.col("sid").alias(f"sid_{side}"), "cuts")
    return pairs.join(c, f"sid_{side}").withColumn(f"part_{side}", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).drop("cuts")


def near_groups(entries: DataFrame, id_col: str = "id", text_cols: tuple[str, ...] = ("standard_question", "similar_questions"), order_col: str | None = "updated_at", t: float = THRESHOLD, hot: int = HOT) -> DataFrame:
    """id, group_id, n_links: each entry with the least id of its group and its number of links to different texts.

    Groups are connected by links of at least ``t``; equal texts are one node, so
    copies are never paired. An entry alone is its own group; one without terms,
    too. Nulls and repeated rows as in ``near_pairs``.
    """
    from quern.operators.components import components

    sets = settle(term_sets(entries, id_col, list(text_cols), order_col), "terms")
    who = settle(latest(sets), "latest")
    live = who.select("sid").distinct()
    links = near_sets(sets, t, hot).select("sid_a", "sid_b").join(live.withColumnRenamed("sid", "sid_a"), "sid_a", "left_semi").join(live.withColumnRenamed("sid", "sid_b"), "sid_b", "left_semi")
    links = settle(links, "links")
    discard(sets)
    part = components(links.select(F.col("sid_a").alias("src"), F.col("sid_b").alias("dst"))).select(F.col("node").alias("sid"), "component")
    n = links.select(F.explode(F.array("sid_a", "sid_b")).alias("sid")).groupBy("sid").agg(F.count("*").alias("n_links"))
    j = settle(who.join(part, "sid", "left").join(n, "sid", "left").select("id", F.coalesce("component", "sid").alias("c"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "grouped")
    least = j.groupBy("c").agg(F.min("id").alias("group_id"))
    ids = entries.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id")).distinct()
    return ids.join(j.join(least, "c").drop("c"), "id", "left").select("id", F.coalesce("group_id", "id").alias("group_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
