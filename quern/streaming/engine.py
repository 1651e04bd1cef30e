"""Structured Streaming: windows, joins, per-key state, and running a stream to its end."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.runtime import _hadoop, shared_dir


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The Parquet files of ``path`` as a stream, with ``ts`` as an instant (streams have no zoneless time)."""
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    fs, p = _hadoop(spark, path)
    if fs.getFileStatus(p).isFile():  # a stream reads folders
        folder, _, name = path.rpartition("/")
        s = r.option("pathGlobFilter", name).parquet(folder)
    else:
        s = r.parquet(path)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(s: DataFrame, ts: str, size: str, keys: Sequence[str], *aggs, late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Aggregates of each window of event time, tumbling or (with ``slide``) sliding; rows later than ``late`` are dropped."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    g = s.withWatermark(ts, late).groupBy(w, *keys).agg(*aggs)
    return g.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *(c for c in g.columns if c != "window"))


def session_windows(s: DataFrame, ts: str, gap: str, keys: Sequence[str], *aggs, late: str = "1 hour") -> DataFrame:
    g = s.withWatermark(ts, late).groupBy(F.session_window(ts, gap), *keys).agg(*aggs)
    return g.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *(c for c in g.columns if c != "session_window"))


def interval_join(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str, before: str, late: str = "1 hour") -> DataFrame:
    """Rows of two streams with equal keys where the right one comes within ``before`` before the left one."""
    a, b = left.withWatermark(lts, late), right.withWatermark(rts, late)
    cond = (a[key] == b[f"r_{key}"]) & (b[rts] <= a[lts]) & (b[rts] >= a[lts] - F.expr(f"INTERVAL {before}"))
    return a.join(b, cond)


def without_repeats(s: DataFrame, ts: str, keys: Sequence[str], late: str = "1 hour") -> DataFrame:
    """The first row of each key within the lateness."""
    return s.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def gap_state(s: DataFrame, key: str, ts: str, id_col: str, signal: str, samples: int = 5) -> DataFrame:
    """key, hits, last_ids, signals, status after each batch: state kept over batches of a stream.

    status is ``open``, ``resolved`` after a row whose signal is ``resolved``, and
    ``reopened`` after any further one. Rows of a batch are taken in order of (ts, id).
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        hits, ids, signals, status = state.get if state.exists else (0, [], [], "open")
        ids, seen = list(ids), set(signals)
        rows = pd.concat(list(batches)).sort_values([ts, id_col])
        for i, sig in zip(rows[id_col], rows[signal]):
            hits += 1
            ids = [int(i), *ids][:samples]
            seen.add(sig)
            status = "resolved" if sig == "resolved" else "reopened" if status in ("resolved", "reopened") else "open"
        state.update((hits, ids, sorted(x for x in seen if x is not None), status))
        yield pd.DataFrame({"key": [str(k[0])], "hits": [hits], "last_ids": [ids], "signals": [sorted(x for x in seen if x is not None)], "status": [status]})

    return s.where(F.col(key).isNotNull()).groupBy(key).applyInPandasWithState(step, "key string, hits long, last_ids array<long>, signals array<string>, status string", "hits long, last_ids array<long>, signals array<string>, status string", "update", "NoTimeout")


def run(s: DataFrame, keys: Sequence[str], mode: str = "update") -> DataFrame:
    """The stream run over what is there now; of updated rows the last of each key.

    Every batch is written under its own number, so a batch that is run again
    after a failure replaces itself.
    """
    spark = s.sparkSession
    base = f"{shared_dir(spark)}/quern/stream-{uuid.uuid4().hex}"

    def sink(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    q = s.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(sink).start()
    q.awaitTermination()
    got = spark.read.option("basePath", f"{base}/out").parquet(f"{base}/out/*").drop("batch")
    if not keys:
        return got.drop("_batch")
    w = Window.partitionBy(*keys).orderBy(F.desc("_batch"))
    return got.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_batch")


class TagSplitter:
    """Splits streamed text into thought and answer, holding back what may be part of a tag."""

    def __init__(self, begin: str = "<think>", end: str = "</think>"):
        self.tags, self.inside, self.held = (begin, end), False, ""

    def feed(self, piece: str) -> list[tuple[str, str]]:
        """(kind, text) of what is settled; kind is ``think`` or ``answer``."""
        self.held += piece
        out = []
        while self.held:
            tag = self.tags[self.inside]
            at = self.held.find(tag)
            if at >= 0:
                if at:
                    out.append(("think" if self.inside else "answer", self.held[:at]))
                self.held, self.inside = self.held[at + len(tag) :], not self.inside
                continue
            keep = next((n for n in range(min(len(tag) - 1, len(self.held)), 0, -1) if tag.startswith(self.held[-n:])), 0)
            if len(self.held) > keep:
                out.append(("think" if self.inside else "answer", self.held[: len(self.held) - keep]))
                self.held = self.held[len(self.held) - keep :]
            break
        return out

    def close(self) -> list[tuple[str, str]]:
        out = [("think" if self.inside else "answer", self.held)] if self.held else []
        self.held = ""
        return out
