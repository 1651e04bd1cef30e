"""Models behind functions: registered by name, with offline defaults that always give the same."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T

Embed = Callable[[list[str]], list[list[float]]]
Rerank = Callable[[str, list[str]], list[float]]


def hashed_embedding(texts: Sequence[str], dim: int = 64) -> list[list[float]]:
    """Words hashed to signed places, scaled to length 1."""
    out = []
    for t in texts:
        v = [0.0] * dim
        for w in (t or "").lower().split():
            h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
            v[h % dim] += 1.0 if h >> 63 else -1.0
        n = math.sqrt(sum(x * x for x in v))
        out.append([x / n for x in v] if n else v)
    return out


def overlap_rerank(query: str, passages: Sequence[str]) -> list[float]:
    """Share of the query's words that a passage holds."""
    q = set(query.lower().split())
    return [len(q & set((p or "").lower().split())) / len(q) if q else 0.0 for p in passages]


EMBEDDERS: dict[str, Embed] = {"hashed": hashed_embedding}
RERANKERS: dict[str, Rerank] = {"overlap": overlap_rerank}


def embed(c: Column, model: str = "hashed", batch: int = 64) -> Column:
    """The embedding of each text, in batches; an error of the model ends the job."""
    f = EMBEDDERS[model]

    @F.pandas_udf("array<float>")
    def run(s: pd.Series) -> pd.Series:
        texts, out = s.fillna("").tolist(), []
        for i in range(0, len(texts), batch):
            out += f(texts[i : i + batch])
        return pd.Series(out)

    return run(c)


def rerank(df: DataFrame, query: str = "query", passage: str = "passage", model: str = "overlap") -> DataFrame:
    """``df`` with ``model_score``; passages are cleaned for the model first."""
    f = RERANKERS[model]

    @F.pandas_udf("double")
    def run(q: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series([f(a or "", [b or ""])[0] for a, b in zip(q, p)], dtype=float)

    return df.withColumn("model_score", run(F.col(query), T.clean_passage(F.col(passage))))
