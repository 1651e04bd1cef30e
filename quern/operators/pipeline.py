"""Tools, stages and transforms registered by name, and how they are put together."""

from __future__ import annotations

import json
import subprocess
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.jsontext import cast_params, violations

Stage = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Tool:
    """A named function with a JSON schema of its parameters."""

    name: str
    description: str
    parameters: Mapping
    run: Callable[..., object]


class Tools:
    """Tools by name: arguments are cast and checked before a tool runs, its output is cut in the middle."""

    def __init__(self, most: int = 16_000):
        self.tools: dict[str, Tool] = {}
        self.most = most

    def add(self, tool: Tool) -> None:
        if tool.name in self.tools:
            raise ValueError(f"tool {tool.name} is there already")
        self.tools[tool.name] = tool

    def describe(self) -> list[dict]:
        return [{"name": t.name, "description": t.description, "parameters": dict(t.parameters)} for _, t in sorted(self.tools.items())]

    def call(self, name: str, arguments: str | dict) -> str:
        """The output as text; unknown tools and wrong arguments give a text that begins with ``error:``."""
        tool = self.tools.get(name)
        if tool is None:
            return f"error: no tool {name}"
        try:
            args = json.loads(arguments) if isinstance(arguments, str) else dict(arguments)
        except ValueError:
            return "error: the arguments are no JSON"
        args = cast_params(args, tool.parameters)
        if wrong := violations(args, tool.parameters):
            return "error: " + "; ".join(wrong)
        got = tool.run(**args)
        out = got if isinstance(got, str) else json.dumps(got, ensure_ascii=False, default=str)
        return out if len(out) <= self.most else f"{out[: self.most // 2]}\n… {len(out) - self.most} characters left out …\n{out[len(out) - self.most // 2 :]}"


@dataclass
class Pipeline:
    """Stages in order, each a function from frame to frame; some only if a condition holds."""

    stages: list[tuple[str, Stage]] = field(default_factory=list)

    def add(self, name: str, stage: Stage) -> Pipeline:
        return Pipeline([*self.stages, (name, stage)])

    def add_if(self, condition: bool, name: str, stage: Stage) -> Pipeline:
        return self.add(name, stage) if condition else self

    def names(self) -> list[str]:
        return [n for n, _ in self.stages]

    def run(self, df: DataFrame) -> DataFrame:
        return reduce(lambda d, s: d.transform(s[1]), self.stages, df)


class Plugins:
    """Plugins that declare which events they act on; each gets the state and what comes next, and may leave it out."""

    def __init__(self):
        self.by_event: dict[str, list[Callable]] = {}

    def register(self, plugin: Callable, events: Sequence[str]) -> None:
        for e in events:
            self.by_event.setdefault(e, []).append(plugin)

    def trigger(self, event: str, state):
        def step(i: int):
            chain = self.by_event.get(event, [])
            return (lambda s: chain[i](s, step(i + 1))) if i < len(chain) else (lambda s: s)

        return step(0)(state)


class Transforms:
    """Transforms of values by name and version; a new version never replaces an old one."""

    def __init__(self):
        self.of: dict[tuple[str, int], Callable] = {("identity", 1): lambda c: c}

    def add(self, name: str, version: int, f: Callable) -> None:
        if (name, version) in self.of:
            raise ValueError(f"{name} {version} is there already")
        self.of[name, version] = f

    def get(self, name: str, version: int | None = None) -> Callable:
        have = sorted(v for n, v in self.of if n == name)
        if not have or version is not None and version not in have:
            raise KeyError(f"{name} {version}")
        return self.of[name, have[-1] if version is None else version]


def mapping_proposal(keys: DataFrame, fields: DataFrame, key: str, field_id: str, names: str) -> DataFrame:
    """key, field_id, score, ambiguous: for each key of a record the field with an equal name (0.9) or one that holds it or is held by it (0.6); ties are ambiguous.

    Equal names meet by a join on the name, the rest by the names' words.
    """
    norm = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"[\s_\-]+", "")
    k = keys.select(key).distinct().withColumn("_k", norm(F.col(key))).where("_k <> ''")
    n = fields.select(field_id, F.explode(names).alias("_raw")).select(field_id, "_raw", norm(F.col("_raw")).alias("_n")).where("_n <> ''").distinct()
    exact = k.join(n, F.col("_k") == F.col("_n")).select(key, field_id, F.lit(0.9).alias("score"))
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[\s_\-]+"), lambda x: x != ""))
    kw, nw = k.select(key, "_k", F.explode(words(F.col(key))).alias("w")), n.select(field_id, "_n", F.explode(words(F.col("_raw"))).alias("w"))
    part = kw.join(nw, "w").where(F.contains("_k", F.col("_n")) | F.contains("_n", F.col("_k"))).select(key, field_id, F.lit(0.6).alias("score"))
    best = exact.unionByName(part).groupBy(key, field_id).agg(F.max("score").alias("score"))
    top = best.groupBy(key).agg(F.max("score").alias("score"))
    hit = best.join(top, [key, "score"]).groupBy(key, "score").agg(F.min(field_id).alias(field_id), F.count("*").alias("_c"))
    return hit.select(key, field_id, "score", (F.col("_c") > 1).alias("ambiguous"))


def parallel_map(df: DataFrame, column: str, f: Callable[[list], list], schema: str, batch: int = 64) -> DataFrame:
    """``df`` with ``result``: a function of whole batches of one column, run where the rows lie."""
    names = df.columns
    head = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out: list = []
            values = pdf[column].tolist()
            for i in range(0, len(values), batch):
                got = f(values[i : i + batch])
                if len(got) != len(values[i : i + batch]):
                    raise ValueError("a result for each value is needed")
                out += got
            yield pdf[names].assign(result=out)

    return df.mapInPandas(run, f"{head}, result {schema}")


def run_script(df: DataFrame, column: str, command: Sequence[str], seconds: float = 10.0, most_bytes: int = 1_000_000) -> DataFrame:
    """``df`` with ``output`` and ``error``: a named script run once a row, JSON in, JSON out.

    Scripts run without a shell and without the environment of the job, within a
    time and an output size; what goes wrong is in ``error``.
    """
    names = df.columns
    head = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema)

    def one(text: str | None) -> tuple[str | None, str | None]:
        try:
            p = subprocess.run(list(command), input=(text or "null").encode(), capture_output=True, timeout=seconds, env={"PATH": "/usr/bin:/bin"}, check=False)
        except subprocess.TimeoutExpired:
            return None, "timed out"
        except OSError as e:
            return None, str(e)
        if p.returncode:
            return None, p.stderr.decode("utf-8", "replace")[-500:] or f"exit {p.returncode}"
        if len(p.stdout) > most_bytes:
            return None, "too much output"
        try:
            return json.dumps(json.loads(p.stdout), ensure_ascii=False), None
        except ValueError:
            return None, "output is no JSON"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            got = [one(x) for x in pdf[column]]
            yield pdf[names].assign(output=[g[0] for g in got], error=[g[1] for g in got])

    return df.mapInPandas(run, f"{head}, output string, error string")
