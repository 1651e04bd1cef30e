"""What is read out of texts and answers: graphs, options, anchors, and how fit a text is to be read at all."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.jsontext import repaired
from quern.functions.markup import tolerant_pattern


def graph_of(answer: str, types: Sequence[str] = ()) -> tuple[list[dict], list[dict]]:
    """(nodes, relations) of a model's JSON: a node's first mention holds, relations without ends, onto themselves or of unknown types go, ends that are no nodes become nodes."""
    fixed = repaired(answer)
    data = json.loads(fixed) if fixed else {}
    data = {"nodes": data} if isinstance(data, list) else data
    nodes: dict[str, dict] = {}
    for n in data.get("nodes") or data.get("entities") or ():
        name = str(n.get("name") or "").strip() if isinstance(n, dict) else ""
        if name and name not in nodes:
            nodes[name] = {"name": name, "attributes": [str(a) for a in n.get("attributes") or ()]}
    out = []
    for r in data.get("relations") or data.get("edges") or ():
        a, b, kind = (str(r.get(k) or "").strip() for k in ("source", "target", "type"))
        if a and b and a != b and (not types or kind in types):
            out.append({"source": a, "target": b, "type": kind})
            for x in (a, b):
                nodes.setdefault(x, {"name": x, "attributes": []})
    return list(nodes.values()), out


def parsed_graphs(df: DataFrame, key: str, answer: str, types: Sequence[str] = ()) -> DataFrame:
    """key, nodes, relations of each answer."""
    kind = df.schema[key].dataType.simpleString()

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            got = [graph_of(a, types) if a else ([], []) for a in pdf[answer]]
            yield pd.DataFrame({key: pdf[key], "nodes": [g[0] for g in got], "relations": [g[1] for g in got]})

    return df.select(key, answer).mapInPandas(run, f"`{key}` {kind}, nodes array<struct<name:string,attributes:array<string>>>, relations array<struct<source:string,target:string,type:string>>")


def dense_in(text: Column, keywords: Sequence[str], least: int = 4, per_chars: int = 400, distinct: int = 3) -> Column:
    """Whether a text is dense in keywords: as many hits as one in ``per_chars`` characters and ``least``, of ``distinct`` different ones."""
    low = F.lower(text)
    hits = [F.regexp_count(low, F.lit(r"\Q" + k.lower() + r"\E")) for k in keywords]
    total = sum(hits[1:], hits[0])
    kinds = sum(((h > 0).cast("int") for h in hits[1:]), (hits[0] > 0).cast("int"))
    return (total >= F.greatest(F.lit(least), F.floor(F.length(text) / per_chars))) & (kinds >= distinct)


def feedability(text: Column, most: int = 200_000) -> dict[str, Column]:
    """Checks of a text and ``score``, the share that holds: it isn't empty, garbled (replacement and control signs beyond one percent), oversized or cut off, and has headings."""
    n = F.length(F.regexp_replace(text, r"\s", ""))
    bad = F.length(text) - F.length(F.regexp_replace(text, r"[\x{FFFD}\x{0000}-\x{0008}\x{000E}-\x{001F}]", ""))
    checks = {
        "not_empty": n > 0, "not_garbled": bad <= 0.01 * F.length(text), "not_oversized": F.length(text) <= most, "not_cut_off": F.trim(text).rlike(r"[.!?。！？|:：)）\]»”\"']\s*$"), "has_headings": text.rlike(r"(?m)^#{1,6} "),
    }
    checks = {k: F.coalesce(c, F.lit(False)) for k, c in checks.items()}
    return {**checks, "score": sum((c.cast("int") for c in checks.values()), F.lit(0)) / len(checks)}


def options(guidance: str | None) -> tuple[str, list[str]]:
    """(kind, options) of a guidance: ``single`` or ``multi`` for ``one of: a / b`` and ``any of: a / b``, else ``free``."""
    m = re.match(r"\s*(?:(one of|单选|einer von|une parmi|uno de)|(any of|多选|beliebige|plusieurs parmi|varios de))\s*[:：]\s*(.+)", guidance or "", re.I)
    if not m:
        return "free", []
    got = [x.strip() for x in re.split(r"[/、,，;；|]", m[3]) if x.strip()]
    return ("single" if m[1] else "multi"), got


def constrained(value: Column, guidance: str | None, synonyms: Mapping[str, str] | None = None) -> Column:
    """The options that a value names (single: exactly one, else null), free values as they are; synonyms are put in place first."""
    kind, some = options(guidance)
    if kind == "free":
        return F.trim(value)
    v = F.trim(value)
    for a, b in (synonyms or {}).items():
        v = F.replace(v, F.lit(a), F.lit(b))
    parts = F.transform(F.split(v, r"[/、,，;；|]"), lambda x: F.lower(F.trim(x)))
    hit = F.array_compact(F.array(*(F.when(F.array_contains(parts, F.lit(o.lower())), F.lit(o)) for o in some)))
    return F.when(F.size(hit) == 1, F.element_at(hit, 1)) if kind == "single" else F.when(F.size(hit) > 0, F.array_join(hit, "/"))


def induced(examples: Sequence[tuple[str, str]], least: int = 2, shortest: int = 3) -> str | None:
    """A pattern with one group that recovers the value from the text of every example by what stands before it in its line; None if there is none or too few examples."""
    if len(examples) < least:
        return None
    before = []
    for text, value in examples:
        at = text.find(value) if value else -1
        if at < 0:
            return None
        before.append(text[text.rfind("\n", 0, at) + 1 : at][-40:])
    common = os.path.commonprefix([b[::-1] for b in before])[::-1].lstrip()
    if len(common.strip()) < shortest:
        return None
    for tail in (r"([^\n]*\S)", r"([^\n]*?)\s*[.;。；]", r"(\S+)"):
        rx = tolerant_pattern(common) + r"\s*" + tail
        if all((m := re.search(rx, text)) and m[1] == value for text, value in examples):
            return rx
    return None


def by_anchor(text: Column, pattern: str) -> Column:
    """What an induced pattern finds in a text; null if nothing."""
    got = F.regexp_extract(text, pattern, 1)
    return F.when(got != "", got)


def curated_or_raw(curated: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """All curated rows, and raw rows only for keys without any curated one; ``curated`` tells which."""
    return curated.withColumn("curated", F.lit(True)).unionByName(raw.join(curated.select(key), key, "left_anti").withColumn("curated", F.lit(False)))


def aligned(hits: DataFrame, traces: DataFrame, key: str, entity: str) -> DataFrame:
    """key, entity, reason of traces by the entities named in them: one is ``aligned``, several ``multi_entity_ambiguity``, none ``no_actionable_match``."""
    g = hits.select(key, entity).distinct().groupBy(key).agg(F.count("*").alias("_n"), F.min(entity).alias("_e"))
    j = traces.select(key).distinct().join(g, key, "left")
    return j.select(key, F.when(F.col("_n") == 1, F.col("_e")).alias(entity), F.when(F.col("_n") == 1, "aligned").when(F.col("_n") > 1, "multi_entity_ambiguity").otherwise("no_actionable_match").alias("reason"))


def report(df: DataFrame, most: int = 100) -> tuple[list[dict], str]:
    """(rows, text) of a result of at most ``most`` rows, as a tool hands it on: bytes as text, one line a row, and how many were left out at least."""
    got = df.limit(most + 1).collect()
    rows = [{k: v.decode("utf-8", "replace") if isinstance(v, (bytes, bytearray)) else v for k, v in r.asDict(recursive=True).items()} for r in got[:most]]
    lines = [f"{len(rows)} rows" + (", more left out" if len(got) > most else "")] + [f"{i}. " + ", ".join(f"{k}={v}" for k, v in r.items()) for i, r in enumerate(rows, 1)]
    return rows, "\n".join(lines)
