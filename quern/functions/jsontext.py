"""JSON as models write it: repaired, found in fences, cast to a schema, written in one canonical form.

Rows go through Arrow batches to Python where no built-in can say it; parsing
what was repaired is left to ``from_json``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import re
import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_FENCE = re.compile(r"```[ \t]*(?:json)?[ \t]*\r?\n?(.*?)```", re.S | re.I)
_VALID_AFTER_BACKSLASH = frozenset('"\\/bfnrtu')


def unfenced(text: str) -> str:
    """What stands in the first code fence, else from the first brace or bracket on, else the trimmed text."""
    m = _FENCE.search(text)
    if m:
        return m[1].strip()
    at = min((i for i in (text.find("{"), text.find("[")) if i >= 0), default=-1)
    return text[at:].strip() if at >= 0 else text.strip()


def repaired(text: str) -> str | None:
    """Valid JSON from a broken one, or null: fences and trailing commas go, wrong escapes are doubled, raw line ends in strings escaped, open strings and brackets closed, and what follows the value is dropped."""
    s = unfenced(text)
    try:
        json.loads(s)
        return s
    except ValueError:
        pass
    out: list[str] = []
    stack: list[str] = []
    inside = False
    i = 0
    while i < len(s):
        c = s[i]
        if inside:
            if c == "\\":
                nxt = s[i + 1] if i + 1 < len(s) else ""
                good = nxt in _VALID_AFTER_BACKSLASH and (nxt != "u" or re.fullmatch(r"[0-9a-fA-F]{4}", s[i + 2 : i + 6])) if nxt else False
                out.append(c + nxt if good else "\\\\")
                i += 2 if good else 1
                continue
            if c == '"':
                inside = False
            out.append({"\n": "\\n", "\r": "\\r", "\t": "\\t"}.get(c, c))
        elif c == '"':
            inside = True
            out.append(c)
        elif c in "{[":
            stack.append("}" if c == "{" else "]")
            out.append(c)
        elif c in "}]":
            while stack and stack[-1] != c:
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
            out.append(c)
            if not stack:
                break
        else:
            out.append(c)
        i += 1
    if inside:
        out.append('"')
    fixed = "".join(out).rstrip()
    fixed = re.sub(r"[,:]\s*$", lambda m: ": null" if m[0][0] == ":" else "", fixed) + "".join(reversed(stack))
    fixed = _without_trailing_commas(fixed)
    try:
        json.loads(fixed)
        return fixed
    except ValueError:
        return None


def _without_trailing_commas(s: str) -> str:
    out, inside, i = [], False, 0
    while i < len(s):
        c = s[i]
        if inside:
            out.append(s[i : i + 2] if c == "\\" else c)
            i += 2 if c == "\\" else 1
            inside = c != '"'
            continue
        if c == '"':
            inside = True
        if c == "," and re.match(r"\s*[}\]]", s[i + 1 :]):
            i += 1
            continue
        out.append(c)
        i += 1
    return "".join(out)


def set_path(text: str, path: Sequence[str], value) -> str:
    """The object with a value at a path; what stands in the way and is no object is replaced."""
    try:
        root = json.loads(text)
    except (TypeError, ValueError):
        root = {}
    if not isinstance(root, dict):
        root = {}
    at = root
    for p in path[:-1]:
        if not isinstance(at.get(p), dict):
            at[p] = {}
        at = at[p]
    at[path[-1]] = value
    return json.dumps(root, ensure_ascii=False, separators=(",", ":"))


def canonical(value) -> str:
    """One text for one value: NFC strings, whole numbers up to 2^53 - 1, decimals without trailing zeros as strings, UTC times, sets sorted and without repeats, keys in the order of UTF-16; floats are an error."""
    if value is None or isinstance(value, bool):
        return {None: "null", True: "true", False: "false"}[value]
    if isinstance(value, str):
        if unicodedata.normalize("NFC", value) != value:
            raise ValueError("text is not in composed form")
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, int):
        if abs(value) > 2**53 - 1:
            raise ValueError("whole number out of range")
        return str(value)
    if isinstance(value, float):
        raise ValueError("floats have no canonical form")
    if isinstance(value, decimal.Decimal):
        n = value.normalize()
        return json.dumps("0" if n == 0 else format(n, "f"))
    if isinstance(value, dt.datetime):
        if value.tzinfo is None:
            raise ValueError("a time needs a zone")
        u = value.astimezone(dt.timezone.utc)
        return json.dumps(u.strftime("%Y-%m-%dT%H:%M:%S") + (f".{u.microsecond:06d}".rstrip("0") if u.microsecond else "") + "Z")
    if isinstance(value, (set, frozenset)):
        return "[" + ",".join(sorted({canonical(v) for v in value}, key=lambda x: x.encode())) + "]"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in sorted(value, key=lambda k: k.encode("utf-16-be"))) + "}"
    raise ValueError(f"no canonical form for {type(value).__name__}")


def _cast(value, schema: dict):
    kind = schema.get("type")
    if kind == "boolean" and isinstance(value, str):
        return {"true": True, "1": True, "yes": True, "false": False, "0": False, "no": False}.get(value.strip().lower(), value)
    if kind == "boolean" and isinstance(value, (int, float)) and not isinstance(value, bool):
        return bool(value)
    if kind in ("integer", "number") and isinstance(value, str):
        try:
            value = float(value) if "." in value or "e" in value.lower() or kind == "number" else int(value)
        except ValueError:
            return value
    if kind == "integer" and isinstance(value, float) and value.is_integer():
        return int(value)
    if kind == "string" and isinstance(value, (int, float)) and not isinstance(value, bool):
        return str(value)
    if kind == "array" and not isinstance(value, list):
        if isinstance(value, str) and value.strip().startswith("["):
            try:
                value = json.loads(value)
            except ValueError:
                pass
        value = value if isinstance(value, list) else [value]
    if kind == "array" and isinstance(value, list) and "items" in schema:
        return [_cast(v, schema["items"]) for v in value]
    if kind == "object" and isinstance(value, dict):
        return cast_params(value, schema)
    return value


def cast_params(args: dict, schema: dict) -> dict:
    """Arguments cast to the types of a JSON schema where that is safe: "yes" to true, 3.0 to 3, JSON texts and single values to arrays."""
    props = schema.get("properties", {})
    return {k: _cast(v, props[k]) if k in props and v is not None else v for k, v in args.items()}


_KINDS: dict[str, Callable] = {
    "string": lambda v: isinstance(v, str), "boolean": lambda v: isinstance(v, bool), "integer": lambda v: isinstance(v, int) and not isinstance(v, bool), "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "array": lambda v: isinstance(v, list), "object": lambda v: isinstance(v, dict),
}


def violations(args: dict, schema: dict, at: str = "") -> list[str]:
    """What is wrong with arguments under a JSON schema: missing ones, types, enumerations and ranges."""
    out = [f"{at}{k}: missing" for k in schema.get("required", ()) if args.get(k) is None]
    for k, v in args.items():
        s = schema.get("properties", {}).get(k)
        if s is None or v is None:
            continue
        if s.get("type") in _KINDS and not _KINDS[s["type"]](v):
            out.append(f"{at}{k}: not of type {s['type']}")
            continue
        if "enum" in s and v not in s["enum"]:
            out.append(f"{at}{k}: not one of the listed values")
        if _KINDS["number"](v) and (v < s.get("minimum", v) or v > s.get("maximum", v)):
            out.append(f"{at}{k}: out of range")
        if isinstance(v, dict):
            out += violations(v, s, f"{at}{k}.")
        if isinstance(v, list) and "items" in s:
            for i, x in enumerate(v):
                out += violations({str(i): x}, {"properties": {str(i): s["items"]}}, f"{at}{k}.")
    return out


def repair(c: Column) -> Column:
    """``repaired`` of each text."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else repaired(x) for x in s], dtype=object)

    return run(c)


def response(c: Column, schema: str) -> Column:
    """The struct that a model's answer holds, fenced or raw; null if there is none."""
    return F.from_json(repair(c), schema)


def with_path(c: Column, path: Sequence[str], value: Column) -> Column:
    """``set_path`` with a JSON value of each row."""

    @F.pandas_udf("string")
    def run(s: pd.Series, v: pd.Series) -> pd.Series:
        return pd.Series([set_path(a, path, None if b is None else json.loads(b)) for a, b in zip(s, v)], dtype=object)

    return run(c, value)


# The names under which models give the parts of a rewritten question.
REWRITE_NAMES = {"query": ("rewrite_query", "rewritten_query", "query", "question"), "intent": ("intent", "intent_type", "type"), "keywords": ("keywords", "key_words", "terms")}


def rewrite_output(c: Column) -> Column:
    """query, intent and keywords of a rewritten question, whichever of their names the answer uses; query null if there is no JSON."""
    fixed = repair(c)
    one = lambda names: F.coalesce(*(F.get_json_object(fixed, f"$.{n}") for n in names))
    return F.struct(one(REWRITE_NAMES["query"]).alias("query"), one(REWRITE_NAMES["intent"]).alias("intent"), F.from_json(one(REWRITE_NAMES["keywords"]), "array<string>").alias("keywords"))
