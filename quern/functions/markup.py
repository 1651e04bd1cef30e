"""Images, phrases, slugs and other marks in texts, as column expressions."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions import text as T


def phrases(c: Column) -> Column:
    """Texts in quotation marks of more than two bytes, in order, each once."""
    found = F.regexp_extract_all(c, F.lit(r'["“”「『]([^"“”「」『』\n]+)["“”」』]'), 1)
    return F.array_distinct(F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: F.octet_length(x) > 2))


def segments(c: Column) -> Column:
    """Parts between punctuation marks of more than five bytes, in order, each once; a text without marks has none."""
    parts = F.transform(F.split(c, r"[,，;；、。！？!?\s]+"), lambda x: F.trim(x))
    return F.when(F.size(parts) > 1, F.array_distinct(F.filter(parts, lambda x: F.octet_length(x) > 5))).otherwise(F.array().cast("array<string>"))


def expansions(c: Column, most: int = 5) -> Column:
    """Up to ``most`` variants of a question to search by: its words without stop words, its phrases, its segments, the text without question words; none shorter than three bytes, none the question itself, each once whatever the case."""
    bare = F.trim(F.regexp_replace(c, r"(?i)^(what is|what are|how do i|how to|how|why|when|where|who|什么是|如何|怎么|为什么|请问)\s*|[?？]+$", ""))
    some = F.concat(F.array(F.array_join(T.query_terms(c), " ")), phrases(c), segments(c), F.array(bare))
    some = F.filter(some, lambda x: (F.octet_length(x) >= 3) & (F.lower(x) != F.lower(F.trim(c))))
    first = F.aggregate(some, F.array().cast("array<string>"), lambda s, x: F.when(F.exists(s, lambda y: F.lower(y) == F.lower(x)), s).otherwise(F.concat(s, F.array(x))))
    return F.slice(first, 1, most)


def slug_or_null(c: Column) -> Column:
    """The slug of a page, or null for one with other characters than a-z, 0-9, hyphens, slashes and Han, or with slashes at an end or in a row."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"\s+", "-")
    return F.when(s.rlike(r"^[a-z0-9\x{4E00}-\x{9FFF}-]+(/[a-z0-9\x{4E00}-\x{9FFF}-]+)*$"), s)


def for_embedding(c: Column, most: int = 20_000) -> Column:
    """Embedded image data replaced by [image], then at most ``most`` characters, which is what models take."""
    return F.left(F.regexp_replace(c, r"data:image/[a-zA-Z0-9.+-]+;base64,[A-Za-z0-9+/=\s]+", "[image]"), F.lit(most))


def image_refs(c: Column) -> Column:
    """alt and url of each Markdown image; addresses may hold one level of round brackets."""
    rx = F.lit(r"!\[([^\]\n]*)\]\(((?:[^()\s]|\([^()\s]*\))+)[^()\n]*\)")
    return F.arrays_zip(F.regexp_extract_all(c, rx, 1).alias("alt"), F.regexp_extract_all(c, rx, 2).alias("url"))


def images_within(images: Column, start: Column, end: Column) -> Column:
    """Images (start_pos, end_pos, ..) that lie inside a range or touch it."""
    return F.filter(images, lambda i: (i["start_pos"] < end) & (i["end_pos"] > start))


def prune_images(c: Column, kept: Column) -> Column:
    """A text without the images whose address isn't in ``kept``; line ends left in a row become two."""
    refs = image_refs(c)
    gone = F.filter(refs, lambda r: ~F.array_contains(kept, r["url"]))
    out = F.aggregate(gone, c, lambda s, r: F.replace(s, F.concat(F.lit("!["), r["alt"], F.lit("]("), r["url"], F.lit(")")), F.lit("")))
    return F.trim(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def with_image_info(c: Column, images: Column) -> Column:
    """A text with a block for each image that has a caption or recognised text (array of structs url, caption, ocr_text)."""
    blocks = F.transform(images, lambda i: F.when((F.coalesce(i["caption"], F.lit("")) != "") | (F.coalesce(i["ocr_text"], F.lit("")) != ""), F.concat_ws("\n", F.concat(F.lit("[image] "), i["url"]), F.when(F.coalesce(i["caption"], F.lit("")) != "", F.concat(F.lit("caption: "), i["caption"])), F.when(F.coalesce(i["ocr_text"], F.lit("")) != "", F.concat(F.lit("text: "), i["ocr_text"])))))
    return F.concat_ws("\n\n", c, F.array_join(F.array_compact(blocks), "\n\n"))


# What recognition models answer for pictures without text.
NO_TEXT = ("no text", "no text found", "none", "n/a", "无", "无文字", "图片中没有文字", "没有文字")


def clean_ocr(c: Column) -> Column:
    """Recognised text without a code fence; HTML becomes plain text, nearly empty HTML and answers that there is no text become ''."""
    t = F.trim(F.regexp_replace(F.trim(c), r"(?s)^```[a-zA-Z]*\s*\n(.*?)\n?```$", "$1"))
    html = t.rlike(r"(?is)<(html|body|p|div|table|tr|td|span|br)\b[^>]*>")
    plain = F.when(html, F.when(F.length(T.strip_tags(t)) < 10, F.lit("")).otherwise(T.strip_tags(t))).otherwise(t)
    return F.when(F.lower(F.regexp_replace(plain, r"[.。!！]+$", "")).isin(*NO_TEXT), F.lit("")).otherwise(plain)


def tolerant_pattern(text: str) -> str:
    """A regular expression for a text with any white space, or none, between its signs."""
    return r"\s*".join(re.escape(x) for x in text if not x.isspace())


def aliases(c: Column, prefixes: tuple[str, ...], suffixes: tuple[str, ...], least: int = 4) -> Column:
    """Other names of one: without brackets, without a company before it, without endings that tell a kind, taken off one after the other; none shorter than ``least``, none the name itself."""
    bare = F.trim(F.regexp_replace(c, r"[（(][^（）()]*[）)]", ""))
    short = F.trim(F.regexp_replace(bare, r"^(?:" + "|".join(map(re.escape, sorted(prefixes, key=len, reverse=True))) + r")\s*", "")) if prefixes else bare
    steps = reduce(lambda s, _: [*s, F.trim(F.regexp_replace(s[-1], r"\s*(?:" + "|".join(map(re.escape, sorted(suffixes, key=len, reverse=True))) + ")$", ""))], range(3), [short]) if suffixes else [short]
    return F.array_distinct(F.filter(F.array(bare, *steps), lambda x: (F.length(x) >= least) & (x != F.trim(c))))


def signals(answer: Column, score: Column, references: Column, annotation: Column, patterns: tuple[str, ...], low: float = 0.5) -> Column:
    """Which signs of a gap a trace shows: refusal (a pattern in the answer), low_score, no_reference, negative_annotation."""
    flag = lambda cond, name: F.when(F.coalesce(cond, F.lit(False)), F.lit(name))
    has = reduce(lambda a, p: a | F.contains(F.lower(answer), F.lit(p.lower())), patterns, F.lit(False))
    return F.array_compact(F.array(flag(has, "refusal"), flag(score < low, "low_score"), flag(F.size(references) <= 0, "no_reference"), flag(annotation == "negative", "negative_annotation")))


def table_blocks(c: Column) -> Column:
    """HTML tables of a text as Markdown tables; tables with merged cells stay HTML without their layout attributes."""
    cell, row, table = re.compile(r"<t[dh]\b[^>]*>(.*?)</t[dh]\s*>", re.S | re.I), re.compile(r"<tr\b[^>]*>(.*?)</tr\s*>", re.S | re.I), re.compile(r"<table\b[^>]*>.*?</table\s*>", re.S | re.I)
    merged, layout, tag = re.compile(r"\b(?:row|col)span\s*=\s*[\"']?(?!1\b)\d", re.I), re.compile(r"\s(?:style|class|width|height|border|cellpadding|cellspacing|align|valign|bgcolor)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I), re.compile(r"<[^>]+>")

    def one(m: re.Match) -> str:
        if merged.search(m[0]):
            return layout.sub("", m[0])
        rows = [[" ".join(tag.sub(" ", x).replace("|", "\\|").split()) for x in cell.findall(r)] for r in row.findall(m[0])]
        rows = [r for r in rows if r]
        if not rows:
            return ""
        n = max(map(len, rows))
        lines = ["| " + " | ".join([*r, *[""] * (n - len(r))]) + " |" for r in rows]
        return "\n" + "\n".join([lines[0], "|" + " --- |" * n, *lines[1:]]) + "\n"

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([x if x is None or "<" not in x else table.sub(one, x) for x in s], dtype=object)

    return run(c)
