"""Text functions as column expressions; all of them give null for null unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Question words and fillers that carry no search meaning.
STOP_WORDS = "the a an and or of in on at to for is are was were be by with from that this it as the what which who how when where why does do can der die das und oder von zu mit für ist im den dem le la les de des du et ou en un une el los las y o del que".split()


def normalise(c: Column) -> Column:
    """Lower case, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def signature(c: Column) -> Column:
    """md5 of the normalised text, '' for a blank one."""
    n = normalise(c)
    return F.when(n == "", F.lit("")).otherwise(F.md5(n))


def contains_text(short: Column, long: Column) -> Column:
    """Whether the normalised long text holds the short one."""
    return F.contains(normalise(long), normalise(short))


def words(c: Column) -> Column:
    """Runs of letters and digits in lower case, in order."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), 1)


def word_set(c: Column) -> Column:
    return F.array_distinct(words(c))


def query_terms(c: Column) -> Column:
    """Distinct words of more than one character that aren't stop words, in order."""
    stop = F.array(*(F.lit(w) for w in dict.fromkeys(STOP_WORDS)))
    return F.filter(word_set(c), lambda w: (F.length(w) > 1) & ~F.array_contains(stop, w))


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` tokens joined by a blank; an empty array if there are fewer."""
    size = F.size(tokens)
    return F.when(size >= n, F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def char_bigrams(c: Column) -> Column:
    """Distinct pairs of neighbouring characters of the normalised text without blanks; one character stands for itself."""
    t = F.regexp_replace(F.lower(c), r"\s+", "")
    n = F.length(t)
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(t, i, F.lit(2)))
    return F.when(n > 0, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def cjk_tokens(c: Column) -> Column:
    """Runs of Han characters as bigrams (a single one kept), other runs of letters and digits whole."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"([\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}]+|[\p{L}\p{N}&&[^\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}]]+)"), 1)
    split = F.transform(runs, lambda r: F.when(r.rlike(r"^[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}]{2,}$"), F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))), lambda i: F.substring(r, i, F.lit(2)))).otherwise(F.array(r)))
    return F.flatten(split)


def jaccard(a: Column, b: Column) -> Column:
    """Shared elements over all; two empty sets have 0."""
    inter, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def overlap_coefficient(a: Column, b: Column) -> Column:
    """Shared elements over the smaller set; an empty set has 0."""
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def slug(c: Column) -> Column:
    """Lower case, blanks to hyphens, other signs than letters, digits, hyphens, slashes and Han dropped."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"\s+", "-")
    return F.regexp_replace(F.regexp_replace(s, r"[^a-z0-9/\x{4E00}-\x{9FFF}-]", ""), r"^[-/]+|[-/]+$", "")


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def han_share(c: Column) -> Column:
    """Share of Han characters among all that aren't blank; 0 for a blank text."""
    n = F.length(F.regexp_replace(c, r"\s", ""))
    han = n - F.length(F.regexp_replace(c, r"[\s\x{4E00}-\x{9FFF}]", ""))
    return F.when(n > 0, han / n).otherwise(F.lit(0.0))


def language(c: Column) -> Column:
    """zh, de, en or mixed by the shares of scripts and German marks."""
    n = F.length(F.regexp_replace(c, r"\s", ""))
    latin = n - F.length(F.regexp_replace(c, r"[\sA-Za-zÄÖÜäöüß]", ""))
    lat = F.when(n > 0, latin / n).otherwise(F.lit(0.0))
    han = han_share(c)
    german = c.rlike(r"[äöüßÄÖÜ]") | F.lower(c).rlike(r"\b(der|die|das|und|nicht|wird)\b")
    return F.when((han >= 0.15) & (lat >= 0.15), "mixed").when(han > 0.3, "zh").when(german, "de").otherwise("en")


def token_estimate(c: Column) -> Column:
    """Characters over the ratio of the language, rounded half up, at least 1."""
    lang = language(c)
    ratio = F.when(lang == "zh", 1.7).when(lang == "de", 4.5).when(lang == "mixed", 3.0).otherwise(4.0)
    return F.greatest(F.floor(F.length(c) / ratio + 0.5), F.lit(1)).cast("int")


def redact(c: Column) -> Column:
    """Personal numbers masked, also where letters touch them: identity numbers, then phones, then policies of ten digits and more."""
    c = F.regexp_replace(c, r"[0-9]{17}[0-9Xx]", "[ID]")
    c = F.regexp_replace(c, r"1[3-9][0-9]{9}", "[PHONE]")
    return F.regexp_replace(c, r"[0-9]{10,}", "[POLICY]")


# The kinds of entities found by pattern.
ENTITIES = {
    "number": r"([0-9]+(?:[.,][0-9]+)*)",
    "iso_date": r"([0-9]{4}-[0-9]{2}-[0-9]{2})",
    "percent": r"([0-9]+(?:[.,][0-9]+)? ?%)",
    "email": r"([A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z.]+)",
    "url": r"(https?://[^\s<>\"]+)",
    "code": r"([A-Z]{2}-[0-9]{3,})",
}


def entities(c: Column, kind: str) -> Column:
    return F.regexp_extract_all(c, F.lit(ENTITIES[kind]), 1)


# What is taken out of a passage before the lines of its tables, and after them.
PASSAGE_FIRST = [
    (r"(?s)```.*?```", ""), (r"(?s)\$\$.+?\$\$", ""), (r"!\[[^\]\n]*\]\([^()\n]*\)", ""), (r"\[([^\]\n]+)\]\([^()\n]*\)", "$1"), (r"https?://\S+", ""), (r"<[^<>\n]+>", ""), (r"(?m)^[ \t]*\|[ \t:|-]+\|[ \t]*$", ""),
]
PASSAGE_LAST = [(r"(?m)^#{1,6}[ ]+", ""), (r"(?m)^>[ ]?", ""), (r"(?m)^[ \t]*(?:[-*+]|[0-9]+\.)[ ]+", ""), (r"\*{1,3}([^*\n]+)\*{1,3}", "$1"), (r"\n{3,}", "\n\n")]


def clean_passage(c: Column) -> Column:
    """Markdown to plain passage text: code, maths, images, addresses and tags go, links leave their text, rows of tables become lists with commas, marks of headings, quotes, lists and emphasis go, blank lines become one."""
    c = reduce(lambda x, s: F.regexp_replace(x, *s), PASSAGE_FIRST, c)
    row = lambda x: F.array_join(F.transform(F.split(F.regexp_replace(x, r"^[ \t]*\||\|[ \t]*$", ""), r"\|"), lambda y: F.trim(y)), ", ")
    lines = F.transform(F.split(c, "\n"), lambda x: F.when(x.rlike(r"^[ \t]*\|.*\|[ \t]*$"), row(x)).otherwise(x))
    c = F.when(F.contains(c, F.lit("|")), F.array_join(lines, "\n")).otherwise(c)
    return F.trim(reduce(lambda x, s: F.regexp_replace(x, *s), PASSAGE_LAST, c))


def strip_tags(c: Column) -> Column:
    """Text of simple HTML: scripts and styles gone, tags to blanks, white space collapsed."""
    c = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    c = F.regexp_replace(c, r"<[^>]+>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def strip_thoughts(c: Column) -> Column:
    """Without <think> blocks, closed or left open."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<think>.*?</think>", ""), r"(?s)<think>.*$", ""))


def canonical_url(c: Column) -> Column:
    """Trimmed, without its fragment."""
    return F.regexp_replace(F.trim(c), r"#.*$", "")


def truncate(c: Column, head: int, tail: int = 0, mark: str = "…") -> Column:
    """The first and last characters of a longer text with a mark between."""
    return F.when(F.length(c) <= head + tail, c).otherwise(F.concat(F.substring(c, 1, head), F.lit(mark), F.when(F.lit(tail > 0), F.right(c, F.lit(tail))).otherwise(F.lit(""))))


def clean_utf8(c: Column) -> Column:
    """Without NUL and replacement characters."""
    return F.regexp_replace(c, r"[\x{0000}\x{FFFD}]", "")


def like_escape(c: Column) -> Column:
    r"""``%``, ``_`` and ``\`` escaped for LIKE."""
    return F.regexp_replace(c, r"([%_\\])", r"\\$1")


def sql_quote(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit("''"))


def human_size(c: Column) -> Column:
    """Bytes in B, KB, MB or GB with one digit."""
    return F.when(c < 1024, F.concat(c.cast("string"), F.lit(" B"))).when(c < 1 << 20, F.concat(F.format_number(c / 1024, 1), F.lit(" KB"))).when(c < 1 << 30, F.concat(F.format_number(c / (1 << 20), 1), F.lit(" MB"))).otherwise(F.concat(F.format_number(c / (1 << 30), 1), F.lit(" GB")))


def relevance_label(c: Column) -> Column:
    return F.when(c >= 0.8, "High").when(c >= 0.6, "Medium").when(c >= 0.4, "Low").otherwise("Weak")


def is_heading(c: Column) -> Column:
    """A line of at most 40 characters that is numbered, a chapter, or a Markdown heading."""
    return (F.length(c) <= 40) & c.rlike(r"^(#{1,6} |[0-9]+(\.[0-9]+)*[.、 ]|第[0-9一二三四五六七八九十百]+[章节条])")


def sentences(c: Column, parity: bool = False) -> Column:
    """Segments between full stops; with ``parity`` every second one only, as the metrics' reference numbers need."""
    trim = lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")
    parts = F.filter(F.transform(F.split(c, r"[。.]"), trim), lambda s: s != "")
    if not parity:
        return parts
    raw = F.split(c, r"[。.]")
    return F.filter(F.transform(F.filter(raw, lambda s, i: i % 2 == 0), trim), lambda s: s != "")


def key_points(c: Column, least: int = 2) -> Column:
    """Distinct points between semicolons, full stops and line ends, without their numbering."""
    parts = F.split(c, r"[;；。\n]")
    parts = F.transform(parts, lambda s: F.trim(F.regexp_replace(s, r"^\s*(?:[-*•]|[0-9]+[.)、]|[（(][0-9]+[)）])\s*", "")))
    return F.array_distinct(F.filter(parts, lambda s: F.length(s) >= least))


def profile(c: Column) -> dict[str, Column]:
    """Counts that choose a splitting strategy: lines, headings, form feeds, list items, table rows, blank lines."""
    lines = F.split(c, "\n")
    n = lambda rx: F.size(F.filter(lines, lambda s: s.rlike(rx)))
    return {"lines": F.size(lines), "headings": n(r"^#{1,6} "), "form_feeds": F.length(c) - F.length(F.replace(c, F.lit("\f"), F.lit(""))), "items": n(r"^\s*[-*] "), "table_rows": n(r"^\|.*\|$"), "blanks": n(r"^\s*$")}


def fingerprint(c: Column) -> Column:
    """The first 12 hex digits of the hash of a text's headings without digits and white space."""
    heads = F.filter(F.split(c, "\n"), lambda s: s.rlike(r"^#{1,6} "))
    return F.substring(F.sha2(F.array_join(F.transform(heads, lambda s: F.regexp_replace(s, r"[0-9\s]", "")), "|"), 256), 1, 12)


def repair_json(c: Column) -> Column:
    """Fences and trailing commas gone, so that from_json may read it."""
    c = F.regexp_replace(F.trim(c), r"(?s)^```(?:json)?\s*|\s*```$", "")
    return F.regexp_replace(c, r",\s*([}\]])", "$1")


def tagged_hash(domain: str, version: int, c: Column) -> Column:
    """sha256 over domain, version and text, parted by a zero byte each."""
    return F.sha2(F.concat(F.lit(f"{domain}\0{version}\0"), c), 256)
