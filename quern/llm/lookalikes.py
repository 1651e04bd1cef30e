"""One form for texts that look alike but are stored in different characters.

DuckDB runs inside every Arrow partition: one SQL expression removes invisible
characters, maps full-width and other compatibility forms and look-alike letters
by ``translate``, takes joined signs apart by ``replace`` and composes accents by
``nfc_normalize``. What differs visibly (case, accents, digits, raised digits,
fractions) stays different.

Which letters look alike comes from the public Unicode data of confusable
characters, as the ICU library that Spark brings along has them: letters of one
case with one skeleton are one letter. The few fixed lists below come on top of
them; where that library is missing or fails there is an error and no result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.runtime import discard, settle, spread

# Letters of other alphabets and the Latin letters of the same shape.
CYRILLIC = dict(zip("АВЕІЈКМНОРСТУХЅԚԜҮӀаеіјорсухѕһԛԝԁӏ", "ABEIJKMHOPCTYXSQWYIaeijopcyxshqwdl"))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿϳονϲρ", "ABEZHIKMNOPTYXCJjovcp"))
ARMENIAN = dict(zip("ՕՍհոսցօ", "OUhnugo"))
OTHER_LETTERS = dict(zip("ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏚᎢᏙꓐꓑꓒꓓꓔꓖꓗꓚꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴɡ", "ABCDEHJKLMPSTVBPdDTGKCFMNLSRVHWXYAEIOUg"))
# Hyphens, blanks, quotation marks and signs of the same shape.
HYPHENS = "\u2010\u2011\u2012\u2013\u2043\u2212\ufe63\uff0d\u02d7"
BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000\t"
SIGNS = {"∶": ":", "꞉": ":", "։": ":", "\u037e": ";", "٫": ",", "‚": ",", "․": ".", "∕": "/", "⁄": "/", "\u0387": "·", "∙": "·", "‧": "·", "・": "·", "ǃ": "!", "ʼ": "’", "∣": "|", "ǀ": "|", "∼": "~", "⟨": "〈", "⟩": "〉"}
# Characters without any shape.
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\U000e0000-\U000e0fff"


# How the Unicode names of letters begin that may look like Latin ones; others write from right to left or have shapes of their own.
SCRIPTS = ("LATIN", "GREEK", "CYRILLIC", "COPTIC", "CHEROKEE", "LISU", "CANADIAN", "ARMENIAN", "MATHEMATICAL", "SCRIPT", "DOUBLE-STRUCK", "BLACK-LETTER", "PLANCK", "TIFINAGH", "OLD ITALIC", "CARIAN", "LYCIAN", "GOTHIC", "DESERET", "WARANG", "ELBASAN", "VAI", "MODIFIER LETTER SMALL")
#: Latin letters up to here are letters in their own right; but for dotless ones nothing turns them into another.
LAST_LATIN = 0x24F


def _case(c: str) -> int:
    return 1 if c.isupper() else 2 if c.islower() else 0


def _rank(c: str) -> int:
    """Which of several letters of one shape stands for all: one of Latin words before one of Cyrillic, then Greek words, then rare ones."""
    cp = ord(c)
    return 0 if cp < 0x180 and c != "ĸ" else 1 if 0x410 <= cp < 0x450 else 2 if 0x391 <= cp < 0x3CA else 3


@lru_cache(maxsize=1)
def _letters() -> tuple[str, ...]:
    """All letters of SCRIPTS without a canonical decomposition."""
    ranges = (range(0x41, 0x5B), range(0x61, 0x7B), range(0xC0, 0x3400), range(0xA000, 0xAC00), range(0x10000, 0x17000), range(0x1D400, 0x1D800))
    out = []
    for c in (chr(cp) for r in ranges for cp in r):
        if unicodedata.category(c) in ("Lu", "Ll", "Lo", "Lm") and unicodedata.name(c, "").startswith(SCRIPTS):
            d = unicodedata.decomposition(c)
            if not d or d.startswith("<font>"):
                out.append(c)
    return tuple(out)


def confusable(spark: SparkSession) -> dict[str, str]:
    """Letter to the letter that it looks like, from the skeletons of the Unicode data; an error without ICU, as the fixed lists alone would find less and not tell."""
    letters = _letters()
    try:
        checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        skeletons = checker.getSkeleton("\n".join(letters)).split("\n")
    except Exception as e:  # no such class, or no JVM at hand
        raise RuntimeError("look-alike letters need the ICU library (com.ibm.icu) in the driver's JVM") from e
    if len(skeletons) != len(letters):
        raise RuntimeError(f"{len(skeletons)} skeletons for {len(letters)} letters")
    groups: dict[tuple[str, int], list[str]] = {}
    for c, s in zip(letters, skeletons):
        groups.setdefault((s, _case(c)), []).append(c)
    for (s, case), cs in list(groups.items()):
        # signs without case look like a letter of either case; the one named I, l and | alike is left out
        if case == 0 and s != "l":
            for other in (1, 2):
                if min(groups.get((s, other), "~")) < "~":
                    groups[s, other].extend(cs)
                    break
    out = {}
    for (s, case), cs in groups.items():
        if case:
            to = min(cs, key=lambda c: (_rank(c), ord(c)))
            out.update({c: to for c in cs if c != to and (ord(c) > LAST_LATIN or c in "ıȷ")})
    return out


@lru_cache(maxsize=2)
def tables(known: tuple[tuple[str, str], ...] = ()) -> tuple[dict[str, str], dict[str, str]]:
    """The characters that become one other, and those that become several or none; ``known`` are the look-alikes of ``confusable``."""
    one: dict[str, str] = {}
    many: dict[str, str] = {}
    for cp in (*range(0x2E80, 0x3100), *range(0x3130, 0x33FF), *range(0xF900, 0xFB50), *range(0xFE10, 0xFE70), *range(0xFF01, 0xFFEF), *range(0x2100, 0x2180), *range(0x0132, 0x0134), *range(0x01C4, 0x01CD), *range(0x01F1, 0x01F4), *range(0x1D400, 0x1D800)):
        c = chr(cp)
        kind = unicodedata.decomposition(c).split(" ")[0]
        # <super>, <sub>, <fraction>, <circle> and <square> have a size or place of their own; canonical forms are nfc's
        if kind in ("<wide>", "<narrow>", "<compat>", "<small>", "<vertical>", "<font>") or 0xF900 <= cp < 0xFB00 or kind and not kind.startswith("<"):
            plain = unicodedata.normalize("NFKC", c)
            if 0x2100 <= cp < 0x2150 and kind != "<font>":  # signs such as that of a number have small letters of a place of their own
                continue
            if plain != c and not plain.startswith(" ") and (kind == "<narrow>" or not any(unicodedata.combining(x) for x in plain)):
                (one if len(plain) == 1 else many)[c] = plain
    letters = {**dict(known), **CYRILLIC, **GREEK, **ARMENIAN, **OTHER_LETTERS}
    one.update({k: v for k, v in {**letters, **SIGNS}.items() if k != v})
    one.update(dict.fromkeys(HYPHENS, "-"))
    one.update(dict.fromkeys(BLANKS, " "))
    one["\u212a"] = "K"
    # a value may itself be a key, as a full-width sign that looks like another
    for k in one:
        seen = {k}
        while (v := one[k]) in one and v not in seen:
            seen.add(v)
            one[k] = one[v]
    # composed letters follow their base letter
    for cp in (*range(0xC0, 0x2000), *range(0x2C00, 0x2E00), *range(0xA640, 0xA7A0)):
        c = chr(cp)
        parts = unicodedata.normalize("NFD", c)
        if len(parts) > 1 and parts[0] in letters and not unicodedata.decomposition(c).startswith("<"):
            to = unicodedata.normalize("NFC", one[parts[0]] + parts[1:])
            if to != c:
                (one if len(to) == 1 else many)[c] = to
    for k, v in many.items():
        many[k] = "".join(one.get(x, x) for x in v)
    return one, many


def _sql(one: dict[str, str], many: dict[str, str]) -> str:
    """The expression over a column ``t``, with the tables as string constants."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    text = f"regexp_replace(t, {q(f'[{INVISIBLE}]')}, '', 'g')"
    if one:
        text = f"translate({text}, {q(''.join(one))}, {q(''.join(one.values()))})"
    for k, v in many.items():
        text = f"replace({text}, {q(k)}, {q(v)})"
    return f"CASE WHEN regexp_full_match(t, '[ -~]*') THEN t ELSE nfc_normalize({text}) END"


def _normalise(texts: pa.Array, known: tuple[tuple[str, str], ...] = ()) -> pa.Array:
    """The one form of each text, in order; null stays null."""
    con = _connection()
    distinct = texts.dictionary_encode()
    one, many = tables(known)
    # of the tables only what these texts hold
    held = {c for c in set("".join(t for t in distinct.dictionary.to_pylist() if t)) if c > "~" or c == "\t"}
    sql = _sql({c: one[c] for c in sorted(held & one.keys())}, {c: many[c] for c in sorted(held & many.keys())})
    src = pa.table({"i": pa.array(range(len(distinct.dictionary)), pa.int64()), "t": distinct.dictionary})
    con.register("src", src)  # one thread: the executor has the others
    try:
        out = con.sql(f"SELECT i, {sql} AS c FROM src ORDER BY i").to_arrow_table()
    finally:
        con.unregister("src")
    return out.column("c").combine_chunks().take(distinct.indices)


_CON = None


def _connection():
    global _CON
    if _CON is None:
        import duckdb

        _CON = duckdb.connect(config={"threads": 1, "memory_limit": "512MB"})
    return _CON


def one_form(df: DataFrame, columns: Sequence[str], suffix: str = "_form") -> DataFrame:
    """``df`` with, for each of ``columns`` (string or array<string>), its one form in ``column + suffix``.

    Null stays null (also as an element), '' stays ''; repeated rows stay; a text
    of invisible characters only becomes ''. Existing columns of the new names
    are replaced.
    """
    new = [c + suffix for c in columns]
    kept = df.drop(*new)
    fields = [*kept.schema.fields, *(T.StructField(n, kept.schema[c].dataType, True) for c, n in zip(columns, new))]

    known = tuple(sorted(confusable(df.sparkSession).items()))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            arrays = list(batch.columns)
            for c in columns:
                col = batch.column(batch.schema.get_field_index(c))
                if pa.types.is_list(col.type):
                    flat = _normalise(col.flatten().cast(pa.string()), known)
                    counts = col.value_lengths().fill_null(0).to_pylist()
                    offsets, at = [], 0
                    for n, ok in zip(counts, col.is_valid().to_pylist()):
                        offsets.append(at if ok else None)
                        at += n
                    arrays.append(pa.ListArray.from_arrays(pa.array([*offsets, at], pa.int32()), flat))
                else:
                    arrays.append(_normalise(col.cast(pa.string()), known))
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    return kept.mapInArrow(run, T.StructType(fields))


def record_forms(records: DataFrame) -> DataFrame:
    """record_id, product_id, doc, field_id, field, page, stored, form: each text of a golden record and its one form.

    field is ``product_name``, ``value`` or ``quote``; page is null but for
    quotes. Texts that are null, and evidence that is null or empty, give no row.
    """
    q = F.expr("transform(filter(evidence, e -> e.quote is not null), e -> struct('quote' as field, e.page as page, e.quote as stored))")
    texts = F.concat(
        F.array(F.struct(F.lit("product_name").alias("field"), F.lit(None).cast("int").alias("page"), F.col("product_name").alias("stored")), F.struct(F.lit("value").alias("field"), F.lit(None).cast("int").alias("page"), F.col("value").alias("stored"))),
        F.coalesce(q, F.array().cast("array<struct<field:string,page:int,stored:string>>")),
    )
    flat = spread(records).select("record_id", "product_id", "doc", "field_id", F.explode(texts).alias("t")).select("record_id", "product_id", "doc", "field_id", "t.*").where("stored is not null")
    return one_form(flat.withColumnRenamed("stored", "x"), ["x"], "_form").withColumnsRenamed({"x": "stored", "x_form": "form"})


def alike_pairs(records: DataFrame) -> DataFrame:
    """record_id_a, record_id_b, field: records of one fact with a field that looks the same but is stored differently.

    A fact is (product_id, doc, field_id), none of them null. The smaller id
    comes first, repeated rows count once, a record makes no pair with itself.
    ``quote`` needs one page with a quote in both records that differs so; a page
    null in both counts as one page. Forms are compared by their hash first, so
    only records that share one meet.
    """
    f = record_forms(records).where("record_id is not null and product_id is not null and doc is not null and field_id is not null")
    # a form and a stored text go on as their hashes only
    k = f.select("record_id", F.when(F.col("field") == "quote", 2).when(F.col("field") == "value", 1).otherwise(0).cast("tinyint").alias("f"), F.xxhash64("stored").alias("s"), F.xxhash64("product_id", "doc", "field_id", "field", F.coalesce("page", F.lit(-1)), "form").alias("h1"), F.hash("form", "field_id", "doc", "product_id", "field", "page").alias("h2"))
    k = settle(k, "forms")
    # only where one form of a fact is stored in two ways can there be a pair
    two = k.groupBy("h1", "h2").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).where("lo <> hi").select("h1", "h2")
    some = settle(k.join(two, ["h1", "h2"], "left_semi").distinct(), "spelt")
    discard(k)
    a, b = some.alias("a"), some.alias("b")
    on = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2")) & (F.col("a.record_id") < F.col("b.record_id")) & (F.col("a.s") != F.col("b.s"))
    name = F.element_at(F.array(F.lit("product_name"), F.lit("value"), F.lit("quote")), F.col("a.f").cast("int") + 1)
    return a.join(b, on).select(F.col("a.record_id").alias("record_id_a"), F.col("b.record_id").alias("record_id_b"), name.alias("field")).distinct()
