"""Guarded ad-hoc SQL: one read-only statement over allowed tables, with row scoping.

The statement is parsed by Spark's own parser. Its unresolved logical plan is
walked, so nested queries, CTEs and set operations are covered; nothing is
decided by matching the text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The functions a statement may call; all others are denied.
FUNCTIONS = frozenset(
    "abs acos asin atan atan2 cbrt ceil ceiling cos degrees exp floor greatest least ln log log10 log2 mod pi pmod pow power radians round bround sign signum sin sqrt tan width_bucket try_add try_subtract try_multiply try_divide "
    "char_length character_length length lower upper lcase ucase trim ltrim rtrim btrim lpad rpad left right substr substring substring_index concat concat_ws replace translate reverse repeat split split_part instr locate position contains startswith endswith like ilike rlike regexp regexp_like regexp_extract regexp_extract_all regexp_replace regexp_count regexp_substr regexp_instr initcap ascii chr char space format_number format_string levenshtein soundex md5 sha sha1 sha2 crc32 xxhash64 hash octet_length bit_length overlay "
    "coalesce nvl nvl2 ifnull nullif if iff isnull isnotnull isnan nanvl zeroifnull nullifzero decode "
    "count count_if sum avg mean min max stddev stddev_pop stddev_samp std variance var_pop var_samp median mode percentile percentile_approx approx_percentile approx_count_distinct corr covar_pop covar_samp first first_value last last_value any_value max_by min_by collect_list collect_set array_agg bool_and bool_or every some any kurtosis skewness sum_distinct try_sum try_avg grouping grouping_id listagg string_agg histogram_numeric regr_slope regr_r2 "
    "row_number rank dense_rank percent_rank cume_dist ntile lag lead nth_value "
    "date to_date to_timestamp try_to_date try_to_timestamp date_add dateadd date_sub date_diff datediff add_months months_between date_trunc trunc date_format extract date_part datepart year quarter month week weekofyear day dayofmonth dayofweek dayofyear weekday hour minute second last_day next_day make_date make_timestamp make_interval unix_timestamp from_unixtime unix_seconds unix_millis unix_micros timestamp_seconds timestamp_millis timestampadd timestampdiff current_date current_timestamp now window session_window "
    "array array_contains array_distinct array_except array_intersect array_union array_join array_max array_min array_position array_remove array_repeat array_size array_sort array_compact arrays_overlap arrays_zip cardinality size element_at try_element_at get slice flatten sequence shuffle sort_array transform filter exists forall aggregate reduce zip_with explode explode_outer posexplode posexplode_outer inline stack map map_keys map_values map_entries map_from_arrays map_from_entries map_contains_key struct named_struct "
    "get_json_object json_tuple from_json to_json json_array_length json_object_keys schema_of_json parse_json try_parse_json variant_get try_variant_get to_variant_object is_variant_null "
    "cast try_cast string int integer bigint double float decimal boolean tinyint smallint binary timestamp typeof hex unhex base64 unbase64 bin conv encode bit_count bit_and bit_or bit_xor shiftleft shiftright and or not in between equal_null".split()
)
# Plan nodes of a read-only query.
ALLOWED_NODES = frozenset(
    "Project Filter Aggregate Join Sort Limit GlobalLimit LocalLimit Offset Distinct Union Intersect Except SubqueryAlias UnresolvedRelation UnresolvedSubqueryColumnAliases UnresolvedHaving UnresolvedWith CTE WithCTE CTERelationDef CTERelationRef Window WithWindowDefinition OneRowRelation UnresolvedInlineTable LateralJoin Pivot Unpivot Generate Expand GroupingSets UnresolvedOrdinal OrderBy UnresolvedPivot UnresolvedUnpivot TemporalTable Tail LocalRelation UnionLoop UnionLoopRef".split()
)


SUBQUERIES = ("ScalarSubquery", "Exists", "ListQuery", "InSubquery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression")
COMPARISONS = ("EqualTo", "EqualNullSafe", "GreaterThan", "GreaterThanOrEqual", "LessThan", "LessThanOrEqual", "Like", "RLike", "ILike")


class Rejected(ValueError):
    """The statement may not run; the message tells why."""


@dataclass
class Statement:
    """What a statement reads."""

    tables: list[str] = field(default_factory=list)
    functions: list[str] = field(default_factory=list)
    nodes: list[str] = field(default_factory=list)
    has_where: bool = False
    constants: list[str] = field(default_factory=list)


def _children(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def parse(spark: SparkSession, sql: str) -> Statement:
    """Tables, functions and plan nodes of one statement; a syntax error is a rejection."""
    if not sql or not sql.strip():
        raise Rejected("empty statement")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql.strip().rstrip(";"))
    except Exception as e:  # the parser's own exception type differs by version
        raise Rejected(f"not one valid statement: {str(e).splitlines()[0][:200]}") from None
    out, ctes = Statement(), set()

    def fixed(e) -> bool:
        """Whether an expression has one value for all rows: built of literals alone."""
        kids = _children(e.children())
        name = e.getClass().getSimpleName()
        if name == "UnresolvedFunction" and str(_children(e.nameParts())[-1]).lower() == "count":
            return False
        return name == "Literal" or bool(kids) and name not in SUBQUERIES and all(map(fixed, kids))

    def condition(e) -> None:
        """Conditions that hold or fail whatever the row: of literals alone, or of a thing compared with itself."""
        name, kids = e.getClass().getSimpleName(), _children(e.children())
        if fixed(e):
            out.constants.append(str(e.sql()))
        elif name in COMPARISONS and len(kids) == 2 and kids[0].semanticEquals(kids[1]) or name in COMPARISONS and len(kids) == 2 and str(kids[0].sql()) == str(kids[1].sql()):
            out.constants.append(str(e.sql()))
        elif name in ("And", "Or", "Not"):
            for c in kids:
                condition(c)

    def expression(e) -> None:
        name = e.getClass().getSimpleName()
        if name == "UnresolvedFunction":
            out.functions.append(".".join(str(x) for x in _children(e.nameParts())).lower())
        if hasattr(e, "plan") and name in SUBQUERIES:
            walk(e.query().plan() if name == "InSubquery" else e.plan())
        for c in _children(e.children()):
            expression(c)

    def walk(p) -> None:
        name = p.getClass().getSimpleName()
        out.nodes.append(name)
        if name == "UnresolvedRelation":
            out.tables.append(".".join(str(x) for x in _children(p.multipartIdentifier())).lower())
        elif name == "UnresolvedWith":
            for pair in _children(p.cteRelations()):
                ctes.add(str(pair._1()).lower())
                walk(pair._2())
        elif name in ("Filter", "UnresolvedHaving"):
            out.has_where = True
            condition(p.condition() if name == "Filter" else p.havingCondition())
        elif name == "Join" and p.condition().isDefined():
            condition(p.condition().get())
        for e in _children(p.expressions()):
            expression(e)
        for c in _children(p.children()):
            walk(c)

    walk(plan)
    out.tables = sorted({t for t in out.tables if t not in ctes})
    return out


def validate(spark: SparkSession, sql: str, allowed: Iterable[str]) -> Statement:
    """The parsed statement if it is a read-only query over ``allowed`` tables, else ``Rejected``.

    All is decided on the parsed plan: only the listed plan nodes and functions
    pass, tables only if they are allowed, also in subqueries at any depth; and
    no condition may be one of literals alone or compare a thing with itself.
    """
    st = parse(spark, sql)
    strange = [n for n in st.nodes if n not in ALLOWED_NODES]
    if strange:
        raise Rejected(f"not a read-only query: {strange[0]}")
    names = {a.lower() for a in allowed}
    for t in st.tables:
        if t not in names:
            raise Rejected(f"table {t} is not allowed")
    for f in st.functions:
        if f not in FUNCTIONS:
            raise Rejected(f"function {f} is not allowed")
    if st.constants:
        raise Rejected(f"a condition compares constants, or a thing with itself: {st.constants[0]}")
    return st


def run(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame], scope: Mapping[str, str] | None = None) -> DataFrame:
    """The result of a guarded statement; ``scope`` gives a row filter for some tables.

    Every table stands under its name in a WITH clause over a view of this call
    alone, its filter inside, so no statement can leave it out, and calls with
    other scopes, or views of the session, don't meet.
    """
    st = validate(spark, sql, tables)
    named = {k.lower(): k for k in tables}
    scopes = {k.lower(): v for k, v in (scope or {}).items()}
    parts = []
    for t in st.tables:
        df = tables[named[t]]
        if t in scopes:
            df = df.where(F.expr(scopes[t]))
        view = f"q_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(view)
        parts.append(f"`{t}` AS (SELECT * FROM `{view}`)")
    text = sql.strip().rstrip(";").strip()
    if not parts:
        return spark.sql(text)
    own = re.match(r"(?is)(?:\s|--[^\n]*\n|/\*.*?\*/)*WITH\b(\s+RECURSIVE\b)?", text)
    if own:
        return spark.sql(f"WITH{own[1] or ''} {', '.join(parts)}, {text[own.end():]}")
    return spark.sql(f"WITH {', '.join(parts)} {text}")
