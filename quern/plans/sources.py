"""Sources over the files inside read_requests, and round trips of formats."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quern.plans.registry import query
from quern.runtime import shared_dir, table
from quern.sources.parsers import parse_files


def _requests(spark, d):
    return table(spark, d, "read_requests").dropDuplicates(["request_id"])


@query("parse_requests", "SELECT kind, count(*) AS n, count(*) FILTER (WHERE len > 0) AS with_text FROM (SELECT DISTINCT request_id, coalesce(nullif(lower(trim(file_type)), ''), 'txt') AS kind, octet_length(coalesce(file_content, ''::BLOB)) AS len FROM read_requests) GROUP BY kind")
def _(spark, d):
    return parse_files(_requests(spark, d), "file_content", "file_type", "request_id").groupBy("kind").agg(F.count("*").alias("n"), F.count("text").alias("with_text"))


def _trip(fmt: str, **options):
    def f(spark, d):
        path = f"{shared_dir(spark)}/quern/{fmt}-{uuid.uuid4().hex}"
        p = table(spark, d, "part")
        p.write.format(fmt).options(**options).save(path)
        return spark.read.format(fmt).schema(p.schema).options(**options).load(path)

    return f


for _fmt, _opt in (("json", {}), ("csv", {"header": "true"}), ("orc", {}), ("parquet", {})):
    query(f"round_trip_{_fmt}", "SELECT * FROM part")(_trip(_fmt, **_opt))


@query("json_variant", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("union_by_name", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS brand FROM customer UNION ALL SELECT p_partkey, p_name, NULL, p_brand FROM part")
def _(spark, d):
    from quern.sources.parsers import union_by_name

    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return union_by_name([c, p])
