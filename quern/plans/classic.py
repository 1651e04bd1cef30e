"""The classical SQL surface, each statement through the guard; DuckDB runs the same text unless another is given."""

from __future__ import annotations

from quern.operators.sqlguard import run
from quern.plans.registry import query
from quern.runtime import table

TABLES = "region nation customer supplier part orders lineitem events documents embeddings faq_entries golden_records knowledge_bases insurance_products read_requests wiki_releases eval_items pack_budgets".split()


class _Lazy(dict):
    def __init__(self, spark, d):
        super().__init__((t, None) for t in TABLES)
        self.at = spark, d

    def __getitem__(self, t):
        return table(*self.at, t)


def statement(name: str, sql: str, other: str | None = None) -> None:
    query(name, other or sql)(lambda spark, d, sql=sql: run(spark, sql, _Lazy(spark, d)))


R2 = lambda x: f"round(sum({x}), 2)"

statement("sql_pricing_summary", """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_quantity), 6) AS avg_qty, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus""")
statement("sql_join_inner", """SELECT n_name, count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name""")
statement("sql_join_left_count", """SELECT c.c_custkey, count(o.o_orderkey) AS n_orders FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_totalprice > 100000 GROUP BY c.c_custkey""")
statement("sql_join_full", """SELECT coalesce(c.k, s.k) AS nationkey, c.n AS customers, s.n AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY c_nationkey) c FULL OUTER JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY s_nationkey) s ON c.k = s.k""")
statement("sql_join_right", """SELECT n_name, s_name FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey""")
statement("sql_join_cross_small", """SELECT r_name, budget, capacity_tokens FROM region CROSS JOIN pack_budgets""")
statement("sql_semi_exists", """SELECT o_orderpriority, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_discount > 0.08) GROUP BY o_orderpriority""")
statement("sql_anti_not_exists", """SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS avg_bal FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) GROUP BY c_mktsegment""")
statement("sql_in_subquery", """SELECT p_brand, count(*) AS n FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45) GROUP BY p_brand""")
statement("sql_between_in", """SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice BETWEEN 50000 AND 150000 AND o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY o_orderstatus""")
statement("sql_like_order_limit", """SELECT p_partkey, p_name FROM part WHERE p_type LIKE '%STEEL%' OR p_name LIKE '%a%' ORDER BY p_retailprice DESC, p_partkey LIMIT 50""")
statement("sql_case_coalesce", """SELECT CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band, count(*) AS n, coalesce(round(min(c_acctbal), 2), 0) AS least FROM customer GROUP BY CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END""")
statement("sql_having", """SELECT l_orderkey, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 200""")
statement("sql_cte", """WITH big AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey), top AS (SELECT * FROM big WHERE total > 1000000) SELECT c_name, total FROM top JOIN customer ON c_custkey = o_custkey""")
statement("sql_derived_table", """SELECT seg, max(n) AS most FROM (SELECT c_mktsegment AS seg, c_nationkey, count(*) AS n FROM customer GROUP BY c_mktsegment, c_nationkey) t GROUP BY seg""")
statement("sql_scalar_subquery", """SELECT count(*) AS n FROM part WHERE p_retailprice > (SELECT avg(p_retailprice) FROM part)""")
statement("sql_union_distinct", """SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier""")
statement("sql_union_all", """SELECT 'customer' AS kind, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part""")
statement("sql_intersect", """SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 40 INTERSECT SELECT l_partkey FROM lineitem WHERE l_discount > 0.07""")
statement("sql_except", """SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders""")
statement("sql_rollup", """SELECT l_returnflag, l_linestatus, grouping(l_returnflag) + grouping(l_linestatus) AS level, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
statement("sql_cube", """SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
statement("sql_grouping_sets", """SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_size), ())""")
statement("sql_window_rank", """SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rk, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS drk, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders""")
statement("sql_window_lag_lead", """SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS after FROM orders""")
statement("sql_window_running", """SELECT l_orderkey, l_linenumber, round(sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running, round(avg(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS around FROM lineitem""")
statement("sql_window_ntile", """SELECT p_partkey, ntile(4) OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS quarter, round(percent_rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice), 6) AS pr, round(cume_dist() OVER (PARTITION BY p_brand ORDER BY p_retailprice), 6) AS cd FROM part""")
statement("sql_window_first_last", """SELECT DISTINCT o_custkey, first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS first_order, first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS last_order FROM orders""")
statement("sql_count_distinct", """SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders_n FROM lineitem GROUP BY l_suppkey""")
statement("sql_stats", """SELECT p_brand, round(stddev_pop(p_retailprice), 6) AS sd, round(var_samp(p_retailprice), 4) AS v, round(corr(p_size, p_retailprice), 6) AS c FROM part GROUP BY p_brand""")
statement("sql_percentile", """SELECT o_orderpriority, round(percentile(o_totalprice, 0.5), 4) AS med, round(percentile(o_totalprice, 0.9), 4) AS p90 FROM orders GROUP BY o_orderpriority""", """SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.5), 4) AS med, round(quantile_cont(o_totalprice, 0.9), 4) AS p90 FROM orders GROUP BY o_orderpriority""")
statement("sql_filter_agg", """SELECT l_shipyear, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) FILTER (WHERE l_discount > 0.05) AS discounted FROM (SELECT year(l_shipdate) AS l_shipyear, l_returnflag, l_discount FROM lineitem) t GROUP BY l_shipyear""")
statement("sql_pivot", """SELECT * FROM (SELECT o_orderpriority, o_orderstatus, o_orderkey FROM orders) PIVOT (count(o_orderkey) FOR o_orderstatus IN ('F' AS f, 'O' AS o, 'P' AS p))""", """SELECT o_orderpriority, nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS f, nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS o, nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS p FROM orders GROUP BY 1""")
statement("sql_unpivot", """SELECT p_partkey, attr, val FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part) UNPIVOT (val FOR attr IN (size, price))""")
statement("sql_lateral_top", """SELECT c_custkey, t.o_orderkey, t.o_totalprice FROM customer JOIN LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) t""", """SELECT c_custkey, t.o_orderkey, t.o_totalprice FROM customer, LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 2) t""")
statement("sql_date_functions", """SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n, min(datediff(DATE '2000-01-01', CAST(o_orderdate AS DATE))) AS least_days FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""", """SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n, min(datediff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01')) AS least_days FROM orders GROUP BY 1, 2""")
statement("sql_json_extract", """SELECT event_type, count(get_json_object(props, '$.k')) AS with_k, sum(CAST(get_json_object(props, '$.k') AS BIGINT)) AS sum_k FROM events GROUP BY event_type""", """SELECT event_type, count(json_extract_string(props, '$.k')) AS with_k, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS sum_k FROM events GROUP BY event_type""")
statement("sql_array_functions", """SELECT id, size(similar_questions) AS n, array_contains(answers, 'No.') AS says_no, array_join(array_sort(array_distinct(transform(similar_questions, x -> substring(x, 1, 5)))), '|') AS heads FROM (SELECT DISTINCT id, similar_questions, answers FROM faq_entries) t WHERE size(similar_questions) > 0 AND answers IS NOT NULL""", """SELECT id, len(similar_questions)::INT AS n, CASE WHEN list_contains(answers, 'No.') THEN true WHEN len(list_filter(answers, lambda x: x IS NULL)) > 0 THEN NULL ELSE false END AS says_no, array_to_string(list_sort(list_distinct(list_transform(similar_questions, lambda x: substring(x, 1, 5)))), '|') AS heads FROM (SELECT DISTINCT id, similar_questions, answers FROM faq_entries) t WHERE len(similar_questions) > 0 AND answers IS NOT NULL""")
statement("sql_explode", """SELECT tag_name, count(*) AS n FROM (SELECT DISTINCT id, tag_name, similar_questions FROM faq_entries) t LATERAL VIEW explode(similar_questions) q AS question GROUP BY tag_name""", """SELECT tag_name, count(*) AS n FROM (SELECT tag_name, unnest(similar_questions) AS question FROM (SELECT DISTINCT id, tag_name, similar_questions FROM faq_entries)) GROUP BY tag_name""")
statement("sql_offset_page", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40""")
statement("sql_values", """SELECT k, v FROM VALUES (1, 'a'), (2, 'b') AS t(k, v)""", """SELECT k, v FROM (VALUES (1, 'a'), (2, 'b')) AS t(k, v)""")
statement("sql_range_join", """SELECT e.event_id, count(*) AS n FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') e JOIN events f ON f.user_id = e.user_id AND f.ts >= e.ts - INTERVAL 1 HOUR AND f.ts < e.ts GROUP BY e.event_id""")
statement("sql_nulls", """SELECT count(*) AS n, count(filing_no) AS with_filing, count(DISTINCT owner) AS owners, sum(CASE WHEN owner IS NULL AND filing_no IS NULL THEN 1 ELSE 0 END) AS neither FROM insurance_products""")
