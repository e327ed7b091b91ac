"""Validation, error accounting and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog_sync.operators.dedup import union_rows
from catalog_sync.operators.joins import keep_unknown, key_set
from catalog_sync.operators.quality import (
    FAILED_RULE,
    check,
    childless,
    date_like,
    error_rows,
    error_samples,
    error_summary,
    key_audit,
    not_found,
    number_like,
    required,
    route,
    table_profile,
)
from catalog_sync.plans.registry import query, table
from catalog_sync.schemas import ERROR_CATEGORIES, ERROR_SAMPLE_SIZE

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _rules():
    return [
        required("title"), required("release_date"), date_like("release_date"),
        number_like("budget"),
    ]


def _texts(spark, d):
    """Orders as raw documents, each status with a defect of its own."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(priority != "1-URGENT", priority).alias("title"),
        F.when(status == "O", "").when(priority == "2-HIGH", "2020-02-30").otherwise(day).alias(
            "release_date"),
        F.when(priority == "3-MEDIUM", F.concat(F.col("o_custkey"), F.lit("x")))
        .when((priority == "5-LOW") & (status == "P"), "")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("budget"),
    )


_FAILED_SQL = """CASE WHEN o_orderpriority = '1-URGENT' THEN 'missing_title'
      WHEN o_orderpriority = '2-HIGH' AND o_orderstatus <> 'O' THEN 'bad_release_date'
      WHEN o_orderpriority = '3-MEDIUM' THEN 'bad_budget'
      WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'bad_budget' END"""


@query("validate_route", f"SELECT o_orderkey AS id, {_FAILED_SQL} AS failed_rule FROM orders")
def routed_orders(spark, d):
    valid, invalid = route(_texts(spark, d), _rules())
    return union_rows(invalid.select("id", FAILED_RULE), valid.select("id"))


def _errors(spark, d):
    """Error log over the orders: broken documents, orders without lines or returns, customers
    who were asked for and are not there."""
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    checked = check(_texts(spark, d), _rules()).filter(F.col(FAILED_RULE).isNotNull())
    returns = lines.filter(F.col("l_returnflag") == "R")
    on = {"o_orderkey": "l_orderkey"}
    return union_rows(
        error_rows(checked, "validation_error", "validate", "id", F.col(FAILED_RULE)),
        error_rows(childless(orders, lines, on), "no_credits", "shape", "o_orderkey"),
        error_rows(childless(orders, returns, on), "no_actors", "shape", "o_orderkey"),
        error_rows(_missing_customers(spark, d), "not_found", "details", "o_custkey"),
    )


def _missing_customers(spark, d):
    solvent = table(spark, d, "customer").filter(F.col("c_acctbal") >= 0)
    asked = key_set(table(spark, d, "orders"), ["o_custkey"])
    return keep_unknown(asked, solvent, {"o_custkey": "c_custkey"}, unique=True)


_ERRORS_SQL = f"""
  errors AS (
    SELECT 'validation_error' AS category, o_orderkey AS id FROM orders
      WHERE {_FAILED_SQL} IS NOT NULL
    UNION ALL SELECT 'no_credits', o_orderkey FROM orders
      WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'no_actors', o_orderkey FROM orders
      WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    UNION ALL SELECT 'not_found', o_custkey FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0))"""


@query(
    "error_summary",
    f"""WITH {_ERRORS_SQL}
       SELECT c.category, count(DISTINCT e.id) AS ids
       FROM (VALUES {', '.join(f"('{c}')" for c in ERROR_CATEGORIES)}) AS c(category)
       LEFT JOIN errors e ON e.category = c.category GROUP BY c.category""",
)
def order_error_summary(spark, d):
    return error_summary(_errors(spark, d))


@query(
    "error_samples",
    f"""WITH {_ERRORS_SQL}, ids AS (SELECT DISTINCT category, id FROM errors),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY id) AS n FROM ids)
       SELECT category, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS sample_ids
       FROM ranked
       WHERE n <= {ERROR_SAMPLE_SIZE} GROUP BY category""",
)
def order_error_samples(spark, d):
    ids = F.array_join(F.col("sample_ids").cast("array<string>"), ",")
    return error_samples(_errors(spark, d)).select("category", ids.alias("sample_ids"))


@query("error_not_found", f"WITH {_ERRORS_SQL} SELECT DISTINCT id FROM errors "
                          "WHERE category = 'not_found'")
def customers_not_found(spark, d):
    return not_found(_errors(spark, d))


@query(
    "not_found_removed",
    """SELECT DISTINCT 'not_found' AS category, o_custkey AS id FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
       UNION ALL
       SELECT 'removed_movies', c_custkey FROM customer
       WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
)
def not_found_removed(spark, d):
    customers = table(spark, d, "customer")
    source = table(spark, d, "orders").filter(F.col("o_orderstatus") == "F")
    removed = keep_unknown(customers, source, {"c_custkey": "o_custkey"})
    return union_rows(
        error_rows(_missing_customers(spark, d), "not_found", "details", "o_custkey"),
        error_rows(removed, "removed_movies", "refresh", "c_custkey"),
    ).select("category", "id")


_TYPE_SQL = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
    WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
    WHEN 'FLOAT[]' THEN 'array<float>' ELSE data_type END"""


@query(
    "table_profile",
    f"""WITH counts AS (
         {' UNION ALL '.join(f"SELECT '{t}' AS t, count(*) AS n FROM {t}" for t in _TABLES)})
       SELECT table_name, CAST(ordinal_position AS BIGINT) AS position, column_name,
         {_TYPE_SQL} AS data_type, n AS row_count
       FROM information_schema.columns JOIN counts ON table_name = t""",
)
def profile(spark, d):
    return table_profile({t: table(spark, d, t) for t in _TABLES})


@query(
    "key_audit",
    """SELECT 'orders' AS table_name, 'unique(o_orderkey)' AS check, count(*) AS violations
       FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
       UNION ALL
       SELECT 'lineitem', 'unique(l_orderkey,l_linenumber)', count(*)
       FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
       UNION ALL
       SELECT 'lineitem', 'l_orderkey->orders.o_orderkey', count(*) FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
       UNION ALL
       SELECT 'labels', 'doc_id->documents.doc_id', count(*) FROM labels
       WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'fr')""",
)
def audit(spark, d):
    tables = {t: table(spark, d, t) for t in ("orders", "lineitem", "labels", "documents")}
    tables["documents"] = tables["documents"].filter(F.col("lang") != "fr")
    return key_audit(
        tables,
        {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]},
        {
            "lineitem": [("l_orderkey", "orders", "o_orderkey")],
            "labels": [("doc_id", "documents", "doc_id")],
        },
    )
