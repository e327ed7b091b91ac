"""Nested documents, derived row by row from the text tables, to relational rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog_sync.functions import or_default
from catalog_sync.operators.incremental import page_results
from catalog_sync.operators.shape import (
    cast_credits,
    crew_credits,
    explode_children,
    first_by_position,
    first_match,
    genre_string,
    usable_id,
)
from catalog_sync.plans.queries.landing import (
    CAST_SQL,
    CREW_SQL,
    LINES_SQL,
    cast_array,
    crew_array,
)
from catalog_sync.plans.registry import query, table


@query(
    "project_parent",
    """SELECT o_orderkey AS id, o_orderpriority AS title, o_orderstatus AS status,
         o_orderdate AS released, o_totalprice AS budget,
         CAST(NULL AS VARCHAR) AS backdrop_path FROM orders""",
)
def project_parent(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("released"),
        F.col("o_totalprice").alias("budget"),
        F.lit(None).cast("string").alias("backdrop_path"),
    )


@query(
    "project_entity",
    """SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS gender,
         CASE WHEN s_acctbal < 0 THEN 'Unknown' ELSE 'Supplies' END AS known_for_department
       FROM supplier""",
)
def project_entity(spark, d):
    return table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("bigint").alias("gender"),
        or_default(F.when(F.col("s_acctbal") >= 0, F.lit("Supplies")), "Unknown").alias(
            "known_for_department"
        ),
    )


@query(
    "cast_credits",
    f"""
    WITH {LINES_SQL}, {CAST_SQL}
    SELECT movie_id, person_id, 'cast' AS credit_type, name AS character_name,
      pos - 1 AS credit_order, 'Acting' AS department, 'Actor' AS job
    FROM kept_cast""",
)
def cast_rows(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("movie_id"), cast_array())
    return explode_children(docs, "movie_id", cast_credits(F.col("cast")))


@query(
    "crew_credits",
    f"""
    WITH {LINES_SQL}, {CREW_SQL}
    SELECT movie_id, person_id, 'crew' AS credit_type, CAST(NULL AS VARCHAR) AS character_name,
      CAST(NULL AS BIGINT) AS credit_order, coalesce(department, 'Directing') AS department,
      'Director' AS job
    FROM lead_crew WHERE person_id IS NOT NULL AND person_id <> 0""",
)
def crew_rows(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("movie_id"), crew_array())
    return explode_children(docs, "movie_id", crew_credits(F.col("crew")))


@query(
    "usable_ids",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
       WHERE l_suppkey IS NOT NULL AND l_suppkey <> 0""",
)
def usable_ids(spark, d):
    lines = table(spark, d, "lineitem").filter(usable_id(F.col("l_suppkey")))
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "explode_children",
    r"""
    SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS position,
      unnest(lines) AS name
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)""",
)
def exploded_lines(spark, d):
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("name")))
    return explode_children(table(spark, d, "documents"), "doc_id", lines, position="position")


@query(
    "top_n_children_nested",
    """
    SELECT doc_id, CAST(pos - 1 AS INTEGER) AS position, word
    FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
            generate_subscripts(string_split(text, ' '), 1) AS pos FROM documents)
    WHERE pos <= 8""",
)
def leading_words(spark, d):
    words = first_by_position(F.split("text", " "), 8)
    entries = F.transform(words, lambda w: F.struct(w.alias("word")))
    return explode_children(table(spark, d, "documents"), "doc_id", entries, position="position")


@query(
    "first_matching_child_nested",
    """
    SELECT doc_id, arg_min(line, pos) FILTER (WHERE length(line) >= 80) AS first_long_line
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
    GROUP BY doc_id""",
)
def first_long_line(spark, d):
    line = first_match(F.split("text", "\n"), lambda x: F.length(x) >= 80)
    return table(spark, d, "documents").select("doc_id", line.alias("first_long_line"))


@query(
    "json_field",
    "SELECT event_id, CAST(regexp_extract(props, '\"k\": (\\d+)', 1) AS BIGINT) AS k FROM events",
)
def json_field(spark, d):
    props = F.from_json("props", "k BIGINT")
    return table(spark, d, "events").select("event_id", props["k"].alias("k"))


@query(
    "page_explode",
    """
    WITH pages AS (
      SELECT conv_id, CAST(turn + 1 AS INTEGER) AS page, string_split(text, '. ') AS titles,
        max(turn) OVER (PARTITION BY conv_id) + 1 AS total_pages
      FROM conversations)
    SELECT conv_id, page, CAST(generate_subscripts(titles, 1) AS BIGINT) AS id,
      unnest(titles) AS title
    FROM pages WHERE page <= least(total_pages, 5)""",
)
def page_explode(spark, d):
    turns = table(spark, d, "conversations")
    totals = turns.groupBy("conv_id").agg((F.max("turn") + 1).alias("total_pages"))
    results = F.transform(
        F.split("text", r"\. "),
        lambda t, i: F.struct((i + 1).cast("bigint").alias("id"), t.alias("title")),
    )
    pages = turns.select("conv_id", (F.col("turn") + 1).cast("int").alias("page"),
                         results.alias("results"))
    return page_results(pages.join(totals, "conv_id"), 5, request=["conv_id"])


@query(
    "genre_string",
    """
    SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'No genres'
      ELSE replace(p_name, ' ', ', ') END AS genres
    FROM part""",
)
def genre_strings(spark, d):
    names = F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("name")))
    genres = F.when(F.col("p_type") != "PROMO", names)
    return table(spark, d, "part").select("p_partkey", genre_string(genres).alias("genres"))
