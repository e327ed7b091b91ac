"""Validation, routing, error accounting and audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.functions import is_date_text, parse_number
from catalog_sync.operators.dedup import top_n
from catalog_sync.operators.joins import On, keep_unknown, pairs
from catalog_sync.schemas import (
    CORRUPT,
    ERROR_CATEGORIES,
    ERROR_SAMPLE_SIZE,
    NUMERIC_FIELDS,
    REQUIRED_FIELDS,
)

FAILED_RULE = "failed_rule"


@dataclass(frozen=True)
class Rule:
    """A named predicate; a row for which it is not TRUE fails."""

    name: str
    ok: Column


def required(column: str) -> Rule:
    """The field is there. An empty string counts as there."""
    return Rule(f"missing_{column}", F.col(column).isNotNull())


def date_like(column: str) -> Rule:
    """A date, or nothing at all (NULL or empty)."""
    c = F.col(column)
    return Rule(f"bad_{column}", c.isNull() | (c == "") | is_date_text(c))


def number_like(column: str) -> Rule:
    """A number or NULL; an empty string is not a number."""
    c = F.col(column)
    return Rule(f"bad_{column}", c.isNull() | parse_number(c).isNotNull())


def movie_rules() -> list[Rule]:
    return [
        *[required(c) for c in REQUIRED_FIELDS],
        date_like("release_date"),
        *[number_like(c) for c in NUMERIC_FIELDS],
    ]


def first_failure(rules: Sequence[Rule]) -> Column:
    """Name of the first rule a row breaks, NULL for a clean row."""
    return F.coalesce(
        *[F.when(~F.coalesce(rule.ok, F.lit(False)), F.lit(rule.name)) for rule in rules]
    )


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.withColumn(FAILED_RULE, first_failure(rules))


def route(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows with the broken rule)."""
    checked = check(df, rules)
    failed = F.col(FAILED_RULE)
    return checked.filter(failed.isNull()).drop(FAILED_RULE), checked.filter(failed.isNotNull())


# --- error log ---------------------------------------------------------------


def error_rows(
    df: DataFrame, category: str | Column, stage: str, id_: str | Column, detail: Column | None = None
) -> DataFrame:
    """Long form of the error log: category, stage, id, detail."""
    return df.select(
        (F.lit(category) if isinstance(category, str) else category).alias("category"),
        F.lit(stage).alias("stage"),
        (F.col(id_) if isinstance(id_, str) else id_).cast("bigint").alias("id"),
        (F.lit(None).cast("string") if detail is None else detail).alias("detail"),
    )


def fetch_errors(docs: DataFrame, key: str, stage: str) -> DataFrame:
    """Failed fetches by their landing status, and lines the JSON reader could not take."""
    status = F.coalesce(F.col("fetch_status"), F.lit("ok"))
    category = F.when(F.col(CORRUPT).isNotNull(), "processing_error").when(
        status != "ok", F.when(status.isin(ERROR_CATEGORIES), status).otherwise("api_error")
    )
    rows = error_rows(docs, category, stage, key, F.coalesce(F.col(CORRUPT), F.col("fetch_status")))
    return rows.filter(F.col("category").isNotNull())


def category_frame(spark: SparkSession, categories: Sequence[str] = ERROR_CATEGORIES) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, categories))).alias("category"))


def error_summary(errors: DataFrame, categories: Sequence[str] = ERROR_CATEGORIES) -> DataFrame:
    """Distinct ids per category, every category listed."""
    counts = errors.groupBy("category").agg(F.count_distinct("id").alias("ids"))
    return (
        category_frame(errors.sparkSession, categories)
        .join(counts, "category", "left")
        .select("category", F.coalesce("ids", F.lit(0)).alias("ids"))
    )


def error_counts(errors: DataFrame, categories: Sequence[str] = ERROR_CATEGORIES) -> DataFrame:
    """The same with the errors that have no id, such as lines that could not be read."""
    counts = errors.groupBy("category").agg(
        F.count_distinct("id").alias("ids"), F.count_if(F.col("id").isNull()).alias("without_id")
    )
    return (
        category_frame(errors.sparkSession, categories)
        .join(counts, "category", "left")
        .select("category", F.coalesce("ids", F.lit(0)).alias("ids"), F.coalesce("without_id", F.lit(0)).alias("without_id"))
    )


def error_samples(errors: DataFrame, n: int = ERROR_SAMPLE_SIZE) -> DataFrame:
    """Up to ``n`` smallest ids per category. The ids are cut to ``n`` per category in every map
    task first, so a category holding most of the log stays small."""
    ids = errors.select("category", "id").dropna().distinct()
    sample = top_n(ids, ["category"], [F.col("id")], n)
    return sample.groupBy("category").agg(
        F.array_sort(F.collect_list("id")).alias("sample_ids")
    )


def not_found(errors: DataFrame) -> DataFrame:
    """Every id nobody could find, as rows."""
    return errors.filter(F.col("category") == "not_found").select("id").dropna().distinct()


# --- relational checks --------------------------------------------------------


def childless(parents: DataFrame, children: DataFrame, on: On) -> DataFrame:
    """Parents without any row among the children."""
    return keep_unknown(parents, children, on)


def orphans(children: DataFrame, parents: DataFrame, on: On) -> DataFrame:
    """Children whose (non-null) foreign key names no parent."""
    present = reduce(Column.__and__, [F.col(l).isNotNull() for l, _ in pairs(on)])
    return keep_unknown(children.filter(present), parents, on, unique=True)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def children_counts(
    children: DataFrame, parent_key: str, type_column: str, types: Mapping[str, str]
) -> DataFrame:
    """Per parent, how many children of each type (``{output column: type value}``)."""
    return children.groupBy(parent_key).agg(
        *[F.count_if(F.col(type_column) == v).alias(name) for name, v in types.items()]
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    frames = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, frames)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table column: position, type, and the row count of its table."""
    frames = []
    for name, df in tables.items():
        columns = F.array(
            *[
                F.struct(
                    F.lit(i).cast("bigint").alias("position"),
                    F.lit(c).alias("column_name"),
                    F.lit(t).alias("data_type"),
                )
                for i, (c, t) in enumerate(df.dtypes, 1)
            ]
        )
        frames.append(
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), F.inline(columns), "row_count"
            )
        )
    return reduce(DataFrame.union, frames)


def key_audit(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    foreign_keys: Mapping[str, Sequence[tuple[str, str, str]]],
) -> DataFrame:
    """Per key the number of key values held more than once, per foreign key the number of
    orphan rows."""
    count = F.count("*").alias("violations")
    frames = []
    for name, columns in keys.items():
        found = duplicate_keys(tables[name], columns).agg(count)
        frames.append(found.select(F.lit(name).alias("table_name"),
                                   F.lit(f"unique({','.join(columns)})").alias("check"),
                                   "violations"))
    for child, references in foreign_keys.items():
        for column, parent, parent_column in references:
            found = orphans(tables[child].select(column), tables[parent], {column: parent_column})
            frames.append(found.agg(count).select(
                F.lit(child).alias("table_name"),
                F.lit(f"{column}->{parent}.{parent_column}").alias("check"), "violations"))
    return reduce(DataFrame.union, frames)
