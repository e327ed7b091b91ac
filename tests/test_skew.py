"""A third of all rows share one key: the joins must split it, the result must stay whole."""

import pytest
from pyspark.sql import functions as F

from catalog_sync.operators.joins import enrich, keep_known, keep_unknown
from catalog_sync.operators.quality import duplicate_keys, error_samples, error_summary
from catalog_sync.operators.upsert import replace_children

ROWS, KEYS = 120_000, 2_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(autouse=True)
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def children(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % KEYS)
    return spark.range(0, ROWS, 1, 8).select(
        key.alias("movie_id"), "id", F.sha2(F.col("id").cast("string"), 256).alias("payload"))


@pytest.fixture
def parents(spark):
    return spark.range(0, KEYS // 2, 1, 4).withColumn("name", F.lit("x"))


def expected(keep):
    keys = (7 if i % 3 == 0 else i % KEYS for i in range(ROWS))
    return sum(1 for k in keys if keep(k))


@pytest.mark.parametrize("join, keep", [
    (lambda c, p: keep_known(c, p, {"movie_id": "id"}, unique=True), lambda k: k < KEYS // 2),
    (lambda c, p: keep_unknown(c, p.filter("id <> 7"), {"movie_id": "id"}, unique=True),
     lambda k: k >= KEYS // 2 or k == 7),
    (lambda c, p: enrich(c.drop("id"), p, {"movie_id": "id"}), lambda k: k < KEYS // 2),
    (lambda c, p: enrich(c.drop("id"), p, {"movie_id": "id"}, "left"), lambda k: True),
    (lambda c, p: replace_children(
        c, p.filter("id <> 7"), c.filter("movie_id = 1"), "movie_id", "id").filter("movie_id <> 1"),
     lambda k: k >= KEYS // 2 or k == 7),
])
def test_hot_key_is_split(children, parents, join, keep):
    df = join(children, parents)
    assert len(df.collect()) == expected(keep)
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_groups_are_aggregated_before_the_shuffle(spark, children):
    for df in (duplicate_keys(children, ["movie_id"]),
               error_summary(children.select(F.lit("timeout").alias("category"), "id"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan_side = plan[plan.rindex("Exchange hashpartitioning"):]
        assert "HashAggregate" in scan_side
    log = children.select(F.lit("timeout").alias("category"), "id")
    assert error_summary(log).filter("category = 'timeout'").first().ids == ROWS
    assert error_samples(log).first().sample_ids == list(range(10))
