"""A key that holds a third of the rows is split, and the result stays whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loyaltylens.operators import joins


@pytest.fixture
def skew_settings(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "60KB",
        # The code must not depend on it.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_member_is_split_in_the_flag_join(spark, skew_settings):
    facts = spark.range(0, 300_000, 1, 8).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id"))).alias("member"),
        F.lit("TY").alias("period"),
    )
    members = spark.createDataFrame([("hot", "TY"), ("m1", "TY"), ("m2", "LY")], "id string, period string")
    flagged = joins.flag_join(
        facts, members, {"member": "id", "period": "period"}, "member", "is_new", ["order_id"]
    )
    assert flagged.groupBy().agg(F.count(F.lit(1)), F.sum(F.col("is_new").cast("int"))).collect()[0] == (300_000, 100_001)
    flagged.write.format("noop").mode("overwrite").save()
    plan = flagged._jdf.queryExecution()
    flagged.collect()
    assert "skew=true" in plan.executedPlan().toString()


def test_missing_members_are_spread(spark):
    facts = spark.range(10_000).select(F.col("id").alias("order_id"), F.lit(None).cast("string").alias("member"))
    keys = facts.select(joins.spread_missing(F.col("member"), "order_id").alias("key"))
    assert keys.distinct().count() == 10_000


def test_hot_city_is_split_in_the_lookup_join(spark, skew_settings):
    facts = spark.range(0, 300_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("city"))
    lookup = spark.range(500).select(F.concat(F.lit("c"), F.col("id")).alias("name"), F.col("id").alias("value"))
    joined = joins.lookup_join(facts, lookup.unionAll(spark.createDataFrame([("hot", -1)], "name string, value bigint")), {"city": "name"})
    assert joined.filter("value = -1").count() == 100_000 and joined.count() == 300_000
    plan = joined._jdf.queryExecution()
    joined.collect()
    assert "skew=true" in plan.executedPlan().toString()


@pytest.fixture
def no_adaption(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows_per_task(df) -> list[int]:
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())


@pytest.mark.parametrize("hot", [None, "hot"])
def test_no_task_of_a_lookup_join_holds_a_hot_key(spark, no_adaption, hot):
    """A third of the facts has one city, or none: without any help of the engine, tasks stay even."""
    city = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("c"), F.col("id") % 500))
    facts = spark.range(0, 120_000, 1, 8).select("id", city.cast("string").alias("city"))
    lookup = spark.range(500).select(F.concat(F.lit("c"), F.col("id")).alias("name"), F.col("id").alias("value"))
    if hot:
        lookup = lookup.unionAll(spark.createDataFrame([(hot, -1)], "name string, value bigint"))
    joined = joins.lookup_join(facts, lookup, {"city": "name"}, tasks_per_key=1 if hot is None else 64)
    tasks = rows_per_task(joined)
    assert len(tasks) == 8 and tasks[-1] <= 2 * tasks[4]
    assert joined.columns == ["id", "city", "value"]
    found = joined.groupBy().agg(F.count(F.lit(1)), F.count("value"), F.count("city")).first()
    assert tuple(found) == (120_000, 80_000 if hot is None else 120_000, 80_000 if hot is None else 120_000)
