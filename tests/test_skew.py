"""Exact results when one key holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from perkline.operators import dedup


def _skewed(spark, n=30000):
    # a third of the rows on key 'hot', the rest spread over 10k keys;
    # inside 'hot', every 100 rows share an order value (ties on the order)
    return spark.range(n).select(
        F.col("id").alias("rid"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 10000).cast("string"))).alias("k"),
        (F.col("id") % 100).alias("v"),
    ).repartition(16)


def test_keep_one_and_split_exact_under_a_hot_key(spark):
    df = _skewed(spark)
    kept = dedup.keep_one_per_group(df, ["k"], [("v", "desc"), ("rid", "desc")])
    hot = kept.filter(F.col("k") == "hot").first()
    # max v is 99 among ids % 3 == 0 with id % 100 == 99 -> the greatest such id
    expected = max(i for i in range(30000) if i % 3 == 0 and i % 100 == 99)
    assert (hot["v"], hot["rid"]) == (99, expected)
    assert kept.count() == df.select("k").distinct().count()
    winners, losers = dedup.split_one_per_group(df, ["k"], [("v", "desc"), ("rid", "desc")], "rid")
    assert winners.count() + losers.count() == 30000
    assert winners.filter(F.col("k") == "hot").count() == 1
    assert losers.filter(F.col("k") == "hot").count() == 9999


def test_group_size_exact_under_a_hot_key(spark):
    df = _skewed(spark)
    sized = dedup.with_group_size(df, ["k"])
    assert sized.filter(F.col("k") == "hot").select("n_group").distinct().collect()[0][0] == 10000
    assert sized.count() == 30000
    assert dedup.duplicated_groups(df, ["k"]).count() == 30000  # every group has > 1 row here


def test_pick_is_a_partial_aggregate(spark):
    df = _skewed(spark)
    plan = dedup.keep_one_per_group(df, ["k"], [("v", "desc")])._jdf.queryExecution().executedPlan().toString()
    # the partial (map-side) aggregate sits below the exchange: each task sends one row per key
    assert plan.count("SortAggregate") + plan.count("HashAggregate") >= 2


def test_a_hot_keys_rows_spread_when_its_size_joins_back(spark):
    df = _skewed(spark, 60000).withColumn("pad", F.col("rid"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sized = dedup.with_group_size(df, ["k"]).withColumn("task", F.spark_partition_id())
        per_task = sized.filter(F.col("k") == "hot").groupBy("task").count().agg(F.max("count"), F.count("*")).first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert per_task[1] >= 12 and per_task[0] <= 20000 / 4, per_task
