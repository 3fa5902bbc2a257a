from pyspark.sql import functions as F

from endpulse.operators.skew import lookup_join


def test_hot_and_missing_keys(spark):
    rows = spark.range(30000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id")))
        .alias("key"))
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k4", 3), ("unused", 4)], "key string, v int")
    # Small groups would be put together again, as they should.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lookup_join(rows, lookup, "key", "id")
        assert got.columns == ["key", "id", "v"]
        counts = {r.v: r["count"] for r in got.groupBy("v").count().collect()}
        assert counts == {1: 10000, 2: 1, 3: 1, None: 19998}
        # No task of the join gets more than a small part of the hot key's rows.
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 15000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_only_few_keys_can_be_hot(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 2500).cast("string").alias("key"))
    plan = lookup_join(rows, rows.select("key", F.lit(1).alias("v")).distinct(), "key", "id")
    assert plan.count() == 5000 and plan.where("v is null").count() == 0


def test_a_key_with_all_rows_is_spread_over_all_tasks(spark):
    """Groups follow the number of shuffle partitions."""
    rows = spark.range(32000).select("id", F.lit("k").alias("key"))
    lookup = spark.createDataFrame([("k", 1)], "key string, v int")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = lookup_join(rows, lookup, "key", "id")
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 32000 and max(sizes) < 4 * 32000 / 16
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_plan_holds_the_rows_once(spark):
    """Hot keys are counted beforehand, so their counts do not multiply the plan of the rows."""
    rows = spark.range(7000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key"))
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2)], "key string, v int")
    got = lookup_join(rows, lookup, "key", "id")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert {r.v: r["count"] for r in got.groupBy("v").count().collect()} == {1: 3500, 2: 1, None: 3499}


def test_rows_without_any_key(spark):
    lookup = spark.createDataFrame([("a", 1)], "key string, v int")
    rows = spark.range(50).select("id", F.lit(None).cast("string").alias("key"))
    assert lookup_join(rows, lookup, "key", "id").where("v is null").count() == 50
    assert lookup_join(rows.limit(0), lookup, "key", "id").count() == 0
