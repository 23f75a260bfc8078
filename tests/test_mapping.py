import pytest
from pyspark.sql import functions as F

from tillroll.operators.lookup import join_lookup, measured_bytes
from tillroll.operators.mapping import map_shops, shop_mapping


@pytest.fixture
def tables(spark):
    systems = spark.createDataFrame([(1, "s"), (2, "other")], "id int, code string")
    types = spark.createDataFrame([(5,), (6,)], "id int")
    codes = spark.createDataFrame(
        [("a", 10, 1, 5), ("a", 11, 1, 6), ("b", 12, 1, 5), ("c", 13, 2, 5), ("d", 14, 1, 9)],
        "code string, object_id int, external_system_id int, object_type_id int")
    return systems, types, codes


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_mapping_of_one_system(tables):
    assert rows(shop_mapping(*tables, "s")) == [("a", 10), ("a", 11), ("b", 12)]
    assert rows(shop_mapping(*tables, "s", object_type=5)) == [("a", 10), ("b", 12)]
    assert rows(shop_mapping(*tables, "s", unique=True)) == [("a", 11), ("b", 12)]
    assert rows(shop_mapping(*tables, "unknown")) == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("max_bytes", "join"), [(1 << 20, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_join_follows_the_measured_size(spark, max_bytes, join):
    left = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, n int")
    lookup = spark.createDataFrame([("x", "wide " * 10)], "k string, v string")
    assert measured_bytes(lookup) > 50
    joined = join_lookup(left, lookup, "k", "left", max_bytes)
    assert join in plan_of(joined)
    assert rows(joined.select("n", F.col("v").isNull())) == [(1, False), (2, True), (3, True)]
    with pytest.raises(ValueError, match="hot key"):
        join_lookup(left, lookup, "k", "full")


def test_hot_code_is_split_between_tasks(spark):
    """Above the broadcast limit, adaptive execution splits a code that a third of the rows carry."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        raw = spark.range(30_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("shop"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        mapping = spark.range(30_000).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("code"),
            F.col("id").alias("object_id"))
        mapped = map_shops(raw, mapping, "shop", max_bytes=0)
        found = mapped.collect()
        assert "skew=true" in plan_of(mapped)
        assert len(found) == 30_000
        assert all(row["__shop_id"] == (0 if row["shop"] == "hot" else int(row["shop"])) for row in found)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_codes_of_a_mapping_are_not_shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        table = lambda *columns: spark.range(5).toDF("n").select(*[F.col("n").alias(name) for name in columns])
        systems = table("id").withColumn("code", F.col("id").cast("string"))
        found = shop_mapping(systems, table("id"), table("code", "object_id", "external_system_id", "object_type_id"), "1")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_numeric_codes_are_compared_as_text(spark):
    raw = spark.createDataFrame([("7",), ("999x",), (None,)], "shop string")
    mapping = spark.createDataFrame([(7, 70)], "code int, object_id int")
    found = {row["shop"]: row["__shop_id"] for row in map_shops(raw, mapping, "shop").collect()}
    assert found == {"7": 70, "999x": None, None: None}
