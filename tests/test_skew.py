"""Hot keys: same rows as a plain join, spread over partitions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftgraph.operators.skew import grid_join, hot_keys, salted_join


@pytest.fixture
def many(spark):
    """A third of the rows has key 0, another third a key nothing matches."""
    key = (
        F.when(F.col("id") % 3 == 0, 0)
        .when(F.col("id") % 3 == 1, -1)
        .otherwise(F.col("id") % 50)
    )
    return spark.range(3000).select("id", key.cast("bigint").alias("k"))


@pytest.fixture
def one(spark):
    return spark.range(50).select(F.col("id").alias("key"), (F.col("id") * 10).alias("v"))


def _counts(many):
    return many.groupBy(F.col("k").alias("key")).agg(F.count(F.lit(1)).alias("n"))


def test_hot_keys_are_few(spark, many):
    hot = {r["_wg_hot"]: r["_wg_splits"] for r in hot_keys(_counts(many), "key", "n").collect()}
    assert set(hot) == {0, -1}
    assert all(2 <= n <= 8 for n in hot.values())


def test_no_hot_keys(spark):
    even = spark.range(800).select((F.col("id") % 80).alias("k"))
    assert hot_keys(_counts(even), "key", "n") is None
    assert hot_keys(_counts(even.limit(0)), "key", "n") is None


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_gives_the_plain_join(many, one, how):
    hot = hot_keys(_counts(many), "key", "n")
    position = F.col("id")
    ours = salted_join(many, one, F.col("k"), "key", hot, position, how)
    plain = many.join(one, F.col("k") == F.col("key"), how).drop("key")
    assert ours.columns == plain.columns
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, plain.collect()))


def test_salted_join_spreads_the_hot_key(spark, many, one, no_small_data_plans):
    hot = hot_keys(_counts(many), "key", "n")
    joined = salted_join(many, one, F.col("k"), "key", hot, F.col("id"), "left")
    placed = joined.withColumn("p", F.spark_partition_id()).collect()
    assert len({r["p"] for r in placed if r["k"] == 0}) > 1
    assert len({r["p"] for r in placed if r["k"] == -1}) > 1


@pytest.mark.parametrize("heavy", ["left", "right", "both"])
def test_grid_join_gives_the_plain_join(spark, heavy):
    def side(n, hot_share, key, number):
        k = F.when(F.col("id") < n * hot_share, 0).otherwise(F.col("id") % 20)
        return spark.range(n).select(k.cast("bigint").alias(key), F.col("id").alias(number))

    left = side(400 if heavy != "right" else 30, 0.6 if heavy != "right" else 0.1, "a", "_wg_position")
    right = side(300 if heavy != "left" else 30, 0.6 if heavy != "left" else 0.1, "b", "_wg_order")
    counts = (
        left.groupBy(F.col("a").alias("key")).agg(F.count(F.lit(1)).alias("left_rows"))
        .join(right.groupBy(F.col("b").alias("key")).agg(F.count(F.lit(1)).alias("right_rows")), "key")
    )
    ours = grid_join(left, right, "a", "b", counts)
    plain = left.join(right, F.col("a") == F.col("b")).drop("b")
    assert sorted(ours.columns) == sorted(plain.columns)
    ours = ours.select(plain.columns)
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, plain.collect()))
