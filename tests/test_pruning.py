from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftgraph.operators import pruning, textmatch
from weftgraph.operators.index import token_postings
from weftgraph.operators.pruning import only_wanted
from weftgraph.operators.resolve import first_exact_match


def _plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture
def values(spark, tmp_path):
    path = str(tmp_path / "values")
    spark.range(3000).selectExpr("id % 1000 AS value", "id AS _vid", "'x' AS other").write.orc(path)
    return spark.read.orc(path).select("value", "_vid")


def test_few_keys_reach_the_scan(spark, values):
    kept = only_wanted(values, "value", spark.range(20).toDF("key"))
    assert kept.count() == 60
    plan = _plan(kept)
    assert "PushedFilters: [In(value" in plan and "Join" not in plan


def test_more_keys_are_broadcast_if_they_fit(spark, values):
    kept = only_wanted(values, "value", spark.range(600).toDF("key"))
    assert kept.count() == 1800
    plan = _plan(kept)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_too_many_keys_are_left_to_the_caller(spark, values, no_small_data_plans):
    assert only_wanted(values, "value", spark.range(600).toDF("key")) is None


def test_instants_are_not_taken_through_the_driver(spark):
    at = F.timestamp_millis(F.col("id") * 3_600_000)
    times = spark.range(100).select(at.alias("value"), F.col("id").alias("_vid"))
    kept = only_wanted(times, "value", times.where("_vid < 7").select("value"))
    assert "BroadcastHashJoin" in _plan(kept) and kept.count() == 7


@pytest.mark.parametrize("few,fits", [(500, True), (0, True), (0, False)])
def test_every_way_gives_the_same_matches(spark, values, tmp_path, monkeypatch, few, fits):
    monkeypatch.setattr(pruning, "FEW_KEYS", few)
    monkeypatch.setattr(pruning, "fits_broadcast", lambda spark, size: fits)
    keys = spark.range(990, 1010).toDF("key")
    exact = first_exact_match(keys, values).collect()
    assert {tuple(r) for r in exact} == {(k, k) for k in range(990, 1000)}

    texts = spark.range(300).selectExpr("id AS _vid", "concat('the n', id % 50, ' m', id % 7) AS t")
    wanted = spark.createDataFrame([("N3 m3 The",), ("m1",), ("n99 the",), ("n8",)], "key string")
    work = str(tmp_path / "work")
    words = textmatch.first_text_match(wanted, token_postings(texts, "t"), work).collect()
    assert {tuple(r) for r in words} == {("N3 m3 The", 3), ("m1", 1), ("n8", 8)}
