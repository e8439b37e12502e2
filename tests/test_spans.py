"""Ids looked up in spans: equal to a plain search, and evenly spread."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from weftgraph.operators.resolve import mark_dangling, span_of
from weftgraph.plans.jobs import init_vertex, load_vertices


@pytest.mark.parametrize("seed", range(4))
def test_lookup_equals_a_plain_search(spark, seed):
    rng = random.Random(seed)
    spans, at = [], rng.choice([1, 1 << 33, -500])
    for _ in range(rng.choice([1, 7, 300])):
        at += rng.choice([1, 2, 5, 1 << 20, 1 << 34])
        spans.append((at, at + rng.choice([0, 1, 9, 1000])))
        at = spans[-1][1] + 1
    values = [v for lo, hi in spans for v in (lo - 1, lo, (lo + hi) // 2, hi, hi + 1)]
    values += [None, 0, -1, 2**62]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, vid bigint")
    existing = sum(hi - lo + 1 for lo, hi in spans)
    found = span_of(df, F.col("vid"), spark.createDataFrame(spans, "lo bigint, hi bigint"), existing, "span")
    holds = lambda v: next((lo for lo, hi in spans if v is not None and lo <= v <= hi), None)
    assert {r["n"]: r["span"] for r in found.collect()} == {i: holds(v) for i, v in enumerate(values)}


def test_no_spans(spark):
    df = spark.createDataFrame([(1,), (None,)], "vid bigint")
    found = span_of(df, F.col("vid"), spark.createDataFrame([], "lo bigint, hi bigint"), 0, "span")
    assert [r["span"] for r in found.collect()] == [None, None]


def test_many_spans_in_one_segment_are_looked_up_in_even_shares(spark, no_small_data_plans):
    # 10,000 dense loads of 100 ids with gaps between them, and a million keys.
    spans = spark.range(10_000).select((F.col("id") * 150 + 1).alias("lo"), (F.col("id") * 150 + 100).alias("hi"))
    keys = spark.range(0, 1_000_000, 1, 8).select((F.col("id") * 3 % 1_500_000).alias("vid"))
    found = span_of(keys, F.col("vid"), spans, 1_000_000, "span").cache()
    by_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(by_task) == 8 and max(by_task) <= 3 * sorted(by_task)[4]
    wrong = found.where(F.col("span").isNotNull() != ((F.col("vid") > 0) & ((F.col("vid") - 1) % 150 < 100)))
    assert wrong.count() == 0 and found.count() == 1_000_000
    found.unpersist()


def test_dense_and_scan_loads_together(spark, store, work, no_small_data_plans):
    rows = spark.range(0, 4000, 1, 4).selectExpr("id", "cast(id as string) name")
    init_vertex(store, "A", rows)
    for n, order in enumerate(["key", "scan", "key", "scan"]):
        load_vertices(store, "A", rows, "id", f"{work}/map{n}", id_order=order)
    vids = {r["_vid"] for r in store.vertices("A").select("_vid").collect()}
    asked = sorted(vids | {v + d for v in vids for d in (-1, 1)}) + [None]
    df = spark.createDataFrame([(v,) for v in asked], "vid bigint").repartition(8)
    marked = mark_dangling(df, store)
    assert {r["vid"]: r["dangling"] for r in marked.collect()} == {v: v is not None and v not in vids for v in asked}
    by_task = [r["count"] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
    assert max(by_task) <= 3 * sorted(by_task)[len(by_task) // 2]
