from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftgraph.operators.ids import (
    check_intervals,
    commit_batches,
    commit_counts,
    key_order_ids,
    next_segment,
    scan_ids,
)
from weftgraph.sources.shared import new_dir


def _ids(spark, keys, partitions, first=1):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k bigint, n int")
    numbered = key_order_ids(df.repartition(partitions), "k", first, new_dir(spark, "ids"))
    return sorted((r["_vid"], r["k"], r["n"]) for r in numbered.collect())


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ids_follow_the_key_whatever_the_partitioning(spark, partitions):
    keys = list(range(500))
    random.Random(1).shuffle(keys)
    assert [(v, k) for v, k, _ in _ids(spark, keys, partitions, 10)] == [
        (10 + k, k) for k in range(500)
    ]


def test_null_and_repeated_keys_get_an_id_each(spark):
    rows = _ids(spark, [5, None, 5, 1, None, 5], 4)
    assert [v for v, _, _ in rows] == [1, 2, 3, 4, 5, 6]
    assert [k for _, k, _ in rows] == [None, None, 1, 5, 5, 5]
    assert sorted(n for _, _, n in rows) == list(range(6))


def test_a_hot_key_is_cut_over_partitions(spark, no_small_data_plans):
    """All rows but a few share one key, and are copies of each other."""
    df = spark.range(20000).select(
        F.when(F.col("id") < 50, F.col("id")).otherwise(F.lit(99)).alias("k")
    )
    staging = new_dir(spark, "ids")
    numbered = key_order_ids(df, "k", 1, staging)
    assert numbered.select("_vid").distinct().count() == 20000
    assert numbered.agg(F.min("_vid"), F.max("_vid")).first()[:] == (1, 20000)
    sizes = spark.read.parquet(staging).groupBy(F.shiftright("_wg_row", 33)).count()
    assert sizes.agg(F.max("count")).first()[0] < 20000 / 3


def test_empty_source(spark):
    assert _ids(spark, [], 2) == []


def test_scan_ids_are_unique_and_start_a_segment(spark):
    assert next_segment(1) == 1 << 33
    assert next_segment(1 << 33) == 1 << 33
    assert next_segment((1 << 33) + 1) == 2 << 33
    df = scan_ids(spark.range(1000).repartition(7), 1 << 33)
    assert df.select("_vid").distinct().count() == 1000
    assert df.agg(F.min("_vid")).first()[0] >= 1 << 33


def _commits_by_counting(n, t, g):
    """The counters as a loop: commit at each full batch, then once at the end."""
    tx_commits = graph_commits = in_tx = in_graph = 0
    for _ in range(n):
        in_tx += 1
        if in_tx == t:
            in_tx, tx_commits, in_graph = 0, tx_commits + 1, in_graph + 1
            if in_graph == g:
                in_graph, graph_commits = 0, graph_commits + 1
    return tx_commits + 1, graph_commits + 1


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 60), st.integers(1, 9), st.integers(1, 6))
def test_commit_counts(spark, n, t, g):
    row = commit_counts(spark.range(n), t, g).first()
    assert (row["tx_commits"], row["graph_commits"]) == _commits_by_counting(n, t, g)


def test_batch_numbers(spark):
    rows = commit_batches(spark.range(1, 11), F.col("id"), 3, 2).orderBy("id").collect()
    assert [r["tx_batch"] for r in rows] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4]
    assert [r["graph_batch"] for r in rows] == [1] * 6 + [2] * 4


@pytest.mark.parametrize("bad", [0, -1, 1.5, "10", True, None])
def test_intervals_must_be_positive_integers(bad):
    with pytest.raises(ValueError):
        check_intervals(bad, 1)
    with pytest.raises(ValueError):
        check_intervals(1, bad)


def test_repeated_keys_are_numbered_alike_however_the_source_is_split(spark, tmp_path):
    rows = [(i % 2, f"t{i}") for i in range(80)]
    df = spark.createDataFrame(rows, "k int, t string")
    found = []
    for n in (1, 3, 16):
        numbered = key_order_ids(df.repartition(n), "k", 1, str(tmp_path / f"sorted{n}"))
        found.append({r["t"]: r["_vid"] for r in numbered.collect()})
    assert found[0] == found[1] == found[2]
    assert sorted(found[0].values()) == list(range(1, 81))
