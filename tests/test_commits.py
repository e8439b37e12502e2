"""Ordinals, batches and counts of loads."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weftgraph.errors import NotRegisteredError
from weftgraph.operators.ids import ROW_BITS, graph_commits
from weftgraph.plans.jobs import commit_log, init_edge, init_vertex, load_edges, load_vertices, vertex_batches
from weftgraph.sources.shared import write_counted


def _plain_commits(n, t, g):
    """The commits of a loop over n elements: (elements, transactions) of each graph commit."""
    commits, held, txs, in_tx, in_graph = [], 0, 0, 0, 0
    for _ in range(n):
        held, in_tx = held + 1, in_tx + 1
        if in_tx == t:
            in_tx, txs, in_graph = 0, txs + 1, in_graph + 1
            if in_graph == g:
                commits.append((held, txs))
                held, txs, in_graph = 0, 0, 0
    return [*commits, (held, txs + 1)]


@pytest.mark.parametrize("step", [1 << 16, 2])
def test_commits_equal_a_counting_loop(spark, monkeypatch, step):
    from weftgraph.operators import ids

    monkeypatch.setattr(ids, "COMMITS_AT_ONCE", step)
    cases = [(n, t, g) for n in range(26) for t in (1, 2, 5) for g in (1, 3)]
    loads = spark.createDataFrame(
        [(f"{n}-{t}-{g}", n, t, g) for n, t, g in cases], "load_id string, rows bigint, tx_interval bigint, graph_interval bigint"
    )
    found = {}
    for r in graph_commits(loads).collect():
        found.setdefault(r["load_id"], []).append((r["graph_batch"], r["first_tx"], r["last_tx"], r["elements"]))
    for n, t, g in cases:
        expected, tx = [], 0
        for k, (elements, txs) in enumerate(_plain_commits(n, t, g)):
            expected.append((k + 1, tx + 1, tx + txs, elements))
            tx += txs
        assert sorted(found[f"{n}-{t}-{g}"]) == expected


def test_ordinals_of_scan_order_have_no_gaps_and_start_anew(spark, store, work):
    rows = spark.range(0, 1000, 1, 6).selectExpr("id", "cast(id % 10 as string) name")
    init_vertex(store, "A", rows)
    loads = [load_vertices(store, "A", rows, "id", f"{work}/map", tx_commit_interval=t) for t in (100, 7)]
    found = vertex_batches(store, "A").collect()
    for load, t in zip(loads, (100, 7)):
        own = sorted((r["_vid"], r["ordinal"], r["tx_batch"]) for r in found if r["load_id"] == load.load_id)
        assert [o for _, o, _ in own] == list(range(1, 1001))
        assert all(b == (o - 1) // t + 1 for _, o, b in own)
        assert len({v >> ROW_BITS for v, _, _ in own}) == 6
    with pytest.raises(NotRegisteredError):
        vertex_batches(store, "B")


def test_a_label_whose_later_load_has_more_columns(spark, store, work):
    first = spark.createDataFrame([(1,)], "id bigint")
    second = spark.createDataFrame([(2, "x")], "id bigint, more string")
    for rows in (first, second):
        init_vertex(store, "A", rows)
        load_vertices(store, "A", rows, "id", f"{work}/map", id_order="key")
    assert sorted((r["id"], r["more"], r["ordinal"]) for r in vertex_batches(store, "A").collect()) == [(1, None, 1), (2, "x", 1)]


def test_log_of_an_edge_load(spark, store, work):
    rows = spark.range(30).withColumnRenamed("id", "k")
    init_vertex(store, "A", rows)
    load_vertices(store, "A", rows, "k", f"{work}/map")
    pairs = rows.selectExpr("k", "k as other")
    init_edge(store, "E", pairs)
    load_edges(store, "E", pairs, "k", "k", "A", "A", "k", "k", f"{work}/map", f"{work}/map", tx_commit_interval=10, graph_tx_commit_interval=2)
    log = commit_log(store, "edge", "E").orderBy("graph_batch").collect()
    assert [(r["first_tx"], r["last_tx"], r["elements"]) for r in log] == [(1, 2, 20), (3, 4, 10)]
    assert commit_log(store, "edge", "none").collect() == []


def test_rows_are_counted_by_the_write_itself(spark, work):
    df = spark.range(0, 1000, 1, 5).where("id % 3 = 0")
    assert write_counted(df, f"{work}/a") == 334 == spark.read.orc(f"{work}/a").count()
    assert write_counted(df.where("false"), f"{work}/b") == 0
    joined = df.join(spark.range(2000), "id").repartition(3)
    assert write_counted(joined, f"{work}/c") == 334
    with pytest.raises(PySparkException):
        write_counted(df.select(F.raise_error(F.lit("injected")).alias("x")), f"{work}/d")


def test_a_load_reads_its_source_once(spark, store, work):
    counted = spark.sparkContext.accumulator(0)

    def seen(rows):
        for row in rows:
            counted.add(1)
            yield row

    init_edge(store, "E", spark.range(1).selectExpr("id as k", "id as other"))
    rows = spark.range(50).withColumnRenamed("id", "k")
    init_vertex(store, "A", rows)
    source = spark.createDataFrame(rows.rdd.mapPartitions(seen), "k bigint")
    load_vertices(store, "A", source, "k", f"{work}/map")
    assert counted.value == 50
