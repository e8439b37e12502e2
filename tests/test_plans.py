"""Shape of the plans: what is pushed down, what is never there."""

from __future__ import annotations

import ast
import pathlib

import pytest
from pyspark.sql import functions as F

import weftgraph
from weftgraph import init_edge, init_vertex, load_vertices
from weftgraph.operators.ids import key_order_ids, scan_ids
from weftgraph.operators.index import token_postings
from weftgraph.operators.resolve import (
    Endpoints,
    edges_with_keys,
    key_counts,
    map_lookup,
    mark_dangling,
    resolved_edges,
)
from weftgraph.operators.skew import hot_keys
from weftgraph.operators.textmatch import first_text_match
from weftgraph.sources.tables import read_primary_key_map, scan

PACKAGE = pathlib.Path(weftgraph.__file__).parent


def _plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def _calls():
    """Calls in the graph loader; the optional ``llm`` folder has its own rules."""
    for path in PACKAGE.rglob("*.py"):
        if "llm" in path.relative_to(PACKAGE).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute):
                yield path.name, node.func.attr


def test_no_row_work_outside_spark():
    banned = {
        "toLocalIterator", "toPandas", "localCheckpoint", "foreach", "foreachPartition", "rdd",
        "udf", "pandas_udf", "applyInPandas", "mapInPandas", "mapPartitions", "persist", "cache",
    }
    assert not [c for c in _calls() if c[1] in banned]


def test_only_the_registry_is_collected():
    places = {name for name, attr in _calls() if attr == "collect"}
    assert places == {"store.py"}


@pytest.fixture
def edges(spark, tmp_path):
    path = str(tmp_path / "edges")
    spark.range(1000).selectExpr(
        "id % 3 AS a", "id AS b", "string(id) AS note", "double(id) AS w"
    ).write.orc(path)
    return scan(spark, path)


def test_key_filter_and_columns_reach_the_scan(edges):
    plan = _plan(key_counts(edges_with_keys(edges, "a", "b"), "a"))
    assert "PushedFilters: [IsNotNull(a), IsNotNull(b)]" in plan
    assert "ReadSchema: struct<a:bigint,b:bigint>" in plan


def test_map_lookup_shuffles_each_side_once(spark, edges, tmp_path, no_small_data_plans):
    saved = str(tmp_path / "map")
    spark.range(3).selectExpr("id AS k", "id + 1 AS v").write.orc(saved)
    plan = _plan(map_lookup(key_counts(edges, "a"), read_primary_key_map(spark, saved)))
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 2


def test_scan_order_has_no_shuffle_and_key_order_has_one(spark, edges, tmp_path):
    assert "Exchange" not in _plan(scan_ids(edges, 0))
    plan = _plan(key_order_ids(edges, "b", 1, str(tmp_path / "sorted")))
    assert "rangepartitioning" not in plan  # done, and staged


def test_only_columns_asked_for_are_read(spark, store, edges):
    init_vertex(store, "V", edges)
    load_vertices(store, "V", edges, "b", f"{store.root}/map", id_order="key")
    plan = _plan(store.vertices("V").where("b = 5").select("_vid"))
    assert "ReadSchema: struct<_vid:bigint,b:bigint>" in plan
    assert "EqualTo(b,5)" in plan
    marked = _plan(mark_dangling(spark.range(5).withColumnRenamed("id", "vid"), store))
    assert "Scan orc" not in marked and "Join" not in marked


def test_edge_join_has_no_nested_loop_and_broadcasts_hot_keys_only(
    spark, store, edges, no_small_data_plans
):
    def ends(key):
        counts = key_counts(edges, key)
        table = counts.selectExpr("key", "n_edges", "key AS vid", "'map' AS via")
        return Endpoints(table, hot_keys(counts, "key", "n_edges"), 0)

    init_edge(store, "E", edges)
    plan = _plan(resolved_edges(edges, "a", "b", ends("a"), ends("b")))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "_wg_salt" in plan
    tree = plan.split("\n\n")[0]
    assert tree.count("SortMergeJoin") == 2
    assert tree.count("BroadcastHashJoin") == 2  # splits of a's hot keys, once per side


def test_word_search_is_all_equi_joins(spark, work, no_small_data_plans):
    vertices = spark.range(200).selectExpr(
        "id AS _vid", "concat('the w', id % 7, ' x', id % 5, ' y', id % 3) AS t"
    )
    keys = spark.range(30).selectExpr("concat('the w', id % 9, ' x', id % 5) AS key").distinct()
    found = first_text_match(keys, token_postings(vertices, "t"), work)
    plan = _plan(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert found.where(F.col("vid").isNull()).count() == 0
