"""Vertices by id: only the loads that can hold the ids are listed."""

from __future__ import annotations

import pytest

from weftgraph.operators import lookup
from weftgraph.operators.lookup import vertices_with_ids
from weftgraph.plans.jobs import init_vertex, load_vertices


@pytest.fixture
def loads(spark, store, work):
    rows = spark.range(0, 300, 1, 3).selectExpr("id", "cast(id as string) name")
    init_vertex(store, "A", rows)
    orders = ["key", "scan", "key", "scan", "key"]
    done = [load_vertices(store, "A", rows, "id", f"{work}/map", id_order=o).load_id for o in orders]
    store.refresh()
    return done


def _ids_of(spark, store, load_ids):
    return sorted(r["_vid"] for r in store.vertices("A", set(load_ids)).select("_vid").collect())


def _files(df):
    return {f.split("/load=")[1].split("/")[0] for f in df.inputFiles()}


@pytest.mark.parametrize("few", [500, 3])
@pytest.mark.parametrize("chosen", [[0], [1], [2, 3], [0, 4], [0, 1, 2, 3, 4]])
def test_only_loads_that_hold_the_ids_are_listed(spark, store, loads, monkeypatch, few, chosen):
    monkeypatch.setattr(lookup, "FEW_KEYS", few)
    hold = [loads[i] for i in chosen]
    vids = [v for i in hold for v in _ids_of(spark, store, [i])[::50]]
    ids = spark.createDataFrame([(v,) for v in [*vids, *vids, None, -7, 1 << 61]], "vid bigint")
    found = vertices_with_ids(store, "A", ids)
    assert sorted(r["_vid"] for r in found.collect()) == sorted(vids)
    assert _files(found) == set(hold)


@pytest.mark.parametrize("few", [500, 0])
def test_ids_that_no_load_holds(spark, store, loads, monkeypatch, few):
    monkeypatch.setattr(lookup, "FEW_KEYS", few)
    ids = spark.createDataFrame([(-1,), (None,), (1 << 60,)], "vid bigint")
    found = vertices_with_ids(store, "A", ids)
    assert found.collect() == [] and not found.inputFiles() and "name" in found.columns
    assert vertices_with_ids(store, "B", ids) is None
