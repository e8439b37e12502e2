"""Merging the postings of many loads into one run."""

from __future__ import annotations

import pytest

from weftgraph import compact_index, init_vertex, load_vertices
from weftgraph.errors import NotRegisteredError
from weftgraph.plans import jobs


def _loads(spark, store, work, n):
    rows = [(i, f"name{i % 3} common", float(i) if i % 2 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "k bigint, name string, w double")
    init_vertex(store, "P", df, ["name", "w"])
    for _ in range(n):
        load_vertices(store, "P", df, "k", f"{work}/map")
    return df


def _postings(store, prop):
    return sorted(tuple(r) for r in store.postings(store.index_name("P"), prop).collect())


def _runs(store, prop):
    return {f.rsplit("/", 2)[1] for f in store.postings(store.index_name("P"), prop).inputFiles()}


def test_one_run_is_read_and_results_are_equal(spark, store, work):
    df = _loads(spark, store, work, 6)
    before = {p: _postings(store, p) for p in ("name", "w")}
    assert len(_runs(store, "name")) == 6
    assert compact_index(store, "P") == 6
    assert {p: _postings(store, p) for p in before} == before
    assert len(_runs(store, "name")) == len(_runs(store, "w")) == 1
    assert compact_index(store, "P") == 0

    load_vertices(store, "P", df, "k", f"{work}/map")
    assert len(_runs(store, "name")) == 2
    assert len(_postings(store, "name")) == 7 * 80 and len(_postings(store, "w")) == 7 * 20
    assert compact_index(store, "P") == 2
    assert len(_postings(store, "name")) == 7 * 80


def test_a_frequent_word_is_cut_and_every_task_is_sorted(spark, store, work, no_small_data_plans):
    _loads(spark, store, work, 5)
    compact_index(store, "P")
    run = store.postings(store.index_name("P"), "name")
    files = [spark.read.orc(f) for f in run.inputFiles()]
    common = [f.where("token = 'common'").count() for f in files]
    assert sum(common) == 200 and max(common) < 200
    for f in files:
        rows = [tuple(r) for r in f.collect()]
        assert rows == sorted(rows)


def test_a_merge_that_dies_changes_nothing(spark, store, work, monkeypatch):
    _loads(spark, store, work, 3)
    before = _postings(store, "name")

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(jobs, "_index_load", die)
        with pytest.raises(RuntimeError):
            compact_index(store, "P")
    store.refresh()
    assert _postings(store, "name") == before and len(_runs(store, "name")) == 3
    assert compact_index(store, "P") == 3
    assert _postings(store, "name") == before


def test_an_incomplete_index_is_built_anew(spark, store, work, monkeypatch):
    _loads(spark, store, work, 2)
    before = _postings(store, "name")
    with monkeypatch.context() as incomplete:
        incomplete.setattr(store, "index_complete", lambda index: False)
        assert store.postings(store.index_name("P"), "name") is None
        assert compact_index(store, "P") == 2
    assert _postings(store, "name") == before and len(_runs(store, "name")) == 1
    with pytest.raises(NotRegisteredError):
        compact_index(store, "None")
