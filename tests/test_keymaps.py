"""The swap of a primary-key map, with a death at each of its steps."""

from __future__ import annotations

import pytest

from weftgraph.errors import UnresolvedEndpointError
from weftgraph.plans import jobs
from weftgraph.sources import keymaps
from weftgraph.sources.tables import read_primary_key_map


def _rows(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def _load(store, rows, location):
    return jobs.load_vertices(store, "A", rows, "name", location, id_order="key")


def _map(spark, location):
    return sorted(tuple(r) for r in read_primary_key_map(spark, location).collect())


def _plain(spark, location):
    """What a program sees that reads the first two columns at the location."""
    return sorted(tuple(r)[:2] for r in spark.read.orc(location).collect())


def _edges(spark, store, location, names):
    pairs = spark.createDataFrame([(n, n) for n in names], "name string, other string")
    jobs.init_edge(store, "E", pairs)
    jobs.load_edges(store, "E", pairs, "name", "name", "A", "A", "name", "name", location, location)
    return sorted((r["name"], r["_src"]) for r in store.edges("E").collect())


@pytest.fixture
def location(spark, store, work):
    rows = _rows(spark, "ab")
    jobs.init_vertex(store, "A", rows)
    _load(store, rows, f"{work}/map")
    return f"{work}/map"


def _die_in(monkeypatch, module, step, skip=0):
    """The step raises, from the call after the first ``skip`` on."""
    real, calls = getattr(module, step), []

    def broken(*args):
        calls.append(args)
        if len(calls) > skip:
            raise RuntimeError("injected")
        return real(*args)

    monkeypatch.setattr(module, step, broken)


STEPS = [("create_empty", 0), ("remove", 0), ("move", 0)]


@pytest.mark.parametrize("step, skip", STEPS)
def test_a_swap_that_died_is_finished_by_the_next_edge_load(spark, store, location, monkeypatch, step, skip):
    old = _map(spark, location)
    with monkeypatch.context() as patch:
        _die_in(patch, keymaps, step, skip)
        with pytest.raises(RuntimeError, match="injected"):
            _load(store, _rows(spark, "bc"), location)
    # Until then there is one whole map: the old one before the commit, the new one after.
    assert _map(spark, location) == (old if step == "create_empty" else [("b", 3), ("c", 4)])
    assert _edges(spark, store, location, "bc") == [("b", 3), ("c", 4)]
    assert _plain(spark, location) == [("b", 3), ("c", 4)]


@pytest.mark.parametrize("step, skip", STEPS)
def test_a_swap_that_died_is_finished_before_the_next_vertex_load(spark, store, location, monkeypatch, step, skip):
    with monkeypatch.context() as patch:
        _die_in(patch, keymaps, step, skip)
        with pytest.raises(RuntimeError, match="injected"):
            _load(store, _rows(spark, "bc"), location)
    _load(store, _rows(spark, "d"), location)
    assert _map(spark, location) == [("d", 5)]
    assert _plain(spark, location) == [("d", 5)]


def test_the_map_of_a_load_that_was_never_registered_is_dropped(spark, store, location, monkeypatch):
    old = _map(spark, location)
    real = type(store).add_to_registry

    def broken(self, table, rows):
        if rows and rows[0][0] == "vertex":
            raise RuntimeError("injected")
        real(self, table, rows)

    with monkeypatch.context() as patch:
        patch.setattr(type(store), "add_to_registry", broken)
        with pytest.raises(RuntimeError, match="injected"):
            _load(store, _rows(spark, "bc"), location)
    assert _map(spark, location) == old
    with pytest.raises(UnresolvedEndpointError):
        _edges(spark, store, location, "c")
    assert keymaps.waiting_loads(spark, location)
    _load(store, _rows(spark, "d"), location)
    assert not keymaps.waiting_loads(spark, location)


def test_a_map_that_another_program_wrote_is_read_and_replaced(spark, store, work):
    rows = _rows(spark, "ab")
    jobs.init_vertex(store, "A", rows)
    spark.createDataFrame([("x", 9)], "k string, v bigint").write.orc(f"{work}/plain")
    assert _map(spark, f"{work}/plain") == [("x", 9)]
    _load(store, rows, f"{work}/plain/")
    assert _map(spark, f"{work}/plain") == [("a", 1), ("b", 2)]
    assert _plain(spark, f"{work}/plain") == [("a", 1), ("b", 2)]
    assert len(keymaps.list_names(spark, f"{work}/_plain.versions")) == 1
