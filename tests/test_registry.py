from __future__ import annotations

import pytest
from pyspark.sql import types as T

from weftgraph import GraphStore, init_edge, init_vertex
from weftgraph.errors import (
    NotRegisteredError,
    ReservedColumnError,
    TypeConflictError,
    UnsupportedTypeError,
)
from weftgraph.operators.index import define_index
from weftgraph.operators.registry import (
    key_pairs,
    register_label,
    register_labels,
    register_properties,
    require_key_pairs,
    require_labels,
    require_registered,
    unregistered_labels,
)


def _schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def _statuses(store, ddl):
    return {s.name: s.status for s in register_properties(store, _schema(store.spark, ddl))}


def test_first_type_of_a_name_stays(store):
    assert _statuses(store, "k bigint, n string") == {"k": "created", "n": "created"}
    assert _statuses(store, "k string, n string, x int") == {
        "k": "conflict", "n": "exists", "x": "created",
    }
    assert store.property_types() == {"k": "Long", "n": "String", "x": "Integer"}
    assert store.registry("properties").count() == 3


def test_date_and_timestamp_are_one_type(store):
    _statuses(store, "d date")
    assert _statuses(store, "d timestamp") == {"d": "exists"}
    assert _statuses(store, "d timestamp_ntz") == {"d": "exists"}


def test_unsupported_columns(store):
    schema = _schema(store.spark, "a array<int>, k int, m decimal(5,1)")
    with pytest.raises(UnsupportedTypeError, match="a array<int>.*m decimal"):
        register_properties(store, schema, on_unsupported="error")
    assert store.property_types() == {}
    register_properties(store, schema)
    assert store.property_types() == {"k": "Integer"}
    with pytest.raises(ValueError):
        register_properties(store, schema, on_unsupported="ignore")


def test_labels_are_registered_once_per_kind(spark, store):
    names = spark.createDataFrame([("a",), ("b",), ("a",)], "label string")
    register_labels(store, "vertex", names)
    register_labels(store, "vertex", names)
    register_label(store, "vertex", "a")
    register_labels(store, "edge", names.where("label = 'a'"))
    rows = sorted(tuple(r) for r in store.registry("labels").collect())
    assert rows == [("edge", "a"), ("vertex", "a"), ("vertex", "b")]
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("b",)], "label string")
    missing = unregistered_labels(store, "edge", asked).collect()
    assert sorted(r["label"] for r in missing) == ["b", "c"]
    with pytest.raises(NotRegisteredError, match="'b'"):
        require_labels(store, "edge", "a", "b")


def test_key_pairs(store):
    register_properties(store, _schema(store.spark, "a bigint, b bigint, c int"))
    pairs = [("a", "b"), ("a", "c"), ("a", "z")]
    assert [p.status for p in key_pairs(store, pairs)] == ["ok", "mismatch", "missing"]
    require_key_pairs(store, [("a", "b")])
    with pytest.raises(TypeConflictError):
        require_key_pairs(store, pairs[:2])
    with pytest.raises(NotRegisteredError):
        require_key_pairs(store, pairs)


def test_a_load_needs_its_names_registered(store):
    register_label(store, "vertex", "V")
    register_properties(store, _schema(store.spark, "k bigint"))
    require_registered(store, "vertex", "V", _schema(store.spark, "k bigint, bad array<int>"))
    with pytest.raises(NotRegisteredError):
        require_registered(store, "edge", "V", _schema(store.spark, "k bigint"))
    with pytest.raises(NotRegisteredError):
        require_registered(store, "vertex", "V", _schema(store.spark, "k bigint, x int"))
    with pytest.raises(TypeConflictError):
        require_registered(store, "vertex", "V", _schema(store.spark, "k string"))


def test_init_jobs(spark, store):
    df = spark.createDataFrame([], "k bigint, name string, size int")
    init_vertex(store, "V", df, ["name", "size", "name"])
    init_vertex(store, "V", df, ["k"])
    init_edge(store, "E", df.select("k"))
    assert store.labels("vertex") == {"V"} and store.labels("edge") == {"E"}
    assert store.index_properties("graph_Vertex_V") == {"name": "text", "size": "value"}
    assert not define_index(store, "V", ["k"])
    with pytest.raises(NotRegisteredError, match="nope"):
        init_vertex(store, "W", df, ["nope"])


def test_reserved_columns(spark, store):
    for name in ("_vid", "_src", "_wg_x"):
        with pytest.raises(ReservedColumnError):
            init_vertex(store, "V", spark.createDataFrame([], f"`{name}` int"))
    assert store.labels("vertex") == set()


def test_another_process_is_seen_after_refresh(spark, store):
    other = GraphStore(spark, store.root)
    assert other.labels("vertex") == set()
    register_label(store, "vertex", "V")
    other.refresh()
    assert other.labels("vertex") == {"V"}


def test_types_survive_the_registry(store):
    _statuses(store, "a tinyint, b smallint, c float, d double, e boolean")
    assert store.property_types() == {
        "a": "Byte", "b": "Short", "c": "Float", "d": "Double", "e": "Boolean",
    }
    assert isinstance(store.registry("properties").schema["name"].dataType, T.StringType)
