"""Schema profile, and merge-if-absent registration of labels and properties.

The registry has one row per label or property name: schema, not data.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.errors import NotRegisteredError, TypeConflictError, UnsupportedTypeError
from weftgraph.functions.types import column, property_fields, property_type, unsupported_fields
from weftgraph.sources.store import GraphStore


class PropertyStatus(NamedTuple):
    """``created`` (new name), ``exists`` (same type) or ``conflict`` (other type)."""

    name: str
    offered_type: str
    registered_type: str | None
    status: str


class KeyPair(NamedTuple):
    """``ok``, ``mismatch`` or ``missing`` (one of the keys is not registered)."""

    edge_key: str
    vertex_key: str
    edge_type: str | None
    vertex_type: str | None
    status: str


def value_counts(df: DataFrame) -> DataFrame:
    """(name, n_values): non-null values of each column, in one pass."""
    names = [f.name for f in df.schema.fields]
    counted = df.agg(*[F.count(column(n)).alias(n) for n in names])
    return counted.unpivot([], names, "name", "n_values")


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per source column; ``property_type`` is null if unsupported."""
    rows = [
        (i, f.name, f.dataType.simpleString(), property_type(f.dataType))
        for i, f in enumerate(df.schema.fields, 1)
    ]
    schema = "position int, name string, source_type string, property_type string"
    return df.sparkSession.createDataFrame(rows, schema).join(value_counts(df), "name")


def property_statuses(store: GraphStore, schema: T.StructType) -> list[PropertyStatus]:
    """How each supported column stands to the registry."""
    known = store.property_types()
    statuses = []
    for field in property_fields(schema):
        offered, registered = property_type(field.dataType), known.get(field.name)
        if registered is None:
            status = "created"
        else:
            status = "exists" if registered == offered else "conflict"
        statuses.append(PropertyStatus(field.name, offered, registered, status))
    return statuses


def register_properties(
    store: GraphStore, schema: T.StructType, on_unsupported: str = "skip"
) -> list[PropertyStatus]:
    """Registers the new names; a conflicting name keeps its first type.

    Returns the statuses as they were before the registration.
    """
    if on_unsupported not in ("skip", "error"):
        raise ValueError("on_unsupported must be 'skip' or 'error'")
    bad = [f"{f.name} {f.dataType.simpleString()}" for f in unsupported_fields(schema)]
    if bad and on_unsupported == "error":
        raise UnsupportedTypeError(f"columns that cannot be properties: {bad}")
    statuses = property_statuses(store, schema)
    store.add_to_registry(
        "properties",
        [(s.name, s.offered_type, "SINGLE") for s in statuses if s.status == "created"],
    )
    return statuses


def unregistered_labels(store: GraphStore, kind: str, labels: DataFrame) -> DataFrame:
    """Those of the labels (column ``label``) that the kind does not have."""
    known = store.registry("labels").where(F.col("kind") == kind).select("label")
    return labels.select("label").distinct().join(known, "label", "left_anti")


def register_labels(store: GraphStore, kind: str, labels: DataFrame) -> None:
    """Adds the labels that the kind does not have yet."""
    new = unregistered_labels(store, kind, labels).withColumn("kind", F.lit(kind))
    store.append_to_registry("labels", new)


def register_label(store: GraphStore, kind: str, label: str) -> None:
    if label not in store.labels(kind):
        store.add_to_registry("labels", [(kind, label)])


def require_registered(store: GraphStore, kind: str, label: str, schema: T.StructType) -> None:
    """A load needs its label and properties registered, with these types."""
    require_labels(store, kind, label)
    statuses = property_statuses(store, schema)
    missing = [s.name for s in statuses if s.status == "created"]
    if missing:
        raise NotRegisteredError(f"properties not registered: {missing}")
    conflicts = [s for s in statuses if s.status == "conflict"]
    if conflicts:
        raise TypeConflictError(f"types differ from the registered ones: {conflicts}")


def key_pairs(store: GraphStore, pairs: list[tuple[str, str]]) -> list[KeyPair]:
    """Are both keys of each (edge key, vertex key) registered with one type?"""
    known = store.property_types()
    checked = []
    for edge_key, vertex_key in pairs:
        types = known.get(edge_key), known.get(vertex_key)
        if None in types:
            status = "missing"
        else:
            status = "ok" if types[0] == types[1] else "mismatch"
        checked.append(KeyPair(edge_key, vertex_key, *types, status))
    return checked


def require_key_pairs(store: GraphStore, pairs: list[tuple[str, str]]) -> None:
    checked = key_pairs(store, pairs)
    missing = [p for p in checked if p.status == "missing"]
    if missing:
        raise NotRegisteredError(f"keys not registered: {missing}")
    mismatched = [p for p in checked if p.status == "mismatch"]
    if mismatched:
        raise TypeConflictError(f"key types differ: {mismatched}")


def require_labels(store: GraphStore, kind: str, *labels: str) -> None:
    missing = sorted(set(labels) - store.labels(kind))
    if missing:
        raise NotRegisteredError(f"{kind} labels not registered: {missing}")
