"""The four jobs, and the index backfill.

Every job checks its input before it writes, stages what it reads more than
once in the shared folder, and makes its result visible in its last step.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.errors import NameConflictError, NotRegisteredError, UnresolvedEndpointError
from weftgraph.functions.types import column, supported_projection
from weftgraph.operators.ids import (
    ROW_BITS,
    check_intervals,
    commit_batches,
    graph_commits,
    key_order_ids,
    load_ordinals,
    next_segment,
    scan_ids,
    segment_of,
)
from weftgraph.operators.index import define_index, write_merged_postings, write_postings
from weftgraph.operators.registry import (
    PropertyStatus,
    register_label,
    register_properties,
    require_key_pairs,
    require_labels,
    require_registered,
)
from weftgraph.operators.resolve import (
    Endpoints,
    attached_edges,
    edges_with_keys,
    key_counts,
    label_fallback,
    resolve_keys,
    resolved_edges,
)
from weftgraph.sources.keymaps import new_folder, publish, settle
from weftgraph.sources.shared import new_dir, remove, stage, write_counted
from weftgraph.sources.store import GraphStore
from weftgraph.sources.tables import (
    Source,
    primary_key_map,
    read_primary_key_map,
    reject_reserved,
    require_columns,
    scan,
    write_primary_key_map,
)


@dataclass(frozen=True)
class LoadSummary:
    """What a load did; the commit counts follow from the element count."""

    label: str
    load_id: str
    elements: int
    rejected: int
    tx_commits: int
    graph_commits: int


def _summary(
    label: str, load_id: str, elements: int, rejected: int, tx: int, graph: int
) -> LoadSummary:
    full = elements // tx
    return LoadSummary(label, load_id, elements, rejected, full + 1, full // graph + 1)


def init_vertex(
    store: GraphStore,
    label: str,
    source: Source,
    index_columns: Iterable[str] = (),
    *,
    fmt: str = "orc",
    on_unsupported: str = "skip",
) -> list[PropertyStatus]:
    """Registers a vertex label, its properties and, if asked for, its index.

    Only the source's schema is read, except that a new index is filled from
    the label's vertices.  Returns the status of each property.
    """
    schema = _source_schema(store, source, fmt)
    register_label(store, "vertex", label)
    statuses = register_properties(store, schema, on_unsupported)
    columns = list(index_columns)
    if columns:
        fresh = define_index(store, label, columns)
        if fresh or not store.index_complete(store.index_name(label)):
            reindex(store, label)
    return statuses


def init_edge(
    store: GraphStore,
    label: str,
    source: Source,
    *,
    fmt: str = "orc",
    on_unsupported: str = "skip",
) -> list[PropertyStatus]:
    """Registers an edge label and its properties; returns their statuses."""
    schema = _source_schema(store, source, fmt)
    register_label(store, "edge", label)
    return register_properties(store, schema, on_unsupported)


def _source_schema(store: GraphStore, source: Source, fmt: str) -> T.StructType:
    store.refresh()
    df = scan(store.spark, source, fmt)
    reject_reserved(df)
    return df.schema


def reindex(store: GraphStore, label: str) -> None:
    """Builds the label's index anew from all its vertices."""
    store.refresh()
    index = store.index_name(label)
    if not store.index_properties(index):
        raise NotRegisteredError(f"no index {index!r}")
    vertices = store.vertices(label)
    if vertices is None:
        return
    load_id = uuid.uuid4().hex
    schemas = write_postings(store, index, vertices, load_id)
    store.add_to_registry("loads", [_index_load(index, load_id, store.next_seq(), schemas, True)])


def compact_index(store: GraphStore, label: str) -> int:
    """Merges the postings that each load of the label wrote into one sorted run.

    Lookups read that run alone, and those of later loads.  No vertex is read.  Returns how
    many runs were merged: 0 if there is one already, or none.  An index that does not cover
    every load is built anew instead.  The merged runs stay on disk for whoever reads them.
    The new run counts once its row is registered; a job that dies before leaves the old ones.
    """
    store.refresh()
    index = store.index_name(label)
    if not store.index_properties(index):
        raise NotRegisteredError(f"no index {index!r}")
    runs = store.index_runs(index)
    if not store.index_complete(index):
        reindex(store, label)
        return len(runs)
    if len(runs) < 2:
        return 0
    load_id = uuid.uuid4().hex
    schemas = write_merged_postings(store, index, load_id)
    store.add_to_registry("loads", [_index_load(index, load_id, store.next_seq(), schemas, True)])
    return len(runs)


def _index_load(
    index: str, load_id: str, seq: int, schemas: dict[str, T.StructType], full: bool
) -> tuple:
    fields = json.dumps({prop: s.jsonValue() for prop, s in schemas.items()})
    return ("index", index, load_id, seq, None, None, None, None, full, fields)


def _like_earlier_loads(df: DataFrame, earlier: T.StructType) -> DataFrame:
    """A label keeps one type per column, zoned or zone-less timestamps alike.

    Names that differ in case only cannot be columns of one label.
    """
    stored = {f.name.lower(): f.name for f in earlier.fields}
    clashes = [c for c in df.columns if stored.get(c.lower(), c) != c]
    if clashes:
        raise NameConflictError(f"the label has these names in another case: {clashes}")
    types = {f.name: f.dataType for f in earlier.fields}
    return df.select(
        [
            column(f.name).cast(types.get(f.name, f.dataType)).alias(f.name)
            for f in df.schema.fields
        ]
    )


def load_vertices(
    store: GraphStore,
    label: str,
    source: Source,
    primary_key_column: str,
    primary_key_map_location: str,
    *,
    fmt: str = "orc",
    tx_commit_interval: int = 1000,
    graph_tx_commit_interval: int = 1,
    id_order: str = "scan",
) -> LoadSummary:
    """One new vertex per source row, and the (key, id) map of these rows.

    ``id_order="scan"`` numbers the rows where they are scanned: one pass, no
    shuffle, ids with gaps.  ``id_order="key"`` numbers them without gaps in
    the order of the primary key, the same on every run, at the price of a
    range shuffle and a staged copy of the rows.
    """
    check_intervals(tx_commit_interval, graph_tx_commit_interval)
    if id_order not in ("scan", "key"):
        raise ValueError("id_order must be 'scan' or 'key'")
    spark = store.spark
    store.refresh()
    raw = scan(spark, source, fmt)
    reject_reserved(raw)
    require_columns(raw, primary_key_column)
    require_registered(store, "vertex", label, raw.schema)
    rows = _like_earlier_loads(supported_projection(raw), store.element_schema("vertex", label))

    _settle_map(store, primary_key_map_location, drop_others=True)
    load_id, first_id, dense = uuid.uuid4().hex, store.next_id(), id_order == "key"
    path = store.path("vertex", label, load_id)
    if dense:
        work = new_dir(spark, "load-vertices")
        try:
            numbered = key_order_ids(rows, primary_key_column, first_id, f"{work}/sorted")
            count = write_counted(numbered, path)
        finally:
            remove(spark, work)
    else:
        first_id = next_segment(first_id)
        numbered = scan_ids(rows, first_id)
        numbered.write.orc(path)
    written = spark.read.schema(numbered.schema).orc(path)
    if dense:
        last_id = first_id + count - 1
    else:
        count, last_id = _add_segments(store, load_id, first_id, written)
    # Whatever fails from here on, these ids are never given out again.
    reserved = (load_id, store.next_seq(), first_id, last_id, count, dense, None, None)
    store.add_to_registry("loads", [("reserved", label, *reserved)])

    seq, fields = store.next_seq(), json.dumps(numbered.schema.jsonValue())
    intervals = (tx_commit_interval, graph_tx_commit_interval)
    loads = [("vertex", label, load_id, seq, first_id, last_id, count, dense, None, fields, *intervals)]
    index = store.index_name(label)
    if store.index_properties(index):
        schemas = write_postings(store, index, written, load_id)
        loads.append(_index_load(index, load_id, seq, schemas, False))
    # The old map stays until the new one is whole and its vertices can be seen.
    new_map = new_folder(primary_key_map_location, load_id)
    write_primary_key_map(primary_key_map(written, primary_key_column), new_map)
    store.add_to_registry("loads", loads)
    publish(spark, primary_key_map_location, load_id)
    return _summary(label, load_id, count, 0, tx_commit_interval, graph_tx_commit_interval)


def _settle_map(store: GraphStore, location: Source, drop_others: bool = False) -> None:
    """Finishes what a job that died left undone at the location of a map."""
    if isinstance(location, str):
        loads = [r["load_id"] for r in store.loads("vertex")]
        settle(store.spark, location, loads, drop_others)


def _add_segments(
    store: GraphStore, load_id: str, first_id: int, written: DataFrame
) -> tuple[int, int]:
    """Registers the row count of each id segment; returns all rows and the last id."""
    sizes = written.groupBy(segment_of(F.col("_vid")).alias("segment")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    store.append_to_registry("segments", sizes.withColumn("load_id", F.lit(load_id)))
    registered = store.registry("segments").where(F.col("load_id") == load_id)
    last = F.shiftleft(F.col("segment"), ROW_BITS) + F.col("rows") - 1
    rows, last_id = registered.agg(F.sum("rows"), F.max(last)).first()
    return rows or 0, first_id - 1 if last_id is None else last_id


def load_edges(
    store: GraphStore,
    label: str,
    source: Source,
    edge_key_a: str,
    edge_key_b: str,
    vertex_label_a: str,
    vertex_label_b: str,
    vertex_key_a: str,
    vertex_key_b: str,
    map_a: Source,
    map_b: Source,
    *,
    fmt: str = "orc",
    tx_commit_interval: int = 1000,
    graph_tx_commit_interval: int = 1,
    on_missing: str = "error",
    use_index: bool = True,
) -> LoadSummary:
    """One edge A -> B per source row whose two keys lead to vertices.

    Rows without one of the keys are passed over.  A key is looked up in the
    saved map first and then within the vertex label.  Keys that lead nowhere
    stop the job before it writes, or with ``on_missing="quarantine"`` send
    their rows to the label's rejects.
    """
    check_intervals(tx_commit_interval, graph_tx_commit_interval)
    if on_missing not in ("error", "quarantine"):
        raise ValueError("on_missing must be 'error' or 'quarantine'")
    spark = store.spark
    store.refresh()
    raw = scan(spark, source, fmt)
    reject_reserved(raw)
    require_columns(raw, edge_key_a, edge_key_b)
    require_key_pairs(store, [(edge_key_a, vertex_key_a), (edge_key_b, vertex_key_b)])
    require_labels(store, "vertex", vertex_label_a, vertex_label_b)
    require_registered(store, "edge", label, raw.schema)

    rows = edges_with_keys(supported_projection(raw), edge_key_a, edge_key_b)
    rows = _like_earlier_loads(rows, store.element_schema("edge", label))
    for saved in (map_a, map_b):
        _settle_map(store, saved)
    intervals = (tx_commit_interval, graph_tx_commit_interval)
    load_id, work = uuid.uuid4().hex, new_dir(spark, "load-edges")
    try:
        sides = [
            (f"{work}/a", edge_key_a, vertex_label_a, vertex_key_a, map_a),
            (f"{work}/b", edge_key_b, vertex_label_b, vertex_key_b, map_b),
        ]

        def resolve(side: tuple) -> Endpoints:
            folder, key, vertex_label, vertex_key, saved = side
            pk_map = read_primary_key_map(spark, saved)
            search = label_fallback(store, vertex_label, vertex_key, folder, use_index)
            return resolve_keys(store, key_counts(rows, key), pk_map, search, folder)

        # The sides are independent; tasks of one fill the cores the other leaves.
        # The caller's job group and scheduler pool apply to both.
        with ThreadPoolExecutor(len(sides)) as pool:
            ends = list(pool.map(inheritable_thread_target(spark)(resolve), sides))
        lost_a, lost_b = (e.lost for e in ends)
        if on_missing == "error" and (lost_a or lost_b):
            raise UnresolvedEndpointError(
                f"{lost_a} keys of {edge_key_a} and {lost_b} keys of {edge_key_b} "
                f"lead to no vertex; nothing was written"
            )
        keys = (edge_key_a, edge_key_b)
        if lost_a or lost_b:
            # One join of the edges for both tables.
            attached = stage(attached_edges(rows, *keys, *ends), f"{work}/attached")
            found = F.col("_src").isNotNull() & F.col("_dst").isNotNull()
            edges = attached.where(found).drop("_src_reason", "_dst_reason")
            rejects = attached.where(~found).drop("_src", "_dst")
            loads = [
                _write_load(store, "edge", label, load_id, edges, intervals),
                _write_load(store, "reject", label, load_id, rejects, intervals),
            ]
        else:
            edges = resolved_edges(rows, *keys, *ends)
            loads = [_write_load(store, "edge", label, load_id, edges, intervals)]
    finally:
        remove(spark, work)
    store.add_to_registry("loads", loads)
    counts = {row[0]: row[6] for row in loads}
    return _summary(
        label,
        load_id,
        counts["edge"],
        counts.get("reject", 0),
        tx_commit_interval,
        graph_tx_commit_interval,
    )


def _write_load(
    store: GraphStore, kind: str, label: str, load_id: str, df: DataFrame, intervals: tuple[int, int]
) -> tuple:
    count = write_counted(df, store.path(kind, label, load_id))
    fields = json.dumps(df.schema.jsonValue())
    return (kind, label, load_id, store.next_seq(), None, None, count, None, None, fields, *intervals)


def vertex_batches(store: GraphStore, label: str, load_id: str | None = None) -> DataFrame:
    """Vertices of the label with ``load_id``, ``ordinal``, ``tx_batch`` and ``graph_batch``.

    Each load counts its own elements, in the order of their ids, and has the intervals that
    it was given.
    """
    store.refresh()
    found = None
    for load in store.loads("vertex", label):
        if load_id in (None, load["load_id"]):
            numbered = load_ordinals(store, load).withColumn("load_id", F.lit(load["load_id"]))
            batches = commit_batches(numbered, F.col("ordinal"), load["tx_interval"] or 1000, load["graph_interval"] or 1)
            found = batches if found is None else found.unionByName(batches, allowMissingColumns=True)
    if found is None:
        raise NotRegisteredError(f"no such load of {label!r}")
    return found


def commit_log(store: GraphStore, kind: str, label: str) -> DataFrame:
    """One row for each graph commit of the label's loads, and the elements it made durable."""
    store.refresh()
    return graph_commits(store.registry("loads").where((F.col("kind") == kind) & (F.col("label") == label)))
