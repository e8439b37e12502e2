"""The vertex lookups of the edge job, for a user's own use."""

from __future__ import annotations

from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.tokens import text_contains, words_of_query
from weftgraph.functions.types import column
from weftgraph.operators.index import TEXT
from weftgraph.operators.pruning import FEW_KEYS
from weftgraph.operators.resolve import span_of
from weftgraph.sources.store import GraphStore


def vertices_by_id(vertices: DataFrame, ids: DataFrame) -> DataFrame:
    """Vertices whose ``_vid`` is among the ids (column ``vid``)."""
    wanted = ids.select(F.col("vid").alias("_vid")).distinct()
    return vertices.join(wanted, "_vid", "left_semi")


def vertices_with_ids(store: GraphStore, label: str, ids: DataFrame) -> DataFrame | None:
    """Vertices of the label whose ``_vid`` is among the ids (column ``vid``).

    Each load has a range of ids of its own.  Loads that hold none of the ids are not listed
    and not read; which these are takes one pass over the ids and no vertex.  Few ids become
    a filter of the scan besides, where files are sorted by id.
    """
    loads = [r for r in store.loads("vertex", label) if r["rows"]]
    wanted = ids.select(F.col("vid").cast("bigint").alias("_vid")).where("_vid is not null").distinct()
    few = [r[0] for r in wanted.take(FEW_KEYS + 1)]
    if len(few) <= FEW_KEYS:
        holding = {r["load_id"] for r in loads if any(r["lo"] <= v <= r["hi"] for v in few)}
        vertices = store.vertices(label, holding)
        return None if vertices is None else vertices.where(F.col("_vid").isin(few))
    # One row for each load of the label.
    ranges = pa.table({n: pa.array([r[n] for r in loads], pa.int64()) for n in ("lo", "hi")})
    spans = store.spark.createDataFrame(ranges, "lo bigint, hi bigint")
    reach = sum(r["hi"] - r["lo"] + 1 for r in loads)
    met = span_of(wanted, F.col("_vid"), spans, reach, "span").select("span").distinct()
    starts = {r["span"] for r in met.take(len(loads) + 1)}  # and null, for ids that no load holds
    vertices = store.vertices(label, {r["load_id"] for r in loads if r["lo"] in starts})
    return None if vertices is None else vertices.join(wanted, "_vid", "left_semi")


def vertices_by_property(store: GraphStore, label: str, prop: str, value: Any) -> DataFrame | None:
    """Vertices of the label whose property equals the value; the scan filters."""
    vertices = store.vertices(label)
    return None if vertices is None else vertices.where(column(prop) == F.lit(value))


def vertices_by_text(
    store: GraphStore, label: str, prop: str, query: str, use_index: bool = True
) -> DataFrame | None:
    """Vertices of the label whose property has all words of the query."""
    vertices = store.vertices(label)
    if vertices is None:
        return None
    index = store.index_name(label)
    indexed = use_index and store.index_properties(index).get(prop) == TEXT
    postings = store.postings(index, prop) if indexed else None
    if postings is None:
        return vertices.where(text_contains(column(prop), query))
    wanted = words_of_query(store.spark, query)
    hits = (
        postings.where(F.col("token").isin(wanted))
        .groupBy("_vid")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == len(wanted))
        .select("_vid")
    )
    return vertices.join(hits, "_vid", "left_semi")
