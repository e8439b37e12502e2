"""weftgraph: loads columnar tables into a property graph with Spark.

Each source table holds one type of vertex or one type of edge.  The four
jobs in :mod:`weftgraph.plans.jobs` register the schema and load the data;
all row work runs as DataFrame plans on the executors.
"""

from weftgraph.plans.jobs import (
    compact_index,
    init_edge,
    init_vertex,
    load_edges,
    load_vertices,
    reindex,
)
from weftgraph.sources.store import GraphStore

__all__ = [
    "GraphStore",
    "compact_index",
    "init_edge",
    "init_vertex",
    "load_edges",
    "load_vertices",
    "reindex",
]
