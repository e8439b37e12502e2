"""Tables of one graph, below one root folder, all of them ORC.

    registry/properties   (name, property_type, cardinality)
    registry/labels       (kind, label)
    registry/indexes      (index, label, property, kind)
    registry/loads        one row per finished load
    registry/segments     (load_id, segment, rows) of ids given in scan order
    vertices/label=L/load=I/   _vid and the property columns
    edges/label=E/load=I/      _src, _dst and the property columns
    rejects/label=E/load=I/    edge rows left out, and why
    index/<name>/property=P/load=I/   postings (token|value, _vid) or (token, _vids)

A load becomes visible when its row is added to ``registry/loads``, which is
the last thing a job does: data of a job that died is never read.  The row
also keeps the id range and the schema, so that reading never has to open
file footers to merge schemas.  One writer at a time is assumed.
"""

from __future__ import annotations

import json
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weftgraph.sources.shared import exists

REGISTRY = {
    "properties": "name string, property_type string, cardinality string",
    "labels": "kind string, label string",
    "indexes": "index string, label string, property string, kind string",
    "loads": (
        "kind string, label string, load_id string, seq bigint, lo bigint, hi bigint, "
        "rows bigint, dense boolean, full boolean, fields string, "
        "tx_interval bigint, graph_interval bigint"
    ),
    "segments": "load_id string, segment bigint, rows bigint",
}


def merge_fields(schemas: list[T.StructType]) -> T.StructType:
    """Union of the columns by name; the first type seen is kept."""
    merged: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            merged.setdefault(field.name, T.StructField(field.name, field.dataType, True))
    return T.StructType(list(merged.values()))


class GraphStore:
    """Paths and tables of the graph at ``root``; ``name`` prefixes its indexes."""

    def __init__(self, spark: SparkSession, root: str, name: str = "graph"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.name = name
        self._rows: dict[str, list[Row]] = {}

    # -- registry: one small row per label, property, index or load ----------

    def registry(self, table: str) -> DataFrame:
        path = f"{self.root}/registry/{table}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], REGISTRY[table])
        return self.spark.read.schema(REGISTRY[table]).orc(path)

    def rows(self, table: str) -> list[Row]:
        """The table as read since the last refresh; schema, never data."""
        if table not in self._rows:
            known = exists(self.spark, f"{self.root}/registry/{table}")
            self._rows[table] = self.registry(table).collect() if known else []
        return self._rows[table]

    def refresh(self) -> None:
        """Forget what was read; each job starts with this."""
        self._rows.clear()

    def add_to_registry(self, table: str, rows: list[tuple]) -> None:
        if rows:
            schema = T.StructType.fromDDL(REGISTRY[table])
            records = [dict(zip(schema.names, row)) for row in rows]
            local = pa.Table.from_pylist(records, to_arrow_schema(schema))
            self.append_to_registry(table, self.spark.createDataFrame(local, schema).coalesce(1))

    def append_to_registry(self, table: str, frame: DataFrame) -> None:
        names = T.StructType.fromDDL(REGISTRY[table]).names
        frame.select(names).write.mode("append").orc(f"{self.root}/registry/{table}")
        self._rows.pop(table, None)

    def property_types(self) -> dict[str, str]:
        return {r["name"]: r["property_type"] for r in self.rows("properties")}

    def labels(self, kind: str) -> set[str]:
        return {r["label"] for r in self.rows("labels") if r["kind"] == kind}

    def index_properties(self, index: str) -> dict[str, str]:
        return {r["property"]: r["kind"] for r in self.rows("indexes") if r["index"] == index}

    def index_name(self, label: str) -> str:
        # Fixed value: the form of an index name.
        return f"{self.name}_Vertex_{label}"

    # -- loads ----------------------------------------------------------------

    def loads(self, kind: str, label: str | None = None) -> list[Row]:
        """Finished loads, oldest first."""
        found = [
            r for r in self.rows("loads") if r["kind"] == kind and label in (None, r["label"])
        ]
        return sorted(found, key=lambda r: r["seq"])

    def next_seq(self) -> int:
        return max((r["seq"] for r in self.rows("loads")), default=0) + 1

    def next_id(self) -> int:
        """First id not given out yet, not even by a load that died; unique across labels."""
        taken = [r["hi"] for kind in ("vertex", "reserved") for r in self.loads(kind)]
        return max(taken, default=0) + 1

    def path(self, kind: str, label: str, load_id: str) -> str:
        folder = {"vertex": "vertices", "edge": "edges", "reject": "rejects"}[kind]
        return f"{self.root}/{folder}/label={quote(label, safe='')}/load={load_id}"

    def index_path(self, index: str, prop: str, load_id: str) -> str:
        name = quote(index, safe="")
        return f"{self.root}/index/{name}/property={quote(prop, safe='')}/load={load_id}"

    # -- elements ---------------------------------------------------------------

    def element_schema(self, kind: str, label: str) -> T.StructType:
        return merge_fields(
            [T.StructType.fromJson(json.loads(r["fields"])) for r in self.loads(kind, label)]
        )

    def elements(self, kind: str, label: str, only: set[str] | None = None) -> DataFrame | None:
        """All finished loads of a label, or ``only`` some; None before the first one."""
        loads = self.loads(kind, label)
        if not loads:
            return None
        schema = merge_fields([T.StructType.fromJson(json.loads(r["fields"])) for r in loads])
        wanted = [r["load_id"] for r in loads if only is None or r["load_id"] in only]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).orc([self.path(kind, label, i) for i in wanted])

    def vertices(self, label: str, only: set[str] | None = None) -> DataFrame | None:
        """Vertices of a label; of ``only`` these loads, whose files alone are listed then."""
        found = self.elements("vertex", label, only)
        return None if found is None else found.withColumn("_label", F.lit(label))

    def edges(self, label: str) -> DataFrame | None:
        found = self.elements("edge", label)
        return None if found is None else found.withColumn("_label", F.lit(label))

    def rejects(self, label: str) -> DataFrame | None:
        return self.elements("reject", label)

    def all_vertices(self) -> DataFrame:
        """Vertices of every label, absent properties as null."""
        labels = sorted({r["label"] for r in self.loads("vertex")})
        if not labels:
            return self.spark.createDataFrame([], "_vid bigint, _label string")
        union = self.vertices(labels[0])
        for label in labels[1:]:
            union = union.unionByName(self.vertices(label), allowMissingColumns=True)
        return union

    def index_complete(self, index: str) -> bool:
        """Does the index cover every finished load of its label?

        A full build covers the loads before it; each later load has its own postings.
        """
        builds = self.loads("index", index)
        full = max((r["seq"] for r in builds if r["full"]), default=0)
        own = {r["load_id"] for r in builds}
        labels = {r["label"] for r in self.rows("indexes") if r["index"] == index}
        return all(
            r["seq"] < full or r["load_id"] in own
            for r in self.loads("vertex")
            if r["label"] in labels
        )

    def index_runs(self, index: str) -> list[Row]:
        """The last full build or merge, and the loads since."""
        loads = self.loads("index", index)
        start = max((i for i, r in enumerate(loads) if r["full"]), default=0)
        return loads[start:]

    def postings(self, index: str, prop: str) -> DataFrame | None:
        """Postings of the last full build or merge and of the loads since.

        None if the index does not cover all loads, say because its build died: the
        vertices are searched then.
        """
        return self._posting_runs(index, prop, F.explode("_vids").alias("_vid"), F.col("_vid"))

    def posting_blocks(self, index: str, prop: str) -> DataFrame | None:
        """:meth:`postings` of words as (token, _vids); single postings are blocks of one."""
        return self._posting_runs(index, prop, F.col("_vids"), F.array("_vid").alias("_vids"))

    def _posting_runs(self, index: str, prop: str, of_blocks: Column, of_rows: Column) -> DataFrame | None:
        """The runs that are read, those in blocks and those in rows each as one scan."""
        runs = self.index_runs(index)
        if not runs or not self.index_complete(index):
            return None
        paths: dict[bool, list[str]] = {}
        schemas: dict[bool, T.StructType] = {}
        for run in runs:
            fields = json.loads(run["fields"]).get(prop)
            if fields:
                schema = T.StructType.fromJson(fields)
                blocks = "_vids" in schema.names
                schemas.setdefault(blocks, schema)
                paths.setdefault(blocks, []).append(self.index_path(index, prop, run["load_id"]))
        found = [
            self.spark.read.schema(schemas[blocks]).orc(paths[blocks])
            .select(schemas[blocks].names[0], of_blocks if blocks else of_rows)
            for blocks in paths
        ]
        return reduce(DataFrame.unionByName, found) if found else None
