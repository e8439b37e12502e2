"""Vertex ids and commit batches."""

from __future__ import annotations

import json
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.functions.types import column
from weftgraph.sources.shared import fits_broadcast, stage

if TYPE_CHECKING:
    from weftgraph.sources.store import GraphStore

# Fixed value: monotonically_increasing_id() keeps the row's number within its
# partition in the lower 33 bits and the partition's number above them.
ROW_BITS = 33
# Bytes that a segment's row count takes in a broadcast table.
SEGMENT_BYTES = 64
# Graph commits of a load that are listed at once.
COMMITS_AT_ONCE = 1 << 16


def key_order_ids(df: DataFrame, key: str, first_id: int, staging: str) -> DataFrame:
    """``_vid`` = first_id, first_id + 1, ... in the order of ``key``, nulls first.

    Rows of the same key are ordered by a hash of the row, so they are numbered
    alike however the source is split, and equal rows by scan position.  Both are
    part of the range key, so a key that holds a third of the rows is cut like any
    other stretch, and the sampled bounds are little wider than the key.

    The sorted rows are staged once: counting the partitions and numbering the
    rows must see the same cut.  What is broadcast has one row per partition.
    """
    order = [column(key).asc_nulls_first(), F.col("_wg_hash").asc(), F.col("_wg_pos").asc()]
    row_hash = F.xxhash64(*[column(c) for c in df.columns])
    ranged = (
        df.withColumns({"_wg_hash": row_hash, "_wg_pos": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_wg_hash", "_wg_pos")
        .withColumn("_wg_row", F.monotonically_increasing_id())
    )
    staged = (
        stage(ranged, staging)
        .withColumn("_wg_part", segment_of(F.col("_wg_row")))
        .withColumn("_wg_row", row_of(F.col("_wg_row")))
    )
    before = Window.orderBy("_wg_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy("_wg_part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "_wg_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_wg_offset")
        )
    )
    numbered = staged.join(F.broadcast(offsets), "_wg_part")
    vid = F.lit(first_id) + F.col("_wg_offset") + F.col("_wg_row")
    return numbered.select(vid.cast("bigint").alias("_vid"), *[column(c) for c in df.columns])


def scan_ids(df: DataFrame, first_id: int) -> DataFrame:
    """``_vid`` from the scan position, with gaps: no shuffle, no staging, one pass.

    ``first_id`` starts a segment, see :func:`next_segment`; each partition of
    the scan then numbers its rows from the start of a segment of its own.
    """
    vid = F.lit(first_id) + F.monotonically_increasing_id()
    return df.select(vid.cast("bigint").alias("_vid"), *[column(c) for c in df.columns])


def next_segment(first_id: int) -> int:
    """First id of the first segment at or after ``first_id``."""
    return -(-first_id >> ROW_BITS) << ROW_BITS


def segment_of(vid: Column) -> Column:
    return F.shiftright(vid, ROW_BITS)


def segment_of_id(vid: int) -> int:
    return vid >> ROW_BITS


def row_of(vid: Column) -> Column:
    """Row number within the segment, from 0."""
    return vid.bitwiseAND(F.lit((1 << ROW_BITS) - 1))


def check_intervals(tx_commit_interval: int, graph_tx_commit_interval: int) -> None:
    for name, value in (
        ("tx_commit_interval", tx_commit_interval),
        ("graph_tx_commit_interval", graph_tx_commit_interval),
    ):
        if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
            raise ValueError(f"{name} must be an integer greater than 0, not {value!r}")


def _whole(number: Column, interval: int) -> Column:
    """Integer division; doubles would be off beyond 2^53."""
    return F.call_function("div", number.cast("long"), F.lit(interval).cast("long"))


def commit_batches(
    df: DataFrame, ordinal: Column, tx_commit_interval: int, graph_tx_commit_interval: int
) -> DataFrame:
    """Adds the transaction and graph-commit number of each element (1-based)."""
    check_intervals(tx_commit_interval, graph_tx_commit_interval)
    tx = _whole(ordinal - 1, tx_commit_interval) + 1
    return df.withColumn("tx_batch", tx).withColumn(
        "graph_batch", _whole(F.col("tx_batch") - 1, graph_tx_commit_interval) + 1
    )


def load_ordinals(store: GraphStore, load: Row) -> DataFrame:
    """Vertices of one load with their ``ordinal``, from 1 in the order of their ids.

    A load in key order has ids without gaps.  One in scan order has a segment for each scan
    task, and an ordinal is the rows of earlier segments and the row within its own.
    """
    schema = T.StructType.fromJson(json.loads(load["fields"]))
    path = store.path("vertex", load["label"], load["load_id"])
    vertices, vid = store.spark.read.schema(schema).orc(path), F.col("_vid")
    if load["dense"]:
        return vertices.withColumn("ordinal", vid - F.lit(load["lo"]) + 1)
    segments = store.registry("segments").where(F.col("load_id") == load["load_id"])
    # One row for each scan task of the load.
    earlier = Window.partitionBy("load_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    before = segments.select(
        F.col("segment").alias("_wg_segment"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_wg_before")
    )
    size = SEGMENT_BYTES * (segment_of_id(load["hi"]) - segment_of_id(load["lo"]) + 1)
    if fits_broadcast(store.spark, size):
        before = F.broadcast(before)
    joined = vertices.join(before, segment_of(vid) == F.col("_wg_segment"))
    return joined.withColumn("ordinal", F.col("_wg_before") + row_of(vid) + 1).drop("_wg_segment", "_wg_before")


def graph_commits(loads: DataFrame) -> DataFrame:
    """(load_id, graph_batch, first_tx, last_tx, elements): the graph commits of each load.

    Follows from the row counts.  The last commit of a load may hold nothing.  Batches are
    spread in two steps, so that a long load makes no long array.
    """
    tx, graph = F.coalesce("tx_interval", F.lit(1000)), F.coalesce("graph_interval", F.lit(1))
    div = lambda a, b: F.call_function("div", a, b)
    full = div(F.col("rows"), F.col("tx"))
    known = loads.select("load_id", "rows", tx.alias("tx"), graph.alias("graph")).withColumn("last", div(full, F.col("graph")))
    step = F.lit(COMMITS_AT_ONCE).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.col("last"), step)
    parts = known.withColumn("start", F.explode(starts)).repartition("load_id", "start")
    numbers = F.sequence(F.col("start"), F.least(F.col("last"), F.col("start") + step - 1))
    commits = parts.withColumn("n", F.explode(numbers))
    first, size = F.col("n") * F.col("graph"), F.col("graph") * F.col("tx")
    return commits.select(
        "load_id",
        (F.col("n") + 1).alias("graph_batch"),
        (first + 1).alias("first_tx"),
        F.least(first + F.col("graph"), full + 1).alias("last_tx"),
        F.least(size, F.col("rows") - F.col("n") * size).alias("elements"),
    )


def commit_counts(
    elements: DataFrame, tx_commit_interval: int, graph_tx_commit_interval: int
) -> DataFrame:
    """One row: elements, tx commits, graph commits of a load.

    A transaction is opened after each commit, so one more commit of each kind
    always follows the full batches.
    """
    check_intervals(tx_commit_interval, graph_tx_commit_interval)
    full = _whole(F.col("elements"), tx_commit_interval)
    return elements.agg(F.count(F.lit(1)).alias("elements")).select(
        "elements",
        (full + 1).alias("tx_commits"),
        (_whole(full, graph_tx_commit_interval) + 1).alias("graph_commits"),
    )
