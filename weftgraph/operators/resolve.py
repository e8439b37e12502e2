"""From the key columns of edge rows to vertex ids.

Keys are resolved once per distinct key.  The table of resolved endpoints also
holds how many edge rows each key has, which tells the final join the hot
keys, and the job whether anything is unresolved before it writes an edge.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.functions.types import column, property_type
from weftgraph.operators.ids import ROW_BITS
from weftgraph.operators.index import token_blocks, value_postings
from weftgraph.operators.pruning import only_wanted
from weftgraph.operators.skew import hot_keys_of, salted_join
from weftgraph.operators.textmatch import first_text_match
from weftgraph.sources.shared import stage
from weftgraph.sources.store import GraphStore

#: Slabs of ids for each shuffle partition.
SLABS = 16

Fallback = Callable[[DataFrame], DataFrame | None]


def edges_with_keys(edges: DataFrame, key_a: str, key_b: str) -> DataFrame:
    """Edge rows whose endpoint keys are both present."""
    return edges.where(column(key_a).isNotNull() & column(key_b).isNotNull())


def key_counts(edges: DataFrame, key: str) -> DataFrame:
    """(key, n_edges) per distinct endpoint key."""
    return edges.groupBy(column(key).alias("key")).agg(F.count(F.lit(1)).alias("n_edges"))


def latest_per_key(pk_map: DataFrame) -> DataFrame:
    """One id per map key: the one given last, which is the greatest."""
    return pk_map.groupBy("key").agg(F.max("vid").alias("vid"))


def same_key_type(a: T.DataType, b: T.DataType) -> bool:
    """Keys of different property types are never equal, 1 and 1L included."""
    return property_type(a) is not None and property_type(a) == property_type(b)


def map_lookup(keys: DataFrame, pk_map: DataFrame) -> DataFrame:
    """Keys with ``vid`` from the map, null where the map has no such key."""
    if not same_key_type(keys.schema["key"].dataType, pk_map.schema["key"].dataType):
        return keys.withColumn("vid", F.lit(None).cast("bigint"))
    known = latest_per_key(pk_map.where(F.col("key").isNotNull()))
    return keys.join(known, "key", "left")


def map_hits(edges: DataFrame, key: str, pk_map: DataFrame) -> DataFrame:
    """Edge rows whose key is in the map."""
    if not same_key_type(edges.schema[key].dataType, pk_map.schema["key"].dataType):
        return edges.where(F.lit(False))
    known = pk_map.select(F.col("key").alias("_wg_key")).distinct()
    return edges.join(known, column(key) == F.col("_wg_key"), "left_semi")


def first_match(values: DataFrame) -> DataFrame:
    """(value, vid): of the vertices that share a value, the lowest id."""
    return values.groupBy("value").agg(F.min("_vid").alias("vid"))


def first_exact_match(keys: DataFrame, values: DataFrame) -> DataFrame:
    """(key, vid): lowest id whose property equals the key.

    The keys of an edge load that its map does not have are few as a rule; then
    only the values they ask for are grouped.
    """
    wanted = only_wanted(values, "value", keys.select("key"))
    firsts = first_match(values if wanted is None else wanted)
    return keys.join(firsts, F.col("key") == F.col("value")).select("key", "vid")


def label_fallback(
    store: GraphStore, label: str, prop: str, work: str, use_index: bool = True
) -> Fallback:
    """Search within one label for keys the map does not have.

    Strings match by words and everything else by equality.  Postings come
    from the index where the label has one, else from the vertices.
    """

    def search(keys: DataFrame) -> DataFrame | None:
        index = store.index_name(label)
        by_words = isinstance(keys.schema["key"].dataType, T.StringType)
        indexed = use_index and prop in store.index_properties(index)
        stored = store.posting_blocks if by_words else store.postings
        postings = stored(index, prop) if indexed else None
        if postings is None:
            vertices = store.vertices(label)
            if vertices is None or prop not in vertices.columns:
                return None
            if by_words:
                postings = token_blocks(vertices, prop)
            else:
                postings = value_postings(vertices, prop)
        if by_words:
            return first_text_match(keys, postings, work)
        return first_exact_match(keys, postings)

    return search


def _id_ranges(loads: list) -> list[tuple[int, int]]:
    """Ranges without gaps of densely numbered loads, neighbours joined."""
    merged: list[tuple[int, int]] = []
    for lo, hi in sorted((r["lo"], r["hi"]) for r in loads if r["dense"] and r["rows"]):
        if merged and merged[-1][1] + 1 == lo:
            merged[-1] = (merged[-1][0], hi)
        else:
            merged.append((lo, hi))
    return merged


def _id_spans(store: GraphStore, ranges: list[tuple[int, int]]) -> DataFrame:
    """(lo, hi) of the ids that exist: dense loads, and a span for each scan task."""
    bounds = {n: pa.array([r[i] for r in ranges], pa.int64()) for i, n in enumerate(("lo", "hi"))}
    dense = store.spark.createDataFrame(pa.table(bounds), "lo bigint, hi bigint")
    scans = store.registry("loads").where("kind = 'vertex' and not dense").select("load_id")
    scanned = store.registry("segments").join(scans, "load_id", "left_semi").where("rows > 0")
    first = F.shiftleft("segment", ROW_BITS)
    return dense.unionByName(scanned.select(first.alias("lo"), (first + F.col("rows") - 1).alias("hi")))


def _slab_bits(ids: int, partitions: int) -> int:
    """Ids are cut into slabs of 2^bits numbers, about this many for each partition."""
    return max(0, (ids // (SLABS * partitions)).bit_length())


def span_of(df: DataFrame, value: Column, spans: DataFrame, ids: int, name: str) -> DataFrame:
    """Adds ``name``: where the span (lo, hi) that holds the value starts; null if none does.

    Spans do not overlap.

    Both sides are cut into slabs of equal width, so that no slab has more than a small share
    of the ``ids`` that exist, and joined by slab.  A span is repeated in each slab it reaches
    into.  In a slab the last span that starts at or before the value is found by bisection.
    Rows without a value are dealt out by a hash of the row.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = _slab_bits(ids, partitions)
    slab = lambda c: F.shiftright(c, bits)
    reached = F.sequence(slab(F.col("lo")), slab(F.col("hi")))
    cut = spans.select("lo", "hi", F.explode(reached).alias("_wg_slab"))
    # As long as the number of loads and scan tasks that reach into one slab.
    slabs = cut.groupBy("_wg_slab").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("_wg_spans"))
    # Steps of the bisection: the powers of two below the number of spans, falling.
    last = F.floor(F.log2(F.size("_wg_spans").cast("double"))).cast("int")
    slabs = slabs.withColumn("_wg_steps", F.transform(F.sequence(last, F.lit(0), F.lit(-1)), lambda k: F.call_function("shiftleft", F.lit(1), k)))
    spread = F.lit(-1) - F.pmod(F.xxhash64(*[column(c) for c in df.columns]), F.lit(1 << 20))
    keyed = df.withColumn("_wg_key", F.when(value.isNotNull(), slab(value)).otherwise(spread))
    joined = keyed.join(slabs, F.col("_wg_key") == F.col("_wg_slab"), "left")

    def step(at: Column, size: Column) -> Column:
        ahead = at + size
        starts = F.get("_wg_spans", ahead - 1)["lo"]
        return F.when((ahead <= F.size("_wg_spans")) & (starts <= value), ahead).otherwise(at)

    before = F.aggregate("_wg_steps", F.lit(0), step)  # spans that start at or before the value
    last_span = F.when(before > 0, F.get("_wg_spans", before - 1))
    start = F.when(value <= last_span["hi"], last_span["lo"])
    return joined.select(*[column(c) for c in df.columns], start.alias(name))


def mark_dangling(ids: DataFrame, store: GraphStore) -> DataFrame:
    """Adds ``dangling``: is there no vertex of this ``vid``?

    No vertex table is read.  Loads numbered in key order have every id of their range, and
    scan tasks the first ids of their segments.  One range alone is compared with; more are
    looked up in slabs.
    """
    loads, vid = store.loads("vertex"), F.col("vid")
    ranges = _id_ranges(loads)
    if all(r["dense"] for r in loads) and len(ranges) <= 1:
        exists = vid.between(*ranges[0]) if ranges else F.lit(False)
        return ids.withColumn("dangling", vid.isNotNull() & ~exists)
    known = span_of(ids, vid, _id_spans(store, ranges), sum(r["rows"] for r in loads), "_wg_span")
    lost = vid.isNotNull() & F.col("_wg_span").isNull()
    return known.select(*[column(c) for c in ids.columns], lost.alias("dangling"))


@dataclass(frozen=True)
class Endpoints:
    """The resolved keys of one side of the edges.

    ``table`` has (key, n_edges, vid, via) for each distinct key.  ``via`` is
    ``map``, ``search``, ``dangling`` (the map names an id that no vertex has)
    or ``missing``; ``vid`` is null for the last two, which ``lost`` counts.
    ``hot`` holds the keys whose edge rows have to be dealt out.
    """

    table: DataFrame
    hot: DataFrame | None
    lost: int


def resolve_keys(
    store: GraphStore, keys: DataFrame, pk_map: DataFrame, fallback: Fallback, work: str
) -> Endpoints:
    """Looks the keys up in the map, and searches for those it does not have.

    A key in the map is never searched for, even if its id is dangling, and the
    label of its vertex is not looked at.
    """
    marked = stage(mark_dangling(map_lookup(keys, pk_map), store), f"{work}/looked_up")
    total, largest, missed, dangling = marked.agg(
        F.sum("n_edges"),
        F.max("n_edges"),
        F.count_if(F.col("vid").isNull()),
        F.count_if("dangling"),
    ).first()
    table = marked.where(F.col("vid").isNotNull()).select(
        "key",
        "n_edges",
        F.when(~F.col("dangling"), F.col("vid")).alias("vid"),
        F.when(F.col("dangling"), "dangling").otherwise("map").alias("via"),
    )
    lost = dangling
    if missed:
        absent = marked.where(F.col("vid").isNull()).select("key", "n_edges")
        found = fallback(absent.select("key"))
        if found is None:
            searched = absent.withColumn("vid", F.lit(None).cast("bigint"))
        else:
            searched = absent.join(found, "key", "left")
        via = F.when(F.col("vid").isNotNull(), "search").otherwise("missing")
        searched = stage(searched.withColumn("via", via), f"{work}/searched")
        lost += searched.where(F.col("vid").isNull()).count()
        table = table.unionByName(searched)
    return Endpoints(table, hot_keys_of(marked, "key", "n_edges", total, largest), lost)


def join_endpoints(
    edges: DataFrame,
    sides: list[tuple[str, DataFrame, DataFrame | None]],
    how: str,
) -> DataFrame:
    """Joins edge rows to columns of their endpoints, one side after the other.

    Each side is (edge key column, columns wanted: ``key`` and more, hot keys).
    The row's position in the scan deals out the rows of hot keys; it is taken
    before the first shuffle, where a repeated task sees the same rows.
    """
    columns = edges.columns
    if any(hot is not None for _, _, hot in sides):
        edges = edges.withColumn("_wg_position", F.monotonically_increasing_id())
    names = []
    for key, wanted, hot in sides:
        names += [c for c in wanted.columns if c != "key"]
        edges = salted_join(
            edges,
            wanted.withColumnRenamed("key", "_wg_key"),
            column(key),
            "_wg_key",
            hot,
            F.col("_wg_position"),
            how,
        )
    return edges.select(*names, *[column(c) for c in columns])


def resolved_edges(
    edges: DataFrame, key_a: str, key_b: str, ends_a: Endpoints, ends_b: Endpoints
) -> DataFrame:
    """Edge rows with ``_src`` (A) and ``_dst`` (B); all own columns are kept."""
    sides = [
        (
            key,
            ends.table.where(F.col("vid").isNotNull()).select("key", F.col("vid").alias(name)),
            ends.hot,
        )
        for key, ends, name in ((key_a, ends_a, "_src"), (key_b, ends_b, "_dst"))
    ]
    return join_endpoints(edges, sides, "inner")


def attached_edges(
    edges: DataFrame, key_a: str, key_b: str, ends_a: Endpoints, ends_b: Endpoints
) -> DataFrame:
    """All edge rows with ``_src`` and ``_dst``, or why there is none of them."""
    unfound = F.when(F.col("vid").isNull(), F.col("via"))
    sides = [
        (
            key,
            ends.table.select("key", F.col("vid").alias(name), unfound.alias(f"{name}_reason")),
            ends.hot,
        )
        for key, ends, name in ((key_a, ends_a, "_src"), (key_b, ends_b, "_dst"))
    ]
    return join_endpoints(edges, sides, "left")


def unresolved_edges(
    edges: DataFrame, key_a: str, key_b: str, ends_a: Endpoints, ends_b: Endpoints
) -> DataFrame:
    """Edge rows with an unresolved endpoint, and for each side why, else null."""
    names = ("_src_reason", "_dst_reason")
    sides = [
        (
            key,
            ends.table.where(F.col("vid").isNull()).select("key", F.col("via").alias(name)),
            ends.hot,
        )
        for key, ends, name in ((key_a, ends_a, names[0]), (key_b, ends_b, names[1]))
    ]
    joined = join_endpoints(edges, sides, "left")
    return joined.where(F.col(names[0]).isNotNull() | F.col(names[1]).isNotNull())
