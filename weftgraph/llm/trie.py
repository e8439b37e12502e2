"""The prefix trie of conversations, and sums over its subtrees by an Euler tour.

Turns are numbered per conversation, heads are shared as ``rebuilt`` says, and a node is
what conversations with the same first turns have in common.  A prefix is known by two
62-bit sums over hashes of its turns with their places, which a running sum gives.

The tour goes down and up every edge: a node has an enter and an exit arc, each with the
arc that follows.  To rank this list, arcs are range-partitioned by the node's smallest
member, so that most of them follow an arc of the same block; paths within a block become
one link, and the links that are left are ranked by pointer jumping, one join a round.
What a subtree holds is the difference of the sums at its two arcs.

Nothing is gathered by conversation, parent or node: order and running sums come from
range-partitioned rows and one number per partition, so a conversation, a parent or a
group of copies may be as large as it likes.  Only the digest of the members that end at
a node runs through one task, in chunks of ids that were joined before.

Null roles and texts are empty.  Turns of one number are ordered by a hash of role and
text; rows without ``conv_id`` take no part.  An empty table has no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import stage
from weftgraph.operators.skew import hot_keys, salted_join

#: Hashes are summed modulo 2^62, so that two sums never leave a long.
MASK = (1 << 62) - 1
#: Fixed values of the contract: conversations that share a head, and lengths of heads.
FAMILY, HEADS = 5, 9
#: Arcs that a task ranks at once, and ids that are joined before they are digested.
BLOCK_ARCS, CHUNK_IDS = 1 << 18, 4096


# -- running numbers ---------------------------------------------------------------


def running(df: DataFrame, key: list[str], order: list[Column], sums: list[str], purpose: str) -> DataFrame:
    """Adds ``rank``, the row's number within ``key``, and running sums modulo 2^62.

    Rows are range-partitioned by key and order, so a key may span partitions.  Each
    partition starts from nothing; what earlier ones carry into it is one row for each
    partition.  ``key`` names columns of whole numbers without nulls.
    """
    ordered = [*map(F.col, key), *order]
    ranged = df.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    totals = [f"{s}_run" for s in sums]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    schema = ", ".join([*fields, "rank bigint", *[f"{t} bigint" for t in totals], "_part int, _row bigint"])

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, last, state = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in key])
            values = [np.ones(n, np.uint64)]
            values += [batch.column(s).to_numpy(zero_copy_only=False).astype(np.uint64) for s in sums]
            starts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            lengths = np.diff(np.concatenate([[0], starts, [n]]))
            out = []
            for i, value in enumerate(values):
                run = np.cumsum(value, dtype=np.uint64)
                before = np.concatenate([np.zeros(1, np.uint64), run[starts - 1]])
                if last is not None and (keys[:, 0] == last).all():
                    before[:1] -= state[i]
                out.append((run - np.repeat(before, lengths)) & np.uint64(MASK))
            last, state = keys[:, -1], [x[-1] for x in out]
            more = [pa.array(x.astype(np.int64)) for x in out]
            more += [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seen, seen + n))]
            seen += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "rank", *totals, "_part", "_row"])

    local = stage(ranged.mapInArrow(per_task, schema), purpose)
    # One row for each partition: the key that it ends with, and where this has got to.
    ends = local.groupBy("_part").agg(F.max_by(F.struct(*key, "rank", *totals), "_row").alias("end")).orderBy("_part").collect()
    carried, last, state = [], None, (0,) * (1 + len(sums))
    for row in ends:
        own, reached = tuple(row["end"][: len(key)]), tuple(row["end"][len(key) :])
        if last is not None:
            carried.append((row["_part"], *last, *state))
        state = tuple((x + y) & MASK for x, y in zip(state, reached)) if own == last else reached
        last = own
    names = ["_carried_to", *[f"_key_{k}" for k in key], *[f"_carry_{t}" for t in ("rank", *totals)]]
    columns = {x: pa.array([c[i] for c in carried], pa.int64()) for i, x in enumerate(names)}
    carry = df.sparkSession.createDataFrame(pa.table(columns))
    same = F.col("_part") == F.col("_carried_to")
    for k in key:
        same = same & (F.col(k) == F.col(f"_key_{k}"))
    joined = local.join(F.broadcast(carry), same, "left")
    added = [
        (F.col(t) + F.coalesce(F.col(f"_carry_{t}"), F.lit(0))).bitwiseAND(F.lit(MASK)).alias(t) for t in ("rank", *totals)
    ]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *added)


# -- conversations -------------------------------------------------------------------


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, place, a, b, bytes) with shared heads; and (conv_id, turns) of all.

    Conversation c has the first h turns of conversation c - c % 5, then its own after its
    first h; h = crc32(c) % 9.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    own = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("at"),
    )
    own = stage(own, "turn-hashes")
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b"), F.col("at")]
    turns = running(own, ["conv_id"], order, [], "turns").drop("turn", "at")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS)).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    lengths = turns.groupBy("conv_id").agg(F.max("rank").alias("own"))
    lengths = lengths.select("conv_id", "own", head.alias("head"), base.alias("base"))
    firsts = turns.where(F.col("rank") < HEADS).groupBy(F.col("conv_id").alias("base"))
    firsts = firsts.agg(F.sort_array(F.collect_list(F.struct("rank", "a", "b", "bytes"))).alias("firsts"))
    lengths = lengths.join(firsts, "base", "left")
    shared = F.slice(F.coalesce("firsts", F.array().cast(firsts.schema["firsts"].dataType)), F.lit(1), F.col("head"))
    lengths = stage(lengths.select("conv_id", "own", "head", shared.alias("shared")), "conversation-heads")
    shift = F.size("shared") - F.col("head")
    heads = lengths.select("conv_id", F.explode("shared").alias("t")).select("conv_id", "t.rank", "t.a", "t.b", "t.bytes")
    short = lengths.select(F.col("conv_id").alias("_conv"), shift.alias("shift")).where("shift <> 0")
    tails = salted_join(
        turns.where(F.col("rank") > head), short, F.col("conv_id"), "_conv", hot_keys(lengths, "conv_id", "own"), F.col("rank"), "left"
    )
    place = F.col("rank") + F.coalesce("shift", F.lit(0))
    tails = tails.select("conv_id", place.alias("rank"), "a", "b", "bytes")
    sizes = lengths.select("conv_id", (F.size("shared") + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("turns"))
    return heads.unionByName(tails).withColumnRenamed("rank", "place"), sizes


def _nodes(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, parent, conv_id, n_convs, bytes); and (node, conv_id) of what ends at each."""
    mixed = [
        F.xxhash64(F.lit(seed), "place", "a", "b").bitwiseAND(F.lit(MASK)).alias(name) for seed, name in ((3, "x"), (4, "y"))
    ]
    turns = stage(turns.select("conv_id", "place", "bytes", *mixed), "rebuilt-turns")
    prefixes = running(turns, ["conv_id"], [F.col("place")], ["x", "y"], "prefixes")
    before = [(F.col(f"{c}_run") - F.col(c)).bitwiseAND(F.lit(MASK)).alias(c) for c in "xy"]
    prefixes = prefixes.select(
        "conv_id",
        "bytes",
        F.struct(F.col("place").alias("depth"), F.col("x_run").alias("x"), F.col("y_run").alias("y")).alias("node"),
        F.struct((F.col("place") - 1).alias("depth"), *before).alias("parent"),
    )
    depth_type = prefixes.schema["node"].dataType
    nodes = prefixes.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes")
    )
    top = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("depth", "x", "y")]).cast(depth_type)
    root = sizes.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(top.alias("node"), F.lit(None).cast(depth_type).alias("parent"), "conv_id", "n_convs", F.lit(0).cast("long").alias("bytes"))
    ends = prefixes.groupBy("conv_id").agg(F.max("node").alias("node")).select("node", "conv_id")
    turnless = sizes.where("turns = 0").select(top.alias("node"), "conv_id")
    return stage(nodes.unionByName(root), "nodes"), stage(ends.unionByName(turnless), "ends")


def _end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of the sorted ids that end at a node."""
    numbers = ends.select("node.depth", "node.x", "node.y", "conv_id")
    order = ("depth", "x", "y", "conv_id")
    schema = "depth bigint, x bigint, y bigint, first bigint, ids string"

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = np.stack([batch.column(c).to_numpy() for c in order[:3]])
            ids = batch.column("conv_id").to_numpy()
            starts = np.flatnonzero((node[:, 1:] != node[:, :-1]).any(0)) + 1
            stretches = [
                (at, min(at + CHUNK_IDS, e))
                for s, e in zip([0, *starts], [*starts, len(ids)])
                for at in range(s, e, CHUNK_IDS)
            ]
            first = np.array([s for s, _ in stretches], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x[first]) for x in node), pa.array(ids[first]), pa.array([",".join(map(str, ids[s:e])) for s, e in stretches], pa.string())],
                [*order[:3], "first", "ids"],
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None

        def found(rows: list) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*order[:3], "ends_sha256"])

        for batch in batches:
            done = []
            for *node, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node == last:
                    digest.update(b",")
                else:
                    if last is not None:
                        done.append((*last, digest.hexdigest()))
                    last, digest = node, hashlib.sha256()
                digest.update(ids.encode())
            yield found(done)
        if last is not None:
            yield found([(*last, digest.hexdigest())])

    ranged = numbers.repartitionByRange(*order).sortWithinPartitions(*order)
    joined = stage(ranged.mapInArrow(chunks, schema), "end-chunks")
    by_node = joined.repartition(*order[:3]).sortWithinPartitions(*order[:3], "first")
    hashed = by_node.mapInArrow(digests, "depth bigint, x bigint, y bigint, ends_sha256 string")
    return hashed.select(F.struct("depth", "x", "y").alias("node"), "ends_sha256")


def _tree(nodes: DataFrame) -> DataFrame:
    """Nodes with depth, parent_conv_id, n_children, first child and next sibling.

    A node is told by its depth and its smallest member.
    """
    below = nodes.where("parent is not null")
    kids = below.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"), F.min("conv_id").alias("first_child"))
    kids = stage(kids, "children")
    parents = nodes.select(F.col("node").alias("_node"), F.col("conv_id").alias("parent_conv_id"))
    placed = salted_join(below, parents, F.col("parent"), "_node", hot_keys(kids, "parent", "n_children"), F.col("conv_id"))
    placed = placed.withColumn("depth", F.col("node.depth"))
    placed = stage(placed.select("node", "conv_id", "depth", "parent_conv_id", "n_convs", "bytes"), "children-of-parents")
    ranked = running(placed, ["parent_conv_id", "depth"], [F.col("conv_id")], [], "siblings")
    following = ranked.select(
        "parent_conv_id", "depth", (F.col("rank") - 1).alias("rank"), F.col("conv_id").alias("next_sibling")
    )
    ranked = ranked.join(following, ["parent_conv_id", "depth", "rank"], "left").drop("rank")
    root = nodes.where("parent is null").select("node", "conv_id", F.col("node.depth").alias("depth"), "n_convs", "bytes")
    tree = ranked.unionByName(root, allowMissingColumns=True)
    tree = tree.join(kids.withColumnRenamed("parent", "node"), "node", "left")
    return stage(tree.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "tree")


# -- the Euler tour --------------------------------------------------------------------

WEIGHTS = ("arcs", "leaves", "saved")


def _arcs(tree: DataFrame) -> DataFrame:
    """(c, k, next_c, next_k, weights): arc 2 * depth enters a node and the next exits it."""
    enter, leave = F.col("depth") * 2, F.col("depth") * 2 + 1
    inner, more = F.col("n_children") > 0, F.col("next_sibling").isNotNull()
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    down = F.struct(
        enter.alias("k"),
        F.when(inner, F.col("first_child")).otherwise(F.col("conv_id")).alias("next_c"),
        F.when(inner, enter + 2).otherwise(leave).alias("next_k"),
        one.alias("arcs"),
        F.when(inner, none).otherwise(one).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    up = F.struct(
        leave.alias("k"),
        F.coalesce("next_sibling", "parent_conv_id").alias("next_c"),
        F.when(more, enter).when(F.col("parent_conv_id").isNotNull(), leave - 2).alias("next_k"),
        one.alias("arcs"),
        none.alias("leaves"),
        none.alias("saved"),
    )
    return tree.select(F.col("conv_id").alias("c"), F.explode(F.array(down, up)).alias("arc")).select("c", "arc.*")


def _paths(c: np.ndarray, k: np.ndarray, next_c: np.ndarray, next_k: np.ndarray, weights: np.ndarray):
    """Paths within a block of arcs sorted by (c, k): each arc's first and last, and sums up to the last.

    The arcs of one c follow each other without gaps in k.  ``next_k`` is -1 at the end.
    """
    n = len(c)
    first = np.minimum(np.searchsorted(c, next_c), n - 1)
    at = np.clip(first + next_k - k[first], 0, n - 1)
    here = (next_k >= 0) & (c[at] == next_c) & (k[at] == next_k)
    to = np.where(here, at, -1)
    entry = np.ones(n, bool)
    entry[to[here]] = False
    last, sums, hop = np.arange(n), weights.copy(), to.copy()
    while True:
        going = np.flatnonzero(hop >= 0)
        if not len(going):
            break
        target = hop[going]
        step, end, after = sums[:, target], last[target], hop[target]
        sums[:, going] += step
        last[going], hop[going] = end, after
    start_of = np.zeros(n, np.int64)
    start_of[last[entry]] = np.flatnonzero(entry)
    return start_of[last], last, sums


def _ranked(arcs: DataFrame) -> DataFrame:
    """(c, k, weights): sums over the tour from each arc to its end, this arc included."""
    names = ["c", "k", "next_c", "next_k", *WEIGHTS]
    schema = ", ".join(f"{x} bigint" for x in (*names, "first_c", "first_k"))

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            rows = np.concatenate(held, axis=1)
            c, k, next_c, next_k, *weights = rows
            first, last, sums = _paths(c, k, next_c, next_k, np.array(weights))
            columns = [c, k, next_c[last], next_k[last], *sums, c[first], k[first]]
            arrays = [pa.array(x, pa.int64(), mask=(next_k[last] < 0) if i in (2, 3) else None) for i, x in enumerate(columns)]
            return pa.RecordBatch.from_arrays(arrays, [*names, "first_c", "first_k"])

        for batch in batches:
            held.append(np.stack([batch.column(x).fill_null(-1).to_numpy() for x in names]))
            if sum(h.shape[1] for h in held) >= BLOCK_ARCS:
                yield block()
                held = []
        if sum(h.shape[1] for h in held):
            yield block()

    ranged = arcs.select(names).repartitionByRange("c", "k").sortWithinPartitions("c", "k")
    local = stage(ranged.mapInArrow(per_task, schema), "paths")
    links = stage(local.where("c = first_c and k = first_k").select(names), "links")
    while links.where("next_k is not null").count():
        ahead = links.select([F.col(x).alias(f"_{x}") for x in names])
        same = (F.col("next_c") == F.col("_c")) & (F.col("next_k") == F.col("_k"))
        summed = [(F.col(w) + F.coalesce(F.col(f"_{w}"), F.lit(0))).alias(w) for w in WEIGHTS]
        hops = [F.col(f"_{x}").alias(x) for x in ("next_c", "next_k")]
        links = stage(links.join(ahead, same, "left").select("c", "k", *hops, *summed), "links")
    # What follows a path: the sum from its first arc less the path's own.
    whole = links.select(F.col("c").alias("first_c"), F.col("k").alias("first_k"), *[F.col(w).alias(f"_{w}") for w in WEIGHTS])
    own = local.where("c = first_c and k = first_k").select("first_c", "first_k", *WEIGHTS)
    after = own.join(whole, ["first_c", "first_k"])
    after = stage(after.select("first_c", "first_k", *[(F.col(f"_{w}") - F.col(w)).alias(f"_{w}") for w in WEIGHTS]), "after-paths")
    joined = local.join(after, ["first_c", "first_k"])
    return joined.select("c", "k", *[(F.col(w) + F.col(f"_{w}")).alias(w) for w in WEIGHTS])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie, with its place in the tour and its subtree's sums."""
    turns, sizes = rebuilt(conversations)
    nodes, ends = _nodes(turns, sizes)
    tree = _tree(nodes)
    entering = F.col("k") % 2 == 0
    signed = [F.sum(F.when(entering, F.col(w)).otherwise(-F.col(w))).alias(w) for w in WEIGHTS[1:]]
    # The sums run to the end of the tour, so a node's place counts from there.
    place = F.max("arcs").alias("arcs_to_end")
    sums = _ranked(_arcs(tree)).groupBy("c", (F.shiftright("k", 1)).alias("d")).agg(*signed, place)
    found = tree.join(sums, (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d")))
    found = found.join(_end_digests(ends), "node", "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        "arcs_to_end",
    )
