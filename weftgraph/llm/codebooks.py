"""Vector codes from codebooks that Lloyd's rounds improve over cover trees.

Vectors become whole numbers, floor(4096 x), and are cut into 8 equal parts; each part
position has a codebook of up to 16 entries.  Every task builds cover trees over the
vectors that it scanned, a tree for each block of vectors and part position, and writes
them once.  A tree holds its points in tree order with cumulative sums, so a subtree is
a stretch of points and its sum two look-ups.

A round reads the trees and not the vectors.  By the triangle inequality a node whose
points are within ``r`` of its centre can belong only to entries that are within 2 r of
the centre's nearest entry.  If one is left, the whole subtree goes to it; only nodes
with several go on to their children, and the points of leaves are compared exactly.
A task adds up its blocks before anything is shuffled, and the driver gets one number
for each codebook component, whatever the size of the table.

All arithmetic is in whole numbers; square roots only rule entries out, with a margin.
So blocks and trees change the speed and never a result.

Vectors that are null or hold null, NaN or infinite components are left out.  Shorter
vectors count as padded with zeros, to the longest length rounded up to a multiple of 8.
The first codebooks are the 16 smallest ids' vectors (rows of one id by their vectors,
null ids last); fewer rows make fewer entries.  Rows that repeat an id are rows like
others, and null labels are one label.  An empty table gives an empty result.
Components whose squared distances might leave 64 bits end the job (65,000 in vectors of
64 are fine).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.common import stage

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors in a block, and components where vectors are long.
BLOCK_VECTORS, BLOCK_NUMBERS = 2048, 1 << 18
#: A node with so many points is not divided further.
LEAF_POINTS = 16
#: Squared distances stay below this, and so within 64 bits.
MOST = 1 << 62
#: By so much a rounded distance is stretched before it rules anything out.
MARGIN = 1 + 1e-9


def usable(vector: Column) -> Column:
    """Is the vector there, with finite components only?"""
    limit = F.lit(float("inf"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return vector.isNotNull() & F.coalesce(sound, F.lit(False))


def whole_numbers(lists: pa.Array, width: int) -> np.ndarray:
    """floor(4096 x) of each list, padded with zeros to ``width``."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(flat) and 4 * np.abs(flat).max() ** 2 * width > MOST:
        raise ValueError(f"components of {np.abs(flat).max() / SCALE:g} in vectors of {width} are not supported")
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each entry, in whole numbers."""
    if not points.shape[1]:
        return np.zeros((len(points), len(entries)), np.int64)
    return ((points[:, None, :] - entries[None, :, :]) ** 2).sum(2)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all stretches (start, size), one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


class CoverTree:
    """Points in tree order; a node is a stretch of them that starts with its centre."""

    FIELDS = ("order", "start", "end", "child", "children")

    def __init__(self, points: np.ndarray, order, start, end, child, children, radius):
        self.points, self.order, self.radius = points, order, radius  # points: in tree order
        self.start, self.end, self.child, self.children = start, end, child, children
        self.sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, 0)])

    @classmethod
    def build(cls, points: np.ndarray) -> CoverTree:
        """Children cover their parent's points within half its radius.

        Centres are taken one after the other from the points that no earlier one covers,
        the parent's own centre first, so they are more than that half apart.
        """
        order = np.arange(len(points))
        start, end, child, children, radius = [0], [len(points)], [], [], []
        node = 0
        while node < len(start):
            lo, hi = start[node], end[node]
            members = order[lo:hi].copy()
            distance = ((points[members] - points[members[0]]) ** 2).sum(1)
            far = int(distance.max(initial=0))
            radius.append(far)
            if far == 0 or hi - lo <= LEAF_POINTS:
                child.append(0)
                children.append(0)
                node += 1
                continue
            child.append(len(start))
            at, left, near = lo, members, distance * 4 <= far
            while True:
                order[at : at + int(near.sum())] = left[near]
                start.append(at)
                at += int(near.sum())
                end.append(at)
                left = left[~near]
                if not len(left):
                    break
                near = ((points[left] - points[left[0]]) ** 2).sum(1) * 4 <= far
            children.append(len(start) - child[-1])
            node += 1
        numbers = (np.array(x, np.int64) for x in (start, end, child, children))
        return cls(points[order], order, *numbers, np.sqrt(np.array(radius, np.float64)))

    def assign(self, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(starts, ends, entry) of stretches of points and the entry nearest to all of them."""
        nodes = np.zeros(min(1, len(self.points)), np.int64)
        open_to = np.ones((len(nodes), len(entries)), bool)
        while len(nodes):
            exact = squares(self.points[self.start[nodes]], entries)
            nearest = exact.argmin(1)  # the first of equals
            distance = np.where(open_to, np.sqrt(exact.astype(np.float64)), np.inf)
            reach = (distance.min(1) + 2 * self.radius[nodes]) * MARGIN
            open_to &= distance <= reach[:, None]
            settled = (open_to.sum(1) == 1) | (self.radius[nodes] == 0)
            yield self.start[nodes[settled]], self.end[nodes[settled]], nearest[settled]
            leaf = ~settled & (self.children[nodes] == 0)
            points = spread(self.start[nodes[leaf]], (self.end - self.start)[nodes[leaf]])
            yield points, points + 1, squares(self.points[points], entries).argmin(1)
            inner = ~settled & ~leaf
            below = self.children[nodes[inner]]
            open_to = np.repeat(open_to[inner], below, axis=0)
            nodes = spread(self.child[nodes[inner]], below)

    # -- as a row -----------------------------------------------------------------

    TYPE = "struct<" + ",".join(f"{f}:array<int>" for f in FIELDS) + ",radius:array<double>,points:binary>"

    def row(self) -> dict:
        numbers = {f: getattr(self, f).astype(np.int32) for f in self.FIELDS}
        return numbers | {"radius": self.radius, "points": self.points.astype(np.int32).tobytes()}

    @classmethod
    def of_row(cls, row: pa.StructScalar, width: int) -> CoverTree:
        order, start, end, child, children = (
            row[f].values.to_numpy(zero_copy_only=False).astype(np.int64) for f in cls.FIELDS
        )
        points = np.frombuffer(row["points"].as_py(), np.int32).reshape(len(order), width)
        return cls(points.astype(np.int64), order, start, end, child, children, row["radius"].values.to_numpy())


def _trees(kept: DataFrame, width: int) -> DataFrame:
    """One row for each block of vectors: ids, labels and a tree for each part position."""
    ids, labels = (kept.schema[c].dataType for c in ("vec_id", "label"))
    schema = f"ids array<{ids.simpleString()}>, labels array<{labels.simpleString()}>, trees array<{CoverTree.TYPE}>"
    size, step = max(1, min(BLOCK_VECTORS, BLOCK_NUMBERS // max(1, width))), width // PARTS

    def block(rows: pa.Table) -> pa.RecordBatch:
        vectors = whole_numbers(rows.column("embedding").combine_chunks(), width)
        trees = [CoverTree.build(vectors[:, p * step : (p + 1) * step]).row() for p in range(PARTS)]
        fields = {f: pa.list_(pa.int32()) for f in CoverTree.FIELDS}
        kind = pa.struct([*fields.items(), ("radius", pa.list_(pa.float64())), ("points", pa.binary())])
        lists = [
            pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(c).combine_chunks())
            for c in ("vec_id", "label")
        ]
        return pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.list_(kind))], ["ids", "labels", "trees"])

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                new = pa.Table.from_batches([batch])
                held = new if held is None else pa.concat_tables([held, new])
            while held is not None and held.num_rows >= size:
                yield block(held.slice(0, size))
                held = held.slice(size)
        if held is not None and held.num_rows:
            yield block(held)

    return kept.select("vec_id", "label", "embedding").mapInArrow(per_task, schema)


def _sums(trees: DataFrame, codebooks: list[np.ndarray], step: int) -> dict[tuple[int, int], list[int]]:
    """(part, entry) -> how many parts are nearest to the entry, and their sums."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(entries), 1 + step), np.int64) for entries in codebooks]
        for batch in batches:
            for row in batch.column("trees"):
                for part, entries in enumerate(codebooks):
                    tree = CoverTree.of_row(row[part], step)
                    for starts, ends, entry in tree.assign(entries):
                        np.add.at(totals[part][:, 0], entry, ends - starts)
                        np.add.at(totals[part][:, 1:], entry, tree.sums[ends] - tree.sums[starts])
        part, entry = np.indices((len(codebooks), len(codebooks[0])))
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(part.ravel(), pa.int32()),
            "entry": pa.array(entry.ravel(), pa.int32()),
            "numbers": pa.array(list(np.concatenate(totals)), pa.list_(pa.int64())),
        })

    found = trees.select("trees").mapInArrow(per_task, "part int, entry int, numbers array<bigint>")
    found = found.select("part", "entry", F.posexplode("numbers").alias("place", "number"))
    total = F.sum(F.col("number").cast("decimal(38,0)")).alias("total")
    sums: dict[tuple[int, int], list[int]] = {}
    rows = found.groupBy("part", "entry", "place").agg(total).collect()
    for row in sorted(rows):
        sums.setdefault((row["part"], row["entry"]), []).append(int(row["total"]))
    return sums


def train(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]] | None:
    """The staged trees and the codebooks after the rounds; None if no vector is left."""
    kept = vectors.where(usable(F.col("embedding"))).select("vec_id", "label", "embedding")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).collect()
    if not first:
        return None
    longest = kept.agg(F.max(F.size("embedding"))).first()[0]
    step = -(-longest // PARTS)
    start = whole_numbers(pa.array([r["embedding"] for r in first], pa.list_(pa.float64())), step * PARTS)
    codebooks = [start[:, p * step : (p + 1) * step] for p in range(PARTS)]
    trees = stage(_trees(kept, step * PARTS), "cover-trees")
    for _ in range(rounds):
        sums = _sums(trees, codebooks, step)
        codebooks = [
            np.array(
                [
                    [x // sums[part, e][0] for x in sums[part, e][1:]] if sums[part, e][0] else list(entry)
                    for e, entry in enumerate(entries)
                ],
                np.int64,
            ).reshape(entries.shape)
            for part, entries in enumerate(codebooks)
        ]
    return trees, codebooks


def encode(trees: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """(vec_id, label, code, error): for each vector its entries and their squared distances."""
    step = codebooks[0].shape[1]
    fields = {f.name: f.dataType.elementType for f in trees.schema.fields if f.name in ("ids", "labels")}
    schema = T.StructType([
        T.StructField("vec_id", fields["ids"]),
        T.StructField("label", fields["labels"]),
        T.StructField("code", T.StringType()),
        T.StructField("error", T.LongType()),
    ])

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.column("trees")):
                ids = batch.column("ids").slice(i, 1).flatten()
                code, error = np.zeros((len(ids), len(codebooks)), np.uint8), np.zeros(len(ids), np.int64)
                for part, entries in enumerate(codebooks):
                    tree = CoverTree.of_row(row[part], step)
                    own = np.zeros(len(ids), np.int64)
                    for starts, ends, entry in tree.assign(entries):
                        own[spread(starts, ends - starts)] = np.repeat(entry, ends - starts)
                    code[tree.order, part] = own
                    error[tree.order] += ((tree.points - entries[own]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [ids, batch.column("labels").slice(i, 1).flatten(), pa.array([c.tobytes().hex() for c in code]), pa.array(error)],
                    ["vec_id", "label", "code", "error"],
                )

    return trees.mapInArrow(per_task, schema)


def codebooks_digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for c in codebooks for x in c.ravel()).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label, label_error, codebooks_sha256) for each kept vector."""
    trained = train(vectors)
    if trained is None:
        none = vectors.where("false").select("vec_id", "label")
        columns = {"code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
        return none.select("*", *[F.lit(None).cast(t).alias(c) for c, t in columns.items()])
    trees, codebooks = trained
    coded = stage(encode(trees, codebooks), "codes")
    # Written, so that the join can split a label that many rows have.
    errors = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    errors = stage(errors, "label-errors")
    joined = coded.join(errors, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    return joined.withColumn("codebooks_sha256", F.lit(codebooks_digest(codebooks)))
