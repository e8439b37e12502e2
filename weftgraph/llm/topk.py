"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Vectors become whole numbers, floor(256 x).  The index is cut into blocks; in a block
the postings of each dimension are grouped into segments of vectors whose component
has the same quantised impact.  A query takes the segments in descending order of
what they can add to a score, and keeps a lower bound of each score and one common
bound on what is still to come.  It stops when the k-th best lower bound is above what
any other vector can still reach; all vectors that can be among the k (ties included)
are then scored exactly.  Each block gives its k best, and k of these are the answer.

Vectors and queries meet in the cells of a grid: a cell gets some blocks of vectors and
some of the queries, both in bounded numbers, so no machine holds all of either.

Vectors that are null or hold null, NaN or infinite components take no part, neither
do empty ones.  A shorter vector counts as padded with zeros.  Rows with the query's
own vec_id are never its candidates; a repeated vec_id can take several ranks.
Components must stay within +-2^22, else the job fails instead of overflowing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
BLOCK_VECTORS = 8192
#: Queries of a cell at least, and at most; blocks of vectors of a cell at most.
CELL_QUERIES, MOST_QUERIES, MOST_BLOCKS = 512, 1 << 16, 32
#: Cells that are enough to keep all cores busy; more of them move more bytes.
CELLS = 128
#: Width of a quantised impact, in units of 1 / SCALE.
IMPACT = 16
#: Segments taken between two tests for the end.
STRIDE = 96
MOST = 1 << 22


def whole_numbers(vector: Column) -> Column:
    """The vector as whole numbers; null if it takes no part."""
    limit = F.lit(float("inf"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    return F.when(vector.isNotNull() & sound & (F.size(vector) > 0), numbers)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of numbers as rows, padded with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and np.abs(flat).max() > MOST:
        raise ValueError(f"components beyond {MOST} are not supported")
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


class Block:
    """Postings of one block: segments (dimension, quantised impact, vectors)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        level = vectors // IMPACT
        dimension, impact, members = [], [], []
        for d in range(vectors.shape[1]):
            order = np.argsort(level[:, d], kind="stable").astype(np.int32)
            values, starts = np.unique(level[order, d], return_index=True)
            for value, part in zip(values, np.split(order, starts[1:])):
                dimension.append(d)
                impact.append(value * IMPACT)
                members.append(part)
        self.dimension = np.array(dimension, np.int64)
        self.low = np.array(impact, np.int64)  # a component is in [low, low + IMPACT)
        self.members = members
        self.sizes = np.array([len(x) for x in members], np.int64)

    def best(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and score of the k best for one query."""
        width = self.vectors.shape[1]
        query = np.pad(query, (0, max(0, width - len(query))))[:width]  # what is beyond meets zeros
        weight = query[self.dimension]
        # The least that a vector of each segment gets from it, above the least in its dimension.
        least = np.minimum(weight * self.low, weight * (self.low + IMPACT - 1))
        floor = np.full(width, np.iinfo(np.int64).max)
        np.minimum.at(floor, self.dimension, least)
        gain = least - floor[self.dimension]
        slack = int(np.abs(query).sum()) * (IMPACT - 1)  # what quantising can hide in all
        order = np.argsort(-gain, kind="stable")
        order = order[gain[order] > 0]
        # Still to come after each segment: of every dimension the next segment's impact.
        by_dimension = np.argsort(self.dimension[order], kind="stable")
        sorted_gain, sorted_dimension = gain[order][by_dimension], self.dimension[order][by_dimension]
        following = np.zeros(len(order), np.int64)
        same = sorted_dimension[1:] == sorted_dimension[:-1]
        following[by_dimension[:-1][same]] = sorted_gain[1:][same]
        ahead = np.zeros(width, np.int64)
        np.maximum.at(ahead, self.dimension, gain)
        rest_after = ahead.sum() + np.cumsum(following - gain[order])

        open_to = self.ids != own
        wanted = min(k, int(open_to.sum()))
        if not wanted:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lower = np.where(open_to, 0, np.iinfo(np.int64).min // 2)
        rest, possible = int(ahead.sum()), open_to
        for at in range(0, len(order), STRIDE):
            part = order[at : at + STRIDE]
            members = np.concatenate([self.members[s] for s in part])
            gains = np.repeat(gain[part], self.sizes[part])
            lower += np.bincount(members, gains, len(lower)).astype(np.int64)
            rest = int(rest_after[at + len(part) - 1])
            bar = np.partition(lower, -wanted)[-wanted]
            # No vector that is below the bar by more than this can still reach it.
            possible = lower + (rest + slack) >= bar
            if np.count_nonzero(possible) <= max(4 * k, 64):
                break
        rows = np.flatnonzero(possible & open_to)
        scores = self.vectors[rows] @ query
        first = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[first], scores[first]


def _grid(vectors: int, queries: int) -> tuple[int, int]:
    """Into how many parts so many vectors and queries are dealt; cells grow before their number does."""
    blocks, groups = max(1, -(-vectors // BLOCK_VECTORS)), max(1, -(-queries // CELL_QUERIES))
    groups = -(-groups // max(1, min(MOST_QUERIES // CELL_QUERIES, blocks * groups // CELLS)))
    return -(-blocks // max(1, min(MOST_BLOCKS, blocks * groups // CELLS))), groups


_PACK_DDL = "part bigint, ids binary, width int, bytes int, numbers binary"


def _dealt(vectors: DataFrame, parts: int) -> DataFrame:
    """Vectors dealt into parts; one row for each part of a batch, its numbers in as few bytes as they need."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part, ids = batch.column("_part").to_numpy(), batch.column("vec_id").to_numpy().astype(np.int64)
            values = _matrix(batch.column("_vector"))
            kinds = (np.int8, np.int16, np.int32, np.int64)
            values = values.astype(next(x for x in kinds if values.min() >= np.iinfo(x).min and values.max() <= np.iinfo(x).max))
            order = np.argsort(part, kind="stable")
            cuts = np.split(order, np.flatnonzero(np.diff(part[order])) + 1)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part[x[0]] for x in cuts], pa.int64()), "ids": pa.array([ids[x].tobytes() for x in cuts], pa.binary()),
                "width": pa.array([values.shape[1]] * len(cuts), pa.int32()), "bytes": pa.array([values.itemsize] * len(cuts), pa.int32()),
                "numbers": pa.array([values[x].tobytes() for x in cuts], pa.binary())})

    part = F.pmod(F.xxhash64("vec_id", "_vector"), F.lit(parts))
    return vectors.select("vec_id", "_vector", part.alias("_part")).mapInArrow(pack, _PACK_DDL)


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, padded with zeros, in the widest of their types."""
    rows = [table.column(c).to_pylist() for c in ("width", "bytes")]
    ids, numbers = ([x.as_buffer() for x in table.column(c)] for c in ("ids", "numbers"))
    ids = [np.frombuffer(x, np.int64) for x in ids]
    lengths = np.array([len(x) for x in ids], np.int64)
    out = np.zeros((int(lengths.sum()), max(rows[0], default=0)), f"i{max(rows[1], default=8)}")
    for end, count, width, size, x in zip(np.cumsum(lengths), lengths, *rows, numbers):
        out[end - count : end, :width] = np.frombuffer(x, f"i{size}").reshape(count, width)
    return np.concatenate([np.zeros(0, np.int64), *ids]), out


def _best_of_cell(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best of the vectors for each of the queries; one block of vectors is indexed at a time."""
    (ids, values), (asked, wanted) = _unpacked(vectors), _unpacked(queries)
    query, vec_id, score = [np.zeros(0, np.int64)] * 3
    for rows in np.array_split(np.arange(len(ids)), max(1, round(len(ids) / BLOCK_VECTORS))):
        if not len(rows) or not len(asked):
            continue
        block = Block(ids[rows], values[rows].astype(np.int64))
        found = [block.best(own, wanted[q].astype(np.int64), k) for q, own in enumerate(asked)]
        query = np.concatenate([query, np.repeat(np.arange(len(asked)), [len(r) for r, _ in found])])
        vec_id = np.concatenate([vec_id, *(block.ids[r] for r, _ in found)])
        score = np.concatenate([score, *(s for _, s in found)])
        order = np.lexsort((vec_id, -score, query))
        order = order[np.arange(len(order)) - np.searchsorted(query[order], query[order]) < k]
        query, vec_id, score = query[order], vec_id[order], score[order]
    return pa.table({"query_id": pa.array(asked[query], pa.int64()), "vec_id": pa.array(vec_id, pa.int64()), "score": pa.array(score, pa.int64())})


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each query.

    Every part of the queries meets every part of the vectors in one cell.  Both are
    shuffled to it and neither is broadcast: the queries once for each part of the
    vectors would not fit the driver.
    """
    clean = lambda df: df.select("vec_id", whole_numbers(F.col("embedding")).alias("_vector")).where("_vector is not null")
    index, asked = clean(vectors), clean(queries)
    blocks, groups = _grid(index.count(), asked.count())

    def celled(packs: DataFrame, others: int, cell: Column) -> DataFrame:
        sent = packs.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).withColumn("cell", cell)
        return sent.drop("part", "other").repartition(blocks * groups, "cell").groupBy("cell")

    left = celled(_dealt(index, blocks), groups, F.col("part") * groups + F.col("other"))
    right = celled(_dealt(asked, groups), blocks, F.col("other") * groups + F.col("part"))

    def per_cell(one: pa.Table, two: pa.Table) -> pa.Table:
        return _best_of_cell(one, two, k)

    best = left.cogroup(right).applyInArrow(per_cell, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
