"""Best-fit packing of token sequences by large-item matching.

Documents longer than the capacity are cut into full pieces, which fill sequences of
their own, and a first piece with the rest.  What is left has lengths below the
capacity, so the corpus is described by its number of pieces of each length.  From
these counts the packing is planned in runs of equal sequences: pieces above one third
of the capacity share a sequence at most in twos, each of the longest taking the
longest partner that still fits; shorter pieces, in descending order, go where the
least room is left that holds them.  Pieces are ranked within their length, and the
rank finds the run, the sequence and the place.

The plan has at most a few entries for each length, whatever the size of the corpus.
Null and empty texts are documents of one token.  Repeated rows are packed each.  Names
of added tokens in a text are these tokens, as ``tokenizers`` has it.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.common import slices, stage

CAPACITY, END_ID = 1024, 2
BATCH_BYTES = 4 << 20
#: So much white space in a row is left to the library that needs no stack for it.
_LONG_SPACE = re.compile(r"\s{2000}")
#: Equal pieces are dealt over so many numbers, so that copies can be ranked in several tasks.
SALTS = 1 << 12


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Encoder:
    """Ids as ``tokenizers`` gives them for the file, mostly by the faster of two BPE libraries.

    A byte-level BPE has the same ids in both: the merge ranks are the ids' order.  The
    file's added tokens are one id each wherever they stand.  A text with a long run of
    white space, which the faster library cannot match, goes to ``tokenizers`` itself, and
    so does every text if an added token has rules beyond its own string.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as file:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        with open(path, encoding="utf-8") as file:
            added = json.load(file)["added_tokens"]
        self._path, self._slow = path, None
        rules = ("single_word", "lstrip", "rstrip", "normalized")
        self._plain = not any(t[r] for t in added for r in rules)
        self._added = {t["content"]: t["id"] for t in added}
        longest = sorted(self._added, key=len, reverse=True)
        self._between = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None
        self._fast = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        ).encode_ordinary

    def __call__(self, text: str) -> list[int]:
        if not self._plain or _LONG_SPACE.search(text):
            return self._by_tokenizers(text)
        if not any(token in text for token in self._added):
            return self._fast(text)
        ids: list[int] = []
        for n, part in enumerate(self._between.split(text)):
            if n % 2:
                ids.append(self._added[part])
            else:
                ids += self._fast(part)
        return ids

    def _by_tokenizers(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._path)
        return self._slow.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, salt) of every piece of every document."""
    path = path or vocabulary_path()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, made = _encoder(path), 0
        for batch in slices(batches, "text", BATCH_BYTES):
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    out.append((doc, n, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = [*zip(*out), np.arange(made, made + len(out)) % SALTS]
            made += len(out)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"],
            )

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, salt int"
    return docs.select("doc_id", "text").mapInArrow(per_batch, schema)


# -- the plan ------------------------------------------------------------------------


class _Run:
    """``count`` sequences alike: the lengths in them, in order, and the room left."""

    __slots__ = ("count", "items", "room")

    def __init__(self, count: int, items: tuple[int, ...], room: int):
        self.count, self.items, self.room = count, items, room


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[_Run]:
    """Runs of sequences for so many pieces of each length below the capacity."""
    left = {n: c for n, c in counts.items() if 0 < n < capacity and c > 0}
    runs: list[_Run] = []
    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    # Longest first, each with the longest partner that fits.
    for n in large:
        for partner in large:
            if not left[n]:
                break
            if n + partner > capacity or not left[partner] or partner > n:
                continue
            pairs = left[n] // 2 if partner == n else min(left[n], left[partner])
            if pairs:
                left[n] -= pairs
                left[partner] -= pairs
                runs.append(_Run(pairs, (n, partner), capacity - n - partner))
        if left[n]:
            runs.append(_Run(left[n], (n,), capacity - n))
            left[n] = 0
    rooms: dict[int, list[_Run]] = {}
    for run in runs:
        rooms.setdefault(run.room, []).append(run)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            room = next((r for r in range(n, capacity) if rooms.get(r)), None)
            if room is None:
                fresh = min(left[n], max(1, -(-left[n] // (capacity // n))))
                run = _Run(fresh, (), capacity)
                runs.append(run)
            else:
                run = rooms[room].pop()
            if run.count > left[n]:
                rest = _Run(run.count - left[n], run.items, run.room)
                runs.append(rest)
                rooms.setdefault(rest.room, []).append(rest)
                run.count = left[n]
            left[n] -= run.count
            run.items, run.room = (*run.items, n), run.room - n
            rooms.setdefault(run.room, []).append(run)
    return runs


def _places(runs: list[_Run]) -> dict[int, np.ndarray]:
    """For each length: rows (first rank, first sequence, offset), by rank."""
    rank: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for run in runs:
        offset = 0
        for n in run.items:
            out.setdefault(n, []).append((rank.get(n, 0), sequence, offset))
            rank[n] = rank.get(n, 0) + run.count
            offset += n
        sequence += run.count
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    cut = stage(pieces(docs, path, capacity), "pieces")
    # Ranks in two steps, so that a frequent length is not in one task.
    total = cut.count()
    parts = max(1, int(total**0.5) // 4)
    cut = cut.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "salt"), F.lit(parts)))
    sums = cut.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    sums = stage(sums, "piece-counts")
    counts = {r["length"]: r["n"] for r in sums.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs = plan(counts, capacity)
    places = _places(runs)
    first_full = sum(r.count for r in runs)
    places[capacity] = np.array([(0, first_full, 0)], np.int64)

    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = cut.withColumn("_rank", F.row_number().over(inside) - 1).join(base, ["length", "_part"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_rank") + F.col("_base")).alias("_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                mine, rows = length == n, places[int(n)]
                at = np.searchsorted(rows[:, 0], rank[mine], "right") - 1
                sequence[mine] = rows[at, 1] + rank[mine] - rows[at, 0]
                offset[mine] = rows[at, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank").mapInArrow(place, schema)
