"""Posting tables: words of string properties, values of the others."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.errors import NotRegisteredError
from weftgraph.functions.tokens import words
from weftgraph.functions.types import column
from weftgraph.sources.store import GraphStore

TEXT, VALUE = "text", "value"

#: Words of vertices that are grouped at once, and ids in a block at most.
WORDS_AT_ONCE, BLOCK_IDS = 1 << 20, 1024
#: Blocks sent back at once.
BLOCKS_AT_ONCE = 1 << 16


def token_postings(vertices: DataFrame, prop: str) -> DataFrame:
    """(token, _vid): each distinct word of each vertex's property."""
    distinct_words = F.array_distinct(words(column(prop)))
    return vertices.select(F.explode(distinct_words).alias("token"), "_vid")


def token_blocks(vertices: DataFrame, prop: str) -> DataFrame:
    """(token, _vids): the postings of each task, the ids of a word in ascending blocks.

    A block holds vertices of one stretch of consecutive ids that the task read in a row.
    Stretches do not overlap, so neither do blocks of a word: sorted by word and first id and
    taken apart, they are the postings in order, while far fewer rows are sorted.
    """
    distinct_words = F.array_distinct(words(column(prop)))
    listed = vertices.select("_vid", distinct_words.alias("words"))
    return listed.mapInArrow(_grouped(WORDS_AT_ONCE, BLOCK_IDS, BLOCKS_AT_ONCE), "token string, _vids array<bigint>")


def _grouped(words_at_once: int, block_ids: int, blocks_at_once: int) -> Callable:
    """The function of the tasks; it has all it needs, as they cannot import this package."""

    def blocks(vids: np.ndarray, lists: pa.ListArray) -> Iterator[pa.RecordBatch]:
        found = lists.flatten().dictionary_encode()
        n = len(found)
        if not n:
            return
        by_word = pc.sort_indices(found.dictionary)
        rank = np.empty(len(by_word), np.int64)
        rank[by_word.to_numpy()] = np.arange(len(by_word))
        row = np.repeat(np.arange(len(vids)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
        # By word, then in the order of the rows: one number for both is sorted faster.
        bits = n.bit_length()
        order = np.sort(rank[found.indices.to_numpy()] << bits | np.arange(n))
        word, row = order >> bits, row[order & ((1 << bits) - 1)]
        stretch = np.cumsum(np.diff(vids, prepend=vids[0]) != 1)[row]
        first = np.flatnonzero((np.diff(word, prepend=-1) != 0) | (np.diff(stretch, prepend=0) != 0))
        place = np.arange(n) - np.repeat(first, np.diff(first, append=n))
        first = np.flatnonzero(place % block_ids == 0)
        ends, vid = np.append(first, n), vids[row]
        tokens = found.dictionary.take(by_word.take(pa.array(word[first])))
        for at in range(0, len(first), blocks_at_once):
            cut = ends[at : at + blocks_at_once + 1]
            ids = pa.ListArray.from_arrays(pa.array(cut - cut[0], pa.int32()), pa.array(vid[cut[0] : cut[-1]]))
            yield pa.RecordBatch.from_arrays([tokens.slice(at, len(cut) - 1), ids], names=["token", "_vids"])

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vids, lists = batch.column(0).to_numpy(), batch.column(1)
            so_far = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
            at = 0
            while at < len(vids):
                reached = so_far[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(so_far, reached + words_at_once, "right")))
                yield from blocks(vids[at:end], lists.slice(at, end - at))
                at = end

    return per_task


def value_postings(vertices: DataFrame, prop: str) -> DataFrame:
    """(value, _vid) where the vertex has the property."""
    return vertices.select(column(prop).alias("value"), "_vid").where(F.col("value").isNotNull())


def postings_of(vertices: DataFrame, prop: str, kind: str) -> DataFrame:
    return token_postings(vertices, prop) if kind == TEXT else value_postings(vertices, prop)


def define_index(store: GraphStore, label: str, properties: list[str]) -> bool:
    """Registers the label's index; False if it is there already.

    An existing index keeps its columns even when others are asked for.
    """
    known = store.property_types()
    missing = [p for p in properties if p not in known]
    if missing:
        raise NotRegisteredError(f"index columns not registered: {missing}")
    index = store.index_name(label)
    if store.index_properties(index):
        return False
    kinds = [(p, TEXT if known[p] == "String" else VALUE) for p in dict.fromkeys(properties)]
    store.add_to_registry("indexes", [(index, label, p, k) for p, k in kinds])
    return True


def write_postings(
    store: GraphStore, index: str, vertices: DataFrame, load_id: str
) -> dict[str, T.StructType]:
    """Writes the postings of these vertices for each indexed property.

    Each task sorts its own postings by word or value, so that a lookup skips
    the stripes without it.  They are not shuffled: that would move more than
    the texts themselves, and a frequent word would have to be cut up again.
    Postings of words are sorted and kept in blocks, see :func:`token_blocks`.
    """
    schemas = {}
    for prop, kind in store.index_properties(index).items():
        if prop not in vertices.columns:
            continue
        if kind == TEXT:
            postings = token_blocks(vertices, prop)
            ordered = postings.sortWithinPartitions("token", F.col("_vids")[0])
        else:
            postings = value_postings(vertices, prop)
            ordered = postings.sortWithinPartitions("value", "_vid")
        _writer(ordered).orc(store.index_path(index, prop, load_id))
        schemas[prop] = postings.schema
    return schemas


def write_merged_postings(store: GraphStore, index: str, load_id: str) -> dict[str, T.StructType]:
    """Merges the runs of all loads into one, in the order of words or values.

    The range key ends with the id, so that a frequent word is cut like any other stretch
    and no task has all of it.  Words are moved and sorted in the blocks of their runs, which
    become single postings where they are written.  Bloom filters let a lookup skip the
    stripes whose range holds a word that they do not have.
    """
    schemas = {}
    for prop, kind in store.index_properties(index).items():
        if kind == TEXT:
            blocks = store.posting_blocks(index, prop)
            if blocks is None:
                continue
            order = ["token", F.col("_vids")[0]]
            ranged = blocks.repartitionByRange(*order).sortWithinPartitions(*order)
            merged = ranged.select("token", F.explode("_vids").alias("_vid"))
        else:
            postings = store.postings(index, prop)
            if postings is None:
                continue
            merged = postings.repartitionByRange("value", "_vid").sortWithinPartitions("value", "_vid")
        key = merged.columns[0]
        writer = _writer(merged).option("orc.bloom.filter.columns", key).option("orc.bloom.filter.fpp", "0.01")
        writer.orc(store.index_path(index, prop, load_id))
        schemas[prop] = merged.schema
    return schemas


def _writer(postings: DataFrame) -> DataFrameWriter:
    """Words in order are written one by one; looking each up in a dictionary takes longer than all else."""
    return postings.write.option("orc.dictionary.key.threshold", "0")
