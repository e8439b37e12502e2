"""Substring dedup with prefix-partitioned suffix trees over words.

Every place in a document from which ``min_words`` words follow is a suffix.  The
suffix tree of the corpus is never in one place: suffixes are split by their first
words into groups that fit in memory, and each group's subtree is made by itself.

* Census.  Suffixes are counted by prefixes of 1, 3 and 8 words, hashed into a fixed
  number of cells.  A cell that is small enough is a group; a larger one is split by the
  next longer prefix, and at the end by all ``min_words`` words.  Small cells share a bin.
* Subtrees.  A bin gets the fingerprints of its suffixes' first ``min_words`` words, the
  depth at which the tree is cut.  Sorted, equal neighbours are the leaves below one
  internal node of that depth; a longer repeat is a chain of such nodes, one for each
  place.  All leaves but the earliest (smaller doc_id, then smaller place) are repeats.
* Repeats go back to their documents, where overlapping ones are joined to spans.

In a batch of documents only the earliest leaf of a node is sent on, with the others
marked at once, so a passage in every document is one leaf per batch.  Fingerprints
have 64 bits and are compared only within a bin; a bin of 2^20 suffixes confuses two of
them with a probability of 3e-8.

Null and empty texts have no words.  A document is told by its doc_id, and where different
texts share one, by a hash of its text besides: rows that are alike have the same spans, and
of different texts of one id the one with the smaller hash is earlier.  A null doc_id comes
first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import (
    slices,
    squeezed,
    stage,
    text_bytes,
    unsqueezed,
    window_hashes,
    word_bounds,
    word_hashes,
)

MIN_WORDS = 20
#: Suffixes in one bin: about 40 bytes each in the task that makes its subtrees.
BIN_SUFFIXES = 1 << 20
#: Prefix lengths and the number of cells for each.
PREFIXES = ((1, 1 << 12), (3, 1 << 14), (8, 1 << 14))
BATCH_BYTES = 8 << 20
NO_ID = -(2**63)


class _Suffixes:
    """The suffixes of a few documents: hashes, and where each is."""

    def __init__(self, docs: np.ndarray, tags: np.ndarray, texts: pa.Array, min_words: int):
        data, offsets = text_bytes(texts)
        starts, ends = word_bounds(data, offsets)
        hashes = word_hashes(data, starts, ends)
        first = np.searchsorted(starts, offsets[:-1])  # of each document, its first word
        count = np.diff(first, append=len(starts))
        row = np.repeat(np.arange(len(docs)), count)
        place = np.arange(len(starts)) - np.repeat(first, count)
        self.at = np.flatnonzero(place + min_words <= count[row]) if len(starts) else first[:0]
        self.row, self.place, self.docs, self.tags = row[self.at], place[self.at], docs, tags
        self._hashes, self._min = hashes, min_words

    def prefix(self, words: int) -> np.ndarray:
        return window_hashes(self._hashes, min(words, self._min))[self.at]


def _batches(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[_Suffixes]:
    for batch in slices(batches, "text", BATCH_BYTES):
        ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
        tags = batch.column("tag").to_numpy()
        order = np.lexsort((tags, ids))
        texts = batch.column("text").cast(pa.large_string()).take(pa.array(order))
        yield _Suffixes(ids[order], tags[order], texts, min_words)


def _census(docs: DataFrame, min_words: int) -> list[np.ndarray]:
    """Suffixes by cell, for each prefix length: a table of fixed size."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(cells, np.int64) for _, cells in PREFIXES]
        for found in _batches(batches, min_words):
            for (words, cells), total in zip(PREFIXES, sums):
                total += np.bincount((found.prefix(words) % np.uint64(cells)).astype(np.int64), minlength=cells)
        for level, total in enumerate(sums):
            cell = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({
                "level": pa.array(np.full(len(cell), level), pa.int32()),
                "cell": pa.array(cell, pa.int32()), "n": pa.array(total[cell], pa.int64()),
            })

    counted = docs.mapInArrow(per_task, "level int, cell int, n bigint").groupBy("level", "cell").agg(F.sum("n").alias("n"))
    out = [np.zeros(cells, np.int64) for _, cells in PREFIXES]
    for r in counted.collect():
        out[r["level"]][r["cell"]] = r["n"]
    return out


class Bins:
    """Which bin a suffix belongs to, by the shortest prefix whose cell is small enough."""

    def __init__(self, census: list[np.ndarray], bin_suffixes: int):
        most = max(1, bin_suffixes // 4)
        self.bins, self.count, load = [], 1, 0
        for counts in census:
            place = np.full(len(counts), -1, np.int64)
            for cell in np.flatnonzero((counts > 0) & (counts <= most)):
                if load and load + counts[cell] > bin_suffixes:
                    self.count, load = self.count + 1, 0
                place[cell] = self.count - 1
                load += int(counts[cell])
            self.bins.append(place)
        last = census[-1]
        heavy = int(last[last > most].sum())
        self.first_heavy, self.heavy = self.count, max(1, -(-heavy // bin_suffixes))

    def of(self, found: _Suffixes, whole: np.ndarray) -> np.ndarray:
        out = np.full(len(whole), -1, np.int64)
        for (words, cells), place in zip(PREFIXES, self.bins):
            open_ = np.flatnonzero(out < 0)
            if len(open_):
                out[open_] = place[(found.prefix(words)[open_] % np.uint64(cells)).astype(np.int64)]
        rest = out < 0
        out[rest] = self.first_heavy + (whole[rest] >> np.uint64(20)) % np.uint64(self.heavy)
        return out


def _packed(key: str, keys: np.ndarray, docs: np.ndarray, tags: np.ndarray, places: np.ndarray,
            prints: np.ndarray | None) -> Iterator[dict]:
    """One row per key; entries of a key stay in the order of document and place."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            ids, own = docs[part], tags[part]
            first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (own[1:] != own[:-1])))
            yield {
                key: int(keys[part[0]]), "docs": squeezed(ids[first]),
                "tags": squeezed(own[first]) if own.any() else None,
                "counts": np.diff(first, append=len(part)).astype("<u4").tobytes(),
                "places": squeezed(places[part]),
                "prints": None if prints is None else prints[part].tobytes(),
            }


def _unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    docs, tags, places, prints = [], [], [], []
    for row in rows.to_pylist():
        counts = np.frombuffer(row["counts"], "<u4")
        docs.append(np.repeat(unsqueezed(row["docs"]), counts))
        own = np.zeros(len(counts), np.int64) if row["tags"] is None else unsqueezed(row["tags"])
        tags.append(np.repeat(own, counts))
        places.append(unsqueezed(row["places"]))
        if row["prints"] is not None:
            prints.append(np.frombuffer(row["prints"], np.uint64))
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return join(docs), join(tags), join(places), np.concatenate(prints) if prints else None


_FIELDS = [("docs", pa.binary()), ("tags", pa.binary()), ("counts", pa.binary()), ("places", pa.binary()), ("prints", pa.binary())]
_DDL = "docs binary, tags binary, counts binary, places binary, prints binary"


def _later(docs: np.ndarray, tags: np.ndarray, places: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Entries whose fingerprint has an earlier leaf, as indexes."""
    order = np.argsort(prints, kind="stable")
    same = prints[order][1:] == prints[order][:-1]
    shared = np.zeros(len(order), bool)
    shared[1:] |= same
    shared[:-1] |= same
    order = order[shared]
    order = order[np.lexsort((places[order], tags[order], docs[order], prints[order]))]
    if not len(order):
        return order
    new = np.ones(len(order), bool)
    new[1:] = prints[order][1:] != prints[order][:-1]
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return order[(docs[order] != docs[head]) | (tags[order] != tags[head]) | (places[order] != places[head])]


def tagged(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, text): the tag is a hash of the text where different texts share the id, else 0."""
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    shared = keyed.groupBy("_id").agg(F.min("_hash").alias("a"), F.max("_hash").alias("b")).where("a <> b")
    shared = stage(shared.select("_id", F.lit(True).alias("_shared")), "shared-ids")
    if shared.isEmpty():
        return keyed.select("doc_id", F.lit(0).cast("long").alias("tag"), "text")
    return keyed.join(shared, "_id", "left").select(
        "doc_id", F.when(F.col("_shared"), F.col("_hash")).otherwise(0).alias("tag"), "text"
    )


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, bin_suffixes: int = BIN_SUFFIXES) -> DataFrame:
    """(doc_id, tag, spans): the words of each document of ``tagged`` that repeat earlier text.

    ``spans`` has the first word and the word after the last of each span in turn.
    Documents without repeats have no row; a null doc_id is given as -2^63.
    """
    texts = docs.select("doc_id", "tag", "text").where("text is not null")
    bins = Bins(_census(texts, min_words), bin_suffixes)
    count = bins.first_heavy + bins.heavy

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bin", pa.int64()), *_FIELDS])
        for found in _batches(batches, min_words):
            whole, ids, tags = found.prefix(min_words), found.docs[found.row], found.tags[found.row]
            known = np.zeros(len(whole), bool)
            known[_later(ids, tags, found.place, whole)] = True
            sent = np.flatnonzero(~known)
            of_bin = bins.of(found, whole)
            rows = list(_packed("bin", of_bin[sent], ids[sent], tags[sent], found.place[sent], whole[sent]))
            # Those known already pass through the bins in even shares.
            known = np.flatnonzero(known)
            rows += _packed("bin", found.row[known] % count, ids[known], tags[known], found.place[known], None)
            yield pa.RecordBatch.from_pylist(rows, schema)

    def subtrees(key: tuple, rows: pa.Table) -> pa.Table:
        with_prints = rows.filter(rows.column("prints").is_valid())
        ids, tags, places, prints = _unpacked(with_prints)
        known_ids, known_tags, known_places, _ = _unpacked(rows.filter(rows.column("prints").is_null()))
        if prints is not None:
            later = _later(ids, tags, places, prints)
            known_ids = np.concatenate([known_ids, ids[later]])
            known_tags = np.concatenate([known_tags, tags[later]])
            known_places = np.concatenate([known_places, places[later]])
        order = np.lexsort((known_places, known_tags, known_ids))
        known_ids, known_tags, known_places = known_ids[order], known_tags[order], known_places[order]
        back = (known_ids ^ known_tags) % count
        return pa.Table.from_pylist(list(_packed("home", back, known_ids, known_tags, known_places, None)),
                                    pa.schema([("home", pa.int64()), *_FIELDS]))

    def to_spans(key: tuple, rows: pa.Table) -> pa.Table:
        ids, tags, places, _ = _unpacked(rows)
        order = np.lexsort((places, tags, ids))
        ids, tags, places = ids[order], tags[order], places[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]) | (places[1:] > places[:-1] + min_words)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(ids)) - 1
        doc, tag = ids[first], tags[first]
        flat = np.stack([places[first], places[last] + min_words], axis=1).reshape(-1)
        starts = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]))) if len(doc) else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(doc)) * 2, pa.int32()), pa.array(flat, pa.int32()))
        return pa.Table.from_arrays([pa.array(doc[starts], pa.int64()), pa.array(tag[starts], pa.int64()), lists], names=["doc_id", "tag", "spans"])

    binned = texts.mapInArrow(to_bins, f"bin bigint, {_DDL}")
    leaves = binned.groupBy("bin").applyInArrow(subtrees, f"home bigint, {_DDL}")
    return leaves.groupBy("home").applyInArrow(to_spans, "doc_id bigint, tag bigint, spans array<int>")


def dedup_substrings(docs: DataFrame, min_words: int = MIN_WORDS, bin_suffixes: int = BIN_SUFFIXES,
                     texts: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) of each row."""
    docs = tagged(docs)
    spans = repeated_spans(docs, min_words, bin_suffixes).withColumnRenamed("doc_id", "_id")
    keyed = docs.select("doc_id", "tag", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"))
    joined = keyed.join(spans, ["_id", "tag"], "left").select("doc_id", "text", "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            out = []
            for text, flat in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()
                kept, at = words, 0
                if flat:
                    kept = []
                    for a, b in zip(flat[::2], flat[1::2]):
                        kept += words[at:a]
                        at = min(b, len(words))
                    kept += words[at:]
                joined_words = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(joined_words).hexdigest(),
                            joined_words.decode() if texts else None))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)]],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
    return joined.mapInArrow(keep, schema)
