"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A letter in its word, with the
letter (or the gap) before and after it, is a 3-gram; the vector of a 3-gram binds
the three letter vectors, each rotated by its place.  The vectors of a document's
3-grams are bundled (added), those of all training documents of a language are its
prototype, and a document gets the language whose prototype has the greatest cosine.

Null or letterless texts are ``und`` with score 0, as is every text if there is
nothing to learn from.  Ties go to the smaller language.  Rows are judged one by
one: repeated rows get the same answer, other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import slices

DIMENSIONS = 1024
UNKNOWN = "und"
LETTER_VECTORS = 128
#: A block of documents whose 3-grams are counted at once.
BLOCK_ROWS, BLOCK_BYTES = 512, 2 << 20
#: Different 3-grams of a block whose vectors are held at once, 4 KB each.
GRAMS_AT_ONCE = 2048


@lru_cache(maxsize=1)
def letter_ids() -> np.ndarray:
    """Code point to letter vector, 0 for what is no letter.

    Letters of Latin-1 have vectors of their own; the others share the rest.
    """
    ids = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if chr(point).isalpha():
            low = ord(chr(point).lower()[0])
            if 97 <= low <= 122:
                ids[point] = low - 96
            elif 0xDF <= low <= 0xFF:
                ids[point] = 27 + low - 0xDF
            else:
                ids[point] = 60 + low % 68
    return ids


@lru_cache(maxsize=1)
def letter_vectors() -> np.ndarray:
    signs = np.random.default_rng(7).integers(0, 2, (LETTER_VECTORS, DIMENSIONS))
    return (2 * signs - 1).astype(np.float32)


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bind the vectors of each 3-gram's letters."""
    letters = letter_vectors()
    before, middle, after = codes >> 14, codes >> 7 & 127, codes & 127
    out = np.roll(letters, 2, axis=1)[before]
    out *= np.roll(letters, 1, axis=1)[middle]
    out *= letters[after]
    return out


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Row and code of each 3-gram."""
    texts = [t or "" for t in texts]
    joined = "\n" + "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ids = letter_ids()[points]
    row = np.repeat(np.arange(len(texts), dtype=np.int32), np.array([len(t) + 1 for t in texts]))
    at = np.flatnonzero(ids)
    codes = ids[at - 1].astype(np.int32) << 14 | ids[at].astype(np.int32) << 7 | ids[at + 1]
    return row[at - 1], codes


def bundles(rows: np.ndarray, codes: np.ndarray, count: int) -> np.ndarray:
    """The bundled vector of each of ``count`` rows.

    Sums over some of the 3-grams at a time: however many different ones there are, their
    vectors and counts take the same memory.  All sums are whole numbers, so the order of
    adding changes none below 2^24.
    """
    seen = np.zeros(int(codes.max(initial=0)) + 1, bool)
    seen[codes] = True
    present = np.flatnonzero(seen)
    place = np.zeros(len(seen), np.int32)
    place[present] = np.arange(len(present), dtype=np.int32)
    place = place[codes]
    out = np.zeros((count, DIMENSIONS), np.float32)
    for first in range(0, len(present), GRAMS_AT_ONCE):
        some = present[first : first + GRAMS_AT_ONCE]
        here = (place >= first) & (place < first + len(some))
        cells = rows[here].astype(np.int64) * len(some) + (place[here] - first)
        counts = np.bincount(cells, minlength=count * len(some))
        out += counts.reshape(count, -1).astype(np.float32) @ gram_vectors(some)
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "text", BLOCK_BYTES):
        for at in range(0, piece.num_rows, BLOCK_ROWS):
            yield piece.slice(at, BLOCK_ROWS)


def learn(training: DataFrame) -> dict[str, np.ndarray]:
    """The prototype of each language in ``training(text, lang)``.

    One vector per language and task is summed on the executors; the driver gets
    one per language.
    """

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for block in _blocks(batches):
            langs = block.column("lang").to_pylist()
            names = sorted(set(langs))
            number = {x: i for i, x in enumerate(names)}
            rows, codes = grams(block.column("text").to_pylist())
            if len(codes):
                of_row = np.array([number[x] for x in langs])
                found = bundles(of_row[rows], codes, len(names))
                for name, vector in zip(names, found):
                    sums[name] = sums.get(name, 0) + np.rint(vector).astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array(np.repeat(list(sums), DIMENSIONS).tolist(), pa.string()),
                "place": pa.array(list(range(DIMENSIONS)) * len(sums), pa.int32()),
                "value": pa.array(
                    np.concatenate(list(sums.values())) if sums else [], pa.int64()
                ),
            }
        )

    learned = (
        training.where("lang is not null and text is not null")
        .select("text", "lang")
        .mapInArrow(per_task, "lang string, place int, value bigint")
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("vector"))
    )
    rows = learned.collect()
    return {r["lang"]: np.array([x["value"] for x in r["vector"]], np.float64) for r in rows}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score``, the cosine (at least 0)."""
    names = sorted(k for k, v in prototypes.items() if np.linalg.norm(v))
    unit = np.array([prototypes[x] / np.linalg.norm(prototypes[x]) for x in names], np.float32)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            lang = np.full(block.num_rows, UNKNOWN, object)
            score = np.zeros(block.num_rows)
            rows, codes = grams(block.column("text").to_pylist())
            if names and len(codes):
                vectors = bundles(rows, codes, block.num_rows)
                length = np.linalg.norm(vectors, axis=1)
                cosine = vectors @ unit.T / np.maximum(length, 1e-9)[:, None]
                best = cosine.argmax(axis=1)
                has = np.bincount(rows, minlength=block.num_rows) > 0
                lang[has] = np.array(names, object)[best[has]]
                score[has] = np.clip(cosine[np.arange(len(best)), best][has], 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*block.schema.names, "lang_pred", "score"],
            )

    kept = docs.drop("lang_pred", "score")
    schema = f"{_ddl(kept)}, lang_pred string, score double"
    return kept.mapInArrow(per_batch, schema)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def held_out(docs: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``: is the checksum of the id a multiple of 5?

    A document without an id is held out: nothing is learned from it.
    """
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return docs.withColumn("held_out", F.coalesce(checksum % 5 == 0, F.lit(True)))
