"""What the operators share: tables, staging, and words as numpy arrays.

Words are the runs of bytes outside ``\\x20 \\x09-\\x0D``.  UTF-8 never has these
bytes inside a longer code point, so words can be cut in the bytes themselves.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.sources.shared import new_dir
from weftgraph.sources.shared import stage as write_and_read

SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that numpy works on at once; temporaries take about 40 times as much.
SLICE_BYTES = 1 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        joined = f"{root}{os.pathsep}{known}" if known else root
        spark.sparkContext.environment["PYTHONPATH"] = joined


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write the frame below ``spark.checkpoint.dir`` and read it from there."""
    return write_and_read(df, new_dir(df.sparkSession, purpose))


def carried(df: DataFrame, *needed: str) -> DataFrame:
    """``needed`` columns under their names, and the others under names that clash with nothing."""
    others = [c for c in df.columns if c not in needed]
    return df.select(*needed, *[F.col(_quoted(c)).alias(f"column {i}") for i, c in enumerate(others)])


def returned(found: DataFrame, df: DataFrame, *needed: str, **changed: Column) -> list[Column]:
    """The columns of ``df`` out of what was made from ``carried(df, *needed)``."""
    others = [c for c in df.columns if c not in needed]
    place = {c: f"column {i}" for i, c in enumerate(others)}
    return [changed.get(c, found[_quoted(place.get(c, c))]).alias(c) for c in df.columns]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# -- texts as arrays ------------------------------------------------------------


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array and the offsets of each; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data if data is not None else b"", dtype=np.uint8)
    if not len(offsets):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has at most ``limit`` bytes in ``column``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = max(at + 1, end)
            yield batch.slice(at, end - at)
            at = end


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.default_rng(20)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[_IS_SPACE] = 0
_BYTE_FOLDED = _BYTE.copy()
_BYTE_FOLDED[65:91] = _BYTE[97:123]
_TURN = 4096
_POWER = np.cumprod(np.full(_TURN, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after its last."""
    solid = ~_IS_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False
) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, slice by slice."""
    byte = _BYTE_FOLDED if fold_case else _BYTE
    out = np.zeros(len(starts), np.uint64)
    for at in range(0, len(data), SLICE_BYTES):
        end = min(len(data), at + SLICE_BYTES)
        low = int(np.searchsorted(ends, at, "right"))
        high = int(np.searchsorted(starts, end, "left"))
        if low >= high:
            continue
        begin = np.maximum(starts[low:high], at) - at
        lengths = np.diff(begin, append=end - at)
        place = np.arange(begin[0], end - at) + at - np.repeat(starts[low:high], lengths)
        value = byte[data[at + begin[0] : end]] * _POWER[place % _TURN]
        if len(place) and place.max() >= _TURN:
            value *= (place // _TURN * 2 + 1).astype(np.uint64)
        out[low:high] += np.add.reduceat(value, begin - begin[0])
    return mixed(out + (ends - starts).astype(np.uint64))


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbours, in this order."""
    return mixed(left * np.uint64(0x9FB21C651E98DF25) + right)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` neighbours from each place on; len - size + 1 of them."""
    if len(hashes) < size:
        return hashes[:0]
    done, out, step, part = 0, None, 1, hashes
    while True:
        if size & step:
            piece = part[done:]
            out = piece if out is None else paired(out[: len(piece)], piece[: len(out)])
            done += step
        step *= 2
        if step > size:
            return out[: len(hashes) - size + 1]
        part = paired(part[: -step // 2], part[step // 2 :])


# -- small binary columns --------------------------------------------------------


def squeezed(values: np.ndarray) -> bytes:
    """Integers as compressed differences."""
    steps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    for kind in (np.int8, np.int16, np.int32):
        if not len(steps) or (steps.min() >= np.iinfo(kind).min and steps.max() <= np.iinfo(kind).max):
            steps = steps.astype(kind)
            break
    return bytes([steps.itemsize]) + zstandard.ZstdCompressor(level=1).compress(steps.tobytes())


def unsqueezed(blob: bytes) -> np.ndarray:
    kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[blob[0]]
    raw = zstandard.ZstdDecompressor().decompress(blob[1:])
    return np.cumsum(np.frombuffer(raw, kind), dtype=np.int64)
