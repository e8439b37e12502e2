"""Source tables and primary-key maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.errors import MissingColumnError, ReservedColumnError, UnsupportedTypeError
from weftgraph.functions.types import (
    ELEMENT_COLUMNS,
    WORK_PREFIX,
    column,
    property_column,
    property_type,
)
from weftgraph.sources.keymaps import current_folder

Source = str | DataFrame


def scan(spark: SparkSession, source: Source, fmt: str = "orc") -> DataFrame:
    """All files of one vertex or edge type."""
    return source if isinstance(source, DataFrame) else spark.read.format(fmt).load(source)


def require_columns(df: DataFrame, *names: str) -> None:
    """Key columns must exist under exactly the given name and be storable."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumnError(f"no such column: {missing}; the source has {df.columns}")
    bad = [n for n in names if property_type(df.schema[n].dataType) is None]
    if bad:
        raise UnsupportedTypeError(f"key columns of unsupported type: {bad}")


def reject_reserved(df: DataFrame) -> None:
    bad = [c for c in df.columns if c in ELEMENT_COLUMNS or c.startswith(WORK_PREFIX)]
    if bad:
        raise ReservedColumnError(f"reserved column names in the source: {bad}")


def primary_key_map(vertices: DataFrame, key: str) -> DataFrame:
    """(key, vertexID) of every vertex row, null and repeated keys included."""
    return vertices.select(column(key), F.col("_vid").alias("vertexID"))


def write_primary_key_map(pk_map: DataFrame, path: str) -> None:
    """Replaces whatever map was saved at the path."""
    pk_map.write.mode("overwrite").orc(path)


def read_primary_key_map(spark: SparkSession, source: Source) -> DataFrame:
    """(key, vid), taken by position: whatever the two columns are called.

    At a path this is the current map there, see :mod:`weftgraph.sources.keymaps`.
    """
    raw = scan(spark, current_folder(spark, source) if isinstance(source, str) else source)
    if len(raw.columns) < 2 or not isinstance(raw.schema.fields[1].dataType, T.LongType):
        raise UnsupportedTypeError("a primary-key map holds (key, bigint id), in this order")
    first, second = raw.schema.fields[:2]
    if property_type(first.dataType) is None:
        raise UnsupportedTypeError(f"map key of unsupported type {first.dataType.simpleString()}")
    return raw.select(property_column(first).alias("key"), column(second.name).alias("vid"))
