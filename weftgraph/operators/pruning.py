"""Keeping the rows whose key is wanted, without moving the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.functions.types import column
from weftgraph.sources.shared import fits_broadcast

# So many keys are compared in the scan itself, where sorted files are skipped.
FEW_KEYS = 500
# Bytes a key takes in a broadcast table beside its own.
KEY_OVERHEAD = 40
# Types whose values come back from the driver exactly as they were.
EXACT_TYPES = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def only_wanted(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame | None:
    """Rows of ``df`` whose key is in the one column of ``wanted``.

    Few keys become a filter that reaches the scan; more are broadcast if they
    fit the session's limit.  None if there are too many for either, and rows
    would have to be shuffled.  ``wanted`` should be a staged table.
    """
    name, data_type = wanted.columns[0], wanted.schema.fields[0].dataType
    if isinstance(data_type, EXACT_TYPES):
        few = wanted.take(FEW_KEYS + 1)
        if len(few) <= FEW_KEYS:
            return df.where(column(key).isin([r[0] for r in few]))
    text = isinstance(data_type, T.StringType)
    own_bytes = F.octet_length(column(name)) if text else F.lit(8)
    size = wanted.agg(F.sum(own_bytes + KEY_OVERHEAD)).first()[0] or 0
    if not fits_broadcast(df.sparkSession, size):
        return None
    small = F.broadcast(wanted.select(column(name).alias("_wg_wanted")))
    return df.join(small, column(key) == F.col("_wg_wanted"), "left_semi")
