"""Spreading the rows of hot keys over several join partitions.

A key is hot when it holds more rows than an even partition would.  There can
be at most ``spark.sql.shuffle.partitions`` such keys, whatever the data, so
the frame of hot keys is the one thing here that is broadcast without asking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(counts: DataFrame, key: str, rows: str) -> DataFrame | None:
    """(key, _wg_splits) of hot keys; None if there are none.

    ``counts`` holds one row per key.
    """
    total, largest = counts.agg(F.sum(rows), F.max(rows)).first()
    return hot_keys_of(counts, key, rows, total, largest)


def hot_keys_of(
    counts: DataFrame, key: str, rows: str, total: int | None, largest: int | None
) -> DataFrame | None:
    """As :func:`hot_keys`, where the sum and the maximum are known already.

    The splits of all keys together are at most twice the number of partitions.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, -(-(total or 0) // partitions))
    if not total or largest <= share:
        return None
    return counts.where(F.col(rows) > share).select(
        F.col(key).alias("_wg_hot"), F.ceil(F.col(rows) / share).cast("int").alias("_wg_splits")
    )


def _with_splits(df: DataFrame, key: Column, hot: DataFrame) -> DataFrame:
    return df.join(F.broadcast(hot), key == F.col("_wg_hot"), "left").drop("_wg_hot")


def _dealt(position: Column, parts: Column) -> Column:
    """Part of a row.  Hashed, as rows of a key may come at regular positions."""
    return F.pmod(F.xxhash64(position), parts).cast("int")


def salted_join(
    many: DataFrame,
    one: DataFrame,
    many_key: Column,
    one_key: str,
    hot: DataFrame | None,
    position: Column,
    how: str = "inner",
) -> DataFrame:
    """Join whose left side may have hot keys; ``one_key`` is dropped.

    Each left row meets exactly one copy of its right row: left rows of a hot
    key are dealt over the key's splits by ``position``, and the right rows of
    that key are repeated once per split.  ``position`` must come out the same
    when a task is run again.
    """
    if hot is None:
        return many.join(one, many_key == F.col(one_key), how).drop(one_key)
    splits = F.coalesce(F.col("_wg_splits"), F.lit(1))
    left = (
        _with_splits(many, many_key, hot)
        .withColumn("_wg_salt", _dealt(position, splits))
        .drop("_wg_splits")
    )
    right = (
        _with_splits(one, F.col(one_key), hot)
        .withColumn("_wg_copy", F.explode(F.sequence(F.lit(0), splits - 1)))
        .drop("_wg_splits")
    )
    same = (many_key == F.col(one_key)) & (F.col("_wg_salt") == F.col("_wg_copy"))
    return left.join(right, same, how).drop(one_key, "_wg_salt", "_wg_copy")


def grid_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, counts: DataFrame
) -> DataFrame:
    """Inner join where both sides may have hot keys; ``right_key`` is dropped.

    ``counts`` has (key, left_rows, right_rows), one row per key.  A key with
    more pairs than an even partition becomes a grid of cells: a left row goes
    to all columns of one grid row, a right row to all rows of one column, so
    each pair meets in exactly one cell.  ``left`` needs ``_wg_position`` and
    ``right`` needs ``_wg_order``, numbers that are the same on every run.
    """
    pairs = F.col("left_rows") * F.col("right_rows")
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total, largest = counts.agg(F.sum(pairs.cast("double")), F.max(pairs.cast("double"))).first()
    if not total or largest <= total / partitions:
        return left.join(right, F.col(left_key) == F.col(right_key)).drop(right_key)
    share = total / partitions
    cells = F.ceil(pairs / share)
    height = F.greatest(
        F.lit(1), F.ceil(F.sqrt(cells * F.col("left_rows") / F.col("right_rows")))
    )
    height = F.least(height, cells, F.col("left_rows")).cast("int")
    hot = counts.where(pairs > share).select(
        F.col("key").alias("_wg_hot"),
        height.alias("_wg_rows"),
        F.ceil(cells / height).cast("int").alias("_wg_cols"),
    )

    def numbered(df: DataFrame, key: str, number: str, own: str, other: str) -> DataFrame:
        placed = _with_splits(df, F.col(key), hot)
        own_count, other_count = (F.coalesce(F.col(c), F.lit(1)) for c in (own, other))
        return placed.select(
            *df.columns,
            _dealt(F.col(number), own_count).alias(own + "_own"),
            F.explode(F.sequence(F.lit(0), other_count - 1)).alias(other + "_all"),
        )

    a = numbered(left, left_key, "_wg_position", "_wg_rows", "_wg_cols")
    b = numbered(right, right_key, "_wg_order", "_wg_cols", "_wg_rows")
    same_cell = (F.col("_wg_rows_own") == F.col("_wg_rows_all")) & (
        F.col("_wg_cols_own") == F.col("_wg_cols_all")
    )
    return a.join(b, (F.col(left_key) == F.col(right_key)) & same_cell).drop(
        right_key, "_wg_rows_own", "_wg_rows_all", "_wg_cols_own", "_wg_cols_all"
    )
