"""Which source types become properties, and how their values are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark type -> property type.  DATE and TIMESTAMP share one
# property type, so the same name may be either in different sources.
PROPERTY_TYPES = {
    T.ByteType: "Byte",
    T.ShortType: "Short",
    T.IntegerType: "Integer",
    T.LongType: "Long",
    T.FloatType: "Float",
    T.DoubleType: "Double",
    T.StringType: "String",
    T.BooleanType: "Boolean",
    T.TimestampType: "Date",
    T.DateType: "Date",
    T.TimestampNTZType: "Date",
}

# Columns the graph tables add to the source's own.
ELEMENT_COLUMNS = ("_vid", "_label", "_src", "_dst", "_src_reason", "_dst_reason")
# Prefix of the short-lived columns the plans add and drop again.
WORK_PREFIX = "_wg_"


def column(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def property_type(data_type: T.DataType) -> str | None:
    """Property type of a Spark type; None if it cannot be a property."""
    return PROPERTY_TYPES.get(type(data_type))


def stored_type(data_type: T.DataType) -> T.DataType:
    """Type of the stored property column."""
    return T.TimestampType() if isinstance(data_type, T.DateType) else data_type


def property_fields(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if property_type(f.dataType)]


def unsupported_fields(schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema.fields if not property_type(f.dataType)]


def to_millis(value: Column, data_type: T.DataType) -> Column:
    """Instant cut to the millisecond; a date becomes its midnight.

    ``date_trunc`` would turn a zone-less timestamp into a zoned one and so
    move times that fall into a daylight-saving gap; subtracting the
    microseconds below the millisecond keeps the wall clock.
    """
    if isinstance(data_type, T.DateType):
        return value.cast(T.TimestampType())
    if isinstance(data_type, T.TimestampNTZType):
        micros = (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
        return F.timestamp_add("MICROSECOND", -(micros % 1000), value)
    return F.date_trunc("millisecond", value)


def property_column(field: T.StructField) -> Column:
    """The column as it is stored, under its own name."""
    value = column(field.name)
    if property_type(field.dataType) == "Date":
        value = to_millis(value, field.dataType)
    return value.alias(field.name)


def supported_projection(df: DataFrame) -> DataFrame:
    """Columns that become properties, in stored form; the rest is pruned."""
    return df.select([property_column(f) for f in property_fields(df.schema)])


def properties_long(df: DataFrame, ids: list[str]) -> DataFrame:
    """One (ids, key, value) row per non-null property, values as strings."""
    names = [f.name for f in property_fields(df.schema) if f.name not in ids]
    as_text = df.select(
        *[column(i) for i in ids], *[column(n).cast("string").alias(n) for n in names]
    )
    return as_text.unpivot(ids, names, "key", "value").where(F.col("value").isNotNull())
