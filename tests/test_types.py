from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.functions.tokens import text_contains, word_set
from weftgraph.functions.types import properties_long, property_type, supported_projection

ALL_TYPES = (
    "b tinyint, s smallint, i int, l bigint, f float, d double, t string, z boolean, "
    "ts timestamp, dt date, ntz timestamp_ntz, dec decimal(10,2), bin binary, a array<int>, "
    "m map<string,int>, st struct<x:int>"
)


def test_type_table(spark):
    kinds = {f.name: property_type(f.dataType) for f in T.StructType.fromDDL(ALL_TYPES).fields}
    assert kinds == {
        "b": "Byte", "s": "Short", "i": "Integer", "l": "Long", "f": "Float", "d": "Double",
        "t": "String", "z": "Boolean", "ts": "Date", "dt": "Date", "ntz": "Date",
        "dec": None, "bin": None, "a": None, "m": None, "st": None,
    }


def test_projection_prunes_and_keeps_types(spark):
    df = spark.createDataFrame([], ALL_TYPES)
    stored = {f.name: f.dataType.simpleString() for f in supported_projection(df).schema.fields}
    assert stored == {
        "b": "tinyint", "s": "smallint", "i": "int", "l": "bigint", "f": "float", "d": "double",
        "t": "string", "z": "boolean", "ts": "timestamp", "dt": "timestamp",
        "ntz": "timestamp_ntz",
    }


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instants_keep_the_wall_clock(spark, zone):
    """02:30 on the day clocks skip 02:00-03:00 must stay 02:30."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT timestamp_ntz'2024-03-10 02:30:00.123456' AS gap,"
            " timestamp_ntz'1969-12-31 23:59:59.999999' AS early,"
            " timestamp'2024-05-01 10:00:00.987654' AS zoned, date'2024-05-01' AS day"
        )
        row = supported_projection(df).selectExpr(
            *[f"cast({c} AS string) AS {c}" for c in df.columns]
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row.asDict() == {
        "gap": "2024-03-10 02:30:00.123",
        "early": "1969-12-31 23:59:59.999",
        "zoned": "2024-05-01 10:00:00.987",
        "day": "2024-05-01 00:00:00",
    }


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x")], ["a.b", "c`d"])
    assert supported_projection(df).columns == ["a.b", "c`d"]


def test_null_cells_are_no_properties(spark):
    df = spark.createDataFrame(
        [(1, "x", 2.5), (2, None, 1.0), (3, None, None)], "id bigint, name string, score double"
    )
    rows = {tuple(r) for r in properties_long(df, ["id"]).collect()}
    assert rows == {(1, "name", "x"), (1, "score", "2.5"), (2, "score", "1.0")}


@pytest.mark.parametrize(
    "query,found",
    [
        ("Small RING", [1, 2, 3]),
        ("ring", [1, 2, 3, 4]),
        ("ring ring", [1, 2, 3, 4]),
        ("rin", []),
        ("---", []),
        ("", []),
        ("größe", [5]),
    ],
)
def test_text_contains(spark, query, found):
    texts = [
        (1, "small ring"), (2, "RING, very small!"), (3, "ring-small"), (4, "a ring"),
        (5, "Die GRÖSSE und größe"), (6, ""), (7, None),
    ]
    df = spark.createDataFrame(texts, "id int, t string")
    hits = df.where(text_contains(F.col("t"), query)).collect()
    assert sorted(r["id"] for r in hits) == found


def test_equal_word_sets_are_equal_arrays(spark):
    df = spark.createDataFrame([("Small RING",), ("ring small",), ("ring-small! ring",)], "t string")
    assert df.select(word_set(F.col("t"))).distinct().count() == 1


def test_millisecond_value_is_a_plain_datetime(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 1999),)], "t timestamp_ntz")
    assert supported_projection(df).first()[0] == dt.datetime(2024, 1, 1, 0, 0, 0, 1000)
