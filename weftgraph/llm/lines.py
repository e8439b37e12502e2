"""Line dedup over the whole corpus with DataFrame functions only.

A line's key is the line without white space at both ends and with A-Z lower-cased.
Each document's distinct keys are exploded and hashed to 128 bits; a key in enough
documents is repeated and stays only in the largest doc_id that has it.  Rows that
share a doc_id count as one document, and a null doc_id comes before all others.
Null and empty texts are one empty line.  Documents come out once for each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import SPACES, carried, returned, stage

MIN_CHARS, MIN_DOCUMENTS = 20, 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), _UPPER, _LOWER)


def _hash(key: Column) -> Column:
    """128 bits of a key; null for a key that is too short."""
    pair = F.struct(F.xxhash64(F.lit(1), key).alias("a"), F.xxhash64(F.lit(2), key).alias("b"))
    return F.when(F.length(key) >= MIN_CHARS, pair)


def _hashes(text: Column) -> Column:
    return F.transform(lines_of(text), lambda line: _hash(line_key(line)))


def _with_row_key(docs: DataFrame) -> DataFrame:
    """A row is told by its id and a hash of its text."""
    ids = F.coalesce("doc_id", F.lit(-(2**63)))
    return docs.withColumn("_id", ids).withColumn("_text", F.xxhash64(F.lit(3), "text"))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(_id, _text, places of the lines that the row loses, in order)."""
    keys = _with_row_key(docs).select("_id", "_text", F.posexplode(_hashes(F.col("text"))).alias("_place", "_key"))
    keys = keys.where("_key is not null").select("_id", "_text", "_place", "_key.a", "_key.b")
    keys = stage(keys, "line-keys")
    repeated = (
        keys.groupBy("a", "b")
        .agg(F.count_distinct("_id").alias("_documents"), F.max("_id").alias("_keeps"))
        .where(F.col("_documents") >= MIN_DOCUMENTS)
        .select("a", "b", "_keeps")
    )
    # Written, so that both sides of the join are shuffled for it and a hot key can be split.
    losing = keys.join(stage(repeated, "repeated-lines"), ["a", "b"]).where("_id <> _keeps")
    losing = losing.groupBy("_id", "_text").agg(F.collect_set("_place").alias("_places"))
    return losing.withColumn("_places", F.array_sort("_places"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``; lines stay in their order.

    Columns that have these names already are replaced.
    """
    docs = docs.drop("kept_text", "n_lines", "n_dropped")
    inner = carried(docs, "doc_id", "text")
    found = _with_row_key(inner).join(repeated_lines(inner), ["_id", "_text"], "left")
    text = F.coalesce("text", F.lit(""))
    n_lines = F.length(text) - F.length(F.translate(text, "\n", "")) + 1
    found = found.withColumn("n_lines", n_lines.cast("long"))
    # The stretches between lost lines: one starts at the front and one after each lost line.
    starts = F.concat(F.array(F.lit(0)), F.transform("_places", lambda p: p + 1))
    ends = F.concat(F.col("_places"), F.array(F.col("n_lines").cast("int")))
    found = found.withColumn("_stretches", F.when(F.col("_places").isNotNull(), F.arrays_zip(starts.alias("s"), ends.alias("e"))))
    found = found.withColumn("_lines", F.when(F.col("_places").isNotNull(), F.split("text", "\n", -1)))
    kept = F.flatten(F.transform("_stretches", lambda x: F.slice("_lines", x["s"] + 1, x["e"] - x["s"])))
    none = F.col("_places").isNull()
    found = found.withColumn("_kept", F.when(none, text).otherwise(F.array_join(kept, "\n")))
    found = found.withColumn("_dropped", F.when(none, F.lit(0)).otherwise(F.size("_places")).cast("long"))
    made = [found["_kept"].alias("kept_text"), found["n_lines"], found["_dropped"].alias("n_dropped")]
    return found.select(*returned(found, docs, "doc_id", "text"), *made)
