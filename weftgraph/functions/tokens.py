"""Word sets of texts, and the all-words-occur predicate."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: everything that is neither letter nor number separates words.
WORD_SEPARATOR = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-cased words of the whole text, in order, with repeats."""
    return F.filter(F.split(F.lower(text), WORD_SEPARATOR), lambda w: w != F.lit(""))


def word_set(text: Column) -> Column:
    """Distinct words in sorted order, so equal sets are equal arrays."""
    return F.sort_array(F.array_distinct(words(text)))


def words_of_query(spark: SparkSession, query: str) -> list[str]:
    """The word set of one query, computed once, so that scans see literals."""
    return spark.range(1).select(word_set(F.lit(query)).alias("words")).first()["words"]


def text_contains(text: Column, query: Column | str) -> Column:
    """True where every word of the query occurs in the text.

    A query without words matches nothing; a null text never matches.
    """
    if isinstance(query, str):
        known = words_of_query(SparkSession.active(), query)
        wanted = F.array(*map(F.lit, known)).cast("array<string>")
    else:
        wanted = word_set(query)
    missing = F.array_except(wanted, words(text))
    return F.coalesce((F.size(wanted) > 0) & (F.size(missing) == 0), F.lit(False))
