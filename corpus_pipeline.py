"""A training corpus from raw documents, in stages that each use one operator.

Each stage takes what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import jaccard, language, lines, mixing, packing
from weftgraph.llm.common import carried, importable, returned, stage, table

#: Share of the documents learned from that a language's bound is read at, and the part of their
#: cosine that is asked for.  Bounds are by text length, in powers of two.
BOUND_QUANTILE, BOUND_SHARE = 0.01, 0.5
#: Cosine asked for at a length of which nothing was learned: four deviations of chance.
CHANCE = 4 / language.DIMENSIONS**0.5
#: Similarity of near copies in percent, and words in a shingle.
COPY_PERCENT, COPY_WORDS = 80, 5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without letters and alien ones go.

    Texts of one length have about the same cosine with their language, longer ones a higher
    one.  A document goes if its cosine is below half of the 1 % quantile at its length, taken
    over the documents that are learned from.  Null and empty texts go.  A missing ``lang`` is
    no reason to go, and none is changed.
    """
    importable(spark)
    size = F.floor(F.log2(F.greatest(F.length("text"), F.lit(1)).cast("double"))).cast("int")
    learned = language.held_out(docs.select("doc_id", "text", "lang")).where("not held_out and lang is not null")
    prototypes = language.learn(learned)
    own = language.predict(learned.select("text"), prototypes).where(F.col("lang_pred") != language.UNKNOWN)
    # One row for each power of two.
    bounds = own.groupBy(size.alias("size")).agg(
        (F.percentile_approx("score", BOUND_QUANTILE) * BOUND_SHARE).alias("bound")
    )
    judged = language.predict(carried(docs, "doc_id", "text"), prototypes).withColumn("size", size)
    judged = judged.join(F.broadcast(stage(bounds, "language-bounds")), "size", "left")
    bound = F.coalesce("bound", F.lit(CHANCE))
    kept = judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= bound))
    return kept.select(*returned(kept, docs, "doc_id", "text"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that are in many documents.

    A document all of whose lines go stays, with an empty text.
    """
    importable(spark)
    found = lines.dedup_lines(carried(docs, "doc_id", "text"))
    n_chars = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return found.select(*returned(found, docs, "doc_id", "text", text=F.col("kept_text"), n_chars=n_chars))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id.

    Near copies share 80 % or more of their five-word shingles; op7's contract, which
    asks for other numbers, binds only that query.  Rows count by themselves, whether they
    share an id or have none (which is smaller than any).  Documents without words are no copies.
    """
    importable(spark)
    rows = carried(docs, "doc_id", "text")
    counted = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    shared = stage(counted.where("rows > 1 and doc_id is not null").select("doc_id"), "shared-ids")
    # Rows that no id tells from others get numbers below all ids, and are written with them.
    below = rows.agg(F.min("doc_id")).first()[0] or 0
    number = F.lit(min(below, 0) - 1) - F.monotonically_increasing_id()
    doubtful = rows.where("doc_id is null").unionByName(rows.join(shared, "doc_id", "left_semi").select(rows.columns))
    doubtful = stage(doubtful.withColumn("row", number), "rows-without-own-id")
    certain = rows.where("doc_id is not null").join(shared, "doc_id", "left_anti").select(*rows.columns, F.col("doc_id").alias("row"))
    every = certain.select(F.col("row").alias("doc_id"), "text").unionByName(doubtful.select(F.col("row").alias("doc_id"), "text"))
    groups = jaccard.join_components(every, percent=COPY_PERCENT, size=COPY_WORDS)
    groups = stage(groups.select(F.col("doc_id").alias("row"), "component_id"), "copy-groups")
    ids = doubtful.select("row", "doc_id", F.lit(True).alias("known"))
    named = groups.join(ids, "row", "left")
    named = named.withColumn("id", F.when(F.col("known"), F.col("doc_id")).otherwise(F.col("row")))
    first = stage(named.groupBy("component_id").agg(F.min(F.struct("id", "row")).alias("first")), "first-copies")
    later = groups.join(first, "component_id").where("row <> first.row").select("row")
    later = stage(later, "later-copies")
    kept = certain.unionByName(doubtful).join(later, "row", "left_anti")
    return kept.select(*returned(kept, docs, "doc_id", "text"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    importable(spark)
    mixed = mixing.mix_documents(carried(docs, "doc_id", "text", "source"))
    return mixed.select(*returned(mixed, docs, "doc_id", "text", "source"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: the pieces of every document and their places."""
    importable(spark)
    return packing.pack(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("ngram_jaccard_join", one_of_near_copies),
    ("source_mixing", mixed_sources),
    ("best_fit_packing", packed),
]

#: The language model, the components and the packing are not for SQL to say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
