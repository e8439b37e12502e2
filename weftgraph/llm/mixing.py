"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents lie in the order of a hash, and their words are cut into
blocks of equal size; when a source is through, it starts again.  The schedule has
one slot per block taken: the golden-ratio point of slot i, i * phi mod 1, falls into
the part of one source in the cumulative weights, and the rank of the slot among that
source's slots is the block it takes.  The schedule is a little longer than needed
and a source's last slots are void once its target is reached, so that each takes
its target to the word.

Null and empty texts have size 0 and are never taken.  A null source is a source like
the others, the last in order.  Repeated rows are documents of their own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftgraph.llm.common import carried, returned, stage, word_count

#: Weights of the sources by code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words; most times a source is used.
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS = 1024
#: Golden ratio less 1, as a fraction of 2^32.  Its products with slot numbers below
#: ``MOST_SLOTS`` fit a long; blocks are made larger if there would be more slots.
GOLDEN, CIRCLE, MOST_SLOTS = 2654435769, 1 << 32, 1 << 30
#: Cells of the circle by which slots find their source.
CELLS = 1 << 12


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size) with weight and target; one row per source.

    Shares in proportion to the weights, but none above ``MOST`` times its size: with
    sources in order of size per weight, those up to some point are at their limit and
    share what is left by weight.  The point is the first at which the share per weight
    is within the next source's limit.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    n = len(WEIGHTS)
    weights = F.array(*[F.lit(float(x)) for x in WEIGHTS])
    t = sources.withColumn("weight", F.get(weights, (F.row_number().over(order) - 1) % n))
    t = t.withColumn("limit", MOST * F.col("source_size"))
    t = t.withColumn("per_weight", F.col("limit") / F.col("weight"))
    by_limit = Window.orderBy("per_weight", F.col("source").isNull(), "source")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(1))) * SHARE
    left = total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    t = t.withColumn("level", left / F.sum("weight").over(after))
    fits = F.when(F.col("level") <= F.col("per_weight"), F.col("level"))
    t = t.withColumn("level", F.first(fits, ignorenulls=True).over(Window.orderBy("per_weight")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("limit"), F.coalesce("level", F.lit(float("inf"))) * F.col("weight"))
    return t.select("source", "source_size", "weight", target.alias("target"))


def _key(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _running(value: str, *keys: str, order: str) -> Column:
    """Sum of ``value`` over the rows before this one."""
    window = Window.partitionBy(*keys).orderBy(order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(before), F.lit(0))


def _placed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row with ``_at``, the words of its source that lie before it.

    A source of n rows is cut by the hash into about sqrt(n) parts; the parts are added
    up first, then the rows in each part, so no task holds a whole source.
    """
    part = F.floor(F.shiftrightunsigned("_turn", 33) * F.col("_parts") / F.lit(2.0**31))
    rows = rows.join(plan.select("_key", "_parts"), "_key").withColumn("_part", part).drop("_parts")
    sums = rows.groupBy("_key", "_part").agg(F.sum("size").alias("_sum"))
    sums = sums.select("_key", "_part", _running("_sum", "_key", order="_part").alias("_base"))
    order = Window.partitionBy("_key", "_part").orderBy("_turn", "doc_id", "_same", "size")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(before), F.lit(0)))
    rows = rows.join(sums, ["_key", "_part"]).withColumn("_at", F.col("_in") + F.col("_base"))
    return rows.select("doc_id", "_same", "size", "_key", "_at")


def _schedule(spark: SparkSession, plan: DataFrame) -> DataFrame:
    """(_key, _block, _until): the blocks taken, and where in its source a slot's pass ends."""
    total = plan.agg(F.sum("_need")).first()[0] or 0
    share = F.col("target") / F.sum("target").over(Window.partitionBy(F.lit(1)))
    order = Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    arcs = plan.where("_need > 0").withColumn("_share", share)
    arcs = arcs.withColumn("_end", F.least(F.round(F.sum("_share").over(order) * CIRCLE).cast("long"), F.lit(CIRCLE)))
    arcs = arcs.withColumn("_begin", F.lag("_end", 1, 0).over(Window.orderBy("_key")))
    last = F.row_number().over(Window.orderBy(F.desc("_key"))) == 1
    arcs = arcs.withColumn("_end", F.when(last, F.lit(CIRCLE)).otherwise(F.col("_end")))
    width = CIRCLE // CELLS
    covered = F.sequence(F.floor(F.col("_begin") / width), F.floor((F.col("_end") - 1) / width))
    arcs = arcs.where("_end > _begin").select("_key", "_begin", "_end", F.explode(covered).alias("_cell"))

    per_chunk = max(1, math.isqrt(total))
    slots = spark.range(total).withColumn("_point", (F.col("id") * GOLDEN) % CIRCLE)
    slots = slots.withColumn("_cell", F.floor(F.col("_point") / width)).join(arcs, "_cell")
    slots = slots.where("_begin <= _point and _point < _end")
    slots = slots.select("_key", "id", F.floor(F.col("id") / per_chunk).alias("_chunk"))
    counts = slots.groupBy("_key", "_chunk").agg(F.count("*").alias("_sum"))
    before = counts.select("_key", "_chunk", _running("_sum", "_key", order="_chunk").alias("_base"))
    ranked = slots.withColumn("_rank", F.row_number().over(Window.partitionBy("_key", "_chunk").orderBy("id")) - 1)
    ranked = ranked.join(before, ["_key", "_chunk"])
    ranked = ranked.select("_key", (F.col("_rank") + F.col("_base")).alias("_rank"))

    # The points miss a source's share by a few slots at most; those come at the end.
    got = counts.groupBy("_key").agg(F.sum("_sum").alias("_got"))
    short = plan.join(got, "_key", "left").withColumn("_got", F.coalesce("_got", F.lit(0)))
    short = short.where("_got < _need").select(
        "_key", F.explode(F.sequence("_got", F.col("_need") - 1)).alias("_rank")
    )
    slots = ranked.unionByName(short).join(plan, "_key").where("_rank < _need")
    in_pass = F.floor(F.col("_rank") / F.col("_per_pass"))
    return slots.select(
        "_key",
        (F.col("_rank") % F.col("_per_pass")).alias("_block"),
        (F.col("_words") - in_pass * F.col("source_size")).alias("_until"),
    )


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of each row of ``docs``.

    ``taken`` is the words of the document that the mix has, repeats counted.
    """
    return _mix(docs, block_words).drop("_same")


def _mix(docs: DataFrame, block_words: int) -> DataFrame:
    rows = stage(
        docs.select(
            "doc_id",
            F.xxhash64(F.lit(1), "text").alias("_same"),
            word_count(F.col("text")).alias("size"),
            _key(F.col("source")).alias("_key"),
            "source",
            F.xxhash64(F.lit(5), "doc_id").alias("_turn"),
        ),
        "mix-sizes",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    most = (sizes.agg(F.sum("source_size")).first()[0] or 0) * SHARE / MOST_SLOTS
    block = max(block_words, math.ceil(most))
    plan = targets(sizes).withColumn("_key", _key(F.col("source"))).join(
        sizes.select(_key(F.col("source")).alias("_key"), F.ceil(F.sqrt("_rows")).alias("_parts")), "_key"
    )
    # What a source needs of slots: whole passes of all its blocks, then blocks up to the target.
    plan = plan.withColumn("_words", F.round("target").cast("long"))
    plan = plan.withColumn("_per_pass", F.ceil(F.col("source_size") / block))
    passes = F.floor(F.col("_words") / F.col("source_size"))
    rest = F.col("_words") - passes * F.col("source_size")
    need = F.when(F.col("source_size") > 0, passes * F.col("_per_pass") + F.ceil(rest / block))
    plan = stage(plan.withColumn("_need", F.coalesce(need, F.lit(0)).cast("long")), "mix-targets")

    placed = stage(_placed(rows, plan), "mix-places")
    pieces = placed.where("size > 0").withColumn("_to", F.col("_at") + F.col("size"))
    pieces = pieces.withColumn(
        "_block", F.explode(F.sequence(F.floor(F.col("_at") / block), F.floor((F.col("_to") - 1) / block)))
    )
    low = F.greatest(F.col("_at"), F.col("_block") * block)
    high = F.least(F.col("_to"), (F.col("_block") + 1) * block, F.col("_until"))
    taken = (
        pieces.join(_schedule(docs.sparkSession, plan), ["_key", "_block"])
        .select("_key", "_at", F.greatest(high - low, F.lit(0)).alias("_got"))
        .groupBy("_key", "_at")
        .agg(F.sum("_got").alias("taken"))
        .withColumn("_some", F.lit(True))
    )
    # A row with words is told by its source and place; rows without words take no part.
    placed = placed.withColumn("_some", F.col("size") > 0).join(taken, ["_key", "_at", "_some"], "left")
    return placed.join(plan.select("_key", "source_size", "target"), "_key").select(
        "doc_id", "_same", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents of the mix, each as often as the mix takes it, with their columns.

    A document at the edge of its source's last pass is taken whole or not at all,
    whichever is nearer.
    """
    taken = _mix(docs, block_words).where("size > 0").groupBy("doc_id", "_same").agg(
        F.max("size").alias("_size"), F.avg("taken").alias("_taken")
    )
    times = F.round(F.col("_taken") / F.col("_size")).cast("int")
    taken = taken.select(F.col("doc_id").alias("_id"), F.col("_same").alias("_text"), times.alias("_times"))
    inner = carried(docs, "doc_id", "text")
    matched = inner.join(
        taken.where("_times > 0"),
        inner["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(F.lit(1), inner["text"]) == F.col("_text")),
    )
    repeated = matched.withColumn("_time", F.explode(F.sequence(F.lit(1), "_times")))
    return repeated.select(*returned(repeated, docs, "doc_id", "text"))
