"""Quality rules: base rules on words, then robust multivariate outliers.

Each document's statistics become four transformed numbers.  For each language and
source a minimum-covariance-determinant estimate is made with concentration steps:
from a start at medians, each step takes the part of the group that is nearest to the
centre and estimates centre and covariance anew from it, which never raises the
determinant.  Documents farther than the cutoff by Mahalanobis distance are rejected.

All of it is DataFrame functions.  A step is one aggregation of sums per group, over
whole numbers, so the result does not depend on how rows are partitioned; the nearest
part is found from a histogram of distances.  Groups of fewer than ``MIN_GROUP`` rows
use the estimate of their language, and languages that small that of the corpus.

Null and empty texts have no words and fail the base rule.  Null languages and sources
are groups like others.  Repeated rows count each; a group of equal rows has the least
variance allowed and rejects none of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.common import SPACES, WORD, stage

MIN_WORDS, REPEAT_WINDOW, MOST_REPEATED = 20, 8, 30
#: Share of a group that its estimate is made from, and the number of steps.
CORE, STEPS = 0.75, 3
MIN_GROUP = 50
#: Squared distance beyond which a document is rejected: the 0.999 quantile of chi-square
#: with four degrees of freedom.
CUTOFF = 18.47
#: Squared distance within which 75 % of four-dimensional normal points lie, and the
#: share of variance that remains in that part: the estimate is divided by it.
SHRINKS = 0.62
#: Least standard deviation of each transformed statistic, given those before it.
LEAST = (0.5, 0.05, 0.05, 0.15)
UNIT = 1000


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in windows that occur more than once in the text."""
    w = REPEAT_WINDOW

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.least(F.lit(w), F.coalesce(F.get(places, i + 1) - p, F.lit(w))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    def places(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        def repeated(pairs: Column) -> Column:
            kept = F.filter(
                F.transform(pairs, lambda x, i: F.when(
                    (F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"]), x["i"])),
                lambda x: x.isNotNull(),
            )
            return F.array_sort(kept)
        return _let(pairs, repeated)

    def of_windows(windows: Column) -> Column:
        all_differ = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(all_differ, F.lit(0).cast("long")).otherwise(_let(places(windows), covered))

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (w - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, w)))

    hashes = F.transform(words, lambda x: F.xxhash64(x))
    counted = _let(hashes, lambda h: _let(windows(h), of_windows))
    return F.when(F.size(words) >= w, counted).otherwise(F.lit(0)).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` without its text but with the base statistics and ``base_failed``."""
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    kept = docs.select("doc_id", "lang", "source", text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    stats = kept.select(
        "doc_id", "lang", "source",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        _repeat_words(F.col("_words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return stats.withColumn("base_failed", failed)


_X = ("_x0", "_x1", "_x2", "_x3")
_PAIRS = tuple((i, j) for i in range(4) for j in range(i + 1))


def _transformed(stats: DataFrame) -> DataFrame:
    """The four numbers, as thousandths: log of words, word length, symbols, repeats."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    numbers = (
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / n),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / n) + F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
    )
    return stats.withColumns({x: F.round(v * UNIT).cast("long") for x, v in zip(_X, numbers)})


def _estimate(rows: DataFrame, key: list[str]) -> DataFrame:
    """Count, centre and inverse covariance (by its Cholesky factor) of each group."""
    sums = [F.count("*").alias("_n")]
    sums += [F.sum(F.col(x).cast("decimal(38,0)")).alias(f"_s{i}") for i, x in enumerate(_X)]
    sums += [F.sum((F.col(_X[i]) * F.col(_X[j])).cast("decimal(38,0)")).alias(f"_q{i}{j}") for i, j in _PAIRS]
    g = rows.groupBy(*key).agg(*sums)
    g = g.select(*key, "_n", *[(F.col(f"_s{i}").cast("double") / F.col("_n")).alias(f"_m{i}") for i in range(4)],
                 *[F.col(f"_q{i}{j}").cast("double").alias(f"_q{i}{j}") for i, j in _PAIRS])
    for i, j in _PAIRS:
        value = (F.col(f"_q{i}{j}") / F.col("_n") - F.col(f"_m{i}") * F.col(f"_m{j}")) / SHRINKS
        for k in range(j):
            value = value - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
        factor = F.greatest(F.sqrt(F.greatest(value, F.lit(0.0))), F.lit(LEAST[i] * UNIT)) if i == j else value / F.col(f"_l{j}{j}")
        g = g.withColumn(f"_l{i}{j}", factor)
    return g.drop(*[f"_q{i}{j}" for i, j in _PAIRS])


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    total, z = F.lit(0.0), []
    for i in range(4):
        value = F.col(_X[i]) - F.col(f"_m{i}")
        for j in range(i):
            value = value - F.col(f"_l{i}{j}") * z[j]
        z.append(value / F.col(f"_l{i}{i}"))
        total = total + z[i] * z[i]
    return total


def _start(rows: DataFrame) -> DataFrame:
    """Centre at each statistic's median, by histogram, and the least variances."""
    cells = rows.select("_group", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.floor(F.col(x) / 10).alias("cell")) for i, x in enumerate(_X)])).alias("c"))
    counts = cells.groupBy("_group", "c.i", "c.cell").agg(F.count("*").alias("n"))
    running = Window.partitionBy("_group", "i").orderBy("cell")
    below = F.sum("n").over(running) - F.col("n")
    total = F.sum("n").over(Window.partitionBy("_group", "i"))
    median = counts.withColumn("_b", below).withColumn("_t", total).where("2 * _b < _t").groupBy("_group", "i")
    median = median.agg((F.max("cell") * 10.0 + 5).alias("m"))
    start = median.groupBy("_group").agg(*[F.max(F.when(F.col("i") == i, F.col("m"))).alias(f"_m{i}") for i in range(4)])
    spread = {f"_l{i}{j}": F.lit(LEAST[i] * UNIT * 2 if i == j else 0.0) for i, j in _PAIRS}
    return start.withColumn("_n", F.lit(0).cast("long")).withColumns(spread)


def _nearest(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """The core of each group: rows up to the cell of distance in which its share is reached."""
    near = rows.join(estimate, "_group").withColumn("_cell", F.floor(F.log1p(_distance()) * 200))
    counts = near.groupBy("_group", "_cell").agg(F.count("*").alias("n"))
    running = Window.partitionBy("_group").orderBy("_cell")
    counts = counts.withColumn("_b", F.sum("n").over(running) - F.col("n"))
    counts = counts.withColumn("_t", F.sum("n").over(Window.partitionBy("_group")))
    limit = counts.where(F.col("_b") < CORE * F.col("_t")).groupBy("_group").agg(F.max("_cell").alias("_limit"))
    return near.join(limit, "_group").where("_cell <= _limit").select("_group", *_X)


def estimates(rows: DataFrame) -> DataFrame:
    """The estimate of every group of ``rows(_group, _x0.._x3)``; a small table, written."""
    now = _start(rows)
    for step in range(STEPS):
        now = stage(_estimate(_nearest(rows, now), ["_group"]), f"mcd-{step}")
    return now


def judge(docs: DataFrame) -> DataFrame:
    """The statistics of each row, ``distance`` (squared) and ``kept``."""
    stats = stage(_transformed(statistics(docs)), "quality-statistics")
    text = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    names = F.array(F.lit("all"), F.concat_ws("\x1f", F.lit("l"), text("lang")),
                    F.concat_ws("\x1f", F.lit("s"), text("lang"), text("source")))
    sizes = stats.where("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("_in_lang", F.sum("n").over(Window.partitionBy("lang")))
    level = F.when(F.col("n") >= MIN_GROUP, 2).when(F.col("_in_lang") >= MIN_GROUP, 1).otherwise(0)
    sizes = stage(sizes.select(names.alias("_names"), level.alias("_level")), "quality-groups")

    # Every group's estimate is made from all its rows; those of languages and of the
    # corpus only where some group needs them.
    needed = sizes.select(F.get("_names", F.col("_level")).alias("_group")).distinct()
    sound = stats.where("not base_failed").select(F.explode(names).alias("_group"), *_X)
    needed = stage(needed, "quality-needed")
    rows = stage(sound.join(needed, "_group"), "quality-rows")
    made = estimates(rows)
    chosen = sizes.withColumn("_group", F.get("_names", F.col("_level"))).join(made, "_group")
    chosen = stage(chosen.select(F.get("_names", F.lit(2)).alias("_own"), *made.columns[1:]), "quality-chosen")
    judged = stats.withColumn("_own", F.get(names, F.lit(2))).join(chosen, "_own", "left")
    distance = F.when(~F.col("base_failed"), _distance())
    judged = judged.withColumn("distance", distance)
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)
    return judged.withColumn("kept", kept).drop("_own", "_n", *_X, *[f"_m{i}" for i in range(4)], *[f"_l{i}{j}" for i, j in _PAIRS])
