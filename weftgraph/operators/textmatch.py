"""First vertex whose property has all the words of a key, for many keys.

Keys are reduced to distinct word sets.  One pass over the postings counts the wanted words,
with the lowest vertex of each and the blocks of vertices that may have it: a set with an
unknown word is out, a one-word set is answered, and another one is looked for only in blocks
that may have all of its words.

Neither postings nor pairs of set and vertex are moved one by one.  What is moved are a row
for each word of a block, with the places of its vertices, and a row for each set and block.
They meet in one task, which narrows the vertices of the set's rarest word there by its other
words and returns the lowest one left.  A task holds the postings of one block at a time.

Blocks are probed in ascending ranges of ids.  A set that is answered in one range is
dropped from the next, eight times as long, so sets of frequent words, or of a text with many
copies, never meet all blocks.  How many ranges there are follows from the pairs that one
alone would make.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.tokens import word_set
from weftgraph.operators.pruning import only_wanted
from weftgraph.operators.skew import hot_keys, salted_join
from weftgraph.sources.shared import stage

#: Each range of ids has so many times the blocks of the one before.
GROWTH = 8
#: Ranges at most; the first has GROWTH ** (1 - RANGES) of all blocks.
RANGES = 6
#: A block has 2 ** BLOCK_BITS consecutive ids; a task holds the postings of one.
BLOCK_BITS = 13
#: Blocks are dealt over so many bits, which say where a word may be.
ZONES = 256
#: Vertices of rarest words that a task narrows at once.
PLACES_AT_ONCE = 1 << 20


def _in_blocks(postings: DataFrame) -> DataFrame:
    """(token, block, places): postings by blocks of ids, places counted within the block."""
    block_of = lambda vid: F.shiftright(vid, BLOCK_BITS)
    if "_vid" in postings.columns:
        parts = postings.select("token", block_of(F.col("_vid")).alias("block"), F.array("_vid").alias("vids"))
    else:
        first, last = (block_of(F.element_at("_vids", at)) for at in (1, -1))

        def part(block: Column) -> Column:
            return F.struct(block.alias("block"), F.filter("_vids", lambda v: block_of(v) == block).alias("vids"))

        whole = F.array(F.struct(first.alias("block"), F.col("_vids").alias("vids")))
        cut = F.when(first == last, whole).otherwise(F.transform(F.sequence(first, last), part))
        parts = postings.select("token", F.inline(cut)).where(F.size("vids") > 0)
    place = lambda vid: (vid - F.shiftleft("block", BLOCK_BITS)).cast("smallint")
    return parts.select("token", "block", F.transform("vids", place).alias("places"))


def _zone(block: Column) -> Column:
    return F.pmod(F.xxhash64(block), F.lit(ZONES)).cast("int")


def _counted(postings: DataFrame) -> DataFrame:
    """(token, n_vertices, first_vid, zones), added up in the tasks before anything is shuffled.

    ``zones`` are the bits of the blocks that have the word, 64 in a number.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("zone") % 64)
    zones = [F.bit_or(F.when(F.floor(F.col("zone") / 64) == n, bit).otherwise(0)) for n in range(ZONES // 64)]
    first = F.shiftleft("block", BLOCK_BITS) + F.array_min("places")
    return (
        postings.withColumn("zone", _zone(F.col("block")))
        .groupBy("token")
        .agg(
            F.sum(F.size("places")).alias("n_vertices"),
            F.min(first).alias("first_vid"),
            F.array(*zones).alias("zones"),
        )
    )


def _ranked_sets(sets: DataFrame, words: DataFrame) -> DataFrame:
    """Per set whose words are all known: its words from rare to frequent, and the zones that have all of them."""
    set_words = sets.select(
        "set_id", F.size("words").alias("n_words"), F.explode("words").alias("word")
    )
    use = set_words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    found = salted_join(
        set_words, words, F.col("word"), "token", hot_keys(use, "word", "n"), F.col("set_id")
    )
    # As long as the key's own text: one struct per word of the set.
    by_rarity = F.sort_array(F.collect_list(F.struct("n_vertices", "word", "first_vid")))
    zones = [F.bit_and(F.get("zones", F.lit(n))) for n in range(ZONES // 64)]
    ranked = found.groupBy("set_id", "n_words").agg(by_rarity.alias("ranked"), F.array(*zones).alias("zones"))
    complete = ranked.where(F.size("ranked") == F.col("n_words"))
    word = F.col("ranked.word")
    return complete.select(
        "set_id",
        "n_words",
        word[0].alias("first_word"),
        F.try_element_at(word, F.lit(2)).alias("second_word"),
        F.slice(word, 3, F.greatest(F.size(word) - 2, F.lit(0))).alias("other_words"),
        F.col("ranked.first_vid")[0].alias("first_vid"),
        "zones",
    )


def first_text_match(keys: DataFrame, postings: DataFrame, work: str) -> DataFrame:
    """(key, vid): lowest id with all words of the key; unmatched keys are left out.

    ``keys`` has one string column ``key``; ``postings`` is (token, _vid), or (token, _vids) with
    ascending ids.
    """
    key_sets = keys.select("key", word_set(F.col("key")).alias("words")).where(
        F.size("words") > 0
    )
    sets = stage(
        key_sets.groupBy("words")
        .agg(F.count(F.lit(1)).alias("n_keys"))
        .withColumn("set_id", F.monotonically_increasing_id()),
        f"{work}/sets",
    )
    wanted = stage(sets.select(F.explode("words").alias("token")).distinct(), f"{work}/wanted")
    # The texts are read once: what is counted and probed are the postings in place.
    few = only_wanted(postings, "token", wanted)
    kept = stage(_in_blocks(postings if few is None else few), f"{work}/postings")
    counted = _counted(kept)
    words = stage(counted.join(wanted, "token") if few is None else counted, f"{work}/words")
    ranked = stage(_ranked_sets(sets, words), f"{work}/ranked")

    one_word = ranked.where("n_words = 1").select("set_id", F.col("first_vid").alias("vid"))
    n_zones = F.aggregate("zones", F.lit(0), lambda n, bits: n + F.bit_count(bits))
    several = ranked.where("n_words > 1").drop("first_vid").where(n_zones > 0)
    n_sets, pairs = several.agg(F.count(F.lit(1)), F.sum(n_zones)).first()
    found = [one_word]
    if pairs:
        found += _probed(several, kept, n_sets, pairs, work)
    # Staged, as answers are often so few that neither sets nor keys have to be shuffled for them.
    matched = stage(reduce(DataFrame.unionByName, found), f"{work}/matched")
    answers = stage(
        sets.join(matched, "set_id").select(F.col("words").alias("set_words"), "vid"), f"{work}/answers"
    )
    return salted_join(
        key_sets,
        answers,
        F.col("words"),
        "set_words",
        hot_keys(sets, "words", "n_keys"),
        F.col("key"),
    ).select("key", "vid")


def _borders(ids: DataFrame, rows: int, pairs: int) -> list[int]:
    """Ids where a range ends, ascending; none where all pairs are few for so many rows."""
    ranges = 1
    while ranges < RANGES and pairs > rows * GROWTH**ranges:
        ranges += 1
    shares = [GROWTH**-k for k in range(ranges - 1, 0, -1)]
    if not shares:
        return []
    found = ids.agg(F.percentile_approx("_vid", shares, F.lit(10_000))).first()[0]
    return sorted(set(found))


def _probed(sets: DataFrame, postings: DataFrame, n_sets: int, pairs: int, work: str) -> list[DataFrame]:
    """(set_id, vid) of the sets that have a match, range by range; ``pairs`` are of set and zone."""
    blocks = stage(postings.select("block", _zone(F.col("block")).alias("zone")).distinct(), f"{work}/blocks")
    n_blocks, n_zones = blocks.agg(F.count(F.lit(1)), F.count_distinct("zone")).first()
    ends = blocks.select((F.shiftleft(F.col("block") + 1, BLOCK_BITS) - 1).alias("_vid"))
    borders, found, still_open = _borders(ends, n_sets, pairs * n_blocks // n_zones), [], sets
    for n, (low, high) in enumerate(zip([None, *borders], [*borders, None])):
        within = F.lit(True)
        if low is not None:
            within = within & (F.col("block") >= (low + 1) >> BLOCK_BITS)
        if high is not None:
            within = within & (F.col("block") <= high >> BLOCK_BITS)
        used = stage(still_open.select(F.explode(_words_of_set()).alias("token")).distinct(), f"{work}/used-{n}")
        asked = only_wanted(postings, "token", used)
        rows = (postings if asked is None else asked).where(within)
        matches = _matches(still_open, rows, blocks.where(within), low, high)
        found.append(matches if high is None else stage(matches, f"{work}/found-{n}"))
        if high is not None:
            still_open = stage(still_open.join(found[-1], "set_id", "left_anti"), f"{work}/open-{n}")
            if still_open.isEmpty():
                break
    return found


def _words_of_set() -> Column:
    """The words of a set of several."""
    return F.concat(F.array("first_word", "second_word"), "other_words")


def _matches(
    sets: DataFrame, postings: DataFrame, blocks: DataFrame, low: int | None, high: int | None
) -> DataFrame:
    """(set_id, vid): the lowest vertex above ``low`` and up to ``high`` that has all words of the set."""
    asked = _with_rarest(sets, blocks).withColumn("places", F.lit(None).cast("array<smallint>"))
    rows = postings.select(
        "block", F.lit(None).cast("bigint").alias("set_id"), F.array("token").alias("words"), "places"
    )
    # In each block its postings first, then the sets that are looked for in it.
    dealt = rows.unionByName(asked).repartition("block").sortWithinPartitions("block", "set_id")
    found = dealt.mapInArrow(_met(low, high, BLOCK_BITS, PLACES_AT_ONCE), "set_id bigint, vid bigint")
    return found.groupBy("set_id").agg(F.min("vid").alias("vid"))


def _with_rarest(sets: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block, set_id, words) where the block may have the set's rarest word and all the others."""

    def has(zone: Column) -> Column:
        return F.getbit(F.get("zones", F.floor(zone / 64).cast("int")), zone % 64) == 1

    zone = F.explode(F.filter(F.sequence(F.lit(0), F.lit(ZONES - 1)), has))
    asked = sets.select("set_id", _words_of_set().alias("words"), zone.alias("zone"))
    return asked.join(blocks, "zone").select("block", "set_id", "words")


def _met(low: int | None, high: int | None, bits: int, places_at_once: int) -> Callable:
    """The function of the tasks; it has all it needs, as they cannot import this package."""

    def indexed(block: int, parts: list[pa.RecordBatch]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The words, their postings as rising numbers (word, then place), and where each word starts."""
        tokens = pa.concat_arrays([p.column(2).flatten() for p in parts]).dictionary_encode()
        lists = [p.column(3) for p in parts]
        lengths = np.concatenate([pc.list_value_length(c).to_numpy() for c in lists])
        place = np.concatenate([c.flatten().to_numpy() for c in lists]).astype(np.int64)
        keys = np.repeat(tokens.indices.to_numpy().astype(np.int64) << bits, lengths) | place
        vid = place + (block << bits)
        if low is not None or high is not None:
            keys = keys[(vid > (vid.min() - 1 if low is None else low)) & (vid <= (vid.max() if high is None else high))]
        keys.sort()
        return tokens.dictionary, keys, np.searchsorted(keys, np.arange(len(tokens.dictionary) + 1) << bits)

    def matched(block: int, index: tuple, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dictionary, keys, starts = index
        if not len(keys):
            return
        ids, lists = rows.column(1).to_numpy(), rows.column(2)
        n_words = pc.list_value_length(lists).to_numpy()
        word = pc.fill_null(pc.index_in(lists.flatten(), value_set=dictionary), -1).to_numpy().astype(np.int64)
        n_here = np.where(word < 0, 0, np.diff(starts)[word])
        # Each set's words from rare to frequent in this block.
        order = np.lexsort((n_here, np.repeat(np.arange(len(ids)), n_words)))
        word, n_here, first = word[order], n_here[order], np.cumsum(n_words) - n_words
        whole = np.flatnonzero(n_here[first] > 0)
        so_far, at = np.cumsum(n_here[first[whole]]), 0
        while at < len(whole):
            reached = so_far[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(so_far, reached + places_at_once, "right")))
            some = whole[at:end]
            n, rarest = n_here[first[some]], word[first[some]]
            row = np.repeat(some, n)
            place = keys[np.arange(len(row)) + np.repeat(starts[rarest] - (np.cumsum(n) - n), n)] & ((1 << bits) - 1)
            step = 1
            while len(more := np.flatnonzero(n_words[row] > step)):
                key = word[first[row[more]] + step] << bits | place[more]
                met = keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key
                left = np.ones(len(row), bool)
                left[more] = met
                row, place, step = row[left], place[left], step + 1
            lowest = np.flatnonzero(np.diff(row, prepend=-1))
            vids = place[lowest] + (block << bits)
            yield pa.RecordBatch.from_arrays([pa.array(ids[row[lowest]]), pa.array(vids)], names=["set_id", "vid"])
            at = end

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, index = None, [], None
        for batch in batches:
            blocks, asked = batch.column(0).to_numpy(), batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (asked[1:] != asked[:-1])) + 1
            for start, end in zip([0, *cuts], [*cuts, len(blocks)]):
                if start == end:
                    continue
                if blocks[start] != block:
                    block, parts, index = int(blocks[start]), [], None
                rows = batch.slice(start, end - start)
                if not asked[start]:
                    parts.append(rows)
                elif parts or index:
                    if index is None:
                        index, parts = indexed(block, parts), []
                    yield from matched(block, index, rows)

    return per_task
