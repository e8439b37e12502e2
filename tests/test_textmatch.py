"""Word search for many keys at once against a plain double loop."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from weftgraph.operators.index import token_postings
from weftgraph.operators.textmatch import first_text_match


def _words(text):
    return {w for w in re.split(r"[\W_]+", text.lower()) if w}


def _brute_force(keys, texts):
    found = {}
    for key in keys:
        wanted = _words(key)
        hits = [vid for vid, text in texts if text is not None and wanted and wanted <= _words(text)]
        if hits:
            found[key] = min(hits)
    return found


def _ours(spark, keys, texts, work):
    vertices = spark.createDataFrame(texts, "_vid bigint, t string")
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    rows = first_text_match(frame, token_postings(vertices, "t"), work).collect()
    assert len(rows) == len({r["key"] for r in rows})
    return {r["key"]: r["vid"] for r in rows}


def test_cases_of_one_key(spark, work):
    texts = [(7, "small ring"), (5, "a very small gold ring"), (9, None), (2, "---"), (3, "ring")]
    keys = ["Small RING", "ring small", "ring-small!", "---", "", "ring", "gold ring x", "tiny"]
    assert _ours(spark, keys, texts, work) == {
        "Small RING": 5, "ring small": 5, "ring-small!": 5, "ring": 3,
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_texts_with_a_word_in_most_of_them(spark, tmp_path, seed):
    """One word is in nearly every text and key, and a third of the texts are copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)]

    def text(longest):
        words = rng.choices(vocabulary, weights=range(12, 0, -1), k=rng.randint(0, longest))
        return " ".join(words + ["the"] * (rng.random() < 0.9))

    texts = [(i, text(8)) for i in range(200)] + [(i, "the w0 w1 w2") for i in range(200, 300)]
    rng.shuffle(texts)
    keys = sorted({text(5) for _ in range(120)})
    expected = _brute_force(keys, texts)
    assert len(expected) > 20
    assert _ours(spark, keys, texts, str(tmp_path / "work")) == expected


def test_long_key_in_long_text(spark, work):
    rng = random.Random(4)
    vocabulary = [f"word{i}" for i in range(3000)]
    texts = [(i, " ".join(rng.sample(vocabulary, 1500))) for i in range(12)]
    inside = " ".join(rng.sample(texts[7][1].split(), 400))
    assert _ours(spark, [inside, inside + " absent"], texts, work) == {inside: 7}


def test_nothing_to_search_in(spark, work):
    assert _ours(spark, ["a"], [], work) == {}


def test_sets_of_frequent_words_meet_few_vertices(spark, work, monkeypatch):
    """Every text has the frequent words; a set of them is answered in the first range."""
    from weftgraph.operators import textmatch

    rng = random.Random(6)
    texts = [(i * 3, f"the of and {rng.choice('abcdefgh')} {'rare' if i == 2900 else ''}") for i in range(3000)]
    frequent = ["of the", "the of and", "and of", "the and"]
    keys = [*frequent, *(f"the of {x}" for x in "abcdefgh"), *(f"the {x} z" for x in "ab"), "the rare", "rare of and the"]
    expected = _brute_force(keys, texts)
    met, ranges = [], []
    real_pairs, real_matches = textmatch._with_rarest, textmatch._matches

    def pairs(sets, postings):
        found = real_pairs(sets, postings)
        met.append(found.count())
        return found

    def matches(sets, *others):
        ranges.append(sorted(" ".join(sorted([r["first_word"], r["second_word"], *r["other_words"]])) for r in sets.collect()))
        return real_matches(sets, *others)

    monkeypatch.setattr(textmatch, "_with_rarest", pairs)
    monkeypatch.setattr(textmatch, "_matches", matches)
    monkeypatch.setattr(textmatch, "GROWTH", 4)
    monkeypatch.setattr(textmatch, "RANGES", 4)
    monkeypatch.setattr(textmatch, "_borders", lambda *_: [3 * 3000 // 64, 3 * 3000 // 16, 3 * 3000 // 4])
    assert _ours(spark, keys, texts, work) == expected
    # All of the first range, then only what is not answered yet.
    assert len(ranges[0]) == 14 and ranges[1:] == [["and of rare the", "rare the"]] * 3
    assert sum(met) < 3000


@pytest.mark.parametrize("pairs, ranges", [(0, 1), (800, 1), (801, 2), (10**5, 4), (10**18, 6)])
def test_ranges_follow_from_the_pairs(spark, pairs, ranges):
    from weftgraph.operators import textmatch

    postings = spark.range(100).select(F.col("id").alias("_vid"))
    borders = textmatch._borders(postings, 100, pairs)
    assert borders == sorted(set(borders)) and len(borders) <= ranges - 1
    assert (len(borders) == 0) == (ranges == 1)


def test_too_many_words_to_send_around(spark, work, monkeypatch):
    """Postings are then cut by the frequencies that were counted, and only for whole sets."""
    from weftgraph.operators import textmatch

    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [(i, " ".join(["the", *rng.sample(vocabulary, 6)])) for i in range(400)]
    keys = sorted({" ".join(["the", *rng.sample(vocabulary, rng.randint(0, 3)), *rng.choice([[], ["absent"]])]) for _ in range(80)})
    monkeypatch.setattr(textmatch, "only_wanted", lambda *args: None)
    assert _ours(spark, keys, texts, work) == _brute_force(keys, texts)


def test_sets_meet_blocks_of_vertices_and_not_vertices(spark, work, monkeypatch):
    """All words are in many texts and no text has all of a set: no row is moved for a set and a vertex."""
    from weftgraph.operators import textmatch

    texts = [(i, f"a{i % 8} b{i // 8 % 8} {'c' if i % 8 != i // 8 % 8 else 'd'}") for i in range(1600)]
    keys = [f"a{i} b{i} c" for i in range(8)] + ["a1 b2 c"]
    met = []
    real = textmatch._with_rarest

    def pairs(sets, others):
        found = real(sets, others)
        met.append(found.count())
        return found

    monkeypatch.setattr(textmatch, "_with_rarest", pairs)
    assert _ours(spark, keys, texts, work) == {"a1 b2 c": 17}
    assert sum(met) <= len(keys)  # 1,800 pairs of a set and a vertex with its rarest word


@pytest.mark.parametrize("ids", ["near", "scattered", "segments"])
def test_blocks_of_any_ids(spark, tmp_path, monkeypatch, ids):
    """Blocks of eight ids, stretches that reach over several, few places at once, and several ranges."""
    from weftgraph.operators import textmatch
    from weftgraph.operators.index import token_blocks

    rng = random.Random(8)
    vids = {
        "near": list(range(5, 205)),
        "scattered": sorted(rng.sample(range(5000), 200)),
        "segments": [*range(1 << 33, (1 << 33) + 100), *range(5 << 33, (5 << 33) + 100)],
    }[ids]
    vocabulary = [f"w{i}" for i in range(10)]
    texts = [(v, " ".join(["the", *rng.sample(vocabulary, rng.randint(0, 5))])) for v in vids] + [(4, None)]
    keys = sorted({" ".join(rng.sample([*vocabulary, "the"], rng.randint(1, 5))) for _ in range(90)})
    expected = _brute_force(keys, texts)
    assert 20 < len(expected) < len(keys)
    monkeypatch.setattr(textmatch, "BLOCK_BITS", 3)
    monkeypatch.setattr(textmatch, "PLACES_AT_ONCE", 5)
    monkeypatch.setattr(textmatch, "GROWTH", 2)
    vertices = spark.createDataFrame(texts, "_vid bigint, t string").coalesce(2)
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    for name, postings in (("blocks", token_blocks(vertices, "t")), ("single", token_postings(vertices, "t"))):
        found = first_text_match(frame, postings, str(tmp_path / name))
        assert {r["key"]: r["vid"] for r in found.collect()} == expected
        monkeypatch.setattr(textmatch, "only_wanted", lambda *args: None)
    assert (tmp_path / "blocks" / "found-1").exists()  # more than two ranges
