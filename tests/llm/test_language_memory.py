"""Memory of the language profiles, whatever letters the texts have."""

from __future__ import annotations

import tracemalloc

import numpy as np

from weftgraph.llm import language


def _texts(rng, rows):
    """Words of random Latin and Han letters: nearly every 3-gram is new."""
    letters = np.array([*"abcdefghijklmnopqrstuvwxyz", *map(chr, range(0x4E00, 0x4E44))])
    return ["".join(rng.choice(letters, 400)) for _ in range(rows)]


def test_vectors_of_many_different_grams_are_not_held_at_once():
    texts = _texts(np.random.default_rng(1), language.BLOCK_ROWS)
    rows, codes = language.grams(texts)
    assert len(np.unique(codes)) > 50_000
    language.bundles(rows[:10], codes[:10], 1)
    tracemalloc.start()
    language.bundles(rows, codes, len(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


def test_bundles_are_the_sums_of_all_gram_vectors():
    texts = [None, "", *_texts(np.random.default_rng(2), 20), "12 -", "aa aa"]
    rows, codes = language.grams(texts)
    expected = np.zeros((len(texts), language.DIMENSIONS))
    np.add.at(expected, rows, language.gram_vectors(codes))
    assert len(np.unique(codes)) > 2 * language.GRAMS_AT_ONCE
    assert (language.bundles(rows, codes, len(texts)) == expected).all()
    none = language.grams([None, ""])
    assert (language.bundles(*none, 2) == 0).all()
