"""Vector codes against a plain Lloyd, and odd vectors."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from weftgraph.llm import codebooks
from weftgraph.llm.common import importable

VECTORS = "vec_id bigint, embedding array<float>, label int, code string, ids int, _label int, trees string"


def plain(rows):
    """{vec_id: (code, error, label_error)} and the digest; vec_ids are distinct."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    width = -(-max(len(r[1]) for r in rows) // 8) * 8
    points = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        points[i, : len(r[1])] = np.floor(np.float32(r[1]).astype(np.float64) * 4096)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))[:16]
    step, books, codes, errors = width // 8, [], [""] * len(rows), [0] * len(rows)
    for p in range(8):
        x = points[:, p * step : (p + 1) * step]
        book = x[first].copy()
        for turn in range(7):
            distance = ((x[:, None] - book[None]) ** 2).sum(2)
            near = distance.argmin(1)
            for e in range(len(book) if turn < 6 else 0):
                if (near == e).any():
                    book[e] = x[near == e].sum(0) // (near == e).sum()
        books.append(book)
        for i in range(len(rows)):
            codes[i] += f"{near[i]:02x}"
            errors[i] += int(distance[i, near[i]])
    by_label = {}
    for r, e in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()
    return {r[0]: (c, e, by_label[r[2]]) for r, c, e in zip(rows, codes, errors)}, digest


def _check(spark, rows, parts=3):
    importable(spark)
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], VECTORS).repartition(parts)
    found = codebooks.compress(df).collect()
    expected, digest = plain(rows)
    assert len(found) == len(expected)
    assert {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in found} == expected
    assert {r["codebooks_sha256"] for r in found} == {digest}


def test_clusters_copies_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(codebooks, "BLOCK_VECTORS", 150)
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 3, (20, 24))
    rows = [(i, (centres[i % 20] + rng.normal(0, 0.05, 24)).tolist(), i % 7) for i in range(900)]
    rows += [(i, centres[3].tolist(), 1) for i in range(900, 1300)]  # a third are copies
    rows += [(-5, None, 1), (-4, [1.0, None], 2), (-3, [float("nan")] * 24, 1), (-2, [float("inf")] * 24, None)]
    rows += [(2000, centres[1].tolist(), None), (2001, [0.5] * 3, None), (2002, [], 3), (None, centres[2].tolist(), 4)]
    _check(spark, rows)


def test_ties_and_few_vectors(spark):
    # On a small grid many points are as near to one entry as to another.
    rng = np.random.default_rng(4)
    grid = lambda n: [(i, (rng.integers(-2, 3, 16) / 4096).tolist(), i % 3) for i in range(n)]
    _check(spark, grid(700))
    _check(spark, grid(5))
    _check(spark, [(1, [0.25] * 8, None)])


def test_no_vectors(spark):
    importable(spark)
    df = spark.createDataFrame([(1, None, 1, "x", 1, 2, "y")], VECTORS)
    for none in (df, df.where("false")):
        found = codebooks.compress(none)
        assert found.collect() == [] and {"vec_id", "code", "error", "label_error", "codebooks_sha256"} <= set(found.columns)


def test_repeated_ids(spark):
    importable(spark)
    rows = [(1, [float(i % 4)] * 8, 1, "x", 1, 2, "y") for i in range(40)]
    found = codebooks.compress(spark.createDataFrame(rows, VECTORS).repartition(4)).collect()
    assert len(found) == 40
    again = codebooks.compress(spark.createDataFrame(rows, VECTORS).repartition(2)).collect()
    assert sorted(found) == sorted(again)


def test_components_that_are_too_large(spark):
    importable(spark)
    df = spark.createDataFrame([(1, [1e30] * 8, 1, "x", 1, 2, "y")], VECTORS)
    with pytest.raises(ValueError, match="not supported"):
        codebooks.compress(df)


def test_cover_tree_holds_what_it_says():
    rng = np.random.default_rng(5)
    points = np.floor(rng.normal(0, 900, (600, 8))).astype(np.int64)
    tree = codebooks.CoverTree.build(points)
    assert sorted(tree.order) == list(range(600)) and (tree.points == points[tree.order]).all()
    for node in range(len(tree.start)):
        own = tree.points[tree.start[node] : tree.end[node]]
        distance = np.sqrt(((own - own[0]) ** 2).sum(1))
        assert distance.max() == tree.radius[node]
        below = range(tree.child[node], tree.child[node] + tree.children[node])
        if below:
            assert sum(tree.end[c] - tree.start[c] for c in below) == len(own)
            assert all(tree.radius[c] <= tree.radius[node] / 2 for c in below)
            centres = tree.points[tree.start[list(below)]]
            apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2)) + np.eye(len(centres)) * 1e9
            assert apart.min() > tree.radius[node] / 2
    entries = points[:16]
    found = np.full(600, -1)
    for starts, ends, entry in tree.assign(entries):
        for s, e, x in zip(starts, ends, entry):
            assert (found[s:e] == -1).all()
            found[s:e] = x
    assert (found == codebooks.squares(tree.points, entries).argmin(1)).all()
