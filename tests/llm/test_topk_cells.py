"""op9's grid: what meets in its cells, and that nothing goes through the driver."""

from __future__ import annotations

import numpy as np
import pytest

from weftgraph.llm import topk
from weftgraph.llm.common import importable
from tests.llm import plain


def _vectors(spark, rows):
    importable(spark)
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


@pytest.fixture
def small_cells(monkeypatch):
    """A grid of several parts of both sides, some blocks in a cell."""
    for name, value in (("BLOCK_VECTORS", 20), ("CELL_QUERIES", 4), ("MOST_QUERIES", 8), ("MOST_BLOCKS", 3), ("CELLS", 4)):
        monkeypatch.setattr(topk, name, value)


def test_queries_are_not_broadcast_to_blocks(spark):
    rng = np.random.default_rng(6)
    df = _vectors(spark, [(i, [float(x) for x in rng.standard_normal(4)]) for i in range(200)])
    found = topk.top_k(df, df.where("vec_id % 50 = 0"), 5)
    assert found.count() == 20
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_top_k_over_many_cells(spark, small_cells):
    rng = np.random.default_rng(7)
    good = [(i, [float(x) for x in np.round(rng.standard_normal(5), 1)]) for i in range(400)]
    good += [(i, good[100][1]) for i in range(400, 440)]
    assert topk._grid(440, 9) == (8, 2)
    df = _vectors(spark, good).repartition(5)
    rows = topk.top_k(df, df.where("vec_id % 50 = 0"), 5).collect()
    assert sorted(tuple(r) for r in rows) == sorted(plain.top_k([(i, [int(np.floor(256 * x)) for x in v]) for i, v in good]))


def test_vectors_of_other_lengths_and_widths_meet(spark, small_cells):
    """Batches can need one byte a number or eight, and have shorter vectors than others."""
    rng = np.random.default_rng(8)
    good = [(i, [float(x) for x in np.round(rng.standard_normal(1 + i % 4) * (1, 0.1, 4000)[i % 3], 2)]) for i in range(150)]
    df = _vectors(spark, good).repartition(6)
    rows = topk.top_k(df, df.where("vec_id % 50 = 0"), 5).collect()
    padded = [(i, [int(np.floor(256 * x)) for x in v] + [0] * (4 - len(v))) for i, v in good]
    assert sorted(tuple(r) for r in rows) == sorted(plain.top_k(padded))


def test_grid_of_large_tables_stays_small():
    for vectors in (10**4, 10**5, 10**6, 10**7):
        blocks, groups = topk._grid(vectors, vectors // 50)
        assert blocks * groups <= 4 * topk.CELLS
        assert vectors / blocks <= 1.5 * topk.MOST_BLOCKS * topk.BLOCK_VECTORS
        assert vectors / 50 / groups <= topk.MOST_QUERIES
