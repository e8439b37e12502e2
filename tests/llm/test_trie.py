"""The prefix trie against a plain one, and odd conversations."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
from weftgraph.llm import trie
from weftgraph.llm.common import importable

TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, a string, rank int, _row int, c bigint"


def plain(rows):
    """{(conv_id, depth): the other columns}; turns of a conversation have different numbers."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c in own:
        own[c] = [x[2:] for x in sorted(own[c])]
    told = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        told[c] = own.get(base, [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in told.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own_saving = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = own_saving + sum(saved[x] for x in children[node])
    out = {}
    for node, own_members in members.items():
        ids = ",".join(map(str, sorted(ends[node])))
        out[min(own_members), len(node)] = (
            min(members[node[:-1]]) if node else None, len(own_members), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(ids.encode()).hexdigest(),
        )
    return out


def _check(spark, rows, parts=5):
    importable(spark)
    df = spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], TURNS).repartition(parts)
    found = trie.prefix_trie(df)
    names = ["parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = found.collect()
    expected = plain(rows)
    assert len(got) == len(expected)
    assert {(r["conv_id"], r["depth"]): tuple(r[n] for n in names) for r in got} == expected
    return got


def _odd():
    rng = np.random.default_rng(8)
    rows = []
    for c in [*range(-12, 70), 1003, 1009]:  # the bases of the last two are missing
        for t in range(int(rng.integers(1, 12))):
            if c != 15:
                rows.append((c, t, "user" if t % 2 == 0 else None, rng.choice(["hi", "ho", "é", None])))
    rows += [(200 + c, t, "user", "the same") for c in range(150) for t in range(3)]  # copies
    rows += [(400 + c, 0, "user", f"own {c}") for c in range(100)]
    rows += [(600, t, "user", f"long {t % 7}") for t in range(800)]  # a hot conversation
    rows += [(601, None, "user", "first"), (601, 0, None, "second"), (None, 0, "user", "nobody's")]
    rows += [(5000 + c, 0, "user", "hi") for c in range(4)]
    return rows


def test_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 16)
    monkeypatch.setattr(trie, "BLOCK_ARCS", 64)
    _check(spark, _odd())


def test_odd_conversations_without_small_data_plans(spark, no_small_data_plans):
    got = _check(spark, _odd(), 3)
    # The places are those of a depth-first walk: every arc has its own, a node's first.
    assert sorted(r["arcs_to_end"] for r in got)[-1] == 2 * len(got)
    assert len({r["arcs_to_end"] for r in got}) == len(got)


def test_repeated_rows_and_tied_turns(spark):
    importable(spark)
    rows = [(10, 0, "user", "x")] * 3 + [(10, 1, "user", t) for t in "abc"] + [(11, 0, "user", "x")]
    make = lambda n: spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], TURNS).repartition(n)
    found = [sorted(map(repr, trie.prefix_trie(make(n)).collect())) for n in (1, 4)]
    assert found[0] == found[1] and len(found[0]) >= 7


def test_no_conversations_and_one_without_turns(spark):
    importable(spark)
    empty = spark.createDataFrame([], TURNS)
    assert trie.prefix_trie(empty).collect() == []
    lonely = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(lonely, 0, "user", "gone")]
    assert plain(rows) == {(lonely, 0): (None, 1, 0, 1, 0, hashlib.sha256(str(lonely).encode()).hexdigest())}
    _check(spark, rows)


def test_running_numbers_over_partitions(spark, no_small_data_plans):
    importable(spark)
    rows = [(1 if i % 3 else i, i, (i * 0x9E3779B97F4A7C15) & trie.MASK) for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, at bigint, v bigint").repartition(4)
    got = trie.running(df, ["k"], [F.col("at")], ["v"], "test-running").collect()
    state = defaultdict(lambda: [0, 0])
    for r in sorted(got, key=lambda r: (r["k"], r["at"])):
        s = state[r["k"]]
        s[0], s[1] = s[0] + 1, (s[1] + r["v"]) & trie.MASK
        assert (r["rank"], r["v_run"]) == tuple(s)
