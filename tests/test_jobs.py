from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from weftgraph import init_edge, init_vertex, load_edges, load_vertices, reindex
from weftgraph.errors import (
    MissingColumnError,
    NameConflictError,
    NotRegisteredError,
    TypeConflictError,
    UnresolvedEndpointError,
    UnsupportedTypeError,
)
from weftgraph.operators.lookup import vertices_by_property, vertices_by_text
from weftgraph.operators.resolve import mark_dangling


def _frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def _map(store, label):
    return f"{store.root}/maps/{label}"


def _load(store, label, df, key, index=(), **options):
    init_vertex(store, label, df, index)
    return load_vertices(store, label, df, key, _map(store, label), **options)


def _edges(store, label, df, keys, maps=None, **options):
    """keys: (edge key, vertex label, vertex key) for A and for B."""
    init_edge(store, label, df)
    (ka, la, va), (kb, lb, vb) = keys
    map_a, map_b = maps or (_map(store, la), _map(store, lb))
    return load_edges(store, label, df, ka, kb, la, lb, va, vb, map_a, map_b, **options)


def _vids(store, label, key):
    rows = store.vertices(label).collect()
    return {r[key]: r["_vid"] for r in rows}


@pytest.fixture
def people(spark):
    return _frame(spark, [(i, f"person {i}") for i in range(1, 7)], "id bigint, name string")


@pytest.fixture
def cities(spark):
    return _frame(
        spark,
        [(10, "Old Town"), (20, "New Town"), (30, "Old Small Town")],
        "city bigint, town string",
    )


# -- vertices ------------------------------------------------------------------


@pytest.mark.parametrize("id_order", ["scan", "key"])
def test_a_vertex_per_row_and_all_of_them_in_the_map(spark, store, id_order):
    rows = [(2, "b", None), (1, "a", 1.5), (2, "c", 2.5), (None, None, None)]
    df = _frame(spark, rows, "id bigint, name string, score double")
    summary = _load(store, "V", df, "id", id_order=id_order, tx_commit_interval=2)
    assert (summary.elements, summary.tx_commits, summary.graph_commits) == (4, 3, 3)
    got = store.vertices("V").collect()
    assert sorted((tuple(r[c] for c in df.columns) for r in got), key=repr) == sorted(rows, key=repr)
    saved = spark.read.orc(_map(store, "V"))
    assert saved.columns == ["id", "vertexID"]
    assert {(r["id"], r["vertexID"]) for r in saved.collect()} == {(r["id"], r["_vid"]) for r in got}
    assert len({r["_vid"] for r in got}) == 4
    if id_order == "key":
        assert sorted(r["_vid"] for r in got) == [1, 2, 3, 4]
        assert min(got, key=lambda r: r["_vid"])["id"] is None


@pytest.mark.parametrize("orders", [("scan", "key", "scan"), ("key", "scan", "key")])
def test_ids_stay_unique_across_labels_and_loads(spark, store, people, cities, orders):
    _load(store, "P", people, "id", id_order=orders[0])
    _load(store, "C", cities, "city", id_order=orders[1])
    _load(store, "P", people, "id", id_order=orders[2])
    assert store.vertices("P").count() == 12
    everyone = store.all_vertices()
    assert everyone.count() == 15
    assert everyone.select("_vid").distinct().count() == 15
    assert set(everyone.columns) == {"_vid", "_label", "id", "name", "city", "town"}
    marked = mark_dangling(everyone.select(F.col("_vid").alias("vid")), store)
    assert marked.where("dangling").count() == 0


def test_the_map_keeps_the_last_load_only(spark, store, people):
    _load(store, "P", people, "id", id_order="key")
    _load(store, "P", people.where("id > 4"), "id", id_order="key")
    saved = {(r[0], r[1]) for r in spark.read.orc(_map(store, "P")).collect()}
    assert saved == {(5, 7), (6, 8)}


def test_empty_source(spark, store):
    for order in ("scan", "key"):
        df = _frame(spark, [], "id bigint, name string")
        summary = _load(store, "V", df, "id", id_order=order)
        assert (summary.elements, summary.tx_commits, summary.graph_commits) == (0, 1, 1)
    assert store.vertices("V").count() == 0
    assert spark.read.schema("id bigint, vertexID bigint").orc(_map(store, "V")).count() == 0


def test_orc_source_by_path(spark, store, people, tmp_path):
    path = str(tmp_path / "people")
    people.repartition(3).write.orc(path)
    _load(store, "P", path, "id")
    assert store.vertices("P").count() == 6


def test_columns_may_differ_between_loads(spark, store, people):
    _load(store, "P", people, "id")
    _load(store, "P", _frame(spark, [(9, 3)], "id bigint, age int"), "id")
    rows = store.vertices("P").collect()
    assert {(r["id"], r["name"], r["age"]) for r in rows if r["id"] in (1, 9)} == {
        (1, "person 1", None), (9, None, 3),
    }


def test_dates_and_timestamps_share_a_column(spark, store):
    _load(store, "D", _frame(spark, [(1, dt.date(2024, 5, 1))], "id int, at date"), "id")
    later = dt.datetime(2024, 5, 2, 1, 2, 3, 4567)
    _load(store, "D", _frame(spark, [(2, later)], "id int, at timestamp_ntz"), "id")
    rows = {r["id"]: r["at"] for r in store.vertices("D").collect()}
    assert rows == {1: dt.datetime(2024, 5, 1), 2: dt.datetime(2024, 5, 2, 1, 2, 3, 4000)}


def test_a_date_can_be_the_key(spark, store):
    df = _frame(spark, [(dt.date(2024, 5, i),) for i in (1, 2)], "day date")
    _load(store, "Day", df, "day", id_order="key")
    edges = _frame(spark, [(dt.date(2024, 5, 2), dt.date(2024, 5, 1))], "a date, b date")
    _edges(store, "E", edges, [("a", "Day", "day"), ("b", "Day", "day")])
    assert [tuple(r)[:2] for r in store.edges("E").collect()] == [(2, 1)]


def test_labels_and_columns_with_odd_names(spark, store):
    df = _frame(spark, [(1, "x")], "`a.b` bigint, `c d` string")
    _load(store, "My/Label = 1%", df, "a.b", ["c d"])
    assert store.vertices("My/Label = 1%").count() == 1
    assert store.postings(store.index_name("My/Label = 1%"), "c d").count() == 1


def test_what_a_vertex_load_refuses(spark, store, people):
    with pytest.raises(NotRegisteredError):
        load_vertices(store, "P", people, "id", _map(store, "P"))
    init_vertex(store, "P", people)
    for bad in ("ID", "nope"):
        with pytest.raises(MissingColumnError):
            load_vertices(store, "P", people, bad, _map(store, "P"))
    with pytest.raises(UnsupportedTypeError):
        lists = people.select(F.array("id").alias("id"), "name")
        load_vertices(store, "P", lists, "id", _map(store, "P"))
    with pytest.raises(TypeConflictError):
        load_vertices(store, "P", people.selectExpr("string(id) AS id"), "id", _map(store, "P"))
    with pytest.raises(ValueError):
        load_vertices(store, "P", people, "id", _map(store, "P"), tx_commit_interval=0)
    with pytest.raises(ValueError):
        load_vertices(store, "P", people, "id", _map(store, "P"), id_order="random")
    assert store.vertices("P") is None


# -- edges -----------------------------------------------------------------------


def _knows(spark):
    rows = [(1, 2, 0.5), (1, 2, 0.5), (2, 1, None), (None, 2, 1.0), (1, None, 1.0), (None, None, 1.0)]
    return _frame(spark, rows, "a bigint, b bigint, w double")


@pytest.mark.parametrize("id_order", ["scan", "key"])
def test_edges_are_directed_parallel_and_keep_their_columns(spark, store, people, id_order):
    _load(store, "P", people, "id", id_order=id_order)
    both = [("a", "P", "id"), ("b", "P", "id")]
    summary = _edges(store, "KNOWS", _knows(spark), both, tx_commit_interval=3)
    assert (summary.elements, summary.rejected, summary.tx_commits) == (3, 0, 2)
    vid = _vids(store, "P", "id")
    rows = sorted(tuple(r) for r in store.edges("KNOWS").fillna(-1.0, ["w"]).collect())
    assert rows == sorted(
        [
            (vid[1], vid[2], 1, 2, 0.5, "KNOWS"),
            (vid[1], vid[2], 1, 2, 0.5, "KNOWS"),
            (vid[2], vid[1], 2, 1, -1.0, "KNOWS"),
        ]
    )
    _edges(store, "KNOWS", _knows(spark), both)
    assert store.edges("KNOWS").count() == 6


def test_the_greatest_id_of_a_key_wins(spark, store):
    df = _frame(spark, [(1, "x"), (2, "y"), (1, "z"), (None, "n")], "id bigint, name string")
    _load(store, "V", df.coalesce(1), "id")
    _edges(
        store, "E", _frame(spark, [(1, 2)], "a bigint, b bigint"),
        [("a", "V", "id"), ("b", "V", "id")],
    )
    names = {r["_vid"]: r["name"] for r in store.vertices("V").collect()}
    edge = store.edges("E").first()
    assert (names[edge["_src"]], names[edge["_dst"]]) == ("z", "y")


@pytest.mark.parametrize("indexed", [False, True])
def test_map_first_then_search_within_the_label(spark, store, people, cities, indexed):
    _load(store, "P", people, "id", ["id"] if indexed else (), id_order="key")
    _load(store, "C", cities, "city", ["town"] if indexed else (), id_order="key")
    _load(store, "Other", cities.selectExpr("city + 5 AS city", "'Town' AS town"), "city")
    half = f"{store.root}/maps/half"
    store.vertices("P").where("id <= 3").select("id", "_vid").write.orc(half)
    towns = f"{store.root}/maps/towns"
    spark.createDataFrame([("somewhere else", 8)], "t string, v bigint").write.orc(towns)
    rows = [(1, "town OLD"), (5, "Small!"), (6, "somewhere else"), (2, "Old Town")]
    df = _frame(spark, rows, "who bigint, place string")
    _edges(
        store, "IN", df, [("who", "P", "id"), ("place", "C", "town")], (half, towns),
        use_index=indexed,
    )
    got = {(r["who"], r["_src"], r["_dst"]) for r in store.edges("IN").collect()}
    assert got == {(1, 1, 7), (5, 5, 9), (6, 6, 8), (2, 2, 7)}


def test_keys_of_another_type_are_not_in_the_map(spark, store):
    df = _frame(spark, [(1, "a"), (2, "b")], "id bigint, name string")
    _load(store, "V", df, "id", id_order="key")
    ints = f"{store.root}/maps/ints"
    spark.createDataFrame([(1, 2)], "id int, v bigint").write.orc(ints)
    edges = _frame(spark, [(1, 1)], "a bigint, b bigint")
    _edges(store, "E", edges, [("a", "V", "id"), ("b", "V", "id")], (ints, _map(store, "V")))
    assert tuple(store.edges("E").first())[:2] == (1, 1)


def test_unresolved_keys_stop_the_job_before_it_writes(spark, store, people):
    _load(store, "P", people, "id")
    df = _frame(spark, [(1, 2), (1, 77), (88, 2), (88, 99)], "a bigint, b bigint")
    keys = [("a", "P", "id"), ("b", "P", "id")]
    with pytest.raises(UnresolvedEndpointError, match="1 keys of a and 2 keys of b"):
        _edges(store, "E", df, keys)
    assert store.edges("E") is None
    summary = _edges(store, "E", df, keys, on_missing="quarantine")
    assert (summary.elements, summary.rejected) == (1, 3)
    rejects = {tuple(r) for r in store.rejects("E").collect()}
    assert rejects == {
        (None, "missing", 1, 77), ("missing", None, 88, 2), ("missing", "missing", 88, 99),
    }


@pytest.mark.parametrize("id_order", ["scan", "key"])
def test_a_map_that_names_no_vertex(spark, store, people, id_order):
    """A map hit is final: it is not searched for by property instead."""
    _load(store, "P", people, "id", id_order=id_order)
    broken = f"{store.root}/maps/broken"
    last = store.next_id()
    spark.read.orc(_map(store, "P")).selectExpr(
        "id", f"if(id = 2, {last}, if(id = 3, 0, vertexID)) AS v"
    ).write.orc(broken)
    df = _frame(spark, [(1, 1), (2, 1), (1, 3)], "a bigint, b bigint")
    keys = [("a", "P", "id"), ("b", "P", "id")]
    with pytest.raises(UnresolvedEndpointError):
        _edges(store, "E", df, keys, (broken, broken))
    _edges(store, "E", df, keys, (broken, broken), on_missing="quarantine")
    assert {tuple(r)[:2] for r in store.rejects("E").collect()} == {
        ("dangling", None), (None, "dangling"),
    }
    assert store.edges("E").count() == 1


def test_what_an_edge_load_refuses(spark, store, people, cities):
    _load(store, "P", people, "id")
    df = _frame(spark, [(1, "x")], "a bigint, b string")
    with pytest.raises(MissingColumnError):
        _edges(store, "E", df, [("a", "P", "id"), ("nope", "P", "id")])
    with pytest.raises(TypeConflictError):
        _edges(store, "E", df, [("a", "P", "id"), ("b", "P", "id")])
    with pytest.raises(NotRegisteredError):
        _edges(store, "E", df, [("a", "P", "id"), ("b", "P", "no_such_property")])
    with pytest.raises(NotRegisteredError):
        _edges(
            store, "E", df, [("a", "P", "id"), ("b", "City", "name")],
            (_map(store, "P"), _map(store, "P")),
        )
    with pytest.raises(UnsupportedTypeError):
        words = f"{store.root}/maps/words"
        spark.createDataFrame([(1, "not an id")], "id bigint, v string").write.orc(words)
        _edges(store, "E", df, [("a", "P", "id"), ("b", "P", "name")], (words, words))
    assert store.edges("E") is None


def test_label_without_vertices_finds_nothing(spark, store, people):
    _load(store, "P", people, "id")
    init_vertex(store, "Q", people)
    empty = f"{store.root}/maps/empty"
    spark.createDataFrame([], "k string, v bigint").write.orc(empty)
    df = _frame(spark, [(1, "person")], "a bigint, b string")
    keys = [("a", "P", "id"), ("b", "Q", "name")]
    _edges(store, "E", df, keys, (_map(store, "P"), empty), on_missing="quarantine")
    assert store.edges("E").count() == 0 and store.rejects("E").count() == 1


@pytest.mark.parametrize("partitions", ["3", "16"])
def test_every_row_is_an_edge_a_reject_or_without_key(spark, store, partitions):
    """A hub key on both sides, a third of the rows on a missing key."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rng = random.Random(5)
        nodes = [(i, f"n{i}") for i in range(40)]
        rows = []
        for _ in range(600):
            a = rng.choice([0, 0, -1, rng.randrange(40), None])
            b = rng.choice([0, -2, rng.randrange(40), rng.randrange(40), None])
            rows.append((a, b, rng.random()))
        _load(store, "N", _frame(spark, nodes, "id bigint, name string"), "id", id_order="key")
        df = _frame(spark, rows, "a bigint, b bigint, w double")
        keys = [("a", "N", "id"), ("b", "N", "id")]
        summary = _edges(store, "E", df, keys, on_missing="quarantine")
        full = [r for r in rows if r[0] is not None and r[1] is not None]
        good = [r for r in full if r[0] >= 0 and r[1] >= 0]
        assert (summary.elements, summary.rejected) == (len(good), len(full) - len(good))
        got = sorted(tuple(r)[:5] for r in store.edges("E").collect())
        assert got == sorted((a + 1, b + 1, a, b, w) for a, b, w in good)
        bad = sorted(tuple(r)[2:] for r in store.rejects("E").collect())
        assert bad == sorted(r for r in full if r[0] < 0 or r[1] < 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# -- indexes and lookups -------------------------------------------------------------


def test_index_covers_loads_before_and_after_it(spark, store, cities):
    _load(store, "C", cities, "city")
    init_vertex(store, "C", cities, ["town", "city"])
    load_vertices(store, "C", cities.where("city = 10"), "city", _map(store, "C"))
    index = store.index_name("C")
    for _ in range(2):
        tokens = store.postings(index, "town")
        assert tokens.groupBy("token").count().collect().__len__() == 4
        assert {r["token"]: r["count"] for r in tokens.groupBy("token").count().collect()} == {
            "old": 3, "new": 1, "town": 4, "small": 1,
        }
        assert store.postings(index, "city").count() == 4
        reindex(store, "C")
    with pytest.raises(NotRegisteredError):
        reindex(store, "None")


def test_index_leaves_absent_values_out(spark, store):
    df = _frame(spark, [(1, None, None), (2, "x y x", 5)], "id int, t string, n int")
    _load(store, "V", df, "id", ["t", "n"], id_order="key")
    index = store.index_name("V")
    assert {tuple(r) for r in store.postings(index, "t").collect()} == {("x", 2), ("y", 2)}
    assert {tuple(r) for r in store.postings(index, "n").collect()} == {(5, 2)}


@pytest.mark.parametrize("use_index", [False, True])
def test_lookups(spark, store, cities, use_index):
    _load(store, "C", cities, "city", ["town"])
    found = vertices_by_text(store, "C", "town", "town, old", use_index)
    assert sorted(r["city"] for r in found.collect()) == [10, 30]
    assert vertices_by_text(store, "C", "town", "!!", use_index).count() == 0
    assert vertices_by_property(store, "C", "city", 20).first()["town"] == "New Town"
    assert vertices_by_text(store, "Nothing", "town", "x", use_index) is None


def test_a_load_that_died_is_not_seen(spark, store, people):
    _load(store, "P", people, "id")
    people.write.orc(store.path("vertex", "P", "unfinished"))
    assert store.vertices("P").count() == 6


def test_a_load_that_dies_gives_no_id_twice_and_leaves_the_old_map(spark, store, work, monkeypatch):
    from weftgraph.plans import jobs

    rows = spark.createDataFrame([("a x",), ("b x",)], "name string")
    more = spark.createDataFrame([("c x",)], "name string")
    jobs.init_vertex(store, "A", rows, ["name"])
    jobs.load_vertices(store, "A", rows, "name", f"{work}/map", id_order="key")
    before = sorted(map(tuple, spark.read.orc(f"{work}/map").collect()))

    def broken(*args):
        raise RuntimeError("injected")

    for step in ("write_postings", "write_primary_key_map"):
        with monkeypatch.context() as patch:
            patch.setattr(jobs, step, broken)
            with pytest.raises(RuntimeError, match="injected"):
                jobs.load_vertices(store, "A", more, "name", f"{work}/map", id_order="key")
        assert sorted(map(tuple, spark.read.orc(f"{work}/map").collect())) == before
    store.refresh()
    assert store.vertices("A").count() == 2
    jobs.load_vertices(store, "A", more, "name", f"{work}/map", id_order="key")
    store.refresh()
    assert sorted(r["_vid"] for r in store.vertices("A").collect()) == [1, 2, 5]
    assert [tuple(r) for r in spark.read.orc(f"{work}/map").collect()] == [("c x", 5)]


def test_an_index_whose_build_died_is_not_used_and_is_built_on_repeat(spark, store, work, monkeypatch):
    from weftgraph.operators.lookup import vertices_by_text
    from weftgraph.plans import jobs

    rows = spark.createDataFrame([("a x",), ("b x",)], "name string")
    jobs.init_vertex(store, "A", rows)
    jobs.load_vertices(store, "A", rows, "name", f"{work}/map")

    def broken(*args):
        raise RuntimeError("injected")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "write_postings", broken)
        with pytest.raises(RuntimeError, match="injected"):
            jobs.init_vertex(store, "A", rows, ["name"])
    jobs.load_vertices(store, "A", rows.limit(1), "name", f"{work}/map")
    store.refresh()
    assert not store.index_complete(store.index_name("A"))
    assert vertices_by_text(store, "A", "name", "x").count() == 3
    jobs.init_vertex(store, "A", rows, ["name"])
    store.refresh()
    assert store.index_complete(store.index_name("A"))
    assert vertices_by_text(store, "A", "name", "X!").count() == 3
    assert vertices_by_text(store, "A", "name", "--").count() == 0


def test_batches_are_exact_for_large_ordinals(spark):
    from pyspark.sql import functions as F

    from weftgraph.operators.ids import commit_batches

    big = 2**60
    rows = spark.createDataFrame([(big + i,) for i in range(1, 5)], "n bigint")
    found = commit_batches(rows, F.col("n"), 1, 3).orderBy("n").collect()
    assert [r["tx_batch"] for r in found] == [big + i for i in range(1, 5)]
    assert [r["graph_batch"] for r in found] == [(big + i - 1) // 3 + 1 for i in range(1, 5)]


def test_dangling_among_ten_thousand_loads_of_both_orders(spark, store):
    pairs = range(5000)
    at = {i: (2 * i + 1) << 33 for i in pairs}
    loads = []
    for i in pairs:
        scan = (f"s{i}", 2 * i + 1, at[i], at[i] + 9, 10, False, None, "{}")
        dense = (f"d{i}", 2 * i + 2, at[i] + 20, at[i] + 29, 10, True, None, "{}")
        loads += [("vertex", "A", *scan), ("vertex", "A", *dense)]
    store.add_to_registry("loads", loads)
    store.add_to_registry("segments", [(f"s{i}", 2 * i + 1, 10) for i in pairs])
    offsets = {0: False, 9: False, 10: True, 19: True, 20: False, 29: False, 30: True, -1: True}
    expected = {at[i] + o: lost for i in (0, 7, 4999) for o, lost in offsets.items()}
    ids = spark.createDataFrame([(v,) for v in [*expected, None]], "vid bigint")
    rows = mark_dangling(ids, store).collect()
    assert {r["vid"]: r["dangling"] for r in rows} == {**expected, None: False}


def test_dangling_in_ranges_over_several_segments(spark, store):
    wide = (5, 3 << 33)
    far = ((7 << 33) + 1, (7 << 33) + 4)
    store.add_to_registry(
        "loads",
        [
            ("vertex", "A", "one", 1, *wide, wide[1] - wide[0] + 1, True, None, "{}"),
            ("vertex", "A", "two", 2, *far, 4, True, None, "{}"),
        ],
    )
    lost = {4: True, 5: False, 2 << 33: False, 3 << 33: False, (3 << 33) + 1: True}
    lost |= {7 << 33: True, far[0]: False, far[1]: False, far[1] + 1: True, -3: True}
    ids = spark.createDataFrame([(v,) for v in lost], "vid bigint")
    assert {r["vid"]: r["dangling"] for r in mark_dangling(ids, store).collect()} == lost


def test_keys_without_an_id_are_dealt_out(spark, store, no_small_data_plans):
    rows = [("vertex", "A", f"d{i}", i, 10 * i, 10 * i + 3, 4, True, None, "{}") for i in range(1, 4)]
    store.add_to_registry("loads", rows)
    ids = spark.range(4000).select(F.col("id").alias("key"), F.lit(None).cast("bigint").alias("vid"))
    marked = mark_dangling(ids, store)
    sizes = marked.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 1000 and marked.where("dangling").count() == 0


def test_names_that_differ_in_case_are_refused_before_a_write(spark, store):
    _load(store, "A", _frame(spark, [(1, "x")], "id bigint, name string"), "id")
    with pytest.raises(NameConflictError):
        _load(store, "A", _frame(spark, [(2, "y")], "id bigint, Name string"), "id")
    assert [r["name"] for r in store.vertices("A").collect()] == ["x"]
    _load(store, "B", _frame(spark, [(2, "y")], "id bigint, Name string"), "id")
    assert [r["Name"] for r in store.vertices("B").collect()] == ["y"]
