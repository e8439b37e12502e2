"""The registered queries, each with the SQL that gives the same rows.

Every query builds its graph from the whole test tables in a folder of its
own.  ``SQL`` is what another engine runs on the same tables; ids there are
``row_number()`` over the primary key, which is how ids are given in key order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.functions.tokens import text_contains
from weftgraph.functions.types import properties_long, supported_projection
from weftgraph.operators.ids import commit_batches, commit_counts, key_order_ids
from weftgraph.operators.index import define_index, token_postings, value_postings
from weftgraph.operators.lookup import (
    vertices_by_id,
    vertices_by_property,
    vertices_by_text,
    vertices_with_ids,
)
from weftgraph.operators.registry import (
    key_pairs,
    register_labels,
    register_properties,
    property_statuses,
    schema_profile,
    unregistered_labels,
    value_counts,
)
from weftgraph.operators.resolve import (
    edges_with_keys,
    first_exact_match,
    first_match,
    join_endpoints,
    key_counts,
    label_fallback,
    latest_per_key,
    map_hits,
    map_lookup,
    mark_dangling,
    resolve_keys,
)
from weftgraph.operators.skew import hot_keys
from weftgraph.plans.jobs import (
    commit_log,
    compact_index,
    init_edge,
    init_vertex,
    load_edges,
    load_vertices,
    reindex,
    vertex_batches,
)
from weftgraph.sources.keymaps import current_folder, new_folder
from weftgraph.sources.shared import new_dir, stage
from weftgraph.sources.store import GraphStore
from weftgraph.sources.tables import read_primary_key_map, scan, write_primary_key_map

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The test tables, in the order they are registered.
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Vertex labels: (source table, primary key).
VERTICES = {
    "Region": ("region", "r_regionkey"),
    "Nation": ("nation", "n_nationkey"),
    "Customer": ("customer", "c_custkey"),
    "Supplier": ("supplier", "s_suppkey"),
    "Part": ("part", "p_partkey"),
    "Order": ("orders", "o_orderkey"),
    "Document": ("documents", "doc_id"),
}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name], SQL[name] = function, sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_graph(spark: SparkSession) -> GraphStore:
    return GraphStore(spark, new_dir(spark, "graph"))


def map_path(store: GraphStore, label: str) -> str:
    return f"{store.root}/maps/{label}"


def load_label(
    store: GraphStore,
    sf_dir: str,
    label: str,
    index: tuple[str, ...] = (),
    source: DataFrame | None = None,
    id_order: str = "key",
):
    """Registers and loads one label from its table; the map is saved beside."""
    name, key = VERTICES[label]
    rows = table(store.spark, sf_dir, name) if source is None else source
    init_vertex(store, label, rows, index)
    return load_vertices(store, label, rows, key, map_path(store, label), id_order=id_order)


def vid_sql(label: str, before: tuple[str, ...] = ()) -> str:
    """Vertices of a label loaded after the labels in ``before``."""
    name, key = VERTICES[label]
    earlier = " + ".join(f"(SELECT count(*) FROM {VERTICES[b][0]})" for b in before) or "0"
    return f"(SELECT {earlier} + row_number() OVER (ORDER BY {key} NULLS FIRST) AS _vid, * FROM {name})"


def words_sql(text: str) -> str:
    return (
        rf"list_distinct(list_filter(regexp_split_to_array(lower({text}), "
        rf"'[^\p{{L}}\p{{N}}]+'), lambda w: w <> ''))"
    )


def profile_sql(name: str) -> str:
    return f"""
      SELECT '{name}' AS table_name, d.position, d.name, d.column_type, c.n_values
      FROM (SELECT CAST(row_number() OVER () AS INTEGER) AS position,
                   column_name AS name, column_type FROM (DESCRIBE {name})) d
      JOIN (UNPIVOT (SELECT count(COLUMNS(*)) FROM {name}) ON *
            INTO NAME name VALUE n_values) c USING (name)"""


SOURCE_TYPE_SQL = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  WHEN 'FLOAT[]' THEN 'array<float>' END"""
PROPERTY_TYPE_SQL = """CASE column_type WHEN 'BIGINT' THEN 'Long' WHEN 'INTEGER' THEN 'Integer'
  WHEN 'DOUBLE' THEN 'Double' WHEN 'VARCHAR' THEN 'String' WHEN 'TIMESTAMP' THEN 'Date' END"""
PROFILES_SQL = " UNION ALL ".join(profile_sql(t) for t in TABLES)


# -- sources and maps --------------------------------------------------------


@query("orc_scan", "SELECT * FROM orders")
def orc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "orders-orc")
    table(spark, sf_dir, "orders").write.orc(path)
    return scan(spark, path)


@query("pk_map_scan", f"SELECT c_custkey AS key, _vid AS vid FROM {vid_sql('Customer')}")
def pk_map_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer")
    return read_primary_key_map(spark, map_path(store, "Customer"))


@query(
    "pk_map_build",
    f'SELECT o_orderkey, (SELECT count(*) FROM orders) + _vid AS "vertexID" '
    f"FROM {vid_sql('Order')}"
)
def pk_map_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load of the same rows replaces the map of the first."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Order")
    load_label(store, sf_dir, "Order")
    return scan(spark, map_path(store, "Order"))


@query("map_after_failed_swap", f"""
    SELECT o.o_orderkey, c._vid AS _src
    FROM orders o JOIN {vid_sql('Customer', ('Customer', 'Order'))} c ON c.c_custkey = o.o_custkey""")
def map_after_failed_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are loaded again, but the job dies before their map is current.

    Its vertices are registered, so the edge load finishes the swap and uses their map.
    """
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer")
    load_label(store, sf_dir, "Order")
    customers, current = table(spark, sf_dir, "customer"), map_path(store, "Customer")
    again = load_vertices(store, "Customer", customers, "c_custkey", f"{current}-again", id_order="key")
    # What such a job leaves: a whole map in waiting at the location, and no version of it.
    written = scan(spark, current_folder(spark, f"{current}-again"))
    write_primary_key_map(written, new_folder(current, again.load_id))
    load_placed(store, sf_dir)
    return store.edges("PLACED").select("o_orderkey", "_src")


@query("pk_map_dedupe", f"SELECT o_custkey AS key, max(_vid) AS vid FROM {vid_sql('Order')} GROUP BY o_custkey")
def pk_map_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map whose key repeats: customer of each order -> order."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Order")
    saved = f"{store.root}/maps/by-customer"
    store.vertices("Order").select("o_custkey", "_vid").write.orc(saved)
    return latest_per_key(read_primary_key_map(spark, saved))


# -- schema and registry -----------------------------------------------------


@query(
    "schema_profile",
    f"SELECT table_name, position, name, {SOURCE_TYPE_SQL} AS source_type, "
    f"{PROPERTY_TYPE_SQL} AS property_type, n_values FROM ({PROFILES_SQL})"
)
def profile_of_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = [
        schema_profile(table(spark, sf_dir, t)).withColumn("table_name", F.lit(t)) for t in TABLES
    ]
    return reduce(DataFrame.unionByName, profiles)


@query(
    "register_properties",
    f"SELECT name, min({PROPERTY_TYPE_SQL}) AS property_type, 'SINGLE' AS cardinality, "
    f"CAST(sum(n_values) AS BIGINT) AS n_values FROM ({PROFILES_SQL}) "
    f"WHERE {PROPERTY_TYPE_SQL} IS NOT NULL GROUP BY name"
)
def registered_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of all tables, each name once, with how many values it has."""
    store = new_graph(spark)
    sources = [table(spark, sf_dir, t) for t in TABLES]
    for source in sources:
        register_properties(store, source.schema)
    used = reduce(DataFrame.unionByName, [value_counts(s) for s in sources])
    totals = used.groupBy("name").agg(F.sum("n_values").alias("n_values"))
    return store.registry("properties").join(totals, "name")


@query("property_conflicts", """
    SELECT 'k' AS name, 'Integer' AS offered_type, 'Long' AS registered_type,
           'conflict' AS status, count(s_nationkey) AS n_values FROM supplier
    UNION ALL SELECT 'name', 'String', 'String', 'exists', count(s_name) FROM supplier
    UNION ALL SELECT 'balance', 'Double', NULL, 'created', count(s_acctbal) FROM supplier""")
def property_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers offer an int ``k`` where customers registered a bigint."""
    store = new_graph(spark)
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "c_name AS name")
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_nationkey AS k", "s_name AS name", "s_acctbal AS balance"
    )
    register_properties(store, customers.schema)
    statuses = spark.createDataFrame(
        property_statuses(store, suppliers.schema),
        "name string, offered_type string, registered_type string, status string",
    )
    return statuses.join(value_counts(suppliers), "name")


@query("register_labels", """
    SELECT 'vertex' AS kind, label FROM (
      SELECT lang AS label FROM documents UNION SELECT source FROM documents
      UNION SELECT event_type FROM events)
    UNION ALL
    SELECT 'edge', label FROM (
      SELECT event_type AS label FROM events UNION SELECT role FROM conversations)""")
def registered_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels found in the data; those offered twice are registered once."""
    store = new_graph(spark)
    documents, events = table(spark, sf_dir, "documents"), table(spark, sf_dir, "events")
    types = events.select(F.col("event_type").alias("label"))
    roles = table(spark, sf_dir, "conversations").select(F.col("role").alias("label"))
    langs = documents.select(F.col("lang").alias("label"))
    sources = documents.select(F.col("source").alias("label"))
    for kind, labels in (
        ("vertex", langs),
        ("vertex", sources.union(langs)),
        ("vertex", types.union(sources)),
        ("edge", types),
        ("edge", roles.union(types)),
    ):
        register_labels(store, kind, labels)
    return store.registry("labels")


@query("init_vertex", f"""
    SELECT 'label' AS element, 'Customer' AS name, 'vertex' AS kind, count(*) AS n_values
    FROM customer
    UNION ALL SELECT 'property', name, {PROPERTY_TYPE_SQL}, n_values
    FROM ({profile_sql('customer')})
    UNION ALL SELECT 'index', 'c_nationkey', 'value', count(c_nationkey) FROM customer
    UNION ALL SELECT 'index', 'c_name', 'text', CAST(sum(len({words_sql('c_name')})) AS BIGINT)
    FROM customer""")
def initialised_vertex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the init job registered, with the number of values behind it."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer", ("c_name", "c_nationkey"))
    vertices, index = store.vertices("Customer"), store.index_name("Customer")
    labels = store.registry("labels").crossJoin(
        vertices.agg(F.count(F.lit(1)).alias("n_values"))
    ).select(F.lit("label").alias("element"), F.col("label").alias("name"), "kind", "n_values")
    properties = store.registry("properties").join(value_counts(vertices), "name").select(
        F.lit("property").alias("element"), "name", F.col("property_type").alias("kind"), "n_values"
    )
    sizes = [
        store.postings(index, p).agg(
            F.lit("index").alias("element"),
            F.lit(p).alias("name"),
            F.lit(kind).alias("kind"),
            F.count(F.lit(1)).alias("n_values"),
        )
        for p, kind in store.index_properties(index).items()
    ]
    return reduce(DataFrame.unionByName, [labels, properties, *sizes])


@query("init_edge", f"""
    SELECT 'PLACED' AS label, 'edge' AS kind, name, {PROPERTY_TYPE_SQL} AS property_type, n_values
    FROM ({profile_sql('orders')})""")
def initialised_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_graph(spark)
    orders = table(spark, sf_dir, "orders")
    init_edge(store, "PLACED", orders)
    named = store.registry("properties").join(value_counts(orders), "name")
    return store.registry("labels").crossJoin(named.drop("cardinality"))


@query("edge_type_check", """
    SELECT 'o_custkey' AS edge_key, 'c_custkey' AS vertex_key, 'Long' AS edge_type,
           'Long' AS vertex_type, 'ok' AS status, count(o_custkey) AS n_values FROM orders
    UNION ALL SELECT 'o_orderkey', 'c_nationkey', 'Long', 'Integer', 'mismatch',
           count(o_orderkey) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'c_phone', 'String', NULL, 'missing',
           count(o_orderpriority) FROM orders""")
def edge_type_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key pairs checked against the registry, and how many edges hang on each."""
    store = new_graph(spark)
    orders = table(spark, sf_dir, "orders")
    init_vertex(store, "Customer", table(spark, sf_dir, "customer"))
    init_edge(store, "PLACED", orders)
    pairs = [
        ("o_custkey", "c_custkey"),
        ("o_orderkey", "c_nationkey"),
        ("o_orderpriority", "c_phone"),
    ]
    checked = spark.createDataFrame(
        key_pairs(store, pairs),
        "edge_key string, vertex_key string, edge_type string, vertex_type string, status string",
    )
    return checked.join(value_counts(orders).withColumnRenamed("name", "edge_key"), "edge_key")


@query("edge_label_check", """
    SELECT event_type AS label, count(*) AS n_rows FROM events
    WHERE event_type NOT IN (SELECT lang FROM documents) GROUP BY event_type""")
def edge_label_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that rows ask for and nobody registered."""
    store = new_graph(spark)
    langs = table(spark, sf_dir, "documents").select(F.col("lang").alias("label"))
    register_labels(store, "vertex", langs)
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("label"))
    asked = types.union(langs).groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
    return asked.join(unregistered_labels(store, "vertex", asked), "label", "left_semi")


# -- projections ---------------------------------------------------------------


@query("supported_projection", "SELECT vec_id, label FROM embeddings")
def supported_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supported_projection(table(spark, sf_dir, "embeddings"))


@query("properties_long", """
    SELECT c_custkey, key, value FROM (
      UNPIVOT (SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
                      CAST(c_acctbal AS VARCHAR) AS c_acctbal,
                      nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)
      ON c_name, c_nationkey, c_acctbal, c_mktsegment INTO NAME key VALUE value)""")
def sparse_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null cells are no properties."""
    customers = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    )
    return properties_long(customers, ["c_custkey"])


@query("ts_millis", "SELECT event_id, date_trunc('millisecond', ts) AS ts FROM events")
def ts_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supported_projection(table(spark, sf_dir, "events").select("event_id", "ts"))


@query("date_to_instant", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate FROM orders")
def date_to_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )
    return supported_projection(days).withColumn(
        "o_orderdate", F.col("o_orderdate").cast(T.TimestampNTZType())
    )


# -- ids and vertex loads --------------------------------------------------------


@query("assign_ids", f"SELECT _vid, o_orderkey FROM {vid_sql('Order')}")
def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return key_order_ids(orders, "o_orderkey", 1, new_dir(spark, "sorted"))


@query("load_vertices", f"SELECT 'Customer' AS _label, * FROM {vid_sql('Customer')}")
def load_vertex_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer")
    return store.vertices("Customer")


@query("vertices_scan", f"""
    SELECT 'Customer' AS _label, _vid, c_custkey AS customer, c_acctbal AS amount,
           c_mktsegment AS class FROM {vid_sql('Customer')}
    UNION ALL SELECT 'Order', _vid, o_custkey, o_totalprice, o_orderpriority
    FROM {vid_sql('Order', ('Customer',))}""")
def vertices_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both labels in one frame; a vertex has null for the other's properties."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer")
    load_label(store, sf_dir, "Order")
    return store.all_vertices().selectExpr(
        "_label",
        "_vid",
        "coalesce(c_custkey, o_custkey) AS customer",
        "coalesce(c_acctbal, o_totalprice) AS amount",
        "coalesce(c_mktsegment, o_orderpriority) AS class",
    )


@query("append_loads", f"""
    SELECT _vid, c_custkey FROM {vid_sql('Customer')}
    UNION ALL SELECT _vid, c_custkey FROM {vid_sql('Customer', ('Customer',))}""")
def append_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading the same rows again makes new vertices."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer")
    load_label(store, sf_dir, "Customer")
    return store.vertices("Customer").select("_vid", "c_custkey")


@query("commit_batches", f"""
    SELECT o_orderkey, (_vid - 1) // 1000 + 1 AS tx_batch, (_vid - 1) // 1000 // 4 + 1 AS graph_batch
    FROM {vid_sql('Order')}""")
def commit_batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_graph(spark)
    load_label(store, sf_dir, "Order")
    numbered = commit_batches(store.vertices("Order"), F.col("_vid"), 1000, 4)
    return numbered.select("o_orderkey", "tx_batch", "graph_batch")


@query("commit_batches_scan", """
    SELECT n // 1000 + 1 AS tx_batch, n // 4000 + 1 AS graph_batch, count(*) AS elements,
           min(n) + 1 AS first_ordinal, max(n) + 1 AS last_ordinal
    FROM (SELECT row_number() OVER () - 1 AS n FROM orders) GROUP BY ALL""")
def commit_batches_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch of a load in scan order holds; its ids have gaps, its ordinals none."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer", id_order="scan")
    orders = table(spark, sf_dir, "orders").repartition(7)
    init_vertex(store, "Order", orders)
    saved = map_path(store, "Order")
    load_vertices(
        store, "Order", orders, "o_orderkey", saved, tx_commit_interval=1000, graph_tx_commit_interval=4
    )
    return vertex_batches(store, "Order").groupBy("tx_batch", "graph_batch").agg(
        F.count(F.lit(1)).alias("elements"),
        F.min("ordinal").alias("first_ordinal"),
        F.max("ordinal").alias("last_ordinal"),
    )


@query("commit_batches_second_load", f"""
    SELECT o_orderkey, _vid AS ordinal, (_vid - 1) // 700 + 1 AS tx_batch, (_vid - 1) // 700 // 3 + 1 AS graph_batch
    FROM {vid_sql('Order')}""")
def commit_batches_second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load of a label counts its own elements, with intervals of its own."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Order", id_order="scan")
    orders = table(spark, sf_dir, "orders")
    second = load_vertices(
        store, "Order", orders, "o_orderkey", map_path(store, "Order"),
        tx_commit_interval=700, graph_tx_commit_interval=3, id_order="key",
    )
    return vertex_batches(store, "Order", second.load_id).select(
        "o_orderkey", "ordinal", "tx_batch", "graph_batch"
    )


@query("commit_log", """
    SELECT label, k + 1 AS graph_batch, k * 4 + 1 AS first_tx, least(k * 4 + 4, n // 100 + 1) AS last_tx,
           least(400, n - k * 400) AS elements
    FROM (SELECT 'Customer' AS label, count(*) AS n FROM customer
          UNION ALL SELECT 'PLACED', count(*) FROM orders) l,
         LATERAL (SELECT unnest(range(0, n // 100 // 4 + 1)) AS k)""")
def commit_log_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph commits of a vertex load and of an edge load."""
    store = new_graph(spark)
    customers = table(spark, sf_dir, "customer")
    init_vertex(store, "Customer", customers)
    every = {"tx_commit_interval": 100, "graph_tx_commit_interval": 4}
    load_vertices(store, "Customer", customers, "c_custkey", map_path(store, "Customer"), **every)
    load_label(store, sf_dir, "Order")
    load_placed(store, sf_dir, **every)
    logs = [
        commit_log(store, kind, label).select(F.lit(label).alias("label"), "graph_batch", "first_tx", "last_tx", "elements")
        for kind, label in (("vertex", "Customer"), ("edge", "PLACED"))
    ]
    return logs[0].unionByName(logs[1])


@query("load_summary", """
    SELECT label, elements, elements // 1000 + 1 AS tx_commits,
           elements // 1000 // 4 + 1 AS graph_commits
    FROM (SELECT 'Customer' AS label, count(*) AS elements FROM customer
          UNION ALL SELECT 'Order', count(*) FROM orders
          UNION ALL SELECT 'Supplier', count(*) FROM supplier)""")
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_graph(spark)
    counts = []
    for label in ("Customer", "Order", "Supplier"):
        load_label(store, sf_dir, label)
        counts.append(
            commit_counts(store.vertices(label), 1000, 4).withColumn("label", F.lit(label))
        )
    return reduce(DataFrame.unionByName, counts)


# -- filters and lookups ---------------------------------------------------------

SOME_KEYS_NULL = [
    "CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS o_custkey",
    "CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey",
    "o_totalprice",
]


@query("edge_key_filter", f"""
    SELECT * FROM (SELECT {', '.join(SOME_KEYS_NULL)} FROM orders)
    WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL""")
def edge_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "orders-orc")
    table(spark, sf_dir, "orders").selectExpr(*SOME_KEYS_NULL).write.orc(path)
    return edges_with_keys(scan(spark, path), "o_custkey", "o_orderkey")


def owing_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_acctbal >= 0")


@query("map_hits", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def map_hit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer", source=owing_nothing(spark, sf_dir))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return map_hits(orders, "o_custkey", read_primary_key_map(spark, map_path(store, "Customer")))


@query("vertex_by_id", f"""
    SELECT _vid, c_custkey, c_name FROM {vid_sql('Customer')}
    WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def vertex_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices behind the ids that the orders' customer keys map to."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer")
    load_label(store, sf_dir, "Order")
    keys = key_counts(table(spark, sf_dir, "orders"), "o_custkey")
    ids = map_lookup(keys, read_primary_key_map(spark, map_path(store, "Customer")))
    return vertices_by_id(store.all_vertices(), ids).select("_vid", "c_custkey", "c_name")


@query("vertices_with_ids", f"""
    SELECT c._vid, c.c_custkey FROM {vid_sql('Customer', ('Customer', 'Order'))} c JOIN orders ON o_custkey = c_custkey
    GROUP BY ALL""")
def vertices_with_many_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers that orders name, among those of the second load only."""
    store = new_graph(spark)
    for label in ("Customer", "Order", "Customer"):
        load_label(store, sf_dir, label)
    saved = read_primary_key_map(spark, map_path(store, "Customer"))
    ids = table(spark, sf_dir, "orders").join(saved, F.col("o_custkey") == F.col("key")).select("vid")
    return vertices_with_ids(store, "Customer", ids).select("_vid", "c_custkey")


@query("vertex_by_property", f"SELECT _vid, c_custkey FROM {vid_sql('Customer')} WHERE c_mktsegment = 'BUILDING'")
def vertex_by_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer")
    found = vertices_by_property(store, "Customer", "c_mktsegment", "BUILDING")
    return found.select("_vid", "c_custkey")


@query("text_contains", f"""
    SELECT doc_id, list_has_all({words_sql('text')}, ['the', 'is']) AS both_words
    FROM documents""")
def text_contains_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", text_contains(F.col("text"), "Is THE?").alias("both_words")
    )


@query("vertex_by_text", f"""
    SELECT _vid, p_partkey, p_name FROM {vid_sql('Part')}
    WHERE list_has_all({words_sql('p_name')}, ['small', 'ring'])""")
def vertex_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_graph(spark)
    load_label(store, sf_dir, "Part", ("p_name",))
    return vertices_by_text(store, "Part", "p_name", "Ring, small").select(
        "_vid", "p_partkey", "p_name"
    )


@query("first_match", f"SELECT p_size AS value, min(_vid) AS vid FROM {vid_sql('Part')} GROUP BY p_size")
def first_match_per_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_graph(spark)
    load_label(store, sf_dir, "Part")
    return first_match(value_postings(store.vertices("Part"), "p_size"))


# -- endpoint resolution -----------------------------------------------------------


def _mapped_rows(spark: SparkSession, sf_dir: str, label: str, key: str, name: str) -> DataFrame:
    """Order rows with the id their key has in the saved map, 0 if it is not there."""
    store = new_graph(spark)
    source = owing_nothing(spark, sf_dir) if label == "Customer" else None
    load_label(store, sf_dir, label, source=source)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    saved = read_primary_key_map(spark, map_path(store, label))
    ends = stage(map_lookup(key_counts(orders, key), saved), f"{store.root}/ends")
    wanted = ends.select("key", F.coalesce("vid", F.lit(0)).alias(name))
    return join_endpoints(orders, [(key, wanted, hot_keys(ends, "key", "n_edges"))], "left")


@query("resolve_endpoint_a", """
    SELECT o_orderkey, o_custkey, coalesce(_src, 0) AS _src FROM orders LEFT JOIN
      (SELECT row_number() OVER (ORDER BY c_custkey) AS _src, c_custkey
       FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey""")
def resolve_endpoint_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped_rows(spark, sf_dir, "Customer", "o_custkey", "_src")


@query("resolve_endpoint_b", f"""
    SELECT o.o_orderkey, o.o_custkey, v._vid AS _dst
    FROM orders o LEFT JOIN {vid_sql('Order')} v USING (o_orderkey)""")
def resolve_endpoint_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mapped_rows(spark, sf_dir, "Order", "o_orderkey", "_dst")


@query("fallback_exact", f"""
    SELECT o_custkey AS key, min(_vid) AS vid
    FROM orders JOIN {vid_sql('Customer')} ON o_custkey = c_custkey GROUP BY o_custkey""")
def fallback_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No map at all: keys found by property equality."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer")
    keys = stage(
        key_counts(table(spark, sf_dir, "orders"), "o_custkey"), f"{store.root}/keys"
    )
    return first_exact_match(keys, value_postings(store.vertices("Customer"), "c_custkey"))


FIRST_NAME_SQL = f"""
    SELECT k.key, min(v._vid) AS vid
    FROM (SELECT key, {words_sql('key')} AS w FROM (SELECT DISTINCT p_name AS key FROM part)) k
    JOIN (SELECT _vid, {words_sql('p_name')} AS w FROM {vid_sql('Part')}) v
      ON len(k.w) > 0 AND list_has_all(v.w, k.w)
    GROUP BY k.key"""


def _by_words(
    spark: SparkSession, sf_dir: str, label: str, prop: str, keys: DataFrame, indexed: bool
) -> DataFrame:
    store = new_graph(spark)
    load_label(store, sf_dir, label, (prop,) if indexed else ())
    search = label_fallback(store, label, prop, f"{store.root}/work", indexed)
    return search(keys)


@query("fallback_text", FIRST_NAME_SQL)
def fallback_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "part").select(F.col("p_name").alias("key")).distinct()
    return _by_words(spark, sf_dir, "Part", "p_name", keys, False)


@query("fallback_text_indexed", FIRST_NAME_SQL)
def fallback_text_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "part").select(F.col("p_name").alias("key")).distinct()
    return _by_words(spark, sf_dir, "Part", "p_name", keys, True)


@query("fallback_text_passages", f"""
    WITH k AS (SELECT text AS key, {words_sql('text')} AS w FROM
               (SELECT text FROM benchmark UNION SELECT text FROM conversations)),
         kw AS (SELECT key, len(w) AS n, unnest(w) AS word FROM k),
         vw AS (SELECT _vid, unnest({words_sql('text')}) AS word FROM {vid_sql('Document')})
    SELECT key, min(_vid) AS vid FROM
      (SELECT key, n, _vid FROM kw JOIN vw USING (word) GROUP BY ALL HAVING count(*) = n)
    GROUP BY key""")
def fallback_text_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long keys in long texts: passages and turns found in documents."""
    passages = table(spark, sf_dir, "benchmark").select("text")
    turns = table(spark, sf_dir, "conversations").select("text")
    keys = passages.union(turns).distinct().withColumnRenamed("text", "key")
    return _by_words(spark, sf_dir, "Document", "text", keys, False)


@query("resolve_cascade", f"""
    SELECT o.o_custkey AS key, o.n_edges, v._vid AS vid,
           CASE WHEN v.c_acctbal >= 0 THEN 'map' WHEN v._vid IS NOT NULL THEN 'search'
                ELSE 'missing' END AS via
    FROM (SELECT o_custkey, count(*) AS n_edges FROM orders GROUP BY o_custkey) o
    LEFT JOIN {vid_sql('Customer')} v ON o_custkey = c_custkey""")
def resolve_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map has some of the customers; the others are searched for."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer", ("c_custkey",))
    saved = f"{store.root}/maps/some"
    store.vertices("Customer").where("c_acctbal >= 0").select("c_custkey", "_vid").write.orc(saved)
    keys = key_counts(table(spark, sf_dir, "orders"), "o_custkey")
    work = f"{store.root}/work"
    search = label_fallback(store, "Customer", "c_custkey", work)
    return resolve_keys(store, keys, read_primary_key_map(spark, saved), search, work).table


@query("dangling_ids", f"""
    SELECT c_custkey AS key, _vid + CASE WHEN c_acctbal < 0 THEN (SELECT count(*) FROM customer)
           ELSE 0 END AS vid, c_acctbal < 0 AS dangling
    FROM {vid_sql('Customer')}""")
def dangling_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map that names ids past the last vertex for some keys."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer")
    past = store.next_id() - 1
    broken = store.vertices("Customer").select(
        F.col("c_custkey").alias("key"),
        (F.col("_vid") + F.when(F.col("c_acctbal") < 0, past).otherwise(0)).alias("vid"),
    )
    return mark_dangling(broken, store)


@query("dangling_ids_scan", """
    SELECT c_custkey AS key, c_acctbal < 0 OR c_mktsegment = 'BUILDING' AS dangling FROM customer
    UNION ALL SELECT -o_orderkey, o_orderstatus = 'P' FROM orders""")
def dangling_ids_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of dense loads and of loads in scan order, some of them between or past what exists."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Order")
    customers = table(spark, sf_dir, "customer").repartition(5)
    load_label(store, sf_dir, "Customer", source=customers, id_order="scan")
    load_label(store, sf_dir, "Supplier")
    past = F.lit(1 << 32)  # within a segment, and beyond its rows
    gone = F.when((F.col("c_acctbal") < 0) | (F.col("c_mktsegment") == "BUILDING"), past).otherwise(0)
    keys = store.vertices("Customer").select(F.col("c_custkey").alias("key"), (F.col("_vid") + gone).alias("vid"))
    low = F.when(F.col("o_orderstatus") == "P", -F.col("_vid")).otherwise(F.col("_vid"))
    orders = store.vertices("Order").select((-F.col("o_orderkey")).alias("key"), low.alias("vid"))
    return mark_dangling(keys.unionByName(orders), store).select("key", "dangling")


# -- edge loads ----------------------------------------------------------------------

PLACED_KEYS = ("o_custkey", "o_orderkey", "Customer", "Order", "c_custkey", "o_orderkey")


def load_placed(store: GraphStore, sf_dir: str, **options):
    orders = table(store.spark, sf_dir, "orders")
    init_edge(store, "PLACED", orders)
    maps = map_path(store, "Customer"), map_path(store, "Order")
    return load_edges(store, "PLACED", orders, *PLACED_KEYS, *maps, **options)


@query("load_edges", f"""
    SELECT 'PLACED' AS _label, c._vid AS _src, v._vid AS _dst, o.*
    FROM orders o JOIN {vid_sql('Customer')} c ON o.o_custkey = c.c_custkey
    JOIN {vid_sql('Order', ('Customer',))} v ON o.o_orderkey = v.o_orderkey""")
def load_edges_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and orders as vertices, joined by the orders' own rows."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer")
    load_label(store, sf_dir, "Order")
    load_placed(store, sf_dir)
    return store.edges("PLACED")


@query("load_edges_supplies", f"""
    SELECT 'SUPPLIES' AS _label, s._vid AS _src, p._vid AS _dst, l.*
    FROM lineitem l JOIN {vid_sql('Supplier')} s ON l_suppkey = s_suppkey
    JOIN {vid_sql('Part', ('Supplier',))} p ON l_partkey = p_partkey""")
def load_edges_supplies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few suppliers, many edges each, parallel edges included."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Supplier")
    load_label(store, sf_dir, "Part")
    lines = table(spark, sf_dir, "lineitem")
    init_edge(store, "SUPPLIES", lines)
    load_edges(
        store, "SUPPLIES", lines, "l_suppkey", "l_partkey", "Supplier", "Part",
        "s_suppkey", "p_partkey", map_path(store, "Supplier"), map_path(store, "Part"),
    )
    return store.edges("SUPPLIES")


@query("load_edges_lives_in", f"""
    SELECT 'LIVES_IN' AS _label, c._vid AS _src, n._vid AS _dst, c.c_custkey, c.c_nationkey
    FROM {vid_sql('Customer', ('Nation',))} c JOIN {vid_sql('Nation')} n ON c_nationkey = n_nationkey""")
def load_edges_lives_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Int keys on one side, bigint keys on the other."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Nation")
    load_label(store, sf_dir, "Customer")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    init_edge(store, "LIVES_IN", customers)
    load_edges(
        store, "LIVES_IN", customers, "c_custkey", "c_nationkey", "Customer", "Nation",
        "c_custkey", "n_nationkey", map_path(store, "Customer"), map_path(store, "Nation"),
    )
    return store.edges("LIVES_IN")


@query("load_edges_by_text", f"""
    SELECT 'NAMED_AS' AS _label, v._vid AS _src, f.vid AS _dst, v.p_partkey, v.p_name
    FROM {vid_sql('Part')} v JOIN ({FIRST_NAME_SQL}) f ON v.p_name = f.key""")
def load_edges_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B is a string that no map has, so it is searched by words in the index."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Part", ("p_name",))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    init_edge(store, "NAMED_AS", parts)
    no_names = f"{store.root}/maps/no-names"
    spark.createDataFrame([], "p_name string, vertexID bigint").write.orc(no_names)
    load_edges(
        store, "NAMED_AS", parts, "p_partkey", "p_name", "Part", "Part",
        "p_partkey", "p_name", map_path(store, "Part"), no_names,
    )
    return store.edges("NAMED_AS")


@query("unresolved_edges", """
    SELECT * FROM (
      SELECT CASE WHEN c_custkey IS NULL THEN 'missing' END AS _src_reason,
             CASE WHEN o_orderstatus = 'P' THEN 'missing' END AS _dst_reason, o.*
      FROM orders o LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0)
    WHERE _src_reason IS NOT NULL OR _dst_reason IS NOT NULL""")
def unresolved_edge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose customer or order was not loaded go to the rejects."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer", source=owing_nothing(spark, sf_dir))
    done = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    load_label(store, sf_dir, "Order", source=done)
    load_placed(store, sf_dir, on_missing="quarantine")
    return store.rejects("PLACED")


@query("load_edges_scan_ids", """
    SELECT o_orderkey, c_custkey AS src_key, o_orderkey AS dst_key
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def load_edges_scan_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same edges over vertices numbered with gaps, shown by their keys."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Customer", id_order="scan")
    load_label(store, sf_dir, "Order", id_order="scan")
    load_placed(store, sf_dir)
    a = store.vertices("Customer").select(F.col("_vid").alias("_src"), F.col("c_custkey").alias("src_key"))
    b = store.vertices("Order").select(F.col("_vid").alias("_dst"), F.col("o_orderkey").alias("dst_key"))
    edges = store.edges("PLACED").join(a, "_src").join(b, "_dst")
    return edges.select("o_orderkey", "src_key", "dst_key")


# -- indexes -----------------------------------------------------------------------------


@query("index_define", f"""
    SELECT 'graph_Vertex_Part' AS index, 'Part' AS label, 'p_name' AS property, 'text' AS kind,
           CAST(sum(len({words_sql('p_name')})) AS BIGINT) AS n_postings FROM part
    UNION ALL SELECT 'graph_Vertex_Part', 'Part', 'p_size', 'value', count(p_size) FROM part""")
def index_definition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second definition with other columns changes nothing."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Part", ("p_name", "p_size"))
    define_index(store, "Part", ["p_brand"])
    index = store.index_name("Part")
    sizes = [
        store.postings(index, p).agg(
            F.lit(p).alias("property"), F.count(F.lit(1)).alias("n_postings")
        )
        for p in store.index_properties(index)
    ]
    return store.registry("indexes").join(reduce(DataFrame.unionByName, sizes), "property")


@query("token_index", f"SELECT unnest({words_sql('text')}) AS token, _vid FROM {vid_sql('Document')}")
def token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_graph(spark)
    load_label(store, sf_dir, "Document", ("text",))
    return store.postings(store.index_name("Document"), "text")


@query("value_index", f"SELECT p_size AS value, _vid FROM {vid_sql('Part')} WHERE p_size IS NOT NULL")
def value_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = new_graph(spark)
    load_label(store, sf_dir, "Part", ("p_size",))
    return store.postings(store.index_name("Part"), "p_size")


@query("reindex", f"""
    SELECT unnest({words_sql('p_name')}) AS token, _vid FROM {vid_sql('Part')}
    UNION ALL SELECT unnest({words_sql('p_name')}), _vid FROM {vid_sql('Part', ('Part',))}""")
def index_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts loaded before there was an index, and parts loaded after."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Part")
    load_label(store, sf_dir, "Part", ("p_name",))
    reindex(store, "Part")
    return store.postings(store.index_name("Part"), "p_name")


@query("compact_index", f"""
    SELECT unnest({words_sql('text')}) AS token, _vid FROM {vid_sql('Document')}
    UNION ALL SELECT unnest({words_sql('text')}), _vid FROM {vid_sql('Document', ('Document',))}
    UNION ALL SELECT unnest({words_sql('text')}), _vid FROM {vid_sql('Document', ('Document', 'Document'))}""")
def compacted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings of three loads, merged into one run."""
    store = new_graph(spark)
    for _ in range(3):
        load_label(store, sf_dir, "Document", ("text",))
    compact_index(store, "Document")
    return store.postings(store.index_name("Document"), "text")


@query("document_words", f"SELECT unnest({words_sql('text')}) AS token, _vid FROM {vid_sql('Document')}")
def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings derived on the fly equal those of the index."""
    store = new_graph(spark)
    load_label(store, sf_dir, "Document")
    return token_postings(store.vertices("Document"), "text")
