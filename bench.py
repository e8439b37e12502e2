"""Times the headline jobs and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables and BENCH_CPUS the
number of local cores.  Sources are written as ORC first, and what a job needs
to be there already is loaded first; neither is timed.  Each figure is the
median of BENCH_RUNS (default 3) runs, each on a graph of its own or, for
edges, a new load into the same graph.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weftgraph import GraphStore, init_edge, init_vertex, load_edges, load_vertices, reindex
from weftgraph.operators.resolve import key_counts, label_fallback
from weftgraph.sources.shared import new_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

VERTICES = {
    "Customer": ("customer", "c_custkey"),
    "Order": ("orders", "o_orderkey"),
    "Supplier": ("supplier", "s_suppkey"),
    "Part": ("part", "p_partkey"),
    "Document": ("documents", "doc_id"),
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("weftgraph-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class Bench:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.sources: dict[str, str] = {}
        self.graph = self.new_graph()

    def new_graph(self) -> GraphStore:
        return GraphStore(self.spark, new_dir(self.spark, "bench-graph"))

    def source(self, name: str) -> str:
        if name not in self.sources:
            path = new_dir(self.spark, f"bench-{name}")
            self.spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.orc(path)
            self.sources[name] = path
        return self.sources[name]

    def vertices(self, store: GraphStore, label: str, id_order: str = "scan") -> int:
        name, key = VERTICES[label]
        source, saved = self.source(name), f"{store.root}/maps/{label}"
        init_vertex(store, label, source)
        return load_vertices(store, label, source, key, saved, id_order=id_order).elements

    def edges(self, label: str, name: str, a: tuple[str, str], b: tuple[str, str]) -> int:
        (key_a, label_a), (key_b, label_b) = a, b
        maps = [f"{self.graph.root}/maps/{x}" for x in (label_a, label_b)]
        keys = VERTICES[label_a][1], VERTICES[label_b][1]
        init_edge(self.graph, label, self.source(name))
        return load_edges(
            self.graph, label, self.source(name), key_a, key_b, label_a, label_b, *keys, *maps
        ).elements

    def search(self, label: str, prop: str, keys) -> int:
        work = new_dir(self.spark, "bench-search")
        return label_fallback(self.graph, label, prop, work)(keys).count()

    def prepare(self) -> None:
        for name in ("lineitem", "orders", "benchmark", "conversations"):
            self.source(name)
        for label in VERTICES:
            self.vertices(self.graph, label)

    def jobs(self):
        read = self.spark.read.orc
        passages = (
            read(self.source("benchmark")).select("text")
            .union(read(self.source("conversations")).select("text"))
            .distinct()
            .withColumnRenamed("text", "key")
        )
        names = read(self.source("part")).select(F.col("p_name").alias("key")).distinct()
        customers = key_counts(read(self.source("orders")), "o_custkey")
        return {
            "load_vertices": lambda: self.vertices(self.new_graph(), "Order"),
            "load_vertices_key_order": lambda: self.vertices(self.new_graph(), "Order", "key"),
            "load_edges": lambda: self.edges(
                "PLACED", "orders", ("o_custkey", "Customer"), ("o_orderkey", "Order")
            ),
            "load_edges_supplies": lambda: self.edges(
                "SUPPLIES", "lineitem", ("l_suppkey", "Supplier"), ("l_partkey", "Part")
            ),
            "load_edges_contains": lambda: self.edges(
                "CONTAINS", "lineitem", ("l_orderkey", "Order"), ("l_partkey", "Part")
            ),
            "fallback_exact": lambda: self.search("Customer", "c_custkey", customers),
            "fallback_text": lambda: self.search("Part", "p_name", names),
            "fallback_text_passages": lambda: self.search("Document", "text", passages),
            "reindex": self.reindex,
        }

    def reindex(self) -> int:
        init_vertex(self.indexed, "Document", self.source("documents"), ["text"])
        reindex(self.indexed, "Document")
        return 0


def main() -> None:
    spark = session()
    bench = Bench(spark)
    bench.prepare()
    bench.indexed = bench.new_graph()
    bench.vertices(bench.indexed, "Document")
    seconds = {}
    for name, job in bench.jobs().items():
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            job()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "seconds for all headline jobs (sum of medians)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
