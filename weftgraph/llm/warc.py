"""WARC archives with a two-level capture index.

Pages become WARC/1.1 records, one gzip member each, in archives written by the tasks.
Of pages with equal payloads of some size the one with the smallest page_id is a
response and the others are revisits of it.  The index has one line per record, keyed
by the URL with its host reversed.  Lines are range-sorted into shards, and each shard
is cut into compressed blocks; a sparse directory has the first key, place and length
of each block.  A lookup searches the directory of its shard, reads one block by its
range, searches the block, and reads the record by its range.

Archives are files, written through the file system of their folder's URI.  A task
writes under a name of its own try and the rows that it returns name that file, so a
task that is run again leaves an unused file and nothing else.  Rows that repeat a
page_id with an equal payload are alike and are looked up once each.  Null URLs have an
empty key, null html an empty payload.  A null page_id sorts first.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import stage
from weftgraph.sources.shared import new_dir

MIN_REVISIT_BYTES = 100
BLOCK_LINES = 512
NO_ID = -(2**63)


def reversed_host_key(url: Column) -> Column:
    """``http://www.a.org:80/x?y`` as ``org,a,www:80)/x?y``, lower-cased host first."""
    text = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rest = F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/?#:]*(.*)$", 1)
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.when(host == "", text).otherwise(F.concat(reversed_host, F.lit(")"), rest))


def record_types(pages: DataFrame) -> DataFrame:
    """``pages`` with payload, payload_bytes, payload_digest and refers_to (null for a response)."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    seen = pages.select(F.coalesce("page_id", F.lit(NO_ID)).alias("page_id"), "url", payload.alias("payload"))
    seen = seen.withColumn("payload_bytes", F.length("payload").cast("long"))
    seen = seen.withColumn("payload_digest", F.sha2("payload", 256))
    small = seen.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).select("page_id", "payload_digest")
    small = stage(small, "page-digests")
    first = small.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_n"))
    # Written, so that both sides of the join are shuffled for it and a hot digest can be split.
    first = stage(first.where("_n > 1").drop("_n"), "first-pages")
    later = small.join(first, "payload_digest").where("page_id <> refers_to").distinct()
    return seen.join(later, ["page_id", "payload_digest"], "left")


def _record(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {json.dumps(url)[1:-1] if url else 'urn:none'}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        f"WARC-Page-ID: {page_id}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    return gzip.compress(raw, 6, mtime=0)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        uri = f"file://{uri}"
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the records; one index line (key, page_id, digest, archive, start, length) for each."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        out, place, name = None, 0, f"pages-{uuid.uuid4().hex}.warc.gz"
        try:
            for batch in batches:
                lines = []
                for row in batch.to_pylist():
                    if out is None:
                        system.create_dir(base, recursive=True)
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    record = _record(row["page_id"], row["url"], row["payload"], row["payload_digest"], row["refers_to"])
                    out.write(record)
                    lines.append((row["key"], row["page_id"], row["payload_digest"], name, place, len(record)))
                    place += len(record)
                names = ("key", "page_id", "digest", "archive", "start", "length")
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in lines], t) for i, t in enumerate(kinds)], names=names
                )
        finally:
            if out is not None:
                out.close()

    keyed = record_types(pages).withColumn("key", reversed_host_key(F.col("url")))
    rows = keyed.select("key", "page_id", "url", "payload", "payload_digest", "refers_to")
    schema = "key string, page_id bigint, digest string, archive string, start bigint, length bigint"
    return stage(rows.mapInArrow(per_task, schema), "captures")


def write_index(captures: DataFrame, folder: str) -> list[tuple[str, int, str]]:
    """Sort the captures into blocks; (first key, first page_id, shard) of each shard.

    A shard has a file of blocks and a file with its part of the directory.  The driver
    gets one row per shard; their number is that of the shuffle's partitions.
    """
    shards = captures.repartitionByRange("key", "page_id", "digest").sortWithinPartitions("key", "page_id", "digest")

    def per_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        name, out, place, block, directory = f"shard-{uuid.uuid4().hex}", None, 0, [], []

        def flush() -> None:
            nonlocal place, block
            packed = zlib.compress("\n".join(json.dumps(x) for x in block).encode(), 6)
            out.write(packed)
            directory.append([*block[0][:2], place, len(packed)])
            place, block = place + len(packed), []

        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None:
                        system.create_dir(base, recursive=True)
                        out = system.open_output_stream(f"{base}/{name}.cdx.gz", compression=None)
                    block.append([row[c] for c in ("key", "page_id", "digest", "archive", "start", "length")])
                    if len(block) == BLOCK_LINES:
                        flush()
            if block:
                flush()
        finally:
            if out is not None:
                out.close()
        if directory:
            with system.open_output_stream(f"{base}/{name}.directory", compression=None) as file:
                file.write(zlib.compress(json.dumps(directory).encode(), 6))
        yield pa.RecordBatch.from_pydict({
            "key": pa.array([x[0] for x in directory[:1]], pa.string()),
            "page_id": pa.array([x[1] for x in directory[:1]], pa.int64()),
            "shard": pa.array([name] * len(directory[:1]), pa.string()),
        })

    made = stage(shards.mapInArrow(per_shard, "key string, page_id bigint, shard string"), "shards")
    return sorted(tuple(r) for r in made.collect())


def _range(system: fs.FileSystem, path: str, start: int, length: int) -> bytes:
    with system.open_input_file(path) as file:
        file.seek(start)
        return file.read(length)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = gzip.decompress(raw).partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = rest[: int(headers["Content-Length"])]
    return headers, body.partition(b"\r\n\r\n")[2]


def lookup(
    wanted: DataFrame, shards: list[tuple[str, int, str]], archives: str, index: str, payloads: bool = True
) -> DataFrame:
    """The record of each wanted (key, page_id, digest), read back from its archive.

    Wanted keys are sorted by range, so that a task reads a block of the index once.
    """
    order = wanted.select("key", "page_id", "digest")
    order = order.repartitionByRange("key", "page_id", "digest").sortWithinPartitions("key", "page_id", "digest")
    firsts = [x[:2] for x in shards]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index_system, index_base = _open(index)
        system, base = _open(archives)
        directory: dict[str, list] = {}
        at, lines, keys = None, [], []

        def find(want: tuple) -> list | None:
            nonlocal at, lines, keys
            shard = bisect.bisect_right(firsts, want[:2]) - 1
            while shard >= 0:
                name = shards[shard][2]
                if name not in directory:
                    directory.clear()
                    with index_system.open_input_file(f"{index_base}/{name}.directory") as file:
                        directory[name] = json.loads(zlib.decompress(file.read()))
                blocks = directory[name]
                block = bisect.bisect_right(blocks, want[:2], key=lambda x: (x[0], x[1])) - 1
                while block >= 0:
                    if at != (name, block):
                        raw = _range(index_system, f"{index_base}/{name}.cdx.gz", *blocks[block][2:])
                        lines = [json.loads(x) for x in zlib.decompress(raw).split(b"\n")]
                        keys, at = [tuple(x[:3]) for x in lines], (name, block)
                    n = bisect.bisect_left(keys, want)
                    if n < len(keys) and keys[n] == want:
                        return lines[n]
                    # Lines with the same key and id may begin in the block before.
                    if keys[0][:2] != want[:2]:
                        return None
                    block -= 1
                shard -= 1
            return None

        for batch in batches:
            out = []
            for want in zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "digest"))):
                line = find(want)
                if line is None:
                    continue
                headers, payload = parse_record(_range(system, f"{base}/{line[3]}", *line[4:]))
                kind = headers["WARC-Type"]
                if kind == "response":
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                else:
                    size = int(headers["WARC-Payload-Length"])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                refers = headers.get("WARC-Refers-To-Page-ID")
                shown = payload if payloads and kind == "response" else None
                out.append((want[1], size, digest, kind, None if refers is None else int(refers), shown))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names=names
            )

    schema = (
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, payload binary"
    )
    return order.mapInArrow(read, schema)


def archive(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """Write all pages, index them, and read each back by its URL and id.

    The payload of a revisit is null; that of the page it refers to is the same.
    """
    spark = pages.sparkSession
    archives, index = new_dir(spark, "warc"), new_dir(spark, "cdx")
    captures = write_archives(pages, archives)
    found = lookup(captures, write_index(captures, index), archives, index, payloads)
    return found.withColumn("page_id", F.when(F.col("page_id") != NO_ID, F.col("page_id")))
