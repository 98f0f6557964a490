"""WARC archives with a two-level capture index.

``write_archives`` writes one record per page in gzip members: of pages with equal payloads that
with the largest id is the response, the others are revisits of it. ``build_index`` sorts the
captures by the URL key (host reversed) over all partitions, packs runs of lines into compressed
blocks, and keeps with each block its first key: these first keys are the sparse directory.
``look_up`` sends each wanted key to the one partition whose range can hold it (a binary search in
the partitions' first keys), finds its block by binary search in that partition's directory,
unpacks the block, and finds the line by binary search. ``read_records`` then reads exactly the
bytes of each capture and parses the record.

Archives are written under the shared folder by the tasks, each try to a file of its own; only
rows of tries that Spark commits name their file, so a task that runs again harms nothing. Their
folder must be reachable by pyarrow's file systems.

A null or empty payload is an empty record and is a payload like any other; equal ones are
revisits if they reach ``least_bytes``. A null URL has an empty key and no target header. Pages
with a null id are responses. Rows with the same id and payload are captures of their own. An
empty table gives an empty result. Only id, URL and payload are read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import binary, shared_dir, slices, stage

LINES = 1000
DATE = "2024-01-01T00:00:00Z"
CAPTURE = "page_id bigint, url string, file string, offset bigint, length bigint"


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query: ``http://www.a.com/x?y`` is ``com,a,www)/x?y``."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    own = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return own + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def _files(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One WARC record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {' '.join(url.split())}"] if url else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>",
           "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers_to is not None else []),
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """Headers that matter and the payload (None for a revisit) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    sizes = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    number = lambda x: int(x[len("<urn:page:"):-1]) if x and x != "<urn:page:>" else None
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": number(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"],
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": int(sizes["Content-Length"]), "refers_to": number(fields.get("WARC-Refers-To")),
        "payload": None if revisit else payload,
    }


def write_archives(
    df: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
) -> DataFrame:
    """Write the archives; their captures as ``page_id``, ``url``, ``file``, ``offset``, ``length``."""
    spark = df.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    pages = df.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload"))
    groups = pages.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(
        F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = pages.join(groups, "digest", "left").select(
        "page_id", "url", "payload", F.when(F.col("page_id") != F.col("response"), F.col("response")).alias("refers_to"))
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = _files(folder)
        name, sink, offset = f"{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in slices(batches, 500):
            if sink is None:
                files.create_dir(path, recursive=True)
                sink = files.open_output_stream(f"{path}/{name}", compression=None)
            offsets, lengths = [], []
            columns = [batch.column(i).to_pylist() for i in (0, 1)], binary(batch.column(2)), batch.column(3).to_pylist()
            for page, url, body, refers in zip(*columns[0], columns[1], columns[2]):
                member = gzip.compress(record(page, url, body, refers), 6, mtime=0)
                sink.write(member)
                offsets.append(offset)
                lengths.append(len(member))
                offset += len(member)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f"{folder}/{name}"] * n, pa.string()), pa.array(offsets, pa.int64()),
                 pa.array(lengths, pa.int64())], ["page_id", "url", "file", "offset", "length"])
        if sink is not None:
            sink.close()

    return stage(rows.mapInArrow(run, CAPTURE), "captures")


def build_index(captures: DataFrame, lines: int = LINES) -> DataFrame:
    """The index: ``part``, ``block``, ``first`` (key and id of its first line), ``n``, ``data``."""
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = captures.select("page_id", "url", "file", "offset", "length")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [url_key(u) for u in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *[batch.column(i) for i in (0, 2, 3, 4)]], ["key", "page_id", "file", "offset", "length"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, part = 0, [], None
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            held += [[r["key"], r["page_id"], r["file"], r["offset"], r["length"]] for r in batch.to_pylist()]
            while len(held) >= lines:
                yield packed(part, block, held[:lines])
                held, block = held[lines:], block + 1
        if held:
            yield packed(part, block, held)

    def packed(part: int, block: int, own: list) -> pa.RecordBatch:
        data = zlib.compress("\n".join(json.dumps(x) for x in own).encode())
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([json.dumps(own[0][:2])]),
             pa.array([len(own)], pa.int32()), pa.array([data], pa.binary())], ["part", "block", "first", "n", "data"])

    rows = stage(kept.mapInArrow(keyed, "key string, page_id bigint, file string, offset bigint, length bigint"), "keys")
    order = ["key", F.col("page_id").asc_nulls_first(), "file", "offset"]
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    return stage(ordered.mapInArrow(pack, "part int, block int, first string, n int, data binary"), "index")


def _place(key: str, page_id) -> tuple[bytes, int, int]:
    """Order of a line, as Spark sorts it: bytes of the key, a null id first."""
    return key.encode(), page_id is not None, page_id or 0


def look_up(index: DataFrame, wanted: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The captures of the wanted (URL, id): ``page_id``, ``file``, ``offset``, ``length``.

    Repeated captures of a wanted row all come back; a row wanted twice comes back once.
    """
    # one key for each partition of the index, a number of partitions at most
    bounds = sorted((_place(*json.loads(r["first"])), r["part"]) for r in index.where("block = 0").select("part", "first").collect())
    starts, parts = [b for b, _ in bounds], [p for _, p in bounds]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, url in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key = url_key(url)
                at = _place(key, page)
                # equal lines may span partitions: all whose range touches the key
                low = max(0, bisect.bisect_left(starts, at) - 1)
                out += [(parts[i], key, page) for i in range(low, bisect.bisect_right(starts, at))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64()))], ["part", "key", "page_id"])

    def find(wanted: pa.Table, blocks: pa.Table) -> pa.Table:
        rows = sorted(blocks.select(["block", "first", "data"]).to_pylist(), key=lambda r: r["block"])
        directory = [_place(*json.loads(r["first"])) for r in rows]
        out, opened, own = [], None, []
        for key, page in sorted(zip(wanted["key"].to_pylist(), wanted["page_id"].to_pylist()), key=lambda x: _place(*x)):
            at = _place(key, page)
            for b in range(max(0, bisect.bisect_left(directory, at) - 1), bisect.bisect_right(directory, at)):
                if b != opened:  # wanted rows come in order, so a block is unpacked about once
                    own = [json.loads(x) for x in zlib.decompress(rows[b]["data"]).split(b"\n")]
                    places, opened = [_place(x[0], x[1]) for x in own], b
                for i in range(bisect.bisect_left(places, at), bisect.bisect_right(places, at)):
                    out.append((page, *own[i][2:]))
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        return pa.table({c: pa.array([x[i] for x in out], t) for i, (c, t) in enumerate(zip(("page_id", "file", "offset", "length"), types))})

    asked = wanted.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url")).distinct()
    routed = asked.mapInArrow(route, "part int, key string, page_id bigint")
    return routed.groupBy("part").cogroup(index.groupBy("part")).applyInArrow(
        find, "page_id bigint, file string, offset bigint, length bigint")


def read_records(captures: DataFrame) -> DataFrame:
    """Range reads of the captures, in the order of files and offsets: ``page_id``,
    ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``payload``."""
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in slices(batches, 500):
            found = []
            for r in batch.select(["file", "offset", "length"]).to_pylist():
                if r["file"] != name:
                    files, path = _files(r["file"])
                    name, source = r["file"], files.open_input_file(path)
                got = parsed(gzip.decompress(source.read_at(r["length"], r["offset"])))
                if got["payload"] is not None and base64.b32encode(hashlib.sha1(got["payload"]).digest()).decode() != got["payload_digest"]:
                    raise ValueError(f"{name} at {r['offset']}: the payload doesn't have its digest")
                found.append(got)
            types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
                     "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], t) for c, t in types.items()], list(types))

    return captures.repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary")
