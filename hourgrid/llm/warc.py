"""WARC archives with a two-level capture index.

Writing: payload digests are grouped (summed map-side) to find the smallest page of each
payload; the pages then go, joined by digest, to tasks that write one compressed archive each,
one gzip member a record. The rows they return (key, file, offset, length) are stored at once,
so files of lost or repeated attempts are never referred to.

Index: captures are range-partitioned and sorted by the reversed-host key of their URL and
written as compressed blocks of ``BLOCK_LINES`` lines. The first key of every block, with its
file, offset and length, is the sparse directory: one row a block.

Lookup: the blocks that can hold a key are found by binary search in the directory; a block is
then read by range, once, and binary-searched for all keys that were sent to it; the records
found are read in the order of their files, neighbours in one range. A key of very many
captures is a row a block, so its blocks are searched by many tasks.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark import TaskContext

from hourgrid.llm.files import filesystem, read_bytes
from hourgrid.llm.frames import stored, table
from hourgrid.session import scratch_path

LEAST_SHARED = 100  # bytes; smaller payloads are always written
BLOCK_LINES = 2048
RANGE_BYTES = 8 << 20
MEMBER = zlib.MAX_WBITS | 16
DATE = "2024-01-01T00:00:00Z"
CAPTURE = "page_id long, key string, file string, at long, size long, record_type string"
DIRECTORY = "first string, last string, file string, at long, size long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def url_key(url: str | None) -> str:
    """The host reversed by its labels, then port, path and query: ``com,example)/path?q``."""
    try:
        parts = urlsplit(url or "")
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return f"){url}"
    port = f":{port}" if port and port not in (80, 443) else ""
    query = f"?{parts.query}" if parts.query else ""
    key = f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}".lower()
    return key.replace("\n", "%0a").replace("\r", "%0d").replace("\t", "%09")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    number = record[len("<urn:page:") : -1]
    return int(number) if number else None


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, MEMBER)
    return packer.compress(data) + packer.flush()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record; a revisit has the HTTP header, with the payload's length, and no payload."""
    url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """A record's headers (lower-case names), the length its HTTP header gives, and the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict((k.lower(), v) for k, _, v in (x.partition(": ") for x in lines[1:]))
    block = rest[: int(fields["content-length"])]
    if len(rest) != len(block) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError(f"record {fields['warc-record-id']} is cut")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"fields": fields, "length": length, "payload": payload}


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        file = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        fs, path = filesystem(file)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        out, at = None, 0
        try:
            for batch in batches:
                rows = []
                for page, url, html, digest, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "first"))):
                    if out is None:
                        out = fs.open_output_stream(path, compression=None)
                    payload = (html or "").encode()
                    revisit = first is not None and first != page
                    data = _member(record(page, url, payload, digest, first, revisit))
                    out.write(data)
                    rows.append((page, url_key(url), file, at, len(data), "revisit" if revisit else "response"))
                    at += len(data)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                        names=["page_id", "key", "file", "at", "size", "record_type"])
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages (page_id, url, html)``; the stored captures.

    A null html is an empty payload, a null url an empty one. Rows that tie for the smallest
    page id of a payload are all responses; a null page id counts as the largest.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = rows.withColumn("digest", F.sha2(payload, 256))
    shared = rows.filter(F.octet_length("html") >= LEAST_SHARED)
    first = shared.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return stored(rows.join(first, "digest", "left").mapInArrow(_writer(folder), CAPTURE), "captures")


def _blocks(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        file = f"{folder}/index-{task.partitionId():06d}-{task.taskAttemptId()}.z"
        fs, path = filesystem(file)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        out, at, held = None, 0, []

        def flush() -> pa.RecordBatch:
            nonlocal out, at
            if out is None:
                out = fs.open_output_stream(path, compression=None)
            data = _member("\n".join("\t".join(map(str, x)) for x in held).encode())
            out.write(data)
            row = [held[0][0], held[-1][0], file, at, len(data)]
            at += len(data)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["first", "last", "file", "at", "size"])

        try:
            for batch in batches:
                for line in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "at", "size"))):
                    held.append(line)
                    if len(held) == BLOCK_LINES:
                        yield flush()
            if held:
                yield flush()
        finally:
            if out is not None:
                out.close()

    return run


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the sorted index blocks; their directory, a row a block, stored in key order."""
    ordered = captures.select("key", "file", "at", "size").repartitionByRange("key", "file", "at").sortWithinPartitions("key", "file", "at")
    return stored(ordered.mapInArrow(_blocks(folder), DIRECTORY), "directory")


def block_lines(data: bytes) -> list[tuple[str, str, int, int]]:
    """Key, file, offset and length of the captures of a block."""
    lines = (x.split("\t") for x in zlib.decompress(data, MEMBER).decode().split("\n"))
    return [(key, file, int(at), int(size)) for key, file, at, size in lines]


def _read_record(data: bytes) -> tuple:
    got = parsed(zlib.decompress(data, MEMBER))
    fields, payload = got["fields"], got["payload"]
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != got["length"]):
        raise ValueError(f"record {fields['warc-record-id']} does not have its digest")
    refers = page_of(fields["warc-refers-to"]) if kind == "revisit" else None
    return page_of(fields["warc-record-id"]), got["length"], digest, kind, refers, fields["warc-target-uri"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=[x.split()[0] for x in RECORD.split(", ")])


def _records_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of captures that come sorted by file and offset, read in ranges of RANGE_BYTES at most."""

    def read(held: list[tuple]) -> pa.RecordBatch:
        file, begin = held[0][0], held[0][1]
        data = read_bytes(file, begin, held[-1][1] + held[-1][2] - begin)
        found = _rows([_read_record(data[at - begin : at - begin + size]) for _, at, size, _ in held])
        return pa.RecordBatch.from_arrays([pa.array([x[3] for x in held], pa.string()), *found.columns], names=["key", *found.schema.names])

    held: list[tuple] = []
    for batch in batches:
        for file, at, size, key in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size", "key"))):
            if held and (held[-1][0] != file or held[-1][1] + held[-1][2] != at or at + size - held[0][1] > RANGE_BYTES):
                yield read(held)
                held = []
            held.append((file, at, size, key))
    if held:
        yield read(held)


def read_archives(directory: DataFrame) -> DataFrame:
    """Every record of the archives, block by block of the index, without a search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size"))):
                yield _captures(block_lines(read_bytes(*entry)))

    captures = directory.repartition("first", "at").mapInArrow(run, "key string, file string, at long, size long")
    return captures.repartitionByRange("file", "at").sortWithinPartitions("file", "at").mapInArrow(_records_of, f"key string, {RECORD}").drop("key")


def page_keys(pages: DataFrame) -> DataFrame:
    """The distinct index keys of ``pages (url)``; a null url has the key of an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())], names=["key"])

    return pages.select(F.col("url").cast("string").alias("url")).mapInArrow(run, "key string").distinct()


def _sent_to(files: list[tuple[str, str, str]]):
    """Keys and the blocks that can hold them; ``files`` are the bounds and path of every directory file, in key order."""
    lasts = [last for _, last, _ in files]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            rows = []
            for key in batch.column("key").to_pylist():
                at = bisect.bisect_left(lasts, key)
                while at < len(files) and files[at][0] <= key:
                    if held is None or held[0] != at:
                        fs, path = filesystem(files[at][2])
                        entries = pq.read_table(path, filesystem=fs).sort_by([("first", "ascending"), ("at", "ascending")]).to_pydict()
                        held = at, entries["first"], entries["last"], list(zip(entries["file"], entries["at"], entries["size"]))
                    block = bisect.bisect_left(held[2], key)
                    while block < len(held[1]) and held[1][block] <= key:
                        rows.append((key, *held[3][block]))
                        block += 1
                    at += 1
            if rows:
                yield _captures(rows)

    return run


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names=["key", "file", "at", "size"])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The captures of the keys sent to each block; rows come sorted by block, which is read once."""
    block, lines, names = None, [], []
    for batch in batches:
        rows = []
        for key, *entry in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "at", "size"))):
            if entry != block:
                block, lines = entry, block_lines(read_bytes(*entry))
                names = [x[0] for x in lines]
            rows += lines[bisect.bisect_left(names, key) : bisect.bisect_right(names, key)]
        if rows:
            yield _captures(rows)


def lookup(spark: SparkSession, directory: DataFrame, keys: DataFrame) -> DataFrame:
    """``key`` and record of all captures of ``keys (key)``; repeated keys count once, a null key finds nothing.

    The directory is range-partitioned and sorted, so its files are in key order. Keys are
    dealt by ranges too: a task goes through its keys in order with one directory file at a
    time. The driver sees the bounds of the directory's files, a row each.
    """
    files = sorted((r.first, r.last, r.path) for r in directory.groupBy(F.input_file_name().alias("path")).agg(
        F.min("first").alias("first"), F.max("last").alias("last")).collect())
    wanted = keys.select(F.col("key").cast("string").alias("key")).filter("key IS NOT NULL").distinct()
    capture = "key string, file string, at long, size long"
    sent = wanted.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_sent_to(files), capture)
    found = stored(sent.repartition("file", "at").sortWithinPartitions("file", "at", "key").mapInArrow(_searched, capture), "found")
    ordered = found.repartitionByRange("file", "at").sortWithinPartitions("file", "at")
    return ordered.mapInArrow(_records_of, f"key string, {RECORD}")


def op1_warc_archive(spark, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    directory = build_index(write_archives(pages, folder), f"{folder}-index")
    return lookup(spark, directory, page_keys(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
