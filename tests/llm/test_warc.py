import gzip
import hashlib

from hourgrid.llm import warc
from hourgrid.llm.files import filesystem
from hourgrid.llm.frames import ready
from hourgrid.session import scratch_path


def brute(rows):
    """Sorted (page_id, bytes, digest, type, refers_to)."""
    big = 1 << 63
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100:
            first[data] = min(first.get(data, big), big if page is None else page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        to = first.get(data, big)
        revisit = to != big and to != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def rows():
    big = "é" * 70
    out = [(1, "http://www.Example.com/a?b=1#c", big), (2, "https://x.example.com:8080", big), (3, None, None), (4, "http://[bad", ""),
           (5, "no url\nat\tall", "x" * 99), (6, "http://example.com/", "x" * 99), (7, "http://example.com/", "\r\n\r\n" * 60),
           (None, "http://example.com/", big), (None, "u", "only without ids " * 9), (None, "v", "only without ids " * 9), (1, "again", big)]
    return out + [(i, f"http://h{i % 7}.example.org/p/{i}", f"<p>{i % 40}</p>" * 30) for i in range(10, 200)]


def test_round_trip_and_lookup(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 16)
    data = rows()
    ready(spark)
    pages = spark.createDataFrame([(*r, 1) for r in data], "page_id long, url string, html string, digest int")
    folder = scratch_path(spark, "warc-test")
    captures = warc.write_archives(pages, folder)
    directory = warc.build_index(captures, f"{folder}-index")
    assert directory.count() >= len(data) / 16
    got = warc.read_archives(directory).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(data)
    keys = ["com,example)/", "org,example,h3)/p/24", "none)/", "com,example,x:8080)/", None]
    found = warc.lookup(spark, directory, spark.createDataFrame([(k, k) for k in keys], "key string, page_id string")).collect()
    want = {(k, p) for p, u, _ in data for k in keys if k == warc.url_key(u)}
    assert {(r.key, r.page_id) for r in found} == want and len(found) == 5
    # the archives are plain WARC: whole files decompress to records that follow each other
    file = captures.select("file").first().file
    fs, path = filesystem(file)
    text = gzip.decompress(fs.open_input_file(path).read())
    assert text.startswith(b"WARC/1.1\r\n") and text.count(b"WARC/1.1\r\n") == captures.filter(captures.file == file).count()
    empty = warc.write_archives(pages.limit(0), folder)
    assert warc.read_archives(warc.build_index(empty, f"{folder}-index2")).count() == 0


def test_query(spark, small_dir):
    got = warc.op1_warc_archive(ready(spark), small_dir).collect()
    data = [tuple(r) for r in spark.read.parquet(f"{small_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, got), key=str) == brute(data)


def test_all_keys_find_all_records(spark):
    """The query's path: a key of most captures, many blocks, a folder without a scheme, a very long payload."""
    ready(spark)
    data = rows() + [(1000 + i, "http://hot.example.org/", f"payload {i % 5} " * 20) for i in range(3 * warc.BLOCK_LINES)]
    data += [(9999, "http://long.example.org/", "very long " * 300_000)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test").removeprefix("file:")
    directory = warc.build_index(warc.write_archives(pages, folder), f"{folder}-index")
    assert directory.count() > 3
    got = warc.lookup(spark, directory, warc.page_keys(pages)).drop("key", "url").collect()
    assert sorted(map(tuple, got), key=str) == brute(data)
    assert warc.lookup(spark, directory, warc.page_keys(pages.limit(0))).count() == 0


def test_only_the_blocks_of_a_key_are_read(spark, monkeypatch):
    rows = [(f"k{i:03d}", "f", i, 1) for i in range(40)]
    import pyarrow as pa
    import pyarrow.parquet as pq

    entries = {"first": ["k000", "k010", "k020", "k030"], "last": ["k009", "k019", "k029", "k039"], "file": ["b"] * 4, "at": [0, 1, 2, 3], "size": [1] * 4}
    path = scratch_path(spark, "dir").removeprefix("file:")
    fs, at = filesystem(path)
    fs.create_dir(at, recursive=True)
    pq.write_table(pa.table(entries), f"{at}/d.parquet")
    sent = warc._sent_to([("k000", "k039", f"{path}/d.parquet")])
    keys = pa.RecordBatch.from_arrays([pa.array(["a", "k005", "k025", "k0255", "z"])], names=["key"])
    out = [b.to_pydict() for b in sent([keys])]
    assert [(k, a) for o in out for k, a in zip(o["key"], o["at"])] == [("k005", 0), ("k025", 2), ("k0255", 2)]
    reads = []
    monkeypatch.setattr(warc, "read_bytes", lambda file, at, size: reads.append(at) or warc._member("\n".join("\t".join(map(str, r)) for r in rows[at * 10 : at * 10 + 10]).encode()))
    found = [b.to_pydict()["key"] for b in warc._searched([pa.RecordBatch.from_pydict(o) for o in out])]
    assert found == [["k005", "k025"]] and reads == [0, 2]
