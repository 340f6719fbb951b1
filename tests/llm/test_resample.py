import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hourgrid.llm import resample as R
from hourgrid.llm.frames import ready

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def runs(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % R.BUCKETS


def brute(docs, target):
    """(doc_id, text) rows and texts to {doc_id: (n_features, weight, score, rank)}, for ids that differ."""
    found = [(i, *runs(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in found:
        s.update(map(bucket, f))
    for text in target:
        t.update(map(bucket, runs(text)[1]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + R.BUCKETS) / ((s[b] + 1) * (t_all + R.BUCKETS))))
    out = []
    for i, n, f in found:
        weight = sum(gain(bucket(x)) for x in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = {r[0]: at + 1 for at, r in enumerate(able[: len(able) * 5 // 100])}
    return {r[0]: (*r[2:], rank.get(r[0])) for r in out}


@pytest.mark.parametrize("size", [0, 1, 5, 63, 64, 65, 130, 4096, 70_001])
def test_composed_crc(size):
    rng = np.random.default_rng(size)
    a, b = rng.bytes(20), rng.bytes(size)
    got = R.composed(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([size]))
    assert got[0] == zlib.crc32(a + b)


def texts():
    rng = random.Random(11)
    bits = ["the", "The", "THE", "é", "É", "a", "x" * 90, "数据", "12", "naïve", "rare%d" % rng.randrange(99)]
    gaps = [" ", "  ", ", ", "\n", "-", "\x00", "'"]
    return [None, "", "...", "one", " one two"] + ["".join(rng.choice(bits) + str(rng.randrange(30)) * rng.randrange(2) + rng.choice(gaps)
                                                           for _ in range(rng.randrange(60))) for _ in range(200)]


@pytest.mark.parametrize("most", [0, 3, R.MOST_WORDS])
def test_payloads_do_not_depend_on_the_automaton(most, monkeypatch):
    monkeypatch.setattr(R.W, "CHUNK_BYTES", 2000)
    rows = texts() + ["long long text " * 500 + "end"]
    scanner = R.Scanner(most)
    got = []
    for chunk in R.W.text_chunks(pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"]), "text", 2000):
        crcs, of, _ = scanner.features(chunk)
        got += [sorted(int(c) for crc, row in zip(crcs, of) for c in crc[row == i]) for i in range(chunk.num_rows)]
    assert got == [sorted(zlib.crc32(f.encode()) for f in runs(t)[1]) for t in rows]
    assert len(scanner.words) <= most and (most == 0 or len(scanner.words) > 0)


def test_edge_rows(spark):
    docs = list(enumerate(texts() * 2)) + [(None, "no id " * 15), (10**6, "the long text goes on " * 60_000)]
    target = ["the naïve 12", None, "", "long text"]
    df = ready(spark).createDataFrame([(*r, 5, True) for r in docs], "doc_id long, text string, weight int, rank boolean")
    to = spark.createDataFrame([(t,) for t in target], "text string")
    rows = R.resample(df, to).collect()
    assert {r.doc_id: (r.n_features, r.weight, r.score, r.rank) for r in rows} == brute(docs, target)
    assert R.resample(df.limit(0), to.limit(0)).count() == 0
    copies = R.resample(df.filter("doc_id IS NULL").crossJoin(spark.range(100)), to).collect()  # rows that tie in all
    assert sorted(r["rank"] for r in copies if r["rank"]) == [1, 2, 3, 4, 5]


def test_query(spark, small_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in R.op13_importance_resample(ready(spark), small_dir).collect()}
    assert got == brute(docs, target)
