import glob
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hourgrid.llm import tokenfile as T
from hourgrid.llm.frames import ready
from hourgrid.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def brute(rows):
    """(doc_id, text) rows to doc_id: (start, n_tokens, crc), for ids that differ."""
    out, at = {}, 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(PLAIN.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out[doc] = at, len(ids), zlib.crc32(ids.tobytes())
        at += len(ids)
    return out


def texts():
    rng = random.Random(5)
    bits = ["it's", "IT'S", "word", "Word,", "ÉLAN", "élan.", "é", "́x", "İstanbul", "a b", "<|endoftext|>", "x<|startoftext|>y",
            "<|EndOfText|>", "<|", "１２", "12", "…", "—", "数据", "नमस्ते", "한국어", "가", "ß", "Σας", "\x00", "\x1c", "\u0085", "a.b", "...", "we'll'", "'s"]
    seps = [" ", "\n", "\t", "\r\n", "  ", "\x0b"]
    return ["".join(rng.choice(bits) + rng.choice(seps) for _ in range(rng.randrange(0, 40))) for _ in range(400)]


def test_ids_are_those_of_the_whole_text():
    rows = texts()
    vocab = T.Vocabulary(PATH)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"])
    for _ in range(2):  # the second time, every word is known
        got = [x.tolist() for x in T.encoded_rows(batch, vocab, 1)]
        assert got == [PLAIN.encode(x, add_special_tokens=False).ids + [1] for x in rows]


def test_words_are_forgotten_without_loss(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(T, "MOST_KNOWN", 10)
    monkeypatch.setattr(T.W, "CHUNK_BYTES", 64)
    rows = texts()[:60] + ["one very long text " * 20 + "x" * 300 + " end"]
    got = [x.tolist() for x in T.encoded_rows(pa.RecordBatch.from_arrays([pa.array(rows)], names=["text"]), T.Vocabulary(PATH), 1)]
    assert got == [PLAIN.encode(x, add_special_tokens=False).ids + [1] for x in rows]


def test_cuts_stand_at_white_space():
    data = np.frombuffer(b"aaaa bb cccccccccc d" * 30 + b"z" * 100, np.uint8)
    ends = T.cuts(data, 16)
    assert ends[-1] == len(data)
    assert all(data[e] == 0x20 for e in ends[:-1])


def test_edge_rows(spark):
    rows = [(7, "seven words stand in this short text"), (3, None), (-5, ""), (None, "no id"), (2, "Zwei."), (9, "long text, again. " * 30_000)]
    df = ready(spark).createDataFrame([(d, t, 1, "f") for d, t in rows], "doc_id long, text string, start long, file string")
    shards = T.write_ids(df, scratch_path(spark, "ids"), PATH)
    assert {r.doc_id: tuple(r)[1:] for r in T.read_digests(shards).collect()} == brute(rows)
    empty = T.write_ids(df.limit(0), scratch_path(spark, "ids"), PATH)
    assert T.read_digests(empty).count() == 0 and T.read_documents(empty, df).count() == 0
    twice = df.filter("doc_id = 2").union(df.filter("doc_id IS NULL")).unionAll(df.filter("doc_id = 2 OR doc_id IS NULL"))
    got = sorted(T.read_digests(T.write_ids(twice, scratch_path(spark, "ids"), PATH)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 2, 2]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()


def test_only_requested_frames_are_read(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    folder = scratch_path(ready(spark), "ids")
    shards = T.write_ids(docs, folder, PATH)
    wanted = spark.createDataFrame([(5,), (150,), (10**9,), (None,), (5,)], "doc_id long")
    texts = {r.doc_id: r.text for r in docs.filter("doc_id IN (5, 150)").collect()}
    got = {r.doc_id: r.ids for r in T.read_documents(shards, wanted).collect()}
    assert got == {d: PLAIN.encode(t, add_special_tokens=False).ids + [1] for d, t in texts.items()}
    buffer = io.BytesIO()
    writer = T.Writer(buffer, 2, frame_ids=100)
    parts = [np.arange(n, dtype=np.uint32) % 49408 for n in (30, 60, 20, 350, 1, 99, 2)]
    for i, ids in enumerate(parts):
        writer.add(i, ids)
    writer.close()
    reads = []

    class Watched(io.BytesIO):
        def read(self, size=-1):
            reads.append((self.tell(), size))
            return super().read(size)

    reader = T.Reader(Watched(buffer.getvalue()), len(buffer.getvalue()))
    reads.clear()
    assert np.concatenate(list(reader.parts(3))).tolist() == parts[3].tolist()
    assert [at for at, _ in reads] == reader.places[2:6].tolist()  # its four frames and no other
    assert np.frombuffer(T.decoded_file(buffer.getvalue()), "<u2").tolist() == np.concatenate(parts).tolist()
    for file in glob.glob(f"{folder}/*.zst"):
        T.opened(file)


def test_damage_is_found():
    buffer = io.BytesIO()
    writer = T.Writer(buffer, 2)
    writer.add(1, np.arange(1000, dtype=np.uint32))
    writer.close()
    good = buffer.getvalue()
    T.Reader(io.BytesIO(good), len(good)).frame(0)
    bad = bytearray(good)
    bad[-9 - 24 + 8] ^= 1  # the first frame's checksum in the seek table
    with pytest.raises(ValueError, match="checksum"):
        T.Reader(io.BytesIO(bytes(bad)), len(bad)).frame(0)
    with pytest.raises(ValueError):
        T.Reader(io.BytesIO(good[:-1]), len(good) - 1)


def test_query(spark, small_dir):
    got = {r.doc_id: tuple(r)[1:] for r in T.op11_token_ids(ready(spark), small_dir).collect()}
    rows = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    assert got == brute([tuple(r) for r in rows])
