"""Token ids in seekable files of independent zstandard frames.

File: data frames, each decodable alone, with zstandard's content checksum; a skippable frame
that holds the document index; a trailing seek table in the public seekable layout (compressed
and decompressed size and 32 bits of xxh64 for every frame). Any zstandard decoder reads the
ids of a whole file; a reader of single documents takes the table and the index from the end
of the file and decompresses the frames that hold what it is asked for.

A frame holds whole documents up to ``FRAME_IDS`` ids; a longer document has frames of its own.
Ids are unsigned little-endian numbers of two bytes, or of four if the vocabulary needs them.

Words between ASCII white space never share a token and their ids do not depend on what stands
around them, so a task encodes each distinct word once and scatters the ids to their places.
Texts are dealt by ranges of ``doc_id``; a task writes one file; the first id of a file is the
sum of the files before, one row a file.
"""

from __future__ import annotations

import bisect
import functools
import io
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hourgrid.llm import words as W
from hourgrid.llm.files import filesystem
from hourgrid.llm.frames import stored, table
from hourgrid.session import scratch_path

FRAME_IDS = 1 << 16
LEVEL = 3
END_ID = 1
MOST_KNOWN = 400_000  # distinct words that a task remembers; beyond, it starts anew
JOINT = 4096  # words encoded in one call
STOPS = ".,;:!?"  # never part of a letter run's token
INDEX_MAGIC, TABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1  # fixed by the format
SHARD = "part int, file string, n_docs long, n_ids long, n_null long, first long, last long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _strings(col: pa.Array) -> list[str]:
    return col.to_numpy(zero_copy_only=False).tolist()


class Vocabulary:
    """A tokenizer file, and the ids of the words met so far."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs a task a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocab.values()) < 1 << 16 else 4
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, at in vocab.items():
            self.ends[at] = bool(suffix) and token.endswith(suffix)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.pieces: dict[str, int] = {"": 0}
        self.body, self.tail = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.at = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_runs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of letter runs, encoded side by side: a token that ends a word ends its run."""
        ids, sizes = [], []
        for at in range(0, len(runs), JOINT):
            part = runs[at : at + JOINT]
            got = np.array(self._encode([" ".join(part)])[0], np.uint32)
            stop = np.flatnonzero(self.ends[got]) + 1
            if len(stop) == len(part) and stop[-1] == len(got):
                size = np.diff(stop, prepend=0)
            else:  # some run is more than one word to this tokenizer
                each = self._encode(part)
                got, size = np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each])
            ids.append(got)
            sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, new: pa.Array) -> None:
        """Words that are a run of letters and stops, or only a run, go as these pieces, lower-case if ASCII; others whole."""
        run = pc.ascii_rtrim(new, STOPS)
        letters = pc.utf8_is_alpha(run)
        run = pc.if_else(pc.and_(letters, pc.string_is_ascii(run)), pc.ascii_lower(run), pc.if_else(letters, run, new))
        data, offs = W.flat(new)
        size = np.diff(offs) - pc.binary_length(run).to_numpy().astype(np.int64)
        rest = np.concatenate([[0], np.cumsum(size)])
        inner = np.repeat(offs[1:] - rest[1:], size) + np.arange(rest[-1])
        tail = pa.Array.from_buffers(new.type, len(new), [None, pa.py_buffer(rest), pa.py_buffer(data[inner])])
        places = []
        for col in run, tail:
            coded = col.dictionary_encode()
            pieces = _strings(coded.dictionary)
            fresh = [x for x in pieces if x not in self.pieces]
            runs, odd = [x for x in fresh if x.isalpha()], [x for x in fresh if not x.isalpha()]
            self.pieces.update(zip(runs + odd, range(len(self.pieces), len(self.pieces) + len(fresh))))
            ids, sizes = self._encode_runs(runs) if runs else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            each = self._encode(odd) if odd else []
            self.flat = np.concatenate([self.flat, ids, np.array([i for x in each for i in x], np.uint32)])
            self.at = np.append(self.at, self.at[-1] + np.cumsum(np.concatenate([sizes, [len(x) for x in each]]).astype(np.int64)))
            places.append(np.array([self.pieces[x] for x in pieces], np.int64)[coded.indices.to_numpy()])
        self.known.update(zip(_strings(new), range(len(self.known), len(self.known) + len(new))))
        self.body, self.tail = np.append(self.body, places[0]), np.append(self.tail, places[1])

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after the other, and the row offsets into them."""
        start, end, rows = W.split_words(data, offs)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        bounds = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
        col = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(data[W.SPACED[data]])])
        coded = col.dictionary_encode()
        distinct = _strings(coded.dictionary)
        if len(self.known) + len(distinct) > MOST_KNOWN:
            self.forget()
        known = self.known
        new = np.flatnonzero([w not in known for w in distinct])
        if len(new):
            self._learn(coded.dictionary.take(pa.array(new)))
        word = np.array([known[w] for w in distinct], np.int64)[coded.indices.to_numpy()]
        piece = np.stack([self.body[word], self.tail[word]], axis=1).ravel()
        size = self.at[piece + 1] - self.at[piece]
        upto = np.concatenate([[0], np.cumsum(size)])
        out = self.flat[np.repeat(self.at[piece] - upto[:-1], size) + np.arange(upto[-1])]
        return out, upto[2 * rows]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker and file."""
    return Vocabulary(path)


def cuts(data: np.ndarray, most: int = W.CHUNK_BYTES) -> list[int]:
    """Ends of pieces of one text of ``most`` bytes each or little more: every cut stands at white space."""
    out, at = [], 0
    while len(data) - at > most:
        gap = at + most
        while gap < len(data):
            found = np.flatnonzero(~W.SPACED[data[gap : gap + most]])
            if len(found):
                gap += int(found[0])
                break
            gap = min(gap + most, len(data))
        if gap >= len(data):
            break
        out.append(gap)
        at = gap
    return out + [len(data)]


def encoded_rows(batch: pa.RecordBatch, vocab: Vocabulary, end_id: int) -> Iterator[np.ndarray]:
    """The ids of each row of ``text``, the end id behind; a few megabytes of text are worked on at a time."""
    for chunk in W.text_chunks(batch, "text"):
        data, offs = W.flat(chunk.column("text"))
        if chunk.num_rows == 1 and len(data) > W.CHUNK_BYTES:
            parts, at = [], 0
            for to in cuts(data):
                parts.append(vocab.encode(data[at:to], np.array([0, to - at]))[0])
                at = to
            yield np.append(np.concatenate(parts), np.uint32(end_id))
            continue
        ids, at = vocab.encode(data, offs)
        for a, b in zip(at[:-1], at[1:]):
            yield np.append(ids[a:b], np.uint32(end_id))


class Writer:
    """One file, written front to back; ``close`` adds index and seek table."""

    def __init__(self, out, width: int, frame_ids: int = FRAME_IDS):
        self.out, self.width, self.frame_ids = out, width, frame_ids
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_null = 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[int] = []
        self.sizes: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """A document; null ids come before all others."""
        if self.n_held and self.n_held + len(ids) > self.frame_ids:
            self._flush()
        for at in range(0, len(ids), self.frame_ids):
            self.held.append(ids[at : at + self.frame_ids])
            self.n_held += len(self.held[-1])
            if self.n_held >= self.frame_ids:
                self._flush()
        self.n_null += doc_id is None
        self.docs.append(0 if doc_id is None else doc_id)
        self.sizes.append(len(ids))
        self.n_ids += len(ids)

    def _flush(self) -> None:
        raw = np.concatenate(self.held).astype(f"<u{self.width}").tobytes()
        data = self.packer.compress(raw)
        self.out.write(data)
        self.frames.append((len(data), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.held, self.n_held = [], 0

    def _skippable(self, magic: int, data: bytes) -> int:
        self.out.write(np.array([magic, len(data)], "<u4").tobytes() + data)
        return 8 + len(data)

    def close(self) -> None:
        if self.held:
            self._flush()
        head = np.array([self.width, len(self.docs), self.n_null], "<u8").tobytes()
        body = head + np.array(self.docs, "<i8").tobytes() + np.array(self.sizes, "<u8").tobytes()
        size = self._skippable(INDEX_MAGIC, self.packer.compress(body))
        self.frames.append((size, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        foot = np.array([len(self.frames)], "<u4").tobytes() + b"\x80" + np.array([SEEKABLE_MAGIC], "<u4").tobytes()
        self._skippable(TABLE_MAGIC, np.array(self.frames, "<u4").tobytes() + foot)


class Reader:
    """Seek table and index of one file; frames are read when they are asked for."""

    def __init__(self, file, size: int):
        self.file = file
        foot = self._at(size - 9, 9)
        n = int.from_bytes(foot[:4], "little")
        if int.from_bytes(foot[5:], "little") != SEEKABLE_MAGIC or foot[4] != 0x80:
            raise ValueError("no seek table at the end of the file")
        self.frames = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        if self.places[-1] + 8 + 12 * n + 9 != size:
            raise ValueError("the seek table does not fit the file")
        packed = self._at(int(self.places[-2]) + 8, int(self.frames[-1, 0]) - 8)
        body = zstandard.ZstdDecompressor().decompress(packed)
        self.width, n_docs, self.n_null = np.frombuffer(body, "<u8", 3).astype(np.int64).tolist()
        self.docs = np.frombuffer(body, "<i8", n_docs, 24)
        self.starts = np.concatenate([[0], np.cumsum(np.frombuffer(body, "<u8", n_docs, 24 + 8 * n_docs).astype(np.int64))])
        self.ids_to = np.cumsum(self.frames[:-1, 1]) // self.width  # ids up to the end of each frame
        self.held: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint32))

    def _at(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(size)
        if len(data) != size:
            raise ValueError("the file is cut")
        return data

    def frame(self, i: int) -> np.ndarray:
        """The ids of frame ``i``; both checksums are verified."""
        if self.held[0] != i:
            size, raw_size, check = self.frames[i].tolist()
            raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.places[i]), size), max_output_size=raw_size)
            if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {i} does not have its checksum")
            self.held = i, np.frombuffer(raw, f"<u{self.width}").astype(np.uint32)
        return self.held[1]

    def parts(self, row: int) -> Iterator[np.ndarray]:
        """The ids of the document in ``row``, frame by frame."""
        at, to = int(self.starts[row]), int(self.starts[row + 1])
        i = int(np.searchsorted(self.ids_to, at, "right"))
        while at < to:
            begin = int(self.ids_to[i - 1]) if i else 0
            got = self.frame(i)[at - begin : to - begin]
            yield got
            at += len(got)
            i += 1

    def doc_id(self, row: int) -> int | None:
        return None if row < self.n_null else int(self.docs[row])

    def rows_of(self, doc_id: int) -> range:
        """Rows of a document id, by binary search."""
        docs = self.docs[self.n_null :]
        return range(self.n_null + int(np.searchsorted(docs, doc_id, "left")), self.n_null + int(np.searchsorted(docs, doc_id, "right")))


def opened(uri: str) -> Reader:
    fs, path = filesystem(uri)
    file = fs.open_input_file(path)
    return Reader(file, file.size())


def _write(folder: str, vocabulary_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        vocab = vocabulary(vocabulary_path)
        file = f"{folder}/ids-{task.partitionId():06d}-{task.taskAttemptId()}.zst"
        out = writer = None
        for batch in batches:
            if out is None and batch.num_rows:
                fs, path = filesystem(file)
                fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                out = fs.open_output_stream(path, compression=None)
                writer = Writer(out, vocab.width)
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoded_rows(batch, vocab, end_id)):
                writer.add(doc_id, ids)
        if writer is not None:
            writer.close()
            out.close()
            real = writer.docs[writer.n_null :]
            row = [task.partitionId(), file, len(writer.docs), writer.n_ids, writer.n_null, real[0] if real else None, real[-1] if real else None]
            types = [pa.int32(), pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=[x.split()[0] for x in SHARD.split(", ")])

    return run


def write_ids(docs: DataFrame, folder: str, vocabulary_path: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids of ``docs (doc_id, text)`` in ascending ``doc_id``; a row per file, in order of ``part``.

    ``start`` of a file is the number of ids in the files before it. A null text is empty and
    has only its end id; a null ``doc_id`` comes first; rows that share an id are ordered by a
    hash of their texts, so a repeated id is dealt over several files; equal rows are all
    written. Other columns are ignored. Special tokens in a text are read as the tokenizer
    reads them by default. Files of lost or repeated attempts are never referred to.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    written = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_write(folder, vocabulary_path, end_id), SHARD), "shards")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _documents(reader: Reader, rows: Iterator[int], base: int) -> pa.RecordBatch:
    out = []
    for row in rows:
        crc = 0
        for part in reader.parts(row):
            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
        out.append((reader.doc_id(row), base + int(reader.starts[row]), int(reader.starts[row + 1] - reader.starts[row]), crc))
    cols = list(zip(*out)) if out else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=[x.split()[0] for x in DOCUMENT.split(", ")])


def read_digests(shards: DataFrame) -> DataFrame:
    """Place, length and crc32 of every document, read back from the files frame by frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                reader = opened(file)
                with reader.file:
                    for at in range(0, len(reader.docs), 4096):
                        yield _documents(reader, range(at, min(at + 4096, len(reader.docs))), base)

    return shards.select("file", "start").repartition(max(1, shards.count()), "file").mapInArrow(run, DOCUMENT)


def read_documents(shards: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, ids`` of the documents of ``wanted (doc_id)`` that exist.

    The file of an id is found by binary search among the files' bounds (a row per file), its
    row by binary search in the file's index; only the frames that hold it are decompressed.
    A null id finds nothing; an id that several rows have gives all of them.
    """
    files = sorted((r.first, r.last, r.file) for r in shards.filter("first IS NOT NULL").select("first", "last", "file").collect())
    lasts = [last for _, last, _ in files]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, Reader] | None = None
        for batch in batches:
            for doc_id in batch.column("doc_id").to_pylist():
                at = bisect.bisect_left(lasts, doc_id)
                while at < len(files) and files[at][0] <= doc_id:
                    if held is None or held[0] != files[at][2]:
                        held = files[at][2], opened(files[at][2])
                    for row in held[1].rows_of(doc_id):
                        ids = np.concatenate(list(held[1].parts(row)))
                        yield pa.RecordBatch.from_arrays([pa.array([doc_id]), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], names=["doc_id", "ids"])
                    at += 1

    asked = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    return asked.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(run, "doc_id long, ids array<long>")


def decoded_file(data: bytes) -> bytes:
    """All ids of a file by a plain zstandard decoder, which passes over index and table."""
    return zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    shards = write_ids(table(spark, sf_dir, "documents"), scratch_path(spark, "token-ids"), public_tokenizers.path("word_bpe_49k.json"))
    return read_digests(shards)
