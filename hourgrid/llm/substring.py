"""Removal of repeated word windows, with a count-min prefilter.

1. Every task counts the windows of its documents in a count-min sketch: ``DEPTH`` rows of
   cells, each window in one cell a row. A cell saturates at two, which is all that matters, so
   a task's sketch is two bitmaps; it is sent as sorted cell numbers, about nine bits each, and
   grows with the task's windows only. Merged by ranges of cells, the sketches overestimate
   every count: cells with two or more are written to the shared folder as one bitmap.
2. The second pass looks every window up. Windows whose estimate is one are unique for
   certain. The rest, the truly repeated and a few others, are grouped exactly by a 96-bit
   hash of their words. A task first groups its own, so a window is sent once per task
   however often it occurs; all but the smallest (document, start) are repeats.
3. The repeats of a document are joined to its text, which loses the words they cover.

The sketch has ``CELLS_PER_WINDOW`` cells a window, up to ``MOST_CELLS``. Beyond that bound of
memory the estimates only get looser and more windows are grouped; none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hourgrid.llm import words as W
from hourgrid.llm.files import read_bytes, write_bytes
from hourgrid.llm.frames import row_key, table
from hourgrid.llm.packing import gaps, narrow, packed, ungapped, unpacked, widened
from hourgrid.session import scratch_path

WINDOW = 20
DEPTH = 2
CELLS_PER_WINDOW = 3
MOST_CELLS = 1 << 30
RANGE = 1 << 22  # cells of one row whose counts are merged by one task
BYTES_PER_WINDOW = 6  # of text, to size sketch and buckets
BUCKET_WINDOWS = 4 << 20
BIG = np.iinfo(np.int64).max
ROWS_DDL = "bucket int, chunk long, a binary, b binary, ids binary, place binary, start binary, texts binary"
ROWS = [x.split()[0] for x in ROWS_DDL.split(", ")]
MARKS_DDL = "chunk long, place binary, start binary, texts binary"


def cells(h: np.ndarray, depth: int, width: int) -> np.ndarray:
    """The cell of each window in row ``depth`` of a sketch of ``width`` (a power of two)."""
    x = h if depth == 0 else W.pair(h, np.full(len(h), W.SEEDS[1]))
    return (x >> np.uint64(64 - int(width).bit_length() + 1)).astype(np.int64)


def _window_hashes(chunk: pa.RecordBatch, window: int, lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and start of the windows of a chunk, and the word offsets of its rows."""
    data, offs = W.flat(chunk.column("text"))
    start, end, wo = W.split_words(data, offs)
    at = W.inside(wo, window)
    return W.windows(W.hash_words(data, start, end, lane), window)[at], at, wo


def _sketch(window: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            h = np.concatenate(held)
            for depth in range(DEPTH):
                c = np.sort(cells(h, depth, width))
                new = np.concatenate([[True], c[1:] != c[:-1]])
                again = c[1:][c[1:] == c[:-1]]
                once = c[new]
                twice = again[np.concatenate([[True], again[1:] != again[:-1]])] if len(again) else again
                for part in np.unique(once // RANGE):
                    one = once[slice(*np.searchsorted(once, [part * RANGE, (part + 1) * RANGE]))] - part * RANGE
                    two = twice[slice(*np.searchsorted(twice, [part * RANGE, (part + 1) * RANGE]))] - part * RANGE
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([depth]), pa.array([part]), pa.array([packed(one, RANGE)], pa.binary()), pa.array([packed(two, RANGE)], pa.binary())],
                        names=["depth", "part", "once", "twice"])

        held, size = [], 0
        for batch in batches:
            for chunk in W.text_chunks(batch, "text"):
                held.append(_window_hashes(chunk, window, 0)[0])
                size += len(held[-1])
                if size > 4_000_000:
                    yield from flush(held)
                    held, size = [], 0
        if size:
            yield from flush(held)

    return run


def _merge(path: str):
    """Bitmaps of the cells counted twice or more, one file per range of cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen, twice = None, None, None

        def close() -> Iterator[pa.RecordBatch]:
            if at is not None:
                write_bytes(f"{path}/{at[0]}-{at[1]}.bits", np.packbits(twice).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at[0]]), pa.array([at[1]]), pa.array([int(twice.sum())])], names=["depth", "part", "cells"])

        for batch in batches:
            for depth, part, once, again in zip(*(batch.column(c).to_pylist() for c in ("depth", "part", "once", "twice"))):
                if at != (depth, part):
                    yield from close()
                    at, seen, twice = (depth, part), np.zeros(RANGE, bool), np.zeros(RANGE, bool)
                one = unpacked(once)
                twice[one[seen[one]]] = True
                seen[one] = True
                twice[unpacked(again)] = True
        yield from close()

    return run


def _repeated_cells(path: str, parts: list[tuple[int, int]], width: int) -> list[np.ndarray]:
    out = [np.zeros((width + 7) // 8, np.uint8) for _ in range(DEPTH)]
    for depth, part in parts:
        bits = np.frombuffer(read_bytes(f"{path}/{depth}-{part}.bits"), np.uint8)
        room = out[depth][part * RANGE // 8 : part * RANGE // 8 + len(bits)]
        room[:] = bits[: len(room)]
    return out


def _later(a: np.ndarray, b: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Of windows sorted by hash, document and start: those that also start earlier."""
    head = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    return (doc != doc[first]) | (start != start[first])


def _candidates(window: int, width: int, path: str, parts: list[tuple[int, int]], buckets: int):
    """Windows estimated repeated, packed by bucket.

    A chunk is what a task looks at together; its windows name their text by its place there.
    Of equal windows of a chunk only the first is sent to its bucket, the others are marked at
    once, in the row that also has the chunk's texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, made = None, 0

        def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            chunk = TaskContext.get().partitionId() << 32 | made
            made += 1
            a, b, doc, row, start = (np.concatenate(x) for x in zip(*held))
            texts, place = np.unique(np.stack([doc, row], 1), axis=0, return_inverse=True)
            # as in _group: texts that share an id are told apart by start, not by their hash
            order = np.lexsort((start, doc, b, a))
            a, b, doc, place, start = a[order], b[order], doc[order], place.ravel()[order], start[order]
            later = _later(a, b, doc, start)
            yield pa.RecordBatch.from_arrays(
                [pa.array([made % buckets], pa.int32()), pa.array([chunk]), *(pa.nulls(1, pa.binary()) for _ in range(3)),
                 *(pa.array([x], pa.binary()) for x in (narrow(place[later]), narrow(start[later]), texts.astype("<i8").tobytes()))], names=ROWS)
            stay = np.flatnonzero(~later)  # the first, and rows that tie with it
            bucket = ((a[stay] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(cut)):
                at = stay[cut[k] : cut[k + 1]]
                here, short = np.unique(place[at], return_inverse=True)
                ids = np.concatenate([here, texts[here, 0]]).astype("<i8").tobytes()
                cols = [gaps(a[at]), b[at].astype("<u4").tobytes(), ids, narrow(short), narrow(start[at])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(k)], pa.int32()), pa.array([chunk]), *(pa.array([c], pa.binary()) for c in cols), pa.nulls(1, pa.binary())], names=ROWS)

        held, size = [], 0
        for batch in batches:
            for chunk in W.text_chunks(batch, "text"):
                if bits is None:
                    bits = _repeated_cells(path, parts, width)
                h, at, wo = _window_hashes(chunk, window, 0)
                may = np.ones(len(h), bool)
                for depth in range(DEPTH):
                    c = cells(h, depth, width)
                    may &= (bits[depth][c >> 3] >> (7 - (c & 7)).astype(np.uint8) & 1).astype(bool)
                if not may.any():
                    continue
                second = _window_hashes(chunk, window, 1)[0][may] & np.uint64(0xFFFFFFFF)
                at, h = at[may], h[may]
                rows = np.searchsorted(wo, at, "right") - 1
                ids = chunk.column("doc_id").to_numpy(zero_copy_only=False)
                held.append((h, second, ids[rows], chunk.column("row").to_numpy(zero_copy_only=False)[rows], at - wo[rows]))
                size += len(h)
                if size > 1_000_000:
                    yield from flush(held)
                    held, size = [], 0
        if size:
            yield from flush(held)

    return run


def _group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact groups: of the windows of a bucket, those that are not the smallest (document, start), by chunk."""
    at, held = None, []

    def close() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        a, b, doc, start, place, chunk = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((start, doc, b, a))
        later = order[_later(a[order], b[order], doc[order], start[order])]
        place, start, chunk = place[later], start[later], chunk[later]
        order = np.argsort(chunk, kind="stable")
        place, start, chunk = place[order], start[order], chunk[order]
        names, first = np.unique(chunk, return_index=True)
        cut = np.append(first, len(chunk)).tolist()
        if len(names):
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([narrow(place[i:j]) for i, j in zip(cut, cut[1:])], pa.binary()),
                 pa.array([narrow(start[i:j]) for i, j in zip(cut, cut[1:])], pa.binary()), pa.nulls(len(names), pa.binary())],
                names=["chunk", "place", "start", "texts"])

    for batch in batches:
        named = batch.filter(batch.column("texts").is_valid())
        if named.num_rows:
            yield named.select(["chunk", "place", "start", "texts"])
        for bucket, chunk, a, b, ids, place, start in zip(*(batch.column(c).to_pylist() for c in ROWS[:7])):
            if a is None:
                continue
            if bucket != at:
                yield from close()
                at, held = bucket, []
            here = np.frombuffer(ids, "<i8").reshape(2, -1)
            short = widened(place)
            held.append((ungapped(a), np.frombuffer(b, "<u4"), here[1][short], widened(start), here[0][short], np.full(len(short), chunk)))
    yield from close()


def by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one chunk at a time: the marked starts of each of its texts."""
    at, texts, places, starts = None, None, [], []

    def close() -> Iterator[pa.RecordBatch]:
        if not places:
            return
        place, start = np.concatenate(places), np.concatenate(starts)
        order = np.argsort(place, kind="stable")
        place, start = place[order], start[order]
        names, first = np.unique(place, return_index=True)
        cut = np.append(first, len(place)).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts[names, 0]), pa.array(texts[names, 1]), pa.array([narrow(start[i:j]) for i, j in zip(cut, cut[1:])], pa.binary())],
            names=["m_doc", "m_row", "m_starts"])

    for batch in batches:
        for chunk, place, start, named in zip(*(batch.column(c).to_pylist() for c in ("chunk", "place", "start", "texts"))):
            if chunk != at:
                yield from close()
                at, texts, places, starts = chunk, None, [], []
            if named is not None:
                texts = np.frombuffer(named, "<i8").reshape(-1, 2)
            places.append(widened(place))
            starts.append(widened(start))
    yield from close()


def _without(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.text_chunks(batch, "text"):
                data, offs = W.flat(chunk.column("text"))
                start, end, wo = W.split_words(data, offs)
                heads = [widened(m) + wo[i] for i, marks in enumerate(chunk.column("marks").to_pylist()) for m in marks or ()]
                heads = np.concatenate(heads) if heads else np.zeros(0, np.int64)
                gone = W.cover(heads, window, len(start))
                kept = W.joined(data, start, end, ~gone, wo)
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id"), pa.array([k.decode() for k in kept], pa.string()),
                     pa.array(np.diff(wo)), pa.array(W.per_row(gone, wo))], names=["doc_id", "kept_text", "n_words", "n_removed"])

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, kept_text, n_words, n_removed``: each text without the words of windows that also start earlier.

    Earlier means a smaller id, or the same id and a smaller start. A null text has no words; a
    null id counts as the largest. Rows with equal id and start tie, and a tie removes nothing,
    so repeated rows are treated alike. Kept words are joined by one space.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    keyed = rows.select(F.coalesce("doc_id", F.lit(BIG)).alias("doc_id"), "text", row_key("doc_id", "text").alias("row"))
    expected = (rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0) // BYTES_PER_WINDOW
    width = min(MOST_CELLS, 1 << max(10, (CELLS_PER_WINDOW * expected).bit_length()))
    path = scratch_path(spark, "sketch")
    sketch = rows.mapInArrow(_sketch(window, width), "depth long, part long, once binary, twice binary")
    merged = sketch.repartition("depth", "part").sortWithinPartitions("depth", "part").mapInArrow(_merge(path), "depth long, part long, cells long")
    parts = [(r.depth, r.part) for r in merged.collect()]  # MOST_CELLS / RANGE * DEPTH numbers at most
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), expected // BUCKET_WINDOWS)
    found = keyed.mapInArrow(_candidates(window, width, path, parts, buckets), ROWS_DDL)
    marks = found.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_group, MARKS_DDL)
    marks = marks.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(by_text, "m_doc long, m_row long, m_starts binary")
    marks = marks.groupBy("m_doc", "m_row").agg(F.collect_list("m_starts").alias("marks"))
    joined = keyed.join(marks, (F.col("doc_id") == F.col("m_doc")) & (F.col("row") == F.col("m_row")), "left")
    ids = F.when(F.col("doc_id") < BIG, F.col("doc_id")).alias("doc_id")
    return joined.select(ids, "text", "marks").mapInArrow(_without(window), "doc_id long, kept_text string, n_words long, n_removed long")


def op4_remove_repeated_windows(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
