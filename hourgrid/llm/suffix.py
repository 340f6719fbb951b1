"""Removal of repeated byte strings by prefix-free parsing.

Parse. A position is a trigger if the hash of its eight bytes is a multiple of ``PERIOD``;
triggers cut texts into phrases, and as they hang on the bytes alone, equal strings are cut
alike. A window of ``LENGTH`` bytes belongs to the first trigger in its first ``REACH`` bytes,
or, in text without triggers, to the smallest hash there. The windows of one trigger are a
run; a run's string (the end of one phrase and the phrases that follow) is hashed with its
split, and so is the string behind the trigger that all its windows share.

Parse order. Runs are grouped by the shared string, then by the whole string. A run whose
shared string is found once has no repeated window: that settles nearly all text. A run found
twice as a whole is repeated as a whole. What is left, the ends of matches, gives its windows
one by one, which are grouped by a 96-bit hash of their bytes. Texts travel compressed.

A task groups its own rows first, so a string sends one row per task however often it occurs.
All keys are spread by hash. (A suffix order of the whole corpus would need every suffix that
starts with a frequent phrase in one task; see the README.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hourgrid.llm import words as W
from hourgrid.llm.frames import row_key, stored, table
from hourgrid.llm.packing import gaps, narrow, ungapped, widened
from hourgrid.llm.substring import BIG, MARKS_DDL, by_text

LENGTH = 400
REACH = 192
PERIOD_BITS = 5
BUCKET_BYTES = 32 << 20
ROWS_DDL = "bucket int, chunk long, a binary, b binary, multi binary, place binary, start binary, texts binary"
ROWS = [x.split()[0] for x in ROWS_DDL.split(", ")]
#: Marks of a run: repeated as a whole; to be looked at window by window; both, for others to find.
FULL, PARTIAL, SEED = 0, 1, 2
KINDS = 3
LOW = np.uint64(0xFFFFFFFF)


def parse(data: np.ndarray, offs: np.ndarray, length: int = LENGTH, reach: int = REACH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigger, first and last window start of every run, in order; runs never leave their row."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data),), (1,))
    h = W.pair(eight, np.full(1, W.SEEDS[0]))
    long_ = np.flatnonzero(np.diff(offs) >= length)
    begin, end = offs[:-1][long_], offs[1:][long_]
    t = np.flatnonzero(h >> np.uint64(64 - PERIOD_BITS) == 0)
    row = np.searchsorted(begin, t, "right") - 1
    ok = (row >= 0) & (t <= end[np.maximum(row, 0)] - 8)
    t, row = t[ok], row[ok]
    same = np.concatenate([[False], row[1:] == row[:-1]])
    free = np.where(same, np.concatenate([[0], t[:-1]]) + 1, begin[row])  # behind the trigger before
    lo, hi = np.maximum(free, t - reach), np.minimum(t, end[row] - length)
    # stretches without a trigger near enough, also behind the last trigger of a row
    last = np.full(len(begin), -1, np.int64)
    last[row] = t
    gap_lo = np.concatenate([free, np.where(last >= 0, last + 1, begin)])
    gap_hi = np.concatenate([np.minimum(t - reach - 1, end[row] - length), end - length])
    runs = [(t[lo <= hi], lo[lo <= hi], hi[lo <= hi])]
    for a, b in zip(gap_lo[gap_lo <= gap_hi], gap_hi[gap_lo <= gap_hi]):
        for at in range(int(a), int(b) + 1, 8192):
            to = min(int(b), at + 8191)
            view = np.lib.stride_tricks.sliding_window_view(h[at : to + reach + 1], reach + 1)
            anchor = view.argmin(axis=1) + np.arange(at, to + 1)
            head = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            runs.append((anchor[head], at + head, at + np.append(head[1:], len(anchor)) - 1))
    anchor, lo, hi = (np.concatenate(x) for x in zip(*runs))
    order = np.argsort(lo, kind="stable")
    return anchor[order], lo[order], hi[order]


def run_keys(data: np.ndarray, anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the string all windows of a run share from its trigger on, and of the whole run."""
    shared = anchor + LENGTH - REACH
    left = W.hash_words(data, lo, anchor, 1)
    right = W.hash_words(data, shared, hi + LENGTH, 1)
    split = ((anchor - lo) << 16 | (anchor - hi)).astype(np.uint64)
    return W.hash_words(data, anchor, shared), W.pair(W.pair(left, right), split) & LOW


def _packed(held: list[tuple], buckets: int, made: int) -> Iterator[pa.RecordBatch]:
    """A chunk's keys by bucket, one entry for equal keys; what is found twice here is marked at once.

    Keys name their text by its place in the chunk; one row more has the texts and those marks.
    """
    chunk = TaskContext.get().partitionId() << 32 | made
    a, b, doc, row, start = (np.concatenate(x) for x in zip(*held))
    texts, place = np.unique(np.stack([doc, row], 1), axis=0, return_inverse=True)
    order = np.lexsort((b, a))
    a, b, place, start = a[order], b[order], place.ravel()[order], start[order]
    head = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    first = np.flatnonzero(head)
    multi = np.diff(np.append(first, len(a))) > 1
    rest = np.flatnonzero(~head)
    yield pa.RecordBatch.from_arrays(
        [pa.array([made % buckets], pa.int32()), pa.array([chunk]), *(pa.nulls(1, pa.binary()) for _ in range(3)),
         *(pa.array([x], pa.binary()) for x in (narrow(place[rest]), narrow(start[rest] * KINDS + FULL), texts.astype("<i8").tobytes()))], names=ROWS)
    bucket = ((a[first] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cut = np.searchsorted(bucket, np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(cut)):
        at, m = first[cut[k] : cut[k + 1]], multi[cut[k] : cut[k + 1]]
        cols = [gaps(a[at]), b[at].astype("<u4").tobytes(), np.packbits(m).tobytes(), narrow(place[at]), narrow(start[at])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(k)], pa.int32()), pa.array([chunk]), *(pa.array([c], pa.binary()) for c in cols), pa.nulls(1, pa.binary())], names=ROWS)


def _grouped(runs: bool):
    """Marks of keys ``(a, b)``: FULL if found twice.

    For ``runs`` also PARTIAL if only ``a`` is found twice, and of the repeated runs beside such
    a one the first of each kind is SEED.
    """

    def close(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        a, b, multi, place, start, chunk = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((b, a))
        a, b, multi = a[order], b[order], multi[order]
        new_a = np.concatenate([[True], a[1:] != a[:-1]])
        new = new_a | np.concatenate([[True], b[1:] != b[:-1]])
        of, of_a = np.cumsum(new) - 1, np.cumsum(new_a) - 1
        full = (np.bincount(of, 1 + multi) > 1)[of]
        kind = np.full(len(a), FULL)
        some = full
        if runs:
            some = (np.bincount(of_a, 1 + multi) > 1)[of_a]
            partial = some & ~full
            beside = (np.bincount(of_a, partial) > 0)[of_a]
            kind[partial] = PARTIAL
            kind[full & beside & new] = SEED
        order, kind = order[some], kind[some]
        by_chunk = np.argsort(chunk[order], kind="stable")
        order, kind = order[by_chunk], kind[by_chunk]
        place, start, chunk = place[order], start[order] * KINDS + kind, chunk[order]
        names, first = np.unique(chunk, return_index=True)
        cut = np.append(first, len(chunk)).tolist()
        if len(names):
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([narrow(place[i:j]) for i, j in zip(cut, cut[1:])], pa.binary()),
                 pa.array([narrow(start[i:j]) for i, j in zip(cut, cut[1:])], pa.binary()), pa.nulls(len(names), pa.binary())],
                names=["chunk", "place", "start", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            named = batch.filter(batch.column("texts").is_valid())
            if named.num_rows:
                yield named.select(["chunk", "place", "start", "texts"])
            for bucket, chunk, a, b, multi, place, start in zip(*(batch.column(c).to_pylist() for c in ROWS[:7])):
                if a is None:
                    continue
                if bucket != at:
                    yield from close(held)
                    at, held = bucket, []
                a = ungapped(a)
                twice = np.unpackbits(np.frombuffer(multi, np.uint8), count=len(a))
                held.append((a, np.frombuffer(b, "<u4"), twice, widened(place), widened(start), np.full(len(a), chunk)))
        yield from close(held)

    return run


def _keys(buckets: int, most: int = 1_000_000):
    """The runs of all texts, packed; a run is named by its number in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, made = [], 0, 0
        for batch in batches:
            for chunk in W.text_chunks(batch, "text"):
                data, offs = W.flat(chunk.column("text"))
                anchor, lo, hi = parse(data, offs)
                if not len(lo):
                    continue
                a, b = run_keys(data, anchor, lo, hi)
                rows = np.searchsorted(offs, lo, "right") - 1
                number = np.arange(len(lo)) - np.searchsorted(lo, offs)[rows]
                held.append((a, b, _column(chunk, "doc_id")[rows], _column(chunk, "row")[rows], number))
                size += len(lo)
                if size > most:
                    yield from _packed(held, buckets, made)
                    held, size, made = [], 0, made + 1
        if size:
            yield from _packed(held, buckets, made)

    return run


def _column(chunk: pa.RecordBatch, name: str) -> np.ndarray:
    return chunk.column(name).to_numpy(zero_copy_only=False)


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        for chunk in W.text_chunks(batch, "text"):
            data, offs = W.flat(chunk.column("text"))
            whole = data.tobytes()
            rows = [np.uint32(j - i).tobytes() + codec.compress(whole[i:j], asbytes=True) for i, j in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("row"), pa.array(rows, pa.binary())], names=["doc_id", "row", "packed"])


def plain(packed: pa.Array) -> pa.Array:
    """The texts of ``_packed_texts``, as bytes."""
    codec = pa.Codec("zstd")
    return pa.array([codec.decompress(p[4:], int(np.frombuffer(p, "<u4", 1)[0]), asbytes=True) if p[:4] != b"\0\0\0\0" else b""
                     for p in packed.to_pylist()], pa.binary())


def _marked_runs(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, row offsets, the marked runs as (first, last) window starts, and their marks."""
    data, offs = W.flat(plain(chunk.column("packed")))
    _, lo, hi = parse(data, offs)
    base = np.searchsorted(lo, offs)
    marks = [widened(m) + KINDS * base[i] for i, held in enumerate(chunk.column("marks").to_pylist()) for m in held or ()]
    marks = np.unique(np.concatenate(marks)) if marks else np.zeros(0, np.int64)
    return data, offs, np.stack([lo[marks // KINDS], hi[marks // KINDS]], 1), marks % KINDS


def _window_keys(buckets: int, most: int = 1_000_000):
    """The single windows of the runs marked PARTIAL or SEED."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, made = [], 0, 0
        for batch in batches:
            for chunk in W.text_chunks(batch, "packed", W.CHUNK_BYTES // 2):
                data, offs, runs, kind = _marked_runs(chunk)
                runs = runs[kind != FULL]
                for runs in np.array_split(runs, max(1, len(runs) // 20_000)):
                    count = runs[:, 1] - runs[:, 0] + 1
                    if not len(count):
                        continue
                    s = np.repeat(runs[:, 0] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                    a, b = W.hash_words(data, s, s + LENGTH), W.hash_words(data, s, s + LENGTH, 1) & LOW
                    rows = np.searchsorted(offs, s, "right") - 1
                    held.append((a, b, _column(chunk, "doc_id")[rows], _column(chunk, "row")[rows], s - offs[rows]))
                    size += len(s)
                    if size > most:
                        yield from _packed(held, buckets, made)
                        held, size, made = [], 0, made + 1
        if size:
            yield from _packed(held, buckets, made)

    return run


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in W.text_chunks(batch, "packed", W.CHUNK_BYTES // 2):
            data, offs, runs, kind = _marked_runs(chunk)
            runs = runs[kind != PARTIAL]
            single = [widened(m) // KINDS + offs[i] for i, held in enumerate(chunk.column("windows").to_pylist()) for m in held or ()]
            single = np.concatenate(single) if single else np.zeros(0, np.int64)
            gone = W.cover(np.concatenate([runs[:, 0], single]), np.concatenate([runs[:, 1] - runs[:, 0], np.zeros(len(single), np.int64)]) + LENGTH, len(data))
            rise = gone & ~np.concatenate([[False], gone[:-1]])
            heads = offs[:-1][np.diff(offs) > 0]
            rise[heads] = gone[heads]
            kept, left = data[~gone].tobytes(), np.concatenate([[0], np.cumsum(~gone)])[offs]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), pa.array([kept[i:j] for i, j in zip(left[:-1], left[1:])], pa.binary()), pa.array(np.diff(offs)),
                 pa.array(W.per_row(gone, offs)), pa.array(W.per_row(rise, offs))],
                names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, kept, n_bytes, n_removed, n_spans``: texts less every byte of a repeated string.

    A string of ``LENGTH`` bytes is repeated if it also starts anywhere else, in the same
    document or another; all its places go. A null text is empty. Repeated rows repeat each
    other's strings. ``kept`` is binary, as a cut may fall inside a character.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    keyed = texts.withColumns({"row": row_key("doc_id", "text"), "doc_id": F.coalesce("doc_id", F.lit(BIG))})
    total = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES)

    def grouped(rows: DataFrame, runs: bool, name: str) -> DataFrame:
        marks = rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_grouped(runs), MARKS_DDL)
        marks = marks.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(by_text, "m_doc long, m_row long, m_starts binary")
        marks = marks.groupBy("m_doc", "m_row").agg(F.collect_list("m_starts").alias(name))
        return stored(marks.select(F.col("m_doc").alias("doc_id"), F.col("m_row").alias("row"), name), f"suffix-{name}")

    runs = grouped(keyed.mapInArrow(_keys(buckets), ROWS_DDL), True, "marks")
    packed = keyed.mapInArrow(_packed_texts, "doc_id long, row long, packed binary")
    ends = packed.join(runs, ["doc_id", "row"])
    windows = grouped(ends.select("doc_id", "row", "packed", "marks").mapInArrow(_window_keys(buckets), ROWS_DDL), False, "windows")
    joined = packed.join(runs, ["doc_id", "row"], "left").join(windows, ["doc_id", "row"], "left")
    ids = F.when(F.col("doc_id") < BIG, F.col("doc_id")).alias("doc_id")
    return joined.select(ids, "packed", "marks", "windows").mapInArrow(
        _without, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def op9_remove_repeated_bytes(spark, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
