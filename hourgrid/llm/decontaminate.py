"""Benchmark decontamination with suffix arrays of the corpus.

Every few megabytes of documents are a shard. Its suffix array holds, in the order of their
words, the suffixes that can match at all: those that start with enough consecutive words of
the benchmark's vocabulary. Every suffix of every benchmark item is binary-searched in it;
the range found is its set of verbatim matches, whose documents, places and full lengths
follow. A document word inside the match of a whole window (``window`` words, or a shorter
item as a whole) is hit.

The benchmark is a stated query set against all rows: it is written to the shared folder in
blocks of a fixed size, and every task goes through the blocks, so neither the driver nor an
executor ever holds more than one block. No document is shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hourgrid.llm import words as W
from hourgrid.llm.files import read_rows
from hourgrid.llm.frames import extended, table
from hourgrid.session import scratch_path

WINDOW = 10
BLOCK_BYTES = 16 << 20
NEW = ("n_words long, n_hit long, item_ids array<string>, longest_match long, longest_at long, "
       "longest_item string")


@dataclass
class Items:
    """One block of benchmark items, ready to be searched for."""

    vocab: np.ndarray  # sorted word hashes
    common: np.ndarray  # a bit per hash prefix, to reject other words fast
    suffixes: np.ndarray  # item suffixes as rows of word numbers, 0 behind the end
    need: np.ndarray  # words of the window that starts there, 0 for none
    item: np.ndarray  # item of the suffix
    words: np.ndarray  # all items' word numbers, each item ended by 0
    at: np.ndarray  # where the suffix starts in ``words``
    ids: np.ndarray
    least: int


def prepared(ids: list, texts: pa.Array, window: int) -> Items:
    data, offs = W.flat(texts)
    data = W.LOWER[data]
    start, end, wo = W.split_words(data, offs, W.ALNUM)
    h = W.hash_words(data, start, end)
    vocab, number = np.unique(h, return_inverse=True)
    size = np.diff(wo)
    item = np.repeat(np.arange(len(size)), size)
    words = np.zeros(len(h) + len(size), np.int64)
    at = np.arange(len(h)) + item
    words[at] = number + 1
    left = size[item] - (np.arange(len(h)) - wo[:-1][item])
    need = np.where(left >= window, window, np.where((size[item] < window) & (left == size[item]), left, 0))
    padded = np.append(words, np.zeros(window, np.int64))
    rows = padded[at[:, None] + np.arange(window)] if len(at) else np.zeros((0, window), np.int64)
    rows = np.where(np.arange(window) < left[:, None], rows, 0)
    common = np.zeros(1 << 20, bool)
    common[(vocab >> np.uint64(44)).astype(np.int64)] = True
    least = int(need[need > 0].min()) if (need > 0).any() else window
    return Items(vocab, common, rows, need, item, words, at, np.array([str(i) for i in ids], object), least)


def _lower_bound(rows: np.ndarray, keys: np.ndarray, size: np.ndarray, above: bool) -> np.ndarray:
    """Binary search of all ``keys`` among sorted ``rows`` by their first ``size`` columns."""
    lo, hi = np.zeros(len(keys), np.int64), np.full(len(keys), len(rows), np.int64)
    for _ in range(max(1, math.ceil(math.log2(len(rows) + 1)) + 1)):
        mid = (lo + hi) // 2
        probe = rows[np.minimum(mid, len(rows) - 1)]
        differ = (probe != keys) & (np.arange(rows.shape[1]) < size[:, None])
        where = differ.argmax(axis=1)
        unequal = differ[np.arange(len(keys)), where]
        less = np.where(unequal, probe[np.arange(len(keys)), where] < keys[np.arange(len(keys)), where], above)
        go = lo < hi
        lo = np.where(go & less, mid + 1, lo)
        hi = np.where(go & ~less, mid, hi)
    return lo


def matches(h: np.ndarray, wo: np.ndarray, items: Items, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, place) of every window match in a shard with word hashes ``h``."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    maybe = np.flatnonzero(items.common[(h >> np.uint64(44)).astype(np.int64)])
    if not len(maybe) or not len(items.vocab):
        return none
    slot = np.minimum(np.searchsorted(items.vocab, h[maybe]), len(items.vocab) - 1)
    fits = items.vocab[slot] == h[maybe]
    number = np.zeros(len(h) + window, np.int64)
    number[maybe[fits]] = slot[fits] + 1
    # words from each place on that are of the vocabulary, within the row
    stops = np.flatnonzero(number[: len(h)] == 0)
    bounds = np.unique(np.concatenate([stops, wo]))
    at = maybe[fits]
    run = bounds[np.minimum(np.searchsorted(bounds, at, "right"), len(bounds) - 1)] - at
    sa, run = at[run >= items.least], run[run >= items.least]
    if not len(sa):
        return none
    rows = number[sa[:, None] + np.arange(window)]
    rows = np.where(np.arange(window) < run[:, None], rows, 0)
    order = np.lexsort(rows.T[::-1])
    sa, rows = sa[order], rows[order]
    wanted = np.flatnonzero(items.need)
    keys, size = items.suffixes[wanted], items.need[wanted]
    lo = _lower_bound(rows, keys, size, False)
    hi = _lower_bound(rows, keys, size, True)
    count = hi - lo
    found = np.flatnonzero(count)
    count = count[found]
    slots = np.repeat(lo[found] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
    return np.repeat(wanted[found], count), sa[slots]


def _full_lengths(h: np.ndarray, wo: np.ndarray, items: Items, suffix: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Words in which each match goes on, to the end of the item or the row at most."""
    stop = wo[np.searchsorted(wo, place, "right")]
    size = items.need[suffix].copy()
    grow = np.arange(len(suffix))
    while len(grow):
        x, y = items.at[suffix[grow]] + size[grow], place[grow] + size[grow]
        ok = (y < stop[grow]) & (items.words[x] > 0)
        grow, x, y = grow[ok], x[ok], y[ok]
        same = items.vocab[items.words[x] - 1] == h[y]
        grow = grow[same]
        size[grow] += 1
    return size


def searched(chunk: pa.RecordBatch, text: str, blocks, window: int) -> pa.RecordBatch:
    data, offs = W.flat(chunk.column(text))
    data = W.LOWER[data]
    start, end, wo = W.split_words(data, offs, W.ALNUM)
    h = W.hash_words(data, start, end)
    n = len(wo) - 1
    hit = np.zeros(len(h), bool)
    found: list[set] = [set() for _ in range(n)]
    longest, longest_at, longest_item = np.zeros(n, np.int64), np.full(n, -1, np.int64), [None] * n
    for items in blocks():
        suffix, place = matches(h, wo, items, window)
        if not len(suffix):
            continue
        hit |= W.cover(place, items.need[suffix], len(h))
        row = np.searchsorted(wo, place, "right") - 1
        pairs = np.unique(row * len(items.ids) + items.item[suffix])
        for r, i in zip(pairs // len(items.ids), items.ids[pairs % len(items.ids)]):
            found[r].add(i)
        size = _full_lengths(h, wo, items, suffix, place)
        for k in np.lexsort((place, -size, row)):  # the first of a row is its longest match
            r = row[k]
            if size[k] > longest[r]:
                longest[r], longest_at[r], longest_item[r] = size[k], place[k] - wo[r], items.ids[items.item[suffix[k]]]
    return W.with_columns(chunk, {
        "n_words": pa.array(np.diff(wo)), "n_hit": pa.array(W.per_row(hit, wo)),
        "item_ids": pa.array([sorted(x) for x in found], pa.list_(pa.string())),
        "longest_match": pa.array(longest), "longest_at": pa.array(longest_at, mask=longest == 0),
        "longest_item": pa.array(longest_item, pa.string())})


def benchmark_blocks(benchmark: DataFrame, id_col: str, text: str) -> list[str]:
    """Write the items to the shared folder in blocks of ``BLOCK_BYTES`` on average; the files."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text).cast("string").alias("text"))
    items = items.filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    path = scratch_path(spark, "benchmark")
    items.repartition(int(total // BLOCK_BYTES) + 1).write.parquet(path)
    return [f for f in spark.read.parquet(path).inputFiles()]


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
                       item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with hit words, the items found (as strings, sorted) and the longest verbatim match.

    Null texts have no words, items without words match nothing, a null item id is ``null``.
    Repeated rows are searched one by one; equal items are all reported; an input column
    named like a result column is replaced.
    """
    docs = docs.withColumn(text, F.col(text).cast("string"))
    files = benchmark_blocks(benchmark, item_id, item_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[Items] = []

        def blocks() -> Iterator[Items]:
            if kept:
                yield kept[0]
                return
            for file in files:
                rows = read_rows(file)
                ids = ["null" if i is None else i for i in rows.column("item_id").to_pylist()]
                got = prepared(ids, rows.column("text").combine_chunks(), window)
                if len(files) == 1:
                    kept.append(got)
                yield got

        for batch in batches:
            for chunk in W.text_chunks(batch, text):
                yield searched(chunk, text, blocks, window)

    return docs.mapInArrow(run, extended(docs.schema, NEW))


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
