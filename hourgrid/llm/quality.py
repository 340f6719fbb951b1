"""Quality rules from suffix arrays of whole texts.

For each text a suffix array over its words is built by prefix doubling, thousands of texts
at a time. Neighbours in that order with a common prefix of ``min_words`` words or more are
the longest-common-prefix intervals; each gives a maximal repeated passage. The union of the
passages is limited to a share of the words, and the longest one to a number of words.
No row is shuffled; memory is bounded by a few megabytes of text or one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hourgrid.llm import words as W
from hourgrid.llm.frames import extended

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
CONTINUATION = (np.arange(256) & 0xC0) == 0x80
NEW = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "longest_repeat long, repeat_spans array<struct<start: int, length: int>>, base_failed boolean, kept boolean")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; shares are in per cent of the words."""

    min_words: int = 8
    least_words: int = 20
    base_repeat_pct: int = 30
    max_repeat_pct: int = 25
    max_longest: int = 200


def repeats(h: np.ndarray, word_offs: np.ndarray, least: int) -> np.ndarray:
    """For each word, the length of the longest passage from it that its text has twice, or 0 below ``least``.

    ``h`` holds word hashes of all rows; suffixes are compared within their row only.
    """
    n = len(h)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    row = np.repeat(np.arange(len(word_offs) - 1), np.diff(word_offs))
    stop = word_offs[1:][row]
    first = W.pair(h, row.astype(np.uint64))
    sa = np.argsort(first)
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = first[sa[1:]] != first[sa[:-1]]
    heads = np.maximum.accumulate(np.where(new, slots, 0))
    rank[sa] = heads
    levels = [rank.astype(np.int32)]
    step = 1
    last = np.append(new[1:], True)
    active = np.flatnonzero(~(new & last))
    near: list[np.ndarray] = []
    while len(active):
        pos = sa[active]
        nxt = pos + step
        second = np.where(nxt < stop[pos], rank[np.minimum(nxt, n - 1)] + 1, 0)
        key = rank[pos] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        key = key[order]
        sa[active] = pos[order]
        head = np.empty(len(key), bool)
        head[0] = True
        head[1:] = key[1:] != key[:-1]
        rank[sa[active]] = np.maximum.accumulate(np.where(head, active, 0))
        levels.append(rank.astype(np.int32))
        step *= 2
        if step >= least and not near:
            # all that share `least` words and more stand side by side from here on
            near.append(active)
        active = active[~(head & np.append(head[1:], True))]
    if not near:
        return longest
    at = near[0]
    a, b = sa[at[:-1]], sa[at[1:]]
    pairs = (at[1:] == at[:-1] + 1) & (row[a] == row[b])
    a, b = a[pairs], b[pairs]
    size = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + size, b + size
        fits = (x < stop[a]) & (y < stop[b])
        same = fits & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        size[same] += 1 << k
    size[size < least] = 0
    np.maximum.at(longest, a, size)
    np.maximum.at(longest, b, size)
    return longest


def _dup_lines(col: pa.Array) -> list[int]:
    out = []
    for text in col.to_pylist():
        if not text or "\n" not in text:
            out.append(0)
            continue
        lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
        out.append(len(lines) - len(set(lines)))
    return out


def measured(chunk: pa.RecordBatch, text: str, rules: Rules) -> pa.RecordBatch:
    col = chunk.column(text)
    data, offs = W.flat(col)
    start, end, wo = W.split_words(data, offs)
    longest = repeats(W.hash_words(data, start, end), wo, rules.min_words)
    heads = np.flatnonzero(longest)
    covered = W.cover(heads, longest[heads], len(longest))
    n_words = np.diff(wo)
    n_repeat = W.per_row(covered, wo)
    top = np.zeros(len(n_words), np.int64)
    if len(heads):
        np.maximum.at(top, np.searchsorted(wo, heads, "right") - 1, longest[heads])
    rise = np.flatnonzero(covered & ~np.concatenate([[False], covered[:-1]]) | _row_heads(covered, wo))
    fall = np.flatnonzero(covered & ~np.concatenate([covered[1:], [False]]) | _row_tails(covered, wo))
    span_offs = np.searchsorted(rise, wo).astype(np.int32)
    row_of = np.searchsorted(wo, rise, "right") - 1
    base_failed = (n_words < rules.least_words) | (100 * n_repeat > rules.base_repeat_pct * n_words)
    kept = ~base_failed & (100 * n_repeat <= rules.max_repeat_pct * n_words) & (top <= rules.max_longest)
    spans = pa.StructArray.from_arrays(
        [pa.array((rise - wo[row_of]).astype(np.int32)), pa.array((fall - rise + 1).astype(np.int32))], ["start", "length"])
    letters = W.SPACED[data] & ~CONTINUATION[data]
    return W.with_columns(chunk, {
        "n_words": pa.array(n_words), "word_chars": pa.array(W.per_row(letters, offs)),
        "n_symbols": pa.array(W.per_row(SYMBOLS[data], offs)), "n_dup_lines": pa.array(_dup_lines(col), pa.int64()),
        "n_repeat_words": pa.array(n_repeat), "longest_repeat": pa.array(top),
        "repeat_spans": pa.ListArray.from_arrays(pa.array(span_offs), spans),
        "base_failed": pa.array(base_failed), "kept": pa.array(kept),
    })


def _row_heads(flags: np.ndarray, wo: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags), bool)
    at = wo[:-1]
    at = at[at < len(flags)]
    out[at] = flags[at]
    return out


def _row_tails(flags: np.ndarray, wo: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags), bool)
    at = wo[1:] - 1
    at = at[(at >= 0) & (np.diff(wo) > 0)]
    out[at] = flags[at]
    return out


def quality_rules(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``docs`` with word counts, repeated spans and the verdict ``kept``.

    A null text has no words and, as any text below ``least_words``, is not kept. Repeated
    rows are judged one by one. An input column named like a result column is replaced.
    """
    docs = docs.withColumn(text, F.col(text).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.text_chunks(batch, text):
                yield measured(chunk, text, rules)

    return docs.mapInArrow(run, extended(docs.schema, NEW))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "longest_repeat")
