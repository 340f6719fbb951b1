"""Importance resampling towards a target distribution, by hashed n-gram features.

Features are runs of one to three words; a feature's bucket is the crc32 of its bytes modulo
``BUCKETS``. Bucket counts of all documents and of the target texts give every bucket a gain,
a document's weight is the sum of the gains of its features, and the documents with the
highest weight plus Gumbel noise are drawn, the noise being a hash of seed and document id.

No n-gram is ever built as text. A task keeps an Aho-Corasick automaton of distinct words,
each between two delimiters, with a payload of crc32 and length. A scan of the text emits the
payload of every word in turn, and payloads of neighbours compose: the crc of ``a b`` is the
crc of ``a`` moved on by the bytes of `` b``, which is linear and comes from tables, combined
with that of `` b``. Words that the automaton does not hold yet are found as the gaps between
its matches; those that come again are added until it holds ``MOST_WORDS``, the others get
their payload from the distinct words of the chunk, so its size never changes a result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hourgrid.llm import words as W
from hourgrid.llm.frames import stored, table
from hourgrid.llm.tokenfile import cuts

BUCKETS = 10_000
LONGEST = 3  # words in a feature
LEAST_WORDS = 20  # of a document that can be drawn
PERCENT = 5
SEED = 42
MOST_WORDS = 60_000
_SLOT_BITS = 33  # fixed by Spark: the low bits of monotonically_increasing_id count rows
COUNT = "bucket int, n long"
WEIGHT = "doc_id long, n_words long, n_features long, weight long"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """What a crc becomes if zero bytes follow: tables by byte for 0 to 63 of them, and for 64, 128, ... of them."""
    step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\x00") for b in range(256)], np.uint32)
    few = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])]
    for _ in range(64):
        few.append(step[few[-1] & 0xFF] ^ few[-1] >> np.uint32(8))
    many = [few.pop()]
    for _ in range(36):
        many.append(_moved(many[-1], many[-1]))
    return np.stack(few), np.stack(many)


def _moved(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 0xFF] ^ table[1][crc >> np.uint32(8) & 0xFF] ^ table[2][crc >> np.uint32(16) & 0xFF] ^ table[3][crc >> np.uint32(24)]


FEW, MANY = _tables()
SPACE = np.uint32(zlib.crc32(b" "))


def composed(a: np.ndarray, b: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """The crc32 of a text followed by a text of ``b_size`` bytes, from the crc32 of both."""
    low = b_size & 63
    out = FEW[low, 0, a & 0xFF] ^ FEW[low, 1, a >> np.uint32(8) & 0xFF] ^ FEW[low, 2, a >> np.uint32(16) & 0xFF] ^ FEW[low, 3, a >> np.uint32(24)]
    high, k = b_size >> 6, 0
    while high.any():
        odd = np.flatnonzero(high & 1)
        out[odd] = _moved(MANY[k], out[odd])
        high, k = high >> 1, k + 1
    return out ^ b


class Scanner:
    """Words of texts as payloads: crc32 and length, in order."""

    def __init__(self, most: int = MOST_WORDS):
        self.words = ahocorasick.Automaton()
        self.most = most

    def _learn(self, distinct: pa.Array, again: np.ndarray, payloads: np.ndarray) -> None:
        room = self.most - len(self.words)
        chosen = np.flatnonzero(again)[:room] if room > 0 else []
        for word, payload in zip(distinct.take(pa.array(chosen, pa.int64())).to_pylist(), payloads[chosen].tolist()) if len(chosen) else ():
            self.words.add_word(f" {word.decode('latin-1')} ", payload)
        if len(chosen):
            self.words.make_automaton()

    def scan(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Crc and length of every word of the rows, and the word offsets of the rows."""
        lower = W.LOWER[data]
        text = np.full(len(data) + len(offs), 0x20, np.uint8)  # a space before the first row and after each
        row = np.repeat(np.arange(1, len(offs)), np.diff(offs))
        text[np.arange(len(data)) + row] = np.where(W.ALNUM[lower], lower, 0x20)
        start, end, rows = W.split_words(text, offs + np.arange(1, len(offs) + 1), W.ALNUM)
        payload = np.full(len(text), -1, np.int64)
        if len(self.words) and len(start):
            found = np.fromiter(chain.from_iterable(self.words.iter(text.tobytes().decode("latin-1"))), np.int64)
            payload[found[::2]] = found[1::2]  # a match ends at the space behind its word
        payload = payload[end]
        gaps = np.flatnonzero(payload < 0)
        if len(gaps):
            s, size = start[gaps], (end - start)[gaps]
            bounds = np.concatenate([[0], np.cumsum(size)])
            inner = np.repeat(s - bounds[:-1], size) + np.arange(bounds[-1])
            coded = pa.Array.from_buffers(pa.large_binary(), len(gaps), [None, pa.py_buffer(bounds), pa.py_buffer(text[inner])]).dictionary_encode()
            codes = coded.indices.to_numpy()
            new = np.array([len(w) << 32 | zlib.crc32(w) for w in coded.dictionary.to_pylist()], np.int64)
            payload[gaps] = new[codes]
            self._learn(coded.dictionary, np.bincount(codes) > 1, new)
        return (payload & 0xFFFFFFFF).astype(np.uint32), payload >> 32, rows

    def features(self, chunk: pa.RecordBatch) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """For runs of 1, 2, 3 words: their crc32, and the row of each; last, the words of each row."""
        data, offs = W.flat(chunk.column("text"))
        if chunk.num_rows == 1 and len(data) > W.CHUNK_BYTES:  # no word crosses a cut; runs of words do
            parts, at = [], 0
            for to in cuts(data):
                parts.append(self.scan(data[at:to], np.array([0, to - at])))
                at = to
            crc, size = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            rows = np.array([0, len(crc)])
        else:
            crc, size, rows = self.scan(data, offs)
        row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        out, of = [crc], [row]
        run = crc
        for n in range(1, LONGEST):
            inside = row[n:] == row[:-n] if len(row) > n else np.zeros(0, bool)
            m = len(inside)
            spaced = composed(run[:m], np.full(m, SPACE), np.ones(m, np.int64))
            run = composed(spaced, crc[n:], size[n:]) if m else run[:0]
            out.append(run[inside])
            of.append(row[n:][inside])
        return out, of, np.diff(rows)


def _texts(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def feature_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features of all ``texts (text)`` by bucket; a task sends at most a row a bucket.

    A null or empty text has no feature; repeated rows count each time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, total = Scanner(), np.zeros(buckets, np.int64)
        for batch in batches:
            for chunk in W.text_chunks(batch, "text"):
                for crc in scanner.features(chunk)[0]:
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    return _texts(texts).mapInArrow(run, COUNT).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket in thousandths; the driver sees one number a bucket."""
    counts = []
    for df in source, target:
        by = dict.fromkeys(range(buckets), 0) | {r.bucket: r.n for r in feature_counts(df, buckets).collect()}
        counts.append([by[b] for b in range(buckets)])
    s_all, t_all = (sum(x) for x in counts)
    return [math.floor(1000 * math.log(float((t + 1) * (s_all + buckets)) / float((s + 1) * (t_all + buckets)))) for s, t in zip(*counts)]


def weigh(docs: DataFrame, gain: list[int]) -> DataFrame:
    """Words, features and summed gains of every document; a text without words has none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, by = Scanner(), np.array(gain, np.int64)
        for batch in batches:
            for chunk in W.text_chunks(batch, "text"):
                crcs, of, n_words = scanner.features(chunk)
                weight, n = np.zeros(chunk.num_rows, np.int64), np.zeros(chunk.num_rows, np.int64)
                for crc, row in zip(crcs, of):
                    if len(row):
                        heads = np.flatnonzero(np.diff(row, prepend=-1))
                        weight[row[heads]] += np.add.reduceat(by[crc % np.uint32(len(by))], heads)
                        n[row[heads]] += np.diff(np.append(heads, len(row)))
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (n_words, n, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, WEIGHT)


def scored(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """``score``: weight plus Gumbel noise in thousandths, a function of seed and document id; a null id hashes as no text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return weights.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.ln(-F.ln(share))))


def draw(scores: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rank`` of the drawn documents: ``percent`` of those with ``least_words``, highest scores first.

    Equal scores go by the smaller id, null ids last; rows equal in both in any order. Scores
    are written once, dealt by ranges of the order, and numbered inside each range; one row a
    range is summed up. A tie column lets equal rows spread over several ranges.
    """
    rows = stored(scores.withColumn("__tie", F.monotonically_increasing_id()), "scores")
    short = F.col("n_words") < least_words
    drawn = rows.filter(~short).count() * percent // 100
    order = [short, F.desc("score"), F.asc_nulls_last("doc_id"), F.col("__tie")]
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("__tie").withColumn("__at", F.monotonically_increasing_id()), "ranked")
    placed = placed.select("*", F.shiftright("__at", _SLOT_BITS).alias("__range"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = placed.groupBy("__range").agg(F.count("*").alias("__n")).select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.col("__before") + F.col("__at").bitwiseAND((1 << _SLOT_BITS) - 1) + 1
    return placed.join(starts, "__range").withColumn("rank", F.when(~short & (place <= drawn), place)).drop("__range", "__at", "__before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Features, weight, score and rank of every row of ``docs (doc_id, text)``, drawn towards ``target (text)``; other columns are ignored."""
    return draw(scored(weigh(docs, gains(docs, target)), seed), percent)


def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
