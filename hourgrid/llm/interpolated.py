"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

p(w | h) = a(b) c(h w) / c(h) + g(b) c(w) / N + u(b) / (V + 1), with weights for every bucket b
of the context's frequency c(h). The weights are learned by expectation-maximisation on the
tokens of a deleted part of the training documents, with the counts of the other part.

Nothing of the model is held in one place. Texts are stored once as blocks of word numbers
with a block dictionary. A block sends its distinct words and bigrams, sorted by hash and
coded by their gaps, to hash buckets; each bucket sums them over all blocks and answers every
block in the order it asked. With the answers a block knows all counts of its tokens, so
scores need no further exchange. All words and bigrams are counted, none is pruned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hourgrid.llm import words as W
from hourgrid.llm.frames import stored, table
from hourgrid.llm.packing import gaps, narrow, small, ungapped, unsmall, widened

BLOCK_TOKENS = 1 << 20
CHUNK_BYTES = 1 << 20  # of texts that a block grows by at once, so that none is much larger
BUCKET_TOKENS = 1 << 20
SPAN_TOKENS = 1 << 17  # whose counts are spread over tokens at once
FOLDS, HELD_OUT, DELETED = 10, 0, 1
ADDED = 0.1  # to every count of the base model
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
BUCKETS = 48  # of context frequency, by powers of two
CELLS = 8  # per octave of an estimate, in the counts that weights are learned from
STEPS = 200
BLOCK = "block long, fold int, ids binary, known_ids binary, sizes binary, dictionary binary, numbers binary"
ASKED = "bucket int, block long, fold int, gram int, keys binary, counts binary"
ANSWER = "block long, fold int, gram int, bucket int, total binary, deleted binary, tokens long, distinct long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as numbered words, in blocks of one kind of fold each."""
    made = 0

    def block(fold: int, held: list[tuple]) -> pa.RecordBatch:
        nonlocal made
        ids, known, sizes, hashes = (np.concatenate(x) for x in zip(*held))
        dictionary, numbers = np.unique(hashes, return_inverse=True)
        number = TaskContext.get().partitionId() << 32 | made
        made += 1
        cols = [ids.astype("<i8").tobytes(), np.packbits(known).tobytes(), narrow(sizes), dictionary.tobytes(), numbers.astype("<u4").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([fold], pa.int32()), *(pa.array([c], pa.binary()) for c in cols)],
                                          names=[x.split()[0] for x in BLOCK.split(", ")])

    held: dict[int, list] = {}
    count: dict[int, int] = {}
    for batch in batches:
        for chunk in W.text_chunks(batch, "text", CHUNK_BYTES):
            data, offs = W.flat(chunk.column("text"))
            data = W.LOWER[data]
            start, end, wo = W.split_words(data, offs)
            h = W.hash_words(data, start, end)
            h = np.where((h == START) | (h == END), h ^ np.uint64(1 << 63), h)
            ids = chunk.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            folds = chunk.column("fold").to_numpy(zero_copy_only=False)
            for fold in np.unique(folds).tolist():
                rows = np.flatnonzero(folds == fold)
                size = np.diff(wo)[rows]
                inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                held.setdefault(fold, []).append((ids[rows], known[rows], size, h[np.repeat(wo[:-1][rows], size) + inner]))
                count[fold] = count.get(fold, 0) + int(size.sum()) + len(rows)
                if count[fold] >= BLOCK_TOKENS:
                    yield block(fold, held.pop(fold))
                    count[fold] = 0
    for fold, parts in held.items():
        yield block(fold, parts)


class Tokens:
    """The tokens of a block: every word and the end of every text, with their contexts."""

    def __init__(self, sizes: bytes, dictionary: bytes, numbers: bytes):
        self.sizes = widened(sizes)
        words = np.concatenate([np.frombuffer(dictionary, np.uint64), [END, START]])
        numbers = np.frombuffer(numbers, "<u4")
        ends = np.cumsum(self.sizes + 1) - 1
        n = len(numbers) + len(ends)
        self.first = ends - self.sizes
        word = np.full(n, len(words) - 2, np.int32)
        inner = np.ones(n, bool)
        inner[ends] = False
        word[inner] = numbers
        context = np.empty(n, np.int32)
        context[1:] = word[:-1]
        context[self.first] = len(words) - 1
        self.word, self.context = word, context
        keys = W.pair(words[context], words[word])
        # words sorted by hash, the two marks among them
        order = np.argsort(words)
        self.words = words[order]
        self.place = np.empty(len(words), np.int64)
        self.place[order] = np.arange(len(words))
        self.pairs, pair = np.unique(keys, return_inverse=True)
        self.pair = pair.astype(np.int32)

    def spans(self) -> Iterator[tuple[slice, slice]]:
        """Texts, a few at a time, and their tokens; a text is never cut."""
        starts = np.searchsorted(self.first, np.arange(0, len(self.word), SPAN_TOKENS))
        cut = np.unique(np.append(starts[starts < len(self.first)], len(self.first)))
        edge = np.append(self.first, len(self.word))[cut]
        for k in range(len(cut) - 1):
            yield slice(cut[k], cut[k + 1]), slice(edge[k], edge[k + 1])

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Keys and counts of words (as tokens; the start by its texts) and of bigrams."""
        count = np.bincount(self.word, minlength=len(self.words))
        count[-1] = len(self.sizes)
        by_hash = np.empty(len(count), np.int64)
        by_hash[self.place] = count
        yield 1, self.words, by_hash
        yield 2, self.pairs, np.bincount(self.pair, minlength=len(self.pairs))


def _slices(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    return np.unique(bucket), np.searchsorted(bucket, np.append(np.unique(bucket), buckets))


def _row(batch: pa.RecordBatch, i: int) -> dict:
    """The block in row ``i``; its bytes stay in the batch."""
    row = {name: batch.column(name)[i] for name in (x.split()[0] for x in BLOCK.split(", ")) if name in batch.schema.names}
    return {k: memoryview(v.as_buffer()) if pa.types.is_binary(v.type) else v.as_py() for k, v in row.items()}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Blocks one by one: a batch holds several of some megabytes, and only one at a time is spread out."""
    for batch in batches:
        for i in range(len(batch)):
            yield _row(batch, i)


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Blocks one by one with their ``answers``, the (total, deleted) of each gram's buckets, which follow the block."""
    row = None
    for batch in batches:
        for i, (gram, *counts) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("gram", "total", "deleted")))):
            if gram is None:
                if row:
                    yield row
                row = _row(batch, i) | {"answers": {1: [], 2: []}}
            else:
                row["answers"][gram].append(counts)
    if row:
        yield row


def _asked(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block, fold = row["block"], row["fold"]
            for gram, keys, counts in Tokens(row["sizes"], row["dictionary"], row["numbers"]).grams():
                some, cut = _slices(keys, buckets)
                cut = cut.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()), pa.array([fold] * len(some), pa.int32()),
                     pa.array([gram] * len(some), pa.int32()), pa.array([gaps(keys[i:j]) for i, j in zip(cut, cut[1:])], pa.binary()),
                     pa.array([small(counts[i:j]) for i, j in zip(cut, cut[1:])], pa.binary())],
                    names=[x.split()[0] for x in ASKED.split(", ")])

    return run


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one (gram, bucket) at a time: counts over all blocks, to every block that asked."""

    def close(at: tuple, held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        gram, bucket = at
        keys = [ungapped(k) for _, _, k, _ in held]
        counts = [unsmall(c) for _, _, _, c in held]
        all_, place = np.unique(np.concatenate(keys), return_inverse=True)
        cut = np.cumsum([0] + [len(k) for k in keys])
        own = np.concatenate(counts)
        fold = np.repeat([f for _, f, _, _ in held], np.diff(cut))
        total = np.bincount(place, np.where(fold != HELD_OUT, own, 0), len(all_)).astype(np.int64)
        deleted = np.bincount(place, np.where(fold == DELETED, own, 0), len(all_)).astype(np.int64)
        word = (all_ != START) & (gram == 1)
        stats = [[int(total[word].sum()), int((total[word] > 0).sum())], [int(deleted[word].sum()), 0]]
        rows = [(block, f, gram, bucket, small(total[place[i:j]]), small(deleted[place[i:j]]) if f == DELETED else None, None, None)
                for (block, f, _, _), i, j in zip(held, cut, cut[1:])]
        rows += [(None, f, gram, bucket, None, None, *s) for f, s in zip((-1, DELETED), stats)]
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=[x.split()[0] for x in ANSWER.split(", ")])

    at, held = None, []
    for batch in batches:
        for gram, bucket, *row in zip(*(batch.column(c).to_pylist() for c in ("gram", "bucket", "block", "fold", "keys", "counts"))):
            if (gram, bucket) != at:
                yield from close(at, held)
                at, held = (gram, bucket), []
            held.append(row)
    yield from close(at, held)


def _known(row: dict, deleted: bool) -> tuple[Tokens, np.ndarray, np.ndarray]:
    """Tokens of a block, and the counts of its bigrams and of its words; less the deleted part if asked."""
    tokens = Tokens(row["sizes"], row["dictionary"], row["numbers"])
    pairs, words = (np.concatenate([unsmall(t) - (unsmall(d) if deleted else 0) for t, d in row["answers"][gram]]) for gram in (2, 1))
    return tokens, pairs, words[tokens.place]


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.floor(np.log2(context + 1.0)), BUCKETS - 1).astype(np.int64)


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def _learned_from(tokens_left: int):
    """Counts of the deleted tokens by context bucket and by cells of both estimates."""

    def cell(p: np.ndarray) -> np.ndarray:
        return np.where(p > 0, np.round(CELLS * np.log2(np.maximum(p, 1e-300))), 1).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _answered(batches):
            tokens, pairs, words = _known(row, True)
            for _, at in tokens.spans():
                context = words[tokens.context[at]]
                cells = np.stack([_bucket(context), cell(_ratio(pairs[tokens.pair[at]], context)), cell(words[tokens.word[at]] / max(1, tokens_left))], 1)
                found, n = np.unique(cells, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(found[:, k], pa.int32()) for k in range(3)), pa.array(n, pa.int64())],
                                                 names=["bucket", "pair", "word", "n"])

    return run


def maximise(cells: pd.DataFrame, uniform: float) -> list[float]:
    """Weights of bigram, unigram and uniform estimate for the counted cells, by EM."""
    p = np.stack([np.where(cells.pair > 0, 0.0, 2.0 ** (cells.pair / CELLS)), np.where(cells.word > 0, 0.0, 2.0 ** (cells.word / CELLS)),
                  np.full(len(cells), uniform)])
    n = cells.n.to_numpy(float)
    weights = np.full(3, 1 / 3)
    for _ in range(STEPS):
        share = weights[:, None] * p
        new = (share / share.sum(axis=0) * n).sum(axis=1) / n.sum()
        done = np.abs(new - weights).max() < 1e-9
        weights = new
        if done:
            break
    weights = np.maximum(weights, 1e-9)  # a word that was never deleted can still be unknown
    return (weights / weights.sum()).tolist()


def _scored(tokens_all: int, distinct: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _answered(batches):
            tokens, pairs, words = _known(row, False)
            ids = np.frombuffer(row["ids"], "<i8")
            known = np.unpackbits(np.frombuffer(row["known_ids"], np.uint8), count=len(tokens.sizes)).astype(bool)
            for texts, at in tokens.spans():
                context, word = words[tokens.context[at]], words[tokens.word[at]]
                w = weights[_bucket(context)]
                p = w[:, 0] * _ratio(pairs[tokens.pair[at]], context) + w[:, 1] * (word / max(1, tokens_all)) + w[:, 2] / (distinct + 1)
                # without a known context the bigram's weight goes to the others
                p = np.where(context > 0, p, p / np.maximum(1 - w[:, 0], 1e-12))
                base = np.log10((word + ADDED) / (tokens_all + ADDED * (distinct + 1)))
                sums = [np.add.reduceat(x, tokens.first[texts] - at.start) for x in ((word > 0).astype(np.int64), base, np.log10(p))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[texts], pa.int64(), mask=~known[texts]), pa.array(np.full(len(sums[0]), row["fold"] == HELD_OUT)),
                     pa.array(tokens.sizes[texts] + 1), *map(pa.array, sums)], names=[x.split()[0] for x in SCORES.split(", ")])

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Documents with crc32(id) mod 10 = 0 are held out, those with 1 are the deleted part, all but
    the held-out are counted. A null text has the end as its only token; a null id is hashed
    as ``null``; repeated rows count as often as they are there.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    fold = F.crc32(name.cast("binary")) % FOLDS
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.when(fold == HELD_OUT, HELD_OUT).when(fold == DELETED, DELETED).otherwise(DELETED + 1).alias("fold"))
    blocks = stored(rows.mapInArrow(_blocks, BLOCK), "lm-blocks", compression="zstd")
    expected = blocks.agg(F.sum(F.octet_length("numbers")) / 4).head()[0] or 0
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), int(expected // BUCKET_TOKENS))
    asked = blocks.select("block", "fold", "sizes", "dictionary", "numbers").mapInArrow(_asked(buckets), ASKED)
    answers = stored(asked.repartition("gram", "bucket").sortWithinPartitions("gram", "bucket").mapInArrow(_answers, ANSWER), "lm-answers")
    totals = {r.fold: r for r in answers.filter("block IS NULL AND gram = 1").groupBy("fold").agg(
        F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).collect()}  # two rows
    n, distinct = (totals[-1].tokens, totals[-1].distinct) if totals else (0, 0)
    left = n - (totals[DELETED].tokens if totals else 0)

    def joined(b: DataFrame, a: DataFrame) -> DataFrame:
        # each block's answers behind it, in order: sorted rows, which spill, in place of lists and joined rows on the heap
        both = b.unionByName(a.filter("block IS NOT NULL").select("block", "gram", "bucket", "total", "deleted"), allowMissingColumns=True)
        return both.repartition("block").sortWithinPartitions("block", "gram", "bucket")

    cells = joined(blocks.filter(F.col("fold") == DELETED), answers.filter(F.col("fold") == DELETED)).mapInArrow(
        _learned_from(left), "bucket int, pair int, word int, n long")
    cells = cells.groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n"))
    learned = cells.groupBy("bucket").applyInPandas(
        lambda key, c: pd.DataFrame([[key[0], *maximise(c, 1 / (distinct + 1))]], columns=["bucket", "pair", "word", "uniform"]),
        "bucket int, pair double, word double, uniform double").collect()  # BUCKETS rows at most
    weights = np.tile([0.5, 0.4, 0.1], (BUCKETS, 1))
    for k in range(BUCKETS):  # a bucket that no deleted token has takes the nearest one below
        weights[k] = next(((r.pair, r.word, r.uniform) for r in learned if r.bucket == k), weights[max(0, k - 1)])
    out = joined(blocks, answers).mapInArrow(_scored(n, distinct, weights), SCORES)
    return out.withColumn("train_tokens", F.lit(n).cast("long"))


def op8_interpolated_scores(spark, sf_dir: str) -> DataFrame:
    out = score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
