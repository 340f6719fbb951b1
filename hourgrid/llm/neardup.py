"""MinHash near-duplicates from bottom-k sketches of one hash function.

1. One pass hashes the word shingles of every text once. The ``SKETCH`` smallest hashes of a
   set are its sketch; two 64-bit sums over the set are its signature. Equal sets are one
   class, so copies, however many, become one row (summed map-side).
2. Inverted lists of retained values. Two linked sets have many retained values in common, so
   in one global order of the values, rarest first, they share one of the first few of each
   (a prefix filter): only those values open lists. A frequent passage is in no list of a set
   unless the set is little else, and a set without company is in none.
3. Candidates of a list are first its smallest class against all others (a star). Survivors of
   the union-sketch estimate are verified on the full sets, and components are taken. A group
   of near copies, however large, costs a star.
4. What a list then still holds of several components is compared inside tasks, as a grid of
   tiles of bounded size: first sketches, which leave a forest of the estimate's survivors,
   then, within the trees of that forest, the full sets, which leave a forest of links. Pairs
   are never rows of a table; what leaves a task is less than one row a member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hourgrid.llm import words as W
from hourgrid.llm.components import components
from hourgrid.llm.frames import row_key, stored, table

NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
SHINGLE = 5
SKETCH = 80
#: Of the SKETCH smallest values of a union at 0.75 fewer than COMMON are in both sets with a chance of 3e-9.
COMMON = 36
#: Members of a list, and shingles of a group, in one block of a grid; a tile is two blocks, a few
#: megabytes of sketches or sets. A row goes to as many tiles as its list has blocks.
BLOCK_MEMBERS = 4096
BLOCK_SHINGLES = 200_000


def shingle_sets(col: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the row offsets into them; repeats are not removed yet."""
    data, offs = W.flat(col)
    data = W.LOWER[data]
    start, end, wo = W.split_words(data, offs)
    h = W.hash_words(data, start, end)
    count = np.diff(wo)
    shingles = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    so = np.concatenate([[0], np.cumsum(shingles)])
    out = np.zeros(int(so[-1]), np.uint64)
    at = W.inside(wo, size)
    row = np.searchsorted(wo, at, "right") - 1
    out[so[row] + at - wo[row]] = W.windows(h, size)[at]
    for n in range(1, size):  # texts of fewer words: the whole sequence
        rows = np.flatnonzero(count == n)
        if len(rows):
            out[so[rows]] = W.windows(h, n)[wo[rows]]
    return out, so


def _unique(part: np.ndarray) -> np.ndarray:
    part = np.sort(part)
    return part[np.concatenate([[True], part[1:] != part[:-1]])] if len(part) else part


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in W.text_chunks(batch, "text"):
            all_, so = shingle_sets(chunk.column("text"))
            sets = [_unique(all_[a:b]) for a, b in zip(so[:-1], so[1:])]
            sizes = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            first = np.concatenate([[0], np.cumsum(sizes)])
            sums = []
            for lane in (0, 1):
                mixed = W.pair(flat, np.full(len(flat), W.SEEDS[lane]))
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed)])
                sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            sketch = [s[:SKETCH] for s in sets]
            so = np.concatenate([[0], np.cumsum([len(s) for s in sketch])]).astype(np.int32)
            values = (np.concatenate(sketch) if sketch else np.zeros(0, np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("row"), pa.array(sizes), pa.array(sums[0]), pa.array(sums[1]),
                 pa.ListArray.from_arrays(pa.array(so), pa.array(values))],
                names=["doc_id", "row", "n", "sig_a", "sig_b", "sketch"])


def prefixes(classes: DataFrame) -> DataFrame:
    """``c, n, sketch`` with only the values of each sketch that open lists, rarest first.

    Let ``need`` be the values that the sketches of a linked pair share at least. Wholly retained
    sets share three quarters of the larger one; with a partner of up to n / 0.75 shingles, cut
    at ``SKETCH``, it is ``SKETCH - n / 3``; two cut sketches share ``COMMON``. The first shared
    value, in any order of all values, is then among the first ``k - need + 1`` of either.
    Values of one class only are first in that order, open no list and are never shuffled back.
    """
    values = classes.select("c", "n", F.explode("sketch").alias("value"))
    counts = values.groupBy("value").agg(F.count("*").alias("m")).filter("m > 1")
    n = F.col("n")
    whole = F.least(F.floor((3 * n + 3) / 4), SKETCH - F.floor(n / 3))
    need = F.when(n <= SKETCH, whole).otherwise(COMMON).cast("int")
    shared = values.join(counts, "value").groupBy("c", "n").agg(F.sort_array(F.collect_list(F.struct("m", "value"))).alias("shared"))
    first = F.size("shared") - need + 1  # the values of this class alone stand before
    return shared.filter(first > 0).select("c", "n", F.slice(F.col("shared.value"), F.lit(1), first).alias("sketch"))


def _matrix(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sketches as rows of one matrix, filled up with the largest value, which no sketch holds twice."""
    out = np.full((len(offs) - 1, SKETCH), NONE)
    size = np.diff(offs)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(offs[:-1], size)] = values
    return out


def union_estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard by the ``SKETCH`` smallest values of each union; rows of ``a`` and ``b`` are sketches."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    new = np.ones(both.shape, bool)
    new[:, 1:] = both[:, 1:] != both[:, :-1]
    real = both != NONE
    low = np.cumsum(new, axis=1) <= SKETCH
    return (~new & low & real).sum(axis=1) / np.maximum(1, (new & low & real).sum(axis=1))


def _ragged(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values, as unsigned numbers, and offsets of a column of lists."""
    return col.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())])


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1 << 12):
            part = batch.slice(at, 1 << 12)
            got = union_estimates(_matrix(*_ragged(part.column("a_sketch"))), _matrix(*_ragged(part.column("b_sketch"))))
            yield part.select(["a", "b"]).filter(pa.array(got >= COMMON / SKETCH))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in W.text_chunks(batch, "a_text"):
            a, ao = shingle_sets(chunk.column("a_text"))
            b, bo = shingle_sets(chunk.column("b_text"))
            keep = []
            for i in range(chunk.num_rows):
                x, y = _unique(a[ao[i] : ao[i + 1]]), _unique(b[bo[i] : bo[i + 1]])
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield chunk.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _links(pairs: DataFrame, classes: DataFrame, texts: DataFrame, label: str) -> DataFrame:
    """The pairs (``a, b``) of classes that are links, ``u, v``."""
    a = classes.select(F.col("c").alias("a"), F.col("sketch").alias("a_sketch"))
    b = classes.select(F.col("c").alias("b"), F.col("sketch").alias("b_sketch"))
    near = stored(pairs.join(a, "a").join(b, "b").mapInArrow(_estimated, "a long, b long"), f"{label}-estimated")
    wanted = near.select(F.col("a").alias("c")).union(near.select("b")).distinct()
    rows = wanted.join(classes.select("c", "row"), "c")
    full = stored(texts.join(rows, "row").dropDuplicates(["c"]).select("c", "text"), f"{label}-texts")
    a = full.select(F.col("c").alias("a"), F.col("text").alias("a_text"))
    b = full.select(F.col("c").alias("b"), F.col("text").alias("b_text"))
    done = near.join(a, "a").join(b, "b").select("a", "b", "a_text", "b_text").mapInArrow(_verified, "a long, b long")
    return stored(done.select(F.col("a").alias("u"), F.col("b").alias("v")), f"{label}-links")


def _lists(classes: DataFrame) -> DataFrame:
    """Postings ``key, c, n`` of the lists of two classes and more, with the head ``a, a_n`` and length ``m``.

    Head and length are combined map-side, so a key of very many classes is one row a task; the
    join back is one that adaptive execution can split.
    """
    postings = classes.select("c", "n", F.explode(F.array_distinct("sketch")).alias("key"))
    heads = postings.groupBy("key").agg(F.min(F.struct("c", "n")).alias("head"), F.count("*").alias("m")).filter("m > 1")
    return postings.join(heads, "key").select("key", "c", "n", F.col("head.c").alias("a"), F.col("head.n").alias("a_n"), "m")


def forest(values: np.ndarray, offs: np.ndarray, root: np.ndarray, group: np.ndarray, passes) -> list[tuple[int, int]]:
    """Pairs of rows of different ``root`` that connect what ``group`` holds apart; each row's values are unique.

    ``passes(a, rows, common)`` says which ``rows`` go with row ``a``, given how many values they
    have in common. A pair of different roots is left out only where the groups given and the
    pairs returned connect its rows already, so connectedness is that of all pairs. Rows of the
    commonest root need no turn of their own: they are compared with all others in the others' turns.
    """
    _, ids, times = np.unique(values, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    held = times[ids] > 1
    own = np.concatenate([[0], np.cumsum(held)])[offs]
    ids, row = ids[held], row[held]
    by_value = row[np.argsort(ids, kind="stable")]
    ends = np.cumsum(np.where(times > 1, times, 0))
    _, root, sizes = np.unique(root, return_inverse=True, return_counts=True)
    turns = np.flatnonzero(root != np.argmax(sizes))
    out, group = [], group.copy()
    for a in turns:
        if (group == group[a]).all():
            break
        mine = ids[own[a] : own[a + 1]]
        size = times[mine]
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        common = np.bincount(by_value[np.repeat(ends[mine] - size, size) + inner], minlength=len(group))
        rows = np.flatnonzero((common > 0) & (root != root[a]) & (group != group[a]))
        rows = rows[passes(a, rows, common[rows])] if len(rows) else rows
        for b in rows[np.unique(group[rows], return_index=True)[1]]:
            out.append((int(a), int(b)))
        group[np.isin(group, group[rows])] = group[a]
    return out


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one ``key, lo, hi`` each, from rows sorted by them."""
    held, now = [], None
    for batch in batches:
        ids = np.stack([batch.column(c).to_numpy() for c in ("key", "lo", "hi")], axis=1)
        cuts = np.concatenate([[0], np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1, [len(ids)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and tuple(ids[a]) != now:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            now = tuple(ids[a])
    if held:
        yield pa.Table.from_batches(held)


def _fits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(a, b) >= 75 * np.maximum(a, b)


def _edges(tile: pa.Table, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    c = tile.column("c").to_numpy()
    u, v = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(c[u]), pa.array(c[v])], names=["u", "v"])


def _sketch_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tile in _tiles(batches):
        root, n = tile.column("root").to_numpy(), tile.column("n").to_numpy()
        if (root == root[0]).all():
            continue
        values, offs = _ragged(tile.column("sketch").combine_chunks())
        rows = _matrix(values, offs)

        def passes(a, others, common):
            size = np.diff(offs)
            # what is in both sketches bounds what the estimate can count
            near = _fits(n[a], n[others]) & (SKETCH * common >= COMMON * np.minimum(SKETCH, size[a] + size[others] - common))
            near[near] = union_estimates(np.repeat(rows[a : a + 1], near.sum(), axis=0), rows[others[near]]) >= COMMON / SKETCH
            return near

        # a member of a component may pass where another does not: only pairs tie rows here
        yield _edges(tile, forest(values, offs, root, np.arange(len(n)), passes))


def _set_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tile in _tiles(batches):
        root, n = tile.column("root").to_numpy(), tile.column("n").to_numpy()
        if (root == root[0]).all():
            continue
        all_, offs = shingle_sets(tile.column("text").combine_chunks())
        sets = [_unique(all_[a:b]) for a, b in zip(offs[:-1], offs[1:])]
        offs = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        yield _edges(tile, forest(np.concatenate(sets), offs, root, root, lambda a, b, common: 100 * common >= 75 * (n[a] + n[b] - common)))


def _dealt(rows: DataFrame, blocks: "F.Column") -> DataFrame:
    """``rows`` with ``key, c`` dealt over the tiles ``lo, hi`` of a grid of ``blocks`` by ``blocks`` a key."""
    at = F.pmod(F.xxhash64("c"), blocks)
    out = rows.withColumn("at", at).withColumn("to", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return out.withColumn("lo", F.least("at", "to")).withColumn("hi", F.greatest("at", "to")).drop("at", "to")


def _compared(rows: DataFrame, compare) -> DataFrame:
    return rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(compare, "u long, v long").distinct()


def _spread(lists: DataFrame) -> DataFrame:
    """Of ``key, c, n, root`` the lists that span several components, with their length ``m``;
    of lists with the same members one."""
    wide = lists.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m"),
                                    *[F.bit_xor(F.xxhash64("c", F.lit(i))).alias(f"members_{i}") for i in (0, 1)]).filter("lo <> hi")
    return lists.join(wide.groupBy("members_0", "members_1", "m").agg(F.min("key").alias("key")).select("key", "m"), "key")


def _crossing(lists: DataFrame, label: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``u, v`` that join what ``label`` holds apart; a list's head has been compared with all of it."""
    named = lambda df: df.join(label.select(F.col("node").alias("c"), "root"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    open_ = _spread(named(lists.filter((F.col("m") > 2) & (F.col("c") != F.col("a"))).select("key", "c", "n")))
    tiles = _dealt(open_, F.ceil(F.col("m") / BLOCK_MEMBERS)).select("key", "lo", "hi", "c", "n", "root")
    near = components(stored(_compared(tiles.join(classes.select("c", "sketch"), "c"), _sketch_tiles), "cross-estimated"))
    near = named(near.select(F.col("node").alias("c"), F.col("root").alias("key")).join(classes.select("c", "n", "row"), "c"))
    size = near.groupBy("key").agg(F.sum("n").alias("size"))
    full = stored(texts.join(near.join(size, "key"), "row").dropDuplicates(["c"]).select("key", "size", "c", "n", "root", "text"), "cross-texts")
    tiles = _dealt(full, F.ceil(F.col("size") / BLOCK_SHINGLES)).select("key", "lo", "hi", "c", "n", "root", "text")
    return stored(_compared(tiles, _set_tiles), "cross-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row, n_shingles, component_id, kept`` for every row of ``docs``; ``row`` is its ``row_key``.

    Texts without words and null texts have no shingles, form no class and are kept. Equal rows
    share their component; the component's id is its smallest id that is not null. ``kept`` is
    null-safe equality of id and component, so repeated rows of the kept document stay.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = texts.withColumn("row", row_key("doc_id", "text"))
    rows = stored(texts.mapInArrow(_sketches, "doc_id long, row long, n long, sig_a long, sig_b long, sketch array<long>"), "sketches")
    some = rows.filter("n > 0")
    classes = stored(
        some.groupBy("sig_a", "sig_b", "n").agg(F.min("doc_id").alias("least"), F.first("row").alias("row"), F.first("sketch").alias("sketch"))
        .withColumn("c", F.monotonically_increasing_id()), "classes")
    lists = stored(_lists(prefixes(classes)), "lists")
    fits = lambda x, y: 100 * F.least(x, y) >= 75 * F.greatest(x, y)
    star = lists.filter((F.col("c") != F.col("a")) & fits(F.col("n"), F.col("a_n"))).select("a", F.col("c").alias("b")).distinct()
    texts = texts.select("row", "text")
    links = _links(star, classes, texts, "star")
    label = components(links)
    more = _crossing(lists, label, classes, texts)
    label = components(links.union(more))
    named = classes.select("sig_a", "sig_b", F.col("n"), "c", "least").join(
        label.select(F.col("node").alias("c"), "root"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("sig_a", "sig_b", "n", "component_id")
    out = rows.select("doc_id", "row", "sig_a", "sig_b", "n").join(named, ["sig_a", "sig_b", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "row", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def op6_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("row")
