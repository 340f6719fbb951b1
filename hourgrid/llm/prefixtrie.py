"""The trie of conversation prefixes, from vertical bitmaps.

A turn is the md5 of its role and text; a conversation is a row with its turns' digests in
order. Conversations are dealt by ranges of these rows, so those that begin alike lie side by
side, and a hot beginning is split by what follows it and at last by id. A task works on
blocks of a few thousand of them: it numbers a block's conversations by id, indexes every
(position, turn) as a bitset of them, and walks depth first: the bitset of a node, intersected
with the postings of its lowest member's next turn, is a child; what is left gives the next
child. Popcounts are members, the lowest bit is the smallest member, and the bitset of
conversations that have as many turns as the node is deep is its end list.

Blocks are merged by node (a 128-bit hash of the path). Sums over subtrees add up over blocks,
because each node belongs to exactly one conversation, its smallest member, and what a
conversation owns is the end of its path, from some depth on:

* leaves below a node are those of its members that own a leaf;
* tokens saved below a node are, for each member, the bytes of its turns from the node on that
  it does not own: (members - 1) times the bytes of each node's last text, summed otherwise.

So a first walk finds the depth from which each conversation owns its path, whether it owns a
leaf, and who owns the node above; a second walk with these three gives every column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hourgrid.llm.frames import stored, table

BLOCK_CONVS = 2048
BLOCK_TURNS = 1 << 18
DIGEST = 16
RANGE_TURNS = 8  # of the path in the key that deals the blocks
OWNER = "key binary, parent_key binary, depth int, conv_id long, has_child boolean"
PART = ("key binary, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "turn_digest binary, first_end long, ends binary")
NODE = ("key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "turn_digest binary, ends_sha256 string")


def turn_digest(role: Column, text: Column) -> Column:
    """md5 of a turn in hex digits; the role's length comes first, so no two turns are written alike."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def turn_rows(turns: DataFrame) -> DataFrame:
    """Digest and text bytes of every turn. A null role or text is empty; a turn without ``conv_id`` is in no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), turn_digest(role, text).alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("t"))


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: a conversation's turns (turn, digest, size) in order of ``turn``, null first, equal ones by digest."""
    return turn_rows(turns).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def rebuilt(turns: DataFrame, group: int = 5) -> DataFrame:
    """``paths`` with the first h turns taken from the conversation ``conv_id - conv_id % group``; h is crc32(conv_id) % 9.

    Of a group, one conversation gives its head to the others, so they are dealt together.
    """
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    own = turn_rows(turns).withColumn("base", base).repartition("base").groupBy("base", "conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    groups = own.groupBy("base").agg(
        F.collect_list(F.struct("conv_id", "turns")).alias("all"),  # `group` conversations at most
        F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, 8)), ignorenulls=True).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    none = F.slice("turns", 1, 0)
    return groups.select("head", F.inline("all")).select(
        "conv_id",
        F.concat(F.coalesce(F.when(h > 0, F.slice("head", 1, F.greatest(h, F.lit(1)))), none), F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


def _packed(convs: DataFrame) -> DataFrame:
    """The digests of a path as one binary, the sizes beside it."""
    return convs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"), F.col("turns.size").alias("sizes"))


class Block:
    """Conversations numbered by id, and the postings of their turns."""

    def __init__(self, rows: list[tuple]):
        rows = sorted(rows, key=lambda r: r[0])
        self.ids = [r[0] for r in rows]
        self.paths = [r[1] for r in rows]
        self.lengths = [len(p) // DIGEST for p in self.paths]
        self.sizes = [r[2] for r in rows]
        self.known = [r[3:] for r in rows]  # owned from, owns a leaf, owner above
        self.columns: dict[int, dict[bytes, int]] = {}
        self.ended: dict[int, int] = {}
        for i, n in enumerate(self.lengths):
            self.ended[n] = self.ended.get(n, 0) | 1 << i
        self.all = (1 << len(rows)) - 1

    def turn(self, i: int, depth: int) -> bytes:
        return self.paths[i][DIGEST * (depth - 1) : DIGEST * depth]

    def postings(self, depth: int) -> dict[bytes, int]:
        """For position ``depth``, the bitset of every turn; made when it is first asked for."""
        got = self.columns.get(depth)
        if got is None:
            got = {}
            for i, n in enumerate(self.lengths):
                if n >= depth:
                    turn = self.turn(i, depth)
                    got[turn] = got.get(turn, 0) | 1 << i
            self.columns[depth] = got
        return got

    def children(self, members: int, depth: int) -> list[int]:
        """The bitsets of the nodes below a node at ``depth``."""
        left = members & ~self.ended.get(depth, 0)
        if not left & (left - 1):  # a single conversation goes on alone
            return [left] if left else []
        out, column = [], self.postings(depth + 1)
        while left:
            child = left & column[self.turn(lowest(left), depth + 1)]
            out.append(child)
            left ^= child
        return out

    def walk(self) -> Iterator[tuple[bytes, bytes | None, int, int, list[int], int]]:
        """Nodes, parents first: key, parent's key, depth, members, children, and the row of the parent."""
        stack = [(b"", None, 0, self.all, -1)]
        row = 0
        while stack:
            key, above, depth, members, parent = stack.pop()
            below = self.children(members, depth)
            yield key, above, depth, members, below, parent
            for child in below:
                stack.append((hashlib.blake2b(key + self.turn(lowest(child), depth + 1), digest_size=16).digest(), key, depth + 1, child, row))
            row += 1


def lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def numbers(bits: int) -> np.ndarray:
    """The places of the ones, ascending."""
    data = np.frombuffer(bits.to_bytes((bits.bit_length() + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(data, bitorder="little"))


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str], most: int) -> Iterator[Block]:
    held, turns = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if held and (len(held) == most or turns + len(row[2]) > BLOCK_TURNS):
                yield Block(held)
                held, turns = [], 0
            held.append(row)
            turns += len(row[2])
    if held:
        yield Block(held)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [x.split() for x in ddl.split(", ")]
    cols = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(cols, fields)], names=[n for n, _ in fields])


def _owners(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, ["conv_id", "path", "sizes"], most):
            yield _batch([(key, above, depth, block.ids[lowest(members)], bool(below)) for key, above, depth, members, below, _ in block.walk()], OWNER)

    return run


def _parts(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, ["conv_id", "path", "sizes", "owned_from", "owns_leaf", "above"], most):
            leaves = sum(1 << i for i, (_, leaf, _) in enumerate(block.known) if leaf)
            owned = lambda members, depth: block.known[lowest(members)][0] <= depth  # noqa: E731 - in this block
            rows, saved, parents = [], [], []
            for key, _, depth, members, below, parent in block.walk():
                low = lowest(members)
                mine = owned(members, depth)
                count = members.bit_count()
                ends = members & block.ended.get(depth, 0)
                ended = [block.ids[i] for i in numbers(ends).tolist()] if ends else []
                above = (block.known[low][2] if block.known[low][0] == depth else block.ids[low]) if mine and depth else None
                saved.append((count - mine) * block.sizes[low][depth - 1] if depth else 0)
                parents.append(parent)
                rows.append([key, depth, block.ids[low], above, count, sum(owned(c, depth + 1) for c in below), (members & leaves).bit_count(), 0,
                             block.turn(low, depth) if depth else None, ended[0] if ended else None, ",".join(map(str, ended)).encode() if ended else None])
            for i in range(len(rows) - 1, 0, -1):  # children come after their parents
                saved[parents[i]] += saved[i]
            for row, value in zip(rows, saved):
                row[7] = value
            for at in range(0, len(rows), 8192):
                yield _batch(rows[at : at + 8192], PART)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of equal nodes, that come side by side, end lists in order of their ids."""
    now: list | None = None
    ends, done = hashlib.sha256(), []

    def close() -> None:
        if now is not None:
            done.append((*now[:9], ends.hexdigest()))

    for batch in batches:
        for key, depth, conv, above, *sums, turn, first, ended in zip(*batch.to_pydict().values()):
            if now is None or now[0] != key:
                close()
                now, ends, any_end = [key, conv, depth, above, *sums, turn], hashlib.sha256(), False
            else:
                now[1] = min(now[1], conv)
                now[3] = above if now[3] is None else now[3]
                now[4:8] = [a + b for a, b in zip(now[4:8], sums)]
            if ended is not None:
                ends.update(b"," + ended if any_end else ended)
                any_end = True
        yield _batch(done, NODE)
        done = []
    close()
    yield _batch(done, NODE)


def prefix_trie(convs: DataFrame, block: int = BLOCK_CONVS) -> DataFrame:
    """The nodes of the trie of ``convs (conv_id, turns)``, as ``paths`` or ``rebuilt`` give them.

    A node's ``key`` is that of its path, ``turn_digest`` that of its last turn (the root has
    none). A conversation without turns is a member of the root; an id must not repeat. The
    table may be empty: then there is no node, not even a root. ``block`` is the most
    conversations of a bitset; it does not change a result.
    """
    packed = stored(_packed(convs), "paths")

    def dealt(df: DataFrame) -> DataFrame:
        order = [F.substring("path", 1, DIGEST * RANGE_TURNS), F.col("conv_id")]
        return df.repartitionByRange(*order).sortWithinPartitions("path", "conv_id")

    nodes = stored(dealt(packed).mapInArrow(_owners(block), OWNER).groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("has_child").alias("has_child")), "owners")
    own = nodes.groupBy("conv_id").agg(F.min("depth").alias("owned_from"), F.max(~F.col("has_child")).alias("owns_leaf"),
                                       F.min_by("parent_key", "depth").alias("parent_key"))
    above = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    known = own.join(above, "parent_key", "left").drop("parent_key")
    full = stored(packed.join(known, "conv_id", "left").select(
        *packed.columns, F.coalesce("owned_from", F.lit(1 << 30)).alias("owned_from"), F.coalesce("owns_leaf", F.lit(False)).alias("owns_leaf"), "above"), "known-paths")
    parts = dealt(full).mapInArrow(_parts(block), PART)
    return parts.repartition("key").sortWithinPartitions("key", F.asc_nulls_first("first_end")).mapInArrow(_merged, NODE)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations"))).drop("key", "turn_digest")
