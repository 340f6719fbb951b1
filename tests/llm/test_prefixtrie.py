import hashlib
import random
import zlib

import pytest

from hourgrid.llm import prefixtrie as P
from hourgrid.llm.frames import ready

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_paths(rows):
    """(conv_id, turn, role, text) rows to {conv_id: [(role, text), ...]}; equal turns by digest."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs.setdefault(conv, []).append(((turn is not None, turn or 0, digest), (role, text)))
    return {c: [t for _, t in sorted(x)] for c, x in convs.items()}


def brute_rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    below = {}
    for path in nodes:
        if path:
            below.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        kids = below.get(path, [])
        leaves[path] = sum(leaves[k] for k in kids) if kids else 1
        saved[path] = sum(saved[k] for k in kids) + ((len(nodes[path]) - 1) * len(path[-1][1].encode()) if path else 0)
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(below.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest()) for p, m in nodes.items())


def nodes(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def rows():
    rng = random.Random(8)
    out = []
    for c in [*range(80), 10**12, 10**12 + 1]:
        for t in range(rng.choice([1, 2, 3, 3, 4, 12])):
            out.append((c, t, rng.choice(["user", "user", None]), rng.choice(["hi", "hi", "hi", "ö", "", None, "x" * 50])))
    out += [(c, t, "user", f"same {t}") for c in range(200, 320) for t in range(3)]  # one hot conversation
    out += [(c, t, "assistant", "w" if t < 700 else f"{c}") for c in (400, 401, 402) for t in range(702)]  # deep ones
    out += [(500, None, "b", "first"), (500, 0, "a", "second"), (500, 0, "a", "again"), (500, 0, "a", "again"), (None, 0, "user", "lost")]
    out += [(601, 0, "user", "long " * 200_000), (602, 0, "user", "long " * 200_000)]
    return out


@pytest.mark.parametrize("size", [1, 3, P.BLOCK_CONVS])
def test_trie(spark, size):
    data = rows()
    df = ready(spark).createDataFrame([(*r, "x", 1) for r in data], "conv_id long, turn long, role string, text string, path string, depth int")
    assert nodes(P.prefix_trie(P.paths(df), size)) == brute(brute_paths(data))  # also where nodes run over many blocks
    assert P.prefix_trie(P.paths(df.limit(0)), size).count() == 0


def test_rebuilt(spark):
    data = rows() + [(7_003, t, "user", f"{t}") for t in range(3)] + [(7_001, 0, "user", "lone")]  # their 7,000 is absent
    df = ready(spark).createDataFrame(data, "conv_id long, turn long, role string, text string")
    want = brute_rebuilt(brute_paths(data))
    assert any(not x for x in want.values())  # a conversation without turns
    assert nodes(P.prefix_trie(P.rebuilt(df), 7)) == brute(want)


def test_query(spark, small_dir):
    data = [tuple(r) for r in spark.read.parquet(f"{small_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(P.op12_prefix_trie(ready(spark), small_dir)) == brute(brute_rebuilt(brute_paths(data)))
