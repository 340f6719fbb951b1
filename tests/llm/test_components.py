import random

import pytest

from hourgrid.llm import components as C
from hourgrid.llm.frames import ready


def edges():
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(100, 400)]
    some = [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(200)]
    out = path + some + [(7, 7), (5, 3), (3, 5)] + [(9000, 2000 + i) for i in range(100)]
    rng.shuffle(out)
    return out


def wanted(pairs):
    root = {x: x for pair in pairs if pair[0] != pair[1] for x in pair}
    while True:
        low = {}
        for u, v in pairs:
            if u != v:
                least = min(root[u], root[v])
                low[u], low[v] = min(low.get(u, u), least), min(low.get(v, v), least)
        if low == root:
            return root
        root = low


def found(spark, pairs):
    df = ready(spark).createDataFrame(pairs, "u long, v long").repartition(5)
    rows = [tuple(r) for r in C.components(df).collect()]
    assert len(rows) == len(set(rows))
    return dict(rows)


def test_edges_of_one_block_take_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(C, "_large_star", lambda edges: pytest.fail("a round of shuffles for a few hundred edges"))
    assert found(spark, edges()) == wanted(edges())


def test_blocks_meet_in_stars(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_EDGES", 150)
    assert found(spark, edges()) == wanted(edges())
