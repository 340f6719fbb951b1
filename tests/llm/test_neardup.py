import random

import numpy as np
import pytest

from hourgrid.llm import neardup
from hourgrid.llm.frames import ready
from tests.llm import brute


def rows():
    rng = random.Random(11)
    say = lambda n: [rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("aeiou") for _ in range(n)]
    out, passage = [(0, None), (1, ""), (2, "  \n"), (3, "One two"), (4, "one TWO"), (5, "one two three four five")], say(30)
    for i in range(10, 60):
        words = say(rng.randrange(1, 300))
        if rng.random() < 0.4:
            words = passage + words[:40]
        for copy in range(rng.randrange(1, 5)):
            near = [w if rng.random() > 0.02 * copy else "changed" for w in words]
            out.append((1000 * copy + i, " ".join(near)))
    group = say(80)
    for i in range(60):  # a long chain: neighbours are near, the ends are not
        group = [w for w in group]
        group[rng.randrange(80)] = say(1)[0]
        out.append((5000 + i, " ".join(group)))
    return out + [(out[20][0], out[20][1]), (None, out[30][1]), (None, "nothing like it at all here")]


def test_against_all_pairs(spark):
    data = rows()
    df = ready(spark).createDataFrame([(*r, 1) for r in data], "doc_id long, text string, kept int")
    got = neardup.near_duplicates(df).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute.near_duplicates(data)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_query(spark, small_dir):
    got = neardup.op6_near_duplicates(ready(spark), small_dir).collect()
    data = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute.near_duplicates(data)


def test_lists_are_combined_before_the_shuffle(spark):
    classes = ready(spark).createDataFrame([(i, 10 + i, [7, 7, 100 + i]) for i in range(5)], "c long, n long, sketch array<int>")
    got = neardup._lists(classes)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.a, r.a_n, r.m) for r in got.collect()} == {(0, 10, 5)}
    assert sorted(r.c for r in got.select("key", "c").distinct().collect()) == list(range(5))


def _check(spark, data):
    got = neardup.near_duplicates(ready(spark).createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute.near_duplicates(data)


def test_grids_of_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 3)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 500)
    _check(spark, rows())


@pytest.mark.parametrize("length", [70, 300])
def test_large_group_below_the_limit(spark, length):
    """Most pairs have a Jaccard of 0.5 to 0.74; every tenth member is a near copy of another one."""
    rng = random.Random(length)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    data = []
    for i in range(600):
        words = list(base)
        for _ in range(max(2, length // 35)):
            words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        data.append((i, " ".join(words)))
        if i % 10 == 0:
            data.append((10_000 + i, " ".join([*words, "more"])))
    _check(spark, data)


@pytest.mark.parametrize("tied", [True, False])
def test_forest_connects_what_all_pairs_connect(tied):
    rng = np.random.default_rng(3)
    for _ in range(50):
        sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30))).astype(np.uint64) for _ in range(30)]
        root = rng.integers(0, 12, 30)
        group = root if tied else np.arange(30)
        offs = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        least = rng.integers(1, 15)

        def connected(pairs):
            out = group.copy()
            for a, b in pairs:
                out[out == out[b]] = out[a]
            return [set(np.flatnonzero(out == x)) for x in dict.fromkeys(out.tolist())]

        every = [(a, b) for a in range(30) for b in range(a) if root[a] != root[b] and len(np.intersect1d(sets[a], sets[b])) >= least]
        got = neardup.forest(np.concatenate(sets), offs, root, group, lambda a, b, common: common >= least)
        assert {tuple(sorted(x)) for x in got} <= {tuple(sorted(x)) for x in every} and len(got) < 30
        assert connected(got) == connected(every)
