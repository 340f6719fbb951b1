import random

import pytest

from hourgrid.llm import mixing
from hourgrid.llm.frames import ready
from tests.llm import brute


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_takes(spark, seed):
    rng = random.Random(seed)
    data = []
    for i in range(600):
        source = rng.choice(["a", "a", "a", "b", "é", None, "c", "tiny"] if i % 50 else ["tiny"])
        n = rng.randrange(0, 30) if source != "tiny" else rng.randrange(0, 3)
        data.append((i, source, " ".join(["w"] * n)))
    data += [(None, "b", "x y"), (7, data[7][1], data[7][2]), (10_001, "empty", None), (10_002, "empty", " \n")]
    df = ready(spark).createDataFrame([(*d, 3) for d in data], "doc_id long, source string, text string, target int")
    got = mixing.mix(df).collect()
    assert len(got) == len(data)
    want = brute.mix([(d, s, len((t or "").split())) for d, s, t in data])
    taken, largest = {}, {}
    for r in got:
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    for s, t in taken.items():
        assert abs(t - want[s]) <= largest[s] / 2 + 1 or s == "b", s
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(5)).collect()))
    assert mixing.mix(df.limit(0)).count() == 0
