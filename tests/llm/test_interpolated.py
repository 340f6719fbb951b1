import random

import numpy as np
import pandas as pd
import pytest

from hourgrid.llm import interpolated
from hourgrid.llm.frames import ready
from tests.llm import brute


def rows():
    rng = random.Random(9)
    out = [(0, None), (1, ""), (2, "ONE word"), (3, "start end"), (None, "no id")]
    nexts = {w: rng.choices("abcdefgh", k=3) for w in "abcdefgh"}
    for i in range(10, 300):
        w, words = "a", []
        for _ in range(rng.randrange(1, 60)):
            w = rng.choice(nexts[w]) if rng.random() < 0.9 else rng.choice("abcdefghXYZ").lower()
            words.append(w if rng.random() < 0.98 else f"rare{i}")
            w = w if w in nexts else "a"
        out.append((i, " ".join(words)))
    return out + [out[20], out[20]]


def test_counts_base_and_scores(spark, monkeypatch):
    data = rows()
    monkeypatch.setattr(interpolated, "BLOCK_TOKENS", 700)
    used = {}
    keep = interpolated._scored
    monkeypatch.setattr(interpolated, "_scored", lambda n, v, w: used.update(w=w) or keep(n, v, w))
    df = ready(spark).createDataFrame([(*r, 1.0) for r in data], "doc_id long, text string, score double").repartition(3)
    got = sorted(interpolated.score(df).collect(), key=lambda r: (str(r.doc_id), r.base_score))
    base, scores = brute.interpolated(data)
    want = sorted(zip(base, scores(used["w"])), key=lambda x: (str(x[0][0]), x[0][5]))
    assert len(got) == len(want)
    for r, (b, s) in zip(got, want):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == b[:5]
        assert r.base_score == pytest.approx(b[5]) and r.score == pytest.approx(s)
    # held-out texts are predicted better than by the base
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert interpolated.score(df.limit(0)).count() == 0
    only = interpolated.score(df.filter("doc_id = 10")).collect()
    assert len(only) == 1 and np.isfinite(only[0].score)


def test_em_finds_the_mixture():
    cells = pd.DataFrame({"pair": [-8, -24], "word": [-40, -8], "n": [70, 30]})
    a, g, u = interpolated.maximise(cells, 1e-6)
    p = lambda w: 70 * np.log(w[0] * 0.5 + w[1] * 2**-5 + w[2] * 1e-6) + 30 * np.log(w[0] * 0.125 + w[1] * 0.5 + w[2] * 1e-6)
    best = max((p((x, 1 - x, 0)) for x in np.linspace(0, 1, 2001)))
    assert p((a, g, u)) == pytest.approx(best, abs=1e-4)


def test_a_batch_of_blocks_is_scored_in_little_memory():
    """Blocks one at a time, and their counts spread over a few texts' tokens at a time; the same sums as all at once."""
    import tracemalloc

    import pyarrow as pa

    from hourgrid.llm.packing import narrow, small

    rng = np.random.default_rng(3)
    sizes = rng.integers(0, 900, 1000)
    dictionary = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    numbers = rng.integers(0, len(dictionary), int(sizes.sum())).astype("<u4")
    tokens = interpolated.Tokens(narrow(sizes), dictionary.tobytes(), numbers.tobytes())
    counts = [np.arange(len(k)) % 7 for k in (tokens.words, tokens.pairs)]
    answers = [{"block": 1, "gram": g, "total": small(x), "deleted": None} for g, c in zip((1, 2), counts) for x in np.array_split(c, 3)]
    row = {"block": 1, "fold": 2, "ids": np.arange(1000).astype("<i8").tobytes(), "known_ids": np.packbits(np.ones(1000, bool)).tobytes(), "sizes": narrow(sizes),
           "dictionary": dictionary.tobytes(), "numbers": numbers.tobytes()}
    schema = pa.schema([(k, {"block": pa.int64(), "fold": pa.int32(), "gram": pa.int32()}.get(k, pa.binary())) for k in (*row, "gram", "total", "deleted")])
    n, size = 3, len(tokens.word)
    batch = pa.RecordBatch.from_pylist([row, *answers] * n, schema)
    weights = np.tile([0.5, 0.4, 0.1], (interpolated.BUCKETS, 1))
    tracemalloc.start()
    got = [(len(out), out.column("doc_id").to_numpy(), out.column("score").to_numpy()) for out in interpolated._scored(size, 5000, weights)(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 130 * size  # bytes a token; 194 with the counts of whole blocks spread out at once
    assert np.concatenate([i for _, i, _ in got]).tolist() == list(range(1000)) * n
    # the same sums over the whole block
    pair, context, word = counts[1][tokens.pair], counts[0][tokens.place][tokens.context], counts[0][tokens.place][tokens.word]
    p = 0.5 * np.divide(pair, context, out=np.zeros(size), where=context > 0) + 0.4 * word / size + 0.1 / 5001
    whole = np.add.reduceat(np.log10(np.where(context > 0, p, p / 0.5)), tokens.first)
    assert np.allclose(np.concatenate([s for _, _, s in got]), np.tile(whole, n))
