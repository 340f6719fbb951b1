import hashlib
import random

from hourgrid.llm import substring
from hourgrid.llm.frames import ready
from tests.llm import brute


def rows():
    rng = random.Random(2)
    say = lambda n: [rng.choice("abcdefgh") + rng.choice(["", "é", "longer-than-eight"]) for _ in range(n)]
    passages = [say(n) for n in (19, 20, 21, 60)]
    out = [(0, None), (1, ""), (2, " \t"), (3, " ".join(["same"] * 70)), (4, " ".join(["same"] * 19))]
    for i in range(10, 90):
        words = say(rng.randrange(40))
        for _ in range(rng.randrange(3)):
            words += rng.choice(passages) + say(rng.randrange(5))
        out.append((rng.randrange(10_000), "  ".join(words)))
    return out + [(out[20][0], out[20][1]), (None, out[30][1]), (None, out[31][1]), (out[40][0], "other " + (out[40][1] or ""))]


def test_against_plain_python(spark):
    data = rows()
    df = ready(spark).createDataFrame([(*r, 1) for r in data], "doc_id long, text string, n_words int").repartition(5)
    got = substring.remove_repeats(df).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == brute.repeats_removed(data)
    assert substring.remove_repeats(df.limit(0)).count() == 0


def test_query(spark, small_dir):
    got = sorted((tuple(r) for r in substring.op4_remove_repeated_windows(ready(spark), small_dir).collect()), key=str)
    data = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [(d, n, r, hashlib.sha256(k.encode()).hexdigest()) for d, n, r, k in brute.repeats_removed(data)]
    assert got == sorted(want, key=str)


def test_earliest_start_of_rows_without_id(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    texts = [" ".join([*(f"w{n}x{i}" for i in range(n)), passage]) for n in range(12)]
    for some in (texts, texts[3:], texts[5:9]):
        data = [(None, t) for t in some]
        df = ready(spark).createDataFrame(data, "doc_id long, text string").coalesce(1)
        got = {r.kept_text for r in substring.remove_repeats(df).collect() if r.n_removed == 0}
        assert got == {some[0]}
