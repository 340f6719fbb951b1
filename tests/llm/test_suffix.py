import random

from hourgrid.llm import suffix
from hourgrid.llm.frames import ready
from tests.llm import brute


def rows():
    rng = random.Random(6)
    say = lambda n: "".join(rng.choice("abcdefghij éü") for _ in range(n))
    passages = [say(n) for n in (360, 372, 380, 400, 420, 480, 700, 1500)]
    out = [(0, None), (1, ""), (2, "a" * 399), (3, "a" * 400), (4, "b" * 401), (5, "c" * 3000), (6, "ab" * 700), (7, "\x00" * 450), (8, "c" * 410)]
    for i in range(10, 70):
        text = say(rng.randrange(300))
        for _ in range(rng.randrange(3)):
            passage = rng.choice(passages)
            cut = rng.randrange(60)
            text += passage[cut if rng.random() < 0.3 else 0 : len(passage) - (cut if rng.random() < 0.3 else 0)] + say(rng.randrange(80))
        out.append((i, text))
    out += [(80, "Un " * 300 + say(30) + "euxçç " * 90), (81, "x" + "Un " * 200), (82, passages[5] + passages[5])]
    return out + [(out[20][0], out[20][1]), (None, out[30][1]), (None, say(500))]


def test_against_plain_python(spark):
    data = rows()
    df = ready(spark).createDataFrame([(*r, 1) for r in data], "doc_id long, text string, n_bytes int").repartition(4)
    got = suffix.remove_repeated_bytes(df).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str)
    want = brute.bytes_removed(data)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert got == want
    assert suffix.remove_repeated_bytes(df.limit(0)).count() == 0


def test_query(spark, small_dir):
    import hashlib

    got = sorted((tuple(r) for r in suffix.op9_remove_repeated_bytes(ready(spark), small_dir).collect()), key=str)
    data = [tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*w[:4], hashlib.sha256(w[4]).hexdigest()) for w in brute.bytes_removed(data)]
    assert got == sorted(want, key=str)
