import random

from hourgrid.llm import quality
from hourgrid.llm.frames import ready
from tests.llm import brute


def texts():
    rng = random.Random(7)
    out = [None, "", " \n\t", "one", "a b c\n" * 30, "x " * 300, "é ü\x0b#|é\n\n\né ü"]
    for _ in range(40):
        words = [rng.choice(["the", "a", "ünder", "b", "longerwordthaneight", "c#", "d"]) for _ in range(rng.randrange(1, 120))]
        if rng.random() < 0.5:
            words += words[3:30] + ["z"] + words[1:20]
        out.append("".join(w + rng.choice([" ", " ", "\n", "\t "]) for w in words))
    return out + out[:3]


def test_against_plain_python(spark):
    rows = [(i, t, 5) for i, t in enumerate(texts())] + [(None, "no id " * 9, None)]
    df = ready(spark).createDataFrame(rows, "doc_id long, text string, n_words int")
    got = quality.quality_rules(df).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute.quality(r.text)
        assert {k: r[k] for k in want} == want, r.doc_id
        assert sum(s.length for s in r.repeat_spans) == r.n_repeat_words
    assert quality.quality_rules(df.limit(0)).count() == 0


def test_query(spark, small_dir):
    got = {r.doc_id: r for r in quality.op10_quality_rules(ready(spark), small_dir).collect()}
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs[:40]:
        if len(d.text.split()) < 400:
            want = brute.quality(d.text)
            assert {k: got[d.doc_id][k] for k in want} == want
