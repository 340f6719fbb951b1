import random

from hourgrid.llm import decontaminate
from hourgrid.llm.frames import ready
from tests.llm import brute


def test_against_plain_python(spark, monkeypatch):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice("Alpha beta gamma1 délta e".split()) for _ in range(n))
    items = [(i, say(rng.choice([0, 1, 2, 9, 10, 11, 25]))) for i in range(30)] + [(3, "beta  beta"), (None, "sole item"), (40, None)]
    items += [(41, items[5][1]), (42, "only e5 here, and eight more words follow in it yes")]
    docs = [(i, say(rng.randrange(60))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, "..."), (103, f"x {items[42 % 30][1]}, ONLY E5 HERE and-eight more words follow in it yes sole item"), (103, "sole item")]
    ready(spark)
    b = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, n_hit int")
    want = sorted((str(i), *brute.contamination(t, [("null" if k is None else k, x) for k, x in items])) for i, t in docs)
    for size in (1 << 24, 200):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        got = decontaminate.find_contamination(d, b).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.item_ids) for r in got) == want
        for r in got:
            assert (r.longest_match > 0) == (r.n_hit > 0) and r.longest_match <= r.n_hit
    assert decontaminate.find_contamination(d, b.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.find_contamination(d.limit(0), b).count() == 0


def test_query(spark, small_dir):
    got = {r.doc_id: r for r in decontaminate.op7_decontaminate(ready(spark), small_dir).collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert sum(r.contaminated for r in got.values()) > 0
    docs = sorted(spark.read.parquet(f"{small_dir}/documents.parquet").collect(), key=lambda d: (not got[d.doc_id].contaminated, len(d.text)))
    for d in docs[:25]:
        r = got[d.doc_id]
        n, hit, found = brute.contamination(d.text, items)
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(found))
