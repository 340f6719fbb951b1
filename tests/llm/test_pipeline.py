import random

import pytest

import corpus_pipeline
from hourgrid.llm.frames import ready
from tests.llm import brute
from tests.llm.test_templates import brute as templates


def rows():
    rng = random.Random(8)
    say = lambda n: [rng.choice("abcdefghijklmnopqrst") + rng.choice("aeiou") for _ in range(n)]
    item = say(14)
    out = [(0, None, "s"), (1, "", "s"), (2, "junk " * 50, "t")]
    for i in range(10, 75):
        words = say(rng.randrange(15, 60))
        if i % 9 == 0:
            words += item
        if i % 4 == 0:
            words += ["\nVisit", f"page{i}", "of", "our", "site", "today", "\n"] + say(5)
        text = " ".join(words)
        out.append((i, text, rng.choice(["s", "s", "t", None])))
        if i % 5 == 0:
            out.append((i + 100, text.replace(words[3], "zz", 1), "u"))
            out.append((i + 200, text, "s"))
    return out + [out[9]], [(1, " ".join(item)), (2, None)]


def test_against_plain_python(spark, tmp_path):
    docs, items = rows()
    ready(spark)
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in docs], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    source = {(i, t): s for i, t, s in docs}
    kept = [(i, t) for i, t, _ in docs if brute.quality(t)["kept"]]
    by_doc = dict(docs_of := [(i, source[i, t]) for i, t in kept])
    assert len(by_doc) == len({i for i, _ in docs_of})
    cut = [(r[0], r[1]) for r in templates(kept, 10)]
    assert sum(r[3] for r in templates(kept, 10)) > 5
    near = brute.near_duplicates(cut)
    one = sorted({r for r, (d, _, c) in zip(sorted(cut, key=str), sorted(near, key=str)) if d == c}, key=str)
    clean = [(i, t) for i, t in one if not brute.contamination(t, items)[1]]
    assert len(kept) > len(one) > len(clean) > 20
    targets = brute.mix([(i, by_doc[i], len(t.split())) for i, t in clean])
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    text = dict(clean)
    taken = {}
    for r in got:
        assert text[r.doc_id] == r.text and r.n_chars == len(r.text) and by_doc[r.doc_id] == r.source
        assert r.target == pytest.approx(targets[r.source]) and 1 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, t in targets.items():
        assert abs(taken.get(s, 0) - t) <= 33
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0)
        assert stage(spark, empty, str(tmp_path)).columns == empty.columns


CLASHES = "kept int, n_words string, row long, n_hit int, size string, source_size int, target string, copies int, taken string, __row int, texts int"


def test_columns_of_any_name_stay(spark, tmp_path):
    """Equal ids and texts of two sources, columns named like results, very long and null texts, empty tables."""
    ready(spark)
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice("abcdefghijklmnopqrst") + rng.choice("aeiou") + str(rng.randrange(50)) for _ in range(n))
    texts = [say(40) for _ in range(12)] + [say(60_000), None, ""]
    rows = [(i, t, "en", f"s{i % 3}", 7, 1, "mine", 3, 4, "big", 5, "aim", 6, "got", 8, 9) for i, t in enumerate(texts)]
    rows += [(0, texts[0], "en", "a", 7, 1, "mine", 3, 4, "big", 5, "aim", 6, "got", 8, 9)]
    df = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}")
    spark.createDataFrame([(1, "no such words in any text at all of these here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, df, str(tmp_path)).collect()
        assert got and got[0].__fields__[: len(df.columns)] == df.columns, name
        assert {tuple(r)[5:16] for r in got} == {(1, "mine", 3, 4, "big", 5, "aim", 6, "got", 8, 9)}, name
        assert stage(spark, df.limit(0), str(tmp_path)).columns[: len(df.columns)] == df.columns
        if name == "near_duplicates":
            assert [r.source for r in got if r.doc_id == 0] == ["a"]  # the first by source, on every run
        if name == "mixing":
            assert all(r.mix_copies >= 1 and r.mix_taken == r.mix_copies * r.mix_size for r in got)
            assert stage(spark, df.limit(0), str(tmp_path)).count() == 0
        if name == "quality_rules":
            assert {r.doc_id for r in got} == set(range(13))
