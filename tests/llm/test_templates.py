import random
import re

from hourgrid.llm import templates
from hourgrid.llm.frames import ready


def brute(rows, min_docs):
    """Sorted (doc_id, text, n_lines, n_dropped)."""
    big = 1 << 62
    lines, leaves = {}, {}
    for nth, (doc, text) in enumerate(rows):
        if text is None:
            continue
        key = (big if doc is None else doc, text)
        for at, line in enumerate(text.split("\n")):
            tokens = ["<*>" if re.search("[0-9]", t) else t for t in re.findall(r"[^\x20\x09-\x0D]+", line)]
            if tokens:
                lines[(*key, at)] = tuple(tokens)
                leaves.setdefault((len(tokens), *tokens[:3]), {}).setdefault(tuple(tokens), []).append((nth, at))
    import hashlib

    md5 = lambda t: hashlib.md5(" ".join(t).encode()).hexdigest()
    where = {}
    for place, tokens in lines.items():
        found = leaves[(len(tokens), *tokens[:3])]
        if sum(map(len, found.values())) < min_docs:
            continue
        top = max(found, key=lambda t: (len(found[t]), md5(t)))
        alike = sum(a == b for a, b in zip(tokens, top)) * 100 >= 70 * len(tokens)
        where.setdefault(top if alike else tokens, []).append(place)
    gone = set()
    for places in where.values():
        if len({p[:2] for p in places}) >= min_docs:
            gone |= set(places) - {min(places, key=lambda p: (p[0], hashlib.md5(p[1].encode()).hexdigest(), p[2]))}
    out = []
    for doc, text in rows:
        if text is None:
            out.append((doc, None, 0, 0))
            continue
        kept = [x for at, x in enumerate(text.split("\n")) if (big if doc is None else doc, text, at) not in gone]
        n = text.count("\n") + 1
        out.append((doc, "\n".join(kept), n, n - len(kept)))
    return sorted(out, key=str)


def rows():
    rng = random.Random(4)
    say = lambda n: " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(n))
    out = [(0, None), (1, ""), (2, "\n \n"), (3, "w" * 50_000)]
    for i in range(10, 70):
        body = [say(rng.randrange(1, 12)) for _ in range(rng.randrange(5))]
        if rng.random() < 0.6:
            body.append(f"user id={i} logged in from {rng.choice(['home', 'work'])} at 1{i}:00 today")
        if rng.random() < 0.5:
            body.append("  All rights   reserved\t.")
        rng.shuffle(body)
        out.append((i, "\n".join(body)))
    return out + [(out[20][0], out[20][1]), (None, out[30][1]), (out[25][0], "All rights reserved ."), (None, None)]


def test_against_plain_python(spark):
    data = rows()
    df = ready(spark).createDataFrame([(*r, "é") for r in data], "doc_id long, text string, n_dropped string")
    got = templates.drop_recurring_lines(df, 10).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=str) == brute(data, 10)
    assert sum(r.n_dropped for r in got) > 30
    assert templates.drop_recurring_lines(df.limit(0)).count() == 0


def left(spark, lines):
    """The lines that stay of documents of one line each."""
    df = ready(spark).createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(4)
    return sorted(r.text for r in templates.drop_recurring_lines(df, 10).collect() if r.text)


def word(i):
    return "".join(chr(97 + int(c)) for c in str(i))


def test_several_templates_of_a_leaf(spark):
    news, friend = "Read more from the daily newsletter", "Read more from our friend "
    assert left(spark, [friend + word(i) for i in range(1000)] + [news] * 20) == sorted([friend + word(0), news])
    # no line is more frequent than the others, and the first template does not recur
    other = [f"Read more from {word(i)} x{word(i)} y{word(i)}" for i in range(30)]
    assert left(spark, [friend + word(i) for i in range(50)] + other) == sorted([friend + word(0), *other])


def test_lines_alike_to_a_further_template(spark):
    """Field values that are frequent because of another template."""
    top = ["a b c d e f g h i j"] * 60
    one = [f"a b c k l m n o {word(i)} p" for i in range(40)]
    two = [f"a b c q r s t {word(i)} paris u" for i in range(50)]
    paris = ["a b c k l m n o paris p"] * 3
    assert left(spark, top + one + two + paris) == sorted([top[0], one[0], two[0]])
    assert left(spark, top + one[:8] + ["a b c q r s t u v w"] * 9) == sorted([top[0], *one[:8], *["a b c q r s t u v w"] * 9])
