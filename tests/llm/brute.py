"""Plain Python versions of the operators, for small tables only."""

import re
from collections import Counter

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def quality(text):
    words = SPACED.findall(text or "")
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    longest = 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            k = 0
            while j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
    longest = longest if longest >= 8 else 0
    n = len(words)
    failed = n < 20 or 100 * len(hit) > 30 * n
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit), "base_failed": failed,
        "longest_repeat": longest, "kept": not failed and 100 * len(hit) <= 25 * n and longest <= 200,
    }


def chat(rows):
    """(conv_id, turn, role, text) rows to the digests of the chat contract; texts without control strings."""
    import hashlib
    from itertools import groupby

    key = lambda r: (r[0] is not None, r[0] or 0)
    order = lambda r: (*key(r), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    out = {}
    for _, group in groupby(sorted(rows, key=order), key=key):
        turns = [(r[0], r[2] or "", r[3] or "") for r in group]
        loss = "".join(t for _, r, t in turns if r == "assistant")
        esc = lambda s: s.replace("\\", "\\\\").replace("<|", "<\\|")
        chars = sum(len(f"<|im_start|>{esc(r).replace(chr(10), chr(92) + chr(10))}\n{esc(t)}<|im_end|>\n") for _, r, t in turns)
        out[turns[0][0]] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


def mix(rows, weights=(5, 2, 1), most=3.0):
    """(doc_id, source, size) rows to {source: target} by repeated resharing."""
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, cut = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in cut]
        left = total - sum(cut.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return cut | share
        cut |= {s: most * sizes[s] for s in above}


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contamination(text, items, window=10):
    """n_words, n_hit, sorted item ids."""
    words = ALNUM.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item_id, item in items:
        other = ALNUM.findall((item or "").translate(LOWER))
        n = min(window, len(other))
        for i in range(len(other) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == other[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(item_id))
    return len(words), len(hit), sorted(found)


def shingles(text, size=5):
    words = SPACED.findall((text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_duplicates(rows):
    """(doc_id, text) rows to sorted (doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, a in enumerate(sets):
        for j in {j for x in a for j in where[x] if j < i}:
            both = len(a & sets[j])
            if 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def repeats_removed(rows, window=20):
    """(doc_id, text) rows to sorted (doc_id, n_words, n_removed, kept words)."""
    big = 1 << 63
    words = [SPACED.findall(t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            key, place = tuple(w[i : i + window]), (big if d is None else d, i)
            first[key] = min(place, first.get(key, place))
    out = []
    for (d, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < (big if d is None else d, i) for j in range(i, i + window)}
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def bytes_removed(rows, length=400):
    """(doc_id, text) rows to sorted (doc_id, n_bytes, n_removed, n_spans, kept)."""
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def interpolated(rows, deleted_counts=None):
    """(doc_id, text) rows to sorted base rows, and a function (weights by bucket) -> {row number: score}."""
    import math
    import zlib

    fold = [zlib.crc32(("null" if d is None else str(d)).encode()) % 10 for d, _ in rows]
    tokens = [[*SPACED.findall((t or "").translate(LOWER)), None] for _, t in rows]
    uni, bi, starts = Counter(), Counter(), 0
    for f, ws in zip(fold, tokens):
        if f:
            uni.update(ws)
            starts += 1
            bi.update(zip([0, *ws], ws))
    n, v = sum(uni.values()), len(uni)
    base = []
    for (d, _), f, ws in zip(rows, fold, tokens):
        base.append((d, f == 0, len(ws), sum(uni[w] > 0 for w in ws), n,
                     sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)))

    def scores(weights):
        out = []
        for ws in tokens:
            total = 0
            for h, w in zip([0, *ws], ws):
                c = starts if h == 0 else uni[h]
                a, g, u = weights[min(47, int(math.log2(c + 1)))]
                p = (a * bi[h, w] / c if c else 0) + g * uni[w] / n + u / (v + 1)
                total += math.log10(p if c else p / (1 - a))
            out.append(total)
        return out

    return base, scores
