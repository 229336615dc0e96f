"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def near_groups(rows, similarity=85):
    """{doc_id: (shingles, component)}; rows: (doc_id, text)."""
    sets = {}
    for i, t in rows:
        w = SPACED.findall((t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    of = {i: i for i in sets}

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if 100 * min(len(sets[i]), len(sets[j])) < similarity * max(len(sets[i]), len(sets[j])):
                continue
            if 100 * len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                of[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def substring_dedup(rows, length=50):
    first, out = {}, {}
    rows = sorted((i, (t or "").encode()) for i, t in rows)
    for i, b in rows:
        for k in range(len(b) - length + 1):
            first.setdefault(b[k : k + length], i)
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def quality_base(text):
    text = text or ""
    words = SPACED.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def contamination(docs, items, width=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, t in items:
        w = words(t)
        for k in range(max(1, len(w) - width + 1)) if w else ():
            windows[tuple(w[k : k + width])].add(str(item))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for win, who in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found |= who
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def base_scores(rows, held):
    import math

    tokens = {i: [*SPACED.findall((t or "").translate(LOWER)), None] for i, t in rows}
    count = Counter(x for i, w in tokens.items() if not held(i) for x in w)
    n, v = sum(count.values()), len(count)
    return {i: (len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)) for i, w in tokens.items()}
