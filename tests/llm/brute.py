"""Plain Python versions of what the operators return, for small inputs."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, n=5):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def components(rows, percent=80):
    """{id: smallest linked id} for (id, text) rows."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in sets}


def covered(units, window, first, earlier):
    gone = [False] * len(units)
    for k in range(len(units) - window + 1):
        if earlier(first[tuple(units[k:k + window])], k):
            gone[k:k + window] = [True] * window
    return gone


def substring_dedup(rows, window=50):
    """{id: (words, kept text)}."""
    docs = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(docs):
        for k in range(len(docs[i]) - window + 1):
            first.setdefault(tuple(docs[i][k:k + window]), i)
    out = {}
    for i, w in docs.items():
        gone = covered(w, window, first, lambda f, k: f < i)
        out[i] = (len(w), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def suffix_dedup(rows, window=100):
    """{id: (bytes, kept bytes, number of removed runs)}."""
    docs = {i: (t or "").encode() for i, t in rows}
    first = {}
    for i in sorted(docs):
        for k in range(len(docs[i]) - window + 1):
            first.setdefault(tuple(docs[i][k:k + window]), (i, k))
    out = {}
    for i, w in docs.items():
        gone = covered(w, window, first, lambda f, k: f < (i, k))
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(w), bytes(x for x, g in zip(w, gone) if not g), runs)
    return out


def quality_base(text):
    text = text or ""
    w = WORD.findall(text)
    at = defaultdict(list)
    for k in range(len(w) - 2):
        at[tuple(w[k:k + 3])].append(k)
    repeated = {k + d for v in at.values() if len(v) > 1 for k in v for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(repeated))


def quality_scores(rows, trusted, slots=1 << 16, prior=4):
    """Sum of a text's weights in millionths, for each row."""
    def slots_of(text):
        w = WORD.findall(text or "")
        ones = [xxhash.xxh64_intdigest(a.encode(), 42) for a in w]
        return [h % slots for h in ones] + [xxhash.xxh64_intdigest(b.encode(), h) % slots
                                            for h, b in zip(ones, w[1:])]

    raw, target = Counter(), Counter()
    for i, text in rows:
        raw.update(slots_of(text))
        if i is not None and i in trusted:
            target.update(slots_of(text))
    share = sum(target.values()) / max(1, sum(raw.values()))
    weight = {s: math.floor(1e6 * math.log((target[s] + prior) / (raw[s] * share + prior)) + 0.5)
              if share else 0 for s in raw}
    return [sum(weight[s] for s in slots_of(text)) for _, text in rows]


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
       "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10))
                    for k, c in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return True


def pii_base(text):
    """Base spans as kind:start:end, by start and then kind."""
    spans = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(PII.items())
             for m in re.finditer(p, text or "") if _valid(kind, m.group())]
    return [f"{kind}:{s}:{e}" for s, _, kind, e in sorted(spans)]


def edit_distance_inside(item, text):
    """Smallest edit distance of ``item`` to any substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return min(row)


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
