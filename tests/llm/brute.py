"""Plain single-process versions of the operators, straight from their definitions."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def digest(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c)
        total += (v * 2 - 9 if v > 4 else v * 2) if i % 2 else v
    return total % 10 == 0


def _digits(m: str) -> str:
    return re.sub("[^0-9]", "", m)


PERSONAL = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 13 <= len(_digits(m)) <= 19 and luhn(_digits(m))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(_digits(m)) <= 15),
)


def personal(text):
    spans, counts = [], []
    for kind, pattern, valid in PERSONAL:
        found = [f"{kind}:{m.start()}:{m.end()}" for m in pattern.finditer(text or "") if valid(m[0])]
        counts.append(len(found))
        spans += found
    return (*counts, digest(",".join(spans)))


def shingles(text, k):
    words = WORD.findall(low(text))
    if len(words) >= k:
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def near_groups(rows, k, percent):
    """``{doc_id: (set sizes, component)}`` of (doc_id, text) rows, all pairs compared."""
    sets = defaultdict(list)
    for doc, text in rows:
        sets[doc].append(shingles(text, k))
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: (sorted(map(len, sets[d])), find(d)) for d in ids}


def repeats(rows, length=100):
    """Per (doc_id, text) row in order: bytes, removed bytes, removed runs, digest of the rest."""
    seen, out = set(), []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            w = data[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), runs, digest(bytes(b for b, g in zip(data, gone, strict=True) if not g))))
    return out


class Bigrams:
    """Interpolated modified Kneser-Ney on dictionaries."""

    def __init__(self, texts, discounts):
        said = [self.tokens(t) for t in texts]
        self.count = Counter(w for s in said for w in s)
        self.total, self.size = sum(self.count.values()), len(self.count)
        self.pairs = Counter(p for s in said for p in zip([None, *s[:-1]], s, strict=True))
        self.above, self.follows = defaultdict(lambda: [0, 0, 0, 0]), Counter()
        for (v, w), n in self.pairs.items():
            self.above[v][0] += n
            self.above[v][min(n, 3)] += 1
            self.follows[w] += 1
        times, low_times = Counter(self.pairs.values()), Counter(self.follows.values())
        self.d, self.e = discounts([times[i] for i in range(1, 5)]), discounts([low_times[i] for i in range(1, 5)])
        kinds = Counter(min(n, 3) for n in self.follows.values())
        self.gamma = sum(self.e[i - 1] * kinds[i] for i in (1, 2, 3)) / len(self.pairs)

    @staticmethod
    def tokens(text):
        return [*WORD.findall(low(text)), None]

    def word(self, w):
        n = self.follows[w]
        return (n - (self.e[min(n, 3) - 1] if n else 0)) / len(self.pairs) + self.gamma / (self.size + 1)

    def pair(self, v, w):
        if v not in self.above:
            return self.word(w)
        total, *kinds = self.above[v]
        n = self.pairs[v, w]
        gamma = sum(a * b for a, b in zip(self.d, kinds, strict=True)) / total
        return (n - (self.d[min(n, 3) - 1] if n else 0)) / total + gamma * self.word(w)

    def scores(self, text):
        said = self.tokens(text)
        base = sum(math.log10((self.count[w] + 1) / (self.total + 1 * (self.size + 1))) for w in said)
        model = sum(math.log10(self.pair(v, w)) for v, w in zip([None, *said[:-1]], said, strict=True))
        return len(said), sum(self.count[w] > 0 for w in said), self.total, base, model
