"""Source divergence: equal to plain Python at every block and tile size; prices and intersections exact."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gable.llm import divergence

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs):
    """The audit of (lang, source, text) rows, term by term."""
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        found = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(FOLD)))
        counts[lang, source] += found
        seen[lang].update(found.keys())
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in seen[lang].items() if d >= min_docs]
        own = {s: [counts[lang, s][t] for t in kept] for s in sources}
        own[None] = [sum(counts[lang, s][t] for s in sources) for t in kept]
        price = {s: [1 + 10**9 * (c + 2) // (sum(n) + 2 * len(kept)) for c in n] for s, n in own.items()}
        apart = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(o, sum(map(apart, price[s], price[o]))) for o in sources if o != s]
            best = [(t, apart(p, q)) for t, c, p, q in zip(kept, own[s], price[s], price[None], strict=True) if c and p > q]
            for part, items in (("pair", pairs), ("term", best)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1) if part == "pair" or k <= 10]
    return sorted(out)


def made(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string")


def found(frame):
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["ab", "Ab", "é", "É", "zz", "中文", "the", "of", "x1y", "\U0001f600", "a-b", "q"] + [f"w{chr(97 + i)}" for i in range(26)]
    out = [(rng.choice(["en", "de", None]), "hot" if i % 3 == 0 else rng.choice(["s1", "s2", "s3", None, "é"]), " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(300)]
    return [*out, ("en", "empty", None), ("en", "blank", " \t12 "), ("fr", "only", "two words"), ("it", "x", "rare"), ("it", "y", ""), *out[:5], ("en", "long", "ab zz " * 30_000)]


def test_equals_plain_python(spark, rows, monkeypatch):
    docs = made(spark, rows)
    for docs_needed in (10, 1):
        assert found(divergence.audit(docs, docs_needed)) == plain(rows, docs_needed)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 3)
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "HELD", 20)
    assert found(divergence.audit(docs.repartition(5), 2)) == plain(rows, 2)


def test_given_documents(spark, small):
    rows = [tuple(r) for r in small.select("lang", "source", "text").collect()]
    assert found(divergence.audit(small)) == plain(rows, 10)


def test_empty_table_clashing_columns_and_odd_texts(spark, odd, none):
    assert found(divergence.audit(none)) == []
    rows = [tuple(r) for r in odd.select("lang", "source", "text").collect()]
    clash = odd.selectExpr("*", "1 AS term", "2 AS n", "3 AS total", "'x' AS block", "4 AS rank")
    assert found(divergence.audit(clash, 2)) == plain(rows, 2)


def test_terms_do_not_cross_texts():
    terms, counts = divergence.terms(pa.array(["Abc", "DEF ghi", None, "", "é1É"]))
    assert terms.to_pylist() == ["abc", "def", "ghi", "é", "É"] and counts.tolist() == [1, 2, 0, 0, 2]


def test_gallop_equals_binary_search():
    rng = np.random.default_rng(1)
    for few, many in ((0, 10), (1, 5000), (3, 10_000), (100, 50_000), (200, 1500), (70, 0), (65, 600)):
        a, b = (np.unique(rng.integers(0, 60_000, n)).astype(np.int32) for n in (few, many))
        assert divergence.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()


def test_prices_are_exact():
    rng = random.Random(2)
    for base in (1, 7, 10**6, 10**14, 9 * 10**15, 10**17):
        counts = np.array([rng.randint(0, base) for _ in range(50)], dtype=np.int64)
        assert divergence.prices(counts, base, 3).tolist() == [1 + 10**9 * (int(c) + 2) // (base + 6) for c in counts]
