"""Resampling: checksums equal zlib, weights and draws equal plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_support import SCHEMA, prose, table

from gable.llm import resampling

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets(text, size):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(r.encode()) % size for r in runs]


def plain(docs, target, percent=25, min_words=20, seed=7, size=10_000):
    raw, aim = Counter(), Counter()
    for counter, texts in ((raw, (t for _, t in docs)), (aim, target)):
        for text in texts:
            counter.update(buckets(text, size)[1])
    s, t = sum(raw.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s + size) / ((raw[b] + 1) * (t + size)))) for b in range(size)]
    rows = []
    for doc, text in docs:
        n, found = buckets(text, size)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
        score = None if doc is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, n, len(found), weight, score, None])
    able = sorted((r for r in rows if r[1] >= min_words and r[4] is not None), key=lambda r: (-r[4], r[0], r[2], r[3]))
    for k, r in enumerate(able[: len(able) * percent // 100], 1):
        r[5] = k
    return sorted(map(tuple, rows), key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


def test_checksums_of_any_spans():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 300_000, dtype=np.uint8)
    sizes = np.concatenate((rng.integers(1, 30, 500), rng.integers(200, 3000, 300), [1, 255, 256, 257, 511, 512, 513, 768, 90_000]))
    starts = rng.integers(0, len(data) - 90_000, len(sizes))
    ends = starts + sizes
    want = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert resampling.span_crcs(data, starts, ends).tolist() == want
    assert resampling.span_crcs(data, starts[:0], ends[:0]).tolist() == []


@pytest.mark.parametrize("block", [3, 50, 1 << 18])
def test_features_are_those_of_each_text(monkeypatch, block):
    monkeypatch.setattr(resampling, "BLOCK", block)
    texts = ["One two", None, "", "three", "É é ab-CD 12x \U0001f600 中文", " \n", "y" * 700 + " z", "a b c"]
    bucket, text, words = resampling.Features(997).of(pa.array(texts))
    for i, t in enumerate(texts):
        n, want = buckets(t, 997)
        assert words[i] == n and sorted(bucket[text == i].tolist()) == sorted(want)


def test_draws_equal_plain_python(spark, small):
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    want = plain(docs, [r.text for r in target.select("text").collect()])
    assert found(resampling.resample(small, target)) == want
    assert found(resampling.resample(small.repartition(6), target)) == want


def test_odd_rows_ties_and_clashing_columns(spark, odd, none):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    docs += [(20 + i % 3, prose(i % 2, 40)) for i in range(30)]
    aim = [prose(0, 60), None, ""]
    target = table(spark, list(enumerate(aim)))
    clash = table(spark, docs).selectExpr("*", "1 AS score", "2 AS weight", "3 AS rank", "4 AS bucket", "5 AS n")
    assert found(resampling.resample(clash, target)) == plain(docs, aim)
    assert found(resampling.resample(clash, none)) == plain(docs, [])
    assert found(resampling.resample(none, target)) == []


def test_other_parameters_and_long_texts(spark):
    rng = random.Random(3)
    docs = [(i, prose(i, rng.randint(0, 40))) for i in range(60)] + [(99, prose(5, 40_000)), (100, "b" * 100_000 + " c")]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], SCHEMA)
    target = table(spark, [(1, prose(3, 500))])
    got = resampling.resample(frame, target, percent=60, min_words=5, seed=11, features=resampling.Features(251))
    assert found(got) == plain(docs, [prose(3, 500)], 60, 5, 11, 251)
