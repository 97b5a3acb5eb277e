"""Importance resampling towards a target: documents drawn by hashed n-gram weights.

A feature is a run of 1 to ``longest`` neighbouring words (A to Z folded; words are runs of
letters, digits and characters beyond ASCII), joined by one blank. Its bucket is the crc32
of its UTF-8 bytes modulo ``buckets``. The log ratio of target to raw share of a bucket is
its gain; a document's weight is the floored mean gain of its features, its score the
weight plus noise drawn from its id, and of the documents with enough words a percentage
with the highest scores is drawn, which is drawing without replacement by weight.

Checksums of whole batches (``span_crcs``): a byte contributes to a crc32 by its value and
its distance from the end alone, so a table [distance, byte] is computed once, the entries
of all bytes of all features are looked up and joined by ``bitwise_xor.reduceat`` over the
features' spans, and a constant of the length is added. Features beyond the table are cut
into blocks from their end; each block's sum is moved on by the block length with four
tables and joined with the next.

Both tables are read whole, texts twice: once for the counts of raw buckets (a row of
counts per task and bucket goes to the shuffle), once for the weights. The gains are one
number for each bucket. Scores are ordered by range partitions, never in one task.

Defined cases: a null or empty text has no features, weight 0 and is not drawn; rows without
``doc_id`` have no score and are not drawn nor counted among those to draw from, but their
text counts in the buckets; repeated rows are drawn one by one, ties go to the smaller id;
an empty target or an empty table works; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gable.llm.common import read, texts
from gable.llm.tokens import flat, give_back, pieces
from gable.operators.ordered import number_rows
from gable.runtime import stage

BUCKETS, LONGEST, MIN_WORDS, PERCENT, SEED = 10_000, 2, 20, 25, 7
#: Distances in the table, and bytes of features looked up at once.
NEAR, BLOCK = 256, 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _table() -> np.ndarray:
    """What each byte adds to a crc32 at each distance from the end."""
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, (row >> 1) ^ np.uint32(0xEDB88320), row >> 1)
    out = np.empty((NEAR, 256), dtype=np.uint32)
    out[0] = row
    for d in range(1, NEAR):
        out[d] = (out[d - 1] >> 8) ^ row[out[d - 1] & 0xFF]
    return out


_AT = _table()
_FLAT = _AT.ravel()
#: What a length adds: the crc32 of as many zero bytes.
_LENGTHS = np.array([zlib.crc32(bytes(n)) for n in range(NEAR + 1)], dtype=np.uint32)


def _moved(sums: np.ndarray) -> np.ndarray:
    """Sums as if ``NEAR`` more bytes followed: each of their four bytes is one at that distance."""
    out = np.zeros(len(sums), dtype=np.uint32)
    for k in range(4):  # the first byte is used up by the next one read, so it stands farthest
        out ^= _AT[NEAR - 1 - k][(sums >> np.uint32(8 * k)) & np.uint32(0xFF)]
    return out


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of each span of ``data`` (none empty; they may overlap)."""
    lengths = ends - starts
    out = np.empty(len(starts), dtype=np.uint32)
    long = lengths > NEAR
    short = np.flatnonzero(~long)
    out[short] = _near(data, starts[short], ends[short]) ^ _LENGTHS[lengths[short]]
    spots = np.flatnonzero(long)
    if len(spots):
        # block by block from the start; the first one is what the others leave over
        s, rest = starts[spots], lengths[spots]
        head = (rest - 1) % NEAR + 1
        sums = _near(data, s, s + head)
        at, last = s + head, ends[spots]
        while (on := np.flatnonzero(at < last)).size:
            sums[on] = _moved(sums[on]) ^ _near(data, at[on], at[on] + NEAR)
            at[on] += NEAR
        sizes, which = np.unique(rest, return_inverse=True)
        out[spots] = sums ^ np.array([_zeros(int(n)) for n in sizes], dtype=np.uint32)[which]
    return out


def _zeros(n: int) -> int:
    """crc32 of ``n`` zero bytes, in pieces."""
    crc = 0
    for lo in range(0, n, 1 << 20):
        crc = zlib.crc32(bytes(min(1 << 20, n - lo)), crc)
    return crc


def _near(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XOR of the table's entries over spans of at most ``NEAR`` bytes."""
    out = np.empty(len(starts), dtype=np.uint32)
    sizes = ends - starts
    sums = np.concatenate(([0], np.cumsum(sizes)))
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(sums, sums[at] + BLOCK, "right")) - 1)
        heads = (sums[at:to] - sums[at]).astype(np.int32)
        n, low = sizes[at:to], int(starts[at:to].min())
        place = np.arange(sums[to] - sums[at], dtype=np.int32)
        byte = data[low:].take(place + np.repeat((starts[at:to] - low - heads).astype(np.int32), n))
        distance = np.repeat((heads + n - 1).astype(np.int32), n) - place
        out[at:to] = np.bitwise_xor.reduceat(_FLAT.take((distance << 8) + byte), heads)
        at = to
    return out


class Features:
    """Buckets of the features of whole Arrow columns of texts."""

    def __init__(self, buckets: int = BUCKETS, longest: int = LONGEST) -> None:
        self.buckets, self.longest = buckets, longest

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket of each feature, the text of each feature, and the number of words of each text."""
        data, offsets = flat(column)
        data = _LOWER[data]
        inside = _WORD[data]
        first = np.zeros(len(data) + 1, dtype=bool)
        first[offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:-1]
        starts = np.flatnonzero(begins)
        counts = np.diff(np.searchsorted(starts, offsets))
        # words end to end with one blank after each
        before = np.concatenate(([0], np.cumsum(inside)))
        edges = np.append(before[starts], before[-1])
        packed = np.insert(data[inside], edges[1:], 32) if len(starts) else data[:0]
        start = edges[:-1] + np.arange(len(starts))
        end = edges[1:] + np.arange(len(starts))
        text = np.repeat(np.arange(len(counts)), counts)
        crcs, owners = [], []
        for n in range(1, self.longest + 1):
            k = np.flatnonzero(text[n - 1 :] == text[: len(text) - n + 1])  # runs of n words within one text
            crcs.append(span_crcs(packed, start[k], end[k + n - 1]))
            owners.append(text[k])
        return (np.concatenate(crcs) % np.uint32(self.buckets)).astype(np.int64), np.concatenate(owners), counts


def bucket_counts(docs: DataFrame, features: Features, column: str = "text") -> DataFrame:
    """``bucket, n``: features of all texts in each bucket."""

    def rows(batches):
        sums = np.zeros(features.buckets, dtype=np.int64)
        for batch in pieces(batches):
            sums += np.bincount(features.of(batch.column("text"))[0], minlength=features.buckets)
        found = np.flatnonzero(sums)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(sums[found])], ["bucket", "n"])
        give_back()

    named = docs.select(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("text"))
    return named.mapInArrow(rows, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """``floor(1000 ln(target share / raw share))`` of each bucket, shares smoothed by one; at most ``buckets`` rows of each come here."""
    s, t = [0] * buckets, [0] * buckets
    for counts, side in ((s, raw), (t, target)):
        for r in side.collect():
            counts[r.bucket] = r.n
    sums, sumt = sum(s) + buckets, sum(t) + buckets
    return np.array([math.floor(1000 * math.log((t[b] + 1) * sums / ((s[b] + 1) * sumt))) for b in range(buckets)], dtype=np.int64)


def noise(doc: int, seed: int) -> int:
    """``floor(1000 g)`` of a Gumbel variate g drawn from the id."""
    h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, features: Features, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""

    def rows(batches):
        for batch in pieces(batches):
            bucket, text, words = features.of(batch.column("text"))
            n = np.bincount(text, minlength=len(words))
            sums = np.zeros(len(words), dtype=np.int64)
            np.add.at(sums, text, gains[bucket])
            weight = sums // np.maximum(n, 1)
            score = [None if d is None else w + noise(d, seed) for d, w in zip(batch.column("doc_id").to_pylist(), weight.tolist(), strict=True)]
            arrays = [batch.column("doc_id"), *[pa.array(x.astype(np.int64)) for x in (words, n, weight)], pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_features", "weight", "score"])

    return texts(docs).mapInArrow(rows, "doc_id long, n_words long, n_features long, weight long, score long")


def drawn(scores: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` with ``rank`` of the rows that are drawn, null for others."""
    scores = stage(scores, "scores")
    may = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    eligible = scores.where(may).withColumn("__down", -F.col("score"))
    ranked = number_rows(eligible, ["__down", "doc_id", "n_features", "weight"], "rank").drop("__down")
    most = eligible.count() * percent // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    return ranked.unionByName(scores.where(~may).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, features: Features | None = None) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs``, drawn towards the texts of ``target``."""
    features = features or Features()
    gains = bucket_gains(bucket_counts(docs, features), bucket_counts(target, features), features.buckets)
    return drawn(scored(docs, gains, features, seed), percent, min_words)


def op13_importance_resampling(spark, folder: str) -> DataFrame:
    found = resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


OP13_SQL = r"""
WITH steps AS (  -- the crc32 table, one bit at a time
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY n) AS t
  FROM range(256) r(n)),
texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, true AS raw FROM documents
  UNION ALL SELECT row_number() OVER (), NULL, coalesce(text, ''), false FROM benchmark),
lists AS (SELECT r, doc_id, raw, regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
feats AS (SELECT r, raw, unnest(words) AS f FROM lists
  UNION ALL SELECT r, raw, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM lists),
bytes AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM feats)),
crcs AS (SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM bytes, steps),
coded AS (SELECT r, raw, bucket FROM feats JOIN crcs USING (f)),
sums AS (SELECT bucket, count(*) FILTER (raw) AS s, count(*) FILTER (NOT raw) AS t FROM coded GROUP BY bucket),
total AS (SELECT coalesce(sum(s), 0)::BIGINT AS ss, coalesce(sum(t), 0)::BIGINT AS tt FROM sums),
gains AS (SELECT bucket, floor(1000 * ln(((t + 1) * (ss + 10000))::DOUBLE / ((s + 1) * (tt + 10000))::DOUBLE))::BIGINT AS g FROM sums, total),
weights AS (SELECT r, count(*) AS n, sum(g)::BIGINT AS g FROM coded JOIN gains USING (bucket) WHERE raw GROUP BY r),
docs AS (SELECT doc_id, len(words) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(g::DOUBLE / n), 0)::BIGINT AS weight,
  ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h FROM lists LEFT JOIN weights USING (r) WHERE raw),
scores AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM docs),
ranks AS (SELECT *, CASE WHEN n_words >= 20 AND score IS NOT NULL THEN row_number() OVER (PARTITION BY n_words >= 20 AND score IS NOT NULL ORDER BY score DESC, doc_id) END AS k,
  count(*) FILTER (n_words >= 20 AND score IS NOT NULL) OVER () AS most FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= 25 * most // 100 THEN k END AS rank FROM ranks
"""
