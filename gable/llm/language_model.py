"""Interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by its readers.

Counting: tasks hash words, count distinct keys of their rows and send them as sorted
blobs, one for each shard; a shard merges its blobs and writes two files, the sorted
keys and their counts. This is done for words (key: hash, and the place in all sorted
hashes becomes the word's number) and then for bigrams (key: the two numbers). A shard
of bigrams is chosen by the first word; a word that opens more than a shard's share of
all bigrams is spread over all shards by both words. From the shards come the
statistics of each word: bigrams it opens (sum, and how many are seen once, twice, more
often) and how many different words it follows. Readers map the files into memory and
find keys by binary search; nothing of the model but a few sums passes the driver.

``p(w|v) = (c(vw) - D) / c(v.) + g(v) p(w)`` with discounts by count 1, 2, 3 and over;
``p(w)`` is the same over continuation counts, with the uniform distribution over known
words and one unknown word below it. A text starts in the context of the end token.

The order is 2: in this prose most trigrams are seen once, and sorted counts of both orders
would take more than five times the input (figures in the README).

Defined cases: a null or empty text is the end token alone; a null ``doc_id`` is held
out by nothing and trains like other rows; repeated rows count each time; with no
training rows every word is unknown and has probability one; other columns are ignored.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from gable.llm.common import read, texts
from gable.llm.files import mapped, write_array
from gable.llm.tokens import mix, pieces, word_hashes
from gable.runtime import scratch_path, stage

#: Shards of the word table, by the top bits of the hash.
WORD_SHARDS = 64
#: Training tokens for each shard of bigrams.
SHARD_TOKENS = 4_000_000
#: Words in a file of word statistics.
STAT_BLOCK = 1 << 20
#: Distinct keys a task gathers before it merges them.
GATHER = 1 << 22
#: Hash of the token that ends each text.
END = mix(np.array([0xE0D], dtype=np.uint64))[0]
STATS = np.dtype([("total", "<u8"), ("n1", "<u4"), ("n2", "<u4"), ("n3", "<u4"), ("follows", "<u4")])
BLOBS = "shard int, keys binary, counts binary"


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    """Differences of sorted values, byte planes apart, so that their high zero bytes compress away."""
    steps = np.diff(values, prepend=np.zeros(1, dtype=values.dtype))
    return pack(steps.view(np.uint8).reshape(-1, 8).T)


def unpack_sorted(blob: bytes, dtype=np.uint64) -> np.ndarray:
    planes = unpack(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.concatenate(([True], keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, np.flatnonzero(first))


class Gathered:
    """Counts of keys, merged whenever enough of them have come together."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.parts.append((found, counts.astype(np.int64)))
        self.size += len(found)
        if self.size > GATHER and len(self.parts) > 1:
            self.parts = [self.merged()]
            self.size = len(self.parts[0][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        return summed(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))

    def full(self) -> bool:
        return self.size > 2 * GATHER


def blobs(keys: np.ndarray, counts: np.ndarray, shards: np.ndarray):
    """One row for each shard that has keys; keys are sorted."""
    order = np.argsort(shards, kind="stable")
    shards = shards[order]
    cuts = np.flatnonzero(np.diff(shards)) + 1
    rows = [(int(shards[p[0]]), pack_sorted(keys[p2]), pack(counts[p2])) for p, p2 in zip(np.split(np.arange(len(order)), cuts), np.split(order, cuts), strict=True) if len(p)]
    if rows:
        shard, key, count = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(key, pa.binary()), pa.array(count, pa.binary())], ["shard", "keys", "counts"])


def word_shard(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(58)).astype(np.int32)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts end to end, each text closed by the end token; tokens of each text."""
    hashes, counts = word_hashes(column)
    stops = np.cumsum(counts)
    return np.insert(hashes, stops, END), counts + 1


def count_words(batches):
    have = Gathered()
    for batch in pieces(batches):
        have.add(tokens(batch.column("text"))[0])
        if have.full():
            keys, counts = have.merged()
            yield from blobs(keys, counts, word_shard(keys))
            have = Gathered()
    keys, counts = have.merged()
    yield from blobs(keys, counts, word_shard(keys))


def merge_into(folder: str, name: str):
    """For a group of blobs: writes the merged shard, returns its size and the counts of counts 1 to 4."""

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        have = Gathered()
        for keys, counts in zip(table.column("keys"), table.column("counts"), strict=True):
            have.parts.append((unpack_sorted(keys.as_py()), unpack(counts.as_py(), np.int64)))
            have.size += len(have.parts[-1][0])
            if have.size > GATHER:
                have.parts = [have.merged()]
                have.size = len(have.parts[0][0]) // 4
        keys, counts = have.merged()
        write_array(f"{folder}/{name}-{shard}.keys", keys)
        write_array(f"{folder}/{name}-{shard}.counts", counts)
        row = {"shard": [shard], "size": [len(keys)], "total": [int(counts.sum())]} | {f"c{i}": [int((counts == i).sum())] for i in range(1, 5)}
        return pa.table(row, schema=pa.schema([("shard", pa.int32()), *[(n, pa.int64()) for n in ("size", "total", "c1", "c2", "c3", "c4")]]))

    return merge


SIZES = "shard int, size long, total long, c1 long, c2 long, c3 long, c4 long"


class Words:
    """Reader of the word table: numbers of hashes."""

    def __init__(self, folder: str, bases: list[int]) -> None:
        self.bases = bases
        self.keys = [mapped(f"{folder}/w-{s}.keys", np.uint64) if bases[s + 1] > bases[s] else None for s in range(WORD_SHARDS)]
        self.counts = [mapped(f"{folder}/w-{s}.counts", np.int64) if bases[s + 1] > bases[s] else None for s in range(WORD_SHARDS)]

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each hash (-1: unknown) and its count (0: unknown)."""
        distinct, back = np.unique(hashes, return_inverse=True)
        number, count = np.full(len(distinct), -1, dtype=np.int64), np.zeros(len(distinct), dtype=np.int64)
        cuts = np.searchsorted(distinct, np.arange(WORD_SHARDS + 1, dtype=object).astype(object) * (1 << 58)) if False else np.searchsorted(word_shard(distinct), np.arange(WORD_SHARDS + 1))
        for s in range(WORD_SHARDS):
            lo, hi = cuts[s], cuts[s + 1]
            if hi > lo and self.keys[s] is not None:
                at = np.minimum(np.searchsorted(self.keys[s], distinct[lo:hi]), len(self.keys[s]) - 1)
                same = self.keys[s][at] == distinct[lo:hi]
                number[lo:hi] = np.where(same, at + self.bases[s], -1)
                count[lo:hi] = np.where(same, self.counts[s][at], 0)
        return number[back], count[back]


def contexts(numbers: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """The number before each token; the end token before the first of a text."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    begins = np.concatenate(([0], np.cumsum(counts)[:-1]))
    before[begins] = end
    return before


def bigram_shard(first: np.ndarray, second: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    spread = np.isin(first, hot) if len(hot) else np.zeros(len(first), dtype=bool)
    key = np.where(spread, first * 1_000_003 + second + 1, first)
    return (mix(key.astype(np.uint64)) % np.uint64(shards)).astype(np.int32)


def count_bigrams(model: dict):
    def count(batches):
        words = Words(model["folder"], model["bases"])
        end = int(words.numbers(np.array([END]))[0][0])
        hot, size = np.array(model["hot"], dtype=np.int64), model["words"]

        def out(have: Gathered):
            keys, counts = have.merged()
            first, second = (keys // np.uint64(size)).astype(np.int64), (keys % np.uint64(size)).astype(np.int64)
            yield from blobs(keys, counts, bigram_shard(first, second, hot, model["shards"]))

        have = Gathered()
        for batch in pieces(batches):
            hashes, counts = tokens(batch.column("text"))
            numbers, _ = words.numbers(hashes)
            have.add((contexts(numbers, counts, end) * size + numbers).astype(np.uint64))
            if have.full():
                yield from out(have)
                have = Gathered()
        yield from out(have)

    return count


def statistics(model: dict):
    """Per shard of bigrams: sums of each word as opener and as follower, as blobs by block of numbers."""

    def rows(batches):
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                keys, counts = mapped(f"{model['folder']}/b-{shard}.keys", np.uint64), mapped(f"{model['folder']}/b-{shard}.counts", np.int64)
                if not len(keys):
                    continue
                first, second = (keys // np.uint64(model["words"])).astype(np.int64), (keys % np.uint64(model["words"])).astype(np.int64)
                at = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
                opened = np.zeros(len(at), dtype=STATS)
                opened["total"] = np.add.reduceat(counts, at)
                for name, hit in (("n1", counts == 1), ("n2", counts == 2), ("n3", counts >= 3)):
                    opened[name] = np.add.reduceat(hit.astype(np.int64), at)
                number, times = np.unique(second, return_counts=True)
                follow = np.zeros(len(number), dtype=STATS)
                follow["follows"] = times
                for numbers, values in ((first[at], opened), (number, follow)):
                    cuts = np.flatnonzero(np.diff(numbers // STAT_BLOCK)) + 1
                    parts = [(int(n[0] // STAT_BLOCK), pack_sorted(n.astype(np.uint64)), pack(v)) for n, v in zip(np.split(numbers, cuts), np.split(values, cuts), strict=True)]
                    shard_, key, value = zip(*parts, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(shard_, pa.int32()), pa.array(key, pa.binary()), pa.array(value, pa.binary())], ["shard", "keys", "counts"])

    return rows


def write_statistics(folder: str, words: int):
    def merge(table: pa.Table) -> pa.Table:
        block = table.column("shard")[0].as_py()
        dense = np.zeros(min(STAT_BLOCK, words - block * STAT_BLOCK), dtype=STATS)
        for keys, values in zip(table.column("keys"), table.column("counts"), strict=True):
            at = unpack_sorted(keys.as_py()).astype(np.int64) - block * STAT_BLOCK
            part = unpack(values.as_py(), STATS)
            for name in STATS.names:
                dense[name][at] += part[name]
        write_array(f"{folder}/s-{block}.stats", dense)
        follows = dense["follows"]
        row = {"shard": [block], "size": [int((follows > 0).sum())], "total": [int(follows.sum(dtype=np.int64))]} | {f"c{i}": [int((follows == i).sum())] for i in range(1, 5)}
        return pa.table(row, schema=pa.schema([("shard", pa.int32()), *[(n, pa.int64()) for n in ("size", "total", "c1", "c2", "c3", "c4")]]))

    return merge


def discounts(counted: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2, 3 and over; 0.5, 1, 1.5 where a count of counts is missing."""
    n1, n2, n3, n4 = counted
    if not (n1 and n2 and n3):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(found)]


def train(docs: DataFrame) -> dict:
    """Counts the model over all rows of ``docs``; returns its description (folder, sizes, discounts)."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "bigrams")
    rows = texts(docs).select("text")
    word_rows = rows.mapInArrow(count_words, BLOBS).groupBy("shard").applyInArrow(merge_into(folder, "w"), SIZES).collect()  # WORD_SHARDS rows at most
    sizes = {r.shard: r.size for r in word_rows}
    bases = np.concatenate(([0], np.cumsum([sizes.get(s, 0) for s in range(WORD_SHARDS)]))).tolist()
    total = sum(r.total for r in word_rows)
    model = {"folder": folder, "bases": bases, "words": bases[-1], "tokens": total, "shards": max(8, math.ceil(total / SHARD_TOKENS)), "hot": []}
    if not total:
        return model
    hot = spark.range(WORD_SHARDS).selectExpr("cast(id AS int) AS shard").mapInArrow(frequent(model), "number long")
    model["hot"] = sorted(r.number for r in hot.collect())  # at most 4 x shards rows: each holds 1 / (4 x shards) of all tokens
    pairs = rows.mapInArrow(count_bigrams(model), BLOBS).groupBy("shard").applyInArrow(merge_into(folder, "b"), SIZES)
    shards = stage(pairs, "shards")
    sums = shards.agg(*[F.sum(c).alias(c) for c in ("c1", "c2", "c3", "c4")]).first()
    stats = shards.select("shard").repartition(model["shards"]).mapInArrow(statistics(model), BLOBS)
    below = stage(stats.groupBy("shard").applyInArrow(write_statistics(folder, model["words"]), SIZES), "blocks")
    low = below.agg(*[F.sum(c).alias(c) for c in ("size", "total", "c1", "c2", "c3", "c4")]).first()
    model["pair_discounts"] = discounts([sums.c1, sums.c2, sums.c3, sums.c4])
    model["word_discounts"] = discounts([low.c1, low.c2, low.c3, low.c4])
    model["pairs"] = low.total
    d, n = model["word_discounts"], [low.c1, low.c2, low.size - low.c1 - low.c2]
    model["word_gamma"] = sum(x * y for x, y in zip(d, n, strict=True)) / low.total
    return model


def frequent(model: dict):
    """Numbers of the words that make up so many of all tokens that their bigrams are spread over shards."""

    def rows(batches):
        for batch in batches:
            for s in batch.column("shard").to_pylist():
                if model["bases"][s + 1] > model["bases"][s]:
                    counts = mapped(f"{model['folder']}/w-{s}.counts", np.int64)
                    hot = np.flatnonzero(counts > model["tokens"] / (4 * model["shards"])) + model["bases"][s]
                    yield pa.RecordBatch.from_arrays([pa.array(hot, pa.int64())], ["number"])

    return rows


class Scorer:
    """Base and model log10 probabilities of batches of texts."""

    def __init__(self, model: dict) -> None:
        self.m = model
        self.words = Words(model["folder"], model["bases"])
        self.end = int(self.words.numbers(np.array([END]))[0][0])
        self.hot = np.array(model["hot"], dtype=np.int64)
        blocks = -(-model["words"] // STAT_BLOCK)
        self.stats = [mapped(f"{model['folder']}/s-{b}.stats", STATS) for b in range(blocks)] if model["tokens"] else []
        self.pairs: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def about(self, numbers: np.ndarray) -> np.ndarray:
        """Statistics of words, zeros for unknown ones."""
        out = np.zeros(len(numbers), dtype=STATS)
        for b, dense in enumerate(self.stats):
            here = np.flatnonzero((numbers >= b * STAT_BLOCK) & (numbers < (b + 1) * STAT_BLOCK))
            out[here] = dense[numbers[here] - b * STAT_BLOCK]
        return out

    def pair_counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys = (first * self.m["words"] + second).astype(np.uint64)
        shards = bigram_shard(first, second, self.hot, self.m["shards"])
        out = np.zeros(len(keys), dtype=np.int64)
        order = np.lexsort((keys, shards))
        cuts = np.searchsorted(shards[order], np.arange(self.m["shards"] + 1))
        for s in np.unique(shards).tolist():
            if s not in self.pairs:
                self.pairs[s] = tuple(mapped(f"{self.m['folder']}/b-{s}.{n}", t) for n, t in (("keys", np.uint64), ("counts", np.int64)))
            stored, counts = self.pairs[s]
            here = order[cuts[s] : cuts[s + 1]]
            at = np.minimum(np.searchsorted(stored, keys[here]), len(stored) - 1)
            out[here] = np.where(stored[at] == keys[here], counts[at], 0)
        return out

    def scores(self, column: pa.Array) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, base score and model score of each text."""
        hashes, counts = tokens(column)
        begins = np.concatenate(([0], np.cumsum(counts)[:-1]))
        if not self.m["tokens"]:
            return counts, np.zeros(len(counts), dtype=np.int64), np.zeros(len(counts)), np.zeros(len(counts))
        numbers, seen = self.words.numbers(hashes)
        base = np.log10((seen + 1) / (self.m["tokens"] + 1 * (self.m["words"] + 1)))
        before = contexts(numbers, counts, self.end)
        # each distinct pair is looked up once
        n = self.m["words"] + 1
        pairs, back = np.unique((before + 1) * n + numbers + 1, return_inverse=True)
        first, second = pairs // n - 1, pairs % n - 1
        low = self.about(second)["follows"].astype(np.int64)
        off = np.concatenate(([0.0], self.m["word_discounts"]))[np.minimum(low, 3)]
        word = np.maximum(low - off, 0) / self.m["pairs"] + self.m["word_gamma"] / n
        known = np.flatnonzero((first >= 0) & (second >= 0))
        seen_pairs = np.zeros(len(pairs), dtype=np.int64)
        seen_pairs[known] = self.pair_counts(first[known], second[known])
        above = self.about(first)
        total = above["total"].astype(np.float64)
        d = self.m["pair_discounts"]
        gamma = (d[0] * above["n1"] + d[1] * above["n2"] + d[2] * above["n3"]) / np.maximum(total, 1)
        off = np.concatenate(([0.0], d))[np.minimum(seen_pairs, 3)]
        prob = np.where(total > 0, (seen_pairs - off) / np.maximum(total, 1) + gamma * word, word)
        model = np.log10(prob)[back]
        return counts, np.add.reduceat((seen > 0).astype(np.int64), begins), np.add.reduceat(base, begins), np.add.reduceat(model, begins)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, model: dict, held_out) -> DataFrame:
    """Scores of every row of ``docs``; ``held_out`` is a boolean column expression."""

    def rows(batches):
        scorer = Scorer(model)
        for batch in pieces(batches):
            counts, known, base, value = scorer.scores(batch.column("text"))
            total = pa.array(np.full(len(counts), model["tokens"]), pa.int64())
            arrays = [batch.column("doc_id"), batch.column("held_out"), pa.array(counts, pa.int64()), pa.array(known, pa.int64()), total, pa.array(base), pa.array(value)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return texts(docs).withColumn("held_out", held_out).select("doc_id", "text", "held_out").mapInArrow(rows, SCORES)


def describe(model: dict) -> str:
    return json.dumps({k: v for k, v in model.items() if k not in ("bases", "hot")})


def op7_language_model(spark, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return score(docs, train(docs.where(~held_out)), held_out)
