"""Quality rules: text counters and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into a fixed number of buckets. Two multinomials
over the buckets are counted over whole tables, one of the trusted target, one of
the raw corpus; the weight of a bucket is the log ratio of its two smoothed
probabilities. The target's is smoothed towards the raw one with a fixed weight, so that
few target texts say little. A document's score is the mean weight of its n-grams, and every
document is judged by comparing that mean with a fixed threshold.

Everything is DataFrame functions. The only thing that reaches the driver is the
weight table of ``BUCKETS`` doubles, whose size is a parameter.

Defined cases: a null or empty text has no words and fails the base rule; a
null ``doc_id`` is judged like any other row and is never in the trusted target;
repeated rows are judged one by one; an empty corpus or target gives all-equal
weights, so that only the base rule decides; other columns pass through untouched.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, functions as F

from gable.llm.common import BLANKS, read, settled, sized_join, words

#: Hash buckets of the two multinomials.
BUCKETS = 4096
#: Added to every bucket count of the raw multinomial; n-grams that the raw one adds to the target.
SMOOTHING, PRIOR = 1.0, 32 * BUCKETS
#: Least mean weight of a kept document.
THRESHOLD = -0.03
#: Base rule.
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50


def with_ngrams(docs: DataFrame) -> DataFrame:
    """Adds ``__words``, ``__hashes`` and ``__grams`` (bucket of each word and each word pair)."""
    split = settled(docs, __words=words(F.coalesce(F.col("text"), F.lit(""))))
    hashed = settled(split, __hashes="transform(__words, w -> xxhash64(w))")
    pairs = f"transform(slice(__hashes, 2, greatest(size(__hashes) - 1, 0)), (h, i) -> cast(pmod(xxhash64(__hashes[i], h), {BUCKETS}) AS int))"
    singles = f"transform(__hashes, h -> cast(pmod(h, {BUCKETS}) AS int))"
    return settled(hashed, __grams=f"concat({singles}, {pairs})")


def bucket_weights(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """Log ratio of target and raw probability per bucket; ``trusted`` holds the ``doc_id`` of the target."""
    marks = trusted.select(F.col("doc_id").alias("__id")).where("__id IS NOT NULL").distinct().withColumn("__target", F.lit(1))
    rows = docs.select(F.col("doc_id").alias("__id"), "text")
    grams = with_ngrams(sized_join(rows, marks, ["__id"], "left")).select(F.explode_outer("__grams").alias("bucket"), "__target")
    counts = grams.where("bucket IS NOT NULL").groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("__target").alias("target"))
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for row in counts.collect():  # at most BUCKETS rows
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    if not sum(target):
        return [0.0] * BUCKETS
    shares = [(r + SMOOTHING) / (sum(raw) + SMOOTHING * BUCKETS) for r in raw]
    whole = sum(target) + PRIOR
    return [math.log((t + PRIOR * p) / whole) - math.log(p) for p, t in zip(shares, target, strict=True)]


def judge(docs: DataFrame, weights: list[float], out: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` and a struct column ``out`` with the counters, the score and the verdict.

    ``score`` is null for a document without words.
    """
    table = f"from_json('{json.dumps([round(w, 9) for w in weights])}', 'array<double>')"
    lines = F.expr(r"filter(split(coalesce(text, ''), '\n'), l -> l rlike '[^ \\t\\n\\x0B\\f\\r]')")
    rows = settled(with_ngrams(docs), __lines=lines)
    # hashes of three words in a row; positions are looked at only where one of them repeats
    three = "transform(slice(__hashes, 3, greatest(size(__hashes) - 2, 0)), (h, i) -> xxhash64(__hashes[i], __hashes[i + 1], h))"
    rows = settled(rows, __three=three)
    order = "sort_array(transform(__three, (h, i) -> struct(h AS h, i AS p)))"
    rows = settled(rows, __order=f"CASE WHEN size(array_distinct(__three)) < size(__three) THEN {order} END")
    places = "filter(__order, (x, i) -> x.h <=> get(__order, i - 1).h OR x.h <=> get(__order, i + 1).h)"
    covered = (
        f"aggregate(array_sort(transform({places}, x -> x.p)), struct(-3 AS last, 0L AS n),"
        " (s, p) -> struct(p AS last, s.n + least(3, p - s.last) AS n), s -> s.n)"
    )
    text = "coalesce(text, '')"
    measures = {
        "n_words": "cast(size(__words) AS bigint)",
        "word_chars": "cast(length(__bare) AS bigint)",
        "n_symbols": f"cast(length({text}) - length(translate({text}, '#*$%&|<>', '')) AS bigint)",
        "n_dup_lines": "cast(size(__lines) - size(array_distinct(__lines)) AS bigint)",
        "n_repeat_words": f"coalesce({covered}, 0L)",
        "score": f"aggregate(__grams, 0D, (a, g) -> a + {table}[g]) / nullif(size(__grams), 0)",
    }
    rows = rows.withColumn("__bare", F.translate(F.expr(text), BLANKS, ""))
    rows = settled(rows, __m=f"named_struct({', '.join(f'{k!r}, {v}' for k, v in measures.items())})")
    failed = f"(__m.n_words < {MIN_WORDS} OR 100 * __m.n_repeat_words > {MAX_REPEATED_PERCENT} * __m.n_words)"
    verdict = f"NOT {failed} AND coalesce(__m.score >= {threshold}D, false)"
    fields = ", ".join(f"{k!r}, __m.{k}" for k in measures)
    rows = rows.withColumn(out, F.expr(f"named_struct({fields}, 'base_failed', {failed}, 'kept', {verdict})"))
    return rows.drop("__words", "__hashes", "__grams", "__lines", "__three", "__order", "__bare", "__m")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The trusted target: documents that a label marks as good."""
    return labels.where("quality = 1").select("doc_id")


def op8_quality_rules(spark, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    weights = bucket_weights(docs, trusted_ids(read(spark, folder, "labels")))
    judged = judge(docs, weights)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return judged.select("doc_id", *[F.col(f"quality.{n}").alias(n) for n in names])
