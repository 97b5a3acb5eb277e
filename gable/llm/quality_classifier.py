"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Random indexing gives every word (hashed into ``BUCKETS``) a fixed sparse vector of a few
plus and minus ones; the vector of a word is the sum of those of its neighbours within
``WINDOW`` places, over the fitting sample, scaled to length one. A document is the mean
and the spread of the vectors of its words, the share of words without a vector, and its
length. A network with one hidden layer, written in numpy, turns that into a logit; a
temperature, chosen on a part of the sample it did not learn from, calibrates it.

Fitting uses at most ``SAMPLE`` labelled rows, chosen by the hash of their id; its word
vectors are summed by Spark tasks, and the driver holds ``BUCKETS x SIZE`` numbers and one
short row for each sampled document. Scoring reads every whole text once and shuffles nothing.

Defined cases: a null or empty text is a document of no words and gets the score of one;
labels that are null or whose document is missing are left out; several labels of one
document count as the largest; with no labels, or labels of one kind, every score is the
share of label 1 (0.5 without any); repeated rows are scored one by one; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gable.llm.common import read, texts
from gable.llm.tokens import mix, pieces, word_hashes
from gable.runtime import stage

#: Most labelled rows that the classifier is fitted on, and the tasks that work on them.
SAMPLE, SAMPLE_TASKS = 12_000, 16
#: Hash buckets of words, numbers in a word vector, non-zeros of an index vector, places on each side.
BUCKETS, SIZE, NONZERO, WINDOW = 1 << 14, 32, 4, 2
HIDDEN, EPOCHS, RATE, BATCH = 24, 60, 0.01, 128
#: Bytes of text worked on at once.
PIECE = 1 << 21


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zeros of each bucket's index vector."""
    drawn = mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + np.uint64(1)).reshape(BUCKETS, NONZERO)
    return (drawn % np.uint64(SIZE)).astype(np.int64), np.where(drawn >> np.uint64(63), 1.0, -1.0)


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = word_hashes(column, lower=False)
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), counts


def neighbours(batches):
    """The sums of the neighbours' index vectors over all texts of a task, as one row."""
    places, signs = index_vectors()
    sums = np.zeros(BUCKETS * SIZE)
    for batch in pieces(batches, size=PIECE):
        words, counts = buckets(batch.column("text"))
        doc = np.repeat(np.arange(len(counts)), counts)
        for step in range(1, WINDOW + 1):
            same = np.flatnonzero(doc[step:] == doc[:-step])
            a, b = words[same], words[same + step]
            for at, near in ((a, b), (b, a)):
                for k in range(NONZERO):
                    sums += np.bincount(at * SIZE + places[near, k], weights=signs[near, k], minlength=BUCKETS * SIZE)
    yield pa.RecordBatch.from_arrays([pa.array([sums.astype(np.float32).tobytes()], pa.binary())], ["sums"])


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Features of each text."""
    words, counts = buckets(column)
    out = np.zeros((len(counts), 2 * SIZE + 2), dtype=np.float64)
    full = np.flatnonzero(counts)
    if len(full):
        found = vectors[words]
        begins = (np.cumsum(counts) - counts)[full]
        n = counts[full][:, None]
        mean = np.add.reduceat(found, begins, axis=0) / n
        out[full, :SIZE] = mean
        out[full, SIZE : 2 * SIZE] = np.sqrt(np.maximum(np.add.reduceat(found * found, begins, axis=0) / n - mean * mean, 0))
        out[full, 2 * SIZE] = np.add.reduceat((~found.any(axis=1)).astype(np.float64), begins) / counts[full]
    out[:, 2 * SIZE + 1] = np.log1p(counts)
    return out


def fit_network(x: np.ndarray, y: np.ndarray, held: np.ndarray) -> dict:
    """Weights of the network, learned on rows that are not ``held``; temperature from those that are."""
    rng = np.random.default_rng(7)
    mean, spread = x[~held].mean(axis=0), x[~held].std(axis=0) + 1e-6
    z = (x - mean) / spread
    p = {"w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN), "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(1)}
    first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    rows, step = np.flatnonzero(~held), 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(rows), max(1, len(rows) // BATCH)):
            hidden = np.tanh(z[part] @ p["w1"] + p["b1"])
            logit = hidden @ p["w2"] + p["b2"]
            slope = (1 / (1 + np.exp(-logit)) - y[part]) / len(part)
            back = np.outer(slope, p["w2"]) * (1 - hidden * hidden)
            grads = {"w1": z[part].T @ back + 1e-4 * p["w1"], "b1": back.sum(axis=0), "w2": hidden.T @ slope + 1e-4 * p["w2"], "b2": slope.sum(keepdims=True)}
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net = p | {"mean": mean, "spread": spread, "temperature": 1.0}
    check = held if held.any() else ~held
    raw = logits(net, x[check])

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, raw / t) - y[check] * raw / t))

    net["temperature"] = min((float(t) for t in np.geomspace(0.25, 8, 41)), key=loss)
    return net


def logits(net: dict, x: np.ndarray) -> np.ndarray:
    return (np.tanh((x - net["mean"]) / net["spread"] @ net["w1"] + net["b1"]) @ net["w2"] + net["b2"]) / net["temperature"]


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Word vectors and network from a bounded sample; ``labels`` has ``doc_id`` and ``label`` (0 or 1)."""
    one = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("label").cast("double")).alias("label"))
    chosen = one.withColumn("order", F.xxhash64(F.lit("sample"), "doc_id")).orderBy("order", "doc_id").limit(SAMPLE)
    chosen = stage(chosen, "chosen")  # SAMPLE rows at most, so it may be broadcast
    sample = stage(texts(docs).join(F.broadcast(chosen), "doc_id").select("text", "label", "order").repartition(SAMPLE_TASKS), "sample")
    sums = np.zeros(BUCKETS * SIZE, dtype=np.float64)
    for row in sample.select("text").mapInArrow(neighbours, "sums binary").collect():  # a row for each of SAMPLE_TASKS tasks
        sums += np.frombuffer(row.sums, dtype=np.float32)
    table = sums.reshape(BUCKETS, SIZE)
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)
    vectors = table.astype(np.float32)

    def features(batches):
        for batch in pieces(batches, size=PIECE):
            x = pooled(batch.column("text"), vectors)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column("label"), batch.column("order")], ["x", "label", "order"])

    rows = sample.mapInArrow(features, "x binary, label double, order long").collect()  # SAMPLE short rows at most, but for repeated ids
    rows.sort(key=lambda r: (r.order, r.x))
    y = np.array([r.label for r in rows])
    if len(np.unique(y)) < 2:
        return {"vectors": vectors, "constant": float(y.mean()) if len(y) else 0.5}
    x = np.array([np.frombuffer(r.x) for r in rows])
    held = np.array([r.order % 5 == 0 for r in rows])
    if held.all() or len(np.unique(y[~held])) < 2:
        held[:] = False
    return {"vectors": vectors} | fit_network(x, y, held)


SCORED = "doc_id long, held_out boolean, score double"


def score(docs: DataFrame, model: dict, held_out: Column) -> DataFrame:
    """``doc_id, held_out, score`` for each row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # vectors of fixed size and a small network

    def rows(batches):
        net = sent.value
        for batch in pieces(batches, size=PIECE):
            if "constant" in net:
                value = np.full(batch.num_rows, net["constant"])
            else:
                value = 1 / (1 + np.exp(-np.clip(logits(net, pooled(batch.column("text"), net["vectors"])), -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(value)], ["doc_id", "held_out", "score"])

    return texts(docs).withColumn("held_out", held_out).select("doc_id", "held_out", "text").mapInArrow(rows, SCORED)


def op2_quality_classifier(spark, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    labels = read(spark, folder, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    scored = score(docs, fit(docs, labels), held_out)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))
