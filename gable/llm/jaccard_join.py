"""Exact Jaccard join of texts on word n-grams with parity sketches.

1. A document's set of shingles is XOR-hashed: shingles are dealt into K blocks by hash,
   and each block keeps the XOR of the hashes in it. Sets are compared in size bands: a
   pair at the threshold lies in one band or two neighbouring ones, so a document is
   sketched for its own band and for the next. There a linked pair differs in at most d
   shingles, so with K > d blocks at least one block has no difference and equal words
   (pigeonhole). Empty blocks say nothing; a document keeps them as keys only if its other
   blocks number d or fewer, and K has some to spare so that this is rare.
2. Equal block words join documents with the smallest id that has the word. Tasks first do
   so among their own rows, so a key of a third of all rows leaves each task once. A
   document keeps its smallest head, which its other heads are joined with once.
   Connected components of these joins are clusters: every link lies inside one.
3. Clusters are split and verified: one-bit parity sketches (a few hundred bytes, folded to
   one width) give Hamming distances, which never exceed the symmetric difference, by a
   matrix product; parts that are not joined by pairs within the bound come apart. What is
   left is counted exactly on the sets. In both steps small clusters are packed into
   tasks; big ones are cut by size band and hash into pieces whose bytes and rows are
   bounded, and every pair of pieces that can hold a link is a task of its own.
4. Components of the links, over classes of equal sets, are the result.

No pairs inside a cluster are emitted: a piece by itself gives each document the smallest of
its connected part, its head; two pieces then give the heads that links between them lead
together, and how many links each document has.

Defined cases: a null or empty text has no shingles, is linked with nothing and is its own
component; a text of fewer words than a shingle is one shingle of all its words; a null
``doc_id`` has a null component and links nothing; rows that repeat an id are one
document for links; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gable.llm.common import BROADCAST_IDS, components, read, sized_join, texts
from gable.llm.tokens import give_back, mix, pieces, word_hashes
from gable.runtime import row_count, stage

#: Keys that a task gathers before it passes them on.
GATHER = 1_500_000
#: Bounds of a piece of a cluster: bytes of its sets, and documents.
PIECE_BYTES, PIECE_DOCS = 8_000_000, 2048
#: Bits of a parity sketch.
LEAST_BITS, MOST_BITS = 256, 16_384
#: Documents of a piece that is compared by sketches; rows of a matrix product there, and their bits.
SKETCH_DOCS, BLOCK, BLOCK_BITS = 8192, 2048, 1 << 23
#: How often the heads of documents, then the heads of those heads and so on, are led to the smallest.
LED = 4
#: Shingle columns of a matrix product.
SLAB = 2048


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; a link is ``100 * intersection >= percent * union``."""

    words: int
    percent: int

    def bands(self, largest: int) -> list[int]:
        """First set size of each band, up to past ``largest``."""
        firsts = [1]
        while firsts[-1] <= largest:
            firsts.append(max(firsts[-1] + 1, (firsts[-1] - 1) * 100 // self.percent + 1))
        return firsts

    def differences(self, together: np.ndarray) -> np.ndarray:
        """Most shingles in which two linked sets differ that have so many together."""
        return together * (100 - self.percent) // (100 + self.percent)

    def linked(self, common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (100 * common >= self.percent * (a + b - common)) & (common > 0)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within each text, end to end; how many each has."""
    hashes, counts = word_hashes(column)
    begins = np.cumsum(counts) - counts
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begins, n)
    value = np.zeros(len(doc), dtype=np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    with np.errstate(over="ignore"):
        for i in range(k):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + hashes[np.minimum(at + i, len(hashes) - 1)]) if len(hashes) else value
    place = np.cumsum(n) - n
    for d in short.tolist():  # a handful of words each
        x = np.zeros(1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for h in hashes[begins[d] : begins[d] + counts[d]]:
                x = mix(x * np.uint64(0x9E3779B97F4A7C15) + h)
            value[place[d]] = mix(x + np.uint64(counts[d]))[0]
    ends = np.cumsum(n)
    for lo, hi in zip((ends - n).tolist(), ends.tolist(), strict=True):
        value[lo:hi].sort()
    keep = np.ones(len(doc), dtype=bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return value[keep], np.bincount(doc[keep], minlength=len(counts)).astype(np.int64)


def signatures(sets: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit signatures of each set."""
    first, second = np.zeros(len(n), dtype=np.uint64), np.zeros(len(n), dtype=np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        begins = (np.cumsum(n) - n)[full]
        first[full] = np.bitwise_xor.reduceat(mix(sets), begins)
        with np.errstate(over="ignore"):
            second[full] = np.add.reduceat(mix(sets ^ np.uint64(0xA5A5A5A5)), begins)
    return first, second


def sketch_bits(n: int, rule: Rule) -> int:
    """Slots of a sketch: the fewest, within bounds, at which sets without common shingles lie beyond the bound of linked ones.

    Their distance is about half the slots, with a deviation of half the root; the bound is taken a fifth
    larger, as a set is compared with larger ones of its band and the next.
    """
    bound = 1.2 * int(rule.differences(np.int64(2 * n)))
    m = LEAST_BITS
    while m < MOST_BITS and m / 2 - 3.25 * math.sqrt(m) < bound:
        m *= 2
    return m


def parity_bits(s: np.ndarray, m: int) -> np.ndarray:
    """One bit for each of ``m`` slots, flipped by each shingle of a set."""
    return (np.bincount((mix(s + np.uint64(5)) % np.uint64(m)).astype(np.int64), minlength=m) & 1).astype(np.uint8)


def sketch(s: np.ndarray, rule: Rule) -> bytes:
    return np.packbits(parity_bits(s, sketch_bits(len(s), rule))).tobytes()


def folded(blobs: list[bytes]) -> np.ndarray:
    """Sketches as packed rows, all of the width of the narrowest; folding a parity sketch gives a parity sketch."""
    widths = np.array([len(b) for b in blobs])
    rows = np.empty((len(blobs), widths.min()), dtype=np.uint8)
    for width in np.unique(widths):
        same = np.flatnonzero(widths == width)
        whole = np.frombuffer(b"".join([blobs[i] for i in same]), dtype=np.uint8)
        rows[same] = np.bitwise_xor.reduce(whole.reshape(len(same), -1, rows.shape[1]), axis=1)
    return rows


def signs(packed: np.ndarray) -> np.ndarray:
    """Packed sketches as rows of plus and minus ones."""
    return 1 - 2 * np.unpackbits(packed, axis=1).astype(np.float32)


def describe(rule: Rule):
    def rows(batches):
        for batch in pieces(batches, size=1 << 22):
            sets, n = shingle_sets(batch.column("text"), rule.words)
            first, second = signatures(sets, n)
            ends = np.cumsum(n)
            sketches = [sketch(sets[e - k : e], rule) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
            arrays = [batch.column("doc_id"), pa.array(n), pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "s1", "s2", "sketch"])

    return rows


def joined_heads(head: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Distinct pairs of heads that are in one part; ``label`` is a row of each row's part."""
    pairs = np.stack([head, head[label]], axis=1)
    return np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)


def near_parts(packed: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray, rule: Rule) -> np.ndarray:
    """Smallest row in the part of each row that pairs of ``left`` and ``right`` within the Hamming bound make, block by block."""
    edges = [np.zeros((0, 2), dtype=np.int64)]
    bits = 8 * packed.shape[1]
    step = min(BLOCK, BLOCK_BITS // bits)
    lefts, rights = ([side[lo : lo + step] for lo in range(0, len(side), step)] for side in (left, right))
    if left is right:
        rights = lefts
    for i, a in enumerate(lefts):
        x = signs(packed[a])
        for b in rights[i if rights is lefts else 0 :]:
            same = x @ (x if b is a else signs(packed[b])).T
            # most pairs are beyond the bound of the largest sets; the others have theirs
            close = same >= bits - 2 * rule.differences(n[a].max() + n[b].max()) - 0.5
            if b is a:
                np.fill_diagonal(close, False)
            u, v = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
            least = bits - 2 * rule.differences(n[a][u][:, None] + n[b][v][None, :]) - 0.5
            edges.append(star_edges(same[np.ix_(u, v)] >= least, a[u], b[v]))
    return parts_of_edges(len(packed), np.concatenate(edges))


def star_edges(graph: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A few pairs with the same connected parts as the pairs of ``a`` and ``b`` that a boolean matrix marks."""
    label = np.arange(len(a))
    met = graph.any(axis=0)
    graph, b = graph[:, met], b[met]
    while True:
        there = np.where(graph, label[:, None], len(a)).min(axis=0, initial=len(a))
        new = np.minimum(label, np.where(graph, there[None, :], len(a)).min(axis=1, initial=len(a)))
        new = new[new]
        if (new == label).all():
            return np.concatenate((np.stack([a, a[label]], axis=1), np.stack([b, a[there]], axis=1)))
        label = new


def parts_of_edges(size: int, edges: np.ndarray) -> np.ndarray:
    """Smallest row in the connected part of each of ``size`` rows."""
    label = np.arange(size)
    u, v = edges.T
    while True:
        new = label.copy()
        np.minimum.at(new, label[u], label[v])
        np.minimum.at(new, label[v], label[u])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near(rule: Rule):
    """For a group of pieces: ``a, b``: heads that pairs within the Hamming bound lead together.

    Where a document is its own head, that is each document and the smallest of its part. Of two
    pieces only pairs across are compared.
    """

    def piece(table: pa.Table) -> pa.Table:
        cluster, docs = table.column("cluster").to_numpy(), table.column("doc_id").to_numpy()
        n, blobs, head = table.column("n").to_numpy(), table.column("sketch").to_pylist(), table.column("head").to_numpy()
        side, crossed = table.column("side").to_numpy(), table.column("crossed").to_numpy(zero_copy_only=False)
        order = np.lexsort((docs, cluster))
        out = []
        for rows in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            packed, size = folded([blobs[i] for i in rows]), n[rows]
            left = right = np.arange(len(rows))
            if crossed[rows[0]]:
                left, right = np.flatnonzero(side[rows] == 0), np.flatnonzero(side[rows] == 1)
            out.append(joined_heads(head[rows], near_parts(packed, size, left, right, rule)))
        a, b = np.concatenate(out).astype(np.int64).T
        give_back()
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return piece


def block_keys(sets: np.ndarray, n: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all documents in their two bands, and the document of each key."""
    if not len(sets):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    firsts = np.array(rule.bands(rule.bands(int(n.max()))[-1]))
    own = np.searchsorted(firsts, n, "right") - 1
    keys, docs = [], []
    for step in (0, 1):
        band = own + step
        d = rule.differences(2 * (firsts[band + 1] - 1))
        k = d + 3 + d // 16
        k = np.where(n > 0, k, 0)
        base = np.cumsum(k) - k
        doc = np.repeat(np.arange(len(n)), n)
        slot = base[doc] + (mix(sets ^ np.uint64(0x5BD1E995)) % np.repeat(k, n).astype(np.uint64)).astype(np.int64)
        order = np.argsort(slot)
        slot, value = slot[order], mix(sets + np.uint64(77))[order]
        begin = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        word, slot = np.bitwise_xor.reduceat(value, begin), slot[begin]
        owner = np.searchsorted(base, slot, "right") - 1
        block = slot - base[owner]
        filled = np.bincount(owner, minlength=len(n))
        poor = np.flatnonzero((filled <= d) & (n > 0))
        for p in poor.tolist():  # too few blocks with content: empty ones are keys as well
            empty = np.setdiff1d(np.arange(k[p]), block[owner == p])
            word, block, owner = np.concatenate((word, np.zeros(len(empty), dtype=np.uint64))), np.concatenate((block, empty)), np.concatenate((owner, np.full(len(empty), p)))
        with np.errstate(over="ignore"):
            keys.append(mix(word + mix((band[owner] * 1_000_003 + block).astype(np.uint64) + np.uint64(1))))
        docs.append(owner)
    return np.concatenate(keys), np.concatenate(docs)


def candidate_keys(rule: Rule):
    """``key, doc``: equal keys join documents; joins among a task's own rows are made here."""

    def passed(keys: np.ndarray, docs: np.ndarray):
        if not len(keys):  # texts without words alone
            return
        order = np.argsort(keys)
        keys, docs = keys[order], docs[order]
        first = np.concatenate(([True], keys[1:] != keys[:-1]))
        least = np.minimum.reduceat(docs, np.flatnonzero(first))
        heads = least[np.cumsum(first) - 1]
        own = np.stack([docs, heads], axis=1)[docs != heads]
        own = own[np.lexsort((own[:, 1], own[:, 0]))]
        own = own[np.concatenate(([True], (own[1:] != own[:-1]).any(axis=1)))[: len(own)]]
        with np.errstate(over="ignore"):
            tie = mix(mix(own[:, 0].astype(np.uint64)) + own[:, 1].astype(np.uint64) * np.uint64(3) + np.uint64(0xED6E))
        key = np.concatenate((keys[first], tie, tie)).view(np.int64)
        doc = np.concatenate((least, own[:, 0], own[:, 1]))
        for lo in range(0, len(key), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(key[lo : lo + (1 << 16)]), pa.array(doc[lo : lo + (1 << 16)])], ["key", "doc"])

    def rows(batches):
        parts, size, seen = [], 0, set()
        for batch in pieces(batches, size=1 << 22):
            sets, n = shingle_sets(batch.column("text"), rule.words)
            ids = batch.column("doc_id").to_numpy()
            # copies within the task have the class of the first; they need no keys
            first, second = signatures(sets, n)
            new = np.array([not (s in seen or seen.add(s)) for s in zip(first.tolist(), second.tolist(), strict=True)], dtype=bool)
            sets, n, ids = sets[np.repeat(new, n)], n[new], ids[new]
            keys, docs = block_keys(sets, n, rule)
            parts.append((keys, ids[docs]))
            size += len(keys)
            if size > GATHER:
                yield from passed(np.concatenate([k for k, _ in parts]), np.concatenate([d for _, d in parts]))
                parts, size, seen = [], 0, set()
        if parts:
            yield from passed(np.concatenate([k for k, _ in parts]), np.concatenate([d for _, d in parts]))

    return rows


def led_to_smallest(pairs: DataFrame) -> DataFrame:
    """``doc, head`` pairs with the same connected parts: each document by its smallest head, and once each other head with that one.

    Near copies share keys with the same few heads, so their pairs are one for a document and not one for a key.
    """
    least = F.min("head").over(Window.partitionBy("doc"))
    other = F.col("head") != F.col("least")
    return pairs.withColumn("least", least).select(F.when(other, F.col("head")).otherwise(F.col("doc")).alias("doc"), F.col("least").alias("head")).distinct()


def hamming_bound(bits: np.ndarray) -> np.ndarray:
    """Hamming distances of all rows of a matrix of plus and minus ones."""
    return (bits.shape[1] - bits @ bits.T) / 2


def parts_of(graph: np.ndarray) -> np.ndarray:
    """Smallest row number in the connected part of each row of a symmetric boolean matrix."""
    label = np.arange(len(graph))
    while True:
        best = np.where(graph, label[None, :], len(graph)).min(axis=1)
        new = np.minimum(label, best)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by products of 0/1 matrices."""
    if len(sets) == 2:
        n = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), n], [n, len(sets[1])]])
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[column] > 1  # a shingle of one document is in no intersection
    row, column = row[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, SLAB):
        a, b = np.searchsorted(column, (lo, lo + SLAB))
        x = np.zeros((len(sets), SLAB), dtype=np.float32)
        x[row[a:b], column[a:b] - lo] = 1
        total += x @ x.T
    np.fill_diagonal(total, [len(s) for s in sets])
    return total.astype(np.int64)


def links(sets: list[np.ndarray], side: np.ndarray, cross: bool, rule: Rule) -> np.ndarray:
    """Boolean matrix of the linked pairs; only of rows of different sides if ``cross``."""
    n = np.array([len(s) for s in sets])
    found = np.zeros((len(sets), len(sets)), dtype=bool)
    groups = [np.arange(len(sets))]
    if len(sets) > 16:
        close = hamming_bound(signs(folded([sketch(s, rule) for s in sets]))) <= rule.differences(n[:, None] + n[None, :]) + 0.25
        label = parts_of(close)
        groups = [np.flatnonzero(label == g) for g in np.unique(label)]
    for g in groups:
        if len(g) > 1:
            common = common_counts([sets[i] for i in g])
            found[np.ix_(g, g)] = rule.linked(common, n[g][:, None], n[g][None, :])
    np.fill_diagonal(found, False)
    return found & (side[:, None] != side[None, :]) if cross else found


def verify(rule: Rule):
    """For a group of pieces: ``a, links`` of each linked document, and ``a, b`` of the heads that links lead together."""

    def piece(table: pa.Table) -> pa.Table:
        cluster = table.column("cluster").to_numpy()
        docs, sides, head = (table.column(c).to_numpy() for c in ("doc_id", "side", "head"))
        cross = table.column("crossed").to_numpy(zero_copy_only=False)
        blobs = table.column("set").to_pylist()
        order = np.lexsort((docs, cluster))
        counts, edges = [], []
        for rows in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            sets = [np.frombuffer(blobs[i], dtype=np.uint64) for i in rows]
            graph = links(sets, sides[rows], bool(cross[rows[0]]), rule)
            hit = np.flatnonzero(graph.any(axis=1))
            counts.append(np.stack([docs[rows][hit], graph.sum(axis=1)[hit]], axis=1))
            edges.append(joined_heads(head[rows], parts_of(graph)))
        (a, links_), (x, y) = (np.concatenate(both).astype(np.int64).T for both in (counts, edges))
        give_back()
        none = pa.nulls(len(a), pa.int64()), pa.nulls(len(x), pa.int64())
        return pa.table({"a": pa.chunked_array([a, x]), "b": pa.chunked_array([none[0], pa.array(y)]), "links": pa.chunked_array([pa.array(links_), none[1]])})

    return piece


def pieces_of(members: DataFrame, rule: Rule, largest: int, words: str, most_docs: int) -> DataFrame:
    """``doc_id, cluster, tasks`` (array of ``task, side, crossed``) for the members of clusters.

    ``words`` are the 8-byte words that a document brings into its pieces, as SQL.
    """
    members = members.withColumn("words", F.expr(words))
    sizes = members.groupBy("cluster").agg(F.sum("words").alias("total"), F.count(F.lit(1)).alias("docs"))
    marked = members.join(sizes, "cluster")
    small = f"8 * total <= {PIECE_BYTES} AND docs <= {most_docs}"
    total, docs = sizes.where(small).agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("docs"), F.lit(0))).first()
    n_bins = 1 + int(max(8 * total // PIECE_BYTES, docs // PIECE_DOCS))
    few = marked.where(small).selectExpr("doc_id", "cluster", f"array(struct(pmod(xxhash64('bin', cluster), {n_bins}) AS task, 0 AS side, false AS crossed)) AS tasks")
    firsts = rule.bands(largest)
    band = F.expr(f"size(filter(array({','.join(map(str, firsts))}), f -> f <= n)) - 1")
    big = marked.where(f"NOT ({small})").withColumn("band", band)
    dealt = big.groupBy("cluster", "band").agg(F.expr(f"cast(greatest(ceil(8 * sum(words) / {PIECE_BYTES}), ceil(count(1) / {most_docs})) AS int)").alias("cuts"))
    dealt = stage(dealt, "cuts")
    here, above, below = dealt, dealt.selectExpr("cluster", "band - 1 AS band", "cuts AS up"), dealt.selectExpr("cluster", "band + 1 AS band", "cuts AS down")
    cut = big.join(here, ["cluster", "band"]).join(above, ["cluster", "band"], "left").join(below, ["cluster", "band"], "left")
    cut = cut.withColumn("x", F.expr("cast(pmod(xxhash64('piece', doc_id), cuts) AS int)"))
    name = "xxhash64('big', cluster, {0}, {1}, {2}, {3})"
    same = f"transform(sequence(0, cuts - 1), y -> struct({name.format('band', 'least(x, y)', 'band', 'greatest(x, y)')} AS task, int(x > y) AS side, x <> y AS crossed))"
    up = f"CASE WHEN up IS NULL THEN array() ELSE transform(sequence(0, up - 1), y -> struct({name.format('band', 'x', 'band + 1', 'y')} AS task, 0 AS side, true AS crossed)) END"
    down = f"CASE WHEN down IS NULL THEN array() ELSE transform(sequence(0, down - 1), y -> struct({name.format('band - 1', 'y', 'band', 'x')} AS task, 1 AS side, true AS crossed)) END"
    many = cut.selectExpr("doc_id", "cluster", f"concat({same}, {up}, {down}) AS tasks")
    return few.unionByName(many)


SET_ROWS = "doc_id long, cluster long, tasks array<struct<task: bigint, side: int, crossed: boolean>>, set binary"


def with_sets(rule: Rule):
    def rows(batches):
        for batch in pieces(batches, size=1 << 22):
            sets, n = shingle_sets(batch.column("text"), rule.words)
            ends = np.cumsum(n)
            blobs = [sets[e - m : e].tobytes() for e, m in zip(ends.tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("cluster"), batch.column("tasks"), pa.array(blobs, pa.binary())], ["doc_id", "cluster", "tasks", "set"])

    return rows


def join(docs: DataFrame, rule: Rule) -> DataFrame:
    """``doc_id, n_shingles, class_id, n_links, component_id`` for each row of ``docs``.

    ``class_id`` is the smallest document with the same set, ``n_links`` how many other
    classes that class is linked with.
    """
    rows = texts(docs)
    meta = stage(rows.mapInArrow(describe(rule), "doc_id long, n long, s1 long, s2 long, sketch binary"), "sets")
    known = meta.where("doc_id IS NOT NULL AND n > 0")
    same_set = ["s1", "s2", "n"]
    # only sets that occur again are looked up, so a frequent one is combined in each task and then broadcast
    again = known.groupBy(*same_set).agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    again = stage(again, "again")
    looked_up = F.broadcast(again) if row_count(again) <= BROADCAST_IDS else again
    class_id = F.coalesce("class_id", "doc_id").alias("class_id")
    classes = stage(known.join(looked_up, same_set, "left").select("doc_id", class_id, "n"), "classes")
    largest = classes.agg(F.max("n")).first()[0]
    if largest is None:
        return meta.selectExpr("doc_id", "n AS n_shingles", "doc_id AS class_id", "0L AS n_links", "doc_id AS component_id")

    keyed = rows.where("doc_id IS NOT NULL").mapInArrow(candidate_keys(rule), "key long, doc long")
    joined = keyed.withColumn("head", F.min("doc").over(Window.partitionBy("key"))).where("doc <> head").select("doc", "head")
    for _ in range(LED):
        joined = led_to_smallest(joined)
    named = classes.select(F.col("doc_id").alias("doc"), F.col("class_id").alias("a"))
    edges = stage(joined, "joined").join(named, "doc").join(named.withColumnsRenamed({"doc": "head", "a": "b"}), "head").select("a", "b").where("a <> b")
    clusters = components(edges)
    named_sizes = classes.where("doc_id = class_id").groupBy("doc_id").agg(F.max("n").alias("n"))

    def of(parts: DataFrame) -> DataFrame:
        return stage(named_sizes.join(parts.selectExpr("node AS doc_id", "component AS cluster"), "doc_id"), "members")

    def compared(rows: DataFrame, check, schema: str, label: str) -> DataFrame:
        """``check`` of all tasks of ``rows``: first pieces by themselves, then pairs of pieces, which know the heads found before.

        A pair of pieces therefore gives a row for each two heads that it joins, not for each document.
        """
        def tasks(part: DataFrame, crossed: bool) -> DataFrame:
            chosen = F.filter("tasks", lambda t: t["crossed"] == F.lit(crossed))
            return part.select("*", F.explode(chosen).alias("t")).select(*[c for c in part.columns if c != "tasks"], "t.*")

        alone = stage(tasks(rows.withColumn("head", F.col("doc_id")), False).groupBy("task").applyInArrow(check, schema), label)
        heads = alone.where("b IS NOT NULL").groupBy(F.col("a").alias("doc_id")).agg(F.min("b").alias("head"))
        several = rows.where(F.exists("tasks", lambda t: t["crossed"])).join(heads, "doc_id", "left")
        several = several.withColumn("head", F.coalesce("head", "doc_id"))
        return alone.unionByName(stage(tasks(several, True).groupBy("task").applyInArrow(check, schema), label))

    # sketches are small, so the clusters of shared blocks come apart before any set is sent
    sketched = pieces_of(of(clusters), rule, largest, f"4 + least(n div 32, {MOST_BITS // 64})", SKETCH_DOCS).join(meta.select("doc_id", "n", "sketch"), "doc_id").select("doc_id", "n", "cluster", "tasks", "sketch")
    members = of(components(compared(sketched, near(rule), "a long, b long", "near")))
    sets = sized_join(rows, pieces_of(members, rule, largest, "n", PIECE_DOCS), ["doc_id"], "inner").select("doc_id", "cluster", "tasks", "text")
    sets = sets.mapInArrow(with_sets(rule), SET_ROWS)
    found = compared(sets, verify(rule), "a long, b long, links long", "links")
    counts = found.where("links IS NOT NULL").groupBy(F.col("a").alias("class_id")).agg(F.sum("links").alias("n_links"))
    same = classes.select(F.col("doc_id").alias("a"), F.col("class_id").alias("b")).where("a <> b")
    # a document that repeats an id is in several classes, which are then joined through it
    split = classes.groupBy("doc_id").agg(F.countDistinct("class_id").alias("k")).where("k > 1").select("doc_id")
    bridges = same.join(split.withColumnRenamed("doc_id", "a"), "a", "left_semi")
    parts = components(found.where("b IS NOT NULL").select("a", "b").union(bridges)).withColumnsRenamed({"node": "class_id", "component": "part"})
    about = stage(classes.where("doc_id = class_id").select("class_id").distinct().join(counts, "class_id", "left").join(parts, "class_id", "left"), "about")
    out = meta.drop("sketch").join(looked_up, same_set, "left").withColumn("class_id", F.when(F.col("n") > 0, class_id))
    out = out.join(about, "class_id", "left")
    own = F.col("doc_id").isNull()
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(own, None).otherwise(F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(own, None).otherwise(F.coalesce("part", "class_id", "doc_id")).alias("component_id"),
    )


def op9_jaccard_join(spark, folder: str) -> DataFrame:
    joined = join(read(spark, folder, "documents"), Rule(words=3, percent=90))
    return joined.select("doc_id", "n_shingles", "component_id", "class_id", "n_links")
