"""Repeated byte strings across all texts: a radix sort of suffixes, no deeper than the threshold.

Suffixes of ``LENGTH`` bytes ("windows") that are equal must end in one group; order inside
a group does not matter. Passes go from the coarse digit to the fine one, and each looks
only at what the pass before left undecided.

* Suffixes are sorted in bundles. In every window the ``DIGIT``-byte string with the
  smallest hash is its anchor; windows that follow each other mostly share it, and equal
  windows have equal anchors. First digit: the anchor. A bundle whose anchor is alone in
  the corpus holds no repeated window.
* Second digit: all bytes that the windows of a bundle cover. Bundles that agree in it are
  repeats as a whole; the earliest stays.
* Last digit, for anchors with different covers only: each window itself.

Tasks decide equal bundles among their own rows before anything is shuffled, so text that
a third of all rows share leaves a task once. Anchors with many different covers are
salted and decided in two steps; an anchor gets as many salts as keep each part of it
within ``PART_MOST`` covers, so no part grows with the input. A window is removed unless it is the first of its group
by (doc_id, start); what is removed of a text is the union of its removed windows.

Defined cases: a null or empty text has no bytes; texts shorter than ``LENGTH`` repeat
nothing; repeated rows of one ``doc_id`` are taken as the same document in the order of
their texts (equal rows: the second is removed); rows without ``doc_id`` come before all
others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gable.llm import tokens
from gable.llm.common import read, sized_join, texts
from gable.llm.tokens import flat, mix, pieces
from gable.runtime import stage

#: Bytes of a repeated string, bytes of an anchor.
LENGTH, DIGIT = 100, 32
#: Bytes of text worked on at once, bundles a task gathers before it passes them on.
PIECE, GATHER = 1 << 21, 1_500_000
#: An anchor with more different covers than this, and than this part of all of them, is salted.
HOT_LEAST, HOT_PART = 1000, 64
#: Covers of one anchor that stay together at most, whatever the part above is.
PART_MOST = 20_000
#: Bytes whose windows are bundled at once.
STRETCH = 1 << 21
_PLACE = np.uint64((1 << 22) - 1)


class Hashed:
    """Hashes of any stretch of some bytes, in constant time each."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(tokens._BYTES[data] * tokens._powers(tokens._BASE, n), out=self.sums[1:])
        self.back = tokens._powers(pow(tokens._BASE, -1, 1 << 64), n)

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[hi] - self.sums[lo]) * self.back[lo] + (hi - lo).astype(np.uint64))


def bundles(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Of each bundle: row of the text, hash of anchor, hash of cover, first and last window, place of the anchor (all in the text)."""
    data, offsets = flat(column)
    found = [stretch(data, offsets, at) for at in range(0, max(len(data) - LENGTH + 1, 1), STRETCH)]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def stretch(data: np.ndarray, offsets: np.ndarray, base: int) -> tuple[np.ndarray, ...]:
    """Bundles of the windows that start in ``STRETCH`` bytes from ``base`` on; one that goes on beyond is cut in two."""
    data = data[base : base + STRETCH + LENGTH - 1]
    none = np.zeros(0, dtype=np.int64)
    empty = (none, none.astype(np.uint64), none.astype(np.uint64), none, none, none)
    if len(data) < LENGTH:
        return empty
    hashed = Hashed(data)
    at = np.arange(len(data) - DIGIT + 1)
    anchors = hashed.of(at, at + DIGIT)
    # the smallest hash of each window, the leftmost of equal ones, by doubling
    low = (anchors & ~_PLACE) | at.astype(np.uint64)
    width, reach = LENGTH - DIGIT + 1, 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    best = (low & _PLACE).astype(np.int64)
    start = np.arange(len(best))
    row = np.searchsorted(offsets, start + base, "right") - 1
    inside = start + base + LENGTH <= offsets[row + 1]
    start, best, row = start[inside], best[inside], row[inside]
    if not len(start):
        return empty
    first = np.concatenate(([True], (best[1:] != best[:-1]) | (start[1:] != start[:-1] + 1)))
    last = np.concatenate((first[1:], [True]))
    lo, hi, place, row = start[first], start[last], best[first], row[first]
    with np.errstate(over="ignore"):
        cover = mix(hashed.of(lo, hi + LENGTH) + (place - lo).astype(np.uint64))
    shift = offsets[row] - base
    return row, anchors[place], cover, lo - shift, hi - shift, place - shift


def packed(lo: np.ndarray, hi: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (lo << 16) | ((hi - lo) << 8) | (place - lo)


def merged_runs(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of each document that follow each other without a gap; input sorted by document and start."""
    if not len(doc):
        return doc, lo, hi
    cut = np.concatenate(([True], (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1] + 1)))
    return doc[cut], lo[cut], np.maximum.reduceat(hi, np.flatnonzero(cut))


def firsts(anchor: np.ndarray, cover: np.ndarray, doc: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Marks the earliest of all rows that agree in anchor and cover."""
    order = np.lexsort((lo, doc, cover, anchor))
    a, c = anchor[order], cover[order]
    mark = np.zeros(len(order), dtype=bool)
    mark[order] = np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])))[: len(order)]
    return mark


BUNDLES = "anchor long, cover long, doc long, bundle long, until long"


def first_digit(batches):
    """Bundles of a task, equal ones decided: ``until`` is null for a bundle, else rows are removed runs ``bundle..until``."""

    def passed(parts):
        anchor, cover, doc, lo, hi, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        keep = firsts(anchor, cover, doc, lo)
        yield from rows(anchor[keep].view(np.int64), cover[keep].view(np.int64), doc[keep], packed(lo[keep], hi[keep], place[keep]), None)
        order = np.lexsort((lo[~keep], doc[~keep]))
        d, a, b = merged_runs(doc[~keep][order], lo[~keep][order], hi[~keep][order])
        with np.errstate(over="ignore"):
            spread = mix(d.astype(np.uint64) * np.uint64(31) + a.astype(np.uint64)).view(np.int64)
        yield from rows(spread, spread, d, a, b)

    def rows(anchor, cover, doc, bundle, until):
        for i in range(0, len(doc), 1 << 16):
            part = slice(i, i + (1 << 16))
            end = pa.array(until[part]) if until is not None else pa.nulls(len(doc[part]), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (anchor, cover, doc, bundle)] + [end], ["anchor", "cover", "doc", "bundle", "until"])

    parts, size = [], 0
    for batch in pieces(batches, size=PIECE):
        row, anchor, cover, lo, hi, place = bundles(batch.column("text"))
        parts.append((anchor, cover, batch.column("doc").to_numpy()[row], lo, hi, place))
        size += len(row)
        if size > GATHER:
            yield from passed(parts)
            parts, size = [], 0
    if size:
        yield from passed(parts)


def cut_out(batches):
    """The bytes of each undecided bundle."""
    for batch in batches:
        out = {"anchor": [], "doc": [], "bundle": [], "bytes": []}
        for doc, text, open_ in zip(batch.column("doc").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("open").to_pylist(), strict=True):
            for item in open_:
                lo, wide = item["bundle"] >> 16, (item["bundle"] >> 8) & 255
                out["anchor"].append(item["anchor"])
                out["doc"].append(doc)
                out["bundle"].append(item["bundle"])
                out["bytes"].append(text[lo : lo + wide + LENGTH])
        yield pa.RecordBatch.from_arrays([pa.array(out["anchor"], pa.int64()), pa.array(out["doc"], pa.int64()), pa.array(out["bundle"], pa.int64()), pa.array(out["bytes"], pa.binary())], list(out))


WINDOWS = "key long, doc long, lo long, hi long, open boolean"


def last_digit(table: pa.Table) -> pa.Table:
    """Windows of the bundles of a group: removed runs, and for salted anchors the first window of each kind, still open."""
    blobs = table.column("bytes").to_pylist()
    n = np.array([len(b) for b in blobs]) - LENGTH + 1
    data = np.frombuffer(b"".join(blobs), dtype=np.uint8)
    begin = np.cumsum(n + LENGTH - 1) - (n + LENGTH - 1)
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    start = begin[row] + step
    key = Hashed(data).of(start, start + LENGTH)
    bundle = table.column("bundle").to_numpy()[row]
    doc, lo = table.column("doc").to_numpy()[row], (bundle >> 16) + step
    anchor = table.column("anchor").to_numpy()[row].view(np.uint64)
    first = firsts(anchor, key, doc, lo)
    order = np.lexsort((lo[~first], doc[~first]))
    d, a, b = merged_runs(doc[~first][order], lo[~first][order], lo[~first][order])
    open_ = np.flatnonzero(first & table.column("hot").to_numpy(zero_copy_only=False)[row])
    with np.errstate(over="ignore"):
        keys = np.concatenate((np.zeros(len(d), dtype=np.int64), mix(key[open_] ^ mix(anchor[open_])).view(np.int64)))
    return pa.table({
        "key": pa.array(keys), "doc": pa.array(np.concatenate((d, doc[open_]))), "lo": pa.array(np.concatenate((a, lo[open_]))),
        "hi": pa.array(np.concatenate((b, lo[open_]))), "open": pa.array(np.concatenate((np.zeros(len(d), dtype=bool), np.ones(len(open_), dtype=bool)))),
    })


def numbered(docs: DataFrame) -> DataFrame:
    """``doc_id, text, doc``: ``doc`` orders documents, in the order of their ids.

    Where every row has an id of its own, ``doc`` is that id; otherwise the distinct
    (id, text) rows get the place in their order, found range by range.
    """
    rows = texts(docs)
    ids = stage(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), "ids")
    if ids.where("doc_id IS NULL OR n > 1").limit(1).count() == 0:
        return rows.withColumn("doc", F.col("doc_id"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    held = stage(ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "ranged")
    sizes = held.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    return held.join(F.broadcast(bases), "part").selectExpr("doc_id", "text", "base + (at & ((1L << 33) - 1)) AS doc")


def salted(undecided: DataFrame, total: int) -> DataFrame:
    """``anchor, salts`` of the anchors that are dealt over several groups, by their count."""
    most = min(PART_MOST, max(HOT_LEAST, total // HOT_PART))
    counts = undecided.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(f"n > {most}")
    return counts.select("anchor", F.expr(f"(n + {most - 1}) div {most}").alias("salts"))


def removed_runs(rows: DataFrame) -> DataFrame:
    """``doc, lo, hi``: runs of windows that repeat an earlier one; runs may overlap. ``rows`` has ``doc`` and ``text``."""
    found = rows.select("doc", "text").mapInArrow(first_digit, BUNDLES)
    by_anchor, by_cover = Window.partitionBy("anchor"), Window.partitionBy("anchor", "cover").orderBy("doc", "bundle")
    ranked = found.select("*", F.min("cover").over(by_anchor).alias("c0"), F.max("cover").over(by_anchor).alias("c1"), F.row_number().over(by_cover).alias("r"))
    decided = stage(ranked.where("until IS NOT NULL OR r > 1 OR c0 <> c1").selectExpr("anchor", "doc", "bundle", "until", "until IS NULL AND r = 1 AS open"), "bundles")
    whole = decided.where("NOT open").selectExpr("doc", "CASE WHEN until IS NULL THEN bundle >> 16 ELSE bundle END AS lo", "coalesce(until, (bundle >> 16) + ((bundle >> 8) & 255)) AS hi")

    undecided = decided.where("open").select("anchor", "doc", "bundle")
    by_doc = undecided.groupBy("doc").agg(F.collect_list(F.struct("anchor", "bundle")).alias("open"))
    covers = rows.select("doc", "text").join(by_doc, "doc").mapInArrow(cut_out, "anchor long, doc long, bundle long, bytes binary")
    total = undecided.count()
    marked = sized_join(covers, salted(undecided, total), ["anchor"], "left").withColumn("hot", F.expr("salts IS NOT NULL"))
    # groups of anchors that share a task; a salted anchor is in several of them
    n_groups = 16 + total // 20_000
    marked = marked.withColumn("g", F.expr(f"pmod(xxhash64(anchor, CASE WHEN hot THEN pmod(xxhash64(doc, bundle), salts) ELSE 0 END), {n_groups})"))
    windows = stage(marked.groupBy("g").applyInArrow(last_digit, WINDOWS), "windows")
    again = windows.where("open").withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("doc", "lo"))).where("r > 1")
    return whole.unionByName(windows.where("NOT open").select("doc", "lo", "hi")).unionByName(again.select("doc", "lo", "hi"))


REMAINS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def kept_bytes(text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[bytes, int, int]:
    """What stays of a text, the number of removed bytes and of removed runs."""
    if not len(lo):
        return text, 0, 0
    depth = np.zeros(len(text) + 1, dtype=np.int32)
    np.add.at(depth, lo, 1)
    np.add.at(depth, hi + LENGTH, -1)
    gone = np.cumsum(depth[:-1]) > 0
    data = np.frombuffer(text, dtype=np.uint8)
    return data[~gone].tobytes(), int(gone.sum()), int((gone & ~np.concatenate(([False], gone[:-1]))).sum())


def remove(batches):
    for batch in batches:
        out = []
        for doc, text, runs in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("runs").to_pylist(), strict=True):
            runs = runs or []
            kept, gone, spans = kept_bytes(text, np.array([r["lo"] for r in runs], dtype=np.int64), np.array([r["hi"] for r in runs], dtype=np.int64))
            out.append((doc, len(text), gone, spans, hashlib.sha256(kept).hexdigest()))
        if out:
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4])], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def op10_repeated_bytes(spark, folder: str) -> DataFrame:
    rows = numbered(read(spark, folder, "documents"))
    runs = removed_runs(rows).groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    return rows.join(stage(runs, "runs"), "doc", "left").select("doc_id", "text", "runs").mapInArrow(remove, REMAINS)
