"""Packing by concatenating and cutting: token streams of all documents, cut every ``length`` ids.

Two passes. The first encodes each text once and writes its ids with the number of ids
before it in its task (``encoded``). Sums over the tasks' totals then give every document
its place in the one long stream of ids (``placed``), without sorting or moving a text. The
second pass cuts the stream at the multiples of ``length`` (``cut``): each piece is one
boundary record with its document, its place there, its sequence and its place in that, and
its ids. Only the last sequence is not full. ``sequences`` puts the pieces of each window
together; it is padded to ``length`` unless the number of its ids is a power of two.

The written first pass fixes order and places, so a repeated task of the second gives the
same pieces. A task holds one slice of a batch at a time; what is summed on its own is one
row for each task of the first pass.

Defined cases: a null or empty text is the end id alone; rows without ``doc_id`` are packed
with a null one; repeated rows are packed as often as they occur; an empty table gives no
pieces; other columns are ignored. A document is cut as often as windows end in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gable.llm.byte_pieces import SLICE, encoder
from gable.llm.common import read, texts
from gable.llm.tokens import pieces
from gable.runtime import fits_broadcast, stage

#: Ids in a full sequence, and the id that closes each document.
LENGTH = 2048
END_ID = 1

ENCODED = "part int, inside long, doc_id long, n_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Ids of each document, written: ``part``, ids before it in that part, ``doc_id``, their number, the ids."""

    def rows(batches):
        enc = encoder(tokenizer)
        part, before = TaskContext.get().partitionId(), 0
        for batch in pieces(batches, size=SLICE):
            ids, counts = enc.ids(batch.column("text"))
            stops = np.cumsum(counts)
            data = np.insert(ids.astype("<u4"), stops, end_id)
            counts = counts + 1
            ends = np.cumsum(counts)
            bounds = np.concatenate(([0], ends)) * 4
            column = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
            arrays = [pa.array(np.full(len(counts), part, dtype=np.int32)), pa.array(before + ends - counts), batch.column("doc_id"), pa.array(counts), column.cast(pa.binary())]
            before += int(ends[-1])
            yield pa.RecordBatch.from_arrays(arrays, ["part", "inside", "doc_id", "n_tokens", "ids"])

    return stage(texts(docs).mapInArrow(rows, ENCODED), "encoded")


def placed(tokens: DataFrame) -> DataFrame:
    """``encoded`` with ``at``, the number of ids before each document in the whole stream."""
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")), "bases")
    joined = tokens.join(F.broadcast(bases) if fits_broadcast(bases) else bases, "part")
    return joined.select("doc_id", "n_tokens", (F.col("base") + F.col("inside")).alias("at"), "ids")


def cut(stream: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pieces of the documents of ``placed`` within windows of ``length`` ids."""

    def rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n, at = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n_tokens", "at"))
            ids = batch.column("ids").cast(pa.large_binary())
            bounds = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset : ids.offset + len(ids) + 1]
            first = at // length
            count = (at + n - 1) // length - first + 1
            doc = np.repeat(np.arange(len(n)), count)
            sequence = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
            start = np.maximum(sequence * length - at[doc], 0)
            stop = np.minimum((sequence + 1) * length - at[doc], n[doc])
            # documents lie end to end, and so do their pieces
            edges = np.append(bounds[doc] + 4 * start, bounds[-1])
            for lo in range(0, len(doc), 10_000):
                s = slice(lo, lo + 10_000)
                some = edges[lo : lo + 10_001]
                own = pa.Array.from_buffers(pa.large_binary(), len(some) - 1, [None, pa.py_buffer(np.ascontiguousarray(some)), ids.buffers()[2]]).cast(pa.binary())
                arrays = [batch.column("doc_id").take(pa.array(doc[s])), pa.array(start[s]), pa.array((stop - start)[s]), pa.array(n[doc[s]]), pa.array(sequence[s]), pa.array((at[doc] + start - sequence * length)[s]), own]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return stream.mapInArrow(rows, PIECES)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: boundary records with ids (unsigned 32-bit, little-endian)."""
    return cut(placed(encoded(docs, tokenizer, end_id)), length)


def sequences(packed: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, padded, ids, pieces``: one row for each window, of at most ``length`` pieces.

    ``ids`` is padded with ``pad_id`` to ``padded`` ids; ``pieces`` says which documents lie where.
    """
    piece = F.struct("offset", "length", "doc_id", "start", "doc_tokens", "ids")
    grouped = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("found"), F.sum("length").alias("n_tokens"))
    n = F.col("n_tokens")
    padded = F.when(n.bitwiseAND(n - 1) == 0, n).otherwise(length)
    joined = F.aggregate(F.col("found.ids"), F.lit(b""), lambda a, b: F.concat(a, b))
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), (F.col("padded") - n).cast("int")))
    bounds = F.transform("found", lambda p: p.dropFields("ids"))
    return grouped.withColumn("padded", padded).select("sequence_id", "n_tokens", "padded", F.concat(joined, pad).alias("ids"), bounds.alias("pieces"))


def op11_pack_sequences(spark, folder: str) -> DataFrame:
    import public_tokenizers

    found = pack(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
