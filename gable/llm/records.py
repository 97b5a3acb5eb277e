"""Token ids in length-delimited binary records with an offset index.

A record is ``length (u64) | masked crc of the length (u32) | payload | masked crc of the
payload (u32)``, all little-endian. The payload is the document's id (i64), a byte that
is 1 if it has one, a byte with the width of a token id, and the token ids. Checksums are
crc32, rotated right by 15 bits plus a constant, so that data which itself holds checksums
does not look valid. The index is a table of ``path, offset, doc_id, n_tokens``; readers
take records from it in any order, each by one seek in a memory-mapped file.

Documents are range-partitioned and sorted by id, one file for each partition, so files in
the order of their ranges hold ascending ids. Text moves through one shuffle; token ids
never do. Files are finished under a private name and then moved, so a lost attempt leaves
no half file, and the order within a partition is total, so a repeated one writes the same.

Encoding: texts are cut where the tokenizer's pattern always ends a match, each distinct
piece of a batch is encoded once, and the ids of texts are gathered from those of their pieces.

Defined cases: a null or empty text is the end id alone; rows without ``doc_id`` come
first; repeated rows give repeated records; an empty table gives an empty index; other
columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gable.llm.byte_pieces import BLANK, DIGIT, KIND, LETTER, MARK, QUOTE, SLICE, SPACE, PieceEncoder, encoder
from gable.llm.common import read, texts
from gable.llm.files import mapped, place
from gable.llm.tokens import pieces
from gable.runtime import scratch_path, stage

#: Fixed value of the masked checksum.
MASK_DELTA = 0xA282EAD8
#: Id that closes each document.
END_ID = 1

_HEAD = struct.Struct("<QI")
_DOC = struct.Struct("<qBB")
_SUM = struct.Struct("<I")


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + _SUM.pack(masked(length)) + payload + _SUM.pack(masked(payload))


def document(doc: int | None, width: int, ids: bytes) -> bytes:
    """The record of a document; closures that go to workers use this and not the layouts, which cannot be pickled."""
    return frame(_DOC.pack(doc or 0, doc is not None, width) + ids)


def parse_document(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc, has, width = _DOC.unpack_from(payload)
    return (doc if has else None), np.frombuffer(payload, dtype=f"<u{width}", offset=_DOC.size)


def unframe(file: np.ndarray, offset: int) -> bytes:
    """The payload of the record at ``offset``; raises if a checksum does not fit."""
    length, check = _HEAD.unpack(file[offset : offset + 12].tobytes())
    if check != masked(struct.pack("<Q", length)):
        raise ValueError(f"record at {offset}: length is damaged")
    payload = file[offset + 12 : offset + 12 + length].tobytes()
    if _SUM.unpack(file[offset + 12 + length : offset + 16 + length].tobytes())[0] != masked(payload):
        raise ValueError(f"record at {offset}: payload is damaged")
    return payload


class WordEncoder(PieceEncoder):
    """Tokenizers that fold case, drop white space and split off words, digits and runs of marks.

    Texts are cut where the pattern always ends a match, A to Z folded before; only what
    stands beside characters that are no plain ASCII stays together, so that the normaliser
    sees it whole. A run of letters goes straight to the model, all else through the tokenizer.
    """

    def is_known(self, made: dict) -> bool:
        steps = (made["normalizer"] or {}).get("normalizers") or []
        split = (made["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        known = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
        known = known and [s.get("type") for s in split] == ["Split", "ByteLevel"] and split[0]["pattern"] == {"Regex": PATTERN}
        known = known and (split[0]["behavior"], split[0]["invert"], split[1]["add_prefix_space"], split[1]["use_regex"]) == ("Removed", True, False, False)
        return known and made["post_processor"] is None and made["model"]["type"] == "BPE" and not made["model"]["dropout"]

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        folded = _LOWER[data]
        kinds = KIND[folded]
        inside = (kinds != BLANK) & (kinds != SPACE)
        begins = np.ones(len(data), dtype=bool)
        begins[1:] = _ENDS[kinds[:-1] * np.uint8(8) + kinds[1:]] | ~inside[:-1]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        for text in self.texts_with_added(folded, offsets):  # whole, in its own case
            s = slice(offsets[text], offsets[text + 1])
            folded[s], inside[s], begins[s] = data[s], True, False
            begins[offsets[text]] = True
        starts = np.flatnonzero(begins & inside)
        before = np.concatenate(([0], np.cumsum(inside)))
        return folded[inside], np.append(before[starts], before[-1]), np.diff(np.searchsorted(starts, offsets))

    def single(self, piece: str) -> str | None:
        return piece if piece.isascii() and piece.isalpha() and piece.islower() else None


#: Fixed value: the pattern of the tokenizers that ``WordEncoder`` cuts for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _between() -> np.ndarray:
    """True at [a, b] if a match always ends between a byte of kind a and one of kind b."""
    ends = np.zeros((8, 8), dtype=bool)
    ends[LETTER, [DIGIT, MARK, QUOTE]] = True
    ends[DIGIT, [DIGIT, LETTER, MARK, QUOTE]] = True
    ends[MARK, [LETTER, DIGIT]] = True
    return ends


_ENDS = _between().ravel()


INDEX = "path string, part int, row long, offset long, doc_id long, n_tokens long"


def write_records(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Writes all documents below ``folder``; returns the offset index, itself written."""

    def rows(batches):
        part = TaskContext.get().partitionId()
        store, base = place(folder)
        store.create_dir(base, recursive=True)
        name = f"part-{part:05d}.records"
        own = f"{base}/{name}.{TaskContext.get().taskAttemptId()}"
        stream, offset, row, out = None, 0, 0, []
        enc = encoder(tokenizer, WordEncoder)
        for batch in pieces(batches, size=SLICE):
            if stream is None:
                stream = store.open_output_stream(own)
            ids, counts = enc.ids(batch.column("text"))
            stops = np.cumsum(counts)
            data = np.insert(ids, stops, END_ID)
            stops = np.concatenate(([0], stops + np.arange(1, len(stops) + 1)))
            for doc, lo, hi in zip(batch.column("doc_id").to_pylist(), stops[:-1].tolist(), stops[1:].tolist(), strict=True):
                record = document(doc, enc.dtype.itemsize, data[lo:hi].tobytes())
                stream.write(record)
                out.append((row, offset, doc, hi - lo))
                offset, row = offset + len(record), row + 1
        if stream is None:
            return
        stream.close()
        store.move(own, f"{base}/{name}")
        row, offset, doc, count = zip(*out, strict=True)
        n = len(out)
        arrays = [pa.array([f"{folder}/{name}"] * n), pa.array([part] * n, pa.int32()), pa.array(row, pa.int64()), pa.array(offset, pa.int64()), pa.array(doc, pa.int64()), pa.array(count, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["path", "part", "row", "offset", "doc_id", "n_tokens"])

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return stage(ordered.mapInArrow(rows, INDEX), "index")


def read_records(index: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` digest of the records that ``index`` names, in any order: each is found by its offset."""

    def rows(batches):
        open_: dict[str, np.ndarray] = {}
        for batch in batches:
            docs, counts, crcs = [], [], []
            for path, offset in zip(batch.column("path").to_pylist(), batch.column("offset").to_pylist(), strict=True):
                if path not in open_:
                    open_[path] = mapped(path, np.uint8)
                doc, ids = parse_document(unframe(open_[path], offset))
                docs.append(doc)
                counts.append(len(ids))
                crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
            arrays = [pa.array(docs, pa.int64()), batch.column("start"), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids_crc32"])

    # tokens before each file, then before each record of it
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")), "bases")  # one row for each file
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = index.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    placed = placed.join(bases, "part").select("path", "offset", F.expr("base + inside").alias("start"))
    return placed.mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_records(spark, folder: str) -> DataFrame:
    import public_tokenizers

    index = write_records(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "records"))
    return read_records(index)
