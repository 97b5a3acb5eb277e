"""SentencePiece models on the tokenizers library.

The model file is a protobuf; its pieces with scores and kinds, the kind of model, and the
normaliser's settings are read from the wire format. From these the same model is built:
the stored character map as normaliser, a marker for spaces with the dummy prefix, either
unigram scores or merges in the order of the scores of what they make, and byte fallback.

White space never stands inside a piece after other characters, so texts are cut before
each run of spaces and every distinct part of a batch is encoded once, by the library's
multithreaded batch call. The same parts go through the reference library: if the two ever
differ (ties between merges), the reference ids are taken and the part is counted. The ids
of every distinct part are decoded again as well; a text comes back if its parts do, since
the text of ids is that of their parts end to end.

Defined cases: a null or empty text has no ids; a null ``doc_id`` stays null; repeated rows
are encoded one by one; an empty table gives no rows; other columns are ignored by the query
and kept by ``with_ids`` (its own columns replace any of the same name).
"""

from __future__ import annotations

import re
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gable.llm.common import read, texts
from gable.llm.tokens import pieces

#: Fixed values of the format: the marker, piece kinds, model kinds.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Parts a worker remembers in a generation (beside other stages, and where this is all it does), parts in one call.
REMEMBERED, REMEMBERED_ALONE, CALL = 200_000, 500_000, 4_000

_PART = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def fields(data: bytes):
    """Number and value of each field of a protobuf message; messages and strings as bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        elif kind == 2:
            size = number()
            yield tag >> 3, data[at : at + size]
            at += size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError(f"wire type {kind}")


def parse_model(data: bytes) -> dict:
    """Pieces (text, score, kind), model kind, and normaliser settings."""
    model = {"pieces": [], "kind": UNIGRAM, "bytes": False, "map": b"", "prefix": True, "trim": True}
    for name, value in fields(data):
        if name == 1:
            piece = {1: b"", 2: struct.pack("<f", 0), 3: NORMAL} | dict(fields(value))
            model["pieces"].append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif name == 2:
            trainer = dict(fields(value))
            model |= {"kind": trainer.get(3, UNIGRAM), "bytes": bool(trainer.get(35, 0))}
        elif name == 3:
            normalizer = dict(fields(value))
            model |= {"map": normalizer.get(2, b""), "prefix": bool(normalizer.get(3, 1)), "trim": bool(normalizer.get(4, 1))}
    return model


def merges_of(found: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every way to make a piece of two pieces, best piece first."""
    usable = {text: score for text, score, kind in found if kind in (NORMAL, USER)}
    rank = {text: i for i, (text, _, _) in enumerate(found)}
    pairs = []
    for text, score in usable.items():
        splits = [(text[:i], text[i:]) for i in range(1, len(text)) if text[:i] in usable and text[i:] in usable]
        pairs += [(-score, rank[a], rank[b], a, b) for a, b in splits]
    return [(a, b) for *_, a, b in sorted(pairs)]


def build_tokenizer(model: dict):
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    found = model["pieces"]
    unknown = next(i for i, p in enumerate(found) if p[2] == UNKNOWN)
    if model["kind"] == BPE:
        core = models.BPE(
            vocab={p[0]: i for i, p in enumerate(found)}, merges=merges_of(found), unk_token=found[unknown][0], fuse_unk=True, byte_fallback=model["bytes"]
        )
    elif model["kind"] == UNIGRAM:
        core = models.Unigram([(p[0], p[1]) for p in found], unk_id=unknown, byte_fallback=model["bytes"])
    else:
        raise ValueError(f"model kind {model['kind']} is neither unigram nor merges")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model["map"])] if model["map"] else []
    if model["trim"]:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    tokenizer.normalizer = normalizers.Sequence(steps + [normalizers.Replace(" ", MARK)])
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str, decoding: bool = False) -> None:
        import sentencepiece

        with open(path, "rb") as file:
            self.model = parse_model(file.read())
        self.tokenizer = build_tokenizer(self.model)
        # cutting at spaces is exact only if no piece has a marker behind another character
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", p[0]) for p in self.model["pieces"])
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        # ids of parts as 32-bit numbers: those of late, and the generation before them
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.decoding, self.spoilt = decoding, set()
        self.differing: set[str] = set()

    def marked(self, text: str) -> str:
        normal = self.tokenizer.normalizer.normalize_str(text) if self.model["map"] or self.model["trim"] else text.replace(" ", MARK)
        return (MARK if self.model["prefix"] else "") + normal if normal else ""

    def learn(self, parts: set[str]) -> None:
        new, lead = sorted(parts), 1 if self.model["prefix"] else 0
        for lo in range(0, len(new), CALL):
            some = new[lo : lo + CALL]
            ours = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            theirs = self.reference.encode([p.replace(MARK, " ")[lead:] for p in some], num_threads=1)
            for part, a, b in zip(some, ours, theirs, strict=True):
                # the prefix alone cannot be asked of the reference, which gives nothing for an empty text
                if a != b and len(part) > lead:
                    self.differing.add(part)
                    a = b
                self.known[part] = np.asarray(a, dtype="<u4").tobytes()
            if self.decoding:
                final = [a if p not in self.differing else b for p, a, b in zip(some, ours, theirs, strict=True)]
                back = self.tokenizer.decode_batch(final, skip_special_tokens=False)
                self.spoilt.update(p for p, t in zip(some, back, strict=True) if t != p.replace(MARK, " "))

    def encode_flat(self, all_texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
        """Ids of all texts end to end, how many each has, how many of its parts took the reference's ids, how many did not come back."""
        cut = [_PART.findall(self.marked(t)) if self.cuts else [self.marked(t)] if t else [] for t in all_texts]
        parts = set(chain.from_iterable(cut))
        if len(self.known) > (REMEMBERED_ALONE if self.decoding else REMEMBERED):
            self.before, self.known = self.known, {}
        new = parts - self.known.keys()
        again = new & self.before.keys()
        self.known.update((p, self.before[p]) for p in again)
        if new := new - again:
            self.learn(new)
        odd, lost = parts & self.differing, parts & self.spoilt
        ids = [b"".join(map(self.known.__getitem__, c)) for c in cut]
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        return np.frombuffer(b"".join(ids), dtype="<u4"), counts, [sum(p in odd for p in c) if odd else 0 for c in cut], [sum(p in lost for p in c) if lost else 0 for c in cut]

    def encode_batch(self, all_texts: list[str]) -> tuple[list[list[int]], list[int]]:
        """Ids of each text as lists, and how many of its parts took the reference's ids."""
        flat, counts, odd, _ = self.encode_flat(all_texts)
        return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] if len(counts) else [], odd

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        """Texts of whole lists of ids, without the prefix."""
        lead = 1 if self.model["prefix"] else 0
        return [t[lead:] if t.startswith(" ") else t for t in self.tokenizer.decode_batch(ids, skip_special_tokens=False)]


_LOADED: dict[tuple[str, bool], Pieces] = {}


def loaded(path: str, decoding: bool = False) -> Pieces:
    """One model for each worker process and use."""
    if (path, decoding) not in _LOADED:
        _LOADED[path, decoding] = Pieces(path, decoding)
    return _LOADED[path, decoding]


def digest(path: str):
    def rows(batches):
        model = loaded(path, decoding=True)
        for batch in pieces(batches, size=1 << 21):
            flat, counts, odd, lost = model.encode_flat([t or "" for t in batch.column("text").to_pylist()])
            ids = np.split(flat, np.cumsum(counts)[:-1])
            same = [n == 0 for n in lost]
            crcs = [zlib.crc32(i.tobytes()) for i in ids]
            arrays = [batch.column("doc_id"), pa.array(counts), pa.array(crcs, pa.int64()), pa.array(odd, pa.int64()), pa.array(same)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_crc32", "n_reference", "round_trip"])

    return rows


def model_text(model: Pieces, text: str) -> str:
    """What decoding must give back: the normalised text."""
    marked = model.marked(text)
    return marked.replace(MARK, " ")[1 if model.model["prefix"] and marked else 0 :]


def with_ids(docs: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """``docs`` and the ids of each text as an array."""
    others = [c for c in docs.columns if c != column]
    schema = docs.select(*others).withColumn(column, F.array().cast("array<int>")).schema

    def rows(batches):
        model = loaded(path)
        for batch in pieces(batches, size=1 << 20):
            flat, counts, *_ = model.encode_flat([t or "" for t in batch.column("text").to_pylist()])
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, column])

    return docs.select(*others).mapInArrow(rows, schema)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op5_sentencepiece(spark, folder: str) -> DataFrame:
    return texts(read(spark, folder, "documents")).mapInArrow(digest(model_path()), "doc_id long, n_tokens long, ids_crc32 long, n_reference long, round_trip boolean")
