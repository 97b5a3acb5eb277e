"""Token ids of whole Arrow batches, each distinct piece of text encoded once.

The pattern of byte-level tokenizers always ends a token at certain places: before white
space that follows text, before the last white space of a run that text follows, and where ASCII letters,
digits and marks meet (an apostrophe keeps what follows it). Texts are cut there, the ids of
a piece do not depend on its neighbours, so the ids of a text are those of its pieces end to
end. Characters that are not plainly one kind get no cut beside them. A text that holds an
added token is encoded whole, and so are all texts if the tokenizer is of another kind.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pyarrow as pa

from gable.llm.tokens import flat

#: Pieces that a worker remembers, in each of two generations, and bytes of text it works on at once.
REMEMBERED = 120_000
SLICE = 1 << 22

#: Kinds of bytes: unsure, blank, other white space, letter, digit, mark, apostrophe, beyond ASCII.
UNSURE, BLANK, SPACE, LETTER, DIGIT, MARK, QUOTE, BEYOND = range(8)
KIND = np.zeros(256, dtype=np.uint8)
KIND[0x21:0x7F] = MARK
KIND[[*range(65, 91), *range(97, 123)]] = LETTER
KIND[48:58] = DIGIT
KIND[9:14] = SPACE
KIND[32] = BLANK
KIND[39] = QUOTE
KIND[0x80:] = BEYOND
#: First bytes of UTF-8 characters some of which are white space.
_LEADS = np.zeros(256, dtype=bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _between() -> np.ndarray:
    """True at [a, b] if a token always ends between a byte of kind a and one of kind b."""
    ends = np.zeros((8, 8), dtype=bool)
    text = [LETTER, DIGIT, MARK, QUOTE, BEYOND]
    ends[np.ix_(text, [BLANK, SPACE])] = True
    ends[SPACE, text] = True
    ends[LETTER, [DIGIT, MARK, QUOTE]] = True
    ends[DIGIT, [LETTER, MARK, QUOTE]] = True
    ends[MARK, [LETTER, DIGIT]] = True
    return ends


_ENDS = _between().ravel()


def _spaces_beyond_ascii(data: np.ndarray, kinds: np.ndarray) -> None:
    """Makes the bytes of white space beyond ASCII (and of its close relatives) unsure."""
    at = np.flatnonzero(_LEADS[data])
    if not len(at):
        return
    padded = np.concatenate((data, np.zeros(2, dtype=np.uint8)))
    lead, second, third = data[at], padded[at + 1], padded[at + 2]
    two = at[(lead == 0xC2) & ((second == 0x85) | (second == 0xA0))]
    general = (lead == 0xE2) & ((second == 0x80) | (second == 0x81))  # all general punctuation
    three = at[general | ((lead == 0xE1) & ((second == 0x9A) | (second == 0xA0))) | ((lead == 0xE3) & (second == 0x80) & (third == 0x80))]
    for spots, width in ((two, 2), (three, 3)):
        for k in range(width):
            kinds[spots + k] = UNSURE


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places in ``data`` before which a token always ends, the starts of texts among them."""
    kinds = KIND[data]
    _spaces_beyond_ascii(data, kinds)
    before, after = kinds[:-1], kinds[1:]
    ends = np.zeros(len(data) + 1, dtype=bool)
    ends[1:-1] = _ENDS[before * np.uint8(8) + after]
    lead = ((before == BLANK) | (before == SPACE)) & (after >= LETTER)  # the last of a run stands alone or leads
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    lead[inner - 1] = False
    ends[:-2] |= lead
    ends[offsets] = True
    return ends[:-1]


class PieceEncoder:
    """Ids of texts by the tokenizer stored at ``path``, by way of pieces that a worker remembers the ids of."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        made = json.loads(self.tokenizer.to_str())
        self.fits = self.is_known(made)
        self.added = [t["content"].encode() for t in made["added_tokens"]]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def is_known(self, made: dict) -> bool:
        """Whether texts may be cut as ``pieces`` does; ``made`` is the tokenizer's description."""
        raise NotImplementedError

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all pieces end to end, where each piece starts (and the end), and the number of pieces of each text."""
        raise NotImplementedError

    def single(self, piece: str) -> str | None:
        """What the model is given for a piece that its normaliser and pattern leave in one, else None."""
        raise NotImplementedError

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        if not self.fits:
            return self._joined([e.ids for e in self.tokenizer.encode_batch_fast(column.fill_null("").to_pylist(), add_special_tokens=False)])
        packed, bounds, counts = self.pieces(*flat(column))
        if len(bounds) < 2:
            return np.zeros(0, dtype=self.dtype), np.zeros(len(column), dtype=np.int64)
        parts = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(packed))])
        coded = parts.dictionary_encode()
        which = coded.indices.to_numpy()
        known = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // self.dtype.itemsize
        table = np.frombuffer(b"".join(known), dtype=self.dtype)
        each = sizes[which]
        ends = np.concatenate(([0], np.cumsum(each)))
        places = np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], each)
        places += np.arange(ends[-1])
        return table[places], np.diff(ends[np.concatenate(([0], np.cumsum(counts)))])

    def texts_with_added(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """Texts that hold an added token, which the tokenizer finds before anything else."""
        raw = data.tobytes() if self.added else b""
        found = set()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, "right")) - 1
                found.add(text)
                at = raw.find(token, max(at + 1, int(offsets[text + 1])))  # a match over two texts does no harm
        return sorted(found)

    def _known(self, pieces: list[str]) -> list[bytes]:
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = []
        for piece in pieces:
            if piece not in young:
                ids = old.get(piece)
                if ids is None:
                    missing.append(piece)
                else:
                    young[piece] = ids
        tokenize = self.tokenizer.model.tokenize
        names, ids, others = [], [], []
        for piece in missing:
            if (given := self.single(piece)) is not None:
                names.append(piece)
                ids.append([t.id for t in tokenize(given)])
            else:
                others.append(piece)
        for lo in range(0, len(others), 20_000):
            ids += [e.ids for e in self.tokenizer.encode_batch_fast(others[lo : lo + 20_000], add_special_tokens=False)]
        joined, counts = self._joined(ids)
        raw, stops = joined.tobytes(), np.cumsum(counts * self.dtype.itemsize).tolist()
        young.update((piece, raw[a:b]) for piece, a, b in zip(names + others, [0, *stops], stops, strict=False))
        return [young[piece] for piece in pieces]

    def _joined(self, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.fromiter(chain.from_iterable(ids), dtype=self.dtype, count=int(counts.sum())), counts


class ByteEncoder(PieceEncoder):
    """Byte-level tokenizers that keep all characters."""

    def is_known(self, made: dict) -> bool:
        first = made["pre_tokenizer"] or {}
        plain = made["normalizer"] is None and made["post_processor"] is None and made["model"]["type"] == "BPE" and not made["model"]["dropout"]
        return plain and first.get("type") == "ByteLevel" and first.get("use_regex") is True and not first.get("add_prefix_space")

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        begins = cuts(data, offsets)
        for text in self.texts_with_added(data, offsets):
            begins[offsets[text] + 1 : offsets[text + 1]] = False
        starts = np.flatnonzero(begins)
        return data, np.append(starts, len(data)), np.diff(np.searchsorted(starts, offsets))

    def single(self, piece: str) -> str | None:
        # all ASCII bytes but the blank stand for themselves
        return piece.replace(" ", "Ġ") if piece.isascii() and piece.removeprefix(" ").isalpha() else None


_ENCODERS: dict[tuple[type, str], PieceEncoder] = {}


def encoder(path: str, kind: type[PieceEncoder] = ByteEncoder) -> PieceEncoder:
    """One encoder for each worker process, with what it remembers."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]
