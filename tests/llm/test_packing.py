"""Packing: every id once, windows full, equal to concatenating and cutting in plain Python."""

import random
import zlib
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_support import SCHEMA, prose, table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gable.llm import packing
from gable.llm.byte_pieces import ByteEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_of_odd_strings_are_those_of_the_library(tokenizer):
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'ll", "s", "ab", "Z", "9", "12", ".", "<|", "<|endoftext|>", "|>", "é", "ß", "中", " ", " ", "　"]
    parts += ["\x1c", "\x1f", "\x85", " ", " ", "᠎", "​", "-", "’", "\r\n", "İ", "\U0001f600", "٠", "½", "\x00", "\x7f", "а", "т"]
    plain = [p for p in parts if "<" not in p]
    odd = ["".join(rng.choice(chosen) for _ in range(rng.randint(0, 14))) for chosen in (parts, plain) for _ in range(20_000)]
    ids, counts = ByteEncoder(PATH).ids(pa.array([*odd, None, ""]))
    whole = [e.ids for e in tokenizer.encode_batch_fast([*odd, "", ""], add_special_tokens=False)]
    assert counts.tolist() == list(map(len, whole)) and ids.tolist() == list(chain.from_iterable(whole))


def test_remembered_pieces_do_not_change_ids(tokenizer, monkeypatch):
    monkeypatch.setattr("gable.llm.byte_pieces.REMEMBERED", 50)
    encoder = ByteEncoder(PATH)
    for seed in range(6):
        texts = [prose(seed // 2, 80), prose(seed, 100)]
        assert encoder.ids(pa.array(texts))[0].tolist() == list(chain.from_iterable(e.ids for e in tokenizer.encode_batch(texts)))


def checked(docs, tokenizer, length=packing.LENGTH):
    """The pieces of ``docs``, tested against the texts."""
    found = [(r, np.frombuffer(r.ids, dtype="<u4").tolist()) for r in packing.pack(docs, PATH, length).collect()]
    windows = {}
    for r, ids in found:
        assert r.length == len(ids) > 0
        windows.setdefault(r.sequence_id, []).append((r.offset, ids))
    for number, pieces in windows.items():
        ends = 0
        for offset, ids in sorted(pieces):
            assert offset == ends
            ends += len(ids)
        assert ends == length or number == max(windows) and ends < length
    assert sorted(windows) == list(range(len(windows)))
    rest = sorted(([i, *tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in docs.select("doc_id", "text").collect()), key=str)
    whole, open_ = [], None
    for r, ids in sorted(found, key=lambda x: (x[0].sequence_id, x[0].offset)):  # a document's pieces follow each other in the stream
        if r.start == 0:
            open_ = [r.doc_id]
            whole.append(open_)
        assert r.start == len(open_) - 1 and r.doc_id == open_[0]
        open_ += ids
    assert sorted(whole, key=str) == rest
    return found


def test_pieces_of_given_documents(small, tokenizer):
    checked(small, tokenizer)
    checked(small.repartition(7), tokenizer, length=100)


def test_odd_and_empty_tables(odd, none, tokenizer):
    checked(odd, tokenizer, length=64)
    assert packing.pack(none, PATH).count() == 0


def test_clashing_columns_and_long_texts(spark, tokenizer):
    docs = table(spark, [(1, prose(1, 30_000)), (2, "a" * 20_000)]).selectExpr("*", "1 AS ids", "2 AS part", "3 AS at", "4 AS length")
    checked(docs, tokenizer)


def test_sequences_are_padded_except_at_powers_of_two(spark):
    docs = spark.createDataFrame([(i, " a" * n, "en", "s", 0) for i, n in [(1, 5), (2, 9), (3, 0)]], SCHEMA).coalesce(1)
    packed = packing.pack(docs, PATH, length=11)
    rows = packing.sequences(packed, length=11, pad_id=7).orderBy("sequence_id").collect()
    assert [(r.n_tokens, r.padded) for r in rows] == [(11, 11), (6, 11)]
    assert np.frombuffer(rows[1].ids, dtype="<u4").tolist()[6:] == [7] * 5
    assert [(p.doc_id, p.offset) for p in rows[1].pieces] == [(2, 0), (3, 5)]
    rows = packing.sequences(packing.pack(docs.where("doc_id <> 3"), PATH, length=12), length=12).orderBy("sequence_id").collect()
    assert [(r.n_tokens, r.padded) for r in rows] == [(12, 12), (4, 4)]


def test_query_digests(spark, small, tokenizer):
    from gable.llm.packing import op11_pack_sequences

    rows = op11_pack_sequences(spark, "/root/testdata/sf0.001").collect()
    ids = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], dtype="<u4") for i, t in small.select("doc_id", F.coalesce("text", F.lit(""))).collect()}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
