"""Word encoder of the token records: ids equal the library's for odd strings and for all given words."""

import random
from itertools import chain

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gable.llm.byte_pieces import ByteEncoder
from gable.llm.records import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_of_odd_strings(tokenizer):
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'LL", "s", "aB", "Z", "9", "12", ".", "<|", "<|endoftext|>", "<|EndOfText|>", "|>", "é", "é", "ß", "中"]
    parts += [" ", " ", "　", "\x1c", "\x1f", "\x85", " ", "​", "-", "’", "\r\n", "İ", "I", "\U0001f600", "٠", "½", "\x00", "\x7f", "Т", "Σ", "ΑΣ", "́", "Å", "ſ"]
    plain = [p for p in parts if "<" not in p]
    odd = ["".join(rng.choice(chosen) for _ in range(rng.randint(0, 14))) for chosen in (parts, plain) for _ in range(20_000)]
    encoder = WordEncoder(PATH)
    assert encoder.fits
    ids, counts = encoder.ids(pa.array([*odd, None, ""]))
    whole = [e.ids for e in tokenizer.encode_batch_fast([*odd, "", ""], add_special_tokens=False)]
    assert counts.tolist() == list(map(len, whole)) and ids.tolist() == list(chain.from_iterable(whole))


def test_all_distinct_words_of_given_documents(tokenizer):
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"])["text"].to_pylist()
    words = sorted({w for t in texts if t for w in t.split()})
    ids, counts = WordEncoder(PATH).ids(pa.array(words))
    whole = [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, whole)) and ids.tolist() == list(chain.from_iterable(whole))


def test_tokenizers_of_another_kind_are_given_whole_texts(tokenizer):
    texts = ["It's 12 o'clock", None, "Ünï <|endoftext|>"]
    other = ByteEncoder(PATH)
    assert not other.fits
    assert other.ids(pa.array(texts))[0].tolist() == list(chain.from_iterable(e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)))
