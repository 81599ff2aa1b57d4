from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_support import ODD_PAIRS, make_documents, paths
from tokenizers import Tokenizer

from gaugemill.llm.token_files import (
    CachedTokenizer,
    decode_codes,
    encode_codes,
    read_token_files,
    write_token_files,
)
from gaugemill.llm.words import slices, utf8

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "It's <|x a.b (c) 12-34 3.14 “quoted”… naïve × 5÷2 don't.",
    "ÀÉ Straße ΣΑΣ İstanbul   nbsp x",
    "<|STARTOFTEXT|> hi",
    "a<|endoftext|>b",
    "été x",
    "'s 'll || ...,, \x1c a\x85b \x0b c",
    "x" * 300 + " " + "!" * 300,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_codes_come_back(codes):
    control, data = encode_codes(np.array(codes, np.int64))
    assert len(control) == -(-len(codes) // 4)
    assert decode_codes(control, data, len(codes)).tolist() == codes


def test_small_codes_are_short():
    control, data = encode_codes(np.array([1, 255, 256, 65_535, 65_536]))
    assert (len(control), len(data)) == (2, 1 + 1 + 2 + 2 + 3)


def cached(tokenizer, texts):
    found = []
    for _, _, data, offsets in slices(pa.array(texts, pa.string())):
        ids, counts = tokenizer.encode_all(data, offsets)
        found += [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]
    return found


def test_cached_tokenizer_equals_the_library(library):
    tokenizer = CachedTokenizer(PATH, 1)
    for texts in (["", None, *ODD], ODD[:2], ["", " "]):
        assert cached(tokenizer, texts) == [ids_of(library, text) for text in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aBé ß.,!'|3÷×ΣИ\ń <>"), max_size=30), min_size=1))
def test_cached_tokenizer_on_any_text(library, texts):
    assert cached(CACHED, texts) == [ids_of(library, text) for text in texts]


CACHED = CachedTokenizer(PATH, 1)


def test_files_come_back(spark, library, tmp_path):
    pairs = ODD_PAIRS + [(20 + i, text) for i, text in enumerate(ODD)]
    new_path = paths(tmp_path)
    path = new_path()
    write_token_files(
        make_documents(spark, pairs), path, PATH, library.get_vocab_size(), staging=new_path()
    )
    found = rows(read_token_files(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32"))
    order, start, expected = [], 0, []
    for doc_id, text in pairs:
        ids = ids_of(library, text)
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        order.append((doc_id is not None, doc_id or 0, len(ids), crc, doc_id))
    for _, _, size, crc, doc_id in sorted(order, key=lambda x: x[:4]):
        expected.append((doc_id, start, size, crc))
        start += size
    assert found == sorted(expected, key=repr)


def test_frequent_ids_get_small_codes(spark, library, tmp_path):
    new_path = paths(tmp_path)
    path = new_path()
    docs = make_documents(spark, [(i, "the the the cat") for i in range(5)])
    write_token_files(docs, path, PATH, library.get_vocab_size(), staging=new_path())
    first = spark.read.parquet(f"{path}/ranks").orderBy("code").limit(1).collect()[0]
    assert [first.id] == library.encode("the", add_special_tokens=False).ids


def test_empty_table(spark, library, tmp_path):
    new_path = paths(tmp_path)
    path = new_path()
    write_token_files(make_documents(spark, []), path, PATH, library.get_vocab_size(), staging=new_path())
    assert read_token_files(spark, path).count() == 0


def cached_ids(tokenizer, texts):
    data, offsets = utf8(pa.array(texts, pa.string()))
    ids, counts = tokenizer.encode_all(data, offsets)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_every_latin_letter_beside_every_mark(library):
    tokenizer = CachedTokenizer(PATH, 1)
    marks = ".,!?;:%$&#*|'\"-_()/@+="
    letters = [chr(x) for x in (*range(0x41, 0x5B), *range(0xC0, 0x280))]
    texts = [
        " ".join(f"AL{a}{m} {m}{a}b x{a} {a}{m}{a} {a}" for m in marks) for a in letters
    ]
    texts += ["ALİ.", "BUGÜN İLGİLİ, EVET.", "İSTANBUL'DA İYİ! Işık, ILIK; ığdır İ İ."]
    assert cached_ids(tokenizer, texts) == [ids_of(library, text) for text in texts]


def test_words_of_one_hash(library):
    def word(k, a="a", b="b"):
        return a if k == 0 else word(k - 1, a, b) + word(k - 1, b, a)

    one, two = word(9), word(9, "b", "a")
    for texts in ([one, two], [two, f"{one} {two}"]):
        tokenizer = CachedTokenizer(PATH, 1)
        for _ in range(2):
            assert cached_ids(tokenizer, texts) == [ids_of(library, x) for x in texts]
            for text in texts:
                assert cached_ids(tokenizer, [text]) == [ids_of(library, text)]
