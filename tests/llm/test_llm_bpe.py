"""Encoding by distinct words against the tokenizers library on whole texts."""

import hashlib
import os
import random

import numpy as np
import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"

from panelforge.llm import bpe, frames
from panelforge.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.vocabulary(bpe.read(bpe.VOCABULARY))


def whole(library, text):
    return library.encode(text, add_special_tokens=False).ids


def odd_texts():
    rng = random.Random(5)
    alphabet = ["a", "B", "é", "ß", "日", "本", "١", "½", "Ⅷ", "'", "'s", "'ll", "’", " ", "  ", "\t", "\n", "\r\n", " ", " ",
                "‍", "😀", "👩‍👩‍👧", "�", "\x00", "\x1c", "\x85", "0", "12", "<|endoftext|>", "<|endof", "!", "?!", "\U00011f02",
                "՘", "࢏", "́", "ﬁ", "﻿", "ा", "க்", "ไทย"]
    texts = ["", " ", "\n", "a", "'s", "<|endoftext|>", "<|endoftext|><|endoftext|>x", " <|endoftext|> ", "x" * 5000, "ab " * 3000,
             " " * 3000 + "x", "\n" * 501]
    return texts + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(1500)]


def test_words_join_to_the_text_and_encode_alike(vocabulary, library):
    for text in odd_texts():
        words = vocabulary.words(text)
        assert "".join(words) == text
        ids, lengths = vocabulary.encode(words)
        assert ids.tolist() == whole(library, text) and int(lengths.sum()) == len(ids), repr(text)
        assert vocabulary.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False) == text


def test_split_agrees_with_the_library_on_every_known_character(vocabulary):
    import unicodedata

    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    for i in range(0, len(points), 4000):
        text = "\n".join(f"a{chr(c)}b1{chr(c)}2!{chr(c)}? {chr(c)}{chr(c)}  x" for c in points[i:i + 4000])
        assert vocabulary.find(text) == [text[a:b] for _, (a, b) in vocabulary.library_split(text)], hex(points[i])


def test_invalid_utf8_decodes_as_the_library_does(vocabulary, library):
    rng = np.random.default_rng(1)
    for _ in range(300):
        ids = rng.integers(0, 50257, size=8)
        assert vocabulary.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


@pytest.mark.parametrize("chunk_chars", [60, 24_000_000])
def test_encode_and_decode(spark, library, chunk_chars):
    texts = odd_texts()[:400]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(7, "the id again", "y"), (7, None, "z"), (None, "no id", "w"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(5)
    got = bpe.decode(bpe.encode(df, chunk_chars=chunk_chars, bucket_chars=500)).collect()

    def key(r):
        return str(r[0]), str(r[1])

    want = sorted([(i, np.array(whole(library, t or ""), dtype="<u4").tobytes(), t or "") for i, t, _ in rows], key=key)
    assert sorted([(r.doc_id, bytes(r.ids), r.decoded) for r in got], key=key) == want


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.decode(bpe.encode(empty)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert sorted((r.doc_id, bytes(r.ids), r.decoded) for r in bpe.decode(bpe.encode(nothing)).collect()) == [(1, b"", ""), (2, b"", "")]


def test_each_word_of_the_corpus_is_encoded_once(spark):
    source = bpe.read(bpe.VOCABULARY)
    df = spark.range(200).selectExpr("id AS doc_id", "concat('same words here ', id % 7) AS text").repartition(6)
    lists = bpe.split(df, source, 8, chunk_chars=300).where("bucket >= 0").collect()
    of = {}
    for r in lists:
        for w in frames.unpack_words(bytes(r.payload)):
            of.setdefault(w, set()).add(r.bucket)
    assert all(len(b) == 1 for b in of.values())  # all occurrences of a word meet in one bucket
    assert set(of) == {b"same", b" words", b" here"} | {f" {i}".encode() for i in range(7)}


def test_frames_round_trip():
    arrays = [np.arange(5, dtype=np.uint32), np.empty(0, dtype=np.int64), np.array([-3, 2**40], dtype=np.int64)]
    for a, b in zip(arrays, frames.unpack(frames.pack(*arrays))):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
    words = [b"", b"\x00", "é".encode(), b"x" * 300]
    assert frames.unpack_words(frames.pack_words(words)) == words and frames.unpack_words(frames.pack_words([])) == []
    assert frames.narrow(np.array([255])).dtype == np.uint8 and frames.narrow(np.array([256])).dtype == np.uint16


def test_query(spark, small_dir, library):
    out = QUERIES["op12_bpe_codec"](spark, small_dir).collect()
    texts = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in texts:
        ids = whole(library, r.text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, dtype="<u4").tobytes(), (r.text or "").encode())]
        want.append((r.doc_id, len(ids), *sha))
    assert sorted(tuple(r) for r in out) == sorted(want)
