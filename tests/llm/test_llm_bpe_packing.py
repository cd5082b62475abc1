"""Byte-pair coding and packing against the public library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from inciscope.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "A<|endoftext|>b <|ENDOFTEXT|> x", "<|endoftext|>", "İstanbul ǅ ΑΣ ΑΣ. ſ ﬁ K Å é ẞ",
    "a\x1cb\x85c​d﻿e ᠎ x　y", "it's I'LL x'Re 'S ''s ,'s 'sx 'llama", "١٢ ²½ Ⅷ", "\x00\x01 a",
    "x" * 1000, "ab'" * 300, "한국어 각", "\U0001f600\U0001f44d\U0001f3fd a", "'", "'s", "s'", "'l", "'r", "word " * 5000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(5)
    alphabet = [*"aAbBmMtTsS'''.,0٣²! \t\x1f\x85ΣςİıÉé한각\U0001f600‍", "<|endoftext|>", "'ll", "the"]
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1500)]


def test_ids_and_decoding_as_the_library(library):
    model = bpe.load(PATH)
    found, ends = model.encode_texts(texts())
    starts = [0, *ends[:-1]]
    for text, lo, hi in zip(texts(), starts, ends):
        ids = library.encode(text, add_special_tokens=False).ids
        assert found[lo:hi].tolist() == ids == model.encode(text), text
        assert model.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_short_and_long_words_merge_alike():
    model = bpe.load(PATH)
    rng = random.Random(3)
    for _ in range(200):
        word = "".join(rng.choice("abcdethe") for _ in range(rng.randint(1, 120)))
        ids = [*model.first[list(word[:-1].encode())].tolist(), int(model.last[ord(word[-1])])]
        assert model.encode(word) == model.long_word(ids)


def test_tables_with_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, "The cat's hat", "x"), (1, "The cat's hat", "x"), (None, None, None), (2, "", "y"), (3, " \n", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe.encode(docs, PATH)
    assert encoded.columns == ["doc_id", "ids"]
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows), key=str)
    assert sorted(((r[0], r[1]) for r in encoded.collect()), key=str) == want
    decoded = bpe.decode(encoded, PATH).collect()
    digests = bpe.round_trip_digest(docs, PATH).collect()
    for (doc_id, ids), text, digest in zip(want, sorted(decoded, key=lambda r: str((r[0], r[1]))), digests):
        assert text.decoded in {library.decode(i, skip_special_tokens=False) for _, i in want}
    by_id = {r.doc_id: r for r in digests}
    for doc_id, ids in want:
        row = by_id[doc_id]
        decoded_text = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded_text.encode()).hexdigest()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip_digest(empty, PATH).collect() == [] == bpe.encode(empty, PATH).collect()


def check_pieces(pieces, want, size):
    """Every id in exactly one piece, sequences gapless from 0, all but the last full."""
    at = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == at.get(p.sequence_id, 0)
        at[p.sequence_id] = p.offset + p.length
        assert 0 < p.length and at[p.sequence_id] <= size and p.ids_crc32 == zlib.crc32(p.ids) and len(p.ids) == 4 * p.length
    assert sorted(at) == list(range(len(at))) and [at[s] for s in sorted(at)][:-1] == [size] * (len(at) - 1)
    documents = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        documents.setdefault(str(p.doc_id), []).append(p)
    for key, ids in want.items():
        found = sorted(documents[key], key=lambda p: p.start)
        assert [p.start for p in found] == [sum(x.length for x in found[:i]) for i in range(len(found))]
        assert np.frombuffer(b"".join(p.ids for p in found), "<u4").tolist() == ids
        assert {p.doc_tokens for p in found} == {len(ids)}


@pytest.mark.parametrize("size", [4096, 16])
def test_pieces_cover_all_ids(spark, library, size):
    rows = [(k, t, 0) for k, t in enumerate([*ODD, None, "a b c " * 4000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int").repartition(5)
    want = {str(k): [*library.encode(t or "", add_special_tokens=False).ids, 2] for k, t, _ in rows}
    check_pieces(packing.pack(docs, PATH, size).collect(), want, size)


def test_repeated_ids_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id long, text string")
    pieces = packing.pack(docs, PATH).collect()
    assert sorted((str(p.doc_id), p.start, p.length) for p in pieces) == [("1", 0, 2), ("1", 0, 2), ("None", 0, 2)]
    assert packing.pack(docs.limit(0), PATH).collect() == []


def thue_morse(power):
    """Two words of 2**power letters that any polynomial hash modulo 2**64 takes for one."""
    word = [bin(i).count("1") % 2 for i in range(1 << power)]
    return "".join("ab"[b] for b in word), "".join("ba"[b] for b in word)


@pytest.mark.parametrize("power", [10, 11, 12])
def test_words_of_like_structure_keep_their_ids(spark, library, power):
    first, second = thue_morse(power)
    both = [first, second, f"{first} {second}", f"{second} é {first} {first}"]
    found, ends = bpe.load(PATH).encode_texts(both)
    for text, lo, hi in zip(both, [0, *ends[:-1]], ends):
        assert found[lo:hi].tolist() == library.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(both)), "doc_id long, text string").coalesce(1)
    want = {str(k): [*library.encode(t, add_special_tokens=False).ids, 2] for k, t in enumerate(both)}
    check_pieces(packing.pack(docs, PATH).collect(), want, 4096)


def test_words_of_one_hash_are_told_apart(monkeypatch, library):
    """Were all hashes equal, letters would still decide."""
    monkeypatch.setattr(bpe, "run_hashes", lambda data, begins, sizes: np.zeros(len(begins), np.uint64))
    text = "the cat's hat and the dog's hat, the 12 hats"
    assert bpe.load(PATH).encode_texts([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
