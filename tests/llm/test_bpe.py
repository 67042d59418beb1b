"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from isobar.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@pytest.mark.parametrize("block", [8 << 20, 500])
def test_ids_and_round_trip(odd, documents, monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", block)
    rng = random.Random(4)
    mixed = [(100 + i, "".join(rng.choice("ab é漢\t\n 'stre1!?<|endoftext|>") for _ in range(rng.randrange(200)))) for i in range(60)]
    docs = odd.unionByName(documents(*mixed)).repartition(3)
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    assert set(encoded.columns) == {"doc_id", "lang", "source", "n_chars", "ids"}
    found = bpe.decode(encoded, RANKS).collect()
    expected = sorted((repr(r.doc_id), LIBRARY.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect())
    assert sorted((repr(r.doc_id), ids(r.ids), bytes(r.decoded)) for r in found) == expected
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 500)
    found = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((repr(r.doc_id), ids(r.ids), bytes(r.decoded)) for r in found) == expected


def test_empty_and_clashing(documents):
    docs = documents((1, "a b"), (2, None)).withColumn("ids", F.lit("mine")).withColumn("words", F.lit(7)).withColumn("block", F.lit(1))
    found = {r.doc_id: r for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert ids(found[1].ids) == LIBRARY.encode_ordinary("a b") and ids(found[2].ids) == [] and found[1].words == 7
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    assert bpe.encode(docs.where("doc_id = 2"), RANKS, public_tokenizers.PATTERN).count() == 1


def test_words_of_any_length():
    rng = random.Random(5)
    for n in (1, 2, 7, 40, 3000):
        word = "".join(rng.choice("etaonish") for _ in range(n)).encode()
        assert bpe.encode_word(word, RANKS) == LIBRARY._encode_single_piece(word)


def test_null_ids_stay_null(spark):
    word = bytearray(np.array(LIBRARY.encode_ordinary("é漢 word"), "<u4").tobytes())
    rows = [(1, word), (2, None), (3, bytearray()), (4, word)]
    found = {r.k: r.decoded for r in bpe.decode(spark.createDataFrame(rows, "k int, ids binary").coalesce(1), RANKS).collect()}
    assert found == {1: "é漢 word".encode(), 2: None, 3: b"", 4: "é漢 word".encode()}


def test_an_unknown_id_is_an_error(spark):
    encoded = spark.createDataFrame([(bytearray(np.array([99_999_999], "<u4").tobytes()),)], "ids binary")
    with pytest.raises(Exception, match="out of bounds"):
        bpe.decode(encoded, RANKS).collect()
