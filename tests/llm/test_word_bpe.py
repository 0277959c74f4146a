"""Word-table encoding and decoding against the tokenizer on whole texts."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyframe.llm import tables, word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " \t\n\r\x0b\x0c ", "Hello  WORLD's don't", "é é ſ ß İ ÅΩ 日本語 テキスト",
         "a</w>b </w> <|endoftext|>x <|ENDOFTEXT|> <|startoftext|><|endoftext|>", "x" * 50_000, "　  a b  ",
         "̈a ̈ \x1c\x1d", "12345 3.14 $$$ !?!? 🙂🙃 \U0001f468‍\U0001f469", "word " * 20_000, "\x00 \x00a", "﻿bom"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", "x") for i, t in enumerate(TEXTS)] + [(None, "no id here", "c", "x"), (3, TEXTS[3], "c", "x"),
                                                                    (3, "another text of id 3", "c", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string").repartition(3)


def test_round_trip_edges(spark, docs):
    tok = Tokenizer.from_file(PATH)
    docs = tables.scratch(docs, "docs")
    got = word_bpe.decode(word_bpe.encode(docs, PATH), PATH).collect()
    want = sorted((str(r.doc_id), tok.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect())
    have = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got)
    assert have == want
    assert all(r.decoded == tok.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False) for r in got)


def test_small_blocks_share_words(spark, monkeypatch):
    monkeypatch.setattr(word_bpe, "BLOCK_BYTES", 64)
    docs = spark.createDataFrame([(i, f"same words here w{i % 7} and w{i}") for i in range(300)], "doc_id long, text string")
    docs = tables.scratch(docs.repartition(4), "docs")
    tok = Tokenizer.from_file(PATH)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in word_bpe.encode(docs, PATH).collect()}
    assert got == {i: tok.encode(f"same words here w{i % 7} and w{i}", add_special_tokens=False).ids for i in range(300)}


def test_unknown_ids_and_empty(spark):
    rows = [(1, np.array([3306, 60_000, 1002], "<u4").tobytes()), (2, None), (None, b"")]
    got = {r.doc_id: r.decoded for r in word_bpe.decode(
        spark.createDataFrame([(a, None if b is None else bytearray(b)) for a, b in rows], "doc_id long, ids binary"), PATH).collect()}
    assert got == {1: "hello</w> world</w>", 2: "", None: ""}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert word_bpe.encode(empty, PATH).collect() == []
    blank = tables.scratch(spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string"), "blank")
    assert sorted(tuple(r) for r in word_bpe.encode(blank, PATH).collect()) == [(1, b""), (2, b"")]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        word_bpe._tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_query_on_whole_table(spark):
    tok = Tokenizer.from_file(PATH)
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in word_bpe.op12_word_bpe(spark, sf).collect()}
    rows = tables.read(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t")).collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = tok.encode(r.t, add_special_tokens=False).ids
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
