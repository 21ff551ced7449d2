"""Token counts against the library, and the transducers against plain Python."""

import random

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from voxledger.llm import token_count as tc
from voxledger.llm.bpe import load_vocabulary, merge

VOCAB = path("byte_bpe_50k.json")
PIECES = ["s", "'s", "'re", "'", "'ll", "'l", "r", "e", "l", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "a", "Z", "é", "中", "日本", "9",
          "٣", "½", "!", "...", "_", "<|endoftext|>", "<|endoft", "\U0001f600", "́", "‍", "aaaa", "the", " the", "'VE", "'S", "ſ", "İ", "﻿"]


@pytest.fixture(scope="module")
def compiled():
    return tc.compile_machine(VOCAB)


@pytest.fixture(scope="module")
def machine(compiled):
    return tc.machine(VOCAB, compiled)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(VOCAB)
    return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


def odd_texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_equal_to_library_on_odd_texts(machine, library):
    texts = odd_texts(5000) + ["a" * 5000, "ab" * 3000, "-" * 9999, "é" * 4000, "中文" * 3000, " " * 3000, "\n" * 3000, "'re" * 2000, "x" * 50_000]
    texts.append("".join(random.Random(1).choice("abcdefghij") for _ in range(20_000)))  # one word over many chunks
    assert tc.count_texts(machine, texts).tolist() == library(texts)


def test_code_points_of_every_kind(machine, library):
    texts = [f"a{chr(k)}b 1{chr(k)}'s{chr(k)}{chr(k)} {chr(k)}" for k in range(0x110000) if not 0xD800 <= k < 0xE000 and k % 23 == 0]
    texts += [f"a{chr(k)}1 {chr(k)}" for k in (0x88F, 0xC5C, 0x1C89, 0x105C0, 0x10940, 0x323B0, 0x1E5D0)]  # newer than some Unicode tables
    assert tc.count_texts(machine, texts).tolist() == library(texts)


def test_parts_of_long_texts(machine, library, monkeypatch):
    monkeypatch.setattr(tc, "SLICE", 50)
    texts = [" ".join(odd_texts(60, k)) for k in range(30)] + ["z" * 400, "word " * 300, " " * 300 + "a" + "\n " * 100 + "b"]
    assert tc.count_texts(machine, texts).tolist() == library(texts)
    for t in texts:
        assert "".join(tc.parts(t, machine.kinds)) == t


def test_scan_composes_maps():
    rng = np.random.default_rng(3)
    maps = rng.integers(0, 10, (37, 10)).astype(np.uint8)
    got = tc.composed(maps)
    for start in range(10):
        state = start
        for k in range(37):
            state = maps[k, state]
            assert got[k, start] == state


def test_gains_are_counts_of_prefixes(machine):
    """The sum of the gains up to any byte is the number of tokens of the word's prefix."""
    v = load_vocabulary(VOCAB)
    for word in (b" international", b"aaaaaaaaaaaaaaaaaaaaaaaaa", "überraschungén".encode(), b"qzxjkvw", b" antidisestablishmentarianism"):
        begins = np.zeros(len(word), bool)
        begins[0] = True
        sums = np.cumsum(machine.count(np.frombuffer(word, np.uint8), begins), dtype=int)
        assert sums.tolist() == [len(merge(word[:k + 1], v)) for k in range(len(word))]


def test_pairs_fit_as_merges_do(machine):
    rng = random.Random(9)
    v = machine.v
    some = [rng.randrange(50_256) for _ in range(600)]
    for a, b in zip(some, some[1:]):
        assert machine.fit(a, b) == (merge(v.raw[a] + v.raw[b], v) == [a, b])
        assert machine.fit(-1, a) == (merge(v.raw[a], v) == [a])


def test_vocabulary_with_merges_out_of_order():
    """Without strict ranks pairs are decided by the merges themselves."""
    v = load_vocabulary(VOCAB)
    byte = v.byte_id
    ab, abc = len(v.raw), len(v.raw) + 1
    v.raw = v.raw + [b"ab", b"abc"]
    v.merges = {(ab, byte[99]): (0, abc), (byte[97], byte[98]): (1, ab)}
    m = tc.Machine(v, np.zeros(0x110000, np.uint8))
    assert not m.ranked
    word = b"abcabxabc"
    begins = np.arange(len(word)) == 0
    assert m.count(np.frombuffer(word, np.uint8), begins).sum() == len(merge(word, v))


def test_restart_keeps_counts(compiled, library, monkeypatch):
    monkeypatch.setattr(tc, "STATES", 10)
    texts = odd_texts(300, 8)
    for k in range(0, 300, 100):
        m = tc.machine(VOCAB, compiled)
        assert tc.count_texts(m, texts[k:k + 100]).tolist() == library(texts[k:k + 100])


def test_rows(odd, empty, library):
    rows = tc.token_counts(odd, VOCAB, 50).collect()
    texts = {r.doc_id: r.text or "" for r in odd.where("doc_id <> 9").collect()}
    assert len(rows) == odd.count()  # repeated rows and rows without id stay
    assert sum(r.doc_id == 9 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 2
    for r in rows:
        if r.doc_id in texts:
            t = texts[r.doc_id]
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), library([t])[0], library([t])[0] > 50)
    assert tc.token_counts(empty, VOCAB).count() == 0
    assert tc.token_counts(odd.withColumn("text", F.lit(None).cast("string")), VOCAB).agg(F.max("n_tokens")).first()[0] == 0


def test_query_equals_library(spark, sf, table_of, library):
    from voxledger.llm.catalog import QUERIES

    texts = {r.doc_id: r.text or "" for r in table_of("documents").select("doc_id", "text").collect()}
    want = dict(zip(texts, library(list(texts.values()))))
    rows = QUERIES["op11_token_counts"](spark, sf).collect()
    assert len(rows) == len(texts)
    assert all((r.n_tokens, r.n_bytes, r.over_limit) == (want[r.doc_id], len(texts[r.doc_id].encode()), want[r.doc_id] > 1024) for r in rows)
