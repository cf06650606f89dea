"""Token counts and ids equal the library's on whole and on broken texts."""

import random

import numpy as np
import pytest

from conftest import SF_SMALL
from trip_engine.llm import token_counts, tokenizing


def _library(name):
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.fixture(scope="module")
def nasty():
    rnd = random.Random(1)
    parts = ["a", "b", "'s", "'t", " ", "  ", "\n", "\t", "é", "ß", "汉", " ", "1", "٣", "!", "...", "<|endoftext|>", "<|",
             "\x1c", "\x85", "\0", "A", "ǅ", "é", "‍", "\U0001f600", "İ", "Σ", "<|startoftext|>",
             "<|ENDOFTEXT|>", "'S", "don't.", "x'.", "ͅ", "=", "z", "\xa0"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(15_000)] + [
        "a" * 5000, "ab" * 3000, " " * 999, "aaaaaaa bbbbbbb " * 100]


def test_counts(nasty):
    counter = token_counts.TokenCounter("byte_bpe_50k.json")
    want = [len(e.ids) for e in _library("byte_bpe_50k.json").encode_batch(nasty, add_special_tokens=False)]
    assert counter.count(nasty) == want


def test_counts_with_a_small_cache(nasty, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE", 50)
    monkeypatch.setattr(token_counts, "AT_ONCE", 16)
    counter = token_counts.TokenCounter("byte_bpe_50k.json")
    some = nasty[:600]
    want = [len(e.ids) for e in _library("byte_bpe_50k.json").encode_batch(some, add_special_tokens=False)]
    assert [counter.count([t])[0] for t in some] == want


def test_word_ids(nasty, monkeypatch):
    monkeypatch.setattr(tokenizing, "CACHE_WORDS", 5000)
    words = tokenizing.WordTokenizer("word_bpe_49k.json")
    want = [np.array(e.ids, "<u4").tobytes() for e in
            _library("word_bpe_49k.json").encode_batch(nasty, add_special_tokens=False)]
    assert words.encode([t.encode() for t in nasty]) == want


def test_query_over_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    want = dict(zip(texts, (len(e.ids) for e in _library("byte_bpe_50k.json").encode_batch(
        [*texts.values()], add_special_tokens=False))))
    for r in token_counts.op8_token_counts(docs).collect():
        assert r["n_tokens"] == want[r["doc_id"]] and r["over_limit"] == (r["n_tokens"] > 512)
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode())
