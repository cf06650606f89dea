"""Packed pieces restore every document; sequences keep all limits."""

import random
from collections import defaultdict

import numpy as np
import pytest

from conftest import SF_SMALL
from trip_engine.llm.packing import END, Example, Packer, op9_packing, pack_documents


def _library(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [[*e.ids, END] for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_round_trip(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(3)
    rows = pack_documents(docs).collect()
    source = docs.collect()
    want = dict(zip([r["doc_id"] for r in source], _library([r["text"] or "" for r in source])))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
        assert r["doc_tokens"] == len(want[r["doc_id"]]) and r["length"] == len(r["ids"]) // 4 > 0
    for doc, ids in want.items():
        at, got = 0, []
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["length"]
            got += np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert got == ids
    padding = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    total = sum(map(len, want.values()))
    assert padding <= 0.01 * total and len(sequences) <= total / 4096 + 3 * 13


def test_query_digests(spark):
    from zlib import crc32
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    ids = {(r["doc_id"], r["start"]): bytes(r["ids"]) for r in pack_documents(docs).collect()}
    for r in op9_packing(docs).collect():
        assert r["ids_crc32"] == crc32(ids[r["doc_id"], r["start"]])


def _run(examples, limits, cut, pool=16):
    packer = Packer(limits, cut, pool)
    out = [s for e in examples for s in packer.add(e)]
    return out + [*packer.finish()]


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("cut", [True, False])
def test_all_limits_hold(seed, cut):
    rnd = random.Random(seed)
    limits = (64, rnd.choice([2, 5, 64]), rnd.choice([16, 40, 64]))
    examples = []
    for i in range(300):
        n = rnd.choice([1, 2, 7, 30, 64, 200])
        examples.append(Example(i, bytes(4 * n), rnd.randint(0, n)))
    out = _run(examples, limits, cut)
    tokens, loss = defaultdict(int), defaultdict(int)
    for s in out:
        for e in s:
            assert e.start == tokens[e.doc_id]
            tokens[e.doc_id] += e.n
            loss[e.doc_id] += e.loss
        alone = not cut and len(s) == 1
        assert alone or sum(e.n for e in s) <= limits[0]
        assert alone or sum(e.loss for e in s) <= limits[2]
        assert len(s) <= limits[1]
    assert {e.doc_id: (e.n, e.loss) for e in examples} == {d: (tokens[d], loss[d]) for d in tokens}


def test_whole_examples_stay_dense():
    """Uncut, the heuristic comes close to the volume bound."""
    rnd = random.Random(8)
    examples = [Example(i, bytes(4 * rnd.randint(1, 60)), None) for i in range(2000)]
    out = _run(examples, (128, 64, 128), False, 64)
    assert len(out) <= 1.03 * sum(e.n for e in examples) / 128 + 2


@pytest.mark.parametrize("n", [1, 2, 3, 6, 10, 16])
def test_short_texts_leave_little_padding(n):
    """However short the pieces are, sequences of documents are filled."""
    from trip_engine.llm import packing
    limits = (packing.MAX_TOKENS, packing.MAX_TOKENS, packing.MAX_LOSS)
    out = _run((Example(i, bytes(4 * n)) for i in range(20_000)), limits, True, packing.POOL)
    sizes = [sum(e.n for e in s) for s in out]
    padding = sum(0 if x & (x - 1) == 0 else 4096 - x for x in sizes)
    assert sum(sizes) == 20_000 * n and padding < 0.01 * sum(sizes)


def test_documents_of_few_tokens(spark):
    """Through the operator: a table of one-word texts fills its sequences."""
    docs = spark.range(30_000).selectExpr("id AS doc_id", "'word' AS text").coalesce(1)
    rows = op9_packing(docs).groupBy("sequence_id").agg({"length": "sum"}).collect()
    sizes = [r[1] for r in rows]
    assert sum(sizes) == 60_000
    assert sum(0 if x & (x - 1) == 0 else 4096 - x for x in sizes) < 600
