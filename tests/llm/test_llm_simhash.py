"""Fingerprints, fuzzy keys, links and components against brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from conftest import SF_SMOKE
from trip_engine.llm import simhash
from trip_engine.llm.components import connected_components


def _plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def _components(prints):
    """doc -> smallest linked doc, over all pairs."""
    arr = np.array([p for _, p in prints], np.uint64)
    links = []
    for i in range(len(arr)):
        near = np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= 4) + i + 1
        links += [(prints[i][0], prints[j][0]) for j in near]
    return _roots([d for d, _ in prints], links)


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", ["", "one", "One two", "a b c d", "a b c d e", "A\tb\x0bc\nd  É f\x1cg h", "w " * 50])
def test_fingerprint(text):
    assert simhash.simhash(text.encode()) == _plain(text)


def test_fingerprint_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(500))
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 64)
    assert simhash.simhash(text.encode()) == _plain(text)


def test_golay_decoder_is_perfect():
    table = simhash.golay_decoder()
    assert set(np.bincount(table, minlength=4096)) == {2048}
    zero = np.flatnonzero(table == 0)
    assert np.bitwise_count(zero.astype(np.uint32)).max() == 3


def test_every_near_pair_shares_a_key():
    rnd = random.Random(3)
    for _ in range(1500):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), rnd.randint(0, 4)):
            b ^= 1 << bit
        at, keys = simhash.fuzzy_keys(np.array([a, b], np.uint64))
        assert set(keys[at == 0]) & set(keys[at == 1])


def _clustered(rnd, centers, each):
    out = set()
    for _ in range(centers):
        x = rnd.getrandbits(64)
        for _ in range(each):
            out.add(x)
            y = x
            for bit in rnd.sample(range(64), rnd.randint(1, 7)):
                y ^= 1 << bit
            out.add(y)
            if rnd.random() < 0.3:
                x = y
    return [*out]


@pytest.mark.parametrize("block", [8, simhash.BLOCK])
def test_links_connect_what_all_pairs_connect(spark, block):
    prints = _clustered(random.Random(block), 60, 25)
    frame = spark.createDataFrame([(_signed(p),) for p in prints], "fp long")
    links = [(r["u"] % 2**64, r["v"] % 2**64) for r in simhash.find_links(frame, block=block).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    every = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 4]
    assert _roots(prints, links) == _roots(prints, every)


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randint(-500, 500), rnd.randint(-500, 500)) for _ in range(450)]
    links += [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(6000, 6300)]
    got = {r["node"]: r["root"] for r in connected_components(
        spark.createDataFrame(links, "u long, v long")).collect()}
    real = [x for x in links if x[0] != x[1]]
    assert got == _roots({n for x in real for n in x}, real)


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    prints = [(r["doc_id"], _plain(r["text"])) for r in docs.collect()]
    want = _components(prints)
    got = simhash.op10_simhash_near_dedup(docs).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {d: f"{p:016x}" for d, p in prints}
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    kept = simhash.stage(spark, docs, SF_SMOKE)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(set(want.values()))
