"""Fingerprints combine, collisions are caught, hot groups come out whole."""

from hypothesis import given, settings
from hypothesis import strategies as st

from trip_engine.llm.exact_dedup import (
    BASES,
    Polynomial,
    _key,
    find_duplicates,
    fingerprint_chunks,
    fingerprints,
)

POLY = Polynomial(chunk=8)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=80), st.binary(max_size=80))
def test_hash_of_parts_is_hash_of_whole(a, b):
    assert POLY.combine(POLY.of_text(a), POLY.of_text(b), len(b)) == POLY.of_text(a + b)


def test_hash_is_the_plain_polynomial():
    data = bytes(range(256)) * 3
    for got, p, base in zip(POLY.of_text(data), POLY.primes, BASES):
        want = 0
        for x in data:
            want = (want * base + x + 1) % p
        assert got == want


def test_pieces_in_many_rows(spark):
    whole = {1: b"some long text " * 50, 2: b"", 3: b"x"}
    rows = [(k, i, v[i * 7:i * 7 + 7]) for k, v in whole.items() for i in range(max(1, -(-len(v) // 7)))]
    chunks = spark.createDataFrame(rows, "doc_id long, chunk_no long, data binary").repartition(4)
    got = {r["doc_id"]: (r["fp"], r["n_bytes"]) for r in fingerprint_chunks(chunks).collect()}
    assert got == {k: (_key(Polynomial().of_text(v)), len(v)) for k, v in whole.items()}


def _brute(rows):
    groups = {}
    for i, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        groups.setdefault(low, []).append(i)
    return {i: (max(g), len(g)) for g in groups.values() for i in g}


def test_collisions_are_told_apart(spark):
    """Under tiny primes many different texts share a fingerprint."""
    rows = [(i, f"{'AbC'[i % 3]}{i % 10:02d}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weak = Polynomial(primes=(3, 2))
    assert fingerprints(docs, weak).select("fp").distinct().count() <= 6
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in find_duplicates(docs, weak, chunk=2).collect()}
    assert got == _brute(rows)


def test_hot_group(spark):
    rows = [(i, "The Same Text " * 20 if i % 3 == 0 else f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = find_duplicates(docs, chunk=64).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in found} == _brute(rows)
    assert sum(r["kept"] for r in found) == 2001


def test_long_texts_are_hashed_by_chunks(spark):
    """Texts above ``whole`` bytes come out as the others do: equal rows, equal texts under
    other ids, null ids, and a text that differs in its last chunk only."""
    long, other = "Some Words " * 60, "Some Words " * 59 + "some wordZ "
    rows = [(1, long), (2, long.lower()), (2, long.lower()), (3, other), (4, "short"), (5, "SHORT"), (None, long), (6, None),
            (7, long + "x"), (8, ""), (None, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    poly = Polynomial(chunk=64)
    by_chunk = sorted(map(str, find_duplicates(docs, poly, chunk=64, whole=200).collect()))
    assert by_chunk == sorted(map(str, find_duplicates(docs, poly, chunk=64).collect()))
    kept = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in find_duplicates(docs, poly, 64, 200).collect()
            if r["doc_id"] is not None}
    assert kept == {1: (2, 4), 2: (2, 4), 3: (3, 2), 4: (5, 2), 5: (5, 2), 6: (8, 2), 7: (7, 1), 8: (8, 2)}


def test_long_texts_that_collide(spark):
    rows = [(i, f"{'AbC'[i % 3]}{i % 10:02d}" * 9) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weak = Polynomial(primes=(3, 2), chunk=4)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in find_duplicates(docs, weak, 4, 8).collect()}
    assert got == _brute(rows)
