"""The manifest equals a plain tree in one process, at every shape of the exchange."""

from hashlib import sha256
from zlib import crc32

import pytest

from conftest import SF_SMOKE
from trip_engine.llm import merkle
from trip_engine.llm.common import drop_scratch

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    parts = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    return sha256(b"".join(b"-" if p is None else b"%d:%s" % (len(str(p).encode()), str(p).encode())
                           for p in parts)).hexdigest()


def _tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def _climb(levels, at, node, arity):
    """Siblings of a leaf from below, and the root that ``node`` in its place leads to."""
    siblings = []
    for level in levels[:-1]:
        first = at - at % arity
        run = level[first:first + arity]
        siblings += run[:at - first] + run[at - first + 1:]
        run[at - first] = node
        node, at = _h(*run), at // arity
    return siblings, node


def brute(rows, arity=2, tamper=7):
    rows = [dict(r) for r in rows]
    for r in rows:
        r["leaf"] = _leaf(r)
    order = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        own = sorted((r for r in rows if r["lang"] == lang),
                     key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"]))
        trees[lang] = own, _tree([r["leaf"] for r in own], arity)
    top = _tree([trees[x][1][-1][0] for x in order], arity)
    out = []
    for i, lang in enumerate(order):
        own, levels = trees[lang]
        for at, r in enumerate(own):
            hit = r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % tamper == 0
            used = _leaf({**r, "n_chars": None if r["n_chars"] is None else r["n_chars"] + 1}) if hit else r["leaf"]
            low, node = _climb(levels, at, used, arity)
            high, node = _climb(top, i, node, arity)
            out.append((r["doc_id"], r["leaf"], levels[-1][0], top[-1][0], _h(*low, *high), node, node == top[-1][0]))
    return sorted(out, key=str)


def _got(frame):
    return sorted((tuple(r) for r in frame.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("shape", [merkle.Shape(), merkle.Shape(2, 2, 1), merkle.Shape(2, 1, 2), merkle.Shape(2, 0, 3),
                                   merkle.Shape(3, 1, 1)], ids=str)
def test_equals_a_plain_tree(spark, shape):
    rows = []
    for k, (lang, n) in enumerate([(None, 5), ("", 1), ("de", 37), ("en", 113), ("é", 64), ("z", 2), ("zz", 33)]):
        rows += [(1000 * k + 7 * i % 200, f"s{i % 3}" if i % 5 else None, lang, i if i % 4 else None,
                  f"text {i} é" if i % 6 else None) for i in range(n)]
    rows += [rows[40]] * 9 + [(None, None, "de", None, None)] * 3
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    assert _got(merkle.manifest(docs, shape=shape)) == brute([r.asDict() for r in docs.collect()], shape.arity)
    drop_scratch(spark)


def test_many_groups_take_the_salted_join(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FEW_GROUPS", 3)
    docs = spark.createDataFrame([(i, "s", f"l{i % 23}", i, "t" * (i % 5)) for i in range(150)], COLUMNS)
    shape = merkle.Shape(2, 1, 1)
    assert _got(merkle.manifest(docs, shape=shape)) == brute([r.asDict() for r in docs.collect()])


def test_only_tampered_rows_fail(spark):
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    rows = merkle.op12_merkle_manifest(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["verified"] == (crc32(str(r["doc_id"]).encode()) % 7 != 0)
    assert len({r["root"] for r in rows}) == 1


def test_a_lone_leaf_and_no_leaf(spark):
    one = spark.createDataFrame([(3, "s", "en", 1, "a")], COLUMNS)
    r = merkle.op12_merkle_manifest(one).first()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] == _leaf(one.first().asDict())
    assert r["proof_sha256"] == sha256(b"").hexdigest() and r["verified"]
    assert merkle.op12_merkle_manifest(one.limit(0)).collect() == []
