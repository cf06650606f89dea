"""Buckets, gains, weights and ranks equal a plain version in one process."""

import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest

from trip_engine.llm import importance as im


def _features(text, span=2):
    words = re.findall(im.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [crc32(" ".join(words[i:i + n]).encode()) % im.BUCKETS
                        for n in range(1, span + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("piece", [im.PIECE, 5, 1])
def test_buckets(monkeypatch, piece):
    monkeypatch.setattr(im, "PIECE", piece)
    split, rnd = im._splitter(), random.Random(3)
    for _ in range(1500):
        text = "".join(rnd.choice(["a", "B", "é", " ", "\n", ",", "x9", "\x80", "~", "`", "{", "\0"])
                       for _ in range(rnd.randint(0, 40)))
        for span in (1, 2, 3, 4):
            n, got = im.text_buckets(text.encode(), split, span)
            want_n, want = _features(text, span)
            assert n == want_n and sorted(got.tolist()) == sorted(want)


def _brute(docs, target):
    sides = [Counter(b for _, t in rows for b in _features(t)[1]) for rows in (docs, target)]
    s, t = sides
    all_s, all_t = sum(s.values()) + im.BUCKETS, sum(t.values()) + im.BUCKETS
    gain = {b: math.floor(1000 * math.log(float((t[b] + 1) * all_s) / float((s[b] + 1) * all_t))) for b in s}
    out, drawable = [], []
    for doc_id, text in docs:
        n, found = _features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(found), weight, score))
        if n >= 20:
            drawable.append((-score, doc_id is None, doc_id or 0))
    drawable.sort()
    rank = {x[2] if not x[1] else None: i + 1 for i, x in enumerate(drawable[:25 * len(drawable) // 100])}
    return {r[0]: (*r[1:], rank.get(r[0])) for r in out}


def test_equals_a_plain_version(spark):
    rnd = random.Random(5)
    words = ["alpha", "Beta", "gamma", "δέλτα", "x1", "the", "of"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 5, 19, 20, 21, 60])))) for i in range(300)]
    docs += [(1000, None), (None, "the of " * 30), (1001, "\n \t"), (1002, "word" * 5000)]
    target = [(i, " ".join(rnd.choice(words[:3]) for _ in range(30))) for i in range(10)] + [(99, None)]
    got = im.op13_importance_resampling(spark.createDataFrame(docs, "doc_id long, text string").repartition(7),
                                        spark.createDataFrame(target, "item_id long, text string")).collect()
    want = _brute(docs, target)
    assert len(got) == len(docs)
    assert {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in got} == want
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 1 + sum(1 for v in want.values() if v[3])))


def test_equal_rows_get_ranks_of_their_own(spark):
    docs = spark.createDataFrame([(7, "one and the same text " * 10)] * 40 + [(8, "x")], "doc_id long, text string")
    got = im.op13_importance_resampling(docs, docs.select("text", docs.doc_id.alias("item_id"))).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 11)) and len(got) == 41


def test_no_target_texts(spark):
    docs = spark.createDataFrame([(i, "word " * 30) for i in range(8)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    got = im.op13_importance_resampling(docs, none).collect()
    assert sum(r["rank"] is not None for r in got) == 2 and len({r["weight"] for r in got}) == 1
