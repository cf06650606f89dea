"""The pipeline against a brute-force version, stage by stage."""

from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from conftest import SF_SMALL, SF_SMOKE
from trip_engine.llm import mixing, simhash
from trip_engine.llm.common import read_table
from trip_engine.llm.quality_rules import op7_quality_rules


def test_stages(spark, tmp_path):
    docs = read_table(spark, SF_SMALL, "documents")
    tables = {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        before = docs
        stage(spark, docs, SF_SMALL).write.parquet(out)
        docs = spark.read.parquet(out)
        tables[name] = (before, docs)

    def texts(frame):
        return {r["doc_id"]: r["text"] for r in frame.collect()}

    before, after = map(texts, tables["quality_rules"])
    kept = {r["doc_id"] for r in op7_quality_rules(tables["quality_rules"][0]).collect() if r["kept"]}
    assert set(after) == kept and all(before[d] == t for d, t in after.items())

    before, after = map(texts, tables["exact_dedup"])
    last = {}
    for d, t in before.items():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
        last[low] = max(d, last.get(low, d))
    assert set(after) == set(last.values())

    before, after = map(texts, tables["simhash_near_dedup"])
    ids = sorted(before)
    prints = np.array([simhash.simhash(before[d].encode()) for d in ids], np.uint64)
    up = list(range(len(ids)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1:] ^ prints[i]) <= 4) + i + 1:
            a, b = root(i), root(int(j))
            up[max(a, b)] = min(a, b)
    assert set(after) == {ids[root(i)] for i in range(len(ids))} and len(after) < len(before)

    before, after = tables["mix_sources"]
    want = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.op6_mix_sources(before).collect() if r["taken"]}
    assert Counter(r["doc_id"] for r in after.collect()) == want

    mixed, packed = tables["packing"]
    copies = Counter(r["doc_id"] for r in mixed.collect())
    length, total = defaultdict(int), {}
    for r in packed.collect():
        length[r["doc_id"]] += r["length"]
        total[r["doc_id"]] = r["doc_tokens"]
    assert length == {d: n * total[d] for d, n in copies.items()}


def test_run_is_the_stages(spark, tmp_path):
    docs = read_table(spark, SF_SMOKE, "documents")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_SMOKE).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    got = corpus_pipeline.run(spark, SF_SMOKE)
    assert got.columns == docs.columns

    def pieces(frame):
        return Counter((r["doc_id"], r["doc_tokens"]) for r in frame.where("start = 0").collect())
    assert pieces(got) == pieces(docs)
