"""Operator 10: near duplicates by SimHash with Golay-code fuzzy keys.

Fingerprint: XXH64 (seed 42) of every shingle of four words, bit by bit
majority. Documents whose fingerprints differ in at most four bits are linked,
and a component is everything reachable over links.

Links are found without comparing all pairs. The 64 bits are cut into
segments of 23, 23 and 18 bits. Four errors over three segments leave two
segments with at most two errors together (pigeonhole). Each segment is
decoded by the perfect binary Golay code (23, 12) to the index of the nearest
codeword; a word also gets the indices its one-bit neighbours decode to. For a
pair of segments a fingerprint emits (near index, own index) and (own index,
near index): with at most two errors in the pair, two fingerprints always
share such a key, so no link is lost. Keys are joined and every candidate is
verified on all 64 bits.

Scale: equal fingerprints are one node, so copies are never expanded. A key
held by many fingerprints is split into blocks and each pair of blocks is
compared in a task of its own; from each block only a spanning forest of the
links leaves the task, not the pairs. Components are found by distributed
large-star / small-star rounds over written tables.

Defined cases: null and empty texts (and texts without words) have
fingerprint zero, linked like any other; repeated rows come back as often as
they occur (the pipeline stage returns one); a null ``doc_id`` is linked but
never names a component while the component has another id; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import prepare_workers, materialize, utf8
from trip_engine.llm.components import connected_components
from trip_engine.llm.exact_dedup import row_hash

SHINGLE = 4
MAX_BITS = 4
SEED = 42
HASHES_AT_ONCE = 1 << 16
BLOCK = 1024               # fingerprints of one key that are compared in one task
GOLAY_GENERATOR = 0xC75    # x^11+x^10+x^6+x^5+x^4+x^2+1
SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = ((0, 1), (0, 2), (1, 2))


def simhash(data: bytes, width: int = SHINGLE) -> int:
    words = data.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return _majority([xxhash.xxh64_intdigest(b" ".join(words), SEED)])
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words))).tolist()
    ends = ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    return _majority([digest(text[a:b], SEED) for a, b in zip(starts, ends)])


def _majority(hashes: list[int]) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = np.array(hashes[at:at + HASHES_AT_ONCE], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, row_hash (of the text as it is) and fp (the 64 bits as a signed
    long), in one narrow pass."""
    prepare_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([simhash(x, width) for x in b.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(prints.view(np.int64))], ["doc_id", "row_hash", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("row_hash"),
                       utf8().alias("data")) \
        .mapInArrow(run, "doc_id bigint, row_hash bigint, fp bigint")


@lru_cache(maxsize=1)
def golay_decoder() -> np.ndarray:
    """For each 23-bit word the index (12 bits) of the nearest codeword."""
    index = np.arange(1 << 12, dtype=np.uint32)
    rest = index << np.uint32(11)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> np.uint32(bit) & np.uint32(1),
                        rest ^ np.uint32(GOLAY_GENERATOR << (bit - 11)), rest)
    words = index << np.uint32(11) | rest
    one = [1 << i for i in range(23)]
    errors = [0, *one, *(a | b for i, a in enumerate(one) for b in one[:i]),
              *(a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j])]
    table = np.empty(1 << 23, np.uint16)
    for e in errors:  # perfect code: every word is hit exactly once
        table[words ^ np.uint32(e)] = index
    return table


def near_indices(words: np.ndarray, bits: int) -> np.ndarray:
    """Own index in column 0, then those of the one-bit neighbours."""
    flips = np.array([0] + [1 << i for i in range(bits)], np.uint32)
    return golay_decoder()[words[:, None] ^ flips[None, :]].astype(np.int64)


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``prints``, key) pairs, each once."""
    near = []
    for shift, bits in SEGMENTS:
        mask = np.uint64((1 << bits) - 1)
        near.append(near_indices((prints >> np.uint64(shift) & mask).astype(np.uint32), bits))
    at, keys = [], []
    for number, (a, b) in enumerate(PAIRS):
        own_a, own_b = near[a][:, :1], near[b][:, :1]
        for grid in (near[a] << 12 | own_b, own_a << 12 | near[b]):
            grid = np.sort(grid | number << 24, axis=1)
            fresh = np.ones(grid.shape, bool)
            fresh[:, 1:] = grid[:, 1:] != grid[:, :-1]
            rows = np.nonzero(fresh)
            at.append(rows[0])
            keys.append(grid[rows])
    at, keys = np.concatenate(at), np.concatenate(keys)
    both = np.unique(at.astype(np.int64) << 26 | keys)  # (own, own) comes from both grids
    return both >> 26, both & ((1 << 26) - 1)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prints = b.column(0).to_numpy()
        for lo in range(0, len(prints), 4096):
            part = prints[lo:lo + 4096]
            at, keys = fuzzy_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(part[at]), pa.array(keys)], ["fp", "key"])


class _Forest:
    """Union-find over the links one task has seen: a link that joins nothing
    new is not emitted. Emptied when large, which only repeats links."""

    def __init__(self, limit: int = 500_000):
        self.up: dict[int, int] = {}
        self.limit = limit

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def joins(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if len(self.up) > self.limit:
            self.up.clear()
        self.up[max(a, b)] = min(a, b)
        return True


def _links_of(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs among neighbours of equal key (sorted by key)."""
    left = np.arange(len(keys))
    step = 1
    while len(left):
        left = left[left + step < len(keys)]
        left = left[keys[left] == keys[left + step]]
        a, b = prints[left], prints[left + step]
        near = np.bitwise_count(a ^ b) <= max_bits
        if near.any():
            yield a[near], b[near]
        step += 1


def _verify(max_bits: int):
    """Sorted (group, fp) rows to a spanning forest of the links within each group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        keys, prints = np.empty(0, np.int64), np.empty(0, np.uint64)

        def links(keys, prints):
            us, vs = [], []
            for a, b in _links_of(keys, prints, max_bits):
                for u, v in zip(a.view(np.int64).tolist(), b.view(np.int64).tolist()):
                    if forest.joins(u, v):
                        us.append(u)
                        vs.append(v)
            return pa.RecordBatch.from_arrays(
                [pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

        for b in batches:
            k = b.column(0).to_numpy(zero_copy_only=False)
            keys = np.concatenate([keys, k])
            prints = np.concatenate([prints, b.column(1).to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last group may go on
            if whole:
                yield links(keys[:whole], prints[:whole])
                keys, prints = keys[whole:], prints[whole:]
        yield links(keys, prints)
    return run


def find_links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(u, v): links between different fingerprints (column ``fp``) that connect
    all fingerprints connected by links of at most ``max_bits`` bits."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the keys cover up to {MAX_BITS} differing bits")
    prepare_workers(prints.sparkSession)
    nodes = materialize(prints.select("fp").distinct(), "simhash-nodes")
    keyed = nodes.mapInArrow(_emit_keys, "fp bigint, key bigint")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = materialize(sizes.where(F.col("n") > block).withColumn(
        "blocks", F.ceil(F.col("n") / (block // 2)).cast("long")).select("key", "blocks"), "simhash-crowded")
    if crowded.isEmpty():
        grouped = keyed.select(F.col("key").alias("grp"), "fp")
    else:
        own = F.pmod(F.xxhash64("fp", "key"), F.col("blocks"))
        other = F.explode(F.expr("sequence(cast(0 as bigint), blocks - 1)"))
        dealt = keyed.join(crowded, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long"))) \
            .withColumn("own", own).withColumn("other", other)
        grouped = dealt.select(F.when(F.col("blocks") == 1, F.col("key")).otherwise(
            F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))).alias("grp"), "fp")
    dealt_out = grouped.repartition("grp").sortWithinPartitions("grp")
    return dealt_out.mapInArrow(_verify(max_bits), "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, width: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, row_hash, fp (signed long), component_id, is_rep: one row per document.
    A component's representative has its smallest id (a null id is the largest) and,
    among texts of that id, the smallest row_hash."""
    prints = materialize(fingerprints(docs, width), "simhash-prints")
    labels = connected_components(find_links(prints, max_bits))  # node, root
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash")
    classes = prints.groupBy("fp").agg(F.min(place).alias("first"))
    rooted = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    reps = materialize(rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(
        F.min("first").alias("rep")), "simhash-ids")
    root_of = materialize(rooted.select("fp", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    named = materialize(root_of.join(reps, "root").select(
        "fp", F.col("rep.doc_id").alias("component_id"), F.col("rep.row_hash").alias("rep_hash")), "simhash-components")
    return prints.join(named, "fp").select(
        "doc_id", "row_hash", "fp", "component_id",
        (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("row_hash") == F.col("rep_hash"))).alias("is_rep"))


def op10_simhash_near_dedup(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each component, its representative, with
    all columns. Rows go by id and text, so other texts of the same id, or other
    texts without one, are untouched; a fully repeated row comes back once."""
    found = materialize(near_duplicates(docs).select("doc_id", "row_hash", "is_rep"), "simhash-found")
    gone = found.where(~F.col("is_rep")).select(
        F.col("doc_id").alias("__gone_id"), F.col("row_hash").alias("__gone_hash")).distinct()
    rest = docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col("__gone_id"))
                     & (row_hash() == F.col("__gone_hash")), "left_anti")
    repeated = found.where("is_rep").groupBy("doc_id", "row_hash").count().where("count > 1")
    if not repeated.isEmpty():
        rest = rest.withColumn("__row_hash", row_hash()).dropDuplicates(["doc_id", "__row_hash"]) \
            .drop("__row_hash")
    return rest
