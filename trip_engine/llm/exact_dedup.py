"""Operator 4: exact duplicates by composable polynomial fingerprints.

The normalised text (only A-Z lowered, UTF-8) is cut into chunks. Each chunk
has a polynomial hash under two primes; the hash of a concatenation follows
from the hashes of its parts by length-shifted arithmetic
(``H(AB) = H(A) * base^|B| + H(B)``), so the chunks of one huge document can be
hashed apart and in any place, and pieces that lie in several rows combine to
the same fingerprint as the whole text. A text of up to ``WHOLE`` bytes is hashed
where it is read; longer ones are dealt out chunk by chunk, hashed in parallel and
combined from (number, length, hash) triples (``fingerprint_chunks``).

Equal fingerprints are only candidates. Each candidate is compared with the
representative of its group chunk by chunk (one joined row per chunk, so no
task holds two huge texts), the representative's chunks being copied to as
many salts as the group needs. Texts that differ in spite of an equal
fingerprint form a group of their own in another round.

Defined cases: a null text counts as empty, and all empty texts are equal;
of equal texts the largest ``doc_id`` stays (a null id is the smallest); of
fully repeated rows (same id, same text) each is returned and counted by
``find_duplicates``, while the pipeline stage returns one. An empty table gives
an empty result. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import prepare_workers, materialize, utf8

CHUNK = 1 << 16            # bytes of one chunk
WHOLE = 16 * CHUNK         # bytes of a text that one task hashes by itself
_UPPER = "".join(map(chr, range(65, 91)))
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 69069069)
MEMBERS_PER_SALT = 64      # members of a group that share one copy of its representative


def chunk_powers(chunk: int, prime: int, base: int) -> np.ndarray:
    """base^0 .. base^(chunk-1) mod prime, by doubling."""
    powers = np.ones(1, np.uint64)
    while len(powers) < chunk:
        step = np.uint64(pow(base, len(powers), prime))
        powers = np.concatenate([powers, powers * step % np.uint64(prime)])
    return powers[:chunk]


class Polynomial:
    """Fingerprints under the two primes. ``primes`` is a parameter so that a
    test can force collisions with small ones."""

    def __init__(self, primes=PRIMES, chunk: int = CHUNK):
        self.primes, self.chunk = primes, chunk
        self.powers = [chunk_powers(chunk, p, b) for p, b in zip(primes, BASES)]

    def of_chunk(self, data: bytes) -> tuple[int, ...]:
        # bytes < 2^9, powers < 2^31 and at most 2^16 terms: sums stay below 2^56
        a = np.frombuffer(data, np.uint8)[::-1].astype(np.uint64) + np.uint64(1)
        return tuple(int((a * w[:len(a)]).sum()) % p for w, p in zip(self.powers, self.primes))

    def combine(self, left: tuple[int, ...], right: tuple[int, ...], right_bytes: int) -> tuple[int, ...]:
        return tuple((a * pow(b, right_bytes, p) + c) % p
                     for a, c, p, b in zip(left, right, self.primes, BASES))

    def of_text(self, data: bytes) -> tuple[int, ...]:
        total = (0,) * len(self.primes)
        for at in range(0, len(data), self.chunk):
            part = data[at:at + self.chunk]
            total = self.combine(total, self.of_chunk(part), len(part))
        return total


def _key(fp: tuple[int, ...]) -> int:
    return fp[0] << 31 | fp[1]


def fingerprints(docs: DataFrame, poly: Polynomial | None = None, whole: int | None = None) -> DataFrame:
    """doc_id, row_hash (of the text as it is), fp, n_bytes, text_sha256: one row
    per document, in one narrow pass. Texts of more than ``whole`` bytes, if given,
    get no fp here."""
    prepare_workers(docs.sparkSession)
    poly = poly or Polynomial()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [x.lower() for x in b.column(2).to_pylist()]  # bytes.lower: A-Z only
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1),
                pa.array([None if whole is not None and len(t) > whole else _key(poly.of_text(t)) for t in texts],
                         pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ], ["doc_id", "row_hash", "fp", "n_bytes", "text_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("row_hash"),
                       utf8().alias("data")) \
        .mapInArrow(run, "doc_id bigint, row_hash bigint, fp bigint, n_bytes bigint, text_sha256 string")


def row_hash(col: str = "text"):
    return F.xxhash64(F.coalesce(F.col(col), F.lit("")))


def fingerprint_chunks(chunks: DataFrame, poly: Polynomial | None = None, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Fingerprints of documents whose text lies in many rows (``by``: long columns that
    tell documents apart, ``chunk_no``, ``data`` binary, already normalised): every row is
    hashed where it is, and per document only (number, length, hash) triples are combined."""
    prepare_workers(chunks.sparkSession)
    poly = poly or Polynomial()
    keys = len(by)
    named = ", ".join(f"{c} bigint" for c in by)

    def hashed(batches):
        for b in batches:
            data = [x or b"" for x in b.column(keys + 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:keys + 1], pa.array([_key(poly.of_text(x)) for x in data], pa.int64()),
                 pa.array([len(x) for x in data], pa.int64())], [*by, "chunk_no", "fp", "n_bytes"])

    parts = chunks.select(*[F.col(c).cast("long").alias(c) for c in by], F.col("chunk_no").cast("long"), "data") \
        .mapInArrow(hashed, f"{named}, chunk_no bigint, fp bigint, n_bytes bigint")
    listed = parts.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("chunk_no", "fp", "n_bytes"))).alias("parts"))

    def combined(batches):
        for b in batches:
            found, sizes = [], []
            for parts in b.column(keys).to_pylist():
                total = (0,) * len(poly.primes)
                for p in parts:
                    total = poly.combine(total, (p["fp"] >> 31, p["fp"] & 0x7FFFFFFF), p["n_bytes"])
                found.append(_key(total))
                sizes.append(sum(p["n_bytes"] for p in parts))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:keys], pa.array(found, pa.int64()), pa.array(sizes, pa.int64())],
                [*by, "fp", "n_bytes"])

    return listed.mapInArrow(combined, f"{named}, fp bigint, n_bytes bigint")


def _cut(chunk: int):
    """The chunks of the normalised text ``data``."""
    return F.expr(f"transform(sequence(0, greatest(length(data) - 1, 0) div {chunk}), "
                  f"i -> substring(data, cast(i * {chunk} + 1 as int), {chunk}))")


def _lowered(text: str = "text"):
    return F.translate(text, _UPPER, _UPPER.lower()).cast("binary")


def _all_fingerprints(docs: DataFrame, poly: Polynomial, whole: int) -> DataFrame:
    """``fingerprints``, those of long texts from their chunks, which are hashed in
    as many tasks as they ask for. Without long texts that takes no second pass."""
    prints = materialize(fingerprints(docs, poly, whole), "dedup-prints")
    if prints.where("fp is null").isEmpty():
        return prints
    key = ("l_id", "l_hash", "l_null")
    long_texts = docs.where(F.octet_length("text") > whole).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("l_id"), row_hash().alias("l_hash"),
        F.col("doc_id").isNull().cast("long").alias("l_null"), _lowered().alias("data"))
    chunks = long_texts.dropDuplicates(key).select(*key, F.posexplode(_cut(poly.chunk)).alias("chunk_no", "data"))
    combined = materialize(fingerprint_chunks(chunks.repartition(*key, "chunk_no"), poly, key)
                           .withColumnsRenamed({"fp": "l_fp", "n_bytes": "l_bytes"}), "dedup-long")
    return prints.join(combined, (F.coalesce("doc_id", F.lit(0)) == F.col("l_id")) & (F.col("row_hash") == F.col("l_hash"))
                       & (F.col("doc_id").isNull().cast("long") == F.col("l_null")), "left") \
        .withColumn("fp", F.coalesce("fp", "l_fp")).drop(*key, "l_fp", "l_bytes")


def _grouped(prints: DataFrame, name: str = "dedup-groups") -> DataFrame:
    """Every row with its group's representative and size (null: alone). The
    partial aggregate collapses a hot group before the shuffle; the written
    table leaves a plain join of two scans, whose hot keys AQE can split."""
    key = ["cls", "fp", "n_bytes"]
    groups = materialize(
        prints.groupBy(*key).agg(F.max(F.struct("doc_id", "row_hash")).alias("rep"),
                                 F.count(F.lit(1)).alias("group_size")).where("group_size > 1"), name)
    return prints.join(groups, key, "left")


def _is_rep():
    return F.col("rep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("rep.row_hash") == F.col("row_hash"))


def _unequal(docs: DataFrame, grouped: DataFrame, chunk: int) -> DataFrame:
    """(doc_id, row_hash) of the rows whose text differs from the text of
    their representative, compared chunk by chunk."""
    members = grouped.where("group_size > 1").groupBy("doc_id", "row_hash").agg(
        F.first(F.struct("rep", "group_size", _is_rep().alias("is_rep"))).alias("m")) \
        .select(F.col("doc_id").alias("m_id"), F.col("row_hash").alias("m_hash"), "m.*")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("row_hash"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = texts.join(members, F.col("doc_id").eqNullSafe(F.col("m_id"))
                       & (F.col("row_hash") == F.col("m_hash")))
    pieces = found.withColumn("data", _lowered()).select(
        "doc_id", "row_hash", "rep", "is_rep",
        F.ceil(F.col("group_size") / MEMBERS_PER_SALT).cast("long").alias("salts"),
        F.posexplode(_cut(chunk)).alias("chunk_no", "chunk"))
    ours = pieces.where("not is_rep").withColumn(
        "salt", F.pmod(F.monotonically_increasing_id(), F.col("salts")))
    reps = pieces.where("is_rep").dropDuplicates(["rep", "chunk_no"]).select(
        F.col("rep.doc_id").alias("r_id"), F.col("rep.row_hash").alias("r_hash"),
        F.col("chunk_no").alias("r_no"), F.col("chunk").alias("r_chunk"),
        F.explode(F.expr("sequence(cast(0 as bigint), salts - 1)")).alias("r_salt"))
    both = ours.join(reps, F.col("rep.doc_id").eqNullSafe(F.col("r_id"))
                     & (F.col("rep.row_hash") == F.col("r_hash")) & (F.col("salt") == F.col("r_salt"))
                     & (F.col("chunk_no") == F.col("r_no")), "left")
    return both.where(~F.col("chunk").eqNullSafe(F.col("r_chunk"))).select("doc_id", "row_hash").distinct()


def find_duplicates(docs: DataFrame, poly: Polynomial | None = None, chunk: int = CHUNK,
                    whole: int = WHOLE) -> DataFrame:
    """doc_id, row_hash, keep_id, group_size, kept, text_sha256: a row per document."""
    prints = _all_fingerprints(docs, poly or Polynomial(), whole).withColumn("cls", F.lit(0).cast("long"))
    while True:
        grouped = _grouped(prints)
        unequal = materialize(_unequal(docs, grouped, chunk), "dedup-unequal")
        if unequal.isEmpty():
            break
        # texts that only collide form a group of their own: one round per
        # different text under the same fingerprint
        odd = unequal.select(F.col("doc_id").alias("o_id"), F.col("row_hash").alias("o_hash"))
        prints = materialize(prints.join(
            odd, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("row_hash") == F.col("o_hash")), "left")
            .withColumn("cls", F.when(F.col("o_hash").isNull(), F.col("cls")).otherwise(F.col("cls") + 1))
            .drop("o_id", "o_hash"), "dedup-prints")
    alone = F.col("group_size").isNull()
    return grouped.select(
        "doc_id", "row_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("rep.doc_id")).alias("keep_id"),
        F.coalesce(F.col("group_size"), F.lit(1)).cast("long").alias("group_size"),
        (alone | _is_rep()).alias("kept"), "text_sha256")


def op4_exact_dedup(docs: DataFrame) -> DataFrame:
    return find_duplicates(docs).drop("row_hash")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of equal texts (the largest
    ``doc_id``), all columns; a fully repeated row comes back once."""
    found = materialize(find_duplicates(docs).select("doc_id", "row_hash", "kept"), "dedup-found")
    gone = found.where("not kept").select(F.col("doc_id").alias("__gone_id"),
                                          F.col("row_hash").alias("__gone_hash"))
    rest = docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col("__gone_id"))
                     & (row_hash() == F.col("__gone_hash")), "left_anti")
    repeated = found.where("kept").groupBy("doc_id", "row_hash").count().where("count > 1")
    if not repeated.isEmpty():
        rest = rest.withColumn("__row_hash", row_hash()).dropDuplicates(["doc_id", "__row_hash"]) \
            .drop("__row_hash")
    return rest
