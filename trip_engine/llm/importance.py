"""Operator 13: importance resampling towards a target distribution.

An untrained ``tokenizers`` pre-tokenizer, a Regex Split, cuts the ASCII-lowered text into
words with their offsets. Windows of one to ``SPAN`` consecutive offset pairs are the
features; a window's CRC-32 is that of the window without its last word, carried
on over a space and that word, and its bucket is the CRC modulo ``BUCKETS``. Two
histograms (all documents, all target texts) give a bucket's gain, the scaled
logarithm of its smoothed frequency ratio. A document weighs the mean gain of
its features; a Gumbel key drawn from a hash of its id turns the highest scores
into a sample without replacement.

A text is read and cut once: its buckets are written as 16-bit numbers (about an
eighth of the text), histograms and gain sums read those. Only ``BUCKETS`` gains are
broadcast. Ranks come from range partitions and their counts, whatever the number
drawn.

Defined cases: null and empty texts have no features, weight 0 and are never drawn
(less than ``LEAST`` words); bytes that are not UTF-8 count as U+FFFD, a part of a word;
equal scores rank by the smaller doc_id, a null id last (its key is the hash of
``7:`` alone); repeated rows count and rank each; without documents or without target texts
all counts of that side are 0; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import materialize, prepare_workers, utf8
from trip_engine.llm.ranked import with_positions

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SPAN = 2
BUCKETS = 10_000           # at most 65,536
LEAST = 20                 # words of a document that may be drawn
PERCENT = 25
SEED = 7
PIECE = 1 << 17            # characters pre-tokenized at once


def _splitter():
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split
    return Split(Regex(WORD), "removed", invert=True).pre_tokenize_str


def _pieces(text: str) -> Iterator[str]:
    """A long text cut between words."""
    at = 0
    while len(text) - at > PIECE:
        gap = _GAP.search(text, at + PIECE)
        if gap is None:
            break
        yield text[at:gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def text_buckets(data: bytes, split, span: int = SPAN, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of 1 to ``span`` words."""
    text = data.translate(_LOWER).decode("utf-8", "replace")
    n_words, found = 0, []
    last: list[int | None] = [None] * (span + 1)  # CRC of the last run of n words so far
    for piece in _pieces(text):
        words = [w.encode() for w, _ in split(piece)]  # (word, offset pair) in the order of offsets
        if not words:
            continue
        n_words += len(words)
        spaced = [b" " + w for w in words]
        runs = [*map(crc32, words)]  # those that end at the last words of the piece
        found.append(np.array(runs, np.uint32))
        for n in range(1, span):
            before = runs[:-1] if last[n] is None else [last[n], *runs[:-1]]
            last[n] = runs[-1] if runs else None
            runs = [crc32(w, c) for w, c in zip(spaced[len(spaced) - len(before):], before)]
            found.append(np.array(runs, np.uint32))
    return n_words, (np.concatenate([*found, np.zeros(0, np.uint32)]) % buckets).astype("<u2")


def bucket_rows(rows: DataFrame, id_col: str, span: int = SPAN, buckets: int = BUCKETS) -> DataFrame:
    """id, n_words, buckets (16-bit little-endian numbers) of every text."""
    prepare_workers(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter()
        for b in batches:
            got = [text_buckets(x, split, span, buckets) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for n, _ in got], pa.int64()),
                 pa.array([x.tobytes() for _, x in got], pa.binary())], ["doc_id", "n_words", "buckets"])

    return rows.select(F.col(id_col).cast("long").alias("doc_id"), utf8().alias("data")) \
        .mapInArrow(run, "doc_id bigint, n_words bigint, buckets binary")


def histogram(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: summed up within each task first, so ``buckets`` rows a task are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(x, "<u2"), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit])], ["bucket", "n"])

    return rows.select("buckets").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Scaled log ratio of the smoothed frequencies, rounded down, per bucket. The two
    histograms (at most ``buckets`` rows each) come to the driver."""
    def counts(rows: DataFrame) -> list[int]:
        out = [0] * buckets
        for r in histogram(rows, buckets).collect():
            out[r["bucket"]] = r["n"]
        return out

    s, t = counts(documents), counts(target)
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log(((b + 1.0) * all_s) / ((a + 1.0) * all_t)))
                     for a, b in zip(s, t)], np.int64)


def with_weights(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: the mean gain, rounded down."""
    shared = rows.sparkSession.sparkContext.broadcast(gains)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in batches:
            runs = [np.frombuffer(x, "<u2") for x in b.column(2).to_pylist()]
            sums = [int(gain[x].sum()) // len(x) if len(x) else 0 for x in runs]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([*map(len, runs)], pa.int64()), pa.array(sums, pa.int64())],
                ["doc_id", "n_words", "n_features", "weight"])

    return rows.select("doc_id", "n_words", "buckets").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", target_id: str = "item_id",
             percent: int = PERCENT, least: int = LEAST, seed: int = SEED,
             span: int = SPAN, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn) of every document."""
    cut = materialize(bucket_rows(docs, id_col, span, buckets), "importance-buckets")
    gains = bucket_gains(cut, bucket_rows(target, target_id, span, buckets), buckets)
    drawn_key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(drawn_key, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = materialize(with_weights(cut, gains).withColumn("score", F.col("weight") + gumbel), "importance-scores")
    enough = scored.where(F.col("n_words") >= least)
    take = enough.count() * percent // 100
    ranked = with_positions(enough, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], None, "importance-ranks")
    drawn = F.when(F.col("idx") < take, F.col("idx") + 1)
    return ranked.select("doc_id", "n_features", "weight", "score", drawn.alias("rank")).unionByName(
        scored.where(F.col("n_words") < least)
        .select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))


def op13_importance_resampling(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return resample(docs, benchmark)
