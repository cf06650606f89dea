"""Operator 3: language identification by error-correcting output codes.

Every learned language has a codeword of bits. For each bit a binary
classifier over hashed byte 3- and 4-grams tells the languages with a 1 from
those with a 0 (log-odds of the two groups' mixed n-gram distributions). A
text's margins are decoded by loss: the codeword with the smallest sum of
logistic losses, each bit weighed by how well its classifier did on the training
rows, is the nearest one. The losses turn into a score by softmax, and a text
whose two nearest codewords are close is flagged as ambiguous.

Up to five languages get the exhaustive code; more get a fixed random code
with rows at a large distance. Learning reads at most ``MAX_FIT_ROWS`` rows
(chosen by a hash of the id), never held-out ones, and brings back one row of
counts per language and bucket; prediction reads every text whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 (as is
every text if there is nothing to learn from); rows without a language teach
nothing; with one learned language every other text gets it with score 1; of equally
near codewords the language first in code point order is taken;
repeated rows come back each; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import prepare_workers, is_held_out, utf8

MAX_FIT_ROWS = 50_000
MAX_LANGS = 200            # what the driver holds is this by BUCKETS counts
BUCKETS = 1 << 16
SMOOTHING = 0.5
EVIDENCE = 40.0            # n-grams of a text that count as independent, at most
AMBIGUOUS = 0.8            # scores below are flagged
CODE_SEED = 11
PART = 1 << 20             # n-grams of a huge text are summed in parts
UNKNOWN = "und"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(data: bytes) -> bool:
    return bool(_ASCII_LETTER.search(data)) or any(map(str.isalpha, data.decode("utf-8", "replace")))


def ngrams(data: bytes) -> np.ndarray:
    """Buckets of the 3- and 4-grams of the folded bytes (A-Z lowered, runs of other
    ASCII as one space)."""
    folded = b" " + b" ".join(data.translate(_FOLD).split()) + b" "
    a = np.frombuffer(folded, np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(0, np.int64)
    three = a[:-2] * np.uint32(2654435761) + a[1:-1] * np.uint32(40503) * np.uint32(257) + a[2:] * np.uint32(69069)
    four = three[:-1] * np.uint32(31) + a[3:] * np.uint32(2246822519) + np.uint32(97)
    both = np.concatenate([three, four])
    return ((both ^ both >> np.uint32(15)) % np.uint32(BUCKETS)).astype(np.int64)


def code_matrix(n: int) -> np.ndarray:
    """n codewords of -1 and 1: exhaustive up to five languages, else the random
    code of the largest least distance among a fixed number of draws."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 5:
        return np.array([[1 if k == 0 or not (c >> (k - 1)) & 1 else -1 for c in range(1, 1 << (n - 1))]
                         for k in range(n)], float)
    bits = int(np.ceil(10 * np.log2(n)))
    draw = np.random.default_rng(CODE_SEED)
    best, distance = None, -1
    for _ in range(200 if n <= 200 else 5):
        code = draw.choice([-1.0, 1.0], (n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]  # a bit must have both groups
        least = (code.shape[1] - code @ code.T + np.eye(n) * 4 * bits).min() / 2
        if least > distance:
            best, distance = code, least
    return best


class LanguageModel:
    """``counts``: n-gram counts by language (rows in the order of ``langs``)."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        self.code = code_matrix(len(langs))
        rates = counts + SMOOTHING
        rates = rates / rates.sum(axis=1, keepdims=True) if len(langs) else rates
        positive, negative = self.code.T > 0, self.code.T < 0
        self.weights = np.stack([np.log(rates[p].mean(axis=0)) - np.log(rates[q].mean(axis=0))
                                 for p, q in zip(positive, negative)], axis=1).astype(np.float32) \
            if self.code.shape[1] else np.zeros((BUCKETS, 0), np.float32)
        self.bit_weights = np.ones(self.code.shape[1])

    def margins(self, data: bytes) -> np.ndarray:
        grams = ngrams(data)
        if not len(grams):
            return np.zeros(self.code.shape[1])
        total = sum(self.weights[grams[lo:lo + PART]].sum(axis=0, dtype=np.float64)
                    for lo in range(0, len(grams), PART))
        return total / len(grams) * min(len(grams), EVIDENCE)

    def predict(self, data: bytes) -> tuple[str, float]:
        if not self.langs or not has_letter(data):
            return UNKNOWN, 0.0
        losses = (np.logaddexp(0, -self.code * self.margins(data)) * self.bit_weights).sum(axis=1)
        near = np.exp(losses.min() - losses)
        best = int(near.argmax())
        return self.langs[best], float(near[best] / near.sum())


def _rows(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out("doc_id")).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), utf8().alias("data"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts by language, summed over a task."""
    sums: dict[str, np.ndarray] = {}
    for b in batches:
        for lang, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            grams = ngrams(data)
            total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
            if len(grams) < BUCKETS // 16:
                np.add.at(total, grams, 1)
            else:
                total += np.bincount(grams, minlength=BUCKETS)
    for lang, total in sums.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])], ["lang", "bucket", "n"])


def train(docs: DataFrame, most: int = MAX_FIT_ROWS) -> LanguageModel:
    prepare_workers(docs.sparkSession)
    scale = 1 << 30
    sizes = docs.where(F.col("lang").isNotNull() & ~is_held_out("doc_id")).groupBy(
        F.col("lang").cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    known = sizes.orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()  # a row per language
    each = most / max(1, len(known))
    limits = F.create_map(*[F.lit(x) for r in known for x in (r["lang"], int(min(1.0, each / r["n"]) * scale))]) \
        if known else F.create_map().cast("map<string,int>")
    rows = _rows(docs).where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < limits[F.col("lang")])
    # one row per language and bucket comes back
    table = rows.select("lang", "data").mapInArrow(_count, "lang string, bucket bigint, n bigint") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(table["lang"].to_pylist(), object)
    langs = sorted(set(names.tolist()))
    counts = np.zeros((len(langs), BUCKETS))
    at = {name: i for i, name in enumerate(langs)}
    counts[[at[x] for x in names.tolist()], table["bucket"].to_numpy()] = table["n"].to_numpy()
    model = LanguageModel(langs, counts)
    if model.code.shape[1]:
        model.bit_weights = _bit_weights(rows, model)
    return model


def _bit_weights(rows: DataFrame, model: LanguageModel) -> np.ndarray:
    """How well each bit's classifier did on the training rows: twice its
    accuracy minus one, at least a little."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def right(batches):
        m = shared.value
        at = {name: i for i, name in enumerate(m.langs)}
        for b in batches:
            hits = np.zeros(m.code.shape[1], np.int64)
            for lang, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                hits += m.margins(data) * m.code[at[lang]] > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(hits))), pa.array(hits), pa.array(np.full(len(hits), b.num_rows))],
                ["bit", "hits", "n"])

    got = rows.select("lang", "data").mapInArrow(right, "bit bigint, hits bigint, n bigint") \
        .groupBy("bit").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect()  # a row per bit
    weights = np.ones(model.code.shape[1])
    for r in got:
        weights[r["bit"]] = max(0.05, 2 * r["hits"] / max(1, r["n"]) - 1)
    return weights


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous: one row per document, one narrow pass."""
    spark = docs.sparkSession
    prepare_workers(spark)
    shared = spark.sparkContext.broadcast(model)  # buckets times bits, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            found = [m.predict(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("data")) \
        .mapInArrow(run, "doc_id bigint, lang_pred string, score double") \
        .withColumn("ambiguous", F.col("score") < AMBIGUOUS)


def op3_language_id(docs: DataFrame) -> DataFrame:
    return identify(docs, train(docs)).select("doc_id", is_held_out("doc_id").alias("held_out"),
                                              "lang_pred", "score", "ambiguous")
