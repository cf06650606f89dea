"""Operator 5: quality classifier by co-training.

Two views of a document: its text (measurements of the quality rules, and the frequencies
of character-shape pairs in a fixed number of buckets) and its metadata
(source, language, recorded length, hashed to a fixed number of buckets).
Each view has a logistic classifier. In every round each view labels the rows of
an unlabelled pool that it is sure of - by its calibrated probability, in the
proportion of the classes - and hands them to the other view's training set.
In the end each view is calibrated on labelled rows kept apart, and a third
logistic curve joins the two calibrated views.

Learning reads at most ``MAX_LABELLED`` labelled rows and ``MAX_POOL`` pool
rows (chosen by a hash of the id), never held-out ones; scoring reads every
text whole, in one narrow pass.

Defined cases: a null text counts as empty, null metadata is a value of its
own; labelled rows without a text or a label teach nothing; without both classes
every score is the share of the good ones (1 if there are no labels);
repeated rows come back each; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import prepare_workers, is_held_out, materialize, utf8
from trip_engine.llm.quality_rules import MEASURES, measure
from trip_engine.llm.toxicity import fit_logistic

MAX_LABELLED = 10_000
MAX_POOL = 10_000
ROUNDS = 4
SURE = 0.97                # calibrated probability of a class for a pseudo-label
SHARE_PER_ROUND = 0.1      # of the pool, handed over by each view, at most
CALIBRATION = 5            # one labelled row in so many is kept for calibration
SHAPES = 192
METAS = 64
USED = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower")
_SHAPE = bytes(ord("a") if 97 <= c <= 122 or c >= 128 else ord("A") if 65 <= c <= 90
               else ord("0") if 48 <= c <= 57 else c for c in range(256))
PART = 1 << 20


def text_view(data: bytes) -> np.ndarray:
    found = dict(zip(MEASURES, measure(data)))
    words, chars, symbols, lines, dup_lines, repeats, upper, lower = map(found.__getitem__, USED)
    n = max(1, len(data))
    dense = [np.log1p(words), np.log1p(chars), chars / max(1, words) / 10, 10 * symbols / max(1, chars),
             dup_lines / max(1, lines), repeats / max(1, words), upper / max(1, upper + lower),
             float(upper > lower), float(words < 10), np.log1p(lines),
             len(set(data.split())) / max(1, words)]
    shape = np.zeros(SHAPES)
    folded = data.translate(_SHAPE)
    for lo in range(0, max(0, len(folded) - 1), PART):
        a = np.frombuffer(folded[lo:lo + PART + 1], np.uint8).astype(np.int64)
        shape += np.bincount((a[:-1] * 131 + a[1:] * 17) % SHAPES, minlength=SHAPES)
    return np.concatenate([dense, np.log1p(200 * shape / n)]).astype(np.float32)


TEXT_WIDTH = 11 + SHAPES


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(METAS, np.float32)
    size = "" if n_chars is None else str(int(max(0, n_chars)).bit_length())
    for value in (f"s{source}", f"l{lang}", f"n{size}"):
        out[crc32(value.encode("utf-8", "replace")) % METAS] += 1
    return out


class View:
    """A logistic classifier on standardized features, with a calibrated output."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> View:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.w = fit_logistic((x - self.mean) / self.scale, y, ridge=len(x) * 1e-3, rounds=20)
        self.curve = np.array([1.0, 0.0])
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1], -30, 30)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> View:
        if 0 < y.mean() < 1:
            self.curve = fit_logistic(self.margin(x)[:, None], y, ridge=0.1)
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.margin(x) * self.curve[0] + self.curve[1], -30, 30)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


def _sure(p: np.ndarray, free: np.ndarray, share_good: float) -> tuple[np.ndarray, np.ndarray]:
    """Pool rows a view is sure of, the surest of each class first, and their labels."""
    most = max(1, int(len(p) * SHARE_PER_ROUND))
    rows, labels = [], []
    for label, score, share in ((1.0, p, share_good), (0.0, 1 - p, 1 - share_good)):
        order = np.argsort(-np.where(free, score, -1), kind="stable")[:max(1, int(most * share))]
        order = order[free[order] & (score[order] >= SURE)]
        rows.append(order)
        labels.append(np.full(len(order), label))
    return np.concatenate(rows), np.concatenate(labels)


class CoTrained:
    def __init__(self, share: float = 1.0):
        self.share, self.views, self.joint, self.exchanged = share, None, None, 0

    @classmethod
    def fit(cls, views: tuple[np.ndarray, np.ndarray], y: np.ndarray, aside: np.ndarray,
            pool: tuple[np.ndarray, np.ndarray]) -> CoTrained:
        """``views``: text and metadata features of the labelled rows, ``aside`` marks
        those kept for calibration, ``pool`` the features of the unlabelled rows."""
        model = cls(float(y.mean()) if len(y) else 1.0)
        if not len(y) or not 0 < y[~aside].mean() < 1:
            return model
        sets = [[v[~aside]] for v in views]
        labels = [[y[~aside]], [y[~aside]]]
        free = [np.ones(len(pool[0]), bool) for _ in views]
        for number in range(ROUNDS + 1):
            fitted = [View().fit(np.concatenate(x), np.concatenate(t)).calibrate(v[aside], y[aside])
                      for x, t, v in zip(sets, labels, views)]
            if number == ROUNDS or not len(pool[0]):
                break
            handed = 0
            for giver, taker in ((0, 1), (1, 0)):
                rows, given = _sure(fitted[giver].probability(pool[giver]), free[taker], model.share)
                free[taker][rows] = False
                sets[taker].append(pool[taker][rows])
                labels[taker].append(given)
                handed += len(rows)
            model.exchanged += handed
            if not handed:
                break
        model.views = fitted
        z = np.c_[tuple(f.logit(v) for f, v in zip(fitted, views))]
        rest = aside if 0 < y[aside].mean() < 1 else ~aside
        model.joint = fit_logistic(z[rest], y[rest], ridge=0.1)
        return model

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Joint, text and metadata probability of the good class."""
        if self.views is None:
            return (np.full(len(text), self.share),) * 3
        a, b = self.views[0].logit(text), self.views[1].logit(meta)
        z = np.c_[a, b, np.ones(len(a))] @ self.joint
        return tuple(1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (z, a, b))


def _columns() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"),
            utf8().alias("data")]


def _views(b: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray]:
    source, lang, size, data = (b.column(i).to_pylist() for i in range(at, at + 4))
    text = np.array([text_view(x) for x in data], np.float32).reshape(-1, TEXT_WIDTH)
    meta = np.array([meta_view(*m) for m in zip(source, lang, size)], np.float32).reshape(-1, METAS)
    return text, meta


def train(docs: DataFrame, labels: DataFrame) -> CoTrained:
    spark = docs.sparkSession
    prepare_workers(spark)
    known = materialize(labels.where(F.col("quality").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("l_id")).agg(F.max(F.col("quality").cast("int")).alias("quality"))
        .where(~is_held_out("l_id")), "quality-labels")
    scale = 1 << 20

    def chosen(col: str, most: int, total: int, seed: int) -> Column:
        return F.pmod(F.xxhash64(F.col(col), F.lit(seed)), F.lit(scale)) < int(min(1.0, most / max(1, total)) * scale)

    sample = known.where(chosen("l_id", MAX_LABELLED, known.count(), 1))
    rows = docs.where(F.col("text").isNotNull() & ~is_held_out("doc_id")).select(*_columns()) \
        .withColumn("pooled", chosen("doc_id", MAX_POOL, docs.count(), 2)) \
        .join(F.broadcast(sample), F.col("doc_id") == F.col("l_id"), "left") \
        .where("quality is not null or pooled")  # the sample is bounded by MAX_LABELLED rows

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, meta = _views(b, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x.tobytes() for x in text], pa.binary()),
                 pa.array([x.tobytes() for x in meta], pa.binary())], ["doc_id", "quality", "text", "meta"])

    # bounded by MAX_LABELLED + MAX_POOL rows
    got = rows.select("doc_id", "quality", "source", "lang", "n_chars", "data") \
        .mapInArrow(features, "doc_id bigint, quality int, text binary, meta binary").toPandas() \
        .sort_values("doc_id", kind="stable")

    def matrix(part, name, width):
        return np.frombuffer(b"".join(part[name]), np.float32).reshape(-1, width)

    labelled, pool = got[got["quality"].notna()], got[got["quality"].isna()]
    y = (labelled["quality"].to_numpy() > 0).astype(float)
    aside = np.array([crc32(b"aside%d" % i) % CALIBRATION == 0 for i in labelled["doc_id"]], bool)
    return CoTrained.fit((matrix(labelled, "text", TEXT_WIDTH), matrix(labelled, "meta", METAS)), y, aside,
                         (matrix(pool, "text", TEXT_WIDTH), matrix(pool, "meta", METAS)))


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """doc_id, score (joint), text_score, meta_score: one row per document."""
    spark = docs.sparkSession
    prepare_workers(spark)
    shared = spark.sparkContext.broadcast(model)  # a few hundred weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = shared.value.score(*_views(b, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.float64()) for x in found)],
                                             ["doc_id", "score", "text_score", "meta_score"])

    return docs.select(*_columns()).mapInArrow(
        run, "doc_id bigint, score double, text_score double, meta_score double")


def op5_quality_cotraining(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels)).select(
        "doc_id", is_held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_score", "meta_score")
