"""Operator 2: toxicity by maximum-scoring segments.

Lexicon: every unit (a word, and its prefixes of four to six letters) gets the
log-odds of its document frequency in toxic against other labelled texts, with
an informative Dirichlet prior (the unit's share of all texts, worth a fixed part
of them), and the z-score of that log-odds. A word scores by the largest lower
bound of its units' log-odds, if that is significant and not small (common
words with a slight lean are no evidence); any other word costs a small
penalty, and so does a word's third and later occurrence in one segment. Units
are counted in toxic texts first; the most frequent ones there, at most
``MAX_UNITS``, are then counted in the others, so what is broadcast is bounded.

Scan: all maximal scoring segments of a document are found in one linear pass
over its words (runs of penalty words are taken in one step). Where a word occurs
more than twice in a stretch, a sweep over its scoring words follows the best
start for every end. What a segment scores depends on its own words alone, so a
passage counts the same wherever it stands and however often. Calibration: the
best segment of a clean document of n words follows an extreme-value law,
P(S >= s) = 1 - exp(-K n exp(-lambda s)), with lambda from the score
distribution of clean words and K from the clean documents' best segments. The
p-values of the best segment and of all significant segments together, as
-log10, enter a logistic curve fitted on the training rows.

Learning reads at most ``MAX_FIT_ROWS`` labelled rows (chosen by a hash of the
id, evenly over all sources; equal texts count once), never held-out ones;
scoring reads every text whole.

Defined cases: null and empty texts have no segment and get the score of a
text without any; labelled rows without a text or a label teach nothing; a
repeated label counts once; of equally good segments the one that ends first, and of its equally
good starts the earliest, is taken; units of equal counts in code point order; without toxic or without clean training rows every
score is the share of toxic ones among them (0 if none); an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import is_held_out, materialize, prepare_workers, utf8

MAX_FIT_ROWS = 50_000
MAX_UNITS = 100_000
MIN_TOXIC = 5              # toxic texts a unit must occur in
PREFIXES = (4, 5, 6)
MIN_Z = 2.5
SURE = 1.64                # a word scores its log-odds less so many standard deviations,
MIN_SCORE = 1.0            # and nothing if that is below
REPEATS = 2                # occurrences of one word that count in a segment
PENALTY = 0.25
TOP = 12.0                 # largest score of one word
SIGNIFICANT = 0.01         # p-value of a passage that is reported
CACHE = 500_000
PRIOR = 0.02               # weight of the Dirichlet prior, as a part of all training texts
COUNTED_AT_ONCE = 500_000  # units a task counts before it hands the counts on
_WORD = re.compile(r"[^\W\d_]+")


def units(word: str) -> list[int]:
    """Names (64 bits) of a lower-cased word and its prefixes."""
    data = [f"={word}", *(f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n)]
    return [xxhash.xxh64_intdigest(x.encode("utf-8", "replace")) - (1 << 63) for x in data]


def words_of(data: bytes) -> list[str]:
    return _WORD.findall(data.decode("utf-8", "replace").lower())


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_FIT_ROWS) -> DataFrame:
    """(toxic, data): about ``most`` labelled rows at most that are not held out, equal
    texts of the same label once. Written, as the fit reads them several times."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("l_id")) \
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(~is_held_out("l_id"))
    known = materialize(known, "tox-labels")
    share = min(1.0, most / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("l_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # the broadcast is bounded by ``most`` rows of two numbers, the rest by their texts
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("data")) \
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    once = rows.withColumn("h", F.xxhash64("data")).dropDuplicates(["h", "toxic"])
    return materialize(once.select((F.col("toxic") > 0).cast("int").alias("toxic"), "data"), "tox-training")


def _count_units(wanted: frozenset[int] | None):
    """(unit, n): in how many texts each of the wanted units (all: None) occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        names: dict[str, list[int]] = {}

        def batch():
            keys = [*counts]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([counts[k] for k in keys], pa.int64())], ["unit", "n"])

        for b in batches:
            for data in b.column(0).to_pylist():
                found: set[int] = set()
                for w in set(words_of(data)):
                    u = names.get(w)
                    if u is None:
                        if len(names) > CACHE:
                            names.clear()
                        u = [x for x in units(w) if wanted is None or x in wanted]
                        names[w] = u
                    found.update(u)
                counts.update(found)
            if len(counts) > COUNTED_AT_ONCE:
                yield batch()
                counts.clear()
        yield batch()
    return run


def _unit_counts(rows: DataFrame, wanted: frozenset[int] | None = None) -> DataFrame:
    return rows.select("data").mapInArrow(_count_units(wanted), "unit bigint, n bigint") \
        .groupBy("unit").agg(F.sum("n").alias("n"))


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int,
             prior: float = PRIOR) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds ratio of the units' document frequencies with an informative
    Dirichlet prior, and its z-score."""
    weight = prior * (n_toxic + n_clean)
    alpha = weight * (toxic + clean) / max(1, n_toxic + n_clean) + 0.01
    y, x = toxic + alpha, clean + alpha
    delta = np.log(y / np.maximum(n_toxic + weight - y, 0.5)) - np.log(x / np.maximum(n_clean + weight - x, 0.5))
    return delta, delta / np.sqrt(1 / y + 1 / x)


class Lexicon:
    """Significant toxic units with their scores."""

    def __init__(self, names: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int):
        delta, z = log_odds(toxic.astype(float), clean.astype(float), n_toxic, n_clean)
        low = delta - SURE * delta / np.maximum(z, 1e-9)  # lower bound: delta / z is its deviation
        good = (z >= MIN_Z) & (low >= MIN_SCORE)
        self.units = {int(u): float(min(d, TOP)) for u, d in zip(names[good], low[good])}
        self.cache: dict[bytes, float] = {}

    def __getstate__(self):
        return {"units": self.units, "cache": {}}

    def _chunk(self, chunk: bytes) -> float:
        """The best word of a chunk between white space."""
        best = max((self.units.get(u, 0.0) for w in words_of(chunk) for u in units(w)), default=0.0)
        return best if best > 0 else -PENALTY

    def scan(self, data: bytes) -> tuple[int, list[tuple[int, int, float]], list[float]]:
        """Number of words, segments, and the word scores that count in them."""
        chunks = data.split()
        new = set(chunks).difference(self.cache)
        if new:
            if len(self.cache) + len(new) > CACHE:
                self.cache.clear()
                new = set(chunks)
            for c in new:
                self.cache[c] = self._chunk(c)
        scores = np.fromiter(map(self.cache.__getitem__, chunks), np.float64, len(chunks))
        return len(chunks), *segments_of(scores, chunks)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), Ruzzo and Tompa's
    linear scan. Only positive words are stepped over; the penalties between
    them are a difference of prefix sums."""
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    prefix = np.concatenate([[0.0], np.cumsum(scores)])
    before, after = prefix[at].tolist(), prefix[at + 1].tolist()
    # a candidate: start, end, sum before it, sum up to its end, and the last
    # candidate further left whose sum before it is smaller
    start, end, left, right, link = [], [], [], [], []
    for i, lo, hi in zip(at.tolist(), before, after):
        s, e = i, i + 1
        while True:
            j = len(start) - 1
            while j >= 0 and left[j] >= lo:
                j = link[j]
            if j < 0 or right[j] >= hi:
                break
            s, lo = start[j], left[j]
            del start[j:], end[j:], left[j:], right[j:], link[j:]
        link.append(j)
        start.append(s)
        end.append(e)
        left.append(lo)
        right.append(hi)
    return [(s, e, hi - lo) for s, e, lo, hi in zip(start, end, left, right)]


def segments_of(scores: np.ndarray, chunks: list[bytes]) -> tuple[list[tuple[int, int, float]], list[float]]:
    """All maximal segments where a chunk scores ``REPEATS`` times in a segment at
    most and costs the penalty from then on, and the scores that count in them."""
    at = np.flatnonzero(scores > 0).tolist()
    gains = scores[at].tolist()
    names = [chunks[i] for i in at]
    if len(at) - len(set(names)) < REPEATS:
        return maximal_segments(scores), gains
    found, counted = [], []
    for lo, hi in _stretches(at, gains):
        if max(Counter(names[lo:hi]).values()) <= REPEATS:
            found += [(s + at[lo], e + at[lo], x) for s, e, x in maximal_segments(scores[at[lo]:at[hi - 1] + 1])]
            counted += gains[lo:hi]
            continue
        for a, b, x in _repeating(at, gains, names, lo, hi):
            found.append((at[a], at[b] + 1, x))
            seen: Counter = Counter()
            for k in range(a, b + 1):
                seen[names[k]] += 1
                if seen[names[k]] <= REPEATS:
                    counted.append(gains[k])
    return found, counted


def _stretches(at: list[int], gains: list[float]) -> Iterator[tuple[int, int]]:
    """Runs of scoring words that no segment leaves: the sum from their start
    has fallen to zero before the next one, even if every occurrence scores."""
    lo, total = 0, 0.0
    for k in range(1, len(at)):
        total += gains[k - 1] - PENALTY * (at[k] - at[k - 1] - 1)
        if total <= 0:
            yield lo, k
            lo, total = k, 0.0
    yield lo, len(at)


def _repeating(at: list[int], gains: list[float], names: list[bytes], lo: int, hi: int) -> list[tuple[int, int, float]]:
    """Maximal segments (first and last scoring word, score) of a stretch. For every
    end the starts that may still become the best are kept: an earlier start gains
    no more from any later word than a later one, so it stays only while its sum is
    larger. Of those sums only the first one is known, and each start's lead over
    the next: a word adds the same to all starts behind the occurrence that spends it
    and the same to all before, so a step changes two leads, and the sweep is linear but
    for the near-constant search of the start behind a place. A segment is final when
    the best start lies behind it."""
    out, todo = [], [(lo, hi)]
    while todo:
        lo, hi = todo.pop()
        if lo >= hi:
            continue
        earlier: dict[bytes, list[int]] = {}
        lead: dict[int, float] = {}    # start -> its sum less that of the next start kept
        before: dict[int, int] = {}    # start -> the one kept before it
        gone: dict[int, int] = {}      # a dropped start -> a later one

        def kept_from(i: int) -> int:
            """The first start kept at or behind ``i``."""
            path = []
            while i in gone:
                path.append(i)
                i = gone[i]
            for j in path:
                gone[j] = i
            return i

        head, total = lo, 0.0          # the first start kept and its sum
        best, first, last = 0.0, lo, lo
        for k in range(lo, hi):
            gain = gains[k]
            seen = earlier.setdefault(names[k], [])
            spent = seen[-REPEATS] if len(seen) >= REPEATS else lo - 1
            seen.append(k)
            drop = []
            if k > lo:
                gap = PENALTY * (at[k] - at[k - 1] - 1)
                before[k] = k - 1      # the start that the last step has added
                lead[k - 1] = gains[k - 1] - gap
                total += (gain if head > spent else -PENALTY) - gap
                drop.append(k - 1)
                if spent >= lo:        # starts up to there pay the penalty, later ones gain
                    edge = before.get(kept_from(spent + 1))
                    if edge is not None:
                        lead[edge] -= gain + PENALTY
                        drop.append(edge)
            else:
                total = gain
            for s in drop:
                while s is not None and s not in gone and lead[s] <= 0:
                    earlier_start, later = before.get(s), kept_from(s + 1)
                    gone[s] = later
                    if earlier_start is None:
                        head, total = later, total - lead[s]
                        before.pop(later, None)
                    else:
                        before[later] = earlier_start
                        lead[earlier_start] += lead[s]
                    s = earlier_start
            if k > lo and head > last:
                break
            if total > best:
                best, first, last = total, head, k
        out.append((first, last, best))
        todo += [(last + 1, hi), (lo, first)]
    return sorted(out)


class ExtremeValues:
    """P(best segment of n words >= s) = 1 - exp(-K n exp(-lam s))."""

    def __init__(self, lam: float, log_k: float):
        self.lam, self.log_k = lam, log_k

    @classmethod
    def fit(cls, positive: np.ndarray, best: np.ndarray, words: np.ndarray,
            counts: np.ndarray | None = None) -> ExtremeValues:
        """From clean texts: the positive word scores (with how often each occurs, if
        given), and each text's best segment and length. lambda solves sum p_i exp(lambda s_i) = 1 over the word scores;
        K is its likeliest value given lambda."""
        total = float(words.sum())
        counts = np.ones(len(positive)) if counts is None else counts
        rest = total - float(counts.sum())
        if not len(positive) or rest <= 0:
            return cls(1.0, 0.0)

        def excess(lam: float) -> float:
            return (rest * math.exp(-lam * PENALTY) + float((counts * np.exp(lam * positive)).sum())) / total - 1

        hi = 1e-3
        while excess(hi) < 0 and hi < 20:
            hi *= 2
        lo = hi / 2
        for _ in range(50):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if excess(mid) < 0 else (lo, mid)
        weight = float((words * np.exp(-lo * best)).sum())
        return cls(lo, math.log(len(words) / max(weight, 1e-9)))

    def log10_p(self, score: np.ndarray, words: np.ndarray) -> np.ndarray:
        """-log10 of the p-value (0 without a segment), stable for tiny ones."""
        log_e = self.log_k + np.log(np.maximum(words, 1)) - self.lam * np.asarray(score, float)
        log_p = np.where(log_e < -20, log_e, np.log(-np.expm1(-np.exp(np.minimum(log_e, 5))) + 1e-300))
        return np.where(np.asarray(score) > 0, np.maximum(0, -log_p / math.log(10)), 0.0)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic curve (the last one is the constant) by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-9 * np.eye(len(w)),
                               x.T @ (y - p) - penalty * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


class ToxicityModel:
    def __init__(self, lexicon: Lexicon, law: ExtremeValues, weights: np.ndarray | None, share: float):
        self.lexicon, self.law, self.weights, self.share = lexicon, law, weights, share

    def segments(self, data: bytes) -> tuple[int, list[tuple[int, int, float]]]:
        return self.lexicon.scan(data)[:2]

    def evidence(self, words: np.ndarray, best: np.ndarray, total: np.ndarray) -> np.ndarray:
        """-log10 p of the best segment (up to 30), and of the sum of the
        significant ones on a log scale."""
        return np.c_[np.minimum(self.law.log10_p(best, words), 30), np.log1p(total)]

    def significant(self, n: int, found: list[tuple[int, int, float]]) -> list[tuple[int, int, float, float]]:
        if not found:
            return []
        logs = self.law.log10_p(np.array([s for *_, s in found]), np.full(len(found), n))
        return [(a, b, s, float(q)) for (a, b, s), q in zip(found, logs) if q >= -math.log10(SIGNIFICANT)]

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(evidence), self.share)
        z = np.c_[evidence, np.ones(len(evidence))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_FIT_ROWS) -> ToxicityModel:
    spark = docs.sparkSession
    prepare_workers(spark)
    rows = training_rows(docs, labels, most)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = rows.where("toxic = 1"), rows.where("toxic = 0")
    # at most MAX_UNITS rows come back, and the same units again from the other texts
    found = _unit_counts(bad).where(F.col("n") >= MIN_TOXIC).orderBy(F.desc("n"), "unit").limit(MAX_UNITS).toArrow()
    names = found["unit"].to_numpy()
    others = dict(zip(*_unit_counts(good, frozenset(names.tolist())).toArrow().to_pydict().values()))
    clean = np.array([others.get(u, 0) for u in names.tolist()], np.int64)
    lexicon = Lexicon(names, found["n"].to_numpy(), clean, sizes.get(1, 0), sizes.get(0, 0))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for data in b.column(1).to_pylist():
                n, found, counted = lexicon.scan(data)
                out.append((n, max((s for *_, s in found), default=0.0), [float(s) for *_, s in found], counted))
            cols = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, t in zip(cols, (
                    pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()))))],
                ["toxic", "words", "best", "segments", "positive"])

    # the lists grow with the texts, so they stay in a written table; what comes back is two
    # numbers for each of the at most ``most`` training rows, and a count for each different score
    seen = materialize(rows.mapInArrow(
        scan, "toxic int, words bigint, best double, segments array<double>, positive array<double>"), "toxic-seen")
    share = sum(n for toxic, n in sizes.items() if toxic > 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return ToxicityModel(lexicon, ExtremeValues(1.0, 0.0), None, share)
    clean = seen.where("toxic = 0").select("words", "best").toPandas()
    gains = seen.where("toxic = 0").select(F.explode("positive").alias("v")).groupBy("v").count().orderBy("v").toPandas()
    law = ExtremeValues.fit(gains["v"].to_numpy(float), clean["best"].to_numpy(float), clean["words"].to_numpy(float),
                            gains["count"].to_numpy(float))
    model = ToxicityModel(lexicon, law, None, share)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short = ToxicityModel(None, law, None, share)
        for b in batches:
            sums = [sum(q for *_, q in short.significant(n, [(0, 0, s) for s in segments]))
                    for n, segments in zip(b.column(1).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(sums, pa.float64())],
                                             ["toxic", "words", "best", "total"])

    got = seen.select("toxic", "words", "best", "segments").mapInArrow(
        totals, "toxic int, words bigint, best double, total double").toPandas() \
        .sort_values(["toxic", "words", "best", "total"], kind="stable")
    x = model.evidence(got["words"].to_numpy(float), got["best"].to_numpy(float), got["total"].to_numpy(float))
    model.weights = fit_logistic(x, (got["toxic"] > 0).to_numpy(float))
    return model


SCORED = ("doc_id bigint, n_words bigint, score double, p_log10 double, "
          "passages array<struct<start:bigint,end:bigint,score:double,p_log10:double>>")


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, n_words, score (probability), p_log10 (-log10 of the best segment's
    p-value) and the significant passages (first word, word after the last, score,
    -log10 p): one row per document, in one narrow pass."""
    spark = docs.sparkSession
    prepare_workers(spark)
    shared = spark.sparkContext.broadcast(model)  # the lexicon: at most MAX_UNITS units

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()),
                                    ("p_log10", pa.float64())]))
        for b in batches:
            words, best, total, passages = [], [], [], []
            for data in b.column(1).to_pylist():
                n, found = m.segments(data)
                good = m.significant(n, found)
                words.append(n)
                best.append(max((s for *_, s in found), default=0.0))
                total.append(sum(q for *_, q in good))
                passages.append([dict(zip(("start", "end", "score", "p_log10"), p)) for p in good])
            x = m.evidence(np.array(words, float), np.array(best), np.array(total))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words, pa.int64()), pa.array(m.probability(x), pa.float64()),
                 pa.array(x[:, 0], pa.float64()), pa.array(passages, spans)],
                ["doc_id", "n_words", "score", "p_log10", "passages"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("data")).mapInArrow(run, SCORED)


def op2_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", is_held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         "p_log10", F.size("passages").cast("long").alias("n_passages"))
