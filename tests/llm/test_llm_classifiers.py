"""Toxicity, language and quality: the parts against brute force, the whole on held-out rows."""

import random
from zlib import crc32

import numpy as np
import pytest

from conftest import SF_SMALL
from trip_engine.llm import cotraining, langid, toxicity

BENCH = "/root/testdata/sf0.1"


def _table(spark, name, sf_dir=BENCH):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _recursive(s):
    out = []

    def search(lo, hi):
        best = None
        for i in range(lo, hi):
            t = 0
            for j in range(i, hi):
                t += s[j]
                if best is None or t > best[2] + 1e-12 or abs(t - best[2]) <= 1e-12 and j + 1 - i < best[1] - best[0]:
                    best = (i, j + 1, t)
        if best is not None and best[2] > 0:
            search(lo, best[0])
            out.append(best)
            search(best[1], hi)

    search(0, len(s))
    return out


def test_segments_are_the_recursive_ones():
    rnd = random.Random(2)
    for _ in range(1500):
        s = [rnd.choice([-1, -2, -0.5, 3, 1.25, 2.75, 4.1]) for _ in range(rnd.randint(0, 14))]
        got = [(a, b, round(x, 6)) for a, b, x in toxicity.maximal_segments(np.array(s))]
        assert got == [(a, b, round(x, 6)) for a, b, x in _recursive(s)]


def _capped(s, names, lo, hi):
    seen, total = {}, 0.0
    for k in range(lo, hi):
        if s[k] > 0:
            seen[names[k]] = seen.get(names[k], 0) + 1
        total += s[k] if s[k] > 0 and seen[names[k]] <= toxicity.REPEATS else -toxicity.PENALTY
    return total


def test_segments_with_repeats_have_the_best_scores():
    rnd = random.Random(5)
    for _ in range(1500):
        gain = {n: rnd.choice([0.3, 0.45, 0.6, 1.1, 2.3]) for n in "abc"}
        names = [rnd.choice("abc------") for _ in range(rnd.randint(1, 30))]
        s = np.array([gain.get(n, -toxicity.PENALTY) for n in names])
        found, counted = toxicity.segments_of(s, names)
        assert all(x == pytest.approx(_capped(s, names, a, b)) for a, b, x in found)
        best = max((_capped(s, names, i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=0)
        assert max((x for *_, x in found), default=0) == pytest.approx(max(best, 0))
        inside = {k for a, b, _ in found for k in range(a, b)}
        assert sum(b - a for a, b, _ in found) == len(inside) >= len(counted)
        assert inside >= set(np.flatnonzero(s > 0))


def test_a_passage_scores_the_same_wherever_it_stands():
    words = [f"w{i}" for i in range(8)]
    lexicon = toxicity.Lexicon(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), 1, 1)
    lexicon.units = {toxicity.units(w)[0]: 3.0 for w in ("foul", "vile", "nasty")}
    clean = " ".join(words * 20)
    passage = "foul w1 vile nasty"
    scattered = " ".join(f"{clean} {w}" for w in ("foul", "vile", "nasty") * 3)

    def best(text):
        return [x for *_, x in lexicon.scan(text.encode())[1] if x > 8]
    assert best(passage) == [8.75]
    assert best(f"{scattered} {clean} {passage}") == best(f"{passage} {clean} {scattered}") == [8.75]
    assert best(f" {clean} ".join([passage] * 5)) == [8.75] * 5


def test_extreme_value_law_fits_random_scores():
    draw = np.random.default_rng(1)
    words = np.full(4000, 300)
    scores = np.where(draw.random((4000, 300)) < 0.02, draw.exponential(0.8, (4000, 300)), -toxicity.PENALTY)
    best = np.array([max((x for *_, x in toxicity.maximal_segments(r)), default=0.0) for r in scores])
    law = toxicity.ExtremeValues.fit(scores[scores > 0], best, words.astype(float))
    p = 10 ** -law.log10_p(best, words)
    for level in (0.5, 0.1, 0.02):
        assert (p <= level).mean() == pytest.approx(level, rel=0.5)




def test_toxicity_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["toxic"] for r in _table(spark, "labels").collect()}
    rows = toxicity.op2_toxicity(_table(spark, "documents"), _table(spark, "labels")).collect()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(labels[r["doc_id"]], r) for r in rows if r["held_out"] and r["doc_id"] in labels]
    tp = sum(y and r["predicted"] for y, r in held)
    assert tp / sum(y for y, _ in held) >= 0.9 and tp / sum(r["predicted"] for _, r in held) >= 0.95


def test_passages_mark_the_words(spark):
    docs = _table(spark, "documents", SF_SMALL)
    model = toxicity.train(docs, _table(spark, "labels", SF_SMALL))
    for r in toxicity.score(docs, model).where("size(passages) > 0").limit(20).collect():
        assert all(0 <= p["start"] < p["end"] <= r["n_words"] and p["score"] > 0 for p in r["passages"])


def test_scores_do_not_depend_on_the_label_columns(spark):
    docs = _table(spark, "documents", SF_SMALL)
    model = toxicity.train(docs, _table(spark, "labels", SF_SMALL))
    from pyspark.sql import functions as F
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn(
        "doc_id", F.col("doc_id") + 1_000_000)
    a = sorted(r["score"] for r in toxicity.score(docs, model).collect())
    assert a == sorted(r["score"] for r in toxicity.score(other, model).collect())


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9, 40])
def test_codewords_lie_apart(n):
    code = langid.code_matrix(n)
    assert set(np.unique(code)) <= {-1.0, 1.0}
    assert all((col > 0).any() and (col < 0).any() for col in code.T)
    apart = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
    assert min(apart) >= (1 << (n - 2) if n <= 5 else 8)


def test_ngrams_in_parts(monkeypatch):
    counts = np.random.default_rng(0).integers(0, 50, (4, langid.BUCKETS))
    model = langid.LanguageModel(["a", "b", "c", "d"], counts)
    data = ("some words é " * 50).encode()
    whole = model.margins(data)
    monkeypatch.setattr(langid, "PART", 37)
    assert np.allclose(whole, model.margins(data), rtol=1e-4, atol=1e-4)


def test_language_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["lang"] for r in _table(spark, "documents").collect()}
    rows = langid.op3_language_id(_table(spark, "documents")).collect()
    held = [(truth[r["doc_id"]], r["lang_pred"]) for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert sum(a == b for a, b in held) / len(held) >= 0.99
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_one_language_and_nothing_to_learn(spark):
    schema = "doc_id long, text string, lang string"
    rows = [(i, "words of a text", "en") for i in range(20)] + [(30, "9 9", "en"), (31, None, None), (32, "ü", None)]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.op3_language_id(
        spark.createDataFrame(rows, schema)).collect()}
    assert got[3] == ("en", 1.0) and got[30] == got[31] == ("und", 0.0) and got[32] == ("en", 1.0)
    none = langid.op3_language_id(spark.createDataFrame([(1, "abc", None)], schema)).collect()
    assert (none[0]["lang_pred"], none[0]["score"]) == ("und", 0.0)


def test_quality_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in _table(spark, "labels").collect()}
    rows = cotraining.op5_quality_cotraining(_table(spark, "documents"), _table(spark, "labels")).collect()
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in held) / len(held) >= 0.97
    good = [b for a, b in held if a]
    assert sum(good) / len(good) >= 0.98


def test_views_exchange_what_they_are_sure_of():
    """With few labels the pool's pseudo-labels help the weaker view."""
    draw = np.random.default_rng(3)

    def views(n):
        y = draw.integers(0, 2, n).astype(float)
        text = np.c_[y * 3 + draw.normal(0, 0.7, n), draw.normal(0, 1, (n, 3))].astype(np.float32)
        meta = (np.outer(y - 0.5, np.linspace(0.2, 1, 12)) + draw.normal(0, 1, (n, 12))).astype(np.float32)
        return text, meta, y

    text, meta, y = views(60)
    aside = np.arange(60) % 3 == 0
    pool = views(3000)
    test = views(3000)
    alone = cotraining.CoTrained.fit((text, meta), y, aside, (pool[0][:0], pool[1][:0]))
    helped = cotraining.CoTrained.fit((text, meta), y, aside, pool[:2])
    assert helped.exchanged > 100 and alone.exchanged == 0

    def right(m, i):
        return (((m.score(test[0], test[1])[i] >= 0.5) == (test[2] > 0)).mean())
    assert right(helped, 2) > right(alone, 2) and right(helped, 0) >= 0.97


def test_a_rare_language_is_learnt_from_all_its_rows(spark):
    """Ten rows among thousands, and a sample that is far smaller than the table."""
    import random

    from trip_engine.llm import langid
    rnd = random.Random(4)

    def text(letters):
        return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(3, 8))) for _ in range(30))
    rows = [(i, text("aeionrst"), "en") for i in range(6000)] + [(10_000 + i, text("bcdghklm"), "de") for i in range(500)]
    rows += [(20_000 + i, text("pquvwxyz"), "xx") for i in range(10)]
    rows += [(30_000 + i, text("pquvwxyz"), None) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, most=300)
    assert model.langs == ["de", "en", "xx"]
    got = langid.identify(docs, model).where("doc_id >= 10000").collect()
    want = {r[0]: r[2] or "xx" for r in rows}
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in got) >= 0.99 * len(got)


def test_only_the_most_frequent_languages_are_learnt(spark, monkeypatch):
    from trip_engine.llm import langid
    monkeypatch.setattr(langid, "MAX_LANGS", 3)
    rows = [(i, f"some text number {i}", f"l{i % 40}" if i % 2 else f"l{i // 2 % 3}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert langid.train(docs).langs == ["l0", "l1", "l2"]


def _best_segment(at, gains, names):
    """By trying every start: the best sum where a word's third occurrence and later ones cost."""
    from collections import Counter

    from trip_engine.llm.toxicity import PENALTY, REPEATS
    best = 0.0
    for s in range(len(at)):
        seen, total = Counter(), 0.0
        for k in range(s, len(at)):
            total -= PENALTY * (at[k] - at[k - 1] - 1) if k > s else 0.0
            total += gains[k] if seen[names[k]] < REPEATS else -PENALTY
            seen[names[k]] += 1
            best = max(best, total)
    return best


def test_sweep_with_repeats_finds_the_best_segment():
    import random

    from trip_engine.llm.toxicity import _repeating
    rnd = random.Random(17)
    for _ in range(1500):
        n, v = rnd.randint(1, 30), rnd.randint(1, 6)
        names = [b"%d" % rnd.randrange(v) for _ in range(n)]
        worth = {w: rnd.choice([1, 1.25, 2, 3.5, 7]) for w in names}
        at, place = [], 0
        for _ in range(n):
            place += 1 + rnd.choice([0, 0, 1, 4, 12])
            at.append(place)
        gains = [worth[w] for w in names]
        found = _repeating(at, gains, names, 0, n)
        assert max(x for *_, x in found) == _best_segment(at, gains, names)
        assert all(a <= b for a, b, _ in found) and all(x[1] < y[0] for x, y in zip(found, found[1:]))


def test_sweep_with_repeats_grows_with_the_text():
    """2,000 scoring words over and over: eight times the words, not sixty-four times the steps."""
    import random
    import time

    from trip_engine.llm.toxicity import _repeating
    rnd, took = random.Random(5), []
    for n in (20_000, 160_000):
        names = [b"%d" % rnd.randrange(2000) for _ in range(n)]
        worth = {w: rnd.uniform(1, 6) for w in names}
        start = time.process_time()
        _repeating([*range(n)], [worth[w] for w in names], names, 0, n)
        took.append(time.process_time() - start)
    assert took[1] < 30 * took[0] + 0.5 and took[1] < 20


def _two_views(seed, n):
    """Rows whose label shows in the first view for one half and in the second for the other."""
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.5).astype(float)
    first = rng.random(n) < 0.5
    sign = 2 * y - 1
    text = np.c_[np.where(first, 4 * sign, 0) + rng.normal(0, 0.7, n), rng.normal(0, 1, n)]
    meta = np.c_[np.where(first, 0, 4 * sign) + rng.normal(0, 0.7, n), rng.normal(0, 1, n)]
    return (text, meta), y


def _plain_cotraining(views, y, aside, pool):
    """The rounds written out: lists of (features, label) for each view, one pool row at a time."""
    from trip_engine.llm import cotraining as ct
    share = float(y.mean())
    rows = [[(v[i], y[i]) for i in np.flatnonzero(~aside)] for v in views]
    taken = [set(), set()]
    most = max(1, int(len(pool[0]) * ct.SHARE_PER_ROUND))
    for number in range(ct.ROUNDS + 1):
        fitted = [ct.View().fit(np.array([x for x, _ in r]), np.array([t for _, t in r])).calibrate(v[aside], y[aside])
                  for r, v in zip(rows, views)]
        if number == ct.ROUNDS:
            break
        handed = 0
        for giver, taker in ((0, 1), (1, 0)):
            p = fitted[giver].probability(pool[giver])
            for label, part in ((1.0, share), (0.0, 1 - share)):
                sure = p if label else 1 - p
                free = [i for i in range(len(p)) if i not in taken[taker]]
                best = sorted(free, key=lambda i: (-sure[i], i))[:max(1, int(most * part))]
                chosen = [i for i in best if sure[i] >= ct.SURE]
                rows[taker] += [(pool[taker][i], label) for i in chosen]
                handed += len(chosen)
                if label:
                    ones = chosen
            taken[taker] |= set(ones) | set(chosen)
        if not handed:
            break
    return fitted, sum(len(r) for r in rows) - 2 * int((~aside).sum())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cotraining_equals_its_rounds_written_out(seed):
    from trip_engine.llm import cotraining as ct
    views, y = _two_views(seed, 120)
    pool, _ = _two_views(seed + 50, 600)
    aside = np.arange(len(y)) % 3 == 0
    model = ct.CoTrained.fit(views, y, aside, pool)
    fitted, exchanged = _plain_cotraining(views, y, aside, pool)
    assert model.exchanged == exchanged > 0
    for ours, plain in zip(model.views, fitted):
        assert np.allclose(ours.w, plain.w, atol=1e-6) and np.allclose(ours.curve, plain.curve, atol=1e-6)


def test_each_view_teaches_the_other():
    from trip_engine.llm import cotraining as ct
    views, y = _two_views(7, 90)
    pool, _ = _two_views(70, 800)
    test, truth = _two_views(700, 2000)
    aside = np.arange(len(y)) % 3 == 0
    none = tuple(v[:0] for v in pool)
    alone, taught = (ct.CoTrained.fit(views, y, aside, p) for p in (none, pool))
    for a, b in zip(alone.views, taught.views):
        assert np.abs(a.w - b.w).max() > 1e-3  # the other view's labels have moved it
    right = [((m.score(*test)[0] >= 0.5) == (truth > 0)).mean() for m in (alone, taught)]
    assert right[1] >= right[0] - 0.01 and right[1] > 0.95
