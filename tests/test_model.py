"""Model: beats the mean predictor, save/load identical, audit row, B1-B3."""

import math
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_SMOKE
from trip_engine import fixtures as fx
from trip_engine.operators.features import trip_features
from trip_engine.operators.model import (audit_model, build_pipeline, load_model,
                                         predict_durations, save_model, train_duration_model)
from trip_engine.plans.trip_duration import rmse
from trip_engine.specs import FeatureConfig

CFG = FeatureConfig(impute=False)


@pytest.fixture(scope="module")
def fitted(spark):
    train = trip_features(fx.duration_trips(spark, SF_SMOKE, part="train"), CFG)
    model = train_duration_model(train, max_iter=8, max_depth=4)
    return trip_features(fx.duration_trips(spark, SF_SMOKE, part="test"), CFG), model


def test_beats_mean_predictor(spark, fitted):
    """On the test part, which the fit has not seen."""
    train, model = fitted
    preds = predict_durations(model, train, shape="raw")
    mean = train.agg(F.avg("trip_duration")).first()[0]
    base = train.agg(F.sqrt(F.avg(F.pow(F.col("trip_duration") - F.lit(mean), 2)))).first()[0]
    err = rmse(preds, train)
    assert err < 0.5 * base
    joined = preds.join(train.select("id", F.col("trip_duration").alias("t")), "id")
    rmsle = joined.agg(F.sqrt(F.avg(F.pow(F.log1p("trip_duration") - F.log1p("t"), 2)))).first()[0]
    base_rmsle = joined.agg(F.sqrt(F.avg(F.pow(F.log1p(F.lit(mean)) - F.log1p("t"), 2)))).first()[0]
    assert math.isfinite(rmsle) and rmsle < base_rmsle


def test_every_test_row_gets_prediction(spark, fitted):
    _, model = fitted
    test = trip_features(fx.duration_trips(spark, SF_SMOKE, with_label=False), CFG)
    preds = predict_durations(model, test)
    assert preds.count() == test.count()
    assert preds.filter(F.col("trip_duration").isNull()).count() == 0


def test_save_load_same_scores(spark, fitted, tmp_dir):
    train, model = fitted
    path = os.path.join(tmp_dir, "model")
    save_model(model, path)
    again = load_model(path)
    a = predict_durations(model, train, "raw").orderBy("id").collect()
    b = predict_durations(again, train, "raw").orderBy("id").collect()
    assert a == b


def test_audit_row_appended(spark, fitted):
    _, model = fitted
    audit_model(spark, model, "m1", "ml_models_audit", training_rows=10)
    audit_model(spark, model, "m2", "ml_models_audit")
    rows = spark.table("ml_models_audit").collect()
    assert [r.model_name for r in rows][-2:] == ["m1", "m2"]
    assert "distance_filled" in rows[-1].features


def test_pipeline_refuses_label_feature():
    with pytest.raises(ValueError):
        build_pipeline(features=("vendor_id", "trip_duration"))


def test_training_frame_missing_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "vendor_id int, trip_duration double")
    with pytest.raises(ValueError):
        train_duration_model(df)


def test_assembler_invalid_modes(spark):
    """OP-71: with imputers every row is scored; without them 'skip' drops
    rows with a NULL feature and 'error' refuses them (boosted trees reject
    NaN, so 'keep' is only safe behind the imputers)."""
    rows = [(f"id{i}", i % 3, float(i % 7), float(10 + i % 5)) for i in range(60)]
    rows.append(("idnull", 1, None, 12.0))
    df = spark.createDataFrame(rows, "id string, a int, b double, trip_duration double")
    kept = build_pipeline(features=("a", "b"), impute=("b",), mode_impute=("a",),
                          max_iter=2, max_depth=2).fit(df)
    assert kept.transform(df).count() == 61
    skip = build_pipeline(features=("a", "b"), impute=(), mode_impute=(), handle_invalid="skip",
                          max_iter=2, max_depth=2).fit(df)
    assert skip.transform(df).count() == 60
    err = build_pipeline(features=("a", "b"), impute=(), mode_impute=(), handle_invalid="error",
                         max_iter=2, max_depth=2)
    with pytest.raises(Exception):
        err.fit(df).transform(df).collect()


def test_fit_depends_on_neither_layout_nor_cores(spark):
    """The same rows in other partitions, and in sessions with 2 and 5 cores."""
    import subprocess
    import sys
    from conftest import ROOT
    here = [train_duration_model(trip_features(fx.duration_trips(spark, SF_SMOKE).repartition(n), CFG),
                                 max_iter=2, max_depth=4).stages[-1].toDebugString.split("\n", 1)[1] for n in (2, 7)]
    assert here[0] == here[1]
    script = (
        "import sys, hashlib; sys.path.insert(0, sys.argv[1])\n"
        "from trip_engine import fixtures as fx\n"
        "from trip_engine.session import build_session\n"
        "from trip_engine.operators.features import trip_features\n"
        "from trip_engine.operators.model import train_duration_model\n"
        "from trip_engine.specs import FeatureConfig\n"
        "s = build_session(sys.argv[2], shuffle_partitions=int(sys.argv[3]))\n"
        "t = trip_features(fx.duration_trips(s, sys.argv[4]), FeatureConfig(impute=False))\n"
        "m = train_duration_model(t, max_iter=2, max_depth=4)\n"
        "print('FIT', hashlib.md5(m.stages[-1].toDebugString.split(chr(10), 1)[1].encode()).hexdigest())\n")
    import hashlib
    want = hashlib.md5(here[0].encode()).hexdigest()
    for master, parts in (("local[2]", "4"), ("local[5]", "9")):
        out = subprocess.run([sys.executable, "-c", script, ROOT, master, parts, SF_SMOKE], capture_output=True,
                             text=True, timeout=300).stdout
        assert f"FIT {want}" in out


def test_fit_leaves_nothing_cached(spark, fitted):
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0


def test_validation_of_the_job(spark):
    from trip_engine.plans.trip_duration import validate
    raw = fx.duration_trips(spark, SF_SMOKE)
    found = validate(raw, max_iter=5, max_depth=4)
    spread = raw.agg(F.stddev("trip_duration")).first()[0]
    assert found["rows"] == raw.count() and found["held_out_rmse"] < 0.6 * spread


def _structure(model):
    """The trees without their leaf values."""
    import re
    return re.sub(r"Predict: \S+", "", model.stages[-1].toDebugString.split("\n", 1)[1])


def test_the_same_trees_on_any_number_of_partitions(spark):
    """16,500 rows: more than the library samples for its own split candidates."""
    from pyspark.sql import functions as F
    one = trip_features(fx.duration_trips(spark, SF_SMALL), CFG)
    train = one.unionByName(one.where("substring(id, -1) = '3'").withColumn("id", F.concat("id", F.lit("x"))))
    assert train.count() > 10_000
    models = [train_duration_model(train, max_iter=4, max_depth=4, num_partitions=n) for n in (4, 8, 64)]
    assert len({_structure(m) for m in models}) == 1
    rows = [predict_durations(m, train, "raw").orderBy("id").limit(2000).collect() for m in models]
    for other in rows[1:]:
        assert all(abs(a.trip_duration - b.trip_duration) < 1e-6 for a, b in zip(rows[0], other))


def test_sketches_add_up_in_any_order(spark):
    from trip_engine.operators.model import bin_edges, feature_sketch
    df = spark.range(5000).selectExpr(
        "(id * 7919) % 1000 / 10 AS a", "cast(id % 24 AS int) AS b", "-exp(id % 30) AS c",
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN double('NaN') ELSE 0.0 END AS d")
    sketches = [sorted(map(tuple, feature_sketch(df.repartition(n), ["a", "b", "c", "d"]).collect())) for n in (1, 9, 40)]
    assert sketches[0] == sketches[1] == sketches[2]
    per = {i: [(lo, hi, n) for f, _, n, lo, hi in sketches[0] if f == i] for i in range(4)}
    assert [sum(n for *_, n in per[i]) for i in range(4)] == [5000, 5000, 5000, 1666]
    assert all(hi - lo <= 0.0051 * max(abs(lo), abs(hi)) for i in range(3) for lo, hi, _ in per[i])
    edges = bin_edges(per[0])
    assert 25 <= len(edges) <= 30 and bin_edges(per[3]) == []
    assert bin_edges(per[1]) == [x + 0.5 for x in range(23)]
    counts = [df.where(f"a >= {lo} AND a < {hi}").count() for lo, hi in zip([-1, *edges], [*edges, 1e9])]
    assert min(counts) >= 5000 / 31 / 2 and max(counts) < 2.2 * 5000 / 31


def test_values_outside_the_training_range_are_scored(spark, fitted):
    train, model = fitted
    odd = train.limit(3).withColumns({"distance": F.lit(-5.0), "hour": F.lit(99)})
    assert predict_durations(model, odd, "raw").where("trip_duration IS NULL").count() == 0


def test_partitions_follow_the_rows():
    from trip_engine.operators.model import LEAST_PARTITIONS, ROWS_PER_PARTITION, fit_partitions
    assert fit_partitions(10) == LEAST_PARTITIONS
    assert fit_partitions(1000 * ROWS_PER_PARTITION + 1) == 1001


def test_rows_of_equal_bins_train_as_one_weighted_point(spark, monkeypatch):
    """The points hold every row, and give the trees and values of the single rows."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import GBTRegressor
    from trip_engine.operators import model as mo
    train = spark.range(4000).selectExpr(
        "'id' || id AS id", "cast(if(id % 5 < 4, 1, 2 + id % 3) AS int) AS a", "cast(if(id % 10 < 9, 0, id % 7) AS double) AS b",
        "cast((id * 7919) % 101 + 40 * (id % 5) + 300 * (id % 7) AS int) AS trip_duration").repartition(5)
    seen, real = [], mo.weighted_points
    monkeypatch.setattr(mo, "weighted_points", lambda *args: seen.append(real(*args)) or seen[-1])
    params = dict(features=("a", "b"), impute=("b",), mode_impute=("a",), max_iter=4, max_depth=4)
    model = train_duration_model(train, **params)
    points = seen[0].collect()
    assert len(points) < 200 and sum(p[mo.WEIGHT] for p in points) == 4000
    assert {p["_part"] for p in points} != {0}  # a cell of many rows stays many points
    assert sum(p.trip_duration * p[mo.WEIGHT] for p in points) == pytest.approx(train.agg(F.sum("trip_duration")).first()[0])
    rows = PipelineModel(model.stages[:-1]).transform(train)
    single = GBTRegressor(featuresCol="features", labelCol="trip_duration", seed=mo.DEFAULT_SEED, maxIter=4, maxDepth=4).fit(rows)
    a = {r.id: r.prediction for r in model.transform(train).collect()}
    b = {r.id: r.prediction for r in single.transform(rows).collect()}
    assert all(abs(a[i] - b[i]) < 1e-6 for i in b) and len(set(b.values())) > 4
    halves = train.withColumn("trip_duration", F.col("trip_duration") / 3)
    c = {r.id: r.prediction for r in train_duration_model(halves, **params).transform(train).collect()}
    assert all(abs(3 * c[i] - b[i]) < 1e-6 for i in b)


def test_points_are_few_more_than_cells(spark):
    """Cells somewhat above the mean stay one point; those far above it are cut, and no row is lost."""
    from trip_engine.operators.model import weighted_points
    rows = [4] * 30 + [1] * 60 + [60]  # rows of a cell
    binned = spark.createDataFrame([(float(i), 10 * i + k) for i, n in enumerate(rows) for k in range(n)], "a double, t int")
    points = weighted_points(binned, ["a"], "t", "w").collect()
    assert sum(p.w for p in points) == sum(rows)
    held = {i: [p.w for p in points if p.a == i] for i in range(len(rows))}
    assert [sum(w) for w in held.values()] == rows
    assert all(len(held[i]) == 1 for i in range(90)) and len(held[90]) > 5
    assert len(points) <= 1.5 * len(rows)
