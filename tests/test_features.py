"""Feature frame: T7 imputation, T10 label guard, B9 all-missing."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trip_engine import fixtures as fx
from trip_engine.operators.features import impute_mean, trip_features
from trip_engine.specs import FeatureConfig


def test_label_in_features_refused(spark):
    kt = fx.duration_trips(spark, SF_SMALL)
    with pytest.raises(ValueError):
        trip_features(kt, FeatureConfig(features=("vendor_id", "trip_duration")))
    with pytest.raises(ValueError):
        trip_features(kt, FeatureConfig(features=("vendor_id", "vendor_id")))


def test_train_and_test_frames(spark):
    train = trip_features(fx.duration_trips(spark, SF_SMALL))
    test = trip_features(fx.duration_trips(spark, SF_SMALL, with_label=False))
    assert train.columns == ["id", "vendor_id", "passenger_count", "store_and_fwd_flag", "day",
                             "hour", "month", "distance", "trip_duration"]
    assert test.columns == train.columns[:-1]
    assert train.filter(F.col("distance").isNull()).count() == 0
    types = dict(train.dtypes)
    assert types["distance"] == "double" and types["hour"] == "int"


def test_impute_uses_training_mean(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,)], "d double")
    test = spark.createDataFrame([(None,), (float("nan"),), (10.0,)], "d double")
    got = [r.d for r in impute_mean(test, "d", fit_on=train).collect()]
    assert got == [2.0, 2.0, 10.0]
    own = [r.d for r in impute_mean(test, "d").collect()]
    assert own == [10.0, 10.0, 10.0]


def test_impute_all_missing_stays_null(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "d double")
    assert [r.d for r in impute_mean(df, "d").collect()] == [None, None]


def test_flag_batch_mode(spark):
    kt = fx.duration_trips(spark, SF_SMALL)
    f = trip_features(kt, FeatureConfig(flag_unknown=1))
    assert f.filter(F.col("store_and_fwd_flag").isNull()).count() == 0
    g = trip_features(kt)
    assert g.filter(F.col("store_and_fwd_flag").isNull()).count() == 5088
