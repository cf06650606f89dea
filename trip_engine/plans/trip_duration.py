"""Train + predict job (OP-91): training CSV + testing CSV -> predictions + model."""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField, StructType,
                               TimestampType)

from trip_engine.operators.features import trip_features
from trip_engine.operators.model import (audit_model, predict_durations, save_model,
                                         train_duration_model)
from trip_engine.operators.sinks import write_predictions
from trip_engine.session import write_scratch
from trip_engine.sources.files import read_csv, unreadable_values
from trip_engine.specs import FeatureConfig

_COMMON = [
    StructField("id", StringType(), True),
    StructField("vendor_id", IntegerType(), True),
    StructField("pickup_datetime", TimestampType(), True),
    StructField("dropoff_datetime", TimestampType(), True),
    StructField("passenger_count", IntegerType(), True),
    StructField("pickup_longitude", DoubleType(), True),
    StructField("pickup_latitude", DoubleType(), True),
    StructField("dropoff_longitude", DoubleType(), True),
    StructField("dropoff_latitude", DoubleType(), True),
    StructField("store_and_fwd_flag", StringType(), True),
]
# Declared CSV layouts (no inference pass over the files); the header names are
# fixed values.
TRAIN_SCHEMA = StructType(_COMMON + [StructField("trip_duration", IntegerType(), True)])
TEST_SCHEMA = StructType(_COMMON)


def rmse(pred: DataFrame, truth: DataFrame, label: str = "trip_duration") -> float:
    """Root mean squared error of predictions joined to the true labels."""
    j = pred.select("id", F.col(label).alias("_p")).join(
        truth.select("id", F.col(label).alias("_t")), "id")
    return j.agg(F.sqrt(F.avg(F.pow(F.col("_p") - F.col("_t"), 2)))).first()[0]


def train_and_predict(train_raw: DataFrame, test_raw: DataFrame,
                      cfg: FeatureConfig = FeatureConfig(impute=False), shape: str = "round",
                      **params) -> tuple[PipelineModel, DataFrame]:
    """Features for both frames, fit on train, score test. Missing distances
    are filled inside the pipeline with the *training* mean."""
    train = trip_features(train_raw, cfg)
    test = trip_features(test_raw, cfg)
    model = train_duration_model(train, cfg.features, cfg.label, **params)
    return model, predict_durations(model, test, shape)


HELD_OUT = 5  # one training trip in so many
_FOLD = "__held_out"


def held_out(key: str = "id") -> Column:
    """Whether a trip is in the held-out fold: by the md5 of its id, the same in any engine."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % HELD_OUT == 0


def fit_with_folds(train: DataFrame, cfg: FeatureConfig, **params) -> tuple[PipelineModel, dict]:
    """One fit on the trips outside the held-out fold, and the rows and errors of both
    folds from one scoring pass over the (written) training frame."""
    folds = train.where(F.col(cfg.label).isNotNull()).withColumn(_FOLD, F.coalesce(held_out(), F.lit(False)))
    model = train_duration_model(folds.where(~F.col(_FOLD)), cfg.features, cfg.label, **params)
    error = F.pow(F.col("prediction") - F.col(cfg.label), 2)
    found = {r[_FOLD]: r for r in model.transform(folds).groupBy(_FOLD).agg(
        F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(error)).alias("rmse")).collect()}
    none = {"rows": 0, "rmse": None}
    inside, outside = found.get(False, none), found.get(True, none)
    return model, {"training_rows": inside["rows"], "training_rmse": inside["rmse"],
                   "held_out_rows": outside["rows"], "held_out_rmse": outside["rmse"]}


def validate(train_raw: DataFrame, cfg: FeatureConfig = FeatureConfig(impute=False), **params) -> dict:
    """Rows with a label, and the error on the held-out fold of a model fitted without it."""
    found = fit_with_folds(trip_features(train_raw, cfg), cfg, **params)[1]
    return {"rows": found["training_rows"] + found["held_out_rows"], "held_out_rmse": found["held_out_rmse"]}


def run(spark: SparkSession, training_path: str, testing_path: str, output_path: str,
        cfg: FeatureConfig = FeatureConfig(impute=False), shape: str = "round",
        audit_table: str | None = None, **params) -> DataFrame:
    """Read, train, predict, write. The training features are written to the session's
    scratch folder, which all later passes read. With ``audit_table`` the model is
    fitted without a fifth of the training trips (chosen by a hash of their id); the
    audit row holds rows and error of both parts, and ``unreadable_values`` of
    the training file is written as a report beside the predictions. The training CSV
    is read once, and a second time for that report."""
    train = write_scratch(trip_features(read_csv(spark, training_path, TRAIN_SCHEMA), cfg), "training-features")
    test = trip_features(read_csv(spark, testing_path, TEST_SCHEMA), cfg)
    if audit_table:
        model, found = fit_with_folds(train, cfg, **params)
        audit_model(spark, model, "trip_duration_model", audit_table, label=cfg.label,
                    num_partitions=model.num_partitions, **found)
        unreadable_values(spark, training_path, TRAIN_SCHEMA).write.mode("overwrite").option("header", True).csv(
            os.path.join(output_path, "unreadable"))
    else:
        model = train_duration_model(train, cfg.features, cfg.label, **params)
    preds = predict_durations(model, test, shape)
    write_predictions(preds, os.path.join(output_path, "predictions"))
    save_model(model, os.path.join(output_path, "models", "gbtr"))
    return preds
