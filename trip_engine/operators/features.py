"""Feature frames for the duration model (OP-48, OP-49, OP-70)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_engine.functions.exprs import apply_schema, calendar_parts, encode_flag, great_circle
from trip_engine.specs import FeatureConfig

FEATURE_TYPES = {"vendor_id": "int", "passenger_count": "int", "store_and_fwd_flag": "int",
                 "hour": "int", "day": "int", "month": "int", "distance": "double",
                 "trip_duration": "int"}


def _valid(c: str) -> Column:
    """The value when it is a number, NULL for NULL and NaN."""
    return F.nanvl(F.col(c), F.lit(None).cast("double"))


def column_mean(df: DataFrame, col: str) -> Column:
    """OP-48: mean of a column, NULL and NaN skipped, as a lazy scalar
    subquery (one tiny aggregate job, no value round-trips through Python)."""
    return df.select(F.avg(_valid(col)).alias("_mean")).scalar()


def impute_mean(df: DataFrame, col: str, fit_on: DataFrame | None = None) -> DataFrame:
    """OP-49: replace NULL / NaN in ``col`` with its mean.

    ``fit_on=None`` uses the frame's own mean (the original batch job, train
    and test each their own); pass the training frame to apply the training
    mean to another frame. With no valid value at all the column stays NULL
    instead of failing."""
    source = df if fit_on is None else fit_on
    return df.withColumn(col, F.coalesce(_valid(col), column_mean(source, col)))


def check_features(cfg: FeatureConfig) -> None:
    """The label may not be a feature, nor appear twice (the original job
    selected it twice and read it from a test file that lacks it)."""
    if cfg.label in cfg.features:
        raise ValueError(f"label {cfg.label!r} must not be one of the features")
    if len(set(cfg.features)) != len(cfg.features):
        raise ValueError(f"duplicate feature names in {cfg.features}")


def base_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Feature columns before imputation: flag code, distance, calendar parts."""
    lat1, lon1, lat2, lon2 = cfg.coords
    return df.withColumns({
        "store_and_fwd_flag": encode_flag("store_and_fwd_flag", cfg.flag_unknown),
        "distance": great_circle(lat1, lon1, lat2, lon2, unit=cfg.unit, clamp=cfg.clamp,
                                 scale=cfg.scale, method=cfg.method),
        **calendar_parts("pickup_datetime"),
    })


def trip_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig(),
                  mean_from: DataFrame | None = None) -> DataFrame:
    """OP-70: id, the model features and (when present) the label.

    ``mean_from`` is the *raw* frame whose distance mean fills the gaps
    (usually the training trips); by default the frame's own mean is used."""
    check_features(cfg)
    feats = base_features(df, cfg)
    if cfg.impute:
        fit = None if mean_from is None else base_features(mean_from, cfg)
        feats = impute_mean(feats, "distance", fit)
    cols = ["id", *cfg.features] + ([cfg.label] if cfg.label in df.columns else [])
    return apply_schema(feats.select(*cols), FEATURE_TYPES)
