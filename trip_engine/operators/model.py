"""Duration model: assembly, training, scoring, persistence, audit (OP-71..76).

One ``PipelineModel`` holds imputation, binning, assembly and the boosted trees, so
batch scoring and the stream apply exactly what training fitted (the mean
distance of the *training* trips, the same seven features in the same order).

The trees grow on binned features. The library itself would sample its split
candidates per partition, so its fit depends on how the rows are dealt out. Here
one pass sketches every feature: counts, minimum and maximum per bucket of a
logarithmic grid, which add up in any order. Bins of about equal weight are read off
the sketch once, and each bin is so common that the library then finds every
boundary, however the rows are dealt out.

Rows that fall into the same bins are alike to the trees: the fit gets them as one
point with their mean label and their number as its weight, which gives the splits
and leaf values of the single rows. So its passes (one per tree level) grow with the
cells of the grid of bins that hold rows, and no longer once the rows fill the grid.
"""

from __future__ import annotations

import datetime as dt
import json
import math

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegralType, LongType, StringType, StructField, StructType,
                               TimestampType)

from trip_engine.functions.exprs import shape_duration
from trip_engine.operators.features import check_features
from trip_engine.session import ensure_checkpoint_dir, write_scratch
from trip_engine.specs import LABEL, MODEL_FEATURES, FeatureConfig

DEFAULT_SEED = 42
# Points of one training partition, at most, and the fewest partitions: from the rows
# alone, so that a cluster of any size fits the same model to the last bit.
ROWS_PER_PARTITION = 200_000
LEAST_PARTITIONS = 8
# Bins of a feature that hold training rows (the lowest of the library's 32 stays empty).
MAX_BINS = 31
# Sketch: ratio of a bucket's bounds, magnitudes that count as zero and as infinite.
RATIO, SMALLEST, LARGEST = 1.005, 1e-9, 1e15
# Column of a training point's number of rows.
WEIGHT = "_weight"


def feature_sketch(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature, bucket, n, lo, hi: how many values of each feature lie in each bucket of
    a logarithmic grid, and the smallest and largest of them. Sketches of parts of
    the rows add up to that of all; missing values are left out. At most some
    20,000 buckets a feature, whatever the rows."""
    size = F.least(F.abs("v"), F.lit(LARGEST))
    step = F.ceil(F.log(size / F.lit(SMALLEST)) / F.lit(math.log(RATIO)))
    bucket = F.when(size < SMALLEST, F.lit(0)).otherwise(F.signum("v") * (step + 1)).cast("int")
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("v")) for i, c in enumerate(features)])))
    return (values.where(F.col("v").isNotNull() & ~F.isnan("v"))
            .groupBy("feature", bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")))


def bin_edges(buckets: Sequence[tuple[float, float, int]], bins: int = MAX_BINS) -> list[float]:
    """Boundaries between (lowest, highest, count) buckets, so that every bin holds
    a ``bins``-th of the values at least, but for the last, which holds half of that."""
    buckets = sorted(buckets)
    left = sum(n for _, _, n in buckets)
    share, held, edges = left / bins, 0, []
    for (_, hi, n), (lo, _, _) in zip(buckets, buckets[1:]):
        held, left = held + n, left - n
        if held >= share and left >= share / 2:
            edges.append((hi + lo) / 2 if hi < (hi + lo) / 2 else lo)
            held = 0
    return edges


class FeatureBinner(Estimator):
    """Fits the library's ``Bucketizer`` to the bins of the features' sketch. The lowest bin is
    one that no training value falls in: a value below all of them."""

    def __init__(self, features: Sequence[str], outputs: Sequence[str], bins: int = MAX_BINS):
        super().__init__()
        self.features, self.outputs, self.bins = list(features), list(outputs), bins

    def _fit(self, dataset: DataFrame) -> Bucketizer:
        found: dict[int, list] = {i: [] for i in range(len(self.features))}
        for r in feature_sketch(dataset, self.features).collect():
            found[r["feature"]].append((r["lo"], r["hi"], r["n"]))
        splits = []
        for i in range(len(self.features)):
            lowest = min(found[i])[0] if found[i] else 0.0
            splits.append([-math.inf, lowest - max(1.0, abs(lowest)), *bin_edges(found[i], self.bins), math.inf])
        return Bucketizer(splitsArray=splits, inputCols=self.features, outputCols=self.outputs, handleInvalid="keep")


def build_pipeline(features=MODEL_FEATURES, label: str = LABEL, seed: int = DEFAULT_SEED,
                   max_iter: int = 20, max_depth: int = 5, handle_invalid: str = "keep",
                   impute=("distance",),
                   mode_impute=("vendor_id", "passenger_count", "store_and_fwd_flag",
                                "day", "hour", "month")) -> Pipeline:
    """Imputer(s) -> bins -> VectorAssembler -> GBTRegressor (library defaults: 20
    trees of depth 5, as the original model; the seed is fixed because
    PySpark's default seed depends on the class name hash).

    Missing distances take the training mean, other missing features the
    training mode, so no row reaches the trees with a NaN (which boosted
    trees reject) and every request gets a prediction."""
    check_features(FeatureConfig(features=tuple(features), label=label))
    stages = []
    cols = list(features)
    mode_impute = [c for c in (mode_impute or ()) if c in cols]
    impute = [c for c in (impute or ()) if c in cols]
    if impute:
        stages.append(Imputer(strategy="mean", inputCols=list(impute),
                              outputCols=[f"{c}_filled" for c in impute]))
    if mode_impute:
        stages.append(Imputer(strategy="mode", inputCols=list(mode_impute),
                              outputCols=[f"{c}_filled" for c in mode_impute]))
    filled = set(impute) | set(mode_impute)
    cols = [f"{c}_filled" if c in filled else c for c in cols]
    stages.append(FeatureBinner(cols, [f"{c}_bin" for c in cols]))
    stages.append(VectorAssembler(inputCols=[f"{c}_bin" for c in cols], outputCol="features",
                                  handleInvalid=handle_invalid))
    stages.append(GBTRegressor(featuresCol="features", labelCol=label, seed=seed,
                               maxIter=max_iter, maxDepth=max_depth))
    return Pipeline(stages=stages)


def fit_partitions(rows: int) -> int:
    return max(LEAST_PARTITIONS, -(-rows // ROWS_PER_PARTITION))


def weighted_points(binned: DataFrame, bins: Sequence[str], label: str, weight: str) -> DataFrame:
    """One point per cell of the bins: the mean label of its rows, and their number as
    ``weight``. Labels that are no integers have sums that depend on the order, so
    there equal labels alone are put together.

    A cell with more than twice the rows of the mean cell is given as several points of
    that many rows, so that a bin's share of the points stays near its share of the rows (a
    fifth of it at least) and the library, which samples points, finds every boundary. So
    there are at most half as many points again as cells."""
    whole = isinstance(binned.schema[label].dataType, IntegralType)
    cells = (binned.groupBy(*bins).agg(F.avg(label).alias(label), F.count(F.lit(1)).alias(weight)) if whole else
             binned.groupBy(*bins, label).agg(F.count(F.lit(1)).alias(weight)))
    cells = write_scratch(cells, "cells")
    held = cells.agg(F.count(F.lit(1)).alias("cells"), F.sum(weight).alias("rows")).first()
    most = F.lit(-(-2 * held["rows"] // held["cells"]) if held["cells"] else 1).cast("long")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(weight) - 1) / most))).alias("_part")
    return cells.select("*", parts).withColumn(
        weight, F.least(most, F.col(weight) - F.col("_part") * most).cast("double"))


def train_duration_model(train: DataFrame, features=MODEL_FEATURES, label: str = LABEL,
                         seed: int = DEFAULT_SEED, num_partitions: int | None = None,
                         **params) -> PipelineModel:
    """OP-72: fit the pipeline on the training feature frame.

    Imputation, sketch and bins each read the frame once; the rows of equal bins are put
    together (``weighted_points``), and only these points are persisted around the fit,
    which reads them once per tree level. The points are dealt by hash of their bins and
    ordered there, over as many partitions as their number asks for: the same rows give the
    same model. Another ``num_partitions`` gives the same trees, with leaf values that
    differ in the last bits (sums of doubles in another order). Rows without a label
    cannot train."""
    missing = [c for c in [*features, label] if c not in train.columns]
    if missing:
        raise ValueError(f"training frame lacks columns {missing}")
    ensure_checkpoint_dir(train.sparkSession)  # boosting cuts its lineage there
    data = train.filter(F.col(label).isNotNull()).select(*features, label)
    *prepare, assembler, trees = build_pipeline(features, label, seed, **params).getStages()
    stages = Pipeline(stages=prepare).fit(data.select(*features)).stages
    bins = assembler.getInputCols()
    points = weighted_points(PipelineModel(stages).transform(data).select(*bins, label), bins, label, WEIGHT)
    order = [*bins, label, "_part"]
    num_partitions = num_partitions or fit_partitions(points.count())
    dealt = points.repartition(num_partitions, *order).sortWithinPartitions(*order)
    ready = assembler.transform(dealt).select(trees.getFeaturesCol(), label, WEIGHT).persist()
    try:
        model = PipelineModel([*stages, assembler, trees.setWeightCol(WEIGHT).fit(ready)])
    finally:
        ready.unpersist()
    model.num_partitions = num_partitions  # for the audit
    return model


def predict_durations(model: PipelineModel, df: DataFrame, shape: str = "round",
                      id_col: str = "id", label: str = LABEL) -> DataFrame:
    """OP-73 (+ OP-33): (id, trip_duration) per row; a narrow map, no shuffle."""
    return model.transform(df).select(
        id_col, shape_duration("prediction", shape).alias(label))


def save_model(model: PipelineModel, path: str) -> None:
    """OP-75: write (overwrite) the whole pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


AUDIT_SCHEMA = StructType([
    StructField("model_name", StringType(), False),
    StructField("model_type", StringType(), False),
    StructField("label", StringType(), True),
    StructField("features", StringType(), True),
    StructField("params", StringType(), True),
    StructField("training_rows", LongType(), True),
    StructField("held_out_rows", LongType(), True),
    StructField("training_rmse", DoubleType(), True),
    StructField("held_out_rmse", DoubleType(), True),
    StructField("num_partitions", LongType(), True),
    StructField("trained_at", TimestampType(), False),
])


def audit_model(spark: SparkSession, model: PipelineModel, name: str, table: str,
                training_rows: int | None = None, training_rmse: float | None = None,
                label: str = LABEL, held_out_rmse: float | None = None,
                num_partitions: int | None = None, held_out_rows: int | None = None) -> DataFrame:
    """OP-76: append one audit row per fit to ``table`` (created on first use)."""
    gbt = model.stages[-1]
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    params = {p.name: v for p, v in gbt.extractParamMap().items()
              if isinstance(v, (int, float, str, bool))}
    row = (name, type(gbt).__name__, label, json.dumps(assembler.getInputCols()),
           json.dumps(params, sort_keys=True), training_rows, held_out_rows, training_rmse,
           held_out_rmse, num_partitions,
           dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    rec = spark.createDataFrame([row], AUDIT_SCHEMA)
    rec.write.mode("append").saveAsTable(table)
    return rec
