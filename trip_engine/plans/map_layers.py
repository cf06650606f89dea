"""Map layers job (OP-94): sampled point layers and a density grid over all trips."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_engine.operators.frames import LAYERS, layer_density, point_layers, sample_exact
from trip_engine.specs import MAP_SAMPLE_SEED, MAP_SAMPLE_SIZE


def layers(trips: DataFrame, n: int = MAP_SAMPLE_SIZE, seed: int = MAP_SAMPLE_SEED,
           key: str = "id", cell_deg: float = 1e-2) -> dict[str, DataFrame]:
    """The sampled points, and the density of both layers over all trips: three passes
    over the trips (the sample's histogram, its rows, the densities)."""
    sample = sample_exact(trips, n, seed, key)
    return {"points": point_layers(sample, keep=(key,)), "density": layer_density(trips, cell_deg)}


def run(spark: SparkSession, trips_path: str, output_path: str, n: int = MAP_SAMPLE_SIZE,
        seed: int = MAP_SAMPLE_SEED, cell_deg: float = 1e-2) -> dict[str, DataFrame]:
    from trip_engine.plans.trip_duration import TRAIN_SCHEMA
    from trip_engine.sources.files import read_csv
    out = layers(read_csv(spark, trips_path, TRAIN_SCHEMA), n, seed, "id", cell_deg)
    out["points"].write.mode("overwrite").parquet(os.path.join(output_path, "points"))
    density = out.pop("density").persist()
    try:
        for layer in LAYERS:  # one folder per layer
            name = f"{layer.removesuffix('s')}_density"
            out[name] = density.where(F.col("layer") == layer).drop("layer")
            out[name].write.mode("overwrite").parquet(os.path.join(output_path, name))
    finally:
        density.unpersist()
    return out
