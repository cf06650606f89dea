"""Chart and map frames (OP-55, OP-57, OP-58)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, AtomicType, BooleanType, DataType, NumericType,
                               StructType, VariantType)

from trip_engine.specs import MAP_SAMPLE_SEED, MAP_SAMPLE_SIZE

# 60 leading bits of the md5 digest (15 hex digits) order the rows.
_PREFIX_BITS = 60


def series_wide(report: DataFrame, index: str, series: str, value: str,
                values: Sequence) -> DataFrame:
    """OP-57: one row per ``index``, one column per known ``series`` value.

    Known values skip Spark's extra distinct-values job; (index, series) is a
    key of the report, so ``max`` just picks its single value."""
    return report.groupBy(index).pivot(series, list(values)).agg(F.max(value))


def sample_hash(key: str | Column, seed: int) -> Column:
    """md5 of seed ‖ key, lower-case hex (identical in Spark and SQL engines)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(str(seed)), k.cast("string")))


def sample_exact(df: DataFrame, n: int = MAP_SAMPLE_SIZE, seed: int = MAP_SAMPLE_SEED,
                 key: str = "id", ties: Sequence[str] | None = None) -> DataFrame:
    """OP-55: exactly ``n`` rows drawn without replacement, reproducibly: the
    ``n`` rows with the smallest md5(seed ‖ key), ties broken by ``key`` and
    then by the other columns (``ties``; by default all that have an order),
    so that only rows equal in all of them are interchangeable.

    Distributed in two passes and no global sort of the data: (1) a histogram
    of the hash's leading-zero count (at most 61 rows) fixes a power-of-two
    threshold that keeps at least ``n`` and on average under ``2n`` rows;
    (2) rows under the threshold are filtered in place and only they are
    ordered to pick the exact ``n``. Raises if ``n`` exceeds the row count,
    or - whatever ``n`` is - if a key is NULL (a NULL has no place in the order)."""
    if n < 0:
        raise ValueError("n must be >= 0")
    h = sample_hash(key, seed)
    prefix = F.conv(F.substring(h, 1, _PREFIX_BITS // 4), 16, 10).cast("long")
    zeros = F.when(prefix == 0, F.lit(_PREFIX_BITS)).otherwise(
        F.lit(_PREFIX_BITS) - F.length(F.bin(prefix)))
    hist = {r["z"]: r["n"] for r in
            df.select(zeros.alias("z")).groupBy("z").agg(F.count(F.lit(1)).alias("n")).collect()}
    if hist.get(None):
        raise ValueError(f"{hist[None]} rows have no {key}; drop or fill them before sampling")
    total = sum(hist.values())
    if n > total:
        raise ValueError(f"sample of {n} rows requested from {total} rows")
    # largest k with #(zeros >= k) >= n  <=>  smallest threshold 2^(60-k) keeping n rows
    level, running = 0, 0
    for k in range(_PREFIX_BITS, -1, -1):
        running += hist.get(k, 0)
        if running >= n:
            level = k
            break
    threshold = 1 << (_PREFIX_BITS - level)
    survivors = df.filter(prefix < F.lit(threshold)) if level > 0 else df
    if ties is None:
        ties = [f.name for f in df.schema.fields if f.name != key and _has_order(f.dataType)]
    return (survivors.withColumn("_h", h).orderBy("_h", key, *ties).limit(n).drop("_h"))


def _has_order(t: DataType) -> bool:
    if isinstance(t, ArrayType):
        return _has_order(t.elementType)
    if isinstance(t, StructType):
        return all(_has_order(f.dataType) for f in t.fields)
    return isinstance(t, AtomicType | NumericType | BooleanType) and not isinstance(t, VariantType)


def point_layer(df: DataFrame, lat: str, lon: str, layer: str,
                keep: Sequence[str] = ("id",)) -> DataFrame:
    """OP-58: one map layer: (layer, kept columns, latitude, longitude)."""
    return df.select(F.lit(layer).alias("layer"), *keep,
                     F.col(lat).alias("latitude"), F.col(lon).alias("longitude"))


# layer name -> (latitude, longitude)
LAYERS = {"pickups": ("pickup_latitude", "pickup_longitude"),
          "dropoffs": ("dropoff_latitude", "dropoff_longitude")}


def _both_layers(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A row per trip and layer, from one generator: the input is read once."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("layer"), *[F.col(c) for c in keep],
                 F.col(lat).alias("latitude"), F.col(lon).alias("longitude"))
        for name, (lat, lon) in LAYERS.items()])))


def point_layers(df: DataFrame, keep: Sequence[str] = ("id",)) -> DataFrame:
    """Pickup and dropoff layers of a (sampled) trip frame."""
    return _both_layers(df, keep)


def grid_density(df: DataFrame, lat: str, lon: str, cell_deg: float = 1e-2,
                 by: Sequence[str] = ()) -> DataFrame:
    """OP-58: trip count per lat/lon grid cell over *all* trips (a density map
    needs no sample). Rows without a usable coordinate are skipped."""
    ok = (F.col(lat).isNotNull() & ~F.isnan(lat) & F.col(lon).isNotNull() & ~F.isnan(lon))
    cell = F.lit(float(cell_deg))
    return (df.filter(ok)
            .groupBy(*by, F.floor(F.col(lat) / cell).cast("long").alias("lat_cell"),
                     F.floor(F.col(lon) / cell).cast("long").alias("lon_cell"))
            .agg(F.count(F.lit(1)).alias("trip_count")))


def layer_density(df: DataFrame, cell_deg: float = 1e-2) -> DataFrame:
    """Both layers' densities (layer, lat_cell, lon_cell, trip_count) in one pass."""
    return grid_density(_both_layers(df), "latitude", "longitude", cell_deg, by=("layer",))
