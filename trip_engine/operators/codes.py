"""Code -> name mapping by a lookup table (OP-16, the form for large mappings)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.plans.broadcast import fits_broadcast


def map_codes_join(df: DataFrame, code: str, lookup: DataFrame, key: str, name: str, out: str,
                   max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """``out`` = the lookup's name for the code; unknown codes unchanged, NULL
    stays NULL. Of several names for one code the least counts. The lookup is
    broadcast behind a check of its size; a larger one is joined by shuffle,
    where AQE splits hot codes."""
    names = (lookup.where(F.col(key).isNotNull())
             .groupBy(F.col(key).alias("_code")).agg(F.min(name).alias("_name")))
    if fits_broadcast(names, max_broadcast_rows):
        names = F.broadcast(names)
    return (df.join(names, F.col(code) == F.col("_code"), "left")
            .withColumn(out, F.coalesce("_name", code)).drop("_code", "_name"))
