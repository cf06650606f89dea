"""Trip source adapters (OP-05, OP-50)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.specs import TRIP_COLUMNS, SourceSpec


def conform(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """OP-05: rename one source's columns to the common four and add its label."""
    renames = spec.renames()
    missing = [c for c in renames if c not in df.columns]
    if missing:
        raise ValueError(f"source {spec.label!r} lacks columns {missing}")
    by_target = {v: k for k, v in renames.items()}
    return df.select(*[F.col(by_target[c]).alias(c) for c in TRIP_COLUMNS],
                     F.lit(spec.label).alias("source"))


def consolidate(*frames: DataFrame) -> DataFrame:
    """OP-50: UNION ALL of conformed sources, matched by column name."""
    if not frames:
        raise ValueError("consolidate needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b), frames)
