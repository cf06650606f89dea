"""Exact positions in a global or grouped order without gathering anything: rows
are range-partitioned and sorted, written once, and each partition's counts per
group become offsets (partitions + groups rows, never the rows themselves)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trip_engine.llm.common import materialize

_POSITION = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | position


def with_positions(rows: DataFrame, order: Sequence[Column], group: str | None, name: str,
                   col: str = "idx", size: str | None = None) -> DataFrame:
    """``rows`` with their 0-based position ``col`` in ``order``, within ``group``
    (a column without nulls that leads ``order``) if given, and with the number
    of rows of the group as ``size``, if named. Rows that tie in the
    whole order get different positions; the input's position spreads them over
    partitions. ``rows`` should be a written table: range bounds are sampled from
    it in a pass of their own."""
    keys = [*order, F.col("__tie")]
    placed = materialize(
        rows.withColumn("__tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
        .select(*rows.columns, F.spark_partition_id().alias("__part"),
                F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION)).alias("__pos")), name)
    by = [group] if group else []
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__first"))
    found = [(F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift")]
    if size:
        found.append(F.sum("__n").over(Window.partitionBy(*by)).alias(size))
    return placed.join(counts.select(*by, "__part", *found), [*by, "__part"]).select(
        *rows.columns, (F.col("__pos") + F.col("__shift")).cast("long").alias(col), *([size] if size else []))
