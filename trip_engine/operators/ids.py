"""Row ids (OP-53, OP-54).

``row_number() OVER ()`` (the SQL model's id) and ``row_number()`` over a
global order both move every row into one partition. The dense ids here rest on a
row's position in the input, its partition and its place there, which
``monotonically_increasing_id`` gives without a shuffle: the partitions' row counts
become start offsets (a window over one row per partition).

For an ordered id only (order key, position) is range-partitioned, sorted
and written; the ranges' counts turn its places into ids, and the rows meet their
ids by position, in one shuffle without any skew. The frame itself is neither sorted nor
checkpointed. Positions must be the same in every pass: a plan that only reads and
maps files gives that, any other input is written first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trip_engine.plans.inspect import physical_plan
from trip_engine.session import write_scratch

# monotonically_increasing_id = partition index << 33 | position in partition
_POSITION_BITS = 33
# Rows per range of an ordered id: (key, position) rows are small.
RANGE_ROWS = 2_000_000


def _place() -> Column:
    """Position inside the partition."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))


def _starts(counts: DataFrame) -> DataFrame:
    """(_part, _n) to (_part, _start): the rows in all partitions before."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_start"))


def is_narrow(df: DataFrame) -> bool:
    """Whether the plan only reads and maps: then a row's partition and place are the same
    whenever it is computed. (A bucketed table's partitions depend on what is done with it.)"""
    plan = physical_plan(df)
    return not any(step in plan for step in ("Exchange", "AdaptiveSparkPlan", "InMemoryTableScan", "ExistingRDD",
                                             "Limit", "Coalesce", "Bucket"))


def key_id(*parts: Column) -> Column:
    """The md5 of the parts, each led by its number of bytes (``-`` for NULL), so that no
    two different keys read alike."""
    texts = [p.cast("string") for p in parts]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                            for t in texts]))


def add_row_id(df: DataFrame, mode: str = "sparse", order_by: Sequence[str] | None = None,
               col: str = "id", num_partitions: int | None = None) -> DataFrame:
    """Add a unique row id.

    * ``sparse``: unique, increasing within a partition, not contiguous
      (no extra job; the batch airport job's id).
    * ``dense``: exactly 1..N in partition order: one pass that counts, no shuffle.
    * ``key``: the md5 of the columns ``order_by`` (all columns by default):
      unique where they are, and the same after any recomputation.
    * ``dense`` with ``order_by``: 1..N following the given order, equal to
      ``row_number() OVER (ORDER BY ...)`` for a unique order key; equal keys keep
      their input order. ``num_partitions`` ranges, by default as many as the
      number of rows asks for.
    """
    if mode == "sparse":
        if order_by:
            raise ValueError("order_by needs mode='dense'")
        return df.withColumn(col, F.monotonically_increasing_id())
    if mode == "key":
        return df.withColumn(col, key_id(*[F.col(c) for c in (order_by or df.columns)]))
    if mode != "dense":
        raise ValueError(f"mode must be 'sparse', 'key' or 'dense', got {mode!r}")
    if not is_narrow(df):
        df = write_scratch(df, "row-id-input")
    if not order_by:
        counts = df.groupBy(F.spark_partition_id().alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
        tagged = df.withColumns({"_part": F.spark_partition_id(), "_place": _place()})
        # one row per input partition
        return (tagged.join(F.broadcast(_starts(counts)), "_part")
                .withColumn(col, F.col("_start") + F.col("_place") + 1).drop("_part", "_place", "_start"))
    # the position breaks ties, so a value shared by many rows still spreads over ranges
    thin = df.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(order_by)],
                     F.monotonically_increasing_id().alias("_position"))
    ranges = num_partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                                   -(-df.count() // RANGE_ROWS))
    pinned = write_scratch(thin.repartitionByRange(ranges, *thin.columns).sortWithinPartitions(*thin.columns)
                           .select("_position", F.spark_partition_id().alias("_part"), _place().alias("_place")),
                           "row-id-order")
    starts = _starts(pinned.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")))
    # one row per range
    ranked = pinned.join(F.broadcast(starts), "_part").select(
        "_position", (F.col("_start") + F.col("_place") + 1).alias(col))
    return df.withColumn("_position", F.monotonically_increasing_id()).join(ranked, "_position").drop("_position")
