"""Connected components of a link table, by alternating large-star and
small-star rounds (Kiveris et al., 2014). Every round is a pair of aggregates
and joins over written tables; nothing is gathered, and a node with very many
neighbours is met only by partial aggregates and by joins of two scans whose
hot keys AQE can split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import drop_scratch, materialize, scratch_mark

MAX_ROUNDS = 60


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star operation on edges (hi, lo), hi > lo, each once."""
    if larger:
        # neighbours of u in both directions; those above u move to u's least
        least = materialize(
            edges.select(F.explode(F.array(
                F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")),
                F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("e"))
            .groupBy("e.u").agg(F.min("e.v").alias("v"))
            .select("u", F.least("u", "v").alias("m")), "cc-least")
        moved = edges.join(least.withColumnRenamed("u", "lo"), "lo").select(
            F.col("hi").alias("a"), F.col("m").alias("b"))
    else:
        # neighbours of u below u, and u itself, move to the least of them
        least = materialize(edges.groupBy("hi").agg(F.min("lo").alias("m")), "cc-least")
        moved = edges.join(least, "hi").select(F.explode(F.array(
            F.struct(F.col("lo").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("hi").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
    return moved.where("a != b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v: long); root is the least
    node of the component. Nodes without links have no row."""
    spark = links.sparkSession
    mark = scratch_mark(spark)
    edges = materialize(links.where("u != v").select(
        F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct(), "cc-edges")
    before = None
    for _ in range(MAX_ROUNDS):
        # the stars are stable once no node has two smaller neighbours and no
        # smaller neighbour has one itself
        edges = materialize(_star(edges, larger=True), "cc-large")
        edges = materialize(_star(edges, larger=False), "cc-small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    nodes = edges.select(F.explode(F.array(
        F.struct(F.col("hi").alias("node"), F.col("lo").alias("root")),
        F.struct(F.col("lo").alias("node"), F.col("lo").alias("root")))).alias("e")) \
        .groupBy("e.node").agg(F.min("e.root").alias("root"))
    result = materialize(nodes, "cc-roots")
    drop_scratch(spark, mark, keep=1)
    return result
