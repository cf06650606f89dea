"""From documents to packed training sequences: five stages, each one of the
text operators, each written as Parquet and read again by the next.

1. quality rules: documents that fail a rule of the current policy go
2. exact dedup: of equal texts the one with the largest id stays
3. SimHash near-dedup: of each component the smallest id stays
4. mixing sources to target weights: documents repeat as the mix takes them
5. packing: token sequences of at most 4096 ids

Defined cases: a null text is empty, fails the first stage's rules and goes; a null
source is a source of its own in the mix; a null id is the smallest id to dedup and stays
only in a component without ids to near-dedup; of fully repeated rows one stays, and
the mix repeats it; ties go by hashes of the rows, so reruns agree; texts of any length are
worked on whole; an empty table gives an empty result; other columns of the documents are kept
until packing, whatever their names.

Rounding by hashes, SimHash and tokenization have no SQL form, so there is no
twin; tests compare the stages with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trip_engine.llm import exact_dedup, mixing, packing, quality_rules, simhash
from trip_engine.llm.common import drop_scratch, materialize, read_table, scratch_mark

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("exact_dedup", exact_dedup.stage),
    ("simhash_near_dedup", simhash.stage),
    ("mix_sources", mixing.stage),
    ("packing", packing.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. What a stage has written in between goes once
    its result is written; the last table stays, as the result reads it."""
    docs = read_table(spark, sf_dir, "documents")
    mark = scratch_mark(spark)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_scratch(spark, mark, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
