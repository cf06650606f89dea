"""Sinks (OP-80..84)."""

from __future__ import annotations

import uuid

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, order_by: Sequence[str], header: bool = True,
                 mode: str = "overwrite") -> None:
    """OP-80: an ordered CSV report: the files in the order of their names hold
    the rows in the given order. The frame is range-partitioned, so a report of
    any size is written in parallel; AQE merges the ranges of a small one, which
    then is a single file."""
    df.orderBy(*order_by).write.mode(mode).option("header", header).csv(path)


def write_predictions(df: DataFrame, path: str, single_file: bool = False,
                      header: bool = True, mode: str = "overwrite") -> None:
    """OP-81: prediction CSV with a header. Row-level output stays split in
    parallel files unless one file is explicitly asked for; then only the
    write runs in one task (``repartition(1)``: scoring upstream stays
    parallel, which ``coalesce(1)`` would collapse into the same task)."""
    out = df.repartition(1) if single_file else df
    out.write.mode(mode).option("header", header).csv(path)


def publish_view(df: DataFrame, name: str, global_view: bool = False) -> None:
    """OP-82: view materialisation (re-evaluated on every read)."""
    if global_view:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)


def publish_table(df: DataFrame, name: str, mode: str = "overwrite",
                  comment: str | None = None,
                  column_comments: Mapping[str, str] | None = None,
                  properties: Mapping[str, str] | None = None,
                  labels: Mapping[str, str] | None = None,
                  partition_by: Sequence[str] | None = None,
                  fmt: str = "parquet") -> None:
    """OP-83 / OP-84: table materialisation (full refresh) with table and
    column comments and table properties. ``labels`` (owner, env, ...) are
    stored as ``label.<name>`` properties, since some names such as
    ``owner`` are reserved by Spark. A comment for a column that is not there raises.

    A refresh is written beside the table, comments and properties included, and the two swap
    names at the end: until then readers see the old table, and a refresh that fails
    leaves it as it was. A swap that was cut off between its two renames is
    completed by the next call (one refresh of a table at a time). ``mode='append'`` adds
    rows to the table itself."""
    unknown = sorted(set(column_comments or ()) - set(df.columns))
    if unknown:
        raise ValueError(f"comments for columns that {name} does not have: {unknown}")
    spark = df.sparkSession
    if column_comments:
        df = df.withColumns({c: F.col(c).alias(c, metadata={"comment": text}) for c, text in column_comments.items()})
    _finish_swap(spark, name)
    beside = mode == "overwrite"
    target = f"{name}{_NEW}{uuid.uuid4().hex}" if beside else name
    try:
        writer = df.write.mode("errorifexists" if beside else mode).format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with _partitions_found_by_path(spark):
            writer.saveAsTable(target)
        if comment is not None:
            spark.sql(f"COMMENT ON TABLE {target} IS '{_quote(comment)}'")
        properties = {**(properties or {}), **{f"label.{k}": v for k, v in (labels or {}).items()}}
        if properties:
            props = ", ".join(f"'{_quote(k)}' = '{_quote(v)}'" for k, v in properties.items())
            spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({props})")
    except Exception:
        if beside:
            spark.sql(f"DROP TABLE IF EXISTS {target}")
        raise
    if beside:
        _swap(spark, name, target)


_NEW, _OLD = "__new_", "__old_"
_TRACKED = "spark.sql.hive.manageFilesourcePartitions"


@contextmanager
def _partitions_found_by_path(spark: SparkSession):
    """The catalog of a session without a metastore keeps the folders of a table's partitions
    through a rename, which moves them; there partitions are found under the table's folder."""
    before = spark.conf.get(_TRACKED, "true")
    if spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        spark.conf.set(_TRACKED, "false")
    try:
        yield
    finally:
        spark.conf.set(_TRACKED, before)


def _swap(spark: SparkSession, name: str, fresh: str) -> None:
    """``fresh`` becomes ``name``; the table of that name goes."""
    old = f"{name}{_OLD}{uuid.uuid4().hex}"
    had = spark.catalog.tableExists(name)
    if had:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    if had:
        spark.sql(f"DROP TABLE {old}")


def _finish_swap(spark: SparkSession, name: str) -> None:
    """What an earlier, interrupted refresh left: the old table gets its name back where
    nothing has it, and leftovers go."""
    *database, table = name.split(".")
    where = f" IN {'.'.join(database)}" if database else ""
    prefix = "".join(f"{d}." for d in database)
    for mark in (_OLD, _NEW):
        for row in spark.sql(f"SHOW TABLES{where} LIKE '{table.strip('`').lower()}{mark}*'").collect():
            left = f"{prefix}{row.tableName}"
            if mark == _OLD and not spark.catalog.tableExists(name):
                spark.sql(f"ALTER TABLE {left} RENAME TO {name}")
            else:
                spark.sql(f"DROP TABLE IF EXISTS {left}")


def _quote(text: str) -> str:
    return str(text).replace("\\", "\\\\").replace("'", "\\'")
