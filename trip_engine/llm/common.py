"""Shared helpers of the text operators."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import trip_engine
from trip_engine.session import scratch_path

# Largest Arrow batch handed to a Python worker: rows, bytes of one batch.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20

_written: dict[str, list[str]] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application: they may
    run on machines, and in folders, that do not have it."""
    if spark.sparkContext.applicationId in _shipped:
        return
    root = Path(trip_engine.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / "trip_engine.zip"  # the driver serves it
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(spark.sparkContext.applicationId)


_shipped: set[str] = set()


def prepare_workers(spark: SparkSession) -> None:
    """Ship the package, and bound what one Arrow batch holds, so that a run of very
    long texts cannot fill a Python worker (the batching changes, not the rows)."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder of ``spark.checkpoint.dir``
    and read it back: the lineage is cut, the files survive a lost executor,
    and their size is known to the planner."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_mark(spark: SparkSession) -> int:
    return len(_written.get(spark.sparkContext.applicationId, []))


def drop_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the tables that ``materialize`` wrote after ``since`` (a value of
    ``scratch_mark``), but for the last ``keep``. Call it with 0 once the
    results that read them are consumed."""
    paths = _written.get(spark.sparkContext.applicationId, [])
    gone = paths[since:len(paths) - keep]
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in gone:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    del paths[since:len(paths) - keep]


@contextmanager
def paused_gc():
    """No garbage collection meanwhile: for work that makes millions of lists and no cycles,
    which the collector would walk again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def is_held_out(doc_id: str | Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text is 0 mod 5.
    A null id is held out, too."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def utf8(col: str = "text") -> Column:
    """The text as UTF-8 bytes, empty for null (no copy: strings are UTF-8)."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")
