"""File sources (OP-01..04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trip_engine.sources.adapters import conform
from trip_engine.specs import SourceSpec, ZoneSpec


def read_trips(spark: SparkSession, path: str, spec: SourceSpec) -> DataFrame:
    """OP-01 + OP-05: Parquet trips of one source, conformed to the common
    columns. Only the four columns reach the scan (Catalyst prunes the rest)."""
    return conform(spark.read.parquet(path), spec)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, strict: bool = False) -> DataFrame:
    """OP-02: CSV with a header.

    Without ``schema`` the types are inferred (an extra pass over the files).
    With a declared schema the columns are bound *by header name* (Spark's
    CSV reader would bind a schema by position) and typed with ``try_cast``;
    declared columns absent from the file come back as NULL, so a test file
    without the label reads with the training schema's other fields.
    ``strict`` casts instead: a value that does not fit its type fails the
    read. ``unreadable_values`` counts what the lenient mode turns into NULL."""
    reader = spark.read.option("header", header)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if not header:
        return reader.schema(schema).csv(path)
    text = reader.csv(path)
    return text.select(*[
        ((F.col(f.name).cast(f.dataType) if strict else F.col(f.name).try_cast(f.dataType))
         if f.name in text.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def unreadable_values(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One row per declared column: ``column_name`` and how many values of the
    CSV are there but do not fit the type (one pass)."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    text = spark.read.option("header", True).csv(path)
    fields = [f for f in schema.fields if f.name in text.columns]
    counts = text.agg(*[F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
                        .alias(f.name) for f in fields])
    return counts.unpivot([], [f.name for f in fields], "column_name", "unreadable")


# fixed values: the columns of the city's zone lookup
ZONE_LOOKUP_COLUMNS = ("LocationID", "Borough", "Zone", "service_zone")


def read_zone_lookup(spark: SparkSession, path: str, spec: ZoneSpec = ZoneSpec()) -> DataFrame:
    """OP-03: the zone lookup CSV, its columns bound by header name and read
    as strings, the key typed with try_cast so a malformed key becomes NULL (it
    matches no trip) instead of failing. A file without the key or name column
    of ``spec`` is refused."""
    wanted = list(dict.fromkeys([spec.key, spec.name, *ZONE_LOOKUP_COLUMNS]))
    header = spark.read.option("header", True).csv(path).columns
    if lost := [c for c in (spec.key, spec.name) if c not in header]:
        raise ValueError(f"zone lookup {path} has no column {lost}; it has {header}")
    schema = StructType([StructField(c, StringType(), True) for c in wanted
                         if c in header or c in ZONE_LOOKUP_COLUMNS and spec == ZoneSpec()])
    return read_csv(spark, path, schema).withColumn(spec.key, F.col(spec.key).try_cast("long"))


def register_external(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                      **options: str) -> DataFrame:
    """OP-04: an external (unmanaged) table over files, readable by name from
    SQL; dropping it leaves the files in place. An external table or view of that
    name is replaced; a managed table is not, since dropping it would delete its
    files."""
    quoted = ".".join(f"`{part.strip('`').replace('`', '``')}`" for part in name.split("."))
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind in ("TEMPORARY", "VIEW"):
            raise ValueError(f"{name} is a view; drop it first")
        if kind != "EXTERNAL":
            raise ValueError(f"{name} is a managed table; dropping it would delete its data")
        spark.sql(f"DROP TABLE {quoted}")
    return spark.catalog.createTable(quoted, path=path, source=fmt, **options)
