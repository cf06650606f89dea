"""Scoring-request records (OP-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# The request's field names and types (the wire format).
# Declared request schema: fields bind by name, and an integer JSON value for
# ``distance`` parses as a double.
REQUEST_SCHEMA = StructType([
    StructField("id", StringType(), True),
    StructField("vendor_id", IntegerType(), True),
    StructField("passenger_count", IntegerType(), True),
    StructField("store_and_fwd_flag", IntegerType(), True),
    StructField("hour", IntegerType(), True),
    StructField("day", IntegerType(), True),
    StructField("month", IntegerType(), True),
    StructField("distance", DoubleType(), True),
])


# The record as it came, and the fields whose value does not fit the schema.
RAW = "raw_record"
MALFORMED = "malformed"
WRONG_TYPE = "wrong_type"


def parse_requests(df: DataFrame, value_col: str = "value",
                   schema: StructType = REQUEST_SCHEMA) -> DataFrame:
    """Requests carried as JSON text in one column (e.g. a Kafka ``value``
    cast to string), parsed by name with the declared schema.

    Beside the fields: ``raw_record`` (the text as it came), ``malformed``
    (the text is not a JSON object) and ``wrong_type`` (names of fields that are
    there, but with a value that does not fit the type; they read as NULL)."""
    raw = F.col(value_col).cast("string")
    # every field as text first: what is there can be told from what fits
    text = F.from_json(raw, StructType([StructField(f.name, StringType()) for f in schema.fields]
                                       + [StructField("_bad", StringType())]),
                       {"columnNameOfCorruptRecord": "_bad"})
    # valid JSON that starts so is an object
    is_object = F.try_parse_json(raw).isNotNull() & F.ltrim(raw, F.lit(" \t\r\n")).startswith("{")
    rows = df.select(raw.alias(RAW), text.alias("_r"), F.coalesce(is_object, F.lit(False)).alias("_ok"))
    bad = ~F.col("_ok") | F.col("_r._bad").isNotNull()
    # the values in a step of their own: one cast each, read by what is told of them
    rows = rows.select(*[F.when(~bad, F.col(f"_r.{f.name}").try_cast(f.dataType)).alias(f.name) for f in schema.fields],
                       RAW, bad.alias(MALFORMED), "_r")
    wrong = F.array_remove(F.array(*[
        F.when(F.col(f"_r.{f.name}").isNotNull() & F.col(f.name).isNull(), F.lit(f.name)).otherwise("")
        for f in schema.fields]), "")
    return rows.select(*[f.name for f in schema.fields], RAW, MALFORMED,
                       F.when(F.col(MALFORMED), F.array().cast("array<string>")).otherwise(wrong).alias(WRONG_TYPE))


def read_requests(spark: SparkSession, path: str, streaming: bool = False,
                  schema: StructType = REQUEST_SCHEMA,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines requests, batch or as a file stream (a Kafka source is the
    production equivalent: give its value to ``parse_requests``). Lines are read
    as text, so a record that does not parse is kept as it came."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.text(path).where(F.trim("value") != "")
    return parse_requests(lines, "value", schema)
