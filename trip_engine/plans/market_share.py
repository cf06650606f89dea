"""Market share series job (OP-92): requests -> daily share, dense calendar, chart frame."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_engine.operators.share import densify_days, market_share, share_wide
from trip_engine.operators.sinks import write_report


def series(requests: DataFrame, first: str, last: str,
           services=("Uber", "Lyft")) -> dict[str, DataFrame]:
    share = market_share(requests, first=first, last=last)
    dense = densify_days(share, first, last)
    return {"share": share, "dense": dense, "wide": share_wide(dense, services)}


def run(spark: SparkSession, requests_path: str, output_path: str, first: str, last: str,
        services=("Uber", "Lyft")) -> dict[str, DataFrame]:
    out = series(spark.read.parquet(requests_path), first, last, services)
    out["dense"].persist()  # days x services rows: both reports come from one read
    out["wide"] = share_wide(out["dense"], services)
    try:
        for name in ("dense", "wide"):
            df = out[name].withColumn("trip_date", F.date_format("trip_date", "yyyy-MM-dd"))
            order = ["trip_date", "service"] if name == "dense" else ["trip_date"]
            write_report(df, os.path.join(output_path, name), order)
    finally:
        out["dense"].unpersist()
    return out
