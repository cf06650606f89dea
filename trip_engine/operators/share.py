"""Daily market share per service (OP-47, OP-32, OP-56, OP-57 / OP-24)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trip_engine.functions.exprs import capped_sum, map_codes, percent, trip_day
from trip_engine.operators.filters import between_days
from trip_engine.operators.frames import series_wide
from trip_engine.specs import SERVICE_NAMES

SHARE_COLUMNS = ("trip_date", "service", "trip_count", "total_trip_count", "trip_percentage")

# --- fixed values: the display names of the original chart frame -------------
DISPLAY_NAMES = {"trip_date": "Trip Date", "service": "Ride Hailing Service",
                 "trip_count": "Trip Count", "total_trip_count": "Total Trip Count",
                 "trip_percentage": "Trip percentage for the day"}
# ---------------------------------------------------------------------------


def with_display_names(share: DataFrame) -> DataFrame:
    """The share frame under the original display column names, the day as
    'yyyy-MM-dd' text (for chart code written against those names)."""
    out = share.withColumn("trip_date", F.date_format("trip_date", "yyyy-MM-dd"))
    return out.withColumnsRenamed({k: v for k, v in DISPLAY_NAMES.items() if k in out.columns})


def service_days(df: DataFrame, ts: str = "request_datetime", code: str = "hvfhs_license_num",
                 mapping: Mapping[str, str] = SERVICE_NAMES, first=None, last=None) -> DataFrame:
    """OP-16 + OP-19 + OP-26: (trip_date, service) per request, restricted to
    the day range (as a pushed-down timestamp range) when given."""
    if first is not None and last is not None:
        df = between_days(df, ts, first, last)
    return df.select(trip_day(ts).alias("trip_date"), map_codes(code, mapping).alias("service"))


def market_share(df: DataFrame, ts: str = "request_datetime", code: str = "hvfhs_license_num",
                 mapping: Mapping[str, str] = SERVICE_NAMES, first=None, last=None,
                 form: str = "window") -> DataFrame:
    """OP-47: per day and service the trip count, the day's total and the
    percentage (2 decimals).

    ``form='window'`` (default) sums the *aggregated* rows per day with a
    window: one scan, and the second exchange moves only days x services
    rows. ``form='join'`` is the original two-aggregate self join (OP-32),
    kept as a test twin."""
    days = service_days(df, ts, code, mapping, first, last)
    counts = days.groupBy("trip_date", "service").agg(F.count(F.lit(1)).alias("trip_count"))
    if form == "window":
        out = counts.withColumn("total_trip_count",
                                F.sum("trip_count").over(Window.partitionBy("trip_date")))
    elif form == "join":
        totals = days.groupBy("trip_date").agg(F.count(F.lit(1)).alias("total_trip_count"))
        out = counts.join(totals, "trip_date", "inner")
    else:
        raise ValueError(f"form must be 'window' or 'join', got {form!r}")
    return out.select(*SHARE_COLUMNS[:4],
                      percent("trip_count", "total_trip_count").alias("trip_percentage"))


def densify_days(share: DataFrame, first: str | dt.date, last: str | dt.date,
                 services: Sequence[str | None] | None = None) -> DataFrame:
    """OP-56: one row per service per day in [first, last]; days without
    trips get count 0, the day's total (0 if none) and 0 %.

    The share is read once. Its rows are gathered per service (one row per day at
    most), each service is laid over the calendar, and the day's total is the
    largest any service knows: a window over days x services rows. Rows without a day
    (requests without a time) are on no day of the calendar; their services are."""
    f = F.to_date(F.lit(str(first)))
    la = F.to_date(F.lit(str(last)))
    days = F.map_from_entries(F.collect_list(F.when(F.col("trip_date").isNotNull(), F.struct(
        "trip_date", F.struct("trip_count", "total_trip_count", "trip_percentage")))))
    if services is None:
        per_service = share.groupBy("service").agg(days.alias("_days"))
    else:
        per_service = share.groupBy("service").agg(days.alias("_days"))
        missing = share.sparkSession.createDataFrame([(s,) for s in services], "service string")
        per_service = per_service.unionByName(missing, allowMissingColumns=True) \
            .groupBy("service").agg(F.max_by("_days", F.col("_days").isNotNull()).alias("_days"))
    found = per_service.select("service", F.explode(F.sequence(f, la)).alias("trip_date"), "_days") \
        .withColumn("_day", F.try_element_at("_days", F.col("trip_date")))
    total = F.max("_day.total_trip_count").over(Window.partitionBy("trip_date"))
    dense = found.withColumn("_day_total", total).select(
        "trip_date", "service",
        F.coalesce("_day.trip_count", F.lit(0).cast("long")).alias("trip_count"),
        F.coalesce("_day_total", F.lit(0).cast("long")).alias("total_trip_count"),
        F.coalesce("_day.trip_percentage", F.lit(0.0)).alias("trip_percentage"))
    if services is None:
        return dense
    keep = F.lit(False)
    for s in services:
        keep = keep | F.col("service").eqNullSafe(F.lit(s))
    return dense.where(keep)


def share_wide(share: DataFrame, services: Sequence[str] = ("Uber", "Lyft"),
               cap: float = 100.0) -> DataFrame:
    """OP-57 + OP-24: per day the share of each listed service side by side,
    and the stacked total of the first two capped at ``cap``."""
    wide = series_wide(share, "trip_date", "service", "trip_percentage", services)
    if len(services) >= 2:
        a, b = services[0], services[1]
        wide = wide.withColumn("stacked_total", capped_sum(a, b, cap))
    return wide
