"""Filters and predicates (OP-25..29)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_engine.specs import ZoneSpec


def select_zones(lookup: DataFrame, names: Iterable[str] | None = None,
                 spec: ZoneSpec = ZoneSpec()) -> DataFrame:
    """OP-25: lookup rows whose zone name is one of ``names`` (pushed to the scan)."""
    wanted = list(names if names is not None else spec.names)
    return lookup.filter(F.col(spec.name).isin(wanted))


def trips_in_zones(trips: DataFrame, zones: DataFrame, loc_col: str = "PULocationID",
                   spec: ZoneSpec = ZoneSpec()) -> DataFrame:
    """OP-25 applied to trips: keep trips whose ``loc_col`` is a key of the
    (already selected) zones. A semi join against the size-checked lookup
    keys, broadcast, so trips are filtered where they are read."""
    from trip_engine.plans.broadcast import fits_broadcast
    keys = zones.select(F.col(spec.key).alias("_zone_key")).distinct()
    if fits_broadcast(keys, spec.max_broadcast_rows):
        keys = F.broadcast(keys)
    return trips.join(keys, trips[loc_col] == keys["_zone_key"], "left_semi")


def _as_date(d: str | dt.date) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def between_days(df: DataFrame, ts: str, first: str | dt.date, last: str | dt.date) -> DataFrame:
    """OP-26: rows whose timestamp falls on a day in [first, last].

    Written as a half-open timestamp range so the bounds reach the Parquet
    scan as pushed filters (a filter on a formatted day string would not)."""
    lo = _as_date(first)
    hi = _as_date(last) + dt.timedelta(days=1)
    ts_type = df.schema[ts].dataType.simpleString()
    lo_c = F.lit(lo.isoformat()).cast(ts_type)
    hi_c = F.lit(hi.isoformat()).cast(ts_type)
    return df.filter((F.col(ts) >= lo_c) & (F.col(ts) < hi_c))


def slice_equal(df: DataFrame, column: str, value) -> DataFrame:
    """OP-27: equality slice (one service, one airport)."""
    return df.filter(F.col(column) == F.lit(value))


def missing_reasons(keys: Sequence[str], message: str) -> Column:
    """Array of reject reasons, one per NULL key, in key order (OP-28)."""
    reasons = [F.when(F.col(k).isNull(), F.lit(message.format(key=k))) for k in keys]
    return F.array_compact(F.array(*reasons))


def validate_required(df: DataFrame, keys: Sequence[str], message: str,
                      reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """OP-28: split records into (accepted, rejected). A key that is absent
    from the JSON record and a key that is null both read as NULL. Rejected
    rows keep their fields plus a '; '-joined reason text. Both read the input;
    to read it once use ``tag_required`` and split where the rows are written."""
    tagged = tag_required(df, keys, message, reason_col)
    return (tagged.filter(F.col(reason_col).isNull()).drop(reason_col),
            tagged.filter(F.col(reason_col).isNotNull()))


def tag_required(df: DataFrame, keys: Sequence[str], message: str,
                 reason_col: str = "reject_reason") -> DataFrame:
    """OP-28 in one pass: every record with its reject reasons joined by '; ', NULL
    for an accepted one."""
    reasons = F.concat_ws("; ", missing_reasons(keys, message))
    return df.withColumn(reason_col, F.when(reasons != "", reasons))


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """OP-29: drop rows with NULL (or NaN, for floating columns) in ``subset``."""
    return df.na.drop(subset=list(subset))
