"""Airport insights job (OP-90): three trip sources + zone lookup -> six reports."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from trip_engine.operators.airports import airport_reports, release_reports
from trip_engine.operators.filters import select_zones
from trip_engine.operators.sinks import write_report
from trip_engine.sources.adapters import consolidate
from trip_engine.sources.files import read_trips, read_zone_lookup
from trip_engine.specs import GREEN, RIDE_HAILING, YELLOW, ZoneSpec

# report name -> (output sub-folder, order); the sub-folders are fixed values
REPORT_PATHS = {
    "pickups_by_hour": ("pickups/by_hour_of_day", ("airport", "hour_of_day")),
    "pickups_by_weekday": ("pickups/by_day_of_week", ("airport", "day_of_week")),
    "dropoffs_by_hour": ("dropoffs/by_hour_of_day", ("airport", "hour_of_day")),
    "dropoffs_by_weekday": ("dropoffs/by_day_of_week", ("airport", "day_of_week")),
    "trips_by_hour": ("trips/by_hour_of_day", ("airport", "hour_of_day")),
    "trips_by_weekday": ("trips/by_day_of_week", ("airport", "day_of_week")),
}


def insights_from_frames(trips: DataFrame, lookup: DataFrame, spec: ZoneSpec = ZoneSpec(),
                         unmatched: str = "keep") -> dict[str, DataFrame]:
    """The six reports from consolidated trips and the full zone lookup."""
    return airport_reports(trips, select_zones(lookup, spec=spec), spec, unmatched)


def run(spark: SparkSession, ride_hailing_path: str, green_path: str, yellow_path: str,
        zone_lookup_path: str, output_path: str, spec: ZoneSpec = ZoneSpec(),
        unmatched: str = "keep") -> dict[str, DataFrame]:
    """Read, report, write one ordered CSV (with header) per report."""
    trips = consolidate(read_trips(spark, ride_hailing_path, RIDE_HAILING),
                        read_trips(spark, green_path, GREEN),
                        read_trips(spark, yellow_path, YELLOW))
    reports = insights_from_frames(trips, read_zone_lookup(spark, zone_lookup_path, spec),
                                   spec, unmatched)
    # The six reports are roll-ups of one cached cube: the first write fills
    # the cache, the other five run as concurrent jobs (one small task each).
    def write(name: str) -> None:
        sub, order = REPORT_PATHS[name]
        write_report(reports[name], os.path.join(output_path, sub), order)

    first, *rest = reports
    write(first)  # fills the cube cache once
    try:
        with ThreadPoolExecutor(max_workers=len(rest)) as pool:
            list(pool.map(write, rest))
    finally:
        release_reports()  # later reads of the frames recompute the cube
    return reports
