"""Market share: window vs join twin, dense calendar, pushed day range."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from trip_engine import fixtures as fx
from trip_engine.operators.share import densify_days, market_share, share_wide
from trip_engine.plans.inspect import physical_plan


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_window_equals_join(spark):
    r = fx.ride_requests(spark, SF_SMALL)
    a = market_share(r, first=fx.SHARE_FIRST_DAY, last=fx.SHARE_LAST_DAY)
    b = market_share(r, first=fx.SHARE_FIRST_DAY, last=fx.SHARE_LAST_DAY, form="join")
    rows = _rows(a)
    assert rows == _rows(b)
    assert len(rows) == 26 * 5          # FIXTURES B3: 26 days x 5 groups
    services = {x[1] for x in rows}
    assert services == {"Uber", "Lyft", "HV0002", "HV0004", None}


def test_percentages_sum_to_100_per_day(spark):
    r = fx.ride_requests(spark, SF_SMALL)
    s = market_share(r, first=fx.SHARE_FIRST_DAY, last=fx.SHARE_LAST_DAY)
    per_day = s.groupBy("trip_date").agg(F.sum("trip_percentage").alias("p")).collect()
    assert all(abs(x.p - 100.0) <= 0.05 for x in per_day)


def test_dense_calendar_zero_fills(spark):
    r = fx.ride_requests(spark, SF_SMALL)
    s = market_share(r, first="2023-12-25", last="2024-02-05")
    d = densify_days(s, "2023-12-25", "2024-02-05")
    rows = d.collect()
    assert len(rows) == 43 * 5
    assert sum(x.trip_count for x in rows) == sum(x.trip_count for x in s.collect())
    empty = [x for x in rows if str(x.trip_date) == "2023-12-25"]
    assert all(x.trip_count == 0 and x.trip_percentage == 0.0 and x.total_trip_count == 0
               for x in empty)


def test_wide_frame_has_every_day(spark):
    r = fx.ride_requests(spark, SF_SMALL)
    d = densify_days(market_share(r, first="2024-01-01", last="2024-01-31"),
                     "2024-01-01", "2024-01-31")
    w = share_wide(d).collect()
    assert len(w) == 31
    assert all(x.stacked_total <= 100.0 for x in w)
    assert all(abs(x.stacked_total - min(100.0, x.Uber + x.Lyft)) < 1e-9 for x in w)


def test_day_range_pushed_to_scan(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        r = fx.ride_requests(spark, SF_SMALL)
        plan = physical_plan(market_share(r, first=fx.SHARE_FIRST_DAY, last=fx.SHARE_LAST_DAY))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scan = [ln for ln in plan.splitlines() if "events.parquet" in ln][0]
    assert "GreaterThanOrEqual(ts,2024-01-03" in scan and "LessThan(ts,2024-01-29" in scan


def test_display_names(spark):
    from trip_engine.operators.share import with_display_names
    r = fx.ride_requests(spark, SF_SMALL)
    s = with_display_names(market_share(r, first="2024-01-03", last="2024-01-04"))
    assert s.columns == ["Trip Date", "Ride Hailing Service", "Trip Count", "Total Trip Count",
                         "Trip percentage for the day"]
    assert {x["Trip Date"] for x in s.collect()} == {"2024-01-03", "2024-01-04"}


def test_between_days_on_session_timestamps_and_dates(spark):
    from trip_engine.operators.filters import between_days
    df = spark.createDataFrame(
        [("2024-01-02 23:59:59",), ("2024-01-03 00:00:00",), ("2024-01-04 23:59:59",),
         ("2024-01-05 00:00:00",)], "t string")
    ltz = df.select(F.to_timestamp("t").alias("ts"))
    assert between_days(ltz, "ts", "2024-01-03", "2024-01-04").count() == 2
    days = df.select(F.to_date(F.to_timestamp("t")).alias("d"))
    assert between_days(days, "d", "2024-01-03", "2024-01-04").count() == 2


def test_dense_and_wide_scan_the_requests_once(spark):
    from trip_engine import registry as reg
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("market_share_dense", "market_share_wide"):
            assert physical_plan(reg.QUERIES[name](spark, SF_SMALL)).count("events.parquet") == 1
        tagged = physical_plan(reg.QUERIES["validate_requests"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tagged.count("orders.parquet") == 2  # the requests, and the mean that fills them


def test_dense_calendar_for_listed_services(spark):
    """Listed services without a request are zero-filled, the others left out;
    the day's total still counts every service."""
    r = fx.ride_requests(spark, SF_SMALL)
    s = market_share(r, first="2024-01-03", last="2024-01-04")
    rows = densify_days(s, "2024-01-03", "2024-01-05", ["Uber", "None such", None]).collect()
    assert len(rows) == 9 and {x.service for x in rows} == {"Uber", "None such", None}
    totals = {x.trip_date: x.total_trip_count for x in s.collect()}
    for x in rows:
        assert x.total_trip_count == totals.get(x.trip_date, 0)
        assert x.service != "None such" or x.trip_count == 0
    uber = {x.trip_date: x.trip_count for x in s.collect() if x.service == "Uber"}
    assert {x.trip_date: x.trip_count for x in rows if x.service == "Uber" and x.trip_count} == uber


def test_percent_of_nothing_is_null(spark):
    from trip_engine.functions.exprs import percent
    df = spark.createDataFrame([(0, 0), (1, 800), (None, 3)], "p long, t long")
    assert [r[0] for r in df.select(percent("p", "t")).collect()] == [None, 0.13, None]
