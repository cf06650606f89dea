"""Registered queries (one per SURVEY §2 operator) and their SQL twins.

Each query takes ``(spark, sf_dir)``, builds its inputs from the driver's
tables with ``trip_engine.fixtures`` and runs the operator over the whole
tables. ``ORACLE`` holds the equivalent DuckDB SQL for the ones SQL can
express; the fixture derivations are repeated there as CTEs.

Output conventions (both sides): timestamps as 'yyyy-MM-dd HH:mm:ss' text,
days as 'yyyy-MM-dd' text, counts bigint, hour / weekday int.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_engine import fixtures as fx
from trip_engine.operators import airports as ap
from trip_engine.operators import quality as qa
from trip_engine.operators.filters import select_zones
from trip_engine.sources.adapters import conform, consolidate
from trip_engine.specs import GREEN, RIDE_HAILING, YELLOW, ZoneSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ZONES = ZoneSpec(names=fx.FIXTURE_ZONES)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _ts_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in cols})


# --- shared building blocks ---------------------------------------------------
def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OP-05 + OP-50: the three sources conformed and consolidated."""
    return consolidate(*(conform(fx.raw_trips(spark, sf_dir, s), s)
                         for s in (RIDE_HAILING, GREEN, YELLOW)))


def airport_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_zones(fx.zone_lookup(spark, sf_dir), spec=ZONES)


def impressions(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    t, z = trips(spark, sf_dir), airport_zones(spark, sf_dir)
    return ap.zone_impressions(t, z, kind, ZONES)


# SQL twins of the fixtures --------------------------------------------------
SQL_TRIPS = """
trips AS (
  SELECT l_shipdate + to_minutes(CAST(l_partkey % 1440 AS INTEGER)) AS pickup_datetime,
         l_shipdate + to_minutes(CAST(l_partkey % 1440 AS INTEGER))
                    + to_minutes(CAST(trunc(5 + l_quantity) AS INTEGER)) AS dropoff_datetime,
         l_suppkey % 20 AS PULocationID,
         l_partkey % 20 AS DOLocationID,
         CASE l_returnflag WHEN 'N' THEN 'ride_hailing' WHEN 'A' THEN 'green'
                           WHEN 'R' THEN 'yellow' END AS source
  FROM lineitem WHERE l_returnflag IN ('N', 'A', 'R')
)"""

SQL_ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS LocationID, r_name AS Borough, n_name AS Zone,
         CASE WHEN n_name IN ('NATION_3', 'NATION_7', 'NATION_22') THEN 'Airports'
              ELSE 'Boro Zone' END AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
),
airports AS (SELECT * FROM zones WHERE Zone IN ('NATION_3', 'NATION_7', 'NATION_22'))"""


def _sql_impressions(kind: str) -> str:
    ts, loc = ap.KINDS[kind]
    return f"""
{kind}s AS (
  SELECT t.{ts} AS impression_datetime, t.source, a.Zone AS airport,
         CAST(hour(t.{ts}) AS INTEGER) AS hour_of_day,
         CAST(dayofweek(t.{ts}) + 1 AS INTEGER) AS day_of_week
  FROM trips t RIGHT JOIN airports a ON t.{loc} = a.LocationID
)"""


SQL_IMPRESSIONS = ("WITH " + SQL_TRIPS + "," + SQL_ZONES + "," + _sql_impressions("pickup")
                   + "," + _sql_impressions("dropoff") + """,
alls AS (SELECT * FROM pickups UNION ALL SELECT * FROM dropoffs)
""")

# --- OP-01, 05, 10..12, 50 ---------------------------------------------------


@register("conform_sources", "WITH " + SQL_TRIPS + """
SELECT strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
       strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime,
       PULocationID, DOLocationID, source
FROM trips""")
def q_conform_sources(spark, sf_dir):
    return _ts_text(trips(spark, sf_dir), "pickup_datetime", "dropoff_datetime")


@register("consolidated_trips", "WITH " + SQL_TRIPS + """
SELECT source, PULocationID, count(*) AS trip_count,
       strftime(min(pickup_datetime), '%Y-%m-%d %H:%M:%S') AS first_pickup,
       strftime(max(dropoff_datetime), '%Y-%m-%d %H:%M:%S') AS last_dropoff
FROM trips GROUP BY source, PULocationID""")
def q_consolidated_trips(spark, sf_dir):
    t = trips(spark, sf_dir)
    out = t.groupBy("source", "PULocationID").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.min("pickup_datetime").alias("first_pickup"),
        F.max("dropoff_datetime").alias("last_dropoff"))
    return _ts_text(out, "first_pickup", "last_dropoff")


# --- OP-25, 27 ---------------------------------------------------------------
@register("zone_filter", "WITH " + SQL_TRIPS + "," + SQL_ZONES + """
SELECT strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime, PULocationID, source
FROM trips WHERE PULocationID IN (SELECT LocationID FROM airports)""")
def q_zone_filter(spark, sf_dir):
    """Lookup rows selected by zone name, then the trips starting there."""
    from trip_engine.operators.filters import trips_in_zones
    t = trips_in_zones(trips(spark, sf_dir), airport_zones(spark, sf_dir), "PULocationID", ZONES)
    return _ts_text(t.select("pickup_datetime", "PULocationID", "source"), "pickup_datetime")


# --- OP-13, 18, 30, 31, 51 ---------------------------------------------------
for _kind, _key in (("pickup", "airport_pickups"), ("dropoff", "airport_dropoffs"),
                    ("all", "airport_trips")):
    def _q(spark, sf_dir, _kind=_kind):
        return _ts_text(impressions(spark, sf_dir, _kind), "impression_datetime")
    register(_key, SQL_IMPRESSIONS + f"""
SELECT strftime(impression_datetime, '%Y-%m-%d %H:%M:%S') AS impression_datetime,
       source, airport, hour_of_day, day_of_week FROM {_kind}s""")(_q)

# --- OP-40..45, 52: the six reports -----------------------------
for _kind, _prefix in (("pickup", "airport_pickups"), ("dropoff", "airport_dropoffs"),
                       ("all", "airport_trips")):
    for _by, _suffix in (("hour_of_day", "by_hour"), ("day_of_week", "by_weekday")):
        def _q(spark, sf_dir, _kind=_kind, _by=_by):
            return ap.zone_report(trips(spark, sf_dir), airport_zones(spark, sf_dir), _kind, _by, ZONES)
        register(f"{_prefix}_{_suffix}", SQL_IMPRESSIONS + f"""
SELECT airport, {_by}, count(*) AS trip_count FROM {_kind}s
GROUP BY airport, {_by} ORDER BY airport, {_by}""")(_q)


# --- OP-30 zero mode ------------------------------------------------------------
@register("zero_filled_report", SQL_IMPRESSIONS + """
SELECT airport, hour_of_day, count(source) AS trip_count FROM pickups
GROUP BY airport, hour_of_day""")
def q_zero_filled_report(spark, sf_dir):
    return ap.zone_report(trips(spark, sf_dir), airport_zones(spark, sf_dir), "pickup", "hour_of_day",
                          ZONES, unmatched="zero", ordered=False)


def _nameless_zones(spark, sf_dir):
    """The whole, unfiltered lookup with one zone's name missing (zone 7 has trips)."""
    z = fx.zone_lookup(spark, sf_dir)
    return z.withColumn("Zone", F.when(F.col("LocationID") != 7, F.col("Zone")))


SQL_ALL_ZONES = "WITH " + SQL_TRIPS + "," + SQL_ZONES + """,
named AS (SELECT LocationID, CASE WHEN LocationID <> 7 THEN Zone END AS Zone FROM zones),
tagged AS (
  SELECT 'pickup' AS kind, a.Zone AS airport, CAST(hour(t.pickup_datetime) AS INTEGER) AS hour_of_day,
         CAST(dayofweek(t.pickup_datetime) + 1 AS INTEGER) AS day_of_week
  FROM trips t RIGHT JOIN named a ON t.PULocationID = a.LocationID
  UNION ALL
  SELECT 'dropoff', a.Zone, CAST(hour(t.dropoff_datetime) AS INTEGER),
         CAST(dayofweek(t.dropoff_datetime) + 1 AS INTEGER)
  FROM trips t RIGHT JOIN named a ON t.DOLocationID = a.LocationID
)
SELECT kind, airport, hour_of_day, day_of_week, count(*) AS trip_count FROM tagged
GROUP BY kind, airport, hour_of_day, day_of_week"""

for _name, _small in (("airport_cube_all_zones", True), ("airport_cube_all_zones_shuffled", False)):
    def _q(spark, sf_dir, _small=_small):
        return ap.airport_cube(trips(spark, sf_dir), _nameless_zones(spark, sf_dir), ZONES, broadcast=_small)
    register(_name, SQL_ALL_ZONES)(_q)


# --- OP-46: cube and its roll-ups ---------------------------------------------
@register("airport_cube", SQL_IMPRESSIONS + """,
tagged AS (SELECT 'pickup' AS kind, * FROM pickups UNION ALL SELECT 'dropoff', * FROM dropoffs)
SELECT kind, airport, hour_of_day, day_of_week, count(*) AS trip_count FROM tagged
GROUP BY kind, airport, hour_of_day, day_of_week""")
def q_airport_cube(spark, sf_dir):
    return ap.airport_cube(trips(spark, sf_dir), airport_zones(spark, sf_dir), ZONES)


@register("airport_cube_trips_by_hour", SQL_IMPRESSIONS + """
SELECT airport, hour_of_day, count(*) AS trip_count FROM alls GROUP BY airport, hour_of_day""")
def q_airport_cube_trips_by_hour(spark, sf_dir):
    cube = ap.airport_cube(trips(spark, sf_dir), airport_zones(spark, sf_dir), ZONES)
    return ap.cube_report(cube, "all", "hour_of_day", ordered=False)


@register("airport_hour_wide", SQL_IMPRESSIONS + """,
rep AS (SELECT airport, hour_of_day, count(*) AS trip_count FROM alls GROUP BY airport, hour_of_day)
SELECT hour_of_day,
       max(CASE WHEN airport = 'NATION_3' THEN trip_count END) AS "NATION_3",
       max(CASE WHEN airport = 'NATION_7' THEN trip_count END) AS "NATION_7",
       max(CASE WHEN airport = 'NATION_22' THEN trip_count END) AS "NATION_22"
FROM rep GROUP BY hour_of_day""")
def q_airport_hour_wide(spark, sf_dir):
    from trip_engine.operators.frames import series_wide
    cube = ap.airport_cube(trips(spark, sf_dir), airport_zones(spark, sf_dir), ZONES)
    rep = ap.cube_report(cube, "all", "hour_of_day", ordered=False)
    return series_wide(rep, "hour_of_day", "airport", "trip_count", list(fx.FIXTURE_ZONES))


# --- OP-16, 19, 26, 47, 32, 23, 56, 57, 24: market share ----------------------
SQL_REQUESTS = """
req AS (
  SELECT event_id, user_id, ts AS request_datetime,
         CASE event_type WHEN 'click' THEN 'HV0003' WHEN 'view' THEN 'HV0005'
                         WHEN 'purchase' THEN 'HV0002' WHEN 'signup' THEN 'HV0004' END
           AS hvfhs_license_num
  FROM events
),
svc_all AS (
  SELECT event_id, request_datetime, CAST(request_datetime AS DATE) AS trip_date,
         CASE WHEN hvfhs_license_num = 'HV0003' THEN 'Uber'
              WHEN hvfhs_license_num = 'HV0005' THEN 'Lyft'
              ELSE hvfhs_license_num END AS service
  FROM req
),
svc AS (
  SELECT trip_date, service FROM svc_all
  WHERE request_datetime >= TIMESTAMP '2024-01-03 00:00:00'
    AND request_datetime < TIMESTAMP '2024-01-29 00:00:00'
),
share AS (
  SELECT trip_date, service, count(*) AS trip_count,
         CAST(sum(count(*)) OVER (PARTITION BY trip_date) AS BIGINT) AS total_trip_count
  FROM svc GROUP BY trip_date, service
),
share_pct AS (
  SELECT *, ((trip_count * 20000 + total_trip_count) // (2 * total_trip_count)) / 1e2
              AS trip_percentage
  FROM share
)"""


def _share(spark, sf_dir, form="window"):
    from trip_engine.operators.share import market_share
    return market_share(fx.ride_requests(spark, sf_dir), first=fx.SHARE_FIRST_DAY,
                        last=fx.SHARE_LAST_DAY, form=form)


def _day_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in cols})


@register("service_mapping", "WITH " + SQL_REQUESTS + """
SELECT event_id, service FROM svc_all""")
def q_service_mapping(spark, sf_dir):
    from trip_engine.functions.exprs import map_codes
    from trip_engine.specs import SERVICE_NAMES
    r = fx.ride_requests(spark, sf_dir)
    return r.select("event_id", map_codes("hvfhs_license_num", SERVICE_NAMES).alias("service"))


@register("day_range", "WITH " + SQL_REQUESTS + """
SELECT event_id, strftime(trip_date, '%Y-%m-%d') AS trip_date FROM svc_all
WHERE request_datetime >= TIMESTAMP '2024-01-03 00:00:00'
  AND request_datetime < TIMESTAMP '2024-01-29 00:00:00'""")
def q_day_range(spark, sf_dir):
    from trip_engine.functions.exprs import trip_day
    from trip_engine.operators.filters import between_days
    r = between_days(fx.ride_requests(spark, sf_dir), "request_datetime",
                     fx.SHARE_FIRST_DAY, fx.SHARE_LAST_DAY)
    return _day_text(r.select("event_id", trip_day("request_datetime").alias("trip_date")),
                     "trip_date")


_SHARE_SELECT = """
SELECT strftime(trip_date, '%Y-%m-%d') AS trip_date, service, trip_count, total_trip_count,
       trip_percentage FROM share_pct"""


@register("market_share", "WITH " + SQL_REQUESTS + _SHARE_SELECT)
def q_market_share(spark, sf_dir):
    return _day_text(_share(spark, sf_dir), "trip_date")


@register("market_share_join", "WITH " + SQL_REQUESTS + _SHARE_SELECT)
def q_market_share_join(spark, sf_dir):
    return _day_text(_share(spark, sf_dir, form="join"), "trip_date")


# Dense calendar: a range wider than the data (2024-01-01..30), so days at
# both ends have no requests and are zero-filled.
DENSE_FIRST, DENSE_LAST = "2023-12-29", "2024-02-02"
SQL_DENSE = """,
services AS (SELECT DISTINCT service FROM share_pct),
calendar AS (
  SELECT s.service, CAST(d AS DATE) AS trip_date
  FROM services s, generate_series(DATE '2023-12-29', DATE '2024-02-02', INTERVAL 1 DAY) g(d)
),
totals AS (SELECT trip_date, max(total_trip_count) AS day_total FROM share_pct GROUP BY trip_date),
dense AS (
  SELECT c.trip_date, c.service,
         coalesce(p.trip_count, 0) AS trip_count,
         coalesce(t.day_total, 0) AS total_trip_count,
         coalesce(p.trip_percentage, 0.0) AS trip_percentage
  FROM calendar c
  LEFT JOIN share_pct p ON p.trip_date = c.trip_date AND p.service IS NOT DISTINCT FROM c.service
  LEFT JOIN totals t ON t.trip_date = c.trip_date
)"""


def _dense(spark, sf_dir):
    from trip_engine.operators.share import densify_days, market_share
    share = market_share(fx.ride_requests(spark, sf_dir), first=DENSE_FIRST, last=DENSE_LAST)
    return densify_days(share, DENSE_FIRST, DENSE_LAST)


# The dense twin filters the same wider range, so its share CTE is rebuilt.
SQL_REQUESTS_DENSE = SQL_REQUESTS.replace("2024-01-03 00:00:00", "2023-12-29 00:00:00").replace(
    "2024-01-29 00:00:00", "2024-02-03 00:00:00")


@register("market_share_dense", "WITH " + SQL_REQUESTS_DENSE + SQL_DENSE + """
SELECT strftime(trip_date, '%Y-%m-%d') AS trip_date, service, trip_count, total_trip_count,
       trip_percentage FROM dense""")
def q_market_share_dense(spark, sf_dir):
    return _day_text(_dense(spark, sf_dir), "trip_date")


_NULL_DAYS = "(SELECT * REPLACE (CASE WHEN event_id % 17 <> 0 THEN ts END AS ts) FROM events)"


@register("market_share_dense_null_day", "WITH " + SQL_REQUESTS.replace("FROM events", "FROM " + _NULL_DAYS).replace(
    """  WHERE request_datetime >= TIMESTAMP '2024-01-03 00:00:00'
    AND request_datetime < TIMESTAMP '2024-01-29 00:00:00'
""", "") + SQL_DENSE + """
SELECT strftime(trip_date, '%Y-%m-%d') AS trip_date, service, trip_count, total_trip_count,
       trip_percentage FROM dense""")
def q_market_share_dense_null_day(spark, sf_dir):
    """OP-56 on a share without a day range whose requests partly have no time."""
    from trip_engine.operators.share import densify_days, market_share
    req = fx.ride_requests(spark, sf_dir).withColumn(
        "request_datetime", F.when(F.col("event_id") % 17 != 0, F.col("request_datetime")))
    return _day_text(densify_days(market_share(req), DENSE_FIRST, DENSE_LAST), "trip_date")


@register("market_share_wide", "WITH " + SQL_REQUESTS_DENSE + SQL_DENSE + """
SELECT strftime(trip_date, '%Y-%m-%d') AS trip_date,
       max(CASE WHEN service = 'Uber' THEN trip_percentage END) AS "Uber",
       max(CASE WHEN service = 'Lyft' THEN trip_percentage END) AS "Lyft",
       least(max(CASE WHEN service = 'Uber' THEN trip_percentage END)
             + max(CASE WHEN service = 'Lyft' THEN trip_percentage END), 1e2) AS stacked_total
FROM dense GROUP BY trip_date""")
def q_market_share_wide(spark, sf_dir):
    from trip_engine.operators.share import share_wide
    return _day_text(share_wide(_dense(spark, sf_dir)), "trip_date")


# --- OP-14, 15, 17, 20..22, 29, 48, 49, 70: features ---------------------------
SQL_DURATION_TRIPS = """
kt AS (
  SELECT 'id' || CAST(o_orderkey AS VARCHAR) AS id,
         CAST(1 + o_orderkey % 2 AS INTEGER) AS vendor_id,
         o_orderdate + to_minutes(CAST(o_custkey % 1440 AS INTEGER)) AS pickup_datetime,
         CAST(1 + o_custkey % 6 AS INTEGER) AS passenger_count,
         CASE WHEN o_orderkey % 50 <> 0 THEN 4.06e1 + (o_custkey % 100) / 4e2 END
           AS pickup_latitude,
         -7.405e1 + (o_orderkey % 97) / 4e2 AS pickup_longitude,
         4.06013e1 + (o_orderkey % 89) / 4e2 AS dropoff_latitude,
         -7.405e1 + (o_custkey % 83) / 4e2 AS dropoff_longitude,
         CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END AS store_and_fwd_flag,
         CAST(floor(1.2e2 + 1e4 * (abs((4.06013e1 + (o_orderkey % 89) / 4e2)
                                       - (4.06e1 + (o_custkey % 100) / 4e2))
                                  + abs((-7.405e1 + (o_custkey % 83) / 4e2)
                                       - (-7.405e1 + (o_orderkey % 97) / 4e2)))) AS INTEGER)
           AS trip_duration
  FROM orders
)"""


def _sql_guard() -> str:
    return " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in
                        ("pickup_latitude", "pickup_longitude", "dropoff_latitude",
                         "dropoff_longitude"))


def _sql_distance(radius: str, clamp: bool = True, scale: int | None = None,
                  method: str = "cosines") -> str:
    a1, o1, a2, o2 = "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"
    if method == "cosines":
        arg = (f"sin(radians({a1})) * sin(radians({a2})) + cos(radians({a1})) * cos(radians({a2}))"
               f" * cos(radians({o2}) - radians({o1}))")
        if clamp:
            arg = f"greatest(-1e0, least(1e0, {arg}))"
        d = f"acos({arg}) * {radius}"
    else:
        h = (f"pow(sin((radians({a2}) - radians({a1})) / 2), 2) + cos(radians({a1}))"
             f" * cos(radians({a2})) * pow(sin((radians({o2}) - radians({o1})) / 2), 2)")
        if clamp:
            h = f"least(1e0, {h})"
        d = f"2e0 * {radius} * asin(sqrt({h}))"
    if scale is not None:
        d = f"round({d}, {scale})"
    return f"CASE WHEN {_sql_guard()} THEN {d} END"


SQL_FEATURES = """,
base AS (
  SELECT *, """ + _sql_distance("6.371e3", True, 4) + """ AS distance,
         CAST(hour(pickup_datetime) AS INTEGER) AS hour,
         CAST(day(pickup_datetime) AS INTEGER) AS day,
         CAST(month(pickup_datetime) AS INTEGER) AS month,
         CASE WHEN store_and_fwd_flag = 'Y' THEN 1 WHEN store_and_fwd_flag = 'N' THEN 0 END
           AS flag_code
  FROM kt
),
mean AS (SELECT avg(distance) AS m FROM base WHERE distance IS NOT NULL AND NOT isnan(distance)),
feat AS (
  SELECT id, vendor_id, passenger_count, flag_code AS store_and_fwd_flag, day, hour, month,
         coalesce(CASE WHEN isnan(distance) THEN NULL ELSE distance END, (SELECT m FROM mean))
           AS distance, trip_duration
  FROM base
)"""


def _kt(spark, sf_dir, with_label=True, part=None):
    return fx.duration_trips(spark, sf_dir, with_label, part)


# The training part's mean fills both parts; every order is read.
SQL_PARTS = SQL_FEATURES + """,
parts AS (SELECT *, CASE WHEN CAST(substr(id, 3) AS BIGINT) % 10 < 8 THEN 'train' ELSE 'test' END
            AS part FROM base),
train_mean AS (SELECT avg(distance) AS m FROM parts
               WHERE part = 'train' AND distance IS NOT NULL AND NOT isnan(distance)),
filled AS (
  SELECT id, part, vendor_id, passenger_count, flag_code AS store_and_fwd_flag, day, hour, month,
         round(coalesce(CASE WHEN isnan(distance) THEN NULL ELSE distance END,
                        (SELECT m FROM train_mean)), 6) AS distance
  FROM parts
)"""


def _round6(df: DataFrame, *cols: str) -> DataFrame:
    """Test views only: compare 6 decimals, not the last bits of libm."""
    return df.withColumns({c: F.round(c, 6) for c in cols})


for _name, _radius, _unit, _clamp, _scale, _method, _rnd in (
        ("distance_km", "6.371e3", "km", True, 4, "cosines", False),
        ("distance_miles_clamped", "3.959e3", "mi", True, None, "cosines", True),
        ("distance_haversine", "6.371e3", "km", True, None, "haversine", True)):
    def _q(spark, sf_dir, _unit=_unit, _clamp=_clamp, _scale=_scale, _method=_method, _rnd=_rnd):
        from trip_engine.functions.exprs import great_circle
        out = _kt(spark, sf_dir).select("id", great_circle(
            "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude",
            unit=_unit, clamp=_clamp, scale=_scale, method=_method).alias("distance"))
        return _round6(out, "distance") if _rnd else out
    _d = _sql_distance(_radius, _clamp, _scale, _method)
    register(_name, "WITH " + SQL_DURATION_TRIPS + f"""
SELECT id, {f'round({_d}, 6)' if _rnd else _d} AS distance FROM kt""")(_q)


for _name, _unknown in (("flag_encode_null", None), ("flag_encode_one", 1)):
    def _q(spark, sf_dir, _unknown=_unknown):
        from trip_engine.functions.exprs import encode_flag
        return _kt(spark, sf_dir).select(
            "id", encode_flag("store_and_fwd_flag", _unknown).alias("store_and_fwd_flag"))
    _else = "NULL" if _unknown is None else str(_unknown)
    register(_name, "WITH " + SQL_DURATION_TRIPS + f"""
SELECT id, CAST(CASE WHEN store_and_fwd_flag = 'Y' THEN 1 WHEN store_and_fwd_flag = 'N' THEN 0
                     ELSE {_else} END AS INTEGER) AS store_and_fwd_flag FROM kt""")(_q)


@register("calendar_parts", "WITH " + SQL_DURATION_TRIPS + """
SELECT id, CAST(hour(pickup_datetime) AS INTEGER) AS hour,
       CAST(day(pickup_datetime) AS INTEGER) AS day,
       CAST(month(pickup_datetime) AS INTEGER) AS month FROM kt""")
def q_calendar_parts(spark, sf_dir):
    from trip_engine.functions.exprs import calendar_parts
    return _kt(spark, sf_dir).select("id", *[c.alias(n) for n, c in
                                             calendar_parts("pickup_datetime").items()])


@register("apply_schema", "WITH " + SQL_DURATION_TRIPS + """
SELECT id, vendor_id, passenger_count, trip_duration, pickup_latitude,
       CAST(NULL AS INTEGER) AS bad_number FROM kt""")
def q_apply_schema(spark, sf_dir):
    """Text columns (as a CSV read without inference gives them) typed again;
    one column of non-numbers shows the lenient (try_cast) mode."""
    from trip_engine.functions.exprs import apply_schema
    text = _kt(spark, sf_dir).select(
        "id", *[F.col(c).cast("string").alias(c) for c in
                ("vendor_id", "passenger_count", "trip_duration", "pickup_latitude")],
        F.col("store_and_fwd_flag").alias("bad_number"))
    return apply_schema(text, {"vendor_id": "int", "passenger_count": "int",
                               "trip_duration": "int", "pickup_latitude": "double",
                               "bad_number": "int"}, strict=False)


@register("drop_missing", "WITH " + SQL_DURATION_TRIPS + SQL_FEATURES + """
SELECT id, distance FROM base WHERE distance IS NOT NULL AND NOT isnan(distance)""")
def q_drop_missing(spark, sf_dir):
    from trip_engine.operators.features import base_features
    from trip_engine.operators.filters import drop_missing
    return drop_missing(base_features(_kt(spark, sf_dir)), ["distance"]).select("id", "distance")


@register("impute_mean", "WITH " + SQL_DURATION_TRIPS + SQL_FEATURES + """
SELECT id, round(distance, 6) AS distance FROM feat""")
def q_impute_mean(spark, sf_dir):
    from trip_engine.operators.features import base_features, impute_mean
    out = impute_mean(base_features(_kt(spark, sf_dir)), "distance")
    return _round6(out.select("id", "distance"), "distance")


@register("impute_mean_train", "WITH " + SQL_DURATION_TRIPS + SQL_PARTS + """
SELECT id, part, distance FROM filled""")
def q_impute_mean_train(spark, sf_dir):
    """Training and test trips, both filled with the training trips' mean."""
    from trip_engine.operators.features import base_features, impute_mean
    train = base_features(_kt(spark, sf_dir, part="train"))
    parts = [impute_mean(base_features(_kt(spark, sf_dir, False, part)), "distance", fit_on=train)
             .select("id", F.lit(part).alias("part"), "distance") for part in ("train", "test")]
    return _round6(parts[0].unionByName(parts[1]), "distance")


@register("train_features", "WITH " + SQL_DURATION_TRIPS + SQL_FEATURES + """
SELECT id, vendor_id, passenger_count, store_and_fwd_flag, day, hour, month,
       round(distance, 6) AS distance, trip_duration FROM feat""")
def q_train_features(spark, sf_dir):
    from trip_engine.operators.features import trip_features
    return _round6(trip_features(_kt(spark, sf_dir)), "distance")


@register("test_features", "WITH " + SQL_DURATION_TRIPS + SQL_PARTS + """
SELECT id, part, vendor_id, passenger_count, store_and_fwd_flag, day, hour, month, distance FROM filled""")
def q_test_features(spark, sf_dir):
    from trip_engine.operators.features import trip_features
    train = _kt(spark, sf_dir, part="train")
    parts = [trip_features(_kt(spark, sf_dir, False, part), mean_from=train).withColumn("part", F.lit(part))
             for part in ("train", "test")]
    return _round6(parts[0].unionByName(parts[1]), "distance")


# OP-22 on a deterministic stand-in prediction (order price / 7).
for _name, _shape, _sql in (("duration_trunc", "trunc", "CAST(trunc(o_totalprice / 7e0) AS INTEGER)"),
                            ("duration_round", "round", "round(o_totalprice / 7e0)"),
                            ("duration_raw", "raw", "o_totalprice / 7e0")):
    def _q(spark, sf_dir, _shape=_shape):
        from trip_engine.functions.exprs import shape_duration
        o = fx.table(spark, sf_dir, "orders")
        return o.select(F.concat(F.lit("id"), F.col("o_orderkey").cast("string")).alias("id"),
                        shape_duration(F.col("o_totalprice") / F.lit(7.0), _shape)
                        .alias("trip_duration"))
    register(_name, f"""
SELECT 'id' || CAST(o_orderkey AS VARCHAR) AS id, {_sql} AS trip_duration FROM orders""")(_q)


# --- OP-53, 54: row ids --------------------------------------------------------
@register("row_id_sparse_check", "WITH " + SQL_TRIPS + """
SELECT source, count(*) AS trip_count, count(*) AS distinct_ids FROM trips GROUP BY source""")
def q_row_id_sparse_check(spark, sf_dir):
    from trip_engine.operators.ids import add_row_id
    t = add_row_id(trips(spark, sf_dir), "sparse")
    return t.groupBy("source").agg(F.count(F.lit(1)).alias("trip_count"),
                                   F.countDistinct("id").alias("distinct_ids"))


@register("row_id_dense", """
SELECT count(*) AS row_count, CAST(1 AS BIGINT) AS min_id, count(*) AS max_id,
       count(*) AS distinct_ids FROM events""")
def q_row_id_dense(spark, sf_dir):
    from trip_engine.operators.ids import add_row_id
    ids = add_row_id(fx.table(spark, sf_dir, "events").select("event_id"), "dense", col="row_id")
    return ids.agg(F.count(F.lit(1)).alias("row_count"), F.min("row_id").alias("min_id"),
                   F.max("row_id").alias("max_id"), F.countDistinct("row_id").alias("distinct_ids"))


@register("key_ids_distinct", """
WITH k AS (SELECT event_type || '|' || CAST(user_id % 10 AS VARCHAR) AS x, CAST(event_id % 10 AS VARCHAR) AS y FROM events
           UNION ALL SELECT event_type, CAST(user_id % 10 AS VARCHAR) || '|' || CAST(event_id % 10 AS VARCHAR) FROM events)
SELECT x, y, md5(coalesce(CAST(strlen(x) AS VARCHAR) || ':' || x, '-')
                 || coalesce(CAST(strlen(y) AS VARCHAR) || ':' || y, '-')) AS id, count(*) AS n
FROM k GROUP BY x, y""")
def q_key_ids_distinct(spark, sf_dir):
    """OP-53: keys whose parts, put side by side, would read alike get ids of their own."""
    from trip_engine.operators.ids import add_row_id
    ev = fx.table(spark, sf_dir, "events")
    a, b, c = F.col("event_type"), (F.col("user_id") % 10).cast("string"), (F.col("event_id") % 10).cast("string")
    keys = ev.select(F.inline(F.array(F.struct(F.concat_ws("|", a, b).alias("x"), c.alias("y")),
                                      F.struct(a.alias("x"), F.concat_ws("|", b, c).alias("y")))))
    return add_row_id(keys, "key", ["x", "y"]).groupBy("x", "y", "id").agg(F.count(F.lit(1)).alias("n"))


@register("row_id_dense_hot_key", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE event_type || CAST(event_id AS VARCHAR) END AS k
           FROM events)
SELECT k, count(*) AS n, min(row_id) AS first_id, max(row_id) AS last_id, count(DISTINCT row_id) AS ids
FROM (SELECT k, row_number() OVER (ORDER BY k, event_id) AS row_id FROM e) GROUP BY k""")
def q_row_id_dense_hot_key(spark, sf_dir):
    """OP-54 with a third of the rows on one order key: its ids are one gapless run."""
    from trip_engine.operators.ids import add_row_id
    ev = fx.table(spark, sf_dir, "events")
    keyed = ev.select(F.when(F.col("event_id") % 3 == 0, F.lit("hot"))
                      .otherwise(F.concat("event_type", F.col("event_id").cast("string"))).alias("k"))
    return add_row_id(keyed, "dense", order_by=["k"], col="row_id").groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_id").alias("first_id"), F.max("row_id").alias("last_id"),
        F.countDistinct("row_id").alias("ids"))


@register("row_id_dense_ordered", """
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS row_id FROM events""")
def q_row_id_dense_ordered(spark, sf_dir):
    from trip_engine.operators.ids import add_row_id
    ev = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    return add_row_id(ev, "dense", order_by=["ts", "event_id"], col="row_id").select(
        "event_id", "row_id")


# --- OP-55, 58: sample, map layers, density -------------------------------------
# The original map draws 50,000 of 1.4 M trips; the fixture's orders table is
# smaller (1,500 rows at sf0.001), so the registered sample takes 1,000.
SAMPLE_N, SAMPLE_SEED = 1000, 42
_COORDS = "pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude"
SQL_SAMPLE = f""",
sample AS (SELECT id, {_COORDS} FROM kt ORDER BY md5('{SAMPLE_SEED}' || id), id LIMIT {SAMPLE_N})"""


def _sample(spark, sf_dir):
    from trip_engine.operators.frames import sample_exact
    kt = _kt(spark, sf_dir).select("id", *[c.strip() for c in _COORDS.split(",")])
    return sample_exact(kt, SAMPLE_N, SAMPLE_SEED, "id")


@register("sample_exact", "WITH " + SQL_DURATION_TRIPS + SQL_SAMPLE + " SELECT * FROM sample")
def q_sample_exact(spark, sf_dir):
    return _sample(spark, sf_dir)


@register("point_layer", "WITH " + SQL_DURATION_TRIPS + SQL_SAMPLE + """
SELECT 'pickups' AS layer, id, pickup_latitude AS latitude, pickup_longitude AS longitude
FROM sample
UNION ALL
SELECT 'dropoffs', id, dropoff_latitude, dropoff_longitude FROM sample""")
def q_point_layer(spark, sf_dir):
    from trip_engine.operators.frames import point_layers
    return point_layers(_sample(spark, sf_dir))


@register("grid_density", "WITH " + SQL_DURATION_TRIPS + """
SELECT CAST(floor(pickup_latitude / 1e-2) AS BIGINT) AS lat_cell,
       CAST(floor(pickup_longitude / 1e-2) AS BIGINT) AS lon_cell, count(*) AS trip_count
FROM kt WHERE pickup_latitude IS NOT NULL AND NOT isnan(pickup_latitude)
          AND pickup_longitude IS NOT NULL AND NOT isnan(pickup_longitude)
GROUP BY 1, 2""")
def q_grid_density(spark, sf_dir):
    from trip_engine.operators.frames import grid_density
    return grid_density(_kt(spark, sf_dir), "pickup_latitude", "pickup_longitude", 1e-2)


# --- OP-60..63: quality --------------------------------------------------------
@register("check_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_check_unique(spark, sf_dir):
    from trip_engine.operators.quality import check_unique
    return check_unique(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _sql_contract(table: str, source: str, contract) -> str:
    parts = []
    for key, test in contract:
        cols = [key] if isinstance(key, str) else list(key)
        name = ",".join(cols)
        if test == "not_null":
            fail = f"(SELECT count(*) FROM {source} WHERE {cols[0]} IS NULL)"
        else:
            k = ", ".join(cols)
            nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
            fail = (f"(SELECT count(*) FROM (SELECT {k} FROM {source} WHERE {nn} "
                    f"GROUP BY {k} HAVING count(*) > 1))")
        parts.append(f"SELECT '{table}' AS table_name, '{name}' AS column_name, "
                     f"'{test}' AS test, {fail} AS failures")
    return "SELECT *, failures = 0 AS passed FROM (" + "\nUNION ALL ".join(parts) + ")"


@register("check_unique_composite", SQL_IMPRESSIONS + """,
report AS (SELECT airport, hour_of_day, count(*) AS trip_count FROM pickups
           GROUP BY airport, hour_of_day)
""" + _sql_contract("pickups_by_hour", "report", qa.REPORT_BY_HOUR_CONTRACT))
def q_check_unique_composite(spark, sf_dir):
    cube = ap.airport_cube(trips(spark, sf_dir), airport_zones(spark, sf_dir), ZONES)
    report = ap.cube_report(cube, "pickup", "hour_of_day", ordered=False)
    return qa.run_contract(report, qa.REPORT_BY_HOUR_CONTRACT, "pickups_by_hour")


@register("check_not_null", "WITH " + SQL_DURATION_TRIPS + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM kt"
    for c in ("id", "vendor_id", "pickup_datetime", "passenger_count", "pickup_latitude",
              "pickup_longitude", "dropoff_latitude", "dropoff_longitude",
              "store_and_fwd_flag", "trip_duration")))
def q_check_not_null(spark, sf_dir):
    from trip_engine.operators.quality import check_not_null
    return check_not_null(_kt(spark, sf_dir))


_SQL_TEST_IDS = "(SELECT 'id' || CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey % 10 >= 8)"
_SQL_KT_IDS = "(SELECT 'id' || CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey % 10 < 8)"


@register("run_contract", "WITH " + SQL_TRIPS + "," + SQL_ZONES + " "
          + _sql_contract("trips", "trips", qa.TRIPS_CONTRACT) + " UNION ALL "
          + _sql_contract("zone_lookup", "zones", qa.ZONE_LOOKUP_CONTRACT)
          + " UNION ALL " + _sql_contract("training_trips", _SQL_KT_IDS, qa.DURATION_TRIPS_CONTRACT)
          + " UNION ALL " + _sql_contract("testing_trips", _SQL_TEST_IDS, qa.DURATION_TRIPS_CONTRACT))
def q_run_contract(spark, sf_dir):
    found = [qa.run_contract(trips(spark, sf_dir), qa.TRIPS_CONTRACT, "trips"),
             qa.run_contract(fx.zone_lookup(spark, sf_dir), qa.ZONE_LOOKUP_CONTRACT, "zone_lookup")]
    found += [qa.run_contract(_kt(spark, sf_dir, part=p).select("id"), qa.DURATION_TRIPS_CONTRACT, f"{p}ing_trips")
              for p in ("train", "test")]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _sql_key_id(*texts: str) -> str:
    """Twin of ``ids.key_id``: each part led by its number of bytes."""
    return "md5(" + " || ".join(f"coalesce(CAST(strlen({t}) AS VARCHAR) || ':' || {t}, '-')" for t in texts) + ")"


# Line items with a time to the microsecond: many fall into one millisecond.
_MICRO_CONTRACT = (("stamp", "unique"), (("stamp", "l_orderkey"), "unique"),
                   (("stamp", "l_orderkey", "l_linenumber"), "unique"), ("stamp", "not_null"))


@register("run_contract_micros", """
WITH stamped AS (SELECT l_shipdate + to_microseconds(CAST(l_orderkey % 5000 * 7 + l_linenumber AS BIGINT)) AS stamp,
                        l_orderkey, l_linenumber FROM lineitem)
""" + _sql_contract("stamped", "stamped", _MICRO_CONTRACT))
def q_run_contract_micros(spark, sf_dir):
    """OP-62: keys that differ by a microsecond are different keys."""
    li = fx.table(spark, sf_dir, "lineitem")
    micros = (F.col("l_orderkey") % 5000 * 7 + F.col("l_linenumber")).cast("decimal(18,0)")
    seconds = (micros / F.lit(1_000_000)).cast("decimal(18,6)")
    stamped = li.select((F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("stamp"),
                        "l_orderkey", "l_linenumber")
    return qa.run_contract(stamped, _MICRO_CONTRACT, "stamped")


@register("airport_trips_contract", SQL_IMPRESSIONS + """,
ids AS (SELECT row_number() OVER () AS rid, * FROM alls)
SELECT 'airport_trips' AS table_name, c AS column_name, test, failures, failures = 0 AS passed FROM (
  SELECT 'id' AS c, 'not_null' AS test, count(*) FILTER (WHERE source IS NULL) AS failures FROM ids
  UNION ALL SELECT 'impression_datetime', 'not_null', count(*) FILTER (WHERE impression_datetime IS NULL) FROM ids
  UNION ALL SELECT 'source', 'not_null', count(*) FILTER (WHERE source IS NULL) FROM ids
  UNION ALL SELECT 'airport', 'not_null', count(*) FILTER (WHERE airport IS NULL) FROM ids
  UNION ALL SELECT 'id', 'unique', (SELECT count(*) FROM (
    SELECT t.k FROM (SELECT pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, source,
        """ + _sql_key_id("strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S')",
                          "strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S')", "CAST(PULocationID AS VARCHAR)",
                          "CAST(DOLocationID AS VARCHAR)", "source") + """ AS k FROM trips) t
    JOIN (SELECT LocationID AS l, 1 AS pu FROM airports UNION ALL SELECT LocationID, 0 FROM airports) a
      ON (a.pu = 1 AND t.PULocationID = a.l) OR (a.pu = 0 AND t.DOLocationID = a.l)
    GROUP BY t.k HAVING count(*) > 1))
)""")
def q_airport_trips_contract(spark, sf_dir):
    """The contract of the impressions; a trip between two airports shows its id twice."""
    from trip_engine.operators.ids import add_row_id
    t = add_row_id(trips(spark, sf_dir), "key", ["pickup_datetime", "dropoff_datetime", "PULocationID",
                                                 "DOLocationID", "source"])
    imp = ap.zone_impressions(t, airport_zones(spark, sf_dir), "all", ZONES)
    return qa.run_contract(imp, qa.AIRPORT_TRIPS_CONTRACT, "airport_trips")


# --- OP-28: request validation ---------------------------------------------------
_REQ_KEYS = ("id", "vendor_id", "passenger_count", "store_and_fwd_flag", "day", "hour",
             "month", "distance")
@register("validate_requests", "WITH " + SQL_DURATION_TRIPS + SQL_FEATURES + """,
reqs AS (
  SELECT id,
         CASE WHEN CAST(substr(id, 3) AS BIGINT) % 11 <> 0 THEN vendor_id END AS vendor_id,
         passenger_count, coalesce(store_and_fwd_flag, 1) AS store_and_fwd_flag,
         hour, day, month,
         CASE WHEN CAST(substr(id, 3) AS BIGINT) % 7 <> 0 THEN distance END AS distance
  FROM feat
),
why AS (
  SELECT id, concat_ws('; ', """ + ", ".join(
    f"CASE WHEN {k} IS NULL THEN 'Missing feature or id: {k}' END" for k in _REQ_KEYS) + """)
    AS reasons
  FROM reqs
)
SELECT id, CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS status,
       NULLIF(reasons, '') AS reject_reason FROM why""")
def q_validate_requests(spark, sf_dir):
    from trip_engine.streaming.scoring import tag_requests
    return _status(tag_requests(fx.scoring_requests(spark, sf_dir)))


def _status(tagged: DataFrame) -> DataFrame:
    return tagged.select("id", F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
                         .alias("status"), "reject_reason")


SQL_REQUESTS_WHY = ORACLE["validate_requests"].split("SELECT id, CASE WHEN reasons")[0]


def broken_requests(spark, sf_dir) -> DataFrame:
    """The scoring requests as JSON text, every 13th order's record garbled and
    every 17th order's vendor no number."""
    reqs = fx.scoring_requests(spark, sf_dir)
    key = F.substring("id", 3, 40).cast("long")
    text = F.to_json(F.struct(*reqs.columns))
    odd = F.to_json(F.struct("id", F.lit("abc").alias("vendor_id"), *[c for c in reqs.columns
                                                                     if c not in ("id", "vendor_id")]))
    return reqs.select(F.when(key % 13 == 0, F.concat(F.lit("not json at all "), "id"))
                       .when(key % 17 == 0, odd).otherwise(text).alias("value"))


@register("dead_letter", SQL_REQUESTS_WHY + """,
k AS (SELECT *, CAST(substr(id, 3) AS BIGINT) AS key FROM why)
SELECT CASE WHEN key % 13 <> 0 THEN id END AS id,
       CASE WHEN key % 13 = 0 OR key % 17 = 0 OR reasons <> '' THEN 'rejected' ELSE 'accepted' END AS status,
       CASE WHEN key % 13 = 0 THEN 'Malformed record'
            WHEN key % 17 = 0 THEN concat_ws('; ', 'Wrong type: vendor_id', NULLIF(replace(replace(
              reasons, 'Missing feature or id: vendor_id; ', ''), 'Missing feature or id: vendor_id', ''), ''))
            ELSE NULLIF(reasons, '') END AS reject_reason,
       CASE WHEN key % 13 = 0 THEN 'not json at all ' || id END AS malformed_text
FROM k""")
def q_dead_letter(spark, sf_dir):
    """OP-06 + OP-28: records that do not parse keep their text, and malformed, wrong
    and missing are told apart; accepted and rejected make up the input."""
    from trip_engine.sources.requests import MALFORMED, RAW, parse_requests
    from trip_engine.streaming.scoring import tag_requests
    tagged = tag_requests(parse_requests(broken_requests(spark, sf_dir)))
    return tagged.select("id", F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
                         .alias("status"), "reject_reason", F.when(F.col(MALFORMED), F.col(RAW)).alias("malformed_text"))


# --- OP-33, 71..75: model --------------------------------------
_MODELS: dict[tuple[str, str], object] = {}


def duration_model(spark: SparkSession, sf_dir: str):
    """Pipeline fitted on the training part (cached per session and input)."""
    from trip_engine.operators.features import trip_features
    from trip_engine.operators.model import train_duration_model
    from trip_engine.specs import FeatureConfig
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        train = trip_features(_kt(spark, sf_dir, part="train"), FeatureConfig(impute=False))
        _MODELS[key] = train_duration_model(train)
    return _MODELS[key]


@register("score_batch", "WITH " + SQL_DURATION_TRIPS + """
SELECT count(*) FILTER (WHERE CAST(substr(id, 3) AS BIGINT) % 10 < 8) AS training_rows,
       count(*) FILTER (WHERE CAST(substr(id, 3) AS BIGINT) % 10 >= 8) AS scored_rows,
       count(*) FILTER (WHERE CAST(substr(id, 3) AS BIGINT) % 10 >= 8) AS scored_ids,
       CAST(0 AS BIGINT) AS without_prediction, true AS better_than_mean
FROM kt""")
def q_score_batch(spark, sf_dir):
    """OP-33, 71..73: a model fitted on the training part scores the test part: every
    row once, none without a prediction, and with a smaller error than the
    training mean has."""
    from trip_engine.operators.features import trip_features
    from trip_engine.operators.model import predict_durations
    from trip_engine.specs import FeatureConfig
    train, truth = (_kt(spark, sf_dir, part=p) for p in ("train", "test"))
    test = trip_features(truth.drop("trip_duration"), FeatureConfig(impute=False))
    preds = predict_durations(duration_model(spark, sf_dir), test, shape="round")
    both = preds.withColumnRenamed("trip_duration", "p").join(truth.select("id", "trip_duration"), "id", "left")
    base = train.agg(F.count(F.lit(1)).alias("training_rows"), F.avg("trip_duration").alias("mean"))
    error = F.sum(F.pow(F.col("p") - F.col("trip_duration"), 2))
    # sum of (t - mean)^2 from sums, so that the mean need not be known in the pass
    t = F.col("trip_duration").cast("double")
    sums = both.agg(F.count(F.lit(1)).alias("scored_rows"), F.countDistinct("id").alias("scored_ids"),
                    F.count_if(F.col("p").isNull()).alias("without_prediction"), error.alias("e"),
                    F.sum(t).alias("t1"), F.sum(t * t).alias("t2"))
    spread = F.col("t2") - 2 * F.col("mean") * F.col("t1") + F.col("scored_rows") * F.col("mean") * F.col("mean")
    return sums.join(F.broadcast(base)).select(  # two rows of sums
        "training_rows", "scored_rows", "scored_ids", "without_prediction", (F.col("e") < spread).alias("better_than_mean"))


@register("score_stream", SQL_REQUESTS_WHY + """
SELECT id, CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS status,
       NULLIF(reasons, '') AS reject_reason, reasons = '' AS scored FROM why""")
def q_score_stream(spark, sf_dir):
    """OP-06 + OP-28 + OP-74: requests written as JSON lines, scored by a
    file-stream query (availableNow), predictions and rejects read back."""
    import os
    from trip_engine.session import scratch_path
    from trip_engine.sources.requests import read_requests
    from trip_engine.streaming.scoring import read_scored, score_stream
    base = scratch_path(spark, "score-stream")
    inbox = os.path.join(base, "requests")
    fx.scoring_requests(spark, sf_dir).write.mode("overwrite").json(inbox)
    model = duration_model(spark, sf_dir)
    q = score_stream(read_requests(spark, inbox, streaming=True), model,
                     os.path.join(base, "predictions"), os.path.join(base, "rejects"),
                     os.path.join(base, "checkpoint"), available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"scoring stream failed: {q.exception()}")
    return read_scored(spark, os.path.join(base, "predictions"), os.path.join(base, "rejects")).select(
        "id", "status", "reject_reason", F.col("predicted_trip_duration").isNotNull().alias("scored"))


# --- OP-01..04: files, through the session's shared scratch folder ----------------
def _round_trip(df: DataFrame, name: str, fmt: str) -> str:
    from trip_engine.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.format(fmt).option("header", True).save(path)
    return path


@register("parquet_trips", ORACLE["conform_sources"])
def q_parquet_trips(spark, sf_dir):
    """OP-01: each source written in its own layout, read back and conformed."""
    from trip_engine.sources.files import read_trips
    parts = [read_trips(spark, _round_trip(fx.raw_trips(spark, sf_dir, s), f"trips-{s.label}", "parquet"), s)
             for s in (RIDE_HAILING, GREEN, YELLOW)]
    return _ts_text(consolidate(*parts), "pickup_datetime", "dropoff_datetime")


@register("csv_trips", "WITH " + SQL_DURATION_TRIPS + """
SELECT id, vendor_id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
       CAST(NULL AS VARCHAR) AS dropoff_datetime, passenger_count, round(pickup_longitude, 6) AS pickup_longitude,
       round(pickup_latitude, 6) AS pickup_latitude, store_and_fwd_flag, trip_duration FROM kt""")
def q_csv_trips(spark, sf_dir):
    """OP-02: duration trips through CSV, bound by header name to the declared
    layout (the file has no dropoff time, and its columns are in another order)."""
    from trip_engine.plans.trip_duration import TRAIN_SCHEMA
    from trip_engine.sources.files import read_csv
    kt = _kt(spark, sf_dir)
    path = _round_trip(_ts_text(kt, "pickup_datetime").select(*reversed(kt.columns)), "trips-csv", "csv")
    out = read_csv(spark, path, TRAIN_SCHEMA).select(
        "id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "pickup_longitude",
        "pickup_latitude", "store_and_fwd_flag", "trip_duration")
    return _round6(_ts_text(out, "pickup_datetime", "dropoff_datetime"), "pickup_longitude", "pickup_latitude")


@register("zone_lookup_csv", "WITH " + SQL_ZONES + " SELECT LocationID, Borough, Zone, service_zone FROM zones")
def q_zone_lookup_csv(spark, sf_dir):
    """OP-03: the zone lookup through CSV, its columns in another order."""
    from trip_engine.sources.files import read_zone_lookup
    z = fx.zone_lookup(spark, sf_dir).select("Zone", "LocationID", "service_zone", "Borough")
    return read_zone_lookup(spark, _round_trip(z, "zones-csv", "csv"))


@register("external_table", "SELECT event_id, user_id, event_type FROM events")
def q_external_table(spark, sf_dir):
    """OP-04: files under a table name, read by SQL."""
    from trip_engine.sources.files import register_external
    path = _round_trip(fx.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"),
                       "events-external", "parquet")
    name = f"trip_events_{path.rsplit('-', 1)[1]}"
    register_external(spark, name, path)
    return spark.sql(f"SELECT event_id, user_id, event_type FROM {name}")


# --- OP-75, 80..82, 90, 92, 94: sinks and jobs, through the same scratch folder ----
@register("report_csv", "WITH " + SQL_REQUESTS + _SHARE_SELECT)
def q_report_csv(spark, sf_dir):
    """OP-80: the share written as an ordered CSV report and read back."""
    from trip_engine.operators.sinks import write_report
    from trip_engine.session import scratch_path
    from trip_engine.sources.files import read_csv
    path = scratch_path(spark, "share-report")
    write_report(_day_text(_share(spark, sf_dir), "trip_date"), path, ["trip_date", "service"])
    return read_csv(spark, path, "trip_date string, service string, trip_count long, total_trip_count long, "
                                 "trip_percentage double")


@register("predictions_csv", ORACLE["duration_round"])
def q_predictions_csv(spark, sf_dir):
    """OP-81: row-level predictions through CSV, in parallel files."""
    from trip_engine.operators.sinks import write_predictions
    from trip_engine.session import scratch_path
    from trip_engine.sources.files import read_csv
    path = scratch_path(spark, "predictions")
    write_predictions(QUERIES["duration_round"](spark, sf_dir), path)
    return read_csv(spark, path, "id string, trip_duration double")


@register("airport_views", ORACLE["airport_trips_by_hour"])
def q_airport_views(spark, sf_dir):
    """OP-82: the SQL models' names answer to ``spark.sql``."""
    from trip_engine.plans.sql_models import register_airport_views
    register_airport_views(trips(spark, sf_dir), fx.zone_lookup(spark, sf_dir), ZONES)
    return spark.sql("SELECT airport, hour_of_day, trip_count FROM aggregated_trip_insights_by_hod")


@register("saved_model", "WITH " + SQL_DURATION_TRIPS + """
SELECT count(*) AS scored_rows, CAST(0 AS BIGINT) AS different FROM kt""")
def q_saved_model(spark, sf_dir):
    """OP-75: the saved and loaded pipeline scores as the fitted one does."""
    from trip_engine.operators.features import trip_features
    from trip_engine.operators.model import load_model, predict_durations, save_model
    from trip_engine.session import scratch_path
    from trip_engine.specs import FeatureConfig
    path = scratch_path(spark, "model")
    save_model(duration_model(spark, sf_dir), path)
    rows = trip_features(_kt(spark, sf_dir), FeatureConfig(impute=False))
    fitted = predict_durations(duration_model(spark, sf_dir), rows, "raw")
    loaded = predict_durations(load_model(path), rows, "raw").select("id", F.col("trip_duration").alias("again"))
    return fitted.join(loaded, "id").agg(
        F.count(F.lit(1)).alias("scored_rows"),
        F.count_if(~F.col("trip_duration").eqNullSafe(F.col("again"))).alias("different"))


@register("airport_job", SQL_IMPRESSIONS + "\nUNION ALL ".join(
    f"SELECT '{_name}' AS report, airport, {_by} AS bucket, count(*) AS trip_count FROM {_kind}s GROUP BY airport, {_by}"
    for _kind, _name in (("pickup", "pickups"), ("dropoff", "dropoffs"), ("all", "trips"))
    for _by, _name in ((f"hour_of_day", f"{_name}_by_hour"), ("day_of_week", f"{_name}_by_weekday"))))
def q_airport_job(spark, sf_dir):
    """OP-90: three Parquet sources and the lookup CSV to six report CSVs, read back."""
    import os
    from trip_engine.plans.airport_insights import REPORT_PATHS
    from trip_engine.plans.airport_insights import run as run_job
    from trip_engine.session import scratch_path
    from trip_engine.sources.files import read_csv
    paths = [_round_trip(fx.raw_trips(spark, sf_dir, s), f"job-{s.label}", "parquet")
             for s in (RIDE_HAILING, GREEN, YELLOW)]
    out = scratch_path(spark, "airport-job")
    run_job(spark, *paths, _round_trip(fx.zone_lookup(spark, sf_dir), "job-zones", "csv"), out, ZONES)
    reports = None
    for name, (folder, (_, by)) in REPORT_PATHS.items():
        one = read_csv(spark, os.path.join(out, folder), f"airport string, {by} int, trip_count long").select(
            F.lit(name).alias("report"), "airport", F.col(by).alias("bucket"), "trip_count")
        reports = one if reports is None else reports.unionByName(one)
    return reports


@register("market_share_job", ORACLE["market_share_dense"])
def q_market_share_job(spark, sf_dir):
    """OP-92: requests from Parquet to the dense series as CSV, read back."""
    import os
    from trip_engine.plans.market_share import run as run_job
    from trip_engine.session import scratch_path
    from trip_engine.sources.files import read_csv
    out = scratch_path(spark, "share-job")
    run_job(spark, _round_trip(fx.ride_requests(spark, sf_dir), "job-requests", "parquet"), out,
            DENSE_FIRST, DENSE_LAST)
    return read_csv(spark, os.path.join(out, "dense"), "trip_date string, service string, trip_count long, "
                    "total_trip_count long, trip_percentage double")


@register("map_job", "WITH " + SQL_DURATION_TRIPS + """
SELECT CAST(floor(pickup_latitude / 1e-2) AS BIGINT) AS lat_cell,
       CAST(floor(pickup_longitude / 1e-2) AS BIGINT) AS lon_cell, count(*) AS trip_count
FROM kt WHERE pickup_latitude IS NOT NULL GROUP BY 1, 2""")
def q_map_job(spark, sf_dir):
    """OP-94: trips from CSV to point layers and density grids; the pickup grid read back."""
    import os
    return spark.read.parquet(os.path.join(_run_map_job(spark, sf_dir), "pickup_density"))


def _run_map_job(spark, sf_dir) -> str:
    from trip_engine.plans.map_layers import run as run_job
    from trip_engine.session import scratch_path
    out = scratch_path(spark, "map-job")
    run_job(spark, _round_trip(_kt(spark, sf_dir), "job-trips", "csv"), out, n=SAMPLE_N)
    return out


@register("map_job_outputs", "WITH " + SQL_DURATION_TRIPS + SQL_SAMPLE + """,
ends AS (SELECT 'pickup_density' AS output, pickup_latitude AS lat, pickup_longitude AS lon FROM kt
         UNION ALL SELECT 'dropoff_density', dropoff_latitude, dropoff_longitude FROM kt)
SELECT output, CAST(CAST(floor(lat / 1e-2) AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(floor(lon / 1e-2) AS BIGINT) AS VARCHAR)
         AS place, count(*) AS n
FROM ends WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT 'points pickups', id, 1 FROM sample
UNION ALL SELECT 'points dropoffs', id, 1 FROM sample""")
def q_map_job_outputs(spark, sf_dir):
    """OP-94: all three outputs of the map job read back: both grids and the sampled points."""
    import os
    out = _run_map_job(spark, sf_dir)
    points = spark.read.parquet(os.path.join(out, "points")).select(
        F.concat(F.lit("points "), "layer").alias("output"), F.col("id").alias("place"), F.lit(1).cast("long").alias("n"))
    for name in ("pickup_density", "dropoff_density"):
        grid = spark.read.parquet(os.path.join(out, name))
        points = points.unionByName(grid.select(
            F.lit(name).alias("output"), F.concat_ws(",", "lat_cell", "lon_cell").alias("place"),
            F.col("trip_count").alias("n")))
    return points


# --- OP-76, 82..84, 91, 93: what the catalog keeps, read back and removed -----------
def _unique(name: str) -> str:
    import uuid
    return f"{name}_{uuid.uuid4().hex[:12]}"


@register("lasting_views", SQL_IMPRESSIONS + """
SELECT 'trips' AS view, source AS name, NULL::INTEGER AS bucket, count(*) AS n FROM trips GROUP BY source
""" + "".join(f"UNION ALL SELECT 'airport_{k}s', airport, hour_of_day, count(*) FROM {t} GROUP BY airport, hour_of_day\n"
              for k, t in (("pickup", "pickups"), ("dropoff", "dropoffs"), ("trip", "alls")))
          + "".join(f"UNION ALL SELECT 'aggregated_{k}_insights_by_{x}', airport, {by}, count(*) FROM {t} "
                    f"GROUP BY airport, {by}\n"
                    for k, t in (("pickup", "pickups"), ("dropoff", "dropoffs"), ("trip", "alls"))
                    for x, by in (("hod", "hour_of_day"), ("dow", "day_of_week"))))
def q_lasting_views(spark, sf_dir):
    """OP-82: the ten views of the SQL chain, made over catalog tables in this session and
    read in another session of the same catalog; views and tables go afterwards."""
    from trip_engine.plans.sql_models import AIRPORT_VIEWS, create_airport_views
    from trip_engine.session import write_scratch
    from trip_engine.sources.files import register_external
    tables = {_unique(f"raw_{s.label}"): s for s in (RIDE_HAILING, GREEN, YELLOW)}
    lookup, prefix = _unique("raw_zones"), _unique("v") + "_"
    made = []
    try:
        for name, source in tables.items():
            register_external(spark, name, _round_trip(fx.raw_trips(spark, sf_dir, source), "views-trips", "parquet"))
        register_external(spark, lookup, _round_trip(fx.zone_lookup(spark, sf_dir), "views-zones", "parquet"))
        made = create_airport_views(spark, tables, lookup, ZONES, prefix)
        other = spark.newSession()
        found = None
        for view in AIRPORT_VIEWS:
            rows = other.table(prefix + view)
            if view.startswith("aggregated"):
                airport, by, n = rows.columns
                part = rows.select(F.col(airport).alias("name"), F.col(by).alias("bucket"), F.col(n).alias("n"))
            else:
                keys = ("source", F.lit(None).cast("int")) if view == "trips" else ("airport", F.col("hour_of_day"))
                part = rows.groupBy(F.col(keys[0]).alias("name"), keys[1].alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
            part = part.select(F.lit(view).alias("view"), "name", "bucket", "n")
            found = part if found is None else found.unionByName(part)
        return write_scratch(found, "views")
    finally:
        for view in reversed(made):
            spark.sql(f"DROP VIEW IF EXISTS {view}")
        for name in (*tables, lookup):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@register("published_table", "WITH " + SQL_REQUESTS + """,
n AS (SELECT count(*) AS n, sum(trip_count)::BIGINT AS total FROM share)
SELECT c.column_name, c.column_comment, 'daily share' AS table_comment, 'daily' AS label, n.n AS row_count, n.total
FROM n, (VALUES ('trip_date', 'day of the request'), ('service', ''), ('trip_count', 'trips that day'),
                ('total_trip_count', ''), ('trip_percentage', '')) c(column_name, column_comment)""")
def q_published_table(spark, sf_dir):
    """OP-83, 84: a table published, refreshed, and refreshed once more with a comment for a
    column it does not have: rows of the second, comments and label from the catalog; the table
    goes afterwards."""
    from trip_engine.operators.sinks import publish_table
    from trip_engine.session import write_scratch
    name = _unique("daily_share")
    notes = {"trip_date": "day of the request", "trip_count": "trips that day"}

    def publish(rows: DataFrame, **more: str) -> None:
        publish_table(rows, name, comment="daily share", column_comments={**notes, **more}, labels={"interval": "daily"})

    share = _share(spark, sf_dir)
    try:
        publish(share.where("service = 'Uber'"))
        publish(share)
        try:
            publish(share.where("service = 'Lyft'"), no_such_column="refused")
            raise AssertionError("a comment for an unknown column was accepted")
        except ValueError:
            pass
        about = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
        detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        label = spark.sql(f"SHOW TBLPROPERTIES {name} ('label.interval')").first()["value"]
        columns = spark.createDataFrame([(c, t or "", detail.get("Comment", ""), label) for c, t in about.items()],
                                        "column_name string, column_comment string, table_comment string, label string")
        rows, total = spark.table(name).agg(F.count(F.lit(1)), F.sum("trip_count")).first()
        return write_scratch(columns.withColumns({"row_count": F.lit(rows), "total": F.lit(total)}), "published")
    finally:
        for row in spark.sql(f"SHOW TABLES LIKE '{name}*'").collect():
            spark.sql(f"DROP TABLE IF EXISTS {row.tableName}")


@register("training_job", "WITH " + SQL_DURATION_TRIPS + """,
t AS (SELECT ('0x' || substr(md5(id), 1, 8))::BIGINT % 5 = 0 AS held FROM kt WHERE CAST(substr(id, 3) AS BIGINT) % 10 < 8)
SELECT (SELECT count(*) FROM kt WHERE CAST(substr(id, 3) AS BIGINT) % 10 >= 8) AS predictions,
       count(*) FILTER (WHERE NOT held) AS training_rows, count(*) FILTER (WHERE held) AS held_out_rows,
       'trip_duration_model' AS model_name, 'trip_duration' AS label, true AS better_than_mean, true AS fits_its_rows,
       CAST(0 AS BIGINT) AS unreadable_values
FROM t""")
def q_training_job(spark, sf_dir):
    """OP-76, 91: training and testing CSV to predictions, model and audit row: the rows of
    both folds, and errors below the spread of the durations."""
    import os
    from trip_engine.plans.trip_duration import TEST_SCHEMA, TRAIN_SCHEMA
    from trip_engine.plans.trip_duration import run as run_job
    from trip_engine.session import scratch_path, write_scratch
    from trip_engine.sources.files import read_csv

    def csv(part, schema):
        rows = _kt(spark, sf_dir, "trip_duration" in schema.fieldNames(), part)
        return _round_trip(_ts_text(rows, "pickup_datetime"), f"job-{part}", "csv")

    train, test = csv("train", TRAIN_SCHEMA), csv("test", TEST_SCHEMA)
    out, table = scratch_path(spark, "training-job"), _unique("models_audit")
    try:
        run_job(spark, train, test, out, audit_table=table)
        # single numbers beside the audit row
        predicted = read_csv(spark, os.path.join(out, "predictions"), "id string, trip_duration double") \
            .agg(F.countDistinct("id")).first()[0]
        spread = read_csv(spark, train, TRAIN_SCHEMA).agg(F.stddev("trip_duration")).first()[0]
        lost = read_csv(spark, os.path.join(out, "unreadable"), "column_name string, unreadable long") \
            .agg(F.sum("unreadable")).first()[0]
        return write_scratch(spark.table(table).select(
            F.lit(predicted).alias("predictions"), "training_rows", "held_out_rows", "model_name", "label",
            (F.col("held_out_rmse") < 0.6 * spread).alias("better_than_mean"),
            (F.col("training_rmse") < 0.6 * spread).alias("fits_its_rows"),
            F.lit(lost).alias("unreadable_values")), "audit")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@register("scoring_job", SQL_REQUESTS_WHY + """
SELECT CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS status, NULLIF(reasons, '') AS reject_reason,
       count(*) AS n, count(DISTINCT id) AS ids, (SELECT count(*) FROM why) AS committed
FROM why GROUP BY 1, 2""")
def q_scoring_job(spark, sf_dir):
    """OP-93: the job on a saved model and a folder of JSON requests, run twice on the same
    checkpoint: both outputs, and the requests that the commit records name."""
    import os
    from trip_engine.operators.model import save_model
    from trip_engine.plans.score_requests import run as run_job
    from trip_engine.session import scratch_path
    from trip_engine.streaming.scoring import read_commits, read_scored
    base = scratch_path(spark, "scoring-job")
    inbox, model, out, rejects, checkpoint = (os.path.join(base, x) for x in ("in", "model", "out", "rejects", "checkpoint"))
    fx.scoring_requests(spark, sf_dir).write.json(inbox)
    save_model(duration_model(spark, sf_dir), model)
    for _ in range(2):
        query = run_job(spark, inbox, model, out, rejects, checkpoint, available_now=True)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"scoring job failed: {query.exception()}")
    committed = read_commits(spark, out).agg(F.sum("requests")).first()[0]
    counts = read_scored(spark, out, rejects).groupBy("status", "reject_reason").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))
    return counts.withColumn("committed", F.lit(committed))


# --- OP-16 by a lookup table, OP-53 by key -----------------------------------------
@register("service_mapping_join", "WITH " + SQL_REQUESTS + """
SELECT event_id, service FROM svc_all""")
def q_service_mapping_join(spark, sf_dir):
    from trip_engine.operators.codes import map_codes_join
    from trip_engine.specs import SERVICE_NAMES
    names = spark.createDataFrame([*SERVICE_NAMES.items()], "code string, name string")
    return map_codes_join(fx.ride_requests(spark, sf_dir), "hvfhs_license_num", names, "code", "name",
                          "service").select("event_id", "service")


@register("airport_trips_with_id", "WITH " + SQL_TRIPS.replace("AS source\n", """AS source,
         """ + _sql_key_id("strftime(l_shipdate + to_minutes(CAST(l_partkey % 1440 AS INTEGER)), '%Y-%m-%d %H:%M:%S')",
                           "strftime(l_shipdate + to_minutes(CAST(l_partkey % 1440 AS INTEGER))"
                           " + to_minutes(CAST(trunc(5 + l_quantity) AS INTEGER)), '%Y-%m-%d %H:%M:%S')",
                           "CAST(l_suppkey % 20 AS VARCHAR)", "CAST(l_partkey % 20 AS VARCHAR)",
                           "CASE l_returnflag WHEN 'N' THEN 'ride_hailing' WHEN 'A' THEN 'green' ELSE 'yellow' END")
                      + """ AS id
""") + "," + SQL_ZONES + """
SELECT t.id, a.Zone AS airport, t.source FROM trips t RIGHT JOIN airports a ON t.PULocationID = a.LocationID
UNION ALL SELECT t.id, a.Zone, t.source FROM trips t RIGHT JOIN airports a ON t.DOLocationID = a.LocationID""")
def q_airport_trips_with_id(spark, sf_dir):
    """Impressions carry the trips' id (here one that any engine computes alike)."""
    from trip_engine.operators.ids import add_row_id
    t = add_row_id(trips(spark, sf_dir), "key", ["pickup_datetime", "dropoff_datetime", "PULocationID",
                                                 "DOLocationID", "source"])
    return ap.zone_impressions(t, airport_zones(spark, sf_dir), "all", ZONES).select("id", "airport", "source")


# --- OP-27 equality slice, OP-48 column mean ------------------------------------
@register("airport_slice", SQL_IMPRESSIONS + """
SELECT airport, day_of_week, count(*) AS trip_count FROM alls
WHERE airport = 'NATION_7' GROUP BY airport, day_of_week""")
def q_airport_slice(spark, sf_dir):
    """One airport's series of the combined weekday report (a chart input)."""
    from trip_engine.operators.filters import slice_equal
    cube = ap.airport_cube(trips(spark, sf_dir), airport_zones(spark, sf_dir), ZONES)
    return slice_equal(ap.cube_report(cube, "all", "day_of_week", ordered=False),
                       "airport", "NATION_7")


@register("distance_mean", "WITH " + SQL_DURATION_TRIPS + SQL_FEATURES + """
SELECT round(m, 6) AS mean_distance, (SELECT count(*) FROM base WHERE distance IS NULL)
       AS missing FROM mean""")
def q_distance_mean(spark, sf_dir):
    from trip_engine.operators.features import base_features, column_mean
    b = base_features(_kt(spark, sf_dir))
    return b.agg(F.count_if(F.col("distance").isNull()).alias("missing")).select(
        F.round(column_mean(b, "distance"), 6).alias("mean_distance"), "missing")
