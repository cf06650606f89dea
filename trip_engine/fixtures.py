"""Trip-shaped frames derived from the driver's tables (see FIXTURES.md B1-B5).

The original jobs read city trip files that are not part of the tree; these
functions derive frames of the same layout from ``lineitem``, ``nation`` /
``region``, ``events`` and ``orders`` with plain column expressions, so every
registered query grows with the given tables. The same expressions are
repeated as CTEs in ``__spark_entry__.oracle_sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_engine.specs import GREEN, RIDE_HAILING, YELLOW, SourceSpec

# --- fixed values of the stand-ins (FIXTURES.md) ------------------------------
SOURCE_FLAG = {"N": RIDE_HAILING, "A": GREEN, "R": YELLOW}
FIXTURE_ZONES = ("NATION_3", "NATION_7", "NATION_22")
EVENT_CODES = {"click": "HV0003", "view": "HV0005", "purchase": "HV0002", "signup": "HV0004"}
SHARE_FIRST_DAY = "2024-01-03"
SHARE_LAST_DAY = "2024-01-28"
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _minutes(n):
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"), F.lit(0))


def raw_trips(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> DataFrame:
    """One trip source in its own layout (B1): lineitem rows of one return
    flag, renamed to the source's column names."""
    flag = next(k for k, v in SOURCE_FLAG.items() if v is spec)
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == flag)
    pickup = F.col("l_shipdate") + _minutes(F.col("l_partkey") % 1440)
    dropoff = pickup + _minutes((F.lit(5) + F.col("l_quantity")).cast("int"))
    return li.select(
        pickup.alias(spec.pickup),
        dropoff.alias(spec.dropoff),
        (F.col("l_suppkey") % 20).alias(spec.pu),
        (F.col("l_partkey") % 20).alias(spec.do),
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup (B2): one row per nation, the three fixture zones are the
    'airports'. Keys 20-24 never occur in trips, so NATION_22 has no trips."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("long").alias("LocationID"),
                    F.col("r_name").alias("Borough"),
                    F.col("n_name").alias("Zone"),
                    F.when(F.col("n_name").isin(*FIXTURE_ZONES), F.lit("Airports"))
                     .otherwise(F.lit("Boro Zone")).alias("service_zone")))


def ride_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ride-hailing requests (B3): event time and a licence code per event."""
    ev = table(spark, sf_dir, "events")
    code = None
    for k, v in EVENT_CODES.items():
        code = F.when(F.col("event_type") == k, F.lit(v)) if code is None else code.when(
            F.col("event_type") == k, F.lit(v))
    return ev.select(F.col("event_id"), F.col("user_id"),
                     F.col("ts").alias("request_datetime"),
                     code.alias("hvfhs_license_num"))


def duration_trips(spark: SparkSession, sf_dir: str, with_label: bool = True,
                   part: str | None = None) -> DataFrame:
    """Duration trips (B4) from orders: all of them, or the 'train' or 'test' part."""
    o = table(spark, sf_dir, "orders")
    if part is not None:
        o = o.where(F.col("o_orderkey") % 10 < 8 if part == "train" else F.col("o_orderkey") % 10 >= 8)
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    lat_raw = F.lit(4.06e1) + (cust % 100) / F.lit(4e2)
    lon = F.lit(-7.405e1) + (key % 97) / F.lit(4e2)
    dlat = F.lit(4.06013e1) + (key % 89) / F.lit(4e2)
    dlon = F.lit(-7.405e1) + (cust % 83) / F.lit(4e2)
    cols = [
        F.concat(F.lit("id"), key.cast("string")).alias("id"),
        (F.lit(1) + key % 2).cast("int").alias("vendor_id"),
        (F.col("o_orderdate") + _minutes(cust % 1440)).alias("pickup_datetime"),
        (F.lit(1) + cust % 6).cast("int").alias("passenger_count"),
        F.when(key % 50 != 0, lat_raw).alias("pickup_latitude"),
        lon.alias("pickup_longitude"),
        dlat.alias("dropoff_latitude"),
        dlon.alias("dropoff_longitude"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Y"))
         .when(F.col("o_orderstatus") == "O", F.lit("N")).alias("store_and_fwd_flag"),
    ]
    if with_label:
        cols.append(F.floor(F.lit(1.2e2) + F.lit(1e4) * (F.abs(dlat - lat_raw) + F.abs(dlon - lon)))
                    .cast("int").alias("trip_duration"))
    return o.select(*cols)


def scoring_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests (B5): the test trips' features (flag in the batch
    job's reading, so it is always set), with ``distance`` dropped for every
    7th order key and ``vendor_id`` for every 11th - records with one or two
    missing fields. All orders are kept."""
    from trip_engine.operators.features import trip_features
    from trip_engine.specs import FeatureConfig
    test = duration_trips(spark, sf_dir, with_label=False)
    feats = trip_features(test, FeatureConfig(flag_unknown=1))
    key = F.substring("id", 3, 40).cast("long")
    return feats.select(
        "id",
        F.when(key % 11 != 0, F.col("vendor_id")).alias("vendor_id"),
        "passenger_count", "store_and_fwd_flag", "hour", "day", "month",
        F.when(key % 7 != 0, F.col("distance")).alias("distance"))
