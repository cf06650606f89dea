"""Note J rewrite, the B7 row, cube roll-ups, broadcast fallback, plan shape."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_SMOKE
from trip_engine import registry as reg
from trip_engine.functions.exprs import day_of_week, hour_of_day
from trip_engine.operators import airports as ap
from trip_engine.plans.inspect import physical_plan
from trip_engine.session import write_scratch

Z = reg.ZONES


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _literal_right_join_report(trips, zones, kind, by):
    ts, loc = ap.KINDS[kind]
    j = trips.join(zones, trips[loc] == zones["LocationID"], "right")
    imp = j.select(F.col("Zone").alias("airport"), hour_of_day(ts).alias("hour_of_day"),
                   day_of_week(ts).alias("day_of_week"))
    return imp.groupBy("airport", by).agg(F.count(F.lit(1)).alias("trip_count"))


@pytest.mark.parametrize("kind", ["pickup", "dropoff"])
@pytest.mark.parametrize("by", ["hour_of_day", "day_of_week"])
def test_rewrite_equals_right_join(spark, kind, by):
    t, z = reg.trips(spark, SF_SMALL), reg.airport_zones(spark, SF_SMALL)
    ours = ap.airport_report(ap.zone_impressions(t, z, kind, Z), by, ordered=False)
    assert _rows(ours) == _rows(_literal_right_join_report(t, z, kind, by))


def test_unmatched_zone_row(spark):
    t, z = reg.trips(spark, SF_SMALL), reg.airport_zones(spark, SF_SMALL)
    rep = {(r.airport, r.hour_of_day): r.trip_count for r in
           ap.airport_report(ap.zone_impressions(t, z, "pickup", Z), "hour_of_day").collect()}
    assert rep[("NATION_22", None)] == 1
    zero = {(r.airport, r.hour_of_day): r.trip_count for r in ap.airport_report(
        ap.zone_impressions(t, z, "pickup", Z), "hour_of_day", unmatched="zero").collect()}
    assert zero[("NATION_22", None)] == 0
    totals = {}
    for (a, _), n in rep.items():
        totals[a] = totals.get(a, 0) + n
    assert totals["NATION_3"] == 2887 and totals["NATION_7"] == 2999


def test_cube_rollups_equal_six_reports(spark):
    t, z = reg.trips(spark, SF_SMALL), reg.airport_zones(spark, SF_SMALL)
    reports = ap.airport_reports(t, z, Z)
    for kind, prefix in (("pickup", "pickups"), ("dropoff", "dropoffs"), ("all", "trips")):
        imp = reg.impressions(spark, SF_SMALL, kind)
        for by, suffix in (("hour_of_day", "hour"), ("day_of_week", "weekday")):
            assert _rows(reports[f"{prefix}_by_{suffix}"]) == _rows(
                ap.airport_report(imp, by, ordered=False)), (kind, by)


def test_broadcast_fallback_same_answer(spark):
    t, z = reg.trips(spark, SF_SMOKE), reg.airport_zones(spark, SF_SMOKE)
    for kind in ("dropoff", "all"):
        a = ap.airport_report(ap.zone_impressions(t, z, kind, Z, broadcast=True), "hour_of_day")
        b = ap.airport_report(ap.zone_impressions(t, z, kind, Z, broadcast=False), "hour_of_day")
        assert _rows(a) == _rows(b)
    c1 = ap.airport_cube(t, z, Z, broadcast=True)
    c2 = ap.airport_cube(t, z, Z, broadcast=False)
    assert _rows(c1) == _rows(c2)


def test_report_is_ordered_with_null_hour_first(spark):
    rep = reg.QUERIES["airport_pickups_by_hour"](spark, SF_SMOKE).collect()
    keys = [(r.airport, -1 if r.hour_of_day is None else r.hour_of_day) for r in rep]
    assert keys == sorted(keys)


def test_cube_plan_single_scan_no_trip_shuffle(spark):
    spark.catalog.clearCache()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cube = ap.airport_cube(reg.trips(spark, SF_SMALL), reg.airport_zones(spark, SF_SMALL), Z)
        plan = physical_plan(cube)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    # one scan per trip source: no second pass for the unmatched zones
    assert plan.count("lineitem.parquet") == 3, plan
    # every exchange sits directly above an aggregate: trips are never
    # shuffled raw, only partial aggregates (and the few cube rows) move
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line:
            assert "HashAggregate" in lines[i + 1], plan


def test_all_impressions_single_scan(spark, monkeypatch):
    """What is written scans each source once for both kinds; the result reads what was written.
    Without writing, a second narrow scan finds the zones without trips."""
    plans = []

    def keep(df, name):
        plans.append(physical_plan(df))
        return write_scratch(df, name)
    monkeypatch.setattr(ap, "write_scratch", keep)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical_plan(reg.impressions(spark, SF_SMALL, "all"))
        t, z = reg.trips(spark, SF_SMALL), reg.airport_zones(spark, SF_SMALL)
        lazy = physical_plan(ap.zone_impressions(t, z, "all", Z, one_pass=False))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(plans) == 1 and plans[0].count("lineitem.parquet") == 3, plans
    assert "Exchange hashpartitioning" not in plans[0] and "SortMergeJoin" not in plans[0]
    assert "lineitem.parquet" not in plan
    # one full scan per source for the rows, one narrow key scan for the
    # zones without trips - not one pass per kind
    assert lazy.count("lineitem.parquet") == 6, lazy
    assert "SortMergeJoin" not in lazy


def test_both_forms_of_impressions_agree(spark):
    t, z = reg.trips(spark, SF_SMALL), reg.airport_zones(spark, SF_SMALL)
    for kind in ("pickup", "all"):
        a, b = (ap.zone_impressions(t, z, kind, Z, one_pass=x).groupBy("airport", "source", "hour_of_day").count().collect()
                for x in (True, False))
        assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) > 20


def test_lookup_filter_pushed_to_scan(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical_plan(reg.airport_zones(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "PushedFilters" in plan and "In(n_name" in plan


def test_consolidate_by_name(spark):
    from trip_engine.sources.adapters import conform, consolidate
    from trip_engine.specs import GREEN, YELLOW
    g = spark.createDataFrame([(1, 2, "2024-01-01 00:00:00", "2024-01-01 00:10:00")],
                              "PULocationID long, DOLocationID long, lpep_pickup_datetime string,"
                              " lpep_dropoff_datetime string")
    y = spark.createDataFrame([("2024-01-02 00:00:00", "2024-01-02 00:10:00", 3, 4)],
                              "tpep_pickup_datetime string, tpep_dropoff_datetime string,"
                              " PULocationID long, DOLocationID long")
    rows = consolidate(conform(g, GREEN), conform(y, YELLOW)).collect()
    assert [(r.PULocationID, r.source) for r in rows] == [(1, "green"), (3, "yellow")]
    with pytest.raises(ValueError):
        conform(g, YELLOW)


def test_empty_trips_keep_every_zone(spark):
    t = reg.trips(spark, SF_SMOKE).limit(0)
    z = reg.airport_zones(spark, SF_SMOKE)
    cube = ap.airport_cube(t, z, Z).collect()
    assert sorted((r.kind, r.airport, r.trip_count) for r in cube) == sorted(
        (k, a, 1) for k in ("pickup", "dropoff") for a in fx_zones())
    zero = ap.airport_cube(t, z, Z, unmatched="zero").collect()
    assert all(r.trip_count == 0 and r.hour_of_day is None for r in zero)
    imp = ap.zone_impressions(t, z, "all", Z).collect()
    assert len(imp) == 6 and all(r.source is None for r in imp)


def fx_zones():
    from trip_engine import fixtures as fx
    return fx.FIXTURE_ZONES


def test_duplicate_lookup_rows_count_like_right_join(spark):
    t = reg.trips(spark, SF_SMOKE)
    z = reg.airport_zones(spark, SF_SMOKE)
    dup = z.unionByName(z.filter(F.col("Zone") == "NATION_22"))  # an unmatched zone twice
    cube = {(r.kind, r.airport, r.hour_of_day): r.trip_count
            for r in ap.airport_cube(t, dup, Z).collect()}
    assert cube[("pickup", "NATION_22", None)] == 2
    lit = {(r.airport, r.hour_of_day): r.trip_count
           for r in _literal_right_join_report(t, dup, "pickup", "hour_of_day").collect()}
    assert lit[("NATION_22", None)] == 2


def test_trips_in_zones_without_broadcast_same_rows(spark):
    from trip_engine.operators.filters import trips_in_zones
    from trip_engine.specs import ZoneSpec
    t, z = reg.trips(spark, SF_SMOKE), reg.airport_zones(spark, SF_SMOKE)
    small = trips_in_zones(t, z, "DOLocationID", Z)
    big = trips_in_zones(t, z, "DOLocationID", ZoneSpec(names=Z.names, max_broadcast_rows=1))
    assert _rows(small) == _rows(big)
    assert small.count() == ap.zone_impressions(t, z, "dropoff", Z).filter(
        F.col("source").isNotNull()).count()


def _nameless(spark, sf):
    from trip_engine import fixtures as fx
    return fx.zone_lookup(spark, sf).withColumn("Zone", F.when(F.col("LocationID") != 7, F.col("Zone")))


@pytest.mark.parametrize("broadcast", [True, False])
def test_cube_counts_zones_without_a_name(spark, broadcast):
    t, z = reg.trips(spark, SF_SMOKE), _nameless(spark, SF_SMOKE)
    twice = z.unionByName(z.where("LocationID = 7"))
    cube = ap.airport_cube(t, twice, Z, broadcast=broadcast)
    assert _rows(ap.cube_report(cube, "pickup", "hour_of_day", ordered=False)) == _rows(
        _literal_right_join_report(t, twice, "pickup", "hour_of_day"))


def test_reports_scan_the_trips_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("airport_pickups_by_hour", "airport_trips_by_weekday", "zero_filled_report"):
            plan = physical_plan(reg.QUERIES[name](spark, SF_SMOKE))
            assert plan.count("lineitem.parquet") == 3, plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_fallback_joins_no_raw_trips_in_the_cube(spark):
    """Without the broadcast the trips meet the lookup as aggregates, and the
    row-level impressions use an inner join, whose hot zone AQE can split."""
    t, z = reg.trips(spark, SF_SMOKE), reg.airport_zones(spark, SF_SMOKE)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical_plan(ap.airport_cube(t, z, Z, broadcast=False))
        rows = physical_plan(ap.reached_impressions(t, z, "pickup", Z, broadcast=False))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "HashAggregate" in lines[i + 1], plan
    assert "RightOuter" not in rows


def test_impressions_carry_ids_and_leave_nothing_cached(spark):
    from trip_engine import fixtures as fx
    from trip_engine.plans.sql_models import register_airport_views
    register_airport_views(reg.trips(spark, SF_SMOKE), fx.zone_lookup(spark, SF_SMOKE), Z)
    ids = spark.sql("SELECT id FROM airport_trips WHERE id IS NOT NULL")
    assert ids.count() > 0 and dict(ids.dtypes)["id"] == "string"
    spark.catalog.clearCache()
    reports = ap.airport_reports(reg.trips(spark, SF_SMOKE), reg.airport_zones(spark, SF_SMOKE), Z)
    reports["trips_by_hour"].collect()
    cached = spark.sparkContext._jsc.sc().getPersistentRDDs
    assert cached().size() > 0
    ap.release_reports()
    assert cached().size() == 0


def test_broadcast_is_bounded_in_rows_and_bytes(spark):
    from trip_engine.plans.broadcast import fits_broadcast
    df = spark.range(100).selectExpr("id", "repeat('x', 1000) AS name", "CAST(NULL AS STRING) AS other")
    assert fits_broadcast(df, 100) and not fits_broadcast(df, 99)
    assert not fits_broadcast(df, 100, max_bytes=90_000) and fits_broadcast(df, 100, max_bytes=110_000)
    assert fits_broadcast(df.limit(0), 0)
