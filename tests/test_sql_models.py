"""SQL model chain as views / tables; JSON text requests."""

from conftest import SF_SMALL, SF_SMOKE
from trip_engine import fixtures as fx
from trip_engine import registry as reg
from trip_engine.operators.features import trip_features
from trip_engine.operators.model import train_duration_model
from trip_engine.plans.sql_models import (AIRPORT_VIEWS, materialise_predictions,
                                          register_airport_views)
from trip_engine.sources.requests import parse_requests
from trip_engine.specs import FeatureConfig


def test_airport_views_answer_sql(spark):
    register_airport_views(reg.trips(spark, SF_SMALL), fx.zone_lookup(spark, SF_SMALL), reg.ZONES)
    names = {t.name for t in spark.catalog.listTables()}
    assert set(AIRPORT_VIEWS) <= names
    via_view = spark.sql("SELECT airport, hour_of_day, trip_count FROM "
                         "aggregated_pickup_insights_by_hod").collect()
    via_sql = spark.sql("SELECT airport, hour_of_day, count(*) AS trip_count FROM airport_pickups "
                        "GROUP BY airport, hour_of_day").collect()
    assert sorted(map(tuple, via_view), key=repr) == sorted(map(tuple, via_sql), key=repr)
    n22 = spark.sql("SELECT trip_count FROM aggregated_trip_insights_by_dow "
                    "WHERE airport = 'NATION_22'").first()[0]
    assert n22 == 2


def test_prediction_tables(spark):
    cfg = FeatureConfig(impute=False)
    train_raw = fx.duration_trips(spark, SF_SMOKE)
    test_raw = fx.duration_trips(spark, SF_SMOKE, with_label=False)
    model = train_duration_model(trip_features(train_raw, cfg), max_iter=3, max_depth=3)
    materialise_predictions(train_raw, test_raw, model, cfg, prefix="t_")
    assert spark.table("t_trip_duration_prediction").count() == 1500
    assert spark.table("t_enriched_training_trips").columns[-1] == "trip_duration"


def test_parse_json_text_requests(spark):
    df = spark.createDataFrame(
        [('{"id": "a", "vendor_id": 1, "passenger_count": 1, "store_and_fwd_flag": 0, '
          '"hour": 3, "day": 2, "month": 1, "distance": 4}',), ("not json",)], "value string")
    rows = parse_requests(df).collect()
    assert rows[0].id == "a" and rows[0].distance == 4.0
    assert rows[1].id is None


def test_lasting_views_answer_another_session(spark):
    from trip_engine.plans.inspect import physical_plan
    from trip_engine.plans.sql_models import COUNTS_VIEW, create_airport_views
    from trip_engine.specs import GREEN, RIDE_HAILING, YELLOW
    tables = {f"lv_{s.label}": s for s in (RIDE_HAILING, GREEN, YELLOW)}
    for name, source in tables.items():
        fx.raw_trips(spark, SF_SMALL, source).write.mode("overwrite").saveAsTable(name)
    fx.zone_lookup(spark, SF_SMALL).write.mode("overwrite").saveAsTable("lv_zones")
    made = create_airport_views(spark, tables, "lv_zones", reg.ZONES, "lv_")
    assert sorted(made) == sorted(f"lv_{v}" for v in (*AIRPORT_VIEWS, COUNTS_VIEW))
    create_airport_views(spark, tables, "lv_zones", reg.ZONES, "lv_")  # replaced, not refused
    other = spark.newSession()
    z = reg.airport_zones(spark, SF_SMALL)
    t = reg.trips(spark, SF_SMALL)
    from trip_engine.operators import airports as ap
    for kind, name in (("pickup", "pickup"), ("dropoff", "dropoff"), ("all", "trip")):
        got = other.sql(f"SELECT impression_datetime, source, airport, hour_of_day, day_of_week FROM lv_airport_{name}s")
        want = ap.zone_impressions(t, z, kind, reg.ZONES)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        for by, suffix in (("hour_of_day", "hod"), ("day_of_week", "dow")):
            got = other.table(f"lv_aggregated_{name}_insights_by_{suffix}").collect()
            want = ap.zone_report(t, z, kind, by, reg.ZONES).collect()
            assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, want)))
    assert other.sql("SELECT count(DISTINCT id) > 1000 FROM lv_trips WHERE id IS NOT NULL").first()[0]
    other.conf.set("spark.sql.adaptive.enabled", "false")
    plan = physical_plan(other.table("lv_aggregated_trip_insights_by_hod"))
    assert plan.count("/lv_yellow") == 1  # a report reads each trip table once
    # the views follow their tables
    before = other.sql("SELECT sum(trip_count) FROM lv_aggregated_trip_insights_by_dow").first()[0]
    fx.raw_trips(spark, SF_SMALL, GREEN).where("false").write.mode("overwrite").saveAsTable("lv_green")
    other.catalog.refreshTable("lv_green")
    assert other.sql("SELECT sum(trip_count) FROM lv_aggregated_trip_insights_by_dow").first()[0] < before
    for v in reversed(made):
        spark.sql(f"DROP VIEW {v}")
    for name in (*tables, "lv_zones"):
        spark.sql(f"DROP TABLE {name}")
