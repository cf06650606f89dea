"""Jobs OP-90..94 end to end on a temporary folder (data derived from the
driver's tables, written in the layouts the jobs read)."""

import glob
import os
import sys

from pyspark.sql import functions as F

from conftest import ROOT, SF_SMOKE
from trip_engine import fixtures as fx
from trip_engine.plans import map_layers, market_share, trip_duration

sys.path.insert(0, os.path.join(ROOT, "jobs"))


def test_trip_duration_job(spark, tmp_dir):
    train = os.path.join(tmp_dir, "train")
    test = os.path.join(tmp_dir, "test")
    fx.duration_trips(spark, SF_SMOKE).write.option("header", True).csv(train)
    fx.duration_trips(spark, SF_SMOKE, with_label=False).write.option("header", True).csv(test)
    out = os.path.join(tmp_dir, "out")
    preds = trip_duration.run(spark, train, test, out, max_iter=4, max_depth=3,
                              audit_table="job_audit")
    back = spark.read.option("header", True).csv(os.path.join(out, "predictions"))
    assert back.columns == ["id", "trip_duration"]
    assert back.count() == preds.count() == 1500
    assert os.path.isdir(os.path.join(out, "models", "gbtr", "stages"))
    assert spark.table("job_audit").count() >= 1


def test_market_share_job(spark, tmp_dir):
    src = os.path.join(tmp_dir, "fhv")
    fx.ride_requests(spark, SF_SMOKE).write.parquet(src)
    out = market_share.run(spark, src, os.path.join(tmp_dir, "out"), "2024-01-01", "2024-01-30")
    assert out["wide"].count() == 30
    files = glob.glob(os.path.join(tmp_dir, "out", "wide", "part-*.csv"))
    header = open(files[0]).readline().strip()
    assert header == "trip_date,Uber,Lyft,stacked_total"


def test_map_layers_job(spark, tmp_dir):
    src = os.path.join(tmp_dir, "train")
    fx.duration_trips(spark, SF_SMOKE).write.option("header", True).csv(src)
    out = map_layers.run(spark, src, os.path.join(tmp_dir, "out"), n=200, seed=42)
    assert out["points"].count() == 400
    dens = spark.read.parquet(os.path.join(tmp_dir, "out", "pickup_density"))
    assert dens.agg(F.sum("trip_count")).first()[0] == 1500 - 30


def test_airport_cli(spark, tmp_dir):
    import airport_insights as job
    paths = {}
    for spec in fx.SOURCE_FLAG.values():
        p = os.path.join(tmp_dir, spec.label)
        fx.raw_trips(spark, SF_SMOKE, spec).write.parquet(p)
        paths[spec.label] = p
    zones = os.path.join(tmp_dir, "zones")
    fx.zone_lookup(spark, SF_SMOKE).write.option("header", True).csv(zones)
    out = os.path.join(tmp_dir, "out")
    job.main(["--ride-hailing", paths["ride_hailing"], "--green", paths["green"],
              "--yellow", paths["yellow"], "--zone-lookup", zones, "--output", out,
              "--zones", *fx.FIXTURE_ZONES], spark=spark)
    for sub in ("pickups", "dropoffs", "trips"):
        for by in ("by_hour_of_day", "by_day_of_week"):
            assert len(glob.glob(os.path.join(out, sub, by, "part-*.csv"))) == 1
