"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is forced with the ``noop`` sink (full evaluation, no output
cost); median of BENCH_RUNS (default 3) after one warm-up run. Model fitting
has no warm-up run. The headline is the sum over the list below, the costly
items (model fit, contracts, ordered ids) included. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4)))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    from pyspark.sql import functions as F

    from trip_engine import fixtures as fx
    from trip_engine import registry as reg
    from trip_engine.functions.exprs import day_of_week, hour_of_day
    from trip_engine.operators import airports as ap
    from trip_engine.operators.features import trip_features
    from trip_engine.operators.frames import grid_density, sample_exact
    from trip_engine.operators.ids import add_row_id
    from trip_engine.operators.model import predict_durations, train_duration_model
    from trip_engine.operators.quality import TRIPS_CONTRACT, run_contract
    from trip_engine.operators.share import densify_days, market_share
    from trip_engine.session import build_session
    from trip_engine.specs import FeatureConfig

    spark = build_session(f"local[{CPUS}]", app_name="trip-engine-bench",
                          shuffle_partitions=max(8, 2 * CPUS),
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "4g")})
    sf = SF_DIR
    z = reg.airport_zones(spark, sf)

    def six_literal():
        # the original shape: six independent actions, literal right join
        trips = reg.trips(spark, sf)
        for kind in ("pickup", "dropoff", "all"):
            for by in ("hour_of_day", "day_of_week"):
                kinds = ["pickup", "dropoff"] if kind == "all" else [kind]
                imp = None
                for k in kinds:
                    ts, loc = ap.KINDS[k]
                    j = trips.join(z, trips[loc] == z["LocationID"], "right").select(
                        F.col("Zone").alias("airport"), hour_of_day(ts).alias("hour_of_day"),
                        day_of_week(ts).alias("day_of_week"))
                    imp = j if imp is None else imp.unionByName(j)
                _noop(imp.groupBy("airport", by).agg(F.count(F.lit(1)).alias("trip_count"))
                      .orderBy("airport", by))

    def six_cube():
        reports = ap.airport_reports(reg.trips(spark, sf), z, reg.ZONES)
        for df in reports.values():
            _noop(df)
        ap.release_reports()

    def share_window():
        _noop(market_share(fx.ride_requests(spark, sf), first=fx.SHARE_FIRST_DAY,
                           last=fx.SHARE_LAST_DAY))

    def share_join():
        _noop(market_share(fx.ride_requests(spark, sf), first=fx.SHARE_FIRST_DAY,
                           last=fx.SHARE_LAST_DAY, form="join"))

    def share_dense():
        s = market_share(fx.ride_requests(spark, sf), first="2023-12-29", last="2024-02-02")
        _noop(densify_days(s, "2023-12-29", "2024-02-02"))

    def features():
        _noop(trip_features(fx.duration_trips(spark, sf)))

    def sample():
        _noop(sample_exact(fx.duration_trips(spark, sf), 1000, 42, "id"))

    def density():
        _noop(grid_density(fx.duration_trips(spark, sf), "pickup_latitude", "pickup_longitude"))

    def contract():
        _noop(run_contract(reg.trips(spark, sf), TRIPS_CONTRACT, "trips"))

    def dense_ids():
        ev = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
        _noop(add_row_id(ev, "dense", order_by=["l_orderkey", "l_linenumber", "l_partkey"]))

    timed = {
        "airport_six_reports_literal": six_literal,
        "airport_six_reports_cube": six_cube,
        "market_share_window": share_window,
        "market_share_join": share_join,
        "market_share_dense": share_dense,
        "feature_frame": features,
        "sample_exact": sample,
        "grid_density": density,
        "run_contract": contract,
        "dense_row_id_ordered": dense_ids,
    }
    results, spread = {}, {}
    for name, fn in timed.items():
        fn()  # warm-up
        times = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
        spread[name] = [round(min(times), 3), round(max(times), 3)]

    cfg = FeatureConfig(impute=False)
    train = trip_features(fx.duration_trips(spark, sf, part="train"), cfg)
    times = []
    for _ in range(RUNS):  # the first one warms up and counts
        t0 = time.perf_counter()
        model = train_duration_model(train)
        times.append(time.perf_counter() - t0)
    results["gbt_fit"] = round(statistics.median(times), 3)
    spread["gbt_fit"] = [round(min(times), 3), round(max(times), 3)]
    test = trip_features(fx.duration_trips(spark, sf, with_label=False), cfg)
    _noop(predict_durations(model, test))  # warm-up
    times = []
    for _ in range(RUNS):
        t0 = time.perf_counter()
        _noop(predict_durations(model, test))
        times.append(time.perf_counter() - t0)
    results["batch_scoring"] = round(statistics.median(times), 3)
    spread["batch_scoring"] = [round(min(times), 3), round(max(times), 3)]

    headline = ("airport_six_reports_cube", "market_share_window", "feature_frame",
                "batch_scoring", "gbt_fit", "run_contract", "dense_row_id_ordered")
    out = {"metric": "headline_queries_total", "value": round(sum(results[k] for k in headline), 3),
           "unit": "sec", "queries": results, "sf": os.path.basename(sf.rstrip("/")),
           "cpus": CPUS, "runs": RUNS, "headline": list(headline), "spread": spread}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
