"""Exact-size hash sample: size, determinism, brute force, errors."""

import hashlib

import pytest

from conftest import SF_SMALL, SF_SMOKE
from trip_engine import fixtures as fx
from trip_engine.operators.frames import grid_density, point_layers, sample_exact


def test_sample_matches_brute_force(spark):
    kt = fx.duration_trips(spark, SF_SMOKE).select("id", "pickup_latitude")
    got = sorted(r.id for r in sample_exact(kt, 137, 42, "id").collect())
    ids = [r.id for r in kt.select("id").collect()]
    brute = sorted(sorted(ids, key=lambda i: (hashlib.md5(f"42{i}".encode()).hexdigest(), i))[:137])
    assert got == brute


@pytest.mark.parametrize("n", [0, 1, 999, 15000])
def test_sample_size_exact(spark, n):
    kt = fx.duration_trips(spark, SF_SMALL).select("id")
    assert sample_exact(kt, n, 7, "id").count() == n


def test_sample_seed_changes_rows(spark):
    kt = fx.duration_trips(spark, SF_SMALL).select("id")
    a = {r.id for r in sample_exact(kt, 500, 1, "id").collect()}
    b = {r.id for r in sample_exact(kt, 500, 2, "id").collect()}
    assert a != b and len(a) == len(b) == 500


def test_sample_too_large_raises(spark):
    kt = fx.duration_trips(spark, SF_SMOKE).select("id")
    with pytest.raises(ValueError):
        sample_exact(kt, 10**6, 42, "id")


def test_layers_and_density(spark):
    kt = fx.duration_trips(spark, SF_SMALL)
    layers = point_layers(sample_exact(kt, 100, 42, "id"))
    assert layers.groupBy("layer").count().count() == 2
    dens = grid_density(kt, "pickup_latitude", "pickup_longitude")
    total = dens.agg({"trip_count": "sum"}).first()[0]
    assert total == 15000 - 300      # rows without pickup latitude are skipped


@pytest.mark.parametrize("n", [0, 5, 10, 15, 30])
def test_null_key_is_refused_whatever_n(spark, n):
    rows = [(None if i % 3 == 0 else f"id{i}", i) for i in range(30)]
    df = spark.createDataFrame(rows, "id string, v int")
    with pytest.raises(ValueError, match="10 rows have no id"):
        sample_exact(df, n, 42, "id")


def test_repeated_keys_are_cut_by_the_other_columns(spark):
    rows = [("same", i) for i in range(40)] + [(f"id{i}", i) for i in range(10)]
    df = spark.createDataFrame(rows, "id string, v int")
    runs = [sorted(map(tuple, sample_exact(df.repartition(p), 17, 3, "id").collect())) for p in (1, 3, 8)]
    assert runs[0] == runs[1] == runs[2]


def test_layers_read_the_sample_once(spark):
    from trip_engine.plans.inspect import physical_plan
    from trip_engine.plans.map_layers import layers
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = layers(fx.duration_trips(spark, SF_SMOKE), 100)
        scans = [physical_plan(df).count("orders.parquet") for df in out.values()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert scans == [1, 1]
