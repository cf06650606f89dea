"""Scalar functions: distance traps T3-T6, flag T8, codes, percent, shapes."""

import math

import pytest
from pyspark.sql import functions as F

from trip_engine.functions.exprs import (apply_schema, capped_sum, day_of_week, encode_flag,
                                         great_circle, map_codes, percent, shape_duration)

PTS = "a1 double, o1 double, a2 double, o2 double"


def _dist(spark, rows, **kw):
    df = spark.createDataFrame(rows, PTS)
    return [r[0] for r in df.select(great_circle("a1", "o1", "a2", "o2", **kw)).collect()]


def test_identical_points(spark):
    pts = [(40.0 + i / 7, -73.9 - i / 11, 40.0 + i / 7, -73.9 - i / 11) for i in range(200)]
    # the law of cosines is ill-conditioned here: the clamp removes NaN, a
    # residue of rounding (< 1 m) remains; haversine gives exactly 0
    clamped = _dist(spark, pts, clamp=True)
    assert all(not math.isnan(d) and d < 1e-3 for d in clamped)
    assert all(d == 0.0 for d in _dist(spark, pts, method="haversine"))


def test_null_and_nan_coordinates_give_null(spark):
    rows = [(None, -73.9, 40.7, -73.8), (float("nan"), -73.9, 40.7, -73.8),
            (40.7, -73.9, 40.7, None)]
    assert _dist(spark, rows) == [None, None, None]
    assert _dist(spark, rows, method="haversine") == [None, None, None]


def test_known_distance_and_units(spark):
    # JFK -> LaGuardia, roughly 17 km / 10.6 miles
    rows = [(40.6413, -73.7781, 40.7769, -73.8740)]
    km = _dist(spark, rows, unit="km")[0]
    mi = _dist(spark, rows, unit="mi")[0]
    hv = _dist(spark, rows, method="haversine")[0]
    assert 16.5 < km < 17.5 and 10.2 < mi < 10.9
    assert abs(km - hv) < 1e-6
    assert abs(km / mi - 6371.0 / 3959.0) < 1e-12


def test_antimeridian_and_rounding(spark):
    rows = [(0.0, 179.9, 0.0, -179.9)]
    d = _dist(spark, rows, scale=4)[0]
    expected = 6371.0 * math.radians(0.2)
    assert abs(d - round(expected, 4)) < 1e-4


def test_bad_unit_raises():
    with pytest.raises(ValueError):
        great_circle("a", "b", "c", "d", unit="furlong")


def test_flag_modes(spark):
    df = spark.createDataFrame([("Y",), ("N",), (None,), ("x",)], "f string")
    sql_mode = [r[0] for r in df.select(encode_flag("f")).collect()]
    batch_mode = [r[0] for r in df.select(encode_flag("f", unknown=1)).collect()]
    assert sql_mode == [1, 0, None, None]
    assert batch_mode == [1, 0, 1, 1]


def test_map_codes_pass_through(spark):
    df = spark.createDataFrame([("HV0003",), ("HV0005",), ("HV0004",), (None,)], "c string")
    got = [r[0] for r in df.select(map_codes("c", {"HV0003": "Uber", "HV0005": "Lyft"})).collect()]
    assert got == ["Uber", "Lyft", "HV0004", None]


def test_percent_half_up_exact(spark):
    rows = [(1, 32), (57, 200), (1, 3), (2, 3), (0, 5), (5, 5), (1, 8)]
    df = spark.createDataFrame(rows, "n long, t long")
    got = [r[0] for r in df.select(percent("n", "t")).collect()]
    assert got == [3.13, 28.5, 33.33, 66.67, 0.0, 100.0, 12.5]


def test_capped_sum(spark):
    df = spark.createDataFrame([(60.0, 50.0), (10.0, 20.0)], "a double, b double")
    assert [r[0] for r in df.select(capped_sum("a", "b")).collect()] == [100.0, 30.0]


def test_shape_duration(spark):
    df = spark.createDataFrame([(10.5,), (10.49,), (-2.5,)], "p double")
    assert [r[0] for r in df.select(shape_duration("p", "trunc")).collect()] == [10, 10, -2]
    assert [r[0] for r in df.select(shape_duration("p", "round")).collect()] == [11.0, 10.0, -3.0]
    assert [r[0] for r in df.select(shape_duration("p", "raw")).collect()] == [10.5, 10.49, -2.5]
    with pytest.raises(ValueError):
        shape_duration("p", "floor")


def test_day_of_week_sunday_is_one(spark):
    df = spark.createDataFrame([("2024-01-07 10:00:00",), ("2024-01-13 10:00:00",)], "t string")
    got = [r[0] for r in df.select(day_of_week(F.to_timestamp("t"))).collect()]
    assert got == [1, 7]


def test_apply_schema_strict_and_lenient(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    lenient = apply_schema(df, {"a": "int", "b": "int", "absent": "int"}, strict=False).first()
    assert lenient["a"] == 1 and lenient["b"] is None
    with pytest.raises(Exception):
        apply_schema(df, {"b": "int"}, strict=True).collect()


def test_percent_matches_exact_fraction(spark):
    import random
    from fractions import Fraction
    rnd = random.Random(7)
    rows = []
    for _ in range(300):
        t = rnd.randint(1, 10**9)
        rows.append((rnd.randint(0, t), t))
    df = spark.createDataFrame(rows, "n long, t long")
    got = [r[0] for r in df.select(percent("n", "t")).collect()]
    for (n, t), g in zip(rows, got):
        x = Fraction(n * 100, t) * 100          # value in hundredths
        want = int(x + Fraction(1, 2))          # half up (x >= 0)
        assert g == want / 100.0, (n, t, g, want)
