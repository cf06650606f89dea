"""Sources (CSV, zone lookup, external tables, Parquet sources) and sinks."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE
from trip_engine import fixtures as fx
from trip_engine.operators.sinks import (publish_table, publish_view, write_predictions,
                                         write_report)
from trip_engine.plans import airport_insights
from trip_engine.sources.files import read_csv, read_trips, read_zone_lookup, register_external
from trip_engine.specs import GREEN, RIDE_HAILING, YELLOW, ZoneSpec


def test_zone_lookup_csv_with_bad_key(spark, tmp_dir):
    path = os.path.join(tmp_dir, "zones.csv")
    with open(path, "w") as fh:
        fh.write("LocationID,Borough,Zone,service_zone\n1,Queens,JFK Airport,Airports\n"
                 "x,Queens,Broken,Boro Zone\n")
    rows = read_zone_lookup(spark, path).orderBy("Zone").collect()
    assert [(r.LocationID, r.Zone) for r in rows] == [(None, "Broken"), (1, "JFK Airport")]


def test_read_csv_inferred_and_declared(spark, tmp_dir):
    kt = fx.duration_trips(spark, SF_SMOKE)
    path = os.path.join(tmp_dir, "train")
    kt.write.option("header", True).csv(path)
    inferred = read_csv(spark, path)
    assert dict(inferred.dtypes)["trip_duration"] == "int"
    from trip_engine.plans.trip_duration import TRAIN_SCHEMA
    declared = read_csv(spark, path, TRAIN_SCHEMA.simpleString().replace("struct<", "")
                        .rstrip(">").replace(":", " "))
    assert declared.count() == kt.count()


def test_register_external(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ev")
    fx.table(spark, SF_SMOKE, "events").write.parquet(path)
    register_external(spark, "ext_events", path, "parquet")
    assert spark.sql("SELECT count(*) FROM ext_events").first()[0] == 1000
    register_external(spark, "ext_events", path, "parquet")  # re-register is fine


def _write_sources(spark, base):
    paths = {}
    for spec in (RIDE_HAILING, GREEN, YELLOW):
        p = os.path.join(base, spec.label)
        fx.raw_trips(spark, SF_SMOKE, spec).write.parquet(p)
        paths[spec.label] = p
    zones = os.path.join(base, "zones")
    fx.zone_lookup(spark, SF_SMOKE).write.option("header", True).csv(zones)
    return paths, zones


def test_airport_job_end_to_end(spark, tmp_dir):
    paths, zones = _write_sources(spark, tmp_dir)
    out = os.path.join(tmp_dir, "out")
    spec = ZoneSpec(names=fx.FIXTURE_ZONES)
    airport_insights.run(spark, paths["ride_hailing"], paths["green"], paths["yellow"], zones,
                         out, spec)
    files = glob.glob(os.path.join(out, "pickups", "by_hour_of_day", "part-*.csv"))
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    assert lines[0] == "airport,hour_of_day,trip_count"
    back = read_csv(spark, os.path.join(out, "pickups", "by_hour_of_day"))
    assert back.filter(F.col("hour_of_day").isNull()).first().trip_count == 1
    src = read_trips(spark, paths["green"], GREEN)
    assert src.columns == ["pickup_datetime", "dropoff_datetime", "PULocationID",
                           "DOLocationID", "source"]


def test_write_report_sorted_after_exchange(spark, tmp_dir):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("k")).repartition(8)
    write_report(df, os.path.join(tmp_dir, "r"), ["k"])
    files = glob.glob(os.path.join(tmp_dir, "r", "part-*.csv"))
    vals = [int(x) for x in open(files[0]).read().splitlines()[1:]]
    assert len(files) == 1 and vals == sorted(vals)


def test_predictions_and_tables(spark, tmp_dir):
    df = spark.createDataFrame([("id1", 10.0), ("id2", 20.0)], "id string, trip_duration double")
    write_predictions(df, os.path.join(tmp_dir, "p"), single_file=True)
    assert len(glob.glob(os.path.join(tmp_dir, "p", "part-*.csv"))) == 1
    publish_view(df, "pred_view")
    assert spark.sql("SELECT count(*) FROM pred_view").first()[0] == 2
    publish_table(df, "pred_table", comment="predicted durations",
                  column_comments={"trip_duration": "seconds"},
                  properties={"quality": "tested"},
                  labels={"owner": "analytics", "status": "experimental"})
    desc = {r.col_name: r for r in spark.sql("DESCRIBE TABLE pred_table").collect()}
    assert desc["trip_duration"].comment == "seconds"
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES pred_table").collect()}
    assert props["label.owner"] == "analytics" and props["quality"] == "tested"
    ext = spark.sql("DESCRIBE TABLE EXTENDED pred_table").collect()
    assert any(r.col_name == "Comment" and r.data_type == "predicted durations" for r in ext)
    publish_table(df.limit(1), "pred_table")  # full refresh
    assert spark.table("pred_table").count() == 1


def test_declared_schema_binds_by_name_and_fills_missing(spark, tmp_dir):
    from trip_engine.plans.trip_duration import TRAIN_SCHEMA
    test = fx.duration_trips(spark, SF_SMOKE, with_label=False)
    path = os.path.join(tmp_dir, "test")
    # columns in a different order than the declared schema, label absent
    test.select(*reversed(test.columns)).write.option("header", True).csv(path)
    back = read_csv(spark, path, TRAIN_SCHEMA)
    assert back.columns == [f.name for f in TRAIN_SCHEMA.fields]
    assert back.filter(F.col("trip_duration").isNotNull()).count() == 0
    a = back.orderBy("id").select("id", "pickup_latitude", "vendor_id").collect()
    b = test.orderBy("id").select("id", "pickup_latitude", "vendor_id").collect()
    assert a == b


def test_register_external_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "zones_csv")
    fx.zone_lookup(spark, SF_SMOKE).write.option("header", True).csv(path)
    register_external(spark, "ext_zones", path, "csv", header="true")
    assert spark.sql("SELECT count(*) FROM ext_zones WHERE Zone = 'NATION_22'").first()[0] == 1


def test_zone_lookup_binds_by_header_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "zones.csv")
    with open(path, "w") as fh:
        fh.write("Zone,LocationID,Borough,service_zone\nJFK Airport,132,Queens,Airports\n")
    r = read_zone_lookup(spark, path).first()
    assert (r.LocationID, r.Borough, r.Zone, r.service_zone) == (132, "Queens", "JFK Airport", "Airports")


def test_zone_lookup_with_other_names(spark, tmp_dir):
    path = os.path.join(tmp_dir, "zones.csv")
    with open(path, "w") as fh:
        fh.write("label,code\nA,1\n")
    r = read_zone_lookup(spark, path, ZoneSpec(key="code", name="label")).first()
    assert (r.code, r.label) == (1, "A")
    with pytest.raises(ValueError, match="LocationID"):
        read_zone_lookup(spark, path)


def test_managed_table_is_not_replaced(spark, tmp_dir):
    spark.range(7).write.mode("overwrite").saveAsTable("managed_numbers")
    path = os.path.join(tmp_dir, "n")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError, match="managed"):
        register_external(spark, "managed_numbers", path)
    assert spark.table("managed_numbers").count() == 7
    spark.sql("DROP TABLE managed_numbers")


def test_strict_csv_and_the_count_of_unreadable_values(spark, tmp_dir):
    from trip_engine.sources.files import unreadable_values
    path = os.path.join(tmp_dir, "t.csv")
    with open(path, "w") as fh:
        fh.write("a,b\n1,x\nz,y\n,q\n")
    assert [r.a for r in read_csv(spark, path, "a int, b string").collect()] == [1, None, None]
    found = {r.column_name: r.unreadable for r in unreadable_values(spark, path, "a int, b string").collect()}
    assert found == {"a": 1, "b": 0}
    with pytest.raises(Exception):
        read_csv(spark, path, "a int, b string", strict=True).collect()


def test_large_report_is_written_in_order_by_many_tasks(spark, tmp_dir):
    path = os.path.join(tmp_dir, "r")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_report(spark.range(20_000).selectExpr("pmod(id * 7919, 20000) AS k"), path, ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(glob.glob(os.path.join(path, "part-*.csv")))
    values = [int(x) for f in files for x in open(f).read().splitlines()[1:]]
    assert len(files) > 1 and values == list(range(20_000))


def test_scratch_is_released(spark):
    from trip_engine import registry as reg
    from trip_engine.session import _scratch, release_scratch
    reg.QUERIES["zone_lookup_csv"](spark, SF_SMOKE).collect()
    paths = [p.removeprefix("file:") for p in _scratch[spark.sparkContext.applicationId]]
    assert any(os.path.exists(p) for p in paths)
    release_scratch(spark)
    assert not any(os.path.exists(p) for p in paths)


def test_code_lookup_join_same_either_way(spark):
    from trip_engine.operators.codes import map_codes_join
    df = spark.createDataFrame([("a",), ("b",), (None,), ("z",)], "c string")
    names = spark.createDataFrame([("a", "A"), ("b", "B"), ("b", "B2"), (None, "N")], "k string, n string")
    for most in (100, 0):
        out = map_codes_join(df, "c", names, "k", "n", "name", most)
        assert sorted((r.c or "", r["name"]) for r in out.collect()) == [("", None), ("a", "A"), ("b", "B"), ("z", "z")]


def _names(spark, name):
    return sorted(r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{name}*'").collect())


def test_a_failing_refresh_leaves_the_old_table(spark):
    from pyspark.sql import functions as F
    from trip_engine.operators.sinks import publish_table
    good = spark.range(10).withColumn("v", F.lit("a"))
    publish_table(good, "swap_t", comment="first", column_comments={"v": "a value"}, labels={"owner": "x"})
    publish_table(good.limit(4), "swap_t", comment="second", column_comments={"v": "a value"})
    assert spark.table("swap_t").count() == 4 and _names(spark, "swap_t") == ["swap_t"]
    broken = good.withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        publish_table(broken, "swap_t", comment="third")
    assert spark.table("swap_t").count() == 4 and _names(spark, "swap_t") == ["swap_t"]
    detail = {r.col_name: (r.data_type, r.comment) for r in spark.sql("DESCRIBE TABLE EXTENDED swap_t").collect()}
    assert detail["Comment"][0] == "second" and detail["v"][1] == "a value"
    with pytest.raises(ValueError, match="nope"):
        publish_table(good, "swap_t", column_comments={"nope": "?"})
    publish_table(good, "swap_t", mode="append")
    assert spark.table("swap_t").count() == 14
    publish_table(good, "swap_t", partition_by=["v"])
    assert spark.table("swap_t").where("v = 'a'").count() == 10
    spark.sql("DROP TABLE swap_t")


def test_an_interrupted_swap_is_completed(spark, monkeypatch):
    from trip_engine.operators import sinks
    sinks.publish_table(spark.range(3), "cut_t")
    # between the two renames: only the old name is left
    spark.sql("ALTER TABLE cut_t RENAME TO cut_t__old_1")
    spark.range(9).write.saveAsTable("cut_t__new_2")
    sinks._finish_swap(spark, "cut_t")
    assert _names(spark, "cut_t") == ["cut_t"] and spark.table("cut_t").count() == 3
    # the second rename fails: the old table gets its name back
    real = spark.sql

    def sql(text, *args, **kwargs):
        if "RENAME TO cut_t" in text and "__new_" in text.split("RENAME")[0]:
            raise RuntimeError("cut")
        return real(text, *args, **kwargs)
    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", lambda self, text, *a, **k: sql(text, *a, **k))
        with pytest.raises(RuntimeError):
            sinks.publish_table(spark.range(5), "cut_t")
    assert spark.table("cut_t").count() == 3
    sinks.publish_table(spark.range(5), "cut_t")
    assert spark.table("cut_t").count() == 5 and _names(spark, "cut_t") == ["cut_t"]
    spark.sql("DROP TABLE cut_t")
