"""Row ids: sparse unique, dense 1..N, ordered form equals row_number."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trip_engine import fixtures as fx
from trip_engine.operators.ids import add_row_id
from trip_engine.plans.inspect import physical_plan
from trip_engine.session import write_scratch


def test_sparse_unique(spark):
    ev = fx.table(spark, SF_SMALL, "events").repartition(5)
    ids = add_row_id(ev, "sparse").select("id")
    assert ids.count() == ids.distinct().count() == 10000


def test_dense_is_one_to_n(spark):
    ev = fx.table(spark, SF_SMALL, "events").repartition(7).select("event_id")
    ids = sorted(r.id for r in add_row_id(ev, "dense").collect())
    assert ids == list(range(1, 10001))


def test_dense_ordered_equals_row_number(spark):
    ev = fx.table(spark, SF_SMALL, "events").select("event_id", "ts")
    ours = add_row_id(ev, "dense", order_by=["ts", "event_id"], col="rid", num_partitions=6)
    ref = ev.withColumn("rid", F.row_number().over(Window.orderBy("ts", "event_id")))
    assert sorted(tuple(r) for r in ours.select("event_id", "rid").collect()) == \
        sorted(tuple(r) for r in ref.select("event_id", "rid").collect())


def test_dense_plan_never_gathers_rows(spark, monkeypatch):
    """The only single-partition exchange moves counts, and the frame is never written."""
    from trip_engine.operators import ids
    written = []

    def keep(df, name):
        written.append(df.columns)
        return write_scratch(df, name)
    monkeypatch.setattr(ids, "write_scratch", keep)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ev = fx.table(spark, SF_SMALL, "events").select("event_id", "ts", "event_type")
        plans = [physical_plan(add_row_id(ev, "dense", order_by=["ts", "event_id"])), physical_plan(add_row_id(ev, "dense"))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert written == [["_position", "_part", "_place"]]
    for plan in plans:
        lines = plan.splitlines()
        for i, ln in enumerate(lines):
            if "SinglePartition" in ln:
                assert "HashAggregate" in lines[i + 1] and "count(1)" in lines[i + 1], plan
    assert "Join [_position" in plans[0] and "rangepartitioning" not in plans[0]  # the frame is not sorted
    assert "_position" not in plans[1]


def test_dense_ids_of_a_shuffled_frame(spark):
    """Positions of such an input can change, so it is written first."""
    from trip_engine.operators.ids import is_narrow
    ev = fx.table(spark, SF_SMALL, "events").select("event_id", "ts")
    assert is_narrow(ev.where("event_id % 3 = 0"))
    mixed = ev.repartition(5, "ts")
    assert not is_narrow(mixed) and not is_narrow(ev.limit(10))
    ours = add_row_id(mixed, "dense", order_by=["ts", "event_id"], col="rid")
    ref = ev.withColumn("rid", F.row_number().over(Window.orderBy("ts", "event_id")))
    assert sorted(map(tuple, ours.select("event_id", "rid").collect())) == \
        sorted(map(tuple, ref.select("event_id", "rid").collect()))


def test_keys_of_other_parts_are_other_ids(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("-", "a"), ("", "a"), ("1:a", ""),
                                ("", "1:a")], "x string, y string")
    ids = [r.id for r in add_row_id(df, "key").collect()]
    assert len(set(ids)) == len(ids)
    again = add_row_id(df.repartition(3), "key", ["x", "y"]).collect()
    assert {r.id for r in again} == set(ids)


def test_sparse_rejects_order(spark):
    import pytest
    ev = fx.table(spark, SF_SMALL, "events")
    with pytest.raises(ValueError):
        add_row_id(ev, "sparse", order_by=["ts"])


def test_dense_ordered_hot_key_is_split(spark):
    # a third of the rows share one order value: still spread over partitions
    from pyspark.sql import functions as F
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"), "id")
    out = add_row_id(df, "dense", order_by=["k"], col="rid", num_partitions=6)
    per_part = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_part) < 1000
    ids = sorted(r.rid for r in out.collect())
    assert ids == list(range(1, 3001))
    ks = [r.k for r in out.orderBy("rid").collect()]
    assert ks == sorted(ks)
