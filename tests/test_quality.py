"""Quality tests: unique / not_null / contracts against FIXTURES B6."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from trip_engine import fixtures as fx
from trip_engine import registry as reg
from trip_engine.operators import quality as qa


def test_unique_holds(spark):
    assert qa.check_unique(fx.table(spark, SF_SMALL, "orders"), "o_orderkey").count() == 0
    assert qa.check_unique(fx.table(spark, SF_SMALL, "events"), "event_id").count() == 0
    assert qa.check_unique(fx.zone_lookup(spark, SF_SMALL), "LocationID").count() == 0


def test_unique_fails_with_surplus(spark):
    s = qa.unique_summary(fx.table(spark, SF_SMALL, "lineitem"),
                          ["l_orderkey", "l_linenumber"]).first()
    assert s.surplus_rows == 14168 and s.failures > 0


def test_not_null_counts(spark):
    got = {r.column_name: r.failures for r in qa.check_not_null(
        fx.duration_trips(spark, SF_SMALL), ["pickup_latitude", "store_and_fwd_flag", "id"]).collect()}
    assert got == {"pickup_latitude": 300, "store_and_fwd_flag": 5088, "id": 0}


def test_composite_key_holds_where_single_fails(spark):
    res = {(r.column_name, r.test): r for r in
           reg.QUERIES["check_unique_composite"](spark, SF_SMALL).collect()}
    assert res[("hour_of_day", "unique")].failures > 0
    assert not res[("hour_of_day", "unique")].passed
    assert res[("airport,hour_of_day", "unique")].failures == 0
    assert res[("airport,hour_of_day", "unique")].passed


def test_null_keys_not_checked(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,)], "k int")
    assert qa.check_unique(df, "k").count() == 1


def test_contract_shape(spark):
    out = qa.run_contract(fx.zone_lookup(spark, SF_SMALL), qa.ZONE_LOOKUP_CONTRACT, "zones")
    rows = out.collect()
    assert len(rows) == 5 and all(r.passed for r in rows)


def test_contract_reads_a_table_once_and_equals_single_tests(spark):
    from trip_engine.plans.inspect import physical_plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical_plan(qa.run_contract(reg.trips(spark, SF_SMALL), qa.TRIPS_CONTRACT, "trips"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("lineitem.parquet") == 3  # one per source, in the second step too
    df = spark.createDataFrame([(None, 1.5, "a"), (1, -0.0, "a"), (1, 0.0, None), (2, 0.0, "b"), (None, None, "b")],
                               "k int, d double, s string")
    contract = (("k", "unique"), ("k", "not_null"), ("d", "unique"), (("d", "s"), "unique"), ("s", "not_null"),
                (("k", "d", "s"), "unique"))
    got = {(r.column_name, r.test): r.failures for r in qa.run_contract(df, contract, "t").collect()}
    for key, test in contract:
        name = key if isinstance(key, str) else ",".join(key)
        want = (qa.unique_summary(df, key).first().failures if test == "unique"
                else df.where(F.col(key).isNull()).count())
        assert got[name, test] == want, (key, test)


def test_contract_on_an_empty_table(spark):
    out = qa.run_contract(fx.zone_lookup(spark, SF_SMALL).limit(0), qa.ZONE_LOOKUP_CONTRACT, "zones").collect()
    assert len(out) == 5 and all(r.failures == 0 and r.passed for r in out)


def test_keys_differ_by_a_microsecond_a_type_or_a_separator(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)
    rows = [(t, "a|b", "c"), (t + dt.timedelta(microseconds=1), "a", "b|c"), (t, "ab", "c")]
    df = spark.createDataFrame(rows, "t timestamp_ntz, x string, y string")
    contract = (("t", "unique"), (("x", "y"), "unique"), (("t", "x"), "unique"))
    got = {r.column_name: r.failures for r in qa.run_contract(df, contract, "t").collect()}
    assert got == {"t": 1, "x,y": 0, "t,x": 0}
    assert qa.check_unique(df, ["x", "y"]).count() == 0 and qa.check_unique(df, "t").first().n_records == 2


def test_equal_hashes_are_no_failure(spark, monkeypatch):
    """Every key gets one of two hashes: the second step tells them apart."""
    monkeypatch.setattr(qa, "_hash", lambda *parts: F.pmod(F.xxhash64(*parts), F.lit(2)) * 2 ** 40)
    rows = [(i % 9, f"v{i % 5}", i / 3) for i in range(40)] + [(None, "v1", 0.0), (None, None, -0.0)]
    df = spark.createDataFrame(rows, "k int, s string, d double")
    contract = (("k", "unique"), ("s", "unique"), ("d", "unique"), (("k", "s"), "unique"), (("s", "k"), "unique"),
                ("s", "not_null"), ("k", "not_null"))
    got = {(r.column_name, r.test): r.failures for r in qa.run_contract(df, contract, "t").collect()}
    for key, test in contract:
        cols = [key] if isinstance(key, str) else list(key)
        want = df.where(F.col(cols[0]).isNull()).count() if test == "not_null" else \
            df.dropna(subset=cols).groupBy(*cols).count().where("count > 1").count()
        assert got[",".join(cols), test] == want, (key, test)
    assert qa.check_unique(df, ["k", "s"]).count() == got["k,s", "unique"]


def test_both_joins_of_the_second_step_agree(spark, monkeypatch):
    t = reg.trips(spark, SF_SMALL)
    few = {(r.column_name, r.test): r.failures for r in qa.run_contract(t, qa.TRIPS_CONTRACT, "t").collect()}
    monkeypatch.setattr(qa, "MAX_BROADCAST_HASHES", 0)
    assert {(r.column_name, r.test): r.failures for r in qa.run_contract(t, qa.TRIPS_CONTRACT, "t").collect()} == few


def test_the_first_step_shuffles_numbers_only(spark, monkeypatch):
    from trip_engine.plans.inspect import physical_plan
    plans = []

    def keep(df, name):
        plans.append(physical_plan(df))
        return spark.createDataFrame([], df.schema)
    monkeypatch.setattr(qa, "write_scratch", keep)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        qa.run_contract(reg.trips(spark, SF_SMALL), qa.TRIPS_CONTRACT, "t")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plans[0].splitlines()
    at = [i for i, x in enumerate(lines) if "Exchange" in x]
    assert len(at) == 1 and "HashAggregate(keys=[code" in lines[at[0] + 1]


def test_repeated_narrow_keys_need_no_second_step(spark, monkeypatch):
    """Keys of one narrow column are counted in the first step; where many wide keys
    repeat, the second step counts them without a join by hash."""
    from trip_engine.plans.inspect import physical_plan
    rows = [(i // 2, f"v{i % 100}") for i in range(200)] + [(None, "v1"), (2 ** 63 - 1, None), (2 ** 63 - 1, "x")]
    df = spark.createDataFrame(rows, "k long, s string")
    narrow = qa.run_contract(df, (("k", "unique"), (("k", "s"), "unique"), ("k", "not_null")), "t")
    assert "slot0" not in physical_plan(narrow)
    assert [r.failures for r in narrow.orderBy("column_name", "test").collect()] == [1, 101, 0]
    wide = (("s", "unique"), (("s", "k"), "unique"), (("k", "s"), "unique"))
    for most in (0, 50, 10 ** 6):
        monkeypatch.setattr(qa, "MAX_BROADCAST_HASHES", most)
        out = qa.run_contract(df.union(df.limit(3)), wide, "t")
        assert {r.column_name: r.failures for r in out.collect()} == {"s": 100, "s,k": 3, "k,s": 3}
    monkeypatch.setattr(qa, "MAX_BROADCAST_HASHES", 0)
    assert "LeftSemi" not in physical_plan(qa.run_contract(df.union(df.limit(3)), wide, "t"))
    assert qa.unique_summary(df.union(df.limit(3)), ["k", "s"]).first().failures == 3
