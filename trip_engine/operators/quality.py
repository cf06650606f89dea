"""Table data-quality tests (OP-60..63).

Each test reports how many records violate it instead of stopping a run, so
tests that cannot hold on real data (several of the original column tests)
are visible with their size. Keys with a NULL part are not checked for
uniqueness (SQL UNIQUE semantics: NULLs are distinct).

Keys of one narrow column are counted as they are. Wider keys are tested in two steps.
The first shuffles one number a key: its 64-bit hash (a contract's test number in the
upper bits) with the count of its task. Only hashes that came twice can hide a
repeated key; the second step compares the keys behind those, typed and whole, so a
collision of hashes is no failure and a microsecond, a type or a separator inside a
text makes a difference. The second step passes over tests without repeated hashes, and
where there are too many to broadcast it counts all keys, each shuffled once. A
table whose wide keys are unique is read once and its keys are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_engine.session import write_scratch

# Repeated hashes (8 bytes each) that are broadcast to the second step; beyond, it counts
# every key: a join by hash would shuffle them all once more.
MAX_BROADCAST_HASHES = 1_000_000
# Types whose values are no longer than their hash.
_NARROW = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")

Key = str | Sequence[str]


def _cols(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _typed(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """The key's parts; adding 0 makes -0.0 the 0.0 it equals."""
    types = dict(df.dtypes)
    return [F.col(c) + 0 if types[c] in ("float", "double") else F.col(c) for c in cols]


def _present(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def _hash(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def check_unique(df: DataFrame, key: Key) -> DataFrame:
    """OP-60 / OP-63: the key values occurring more than once, with their
    record count ``n_records``. Partial aggregation before the shuffle keeps
    a hot key cheap; no group is ever gathered. A key wider than its hash is tested in
    two steps (a first job finds the repeated hashes)."""
    cols = _cols(key)
    types = dict(df.dtypes)
    rows = df.filter(_present(cols))
    if len(cols) > 1 or types[cols[0]] not in _NARROW:
        rows = rows.withColumn("__hash", _hash(*_typed(df, cols)))
        suspects = write_scratch(rows.groupBy("__hash").count().where("count > 1").select("__hash"), "repeated-keys")
        if suspects.count() <= MAX_BROADCAST_HASHES:
            rows = rows.join(F.broadcast(suspects), "__hash", "left_semi")
    return (rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def unique_summary(df: DataFrame, key: Key) -> DataFrame:
    """One row: duplicated key values (``failures``) and surplus records."""
    dups = check_unique(df, key)
    return dups.agg(F.count(F.lit(1)).alias("failures"),
                    F.coalesce(F.sum(F.col("n_records") - 1), F.lit(0).cast("long"))
                    .alias("surplus_rows"))


def check_not_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """OP-61: NULL count per column, all columns in one scan.
    Output: column_name, failures."""
    cols = list(columns if columns is not None else df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "failures")


def run_contract(df: DataFrame, contract: Sequence[tuple[Key, str]], table: str) -> DataFrame:
    """OP-62: every test of a table as one result frame:
    table_name, column_name, test, failures, passed.

    The table is read once for all tests, a second time only if a hash came twice. Each
    record yields one number (a narrow key: its test's number and the key) per unique
    test whose key is complete, and one per not_null test it violates; they are
    counted before the shuffle (a hot key collapses there). The first step runs when
    the frame is built, and what it suspects is kept in the session's scratch folder."""
    if not contract:
        raise ValueError("empty contract")
    for _, test in contract:
        if test not in ("unique", "not_null"):
            raise ValueError(f"unknown test {test!r}")
    expanded = [(c, t) for key, t in contract for c in (_cols(key) if t == "not_null" else [key])]
    expanded = list(dict.fromkeys((c if isinstance(c, str) else tuple(c), t) for c, t in expanded))
    bits = max(1, (len(expanded) - 1).bit_length())

    def numbered(number: int, value: Column) -> Column:
        """The test's number in the upper bits, the hash's upper bits below."""
        return F.shiftleft(F.lit(number).cast("long"), 64 - bits).bitwiseOR(F.shiftrightunsigned(value, bits))

    types = dict(df.dtypes)
    # a key of one narrow column is counted as it is, in the slot of its type
    exact = {i: types[_cols(k)[0]] for i, (k, t) in enumerate(expanded)
             if t == "unique" and len(_cols(k)) == 1 and types[_cols(k)[0]] in _NARROW}
    values = {t: f"value{i}" for i, t in enumerate(dict.fromkeys(exact.values()))}
    first, wide = [], {}
    for number, (key, test) in enumerate(expanded):
        cols = _cols(key)
        plain = test == "not_null" or number in exact
        code = numbered(number, F.lit(0).cast("long") if plain else _hash(*_typed(df, cols)))
        first.append(F.when(~_present(cols) if test == "not_null" else _present(cols), F.struct(
            code.alias("code"), *[(_typed(df, cols)[0] if exact.get(number) == t else F.lit(None)).cast(t).alias(v)
                                  for t, v in values.items()])))
        if not plain:
            wide[number] = code
    number_of = F.shiftrightunsigned("code", 64 - bits).cast("int")

    def one_of(numbers) -> Column:
        return F.get(F.array(*[F.lit(i in numbers) for i in range(len(expanded))]), number_of)

    is_null_test = one_of([i for i, (_, t) in enumerate(expanded) if t == "not_null"])
    counted = df.select(F.inline(F.array_compact(F.array(*first)))) \
        .groupBy("code", *values.values()).agg(F.count(F.lit(1)).alias("n"))
    found = write_scratch(counted.where(is_null_test | (F.col("n") > 1)).select("code", "n"), "contract")
    # a null test has one row, every row of a narrow key is a repeated value
    failures = found.where(~one_of(wide)).groupBy(number_of.alias("test_no")) \
        .agg(F.sum(F.when(is_null_test, F.col("n")).otherwise(1)).alias("failures"))
    suspects = found.where(one_of(wide)).select("code")
    # a row a test: how many of its hashes came twice
    held = sorted((r["n"], r["test_no"]) for r in suspects.groupBy(number_of.alias("test_no"))
                  .agg(F.count(F.lit(1)).alias("n")).collect())
    if held:
        wide = {i: wide[i] for _, i in held}
        few = [i for j, (_, i) in enumerate(held) if sum(n for n, _ in held[:j + 1]) <= MAX_BROADCAST_HASHES]
        slots = list(dict.fromkeys(tuple(types[c] for c in _cols(expanded[i][0])) for i in wide))
        second = []
        for number, code in wide.items():
            cols = _cols(expanded[number][0])
            # one struct of its types holds the whole key, the other slots are null
            whole = F.struct(*[p.alias(f"k{i}") for i, p in enumerate(_typed(df, cols))])
            mine = tuple(types[c] for c in cols)
            second.append(F.when(_present(cols), F.struct(code.alias("code"), *[
                (whole if s == mine else F.lit(None).cast(_struct_type(s))).alias(f"slot{i}")
                for i, s in enumerate(slots)])))
        keys = df.select(F.inline(F.array_compact(F.array(*second))))
        if few:
            hit = suspects.where(one_of(few)).select("code", F.lit(True).alias("hit"))
            keys = keys.join(F.broadcast(hit), "code", "left").where(~one_of(few) | F.col("hit"))
        repeated = keys.groupBy("code", *[f"slot{i}" for i in range(len(slots))]) \
            .agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        failures = failures.unionByName(
            repeated.groupBy(number_of.alias("test_no")).agg(F.count(F.lit(1)).alias("failures")))
    tests = df.sparkSession.createDataFrame(
        [(i, table, ",".join(_cols(k)), t) for i, (k, t) in enumerate(expanded)],
        "test_no int, table_name string, column_name string, test string")
    return (tests.join(F.broadcast(failures), "test_no", "left")  # a row a test
            .select("table_name", "column_name", "test",
                    F.coalesce("failures", F.lit(0).cast("long")).alias("failures"))
            .withColumn("passed", F.col("failures") == 0))


def _struct_type(types: Sequence[str]) -> str:
    return "struct<" + ", ".join(f"k{i}: {t}" for i, t in enumerate(types)) + ">"


# --- the original column tests, as contracts (fixed values) --------------------
ZONE_LOOKUP_CONTRACT = (("LocationID", "unique"), ("LocationID", "not_null"),
                        ("Borough", "not_null"), ("Zone", "not_null"),
                        ("service_zone", "not_null"))
TRIPS_CONTRACT = (("pickup_datetime", "unique"), ("pickup_datetime", "not_null"),
                  ("dropoff_datetime", "unique"), ("dropoff_datetime", "not_null"),
                  ("PULocationID", "not_null"), ("DOLocationID", "not_null"),
                  ("source", "unique"), ("source", "not_null"))
AIRPORT_TRIPS_CONTRACT = (("id", "unique"), ("id", "not_null"),
                          ("impression_datetime", "not_null"), ("source", "not_null"),
                          ("airport", "not_null"))
REPORT_BY_HOUR_CONTRACT = (("hour_of_day", "unique"), ("hour_of_day", "not_null"),
                           ("airport", "not_null"), ("trip_count", "not_null"),
                           # repair: the report's real key
                           (("airport", "hour_of_day"), "unique"))
DURATION_TRIPS_CONTRACT = (("id", "unique"),)
