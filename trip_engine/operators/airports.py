"""Airport impressions and reports (OP-30, 31, 40..46, 51, 52).

The original answer is ``trips RIGHT JOIN lookup``: every trip that starts
(or ends) in a zone of interest, plus one all-NULL row for a zone without
trips. Spark can only broadcast the *left* side of a right outer join, i.e.
the trip table, or it shuffles every trip. Here the small, size-checked
lookup is broadcast into an inner join (trips never leave their partition
before the partial aggregate) and the unmatched lookup rows are added back
from the few matched keys. (``zone_impressions`` writes the matched rows once and
reads those keys from there.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.functions.exprs import day_of_week, hour_of_day
from trip_engine.plans.broadcast import fits_broadcast
from trip_engine.session import write_scratch
from trip_engine.sources.adapters import consolidate
from trip_engine.specs import ZoneSpec

KINDS = {"pickup": ("pickup_datetime", "PULocationID"),
         "dropoff": ("dropoff_datetime", "DOLocationID")}
BUCKETS = ("hour_of_day", "day_of_week")


def _zones(zones: DataFrame, spec: ZoneSpec) -> DataFrame:
    return zones.select(F.col(spec.key).alias("_zone_key"), F.col(spec.name).alias("airport"))


def _broadcastable(zones: DataFrame, spec: ZoneSpec) -> bool:
    return fits_broadcast(zones, spec.max_broadcast_rows)


def _kinds(kind: str) -> list[str]:
    if kind == "all":
        return list(KINDS)
    if kind not in KINDS:
        raise ValueError(f"kind must be 'pickup', 'dropoff' or 'all', got {kind!r}")
    return [kind]


def _as_impressions(trips: DataFrame, kinds: list[str], keep: list[str],
                    with_payload: bool = True) -> DataFrame:
    """(_kind, _loc[, impression_datetime, kept columns, source]) per trip and
    kind; several kinds come from one generator, i.e. one scan."""
    def cols(k):
        ts, loc = KINDS[k]
        out = [F.lit(k).alias("_kind"), F.col(loc).alias("_loc")]
        if with_payload:
            out += [F.col(ts).alias("impression_datetime"), *[F.col(c) for c in keep],
                    F.col("source")]
        return out
    if len(kinds) == 1:
        return trips.select(*cols(kinds[0]))
    return trips.select(F.inline(F.array(*[F.struct(*cols(k)) for k in kinds])))


def zone_impressions(trips: DataFrame, zones: DataFrame, kind: str = "pickup",
                     spec: ZoneSpec = ZoneSpec(), broadcast: bool | None = None,
                     one_pass: bool = True) -> DataFrame:
    """OP-30 / OP-31 / OP-51: one row per trip starting ('pickup') or ending
    ('dropoff') in a selected zone - or both kinds, 'all' - plus one row with
    NULL trip fields per zone (and kind) without trips.

    Output: [id,] impression_datetime, source, airport, hour_of_day, day_of_week.
    ``zones`` should already be filtered to the zones of interest (OP-25).
    'all' reads the trips once for both kinds (a generator, not a union of
    two scans). The trips' impressions are written to the session's scratch folder
    first, and the zones they reached are read from there, so the trips themselves are
    scanned once. ``one_pass=False`` writes nothing and finds the reached zones in a
    second pass over the key columns (for views, which are evaluated anew)."""
    kinds = _kinds(kind)
    z = _zones(zones, spec)
    keep = (["id"] if "id" in trips.columns else [])
    if broadcast is None:
        broadcast = _broadcastable(zones, spec)
    matched = reached_impressions(trips, zones, kind, spec, broadcast)
    if one_pass:
        matched = write_scratch(matched, "impressions")
        seen = matched.select("_kind", "_zone_key").distinct()
    else:
        # (kind, zone) pairs some trip reached: one narrow pass over the key columns
        keys = z.select(F.col("_zone_key").alias("_loc"))
        seen = (_as_impressions(trips, kinds, keep, with_payload=False)
                .distinct()  # a row per kind and location before any join
                .join(F.broadcast(keys) if broadcast else keys, "_loc", "left_semi")
                .select("_kind", F.col("_loc").alias("_zone_key")))
    wanted = z.select("_zone_key", "airport",
                      F.explode(F.array(*[F.lit(k) for k in kinds])).alias("_kind"))
    unmatched = wanted.join(seen, ["_kind", "_zone_key"], "left_anti")
    types = dict(matched.dtypes)
    for c in ["impression_datetime", *keep, "source"]:
        unmatched = unmatched.withColumn(c, F.lit(None).cast(types[c]))
    return _impression_columns(matched, keep).unionByName(_impression_columns(unmatched, keep))


def reached_impressions(trips: DataFrame, zones: DataFrame, kind: str, spec: ZoneSpec, broadcast: bool) -> DataFrame:
    """The trips' impressions with their kind and zone key: an inner join instead of
    the literal right join, as AQE can split a hot zone of an inner join, not of an
    outer one."""
    z = _zones(zones, spec)
    keep = (["id"] if "id" in trips.columns else [])
    return _as_impressions(trips, _kinds(kind), keep).join(
        F.broadcast(z) if broadcast else z, F.col("_loc") == F.col("_zone_key"), "inner").drop("_loc")


def _impression_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    ts = F.col("impression_datetime")
    return df.select(*keep, ts, "source", "airport", hour_of_day(ts).alias("hour_of_day"),
                     day_of_week(ts).alias("day_of_week"))


def airport_trips(pickups: DataFrame, dropoffs: DataFrame) -> DataFrame:
    """OP-51: pickups UNION ALL dropoffs."""
    return consolidate(pickups, dropoffs)


def _count(unmatched: str):
    # 'keep': count(*) counts the NULL row of a zone without trips (as the
    # original reports do); 'zero': count only real trips (source is set on
    # every conformed trip and NULL on the added lookup row).
    if unmatched == "keep":
        return F.count(F.lit(1))
    if unmatched == "zero":
        return F.count("source")
    raise ValueError(f"unmatched must be 'keep' or 'zero', got {unmatched!r}")


def airport_report(impressions: DataFrame, by: str = "hour_of_day", unmatched: str = "keep",
                   ordered: bool = True) -> DataFrame:
    """OP-40..45 (+ OP-52): trip count per airport and hour of day or day of week."""
    if by not in BUCKETS:
        raise ValueError(f"by must be one of {BUCKETS}, got {by!r}")
    out = impressions.groupBy("airport", by).agg(_count(unmatched).alias("trip_count"))
    return out.orderBy("airport", by) if ordered else out


def zone_report(trips: DataFrame, zones: DataFrame, kind: str = "pickup", by: str = "hour_of_day",
                spec: ZoneSpec = ZoneSpec(), unmatched: str = "keep", ordered: bool = True) -> DataFrame:
    """One report straight from the trips (OP-40..45 + OP-52): the cube of the
    kinds it needs, rolled up. The trips are scanned once and meet the lookup
    as aggregates."""
    return cube_report(airport_cube(trips, zones, spec, unmatched, kinds=_kinds(kind)), kind, by, ordered)


def airport_cube(trips: DataFrame, zones: DataFrame, spec: ZoneSpec = ZoneSpec(),
                 unmatched: str = "keep", broadcast: bool | None = None,
                 kinds: Sequence[str] = tuple(KINDS)) -> DataFrame:
    """OP-46: all six reports' counts from one scan of the trips.

    Each trip yields its pickup and its dropoff impression (a generator, no
    second scan). Impressions are aggregated per zone key before anything is
    shuffled; a lookup small enough to broadcast drops the others before
    that. Zone names join the aggregate by key alone, so a NULL name or a
    duplicate lookup row counts as the literal right join counts it. Output:
    kind, airport, hour_of_day, day_of_week, trip_count - at most
    2 x zones x 24 x 7 rows, cheap to cache and roll up."""
    z = _zones(zones, spec)
    imp = trips.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(KINDS[k][0]).alias("ts"), F.col(KINDS[k][1]).alias("_zone_key"))
        for k in kinds])))
    if broadcast is None:
        broadcast = _broadcastable(zones, spec)
    if broadcast:
        imp = imp.join(F.broadcast(z.select("_zone_key")), "_zone_key", "left_semi")
    matched = (imp.groupBy("kind", "_zone_key", hour_of_day("ts").alias("hour_of_day"),
                           day_of_week("ts").alias("day_of_week"))
               .agg(F.count(F.lit(1)).alias("trip_count")))
    if unmatched not in ("keep", "zero"):
        raise ValueError(f"unmatched must be 'keep' or 'zero', got {unmatched!r}")
    # Lookup rows no impression of a kind reached come from joining the
    # lookup (x2 kinds) to the aggregate - a few hundred rows on both sides -
    # so the trips are scanned once. n_rows keeps duplicate lookup rows exact.
    wanted = (z.select("_zone_key", "airport", F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"))
              .groupBy("kind", "_zone_key", "airport").agg(F.count(F.lit(1)).alias("_n_rows")))
    joined = wanted.join(matched, ["kind", "_zone_key"], "left")
    unmatched_count = F.col("_n_rows") if unmatched == "keep" else F.lit(0).cast("long")
    return (joined
            .select("kind", "airport", "hour_of_day", "day_of_week",
                    F.coalesce(F.col("trip_count") * F.col("_n_rows"), unmatched_count)
                    .alias("trip_count"))
            .groupBy("kind", "airport", "hour_of_day", "day_of_week")
            .agg(F.sum("trip_count").alias("trip_count")))


def cube_report(cube: DataFrame, kind: str = "pickup", by: str = "hour_of_day",
                ordered: bool = True) -> DataFrame:
    """Roll one of the six reports up from ``airport_cube`` (kind 'all' sums
    pickups and dropoffs, as pickups UNION ALL dropoffs would)."""
    if by not in BUCKETS:
        raise ValueError(f"by must be one of {BUCKETS}, got {by!r}")
    src = cube if kind == "all" else cube.filter(F.col("kind") == kind)
    out = src.groupBy("airport", by).agg(F.sum("trip_count").cast("long").alias("trip_count"))
    return out.orderBy("airport", by) if ordered else out


def airport_reports(trips: DataFrame, zones: DataFrame, spec: ZoneSpec = ZoneSpec(),
                    unmatched: str = "keep") -> dict[str, DataFrame]:
    """The six reports of the airport job, all from one cached cube. Release
    it with ``release_reports`` once the reports are written."""
    cube = airport_cube(trips, zones, spec, unmatched).cache()
    _cubes.append(cube)
    return {f"{prefix}_by_{'hour' if by == 'hour_of_day' else 'weekday'}":
            cube_report(cube, kind, by)
            for prefix, kind in (("pickups", "pickup"), ("dropoffs", "dropoff"), ("trips", "all"))
            for by in BUCKETS}


_cubes: list[DataFrame] = []


def release_reports() -> None:
    """Unpersist the cubes behind the reports handed out so far."""
    while _cubes:
        _cubes.pop().unpersist()
