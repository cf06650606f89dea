"""The SQL model chain as Spark views and tables (OP-82, OP-83, OP-84).

Users of the SQL models can keep querying the same relation names with
``spark.sql``: as views of the catalog, SQL text over its tables
(``create_airport_views``), or as views of the session, DataFrames built by the
operators (``register_airport_views``; the size-checked broadcast and the one-scan
cube apply). The prediction chain is materialised as tables like the original models.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from trip_engine.operators import airports as ap
from trip_engine.operators.features import trip_features
from trip_engine.operators.filters import select_zones
from trip_engine.operators.ids import add_row_id
from trip_engine.operators.model import predict_durations
from trip_engine.operators.sinks import publish_table, publish_view
from trip_engine.plans.broadcast import fits_broadcast
from trip_engine.specs import TRIP_COLUMNS, FeatureConfig, SourceSpec, ZoneSpec

# fixed values: the names of the original relations
AIRPORT_VIEWS = ("trips", "airport_pickups", "airport_dropoffs", "airport_trips",
                 "aggregated_pickup_insights_by_hod", "aggregated_pickup_insights_by_dow",
                 "aggregated_dropoff_insights_by_hod", "aggregated_dropoff_insights_by_dow",
                 "aggregated_trip_insights_by_hod", "aggregated_trip_insights_by_dow")


def register_airport_views(trips: DataFrame, lookup: DataFrame,
                           spec: ZoneSpec = ZoneSpec(), id_mode: str = "key") -> dict[str, DataFrame]:
    """Views of the airport chain: trips, impressions and the six reports
    (the reports are rolled up from one cube, not from the impressions). Trips
    without an ``id`` get one (``id_mode`` of ``add_row_id``), which the impressions
    carry on."""
    if "id" not in trips.columns:
        trips = add_row_id(trips, id_mode)
    zones = select_zones(lookup, spec=spec)
    small = fits_broadcast(zones, spec.max_broadcast_rows)  # checked once for all views
    pickups = ap.zone_impressions(trips, zones, "pickup", spec, broadcast=small, one_pass=False)
    dropoffs = ap.zone_impressions(trips, zones, "dropoff", spec, broadcast=small, one_pass=False)
    cube = ap.airport_cube(trips, zones, spec, broadcast=small)
    frames = {"trips": trips, "airport_pickups": pickups, "airport_dropoffs": dropoffs,
              "airport_trips": ap.airport_trips(pickups, dropoffs)}
    for kind, name in (("pickup", "pickup"), ("dropoff", "dropoff"), ("all", "trip")):
        for by, suffix in (("hour_of_day", "hod"), ("day_of_week", "dow")):
            frames[f"aggregated_{name}_insights_by_{suffix}"] = ap.cube_report(cube, kind, by)
    for name, df in frames.items():
        publish_view(df, name)
    return frames


# An eleventh view, which the six reports are rolled up from.
COUNTS_VIEW = "airport_counts"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def airport_view_sql(sources: Mapping[str, SourceSpec], lookup: str, spec: ZoneSpec = ZoneSpec(),
                     prefix: str = "") -> dict[str, str]:
    """The airport chain as SQL text: view name -> query over catalog tables
    (``sources``: table name -> layout; ``lookup``: the zone lookup's table).

    Impressions are an inner join to the selected zones and the zones that no trip
    reached, so a small lookup can be broadcast; the reports come from counts per
    zone key, hour and weekday, which are aggregated before they meet the lookup."""
    v = {name: f"{prefix}{name}" for name in (*AIRPORT_VIEWS, COUNTS_VIEW)}
    zones = (f"(SELECT `{spec.key}` AS zone_key, `{spec.name}` AS airport FROM {lookup} "
             f"WHERE `{spec.name}` IN ({', '.join(map(_literal, spec.names))}))")
    conformed = "\nUNION ALL ".join(
        f"SELECT `{s.pickup}` AS pickup_datetime, `{s.dropoff}` AS dropoff_datetime, `{s.pu}` AS PULocationID, "
        f"`{s.do}` AS DOLocationID, {_literal(s.label)} AS source FROM {table}" for table, s in sources.items())
    parts = ", ".join(f"coalesce(concat(octet_length(CAST({c} AS STRING)), ':', CAST({c} AS STRING)), '-')"
                      for c in (*TRIP_COLUMNS, "source"))
    sql = {"trips": f"SELECT md5(concat({parts})) AS id, * FROM ({conformed})"}
    for kind, (ts, loc) in ap.KINDS.items():
        sql[f"airport_{kind}s"] = f"""
SELECT t.id, t.{ts} AS impression_datetime, t.source, z.airport, hour(t.{ts}) AS hour_of_day,
       dayofweek(t.{ts}) AS day_of_week
FROM {v['trips']} t JOIN {zones} z ON t.{loc} = z.zone_key
UNION ALL
SELECT NULL, NULL, NULL, z.airport, NULL, NULL
FROM {zones} z LEFT ANTI JOIN (SELECT DISTINCT {loc} FROM {v['trips']}) s ON z.zone_key = s.{loc}"""
    sql["airport_trips"] = f"SELECT * FROM {v['airport_pickups']} UNION ALL SELECT * FROM {v['airport_dropoffs']}"
    ends = ", ".join(f"named_struct('kind', '{k}', 'ts', {ts}, 'zone_key', {loc})" for k, (ts, loc) in ap.KINDS.items())
    kinds = ", ".join(f"'{k}'" for k in ap.KINDS)
    sql[COUNTS_VIEW] = f"""
SELECT k.kind, k.airport, c.hour_of_day, c.day_of_week, coalesce(c.trip_count, 1) AS trip_count
FROM (SELECT zone_key, airport, explode(array({kinds})) AS kind FROM {zones}) k
LEFT JOIN (SELECT kind, zone_key, hour(ts) AS hour_of_day, dayofweek(ts) AS day_of_week, count(*) AS trip_count
           FROM (SELECT inline(array({ends})) FROM {v['trips']})
           GROUP BY kind, zone_key, hour(ts), dayofweek(ts)) c
  ON k.kind = c.kind AND k.zone_key = c.zone_key"""
    for name, kind in (("pickup", "pickup"), ("dropoff", "dropoff"), ("trip", None)):
        for suffix, by in (("hod", "hour_of_day"), ("dow", "day_of_week")):
            where = f" WHERE kind = '{kind}'" if kind else ""
            sql[f"aggregated_{name}_insights_by_{suffix}"] = (
                f"SELECT airport, {by}, sum(trip_count) AS trip_count FROM {v[COUNTS_VIEW]}{where} GROUP BY airport, {by}")
    return {v[name]: text for name, text in sql.items()}


def create_airport_views(spark: SparkSession, sources: Mapping[str, SourceSpec], lookup: str,
                         spec: ZoneSpec = ZoneSpec(), prefix: str = "") -> list[str]:
    """OP-82: the chain as views of the catalog. They outlast the session, answer to
    every session of the catalog, and follow their tables; existing ones are
    replaced. Returns the names, in the order of their dependence."""
    for name, text in (views := airport_view_sql(sources, lookup, spec, prefix)).items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
    return [*views]


def materialise_predictions(train_raw: DataFrame, test_raw: DataFrame, model: PipelineModel,
                            cfg: FeatureConfig = FeatureConfig(impute=False),
                            prefix: str = "") -> None:
    """Tables of the prediction chain: enriched training / testing trips and
    the rounded predictions, with comments and labels."""
    labels = {"status": "experimental", "interval": "daily"}
    publish_table(trip_features(train_raw, cfg), f"{prefix}enriched_training_trips",
                  comment="training trips with model features", labels=labels)
    test = trip_features(test_raw, cfg)
    publish_table(test, f"{prefix}enriched_testing_trips",
                  comment="testing trips with model features", labels=labels)
    publish_table(predict_durations(model, test, "round"), f"{prefix}trip_duration_prediction",
                  comment="predicted trip duration per trip id",
                  column_comments={"trip_duration": "predicted duration in seconds"},
                  labels=labels)
