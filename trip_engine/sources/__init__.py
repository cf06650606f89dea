from trip_engine.sources.adapters import conform, consolidate
from trip_engine.sources.files import read_csv, read_trips, read_zone_lookup, register_external
from trip_engine.sources.requests import REQUEST_SCHEMA, parse_requests, read_requests

__all__ = ["conform", "consolidate", "read_csv", "read_trips", "read_zone_lookup",
           "register_external", "REQUEST_SCHEMA", "parse_requests", "read_requests"]
