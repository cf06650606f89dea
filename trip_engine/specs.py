"""Declarative settings: source layouts, zone selection, feature set.

Fixed values that must equal the original jobs' (names, codes, constants)
are kept together below, as plain text, in their natural order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
# Zones of interest in the city lookup.
AIRPORT_ZONES = ("LaGuardia Airport", "JFK Airport")
# Ride-hailing licence code -> service name (other codes pass through).
SERVICE_NAMES = {"HV0003": "Uber", "HV0005": "Lyft"}
# Earth radius per distance unit.
EARTH_RADIUS = {"km": 6371.0, "mi": 3959.0}
# Default distance rounding (decimals) of the batch feature job.
DISTANCE_SCALE = 4
# Map sample: size and seed.
MAP_SAMPLE_SIZE = 50000
MAP_SAMPLE_SEED = 42
# Scoring request: id plus the seven model features, and the reject text.
REQUEST_ID = "id"
MODEL_FEATURES = ("vendor_id", "passenger_count", "store_and_fwd_flag",
                  "day", "hour", "month", "distance")
MISSING_KEY_MESSAGE = "Missing feature or id: {key}"
LABEL = "trip_duration"
# ---------------------------------------------------------------------------

# Common trip columns every source is conformed to.
TRIP_COLUMNS = ("pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID")


@dataclass(frozen=True)
class SourceSpec:
    """How one trip source names the four common columns, and its label."""

    label: str
    pickup: str = "pickup_datetime"
    dropoff: str = "dropoff_datetime"
    pu: str = "PULocationID"
    do: str = "DOLocationID"

    def renames(self) -> dict[str, str]:
        return {self.pickup: "pickup_datetime", self.dropoff: "dropoff_datetime",
                self.pu: "PULocationID", self.do: "DOLocationID"}


RIDE_HAILING = SourceSpec("ride_hailing")
GREEN = SourceSpec("green", "lpep_pickup_datetime", "lpep_dropoff_datetime")
YELLOW = SourceSpec("yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime")


@dataclass(frozen=True)
class ZoneSpec:
    """Zone lookup layout and the zones to report on."""

    key: str = "LocationID"
    name: str = "Zone"
    names: tuple[str, ...] = AIRPORT_ZONES
    # Largest lookup (rows) that is broadcast; above it the join shuffles.
    max_broadcast_rows: int = 1_000_000


@dataclass(frozen=True)
class FeatureConfig:
    """Feature frame options; defaults follow the SQL dialect."""

    unit: str = "km"                 # T3: 'km' | 'mi'
    clamp: bool = True               # T4: clamp acos argument, NULL guard always on
    scale: int | None = DISTANCE_SCALE   # T5: decimals, None = no rounding
    method: str = "cosines"          # 'cosines' (original) | 'haversine'
    flag_unknown: int | None = None  # T8: value for flags other than Y/N
    impute: bool = True              # T7: fill missing distance with a mean
    features: tuple[str, ...] = MODEL_FEATURES
    label: str = LABEL
    coords: tuple[str, str, str, str] = field(default=(
        "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"))
