"""Rule sets: bounds, thresholds and naming schemes, one frozen object per variant.

The numbers are fixed values that results depend on. They are kept here, in one place, so
that operators carry no constants of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    """Inclusive latitude/longitude rectangle."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float

    def contains(self, lat, lon) -> Column:
        if isinstance(lat, str) and isinstance(lon, str):
            return F.expr(
                f"{lat} BETWEEN {self.lat_min}D AND {self.lat_max}D"
                f" AND {lon} BETWEEN {self.lon_min}D AND {self.lon_max}D"
            )
        lat, lon = _col(lat), _col(lon)
        return lat.between(self.lat_min, self.lat_max) & lon.between(self.lon_min, self.lon_max)


@dataclass(frozen=True)
class Range:
    """Numeric interval; ``closed`` says whether both ends belong to it."""

    low: float | None
    high: float | None
    closed: bool = True

    def holds(self, value) -> Column:
        value = _col(value)
        tests = []
        if self.low is not None:
            tests.append(value >= self.low if self.closed else value > self.low)
        if self.high is not None:
            tests.append(value <= self.high if self.closed else value < self.high)
        return tests[0] & tests[1] if len(tests) == 2 else tests[0]


@dataclass(frozen=True)
class Grid:
    """Square cells of ``size`` degrees counted from an origin."""

    origin_lat: float
    origin_lon: float
    size: float
    prefix: str | None = "cell"
    lat_column: str = "cell_lat"
    lon_column: str = "cell_lon"
    with_centres: bool = False


@dataclass(frozen=True)
class CellCentres:
    """Affine map from cell index back to coordinates."""

    lat_origin: float
    lat_step: float
    lon_origin: float
    lon_step: float
    offset: float


@dataclass(frozen=True)
class LabelRule:
    """Speed cuts, fastest first: above ``cuts[0]`` is class 0, above ``cuts[1]`` class 1."""

    cuts: tuple[float, float]
    first_inclusive: bool
    second_inclusive: bool
    names: tuple[str, str, str] = ("Low", "Medium", "High")


@dataclass(frozen=True)
class CleanProfile:
    name: str
    box: Box
    grid: Grid
    distance: Range
    speed: Range | None
    duration_s: Range | None = None
    passengers: Range | None = None
    speed_decimals: int | None = None
    weekday: str = "sunday1"
    columns: tuple[str, ...] | None = None


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---- fixed values -------------------------------------------------------------------

CITY_BOX = Box(40.4774, 40.9176, -74.2591, -73.7004)
ZONE_BOX = Box(40.70, 40.88, -74.02, -73.93)
STREAM_ZONE_BOX = Box(40.70, 40.82, -74.02, -73.93)
DOC_BOX = Box(40.5, 40.95, -74.3, -73.7)

# zone rule on cell indexes used by the second-level cell profile
ZONE_CELL_BOX = Box(13, 35, 35, 50)

STATE_CENTRES = CellCentres(40.4855, 0.0096, -74.2567, 0.009928, 0.5)
BRIDGE_CENTRES = CellCentres(40.4855, 0.01, -74.2567, 0.01, 0.0)

RUSH_HOURS = ((7, 9), (17, 19))
NIGHT_START = 22
NIGHT_END_MODEL = 6
NIGHT_END_LEGACY = 5

TRAIN_MONTHS = (1, 2)
TEST_MONTHS = (3,)

CLEAN_COLUMNS = (
    "pickup_datetime", "dropoff_datetime",
    "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon",
    "trip_distance", "duration_hours", "speed_mph",
    "passenger_count", "fare_amount", "total_amount",
    "cell_id", "cell_lat", "cell_lon",
    "hour", "day_of_week", "month", "year",
    "is_manhattan",
)
CLEAN_COLUMNS_V2 = (
    "pickup_datetime", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon",
    "trip_distance", "speed_mph", "hour", "day_of_week", "is_weekend", "is_rush_hour",
    "cell_id", "cell_lat", "cell_lon",
)
REQUIRED_COLUMNS = (
    "pickup_datetime", "dropoff_datetime",
    "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon",
    "trip_distance",
)

FEATURE_COLUMNS = (
    "hour", "day_of_week", "month", "is_weekend", "is_rush_hour", "is_night",
    "cell_lat", "cell_lon", "is_manhattan_int",
    "prev_trip_count", "prev_avg_speed", "prev_congestion_label",
    "prev_2h_trip_count", "prev_2h_avg_speed",
    "historical_avg_trips", "historical_avg_speed",
)
TARGET_COLUMNS = ("congestion_label", "congestion_level", "avg_speed")
METADATA_COLUMNS = ("cell_id", "hour_bucket", "year")
LEGACY_FEATURE_COLUMNS = (
    "hour", "day_of_week", "is_rush_hour", "is_night", "is_weekend",
    "avg_speed", "speed_std", "speed_range", "vehicle_count", "density_score",
    "avg_distance", "avg_duration",
)

# ---- cleaning variants ----------------------------------------------------------------

STANDARD = CleanProfile(
    name="standard",
    box=CITY_BOX,
    grid=Grid(CITY_BOX.lat_min, CITY_BOX.lon_min, 0.01),
    duration_s=Range(60, 10800),
    distance=Range(0.1, 100.0),
    speed=Range(1.0, 60.0),
    speed_decimals=2,
    columns=CLEAN_COLUMNS,
)
LEGACY = CleanProfile(
    name="v1",
    box=CITY_BOX,
    grid=Grid(0.0, 0.0, 0.005, "cell", "cell_lat_idx", "cell_lon_idx", with_centres=True),
    distance=Range(0.1, 100.0, closed=False),
    speed=Range(0.0, 80.0, closed=False),
    weekday="monday0",
)
COMPACT = CleanProfile(
    name="v2",
    box=CITY_BOX,
    grid=Grid(CITY_BOX.lat_min, CITY_BOX.lon_min, 0.01, None),
    distance=Range(0.0, 100.0, closed=False),
    speed=Range(0.0, 60.0, closed=False),
    weekday="monday0",
    columns=CLEAN_COLUMNS_V2,
)
DOCUMENTED = CleanProfile(
    name="doc",
    box=DOC_BOX,
    grid=Grid(CITY_BOX.lat_min, CITY_BOX.lon_min, 0.01),
    duration_s=Range(0, 10800, closed=False),
    distance=Range(0.0, None, closed=False),
    speed=None,
    passengers=Range(1, 9),
    columns=CLEAN_COLUMNS,
)
CLEAN_PROFILES = {p.name: p for p in (STANDARD, LEGACY, COMPACT, DOCUMENTED)}

# ---- label variants -------------------------------------------------------------------

LABELS = LabelRule((20.0, 10.0), first_inclusive=False, second_inclusive=True)
LABELS_LEGACY = LabelRule((20.0, 10.0), False, False, ("low", "medium", "high"))
LABELS_COMPACT = LabelRule((20.0, 10.0), True, True)
LABELS_WINDOW = LabelRule((15.0, 8.0), True, True)

INDEX_CLAMP_BATCH = (0.10, 0.95)
INDEX_CLAMP_LIVE = (0.05, 0.98)

# ---- named zones (name, latitude, longitude, radius in degrees), first match wins -----

LANDMARKS = (
    ("Times Square Area", 40.758, -73.985, 0.01),
    ("Penn Station", 40.750, -73.993, 0.01),
    ("Grand Central", 40.752, -73.977, 0.01),
    ("SoHo District", 40.723, -74.003, 0.01),
    ("Lower Manhattan", 40.71, -74.01, 0.02),
    ("Midtown East", 40.755, -73.970, 0.01),
    ("Midtown West", 40.755, -73.995, 0.01),
    ("Upper East Side", 40.775, -73.960, 0.015),
    ("Upper West Side", 40.785, -73.975, 0.015),
    ("Chelsea", 40.745, -74.000, 0.01),
)

# upper speed bound of each histogram band and its display name
SPEED_BANDS = (
    (5.0, "00-05 mph (Crawling)"),
    (10.0, "05-10 mph (Very Slow)"),
    (15.0, "10-15 mph (Slow)"),
    (20.0, "15-20 mph (Moderate)"),
    (30.0, "20-30 mph (Normal)"),
    (40.0, "30-40 mph (Fast)"),
    (None, "40+   mph (Highway)"),
)
SPEED_BANDS_SHORT = (
    (10.0, "0-10 mph"),
    (20.0, "10-20 mph"),
    (30.0, "20-30 mph"),
    (None, "30+ mph"),
)
DISTANCE_SEGMENTS = (
    (1.0, "0-1 mi"),
    (2.0, "1-2 mi"),
    (5.0, "2-5 mi"),
    (10.0, "5-10 mi"),
    (None, "10+ mi"),
)
SEVERITY_BANDS = ((8.0, "CRITICAL"), (12.0, "HIGH"), (None, "MODERATE"))
DAY_BANDS = ((12.0, "High"), (18.0, "Medium"), (None, "Low"))
HOUR_BANDS = ((10.0, "HIGH"), (20.0, "MEDIUM"), (None, "LOW"))
