"""The data contract: table layouts, feature lists and fixed domain values.

Everything here is plain data.  The values are fixed because tables, models and
consumers agree on them; nothing in this module touches Spark.
"""

from __future__ import annotations

# --- fixed values: label, split, geography ---------------------------------
LABEL = "dep_del15"
TRAIN_YEARS = (2022, 2023, 2024)
TEST_YEARS = (2025,)
HOLIDAY_YEARS = (2015, 2025)

# Inclusive box of the continental US: south, west, north, east (degrees).
US_BOX = (24.0, -125.0, 50.0, -66.0)

# --- fixed values: raw flight file column -> table column ------------------
FLIGHT_COLUMNS = {
    "Year": "year",
    "Month": "month",
    "DayofMonth": "day_of_month",
    "DayOfWeek": "day_of_week",
    "FlightDate": "flight_date",
    "Reporting_Airline": "reporting_airline",
    "Flight_Number_Reporting_Airline": "flight_number_reporting_airline",
    "Origin": "origin",
    "Dest": "dest",
    "Distance": "distance",
    "CRSDepTime": "crs_dep_time",
    "CRSArrTime": "crs_arr_time",
    "CRSElapsedTime": "crs_elapsed_time",
    "DepDel15": "dep_del15",
    "DepDelayMinutes": "dep_delay_minutes",
    "ArrDel15": "arr_del15",
    "Cancelled": "cancelled",
    "Diverted": "diverted",
    "CarrierDelay": "carrier_delay",
    "WeatherDelay": "weather_delay",
    "NASDelay": "nas_delay",
    "SecurityDelay": "security_delay",
    "LateAircraftDelay": "late_aircraft_delay",
}

# Stable types of the raw flight table, so that monthly files never drift.
FLIGHT_TYPES = {
    "year": "bigint",
    "month": "bigint",
    "day_of_month": "bigint",
    "day_of_week": "bigint",
    "flight_date": "string",
    "reporting_airline": "string",
    "flight_number_reporting_airline": "string",
    "origin": "string",
    "dest": "string",
    "distance": "bigint",
    "crs_dep_time": "bigint",
    "crs_arr_time": "bigint",
    "crs_elapsed_time": "bigint",
    "dep_del15": "bigint",
    "dep_delay_minutes": "double",
    "arr_del15": "bigint",
    "cancelled": "bigint",
    "diverted": "bigint",
    "carrier_delay": "double",
    "weather_delay": "double",
    "nas_delay": "double",
    "security_delay": "double",
    "late_aircraft_delay": "double",
}

# Known only after departure: kept for reports, never allowed as a feature.
AFTER_THE_FACT = (
    "dep_delay_minutes",
    "arr_del15",
    "cancelled",
    "diverted",
    "carrier_delay",
    "weather_delay",
    "nas_delay",
    "security_delay",
    "late_aircraft_delay",
)

# Raw names that must never reach the feature table.
BANNED_RAW = (
    "DepDelay",
    "DepDelayMinutes",
    "DepTime",
    "TaxiOut",
    "TaxiIn",
    "WheelsOff",
    "WheelsOn",
    "ArrTime",
    "ArrDelay",
    "ArrDelayMinutes",
    "ArrDel15",
    "ActualElapsedTime",
    "AirTime",
    "CarrierDelay",
    "WeatherDelay",
    "NASDelay",
    "SecurityDelay",
    "LateAircraftDelay",
    "Cancelled",
    "CancellationCode",
    "Diverted",
    "DivAirportLandings",
)

# --- fixed values: weather ---------------------------------------------------
# archive variable -> (feature suffix, value used when no weather row matches)
WEATHER = {
    "temperature_2m": ("temp_2m", 15.0),
    "precipitation": ("precip", 0.0),
    "wind_speed_10m": ("wind_speed", 10.0),
    "wind_gusts_10m": ("wind_gusts", 15.0),
    "snowfall": ("snowfall", 0.0),
}
WEATHER_VARS = tuple(WEATHER)
WEATHER_FILL = {suffix: fill for suffix, fill in WEATHER.values()}
# Scoring requests use a calmer wind default than training rows do.
REQUEST_WEATHER_FILL = {**WEATHER_FILL, "wind_speed": 8.0}

# --- fixed values: feature table ---------------------------------------------
CATEGORICAL = (
    "origin",
    "dest",
    "carrier",
    "dep_hour",
    "day_of_week",
    "month",
    "time_of_day_bucket",
)
HISTORY = {
    "route_hist_delay_rate": ("origin", "dest"),
    "origin_hist_delay_rate": ("origin",),
    "carrier_hist_delay_rate": ("carrier",),
}
NUMERIC = (
    "distance",
    "crs_elapsed_time",
    "is_holiday_window",
    *HISTORY,
    *(f"{side}_{suffix}" for side in ("origin", "dest") for suffix in WEATHER_FILL),
)
FEATURES = CATEGORICAL + NUMERIC
IDENTITY = ("flight_date", "carrier", "origin", "dest", "year")
GOLD_COLUMNS = FEATURES + (LABEL,) + tuple(c for c in IDENTITY if c not in FEATURES)

# --- fixed values: silver and staging layouts --------------------------------
SILVER_FLIGHT_COLUMNS = (
    "flight_date",
    "flight_ts",
    "year",
    "month",
    "day_of_week",
    "carrier",
    "flight_number_reporting_airline",
    "origin",
    "dest",
    "dep_hour",
    "time_of_day_bucket",
    "distance",
    "crs_dep_time",
    "crs_arr_time",
    "crs_elapsed_time",
    "is_holiday_window",
    LABEL,
    *AFTER_THE_FACT,
)
STAGED_TYPES = {
    "flight_date": "date",
    "year": "int",
    "month": "int",
    "day_of_week": "int",
    "dep_hour": "int",
    "time_of_day_bucket": "string",
    "carrier": "string",
    "flight_number": "string",
    "origin": "string",
    "dest": "string",
    "distance": "double",
    "crs_dep_time": "int",
    "crs_arr_time": "int",
    "crs_elapsed_time": "double",
    "dep_del15": "int",
    "dep_delay_minutes": "double",
    "arr_del15": "int",
    "cancelled": "int",
    "diverted": "int",
    "carrier_delay": "double",
    "weather_delay": "double",
    "nas_delay": "double",
    "security_delay": "double",
    "late_aircraft_delay": "double",
    "is_holiday_window": "int",
}
SEED_FLIGHT_TYPES = {
    ("flight_number_reporting_airline" if c == "flight_number" else c): t
    for c, t in STAGED_TYPES.items()
}

# --- fixed values: positions ---------------------------------------------------
# state-vector slot -> (field, type)
STATE_SLOTS = {
    0: ("icao24", "string"),
    1: ("callsign", "string"),
    5: ("lon", "double"),
    6: ("lat", "double"),
    7: ("baro_altitude", "double"),
    8: ("on_ground", "boolean"),
    9: ("velocity", "double"),
    10: ("heading", "double"),
    13: ("geo_altitude", "double"),
}
AIRCRAFT_FIELDS = (
    "icao24",
    "callsign",
    "lat",
    "lon",
    "altitude",
    "velocity",
    "heading",
    "on_ground",
)
MESSAGE_SCHEMA = (
    "icao24 string, callsign string, lat double, lon double, altitude double, "
    "velocity double, heading double, on_ground boolean, event_ts bigint"
)
MESSAGE_FIELDS = AIRCRAFT_FIELDS + ("event_ts",)
LIVE_TTL_SECONDS = 300
CACHED_TTL_SECONDS = 86400
FRESH_SECONDS = 120
NEARBY_DEGREES = 1.5

# --- fixed values: airports -----------------------------------------------------
AIRPORT_FILE_SCHEMA = (
    "id string, name string, city string, country string, iata string, icao string, "
    "lat string, lon string, altitude string, utc_offset string, dst string, "
    "zone string, kind string, source string"
)
# Airports in use that the public airport file lacks.
AIRPORT_PATCH = (
    ("XWA", "Williston Basin International Airport", "Williston", 48.2594, -103.7510,
     "America/Chicago"),
)
CARRIER_NAMES = {
    "AA": "American Airlines",
    "AS": "Alaska Airlines",
    "B6": "JetBlue Airways",
    "DL": "Delta Air Lines",
    "UA": "United Airlines",
    "WN": "Southwest Airlines",
    "NK": "Spirit Airlines",
    "F9": "Frontier Airlines",
    "G4": "Allegiant Air",
    "HA": "Hawaiian Airlines",
}

# --- fixed values: scoring -------------------------------------------------------
RISK_EDGES = (0.20, 0.45)
MIN_ROUTE_FLIGHTS = 30
VALID_FRACTION = 0.15
CALIB_FRACTION = 0.15
AUC_FLOOR = 0.55
DEFAULT_DISTANCE_MILES = 800.0
FORECAST_HORIZON_DAYS = 16
PRESET_WEEKDAY = 5
PRESET_HOUR = 17
PRESET_CARRIER = "DL"
