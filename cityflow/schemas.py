"""Column names and types of the raw documents and the managed tables."""

from __future__ import annotations


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


# --- raw documents (fixed values: field names and types of the landed JSON) ---

LOCATION_DOC = (
    "id bigint, name string, locality string, timezone string, "
    "coordinates struct<latitude: double, longitude: double>, "
    "country struct<code: string>, provider struct<name: string>, "
    "sensors array<struct<id: bigint, parameter: struct<name: string, units: string>>>"
)

GEOCODE_DOC = (
    "address struct<country_code: string, state: string, city: string, county: string, "
    "road: string, neighbourhood: string, suburb: string>"
)

MEASUREMENT_DOC = "period struct<datetimeTo: struct<utc: string, local: string>>, value double"

LATEST_DOC = (
    "datetime struct<utc: string, local: string>, value double, "
    "sensorsId int, locationsId int"
)

WEATHER_DOC = (
    "hourly struct<time: array<string>, temperature_2m: array<double>, "
    "precipitation: array<double>, wind_speed_10m: array<double>>"
)

# --- bronze ---

RAW_TRIPS = {
    "passenger_count": "bigint",
    "trip_distance": "double",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "bigint",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
}
RAW_YELLOW_TRIPS = {
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    **RAW_TRIPS,
}
RAW_GREEN_TRIPS = {
    "lpep_pickup_datetime": "timestamp",
    "lpep_dropoff_datetime": "timestamp",
    **RAW_TRIPS,
}

ZONES = {
    "LocationID": "bigint",
    "Borough": "string",
    "Zone": "string",
    "service_zone": "string",
}

# The exchange-rate CSV has 32 columns (fixed values); four are not text.
_FX_COLUMNS = """
KEY FREQ CURRENCY CURRENCY_DENOM EXR_TYPE EXR_SUFFIX TIME_PERIOD OBS_VALUE
OBS_STATUS OBS_CONF OBS_PRE_BREAK OBS_COM TIME_FORMAT BREAKS COLLECTION
COMPILING_ORG DISS_ORG DOM_SER_IDS PUBL_ECB PUBL_MU PUBL_PUBLIC UNIT_INDEX_BASE
COMPILATION COVERAGE DECIMALS NAT_TITLE SOURCE_AGENCY SOURCE_PUB TITLE TITLE_COMPL
UNIT UNIT_MULT
""".split()
_FX_TYPED = {
    "TIME_PERIOD": "date",
    "OBS_VALUE": "double",
    "DECIMALS": "bigint",
    "UNIT_MULT": "bigint",
}
EXCHANGE_RATES = {name: _FX_TYPED.get(name, "string") for name in _FX_COLUMNS}

RAW_JSON = {"raw_json": "string"}
RAW_GEOCODES = {"lat": "double", "lon": "double", "json_raw": "string"}
RAW_MEASUREMENTS = {"sensor_id": "int", "raw_json": "string"}
RAW_LATEST = {
    "location_id": "int",
    "ingestion_hour": "int",
    "raw_json": "string",
    "ingestion_day": "int",
}
RAW_WEATHER = {"ingestion_hour": "int", "raw_json": "string"}

# --- silver ---

TRIPS = {
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "PULocationID": "int",
    "DOLocationID": "int",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
    "payment_type": "bigint",
    "trip_duration_minutes": "double",
    "taxi_type": "string",
}
# as stored: a partition for each day of pickup, so that the fact reads changed days only
STORED_TRIPS = {**TRIPS, "pickup_day": "int"}
LOCATIONS = {
    "location_id": "int",
    "name": "string",
    "locality": "string",
    "country_code": "string",
    "latitude": "double",
    "longitude": "double",
    "timezone": "string",
    "provider": "string",
    "road": "string",
    "neighbourhood": "string",
    "suburb": "string",
}
SENSORS = {
    "sensor_id": "int",
    "location_id": "int",
    "parameter": "string",
    "unit": "string",
}
MEASUREMENTS = {
    "sensor_id": "int",
    "datetime_utc": "timestamp",
    "datetime_local": "timestamp",
    "value": "double",
}
WEATHER = {
    "ingestion_hour": "int",
    "datetime_local": "timestamp",
    "temperature_c": "double",
    "precipitation_mm": "double",
    "wind_kmh": "double",
}

# --- gold ---

DIM_BOROUGH = {"BoroughID": "int", "BoroughName": "string"}
DIM_DATE = {
    "DateKey": "int",
    "DateValue": "date",
    "Year": "int",
    "MonthNumber": "int",
    "MonthShort": "string",
    "Day": "int",
    "DayOfWeek": "int",
    "DayOfWeekShort": "string",
    "IsWeekend": "int",
}
HOUR_KEY = {"Value": "int"}
FACT_TAXI = {
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "pickup_hour": "int",
    "trip_duration_minutes": "decimal(10,4)",
    "PUBoroughID": "int",
    "DOBoroughID": "int",
    "trip_distance": "double",
    "fare_amount": "decimal(10,2)",
    "tip_amount": "decimal(10,2)",
    "total_amount": "decimal(10,2)",
    "PickupDateKey": "int",
    "DropoffDateKey": "int",
}
FACT_AIR_QUALITY = {
    "BoroughID": "int",
    "DateKey": "int",
    "HourKey": "int",
    "value": "double",
    "parameter": "string",
    "unit": "string",
}
