import json
from datetime import datetime

import pytest

from cityflow.plans import silver

from .conftest import tuples

RAW = (
    "{p}_pickup_datetime timestamp, {p}_dropoff_datetime timestamp, PULocationID int, "
    "DOLocationID int, passenger_count bigint, trip_distance double, fare_amount double, "
    "tip_amount double, total_amount double, payment_type bigint"
)


def trip(pickup="2024-01-01 10:00:00", dropoff="2024-01-01 10:30:00", pu=1, do=2, n=1, fare=10.0):
    return (pickup, dropoff, pu, do, n, 1.0, fare, 1.0, fare + 1, 1)


@pytest.fixture
def colors(frame):
    green = [
        trip(),
        trip(),
        trip(fare=9.0),
        trip(pu=2, dropoff="2024-01-01 09:30:00"),
        trip(pu=3, n=None),
    ]
    yellow = [trip(), trip(pu=999)]
    return frame(green, RAW.format(p="lpep")), frame(yellow, RAW.format(p="tpep"))


def test_union_keeps_every_row_under_common_names(colors):
    both = silver.all_trips(*colors)
    assert both.count() == 7
    assert both.columns == list(silver.schemas.TRIPS)


def test_trips_are_unique_per_key_and_color(colors):
    trips = silver.taxi_trips(*colors)
    assert tuples(trips, "taxi_type", "PULocationID", "fare_amount", "trip_duration_minutes") == [
        ("green", 1, 9.0, 30.0),
        ("green", 2, 10.0, -30.0),
        ("green", 3, 10.0, 30.0),
        ("yellow", 1, 10.0, 30.0),
        ("yellow", 999, 10.0, 30.0),
    ]


def location(id, lat=40.5, lon=-74.0, **changes):
    doc = {
        "id": id,
        "name": f"place {id}",
        "locality": None,
        "timezone": "America/New_York",
        "coordinates": {"latitude": lat, "longitude": lon},
        "country": {"code": "US"},
        "provider": {"name": "agency"},
        "sensors": [{"id": id * 10, "parameter": {"name": "pm25", "units": "µg/m³"}}],
    }
    doc.update(changes)
    return (json.dumps({k: v for k, v in doc.items() if v is not None}),)


def geocode(lat, lon, **address):
    full = {"country_code": "us", "state": "New York", "city": "New York", **address}
    return (lat, lon, json.dumps({"address": {k: v for k, v in full.items() if v is not None}}))


GEOCODES = [
    geocode(40.5, -74.0, road="B Street", suburb=" The Bronx "),
    geocode(40.5, -74.0, road="A Street", suburb="Queens"),
    geocode(41.0, -74.0, city=None, county="New York County", suburb="Manhattan"),
    geocode(42.0, -74.0, city="Albany"),
    (43.0, -74.0, "{}"),
]
LOCATIONS = [
    location(1),
    location(1),
    location(2, lat=41.0, sensors=None),
    location(3, lat=42.0),
    location(4, lat=43.0),
    location(5, lat=44.0),
    location(6, coordinates=None),
    location(7, coordinates={"latitude": 40.5}),
    location(8, provider=None),
    ("{not json",),
    (None,),
    location(
        9,
        sensors=[
            {"id": 91, "parameter": {"name": "no2", "units": "ppm"}},
            {"id": 92, "parameter": {"name": "o3", "units": "ppm"}},
            {"id": 91, "parameter": {"name": "no2", "units": "ppm"}},
        ],
    ),
]


@pytest.fixture
def raw(frame):
    return (
        frame(LOCATIONS, "raw_json string"),
        frame(GEOCODES, "lat double, lon double, json_raw string"),
    )


def test_city_locations(raw):
    rows = silver.locations(silver.city_documents(*raw))
    assert tuples(rows, "location_id", "road", "suburb", "provider") == [
        (1, "A Street", "Queens", "agency"),
        (2, None, "Manhattan", "agency"),
        (9, "A Street", "Queens", "agency"),
    ]


def test_the_bronx_is_renamed(raw, frame):
    geocodes = frame(GEOCODES[:1], "lat double, lon double, json_raw string")
    rows = silver.locations(silver.city_documents(raw[0], geocodes))
    assert {r.suburb for r in rows.collect()} == {"Bronx"}


def test_sensors(raw):
    rows = silver.sensors(silver.city_documents(*raw))
    assert tuples(rows, "sensor_id", "location_id", "parameter") == [
        (10, 1, "pm25"),
        (91, 9, "no2"),
        (92, 9, "o3"),
    ]


def test_rejects_are_counted(raw):
    counts = silver.rejected_locations(silver.parsed_locations(raw[0]))
    assert tuples(counts) == [
        ("no coordinates", 2),
        ("not JSON", 2),
        ("required field missing", 1),
    ]


def test_strict_mode_stops_at_a_missing_field(raw):
    documents = silver.city_documents(*raw, strict=True)
    with pytest.raises(Exception, match="missing provider.name"):
        silver.locations(documents, strict=True).collect()


def test_measurements_are_unique_per_sensor_and_time(frame):
    def record(sensor, utc, value):
        return (sensor, json.dumps({"period": {"datetimeTo": {"utc": utc}}, "value": value}))

    raw = frame(
        [
            record(1, "2024-11-03T05:00:00Z", 1.0),
            record(1, "2024-11-03T06:00:00Z", 2.0),
            record(1, "2024-11-03T06:00:00Z", 3.0),
            record(1, "2024-11-03T06:00:00Z", None),
            record(2, "bad", 4.0),
            record(2, "worse", 5.0),
        ],
        "sensor_id int, raw_json string",
    )
    one = datetime(2024, 11, 3, 1)
    assert tuples(silver.measurements_from_history(raw), "sensor_id", "datetime_local", "value") == [
        (1, one, 1.0),
        (1, one, 2.0),
        (2, None, 4.0),
    ]
