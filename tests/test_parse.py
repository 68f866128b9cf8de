from datetime import datetime

from pyspark.sql import functions as F

from cityflow import schemas
from cityflow.functions import parse

from .conftest import tuples


def test_historical_measurements(frame):
    raw = frame(
        [
            (1, '{"period":{"datetimeTo":{"utc":"2024-07-01T12:00:00Z","local":"x"}},"value":3.5}'),
            (2, '{"period":{"datetimeTo":{"utc":"soon"}},"value":1}'),
            (3, '{"value":null}'),
            (4, "{broken"),
            (5, None),
        ],
        "sensor_id int, raw_json string",
    )
    assert tuples(parse.historical_measurements(raw)) == [
        (1, datetime(2024, 7, 1, 12), datetime(2024, 7, 1, 8), 3.5),
        (2, None, None, 1.0),
        (3, None, None, None),
        (4, None, None, None),
        (5, None, None, None),
    ]


def test_latest_measurements_with_an_id_beyond_int(frame):
    raw = frame(
        [
            ('{"datetime":{"utc":"2024-01-01T12:00:00Z"},"value":1,"sensorsId":7,"locationsId":1}',),
            ('{"datetime":{"utc":"2024-01-01T12:00:00Z"},"value":2,"sensorsId":5000000000}',),
        ],
        "raw_json string",
    )
    noon, local = datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 7)
    assert tuples(parse.latest_measurements(raw)) == [
        (7, noon, local, 1.0),
        (None, noon, local, 2.0),
    ]


def test_first_weather_hour(frame):
    raw = frame(
        [
            (
                2024010100,
                '{"hourly":{"time":["2024-01-01T00:00","2024-01-01T01:00"],'
                '"temperature_2m":[1.5,2],"precipitation":[0,1],"wind_speed_10m":[9.5,8]}}',
            ),
            (2024010101, '{"hourly":{"time":[],"temperature_2m":[]}}'),
            (2024010102, "[]"),
        ],
        "ingestion_hour int, raw_json string",
    )
    assert tuples(parse.first_weather_hour(raw)) == [
        (2024010100, datetime(2024, 1, 1), 1.5, 0.0, 9.5),
        (2024010101, None, None, None, None),
        (2024010102, None, None, None, None),
    ]


def test_malformed_text_is_marked(frame):
    raw = frame(
        [('{"id":1,"name":"a"}',), ('{"id":1',), ("nonsense",), ("{}",)], "raw_json string"
    )
    doc = parse.document("raw_json", schemas.LOCATION_DOC)
    marks = raw.select(doc["_corrupt_record"].isNotNull(), parse.is_json("raw_json")).collect()
    assert [tuple(m) for m in marks] == [
        (False, True),
        (True, False),
        (True, False),
        (False, True),
    ]


def test_loose_fields_and_serialising(one):
    raw = F.lit('{"a":{"b":[1,"x"]}}')
    assert one(parse.loose_field(raw, "$.a.b[0]", "bigint")) == 1
    assert one(parse.loose_field(raw, "$.a.b[1]", "bigint")) is None
    assert one(parse.loose_field(raw, "$.z", "string")) is None
    assert one(parse.loose_field(F.lit("{"), "$.z", "string")) is None
    assert one(parse.to_text(F.struct(F.lit(1).alias("k")))) == '{"k":1}'
