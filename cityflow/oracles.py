"""The same results in plain SQL over the given tables, one statement per query.

Each statement states the expected outcome directly: it shares no code with the jobs
and skips the detours (JSON text, files, streams) that the jobs take.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# --- shared building blocks ---

_TRIPS = """
trips AS (
  SELECT o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
    c_nationkey AS PULocationID, s_nationkey AS DOLocationID,
    CAST(l_linenumber AS BIGINT) AS passenger_count, l_quantity AS trip_distance,
    l_extendedprice AS fare_amount,
    CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
      AS DOUBLE) AS tip_amount,
    CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
      AS DOUBLE) AS total_amount,
    l_suppkey AS payment_type,
    date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) * 1440.0::DOUBLE
      AS trip_duration_minutes,
    CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS taxi_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

_EVENT_TRIPS = """
trips AS (
  SELECT pickup_datetime,
    pickup_datetime + to_seconds(seconds) AS dropoff_datetime,
    CAST(user_id % 25 AS INTEGER) AS PULocationID,
    CAST((user_id + 1) % 25 AS INTEGER) AS DOLocationID,
    floor(value) AS trip_distance, value AS fare_amount, 0.0::DOUBLE AS tip_amount,
    value AS total_amount, event_id AS payment_type,
    seconds / 60.0::DOUBLE AS trip_duration_minutes,
    CASE WHEN event_type IN ('click', 'view') THEN 'yellow' ELSE 'green' END AS taxi_type
  FROM (SELECT *, date_trunc('second', ts) AS pickup_datetime,
          CAST(floor(value * 60) AS BIGINT) AS seconds FROM events)
)"""

_FACT = """
fact AS (
  SELECT pickup_datetime, dropoff_datetime,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    TRY_CAST(trip_duration_minutes AS DECIMAL(10,4)) AS trip_duration_minutes,
    pu.n_regionkey AS PUBoroughID, dof.n_regionkey AS DOBoroughID, trip_distance,
    TRY_CAST(fare_amount AS DECIMAL(10,2)) AS fare_amount,
    TRY_CAST(tip_amount AS DECIMAL(10,2)) AS tip_amount,
    TRY_CAST(total_amount AS DECIMAL(10,2)) AS total_amount,
    CAST(strftime(pickup_datetime, '%Y%m%d') AS INTEGER) AS PickupDateKey,
    CAST(strftime(dropoff_datetime, '%Y%m%d') AS INTEGER) AS DropoffDateKey
  FROM trips
  LEFT JOIN nation pu ON PULocationID = pu.n_nationkey
  LEFT JOIN nation dof ON DOLocationID = dof.n_nationkey
)"""


def _calendar(first: str, last: str, source: str = "") -> str:
    return f"""
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, CAST(d AS DATE) AS DateValue,
    CAST(year(d) AS INTEGER) AS "Year", CAST(month(d) AS INTEGER) AS MonthNumber,
    strftime(d, '%b') AS MonthShort, CAST(day(d) AS INTEGER) AS "Day",
    CAST(isodow(d) AS INTEGER) AS DayOfWeek, strftime(d, '%a') AS DayOfWeekShort,
    CAST(CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS IsWeekend
  FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS d {source})
)"""


_TRIP_CALENDAR = _calendar("TIMESTAMP '1995-01-01'", "TIMESTAMP '2000-12-31'")
_ORDER_CALENDAR = _calendar("min(o_orderdate)", "max(o_orderdate)", "FROM orders")

_STAR = """
star AS (
  SELECT f.*, r_name AS BoroughName, d.*
  FROM fact f LEFT JOIN region ON PUBoroughID = r_regionkey
  LEFT JOIN dim_date d ON PickupDateKey = DateKey
)"""

_TRIP_STAR = f"WITH {_TRIPS}, {_FACT}, {_TRIP_CALENDAR}, {_STAR}"


def _averages_over(member: str, by: list[str]) -> str:
    """Average of the non-blank totals per member, per slice."""
    slices = ", ".join(by)
    head = f"{slices}, " if by else ""
    group = f"GROUP BY {slices}" if by else ""
    return f"""(SELECT {head}CAST(sum(t) AS DOUBLE) / count(t) AS average
      FROM (SELECT {head}{member}, sum(total_amount) AS t FROM star GROUP BY {head}{member})
      {group})"""


def _revenue(by: list[str]) -> str:
    slices = ", ".join(f"s.{b}" for b in by)
    head = f"{slices}, " if by else ""

    def match(alias: str) -> str:
        return " AND ".join(f"s.{b} IS NOT DISTINCT FROM {alias}.{b}" for b in by) or "TRUE"

    group = f"GROUP BY {', '.join(by)}" if by else ""
    total = ", ".join([*by, "CAST(sum(total_amount) AS DOUBLE) AS total"])
    return f"""{_TRIP_STAR},
revenue AS (
  SELECT {head}d.average AS "Average Daily Revenue", m.average AS "Average Monthly Revenue",
    s.total AS "Total Revenue"
  FROM (SELECT {total} FROM star {group}) s
  JOIN {_averages_over('DateValue', by)} d ON {match('d')}
  JOIN {_averages_over('MonthNumber', by)} m ON {match('m')}
)"""


_BY = ["BoroughName", '"Year"']


def _mean(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / count({column})"


_TRIP_AVERAGES = f"""{_TRIP_STAR},
averages AS (
  SELECT BoroughName, "Year",
    {_mean('trip_distance')} AS "Average Trip Distance",
    {_mean('total_amount')} AS "Average Total Amount",
    {_mean('tip_amount')} AS "Average Tip Amount",
    {_mean('trip_duration_minutes')} AS "Average Trip Duration (Minutes)"
  FROM star GROUP BY BoroughName, "Year"
)"""

# --- measures ---

ORACLES["q_revenue_measures"] = f"{_revenue(_BY)} SELECT * FROM revenue"
ORACLES["q_revenue_grand_total"] = f"{_revenue([])} SELECT * FROM revenue"
ORACLES["q_trip_averages"] = f"{_TRIP_AVERAGES} SELECT * FROM averages"

ORACLES["q_implicit_aggs"] = f"""WITH {_TRIPS}, {_FACT}
SELECT r_name AS BoroughName,
  CAST(sum(trip_duration_minutes) AS DOUBLE) AS trip_duration_minutes,
  sum(trip_distance) AS trip_distance,
  CAST(sum(fare_amount) AS DOUBLE) AS fare_amount,
  CAST(sum(tip_amount) AS DOUBLE) AS tip_amount,
  CAST(sum(total_amount) AS DOUBLE) AS total_amount,
  count(DOBoroughID) AS DOBoroughID, count(DropoffDateKey) AS DropoffDateKey
FROM fact JOIN region ON PUBoroughID = r_regionkey GROUP BY r_name"""

ORACLES["q_implicit_date_aggs"] = f"""WITH {_ORDER_CALENDAR}
SELECT MonthShort, CAST(sum("Year") AS BIGINT) AS "Year",
  CAST(sum(MonthNumber) AS BIGINT) AS MonthNumber, CAST(sum("Day") AS BIGINT) AS "Day",
  CAST(sum(DayOfWeek) AS BIGINT) AS DayOfWeek, CAST(sum(IsWeekend) AS BIGINT) AS IsWeekend
FROM dim_date GROUP BY MonthShort"""

ORACLES["q_slice_calendar"] = f"""{_TRIP_STAR}
SELECT MonthNumber, MonthShort, DayOfWeek, DayOfWeekShort, IsWeekend,
  CAST(sum(total_amount) AS DOUBLE) AS "Total Revenue",
  {_mean('trip_distance')} AS "Average Trip Distance"
FROM star WHERE "Year" IN (1996, 1997, 1998) AND BoroughName <> 'ASIA'
GROUP BY ALL"""

ORACLES["q_slice_day"] = f"""{_TRIP_STAR}
SELECT CAST(DateValue AS VARCHAR) AS DateValue,
  CAST(sum(total_amount) AS DOUBLE) AS "Total Revenue",
  CAST(sum(total_amount) AS DOUBLE) AS "Average Daily Revenue"
FROM star GROUP BY DateValue"""

ORACLES["q_slice_hour"] = f"""WITH {_EVENT_TRIPS}, {_FACT},
per_day AS (
  SELECT pickup_hour, PickupDateKey, sum(total_amount) AS t FROM fact GROUP BY ALL
)
SELECT f.pickup_hour AS "Hour", CAST(sum(total_amount) AS DOUBLE) AS "Total Revenue",
  any_value(d.average) AS "Average Daily Revenue",
  {_mean('trip_duration_minutes')} AS "Average Trip Duration (Minutes)"
FROM fact f JOIN (
  SELECT pickup_hour, CAST(sum(t) AS DOUBLE) / count(t) AS average FROM per_day GROUP BY 1
) d ON f.pickup_hour = d.pickup_hour
GROUP BY f.pickup_hour"""

ORACLES["q_selected_value"] = """
SELECT o_custkey,
  CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN nullif(max(o_orderstatus), 'P') END AS selected
FROM orders GROUP BY o_custkey"""

ORACLES["q_members"] = """
SELECT CAST(range AS INTEGER) AS "Year" FROM range(1995, 2001) UNION
SELECT NULL FROM orders WHERE o_orderdate > TIMESTAMP '2000-12-31'"""


def _titles(year: str) -> str:
    return f"""'Financial Data – Year ' || {year} AS "Financial Title",
  'Trip Data – Year ' || {year} AS "Trip Title",
  'NYC Taxi Trips Summary – Year ' || {year} AS "Dashboard Title" """


ORACLES["q_titles"] = f"""WITH {_ORDER_CALENDAR}
SELECT DISTINCT "Year", {_titles('CAST("Year" AS VARCHAR)')} FROM dim_date"""

ORACLES["q_titles_blank"] = f"""WITH {_ORDER_CALENDAR},
chosen AS (
  SELECT MonthNumber, CASE WHEN count(DISTINCT "Year") = 1
    THEN CAST(max("Year") AS VARCHAR) ELSE '' END AS y
  FROM dim_date WHERE "Year" IN (2000, 2001) GROUP BY MonthNumber
)
SELECT MonthNumber, {_titles('y')} FROM chosen"""

ORACLES["q_metric_selector"] = f"""{_revenue(_BY)}
UNPIVOT revenue ON "Average Daily Revenue", "Average Monthly Revenue", "Total Revenue"
INTO NAME Metric VALUE "Metric Value" """

ORACLES["q_metric_selector_2"] = f"""{_TRIP_AVERAGES}
UNPIVOT averages ON "Average Trip Distance", "Average Total Amount", "Average Tip Amount",
  "Average Trip Duration (Minutes)"
INTO NAME Metric VALUE "Metric Value 2" """

ORACLES["q_measures_from_states"] = ORACLES["q_revenue_measures"]

ORACLES["q_metric_table"] = f"""{_revenue([])}, wide AS (
  SELECT *, {", ".join(f'(SELECT {_mean(column)} FROM star) AS "{name}"' for name, column in (
    ("Average Trip Distance", "trip_distance"), ("Average Total Amount", "total_amount"),
    ("Average Tip Amount", "tip_amount"),
    ("Average Trip Duration (Minutes)", "trip_duration_minutes")))}
  FROM revenue
)
UNPIVOT wide ON * INTO NAME Metric VALUE "Metric Value" """

ORACLES["q_metric_switch"] = f"""{_revenue(['BoroughName'])}
SELECT BoroughName, CASE BoroughName WHEN 'AFRICA' THEN "Total Revenue"
  WHEN 'ASIA' THEN "Average Daily Revenue" WHEN 'EUROPE' THEN "Average Monthly Revenue"
  END AS "Metric Value"
FROM revenue"""


def _plain_text(x: str) -> str:
    """Thousands separators before the point, every digit of the double after it."""
    digits = f"split_part(CAST({x} AS VARCHAR), '.', 2)"
    whole = f"format('{{:,}}', CAST(trunc({x}) AS BIGINT))"
    return f"CASE WHEN {digits} IN ('', '0') THEN {whole} ELSE {whole} || '.' || {digits} END"


ORACLES["q_metric_format"] = f"""{_TRIP_AVERAGES},
totals AS (SELECT BoroughName, "Year", sum(total_amount) AS t FROM star GROUP BY ALL)
SELECT a.BoroughName, a."Year",
  '$' || format('{{:,}}', CAST(trunc(t) AS BIGINT)) || '.' ||
    lpad(CAST(CAST((t - trunc(t)) * 100 AS BIGINT) AS VARCHAR), 2, '0') AS "Total Revenue Text",
  {_plain_text('"Average Total Amount"')} || ' zł' AS "Average Total Amount Text",
  {_plain_text('"Average Trip Distance"')} AS "Average Trip Distance Text"
FROM averages a JOIN totals t
  ON a.BoroughName = t.BoroughName AND a."Year" IS NOT DISTINCT FROM t."Year" """

# --- trips ---

ORACLES["q_union_trips"] = f"""WITH {_TRIPS}
SELECT taxi_type, PULocationID, count(*) AS trips, sum(trip_distance) AS distance
FROM trips GROUP BY ALL"""

ORACLES["q_trip_duration"] = f"""WITH {_TRIPS}
SELECT pickup_datetime, dropoff_datetime, passenger_count, trip_duration_minutes FROM trips"""

ORACLES["q_dedupe_trips"] = f"""WITH {_TRIPS}
SELECT * FROM trips
QUALIFY row_number() OVER (
  PARTITION BY pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, taxi_type
  ORDER BY passenger_count, trip_distance, fare_amount, tip_amount, total_amount,
    payment_type) = 1"""

ORACLES["q_color_branch"] = f"""WITH {_EVENT_TRIPS}
SELECT pickup_datetime, PULocationID, payment_type, taxi_type AS color
FROM trips WHERE taxi_type = 'yellow'"""

ORACLES["q_fact_trips"] = f"""WITH {_TRIPS}, {_FACT}
SELECT * REPLACE (
  CAST(trip_duration_minutes AS DOUBLE) AS trip_duration_minutes,
  CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(tip_amount AS DOUBLE) AS tip_amount,
  CAST(total_amount AS DOUBLE) AS total_amount)
FROM fact"""

_ROLLUP = """
  SELECT PUBoroughID, PickupDateKey, pickup_hour, count(*) AS trips,
    CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
    sum(trip_distance) / count(*) AS average_trip_distance
  FROM fact GROUP BY ALL"""

ORACLES["q_fact_hourly_rollup"] = f"WITH {_EVENT_TRIPS}, {_FACT} {_ROLLUP}"

# --- dimensions ---

ORACLES["q_dim_date"] = f"""WITH {_ORDER_CALENDAR}
SELECT * REPLACE (CAST(DateValue AS VARCHAR) AS DateValue) FROM dim_date"""

ORACLES["q_dim_borough"] = """
SELECT CAST(row_number() OVER (ORDER BY r_name) AS INTEGER) AS BoroughID, r_name AS BoroughName
FROM (SELECT DISTINCT r_name FROM region JOIN nation ON n_regionkey = r_regionkey)"""

ORACLES["q_stable_keys"] = """
SELECT CAST(row_number() OVER (ORDER BY n_nationkey % 2, n_name) AS INTEGER) AS ZoneID,
  n_name AS Zone
FROM nation JOIN region ON n_regionkey = r_regionkey"""

ORACLES["q_hour_key"] = """
SELECT CAST(h.range AS INTEGER) AS Value, count(event_id) AS events
FROM range(24) h LEFT JOIN events ON hour(ts) = h.range GROUP BY 1"""

# --- keys ---

ORACLES["q_dedupe_measurements"] = """
SELECT user_id, date_trunc('hour', ts) AS hour, event_type, event_id, value FROM events
QUALIFY row_number() OVER (
  PARTITION BY user_id, date_trunc('hour', ts), event_type ORDER BY event_id, value) = 1"""

ORACLES["q_distinct_keys"] = "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem"

ORACLES["q_new_keys"] = """
SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')"""

_EVENT_HOURS = """
hours AS (
  SELECT event_id, user_id, CAST(strftime(ts, '%Y%m%d%H') AS INTEGER) AS ingestion_hour
  FROM events
)"""

ORACLES["q_new_keys_composite"] = f"""WITH {_EVENT_HOURS}
SELECT * FROM hours h WHERE NOT EXISTS (
  SELECT 1 FROM hours k WHERE k.ingestion_hour < 2024012012
    AND k.user_id = h.user_id AND k.ingestion_hour = h.ingestion_hour)"""

ORACLES["q_first_unseen"] = """
WITH hours AS (
  SELECT user_id, CAST(strftime(ts, '%Y%m%d%H') AS INTEGER) AS ingestion_hour, event_id, value
  FROM events
)
SELECT * FROM hours WHERE (user_id, ingestion_hour) NOT IN (
  SELECT (user_id, ingestion_hour) FROM hours WHERE ingestion_hour < 2024012012)
QUALIFY row_number() OVER (PARTITION BY user_id, ingestion_hour ORDER BY event_id, value) = 1"""

# --- air quality ---

_TYPES = "(SELECT list_sort(list(DISTINCT event_type)) FROM events)"
_SENSOR = f"user_id * len({_TYPES}) + list_position({_TYPES}, event_type) - 1"

_READINGS = f"""
readings AS (
  SELECT {_SENSOR} AS sensor_id, n_regionkey AS BoroughID, event_type AS parameter,
    'per ' || event_type AS unit, ts, value,
    CAST(strftime(local_ts, '%Y%m%d') AS INTEGER) AS DateKey,
    CAST(hour(local_ts) AS INTEGER) AS HourKey
  FROM (SELECT *, timezone('America/New_York', timezone('UTC', ts)) AS local_ts FROM events)
  JOIN nation ON user_id % 25 = n_nationkey
)"""


def _latest(name: str, condition: str) -> str:
    return f"""
{name} AS (
  SELECT BoroughID, DateKey, HourKey, value, parameter, unit FROM readings
  WHERE {condition}
  QUALIFY row_number() OVER (PARTITION BY BoroughID, DateKey, HourKey, parameter
    ORDER BY ts DESC, sensor_id, value) = 1
)"""


_NEWEST = "(SELECT max(ts) FROM events)"
_LAST_DAY = f"ts >= {_NEWEST} - INTERVAL 24 HOURS"

ORACLES["q_lookback_24h"] = f"""
SELECT {_SENSOR} AS sensor_id, ts AS datetime_utc, value FROM events WHERE {_LAST_DAY}"""

ORACLES["q_latest_per_group"] = """
SELECT user_id, event_type, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1"""

_FIRST_RUN = (
    f"ts <= {_NEWEST} - INTERVAL 12 HOURS AND ts >= {_NEWEST} - INTERVAL 36 HOURS"
)

ORACLES["q_air_quality_merge"] = f"""WITH {_READINGS},
{_latest('old', _FIRST_RUN)}, {_latest('new', _LAST_DAY)}
SELECT * FROM old UNION ALL
SELECT * FROM new n WHERE NOT EXISTS (
  SELECT 1 FROM old o WHERE o.BoroughID = n.BoroughID AND o.DateKey = n.DateKey
    AND o.HourKey = n.HourKey AND o.parameter = n.parameter)"""

ORACLES["q_table_merge"] = ORACLES["q_air_quality_merge"]

ORACLES["q_bucketed_merge"] = ORACLES["q_air_quality_merge"]

ORACLES["q_full_replace"] = f"""
SELECT {_SENSOR} AS sensor_id, ts AS datetime_utc,
  timezone('America/New_York', timezone('UTC', ts)) AS datetime_local, value
FROM events
QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY ts DESC, value) = 1"""

ORACLES["q_copy_layer"] = f"""
SELECT {_SENSOR} AS sensor_id, ts AS datetime_utc,
  timezone('America/New_York', timezone('UTC', ts)) AS datetime_local, value
FROM events
QUALIFY row_number() OVER (PARTITION BY sensor_id, ts ORDER BY value) = 1"""

ORACLES["q_air_quality_summary"] = f"""WITH {_READINGS}, {_latest('fact', 'TRUE')}
SELECT r_name AS BoroughName, parameter, unit,
  CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value
FROM fact JOIN region ON BoroughID = r_regionkey WHERE HourKey >= 6 GROUP BY ALL"""

ORACLES["q_air_quality_by_month"] = f"""WITH {_READINGS}, {_latest('fact', 'TRUE')}
SELECT CAST(DateKey // 10000 AS INTEGER) AS "Year",
  CAST(DateKey // 100 % 100 AS INTEGER) AS MonthNumber, parameter,
  CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS value
FROM fact GROUP BY ALL"""

ORACLES["q_drill_across"] = f"""WITH {_EVENT_TRIPS}, {_FACT}, {_READINGS},
{_latest('air_fact', 'TRUE')},
t AS ({_ROLLUP}),
a AS (
  SELECT BoroughID, DateKey, HourKey, count(value) AS readings, min(value) AS lowest,
    max(value) AS highest
  FROM air_fact GROUP BY ALL
)
SELECT coalesce(PUBoroughID, BoroughID) AS BoroughID, coalesce(PickupDateKey, DateKey) AS DateKey,
  coalesce(pickup_hour, HourKey) AS HourKey, trips, total_revenue, readings, lowest, highest
FROM t FULL JOIN a
  ON PUBoroughID = BoroughID AND PickupDateKey = DateKey AND pickup_hour = HourKey"""

# --- locations ---

_CITY = """
city AS (
  SELECT *, c_nationkey + 0.5::DOUBLE AS latitude, c_custkey / 8.0::DOUBLE AS longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE c_acctbal >= 0 AND c_mktsegment NOT IN ('MACHINERY', 'FURNITURE')
    AND r_name IN ('AFRICA', 'AMERICA', 'ASIA')
)"""

ORACLES["q_geocode_attach"] = f"""WITH {_CITY}
SELECT CAST(c_custkey AS INTEGER) AS location_id, c_name AS name, n_name AS locality,
  'US' AS country_code, latitude, longitude, 'America/New_York' AS timezone,
  c_mktsegment AS provider, 'Road ' || c_custkey AS road, n_name AS neighbourhood,
  CASE r_name WHEN 'AFRICA' THEN 'Bronx' ELSE r_name END AS suburb
FROM city"""

ORACLES["q_geocode_requests"] = """
SELECT DISTINCT c_nationkey + 0.5::DOUBLE AS lat, c_custkey / 8.0::DOUBLE AS lon FROM customer
WHERE c_acctbal >= 0 AND c_mktsegment NOT IN ('MACHINERY', 'FURNITURE') AND c_custkey % 2 = 1"""

ORACLES["q_latest_requests"] = f"""WITH {_CITY}
SELECT DISTINCT CAST(c_custkey AS INTEGER) AS location_id FROM city"""

ORACLES["q_explode_children"] = f"""WITH {_CITY}
SELECT CAST(c_custkey * 2 + i AS INTEGER) AS sensor_id, CAST(c_custkey AS INTEGER) AS location_id,
  CASE i WHEN 0 THEN 'pm25' ELSE 'o3' END AS parameter,
  CASE i WHEN 0 THEN 'µg/m³' ELSE 'ppm' END AS unit
FROM city, (VALUES (0), (1)) AS v(i) WHERE c_mktsegment <> 'HOUSEHOLD'"""

ORACLES["q_rejected_documents"] = """
SELECT CASE WHEN c_acctbal < 0 THEN 'not JSON'
    WHEN c_mktsegment = 'MACHINERY' THEN 'no coordinates'
    ELSE 'required field missing' END AS reject_reason, count(*) AS documents
FROM customer WHERE c_acctbal < 0 OR c_mktsegment IN ('MACHINERY', 'FURNITURE') GROUP BY 1"""

ORACLES["q_borough_normalise"] = """
SELECT CASE WHEN r_name = 'MIDDLE EAST' THEN 'Levant'
    WHEN c_custkey % 2 = 0 THEN r_name
    ELSE '  ' || upper(left(r_name, 1)) || lower(substr(r_name, 2)) || ' ' END AS name,
  count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY 1"""

ORACLES["q_bbox_filter"] = """
SELECT c_custkey, n_name AS nation, c_nationkey + 0.5::DOUBLE AS lat, c_custkey / 8.0::DOUBLE AS lon
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey / 8.0::DOUBLE BETWEEN 10 AND 150 AND c_nationkey + 0.5::DOUBLE BETWEEN 3 AND 18.5
ORDER BY c_custkey LIMIT 100"""

ORACLES["q_bbox_pages"] = """
WITH inside AS (
  SELECT c_custkey, n_name AS nation, c_nationkey + 0.5::DOUBLE AS lat,
    c_custkey / 8.0::DOUBLE AS lon
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_custkey / 8.0::DOUBLE BETWEEN 10 AND 1500
    AND c_nationkey + 0.5::DOUBLE BETWEEN 3 AND 18.5
), placed AS (
  SELECT *, row_number() OVER (ORDER BY nation, lon DESC) AS position FROM inside
)
SELECT *, (position - 1) // 100 + 1 AS page FROM placed"""

# --- documents ---


def _typed_readings(sensor: str, bad_time: str, bad_value: str) -> str:
    return f"""
SELECT sensor_id, datetime_utc,
  timezone('America/New_York', timezone('UTC', datetime_utc)) AS datetime_local, value
FROM (
  SELECT CAST({sensor} AS INTEGER) AS sensor_id,
    CASE WHEN NOT {bad_time} THEN ts END AS datetime_utc,
    CASE WHEN NOT {bad_value} THEN value END AS value
  FROM events)
QUALIFY row_number() OVER (PARTITION BY sensor_id, datetime_utc ORDER BY value NULLS LAST) = 1"""


ORACLES["q_parse_measurement"] = _typed_readings(
    "user_id", "event_type = 'error'", "event_type = 'error'"
)
ORACLES["q_parse_latest"] = _typed_readings("user_id", "event_type = 'purchase'", "FALSE")

ORACLES["q_latest_backlog"] = """
SELECT sensor_id, datetime_utc,
  timezone('America/New_York', timezone('UTC', datetime_utc)) AS datetime_local, value
FROM (
  SELECT CAST(user_id AS INTEGER) AS sensor_id, value, day(ts) % 2 AS odd,
    CASE WHEN event_type <> 'purchase' THEN ts END AS datetime_utc
  FROM events)
QUALIFY row_number() OVER (PARTITION BY sensor_id, datetime_utc ORDER BY odd, value) = 1"""

ORACLES["q_guarded_append"] = """
WITH days AS (SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS d FROM events)
SELECT load_id, count(*) AS rows_read, count(*) FILTER (new) AS rows_added,
  min(d) AS first_day, max(d) AS last_day, CAST(count(DISTINCT d) AS INTEGER) AS days
FROM (
  SELECT 'week' AS load_id, d, TRUE AS new FROM days WHERE d < 20240108 UNION ALL
  SELECT 'fortnight', d, TRUE FROM days WHERE d < 20240115 UNION ALL
  SELECT 'all', d, d >= 20240115 FROM days)
GROUP BY load_id"""

ORACLES["q_parse_weather"] = """
SELECT CAST(strftime(ts, '%Y%m%d%H') AS INTEGER) AS ingestion_hour, datetime_local,
  v AS temperature_c, v * 2 AS precipitation_mm, v / 4 AS wind_kmh
FROM (
  SELECT ts, CASE WHEN event_type <> 'error' THEN date_trunc('minute', ts) END AS datetime_local,
    CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
QUALIFY row_number() OVER (PARTITION BY strftime(ts, '%Y%m%d%H')
  ORDER BY datetime_local NULLS LAST, v NULLS LAST) = 1"""

ORACLES["q_json_roundtrip"] = """
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, CAST(props->>'$.k' AS BIGINT) AS k_loose,
  CAST(NULL AS VARCHAR) AS absent, json_valid(props) AS well_formed,
  '{"event_id":' || event_id || ',"k":' || CAST(props->>'$.k' AS BIGINT) || '}' AS raw_json
FROM events"""

ORACLES["q_json_records"] = """
SELECT c_custkey AS location_id,
  '{"id":' || c_custkey * s || ',"name":"' || CASE s WHEN 1 THEN c_name ELSE c_mktsegment END
    || '"}' AS raw_json
FROM customer, (VALUES (1), (-1)) AS v(s)"""

ORACLES["q_quarantine"] = """
WITH parts AS (
  SELECT c_acctbal < 0 AS broken, c_mktsegment AS segment, '{"id":' || c_custkey || '}' AS record,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN '"location_id":' || c_custkey || ',' ELSE '' END
      AS key,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN '{\\"results\\":[{\\"id\\":' || c_custkey || '}]}'
      ELSE '{}' END AS body
  FROM customer
), texts AS (
  SELECT *, '{' || key || '"body":"' || body || '"' || CASE WHEN broken THEN '' ELSE '}' END AS text
  FROM parts
)
SELECT CASE WHEN segment NOT IN ('MACHINERY', 'FURNITURE')
      THEN CASE WHEN broken THEN 'replayed' ELSE 'loaded' END
    WHEN broken THEN 'not JSON'
    WHEN segment = 'MACHINERY' THEN 'request key missing' ELSE 'no record list' END AS state,
  CASE WHEN segment NOT IN ('MACHINERY', 'FURNITURE') THEN record ELSE text END AS text
FROM texts"""

ORACLES["q_keyed_bronze"] = """
SELECT CAST(user_id % 25 AS INTEGER) AS location_id,
  CAST(strftime(ts, '%Y%m%d%H') AS INTEGER) AS ingestion_hour, user_id AS sensor,
  '{"datetime":{"utc":"' || CASE event_type WHEN 'purchase' THEN 'yesterday' ELSE t END
    || '","local":"' || t || '"},"value":' || value || ',"sensorsId":' || user_id
    || ',"locationsId":' || user_id % 25 || '}' AS raw_json
FROM (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS t FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id, ingestion_hour ORDER BY raw_json) = 1"""

ORACLES["q_json_root_list"] = """
SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS raw_json
FROM orders, (VALUES (1), (2)) AS v(s)"""

_LOCAL = "timezone('America/New_York', timezone('UTC', ts))"

ORACLES["q_local_time"] = f"""
SELECT event_id, {_LOCAL} AS datetime_local,
  CAST(strftime({_LOCAL}, '%Y%m%d') AS INTEGER) AS DateKey,
  CAST(hour({_LOCAL}) AS INTEGER) AS HourKey
FROM events"""

ORACLES["q_ingestion_hour"] = """
SELECT event_id, CAST(strftime(ts, '%Y%m%d%H') AS INTEGER) AS ingestion_hour,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso,
  date_trunc('second', ts + INTERVAL 500 MILLISECOND) AS whole_second
FROM events"""

ORACLES["q_backfill_plan"] = """
SELECT user_id AS sensor_id, w AS window_start,
  least(w + INTERVAL 31 DAY, TIMESTAMP '2024-12-31') AS window_end,
  strftime(w, '%Y-%m-%dT%H:%M:%S+00:00') AS date_from,
  strftime(least(w + INTERVAL 31 DAY, TIMESTAMP '2024-12-31'), '%Y-%m-%dT%H:%M:%S+00:00')
    AS date_to
FROM (SELECT DISTINCT user_id FROM events),
  (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-12-30',
    INTERVAL 31 DAY)) AS w)"""

ORACLES["q_backfill_gaps"] = """
WITH days AS (SELECT DISTINCT user_id, date_trunc('day', ts) AS d FROM events),
windows AS (
  SELECT user_id, w, least(w + INTERVAL 31 DAY, TIMESTAMP '2024-04-01') AS until
  FROM (SELECT DISTINCT user_id FROM events), (SELECT unnest(generate_series(
    TIMESTAMP '2024-01-01', TIMESTAMP '2024-03-31', INTERVAL 31 DAY)) AS w)
), free AS (
  SELECT windows.*, day FROM windows, LATERAL (SELECT unnest(generate_series(
    w, until - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day) AS t
  WHERE NOT EXISTS (SELECT 1 FROM days WHERE days.user_id = windows.user_id AND d = day)
), runs AS (
  SELECT *, date_diff('day', w, day)
    - row_number() OVER (PARTITION BY user_id, w ORDER BY day) AS run
  FROM free
), gaps AS (
  SELECT user_id AS sensor_id, CAST(min(day) AS TIMESTAMP) AS window_start,
    CAST(max(day) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end
  FROM runs GROUP BY user_id, w, run
)
SELECT *, strftime(window_start, '%Y-%m-%dT%H:%M:%S+00:00') AS date_from,
  strftime(window_end, '%Y-%m-%dT%H:%M:%S+00:00') AS date_to
FROM gaps"""

ORACLES["q_typed_cast"] = """
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS amount,
  CAST(NULL AS BIGINT) AS large, TRY_CAST(event_id * 1000000 AS INTEGER) AS wide, ts AS day
FROM events"""

# --- landed files ---

ORACLES["q_file_manifest"] = f"""WITH {_EVENT_TRIPS}
SELECT '2024-01' AS month, taxi_type AS color, count(*) AS trips, sum(trip_distance) AS distance
FROM trips GROUP BY ALL"""

ORACLES["q_csv_scan"] = """
SELECT c_custkey AS LocationID, r_name AS Borough,
  c_name || ', "' || c_mktsegment || '"' AS Zone, c_mktsegment AS service_zone
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

ORACLES["q_csv_exchange_rates"] = """
SELECT 'EXR.' || o_orderkey AS "KEY", o_orderstatus AS CURRENCY,
  strftime(o_orderdate, '%Y-%m-%d') AS TIME_PERIOD,
  CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS OBS_VALUE,
  CAST(4 AS BIGINT) AS DECIMALS, o_orderpriority AS TITLE, o_custkey AS UNIT_MULT
FROM orders"""

# --- streams ---

ORACLES["q_stream_land"] = "SELECT event_id, user_id, ts AS datetime_utc, value FROM events"

ORACLES["q_stream_dedupe"] = "SELECT DISTINCT user_id, date_trunc('hour', ts) AS hour FROM events"

ORACLES["q_stream_latest"] = f"""WITH {_READINGS}
SELECT date_trunc('hour', ts) AS hour_start, BoroughID, parameter, unit, value FROM readings
QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts), BoroughID, parameter
  ORDER BY ts DESC, sensor_id, value) = 1"""

ORACLES["q_stream_window"] = ORACLES["q_stream_latest"]

ORACLES["q_stream_late"] = """
WITH batches AS (SELECT event_id % 6 AS batch_id, max(ts) AS newest FROM events GROUP BY ALL),
progress AS (
  SELECT batch_id, max(newest) OVER (ORDER BY batch_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
  FROM batches
)
SELECT event_id, ts AS datetime_utc, batch_id,
  coalesce(ts < newest - INTERVAL 20 DAY, FALSE) AS late
FROM events JOIN progress ON event_id % 6 = batch_id"""

ORACLES["q_stream_merge"] = f"""WITH {_READINGS}, {_latest('fact', _LAST_DAY)}
SELECT * FROM fact"""
