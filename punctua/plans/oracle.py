"""The registered queries in SQL, for another engine to check the results against."""

from __future__ import annotations

from punctua.contract import AFTER_THE_FACT, LABEL, WEATHER_FILL
from punctua.plans.registry import FLIGHT, NOW

ORACLE: dict[str, str] = {}

_HOLIDAYS = """
holidays AS (
  SELECT d FROM (SELECT CAST(unnest(generate_series(DATE '1994-01-01', DATE '2002-12-31',
                                                    INTERVAL 1 DAY)) AS DATE) AS d)
  WHERE (isodow(d) <= 5 AND month(d) * 100 + day(d) IN (101, 704, 1111, 1225))
     OR (isodow(d) = 1 AND month(d - 1) * 100 + day(d - 1) IN (101, 704, 1111, 1225))
     OR (isodow(d) = 5 AND month(d + 1) * 100 + day(d + 1) IN (101, 704, 1111, 1225))
     OR (isodow(d) = 1 AND month(d) IN (1, 2) AND day(d) BETWEEN 15 AND 21)
     OR (isodow(d) = 1 AND month(d) = 5 AND day(d) >= 25)
     OR (isodow(d) = 1 AND month(d) = 9 AND day(d) <= 7)
     OR (isodow(d) = 1 AND month(d) = 10 AND day(d) BETWEEN 8 AND 14)
     OR (isodow(d) = 4 AND month(d) = 11 AND day(d) BETWEEN 22 AND 28)
),
near_holidays AS (
  SELECT DISTINCT d + CAST(k AS INTEGER) AS day FROM holidays, range(-2, 3) r(k)
)"""

_FLIGHTS = f"""{_HOLIDAYS},
airports AS (
  SELECT n_name AS iata, 'Airport ' || n_name AS name, r_name AS city,
         CAST(24 AS DOUBLE) + n_nationkey AS lat,
         CAST(-125 AS DOUBLE) + n_nationkey * CAST(2.3 AS DOUBLE) AS lon
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
bronze AS (
  SELECT CAST(l_shipdate AS DATE) AS flight_date,
         CAST(((l_partkey * 7 + l_linenumber) % 25) * 100 + l_suppkey % 60 AS INTEGER)
           AS crs_dep_time,
         CAST(l_partkey % 2400 AS INTEGER) AS crs_arr_time,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS {FLIGHT},
         o_orderpriority AS carrier, sn.n_name AS origin, cn.n_name AS dest,
         l_extendedprice AS distance, l_quantity * 5 AS crs_elapsed_time,
         CAST(l_returnflag = 'R' AS INTEGER) AS dep_del15,
         CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE CAST(0 AS DOUBLE) END
           AS dep_delay_minutes,
         CAST(CAST(o_orderstatus = 'P' AS INTEGER) AS DOUBLE) AS cancelled
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
),
flights AS (
  SELECT *, CAST(year(flight_date) AS INTEGER) AS year,
         CAST(month(flight_date) AS INTEGER) AS month,
         CAST(isodow(flight_date) AS INTEGER) AS day_of_week,
         date_diff('day', DATE '1970-01-01', flight_date) AS day_num,
         CASE WHEN dep_hour < 6 THEN 'night' WHEN dep_hour < 12 THEN 'morning'
              WHEN dep_hour < 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day_bucket,
         CAST(flight_date IN (SELECT day FROM near_holidays) AS INTEGER) AS is_holiday_window
  FROM (SELECT *, CASE WHEN crs_dep_time // 100 BETWEEN 0 AND 23
                       THEN crs_dep_time // 100 ELSE 0 END AS dep_hour FROM bronze)
),
staged AS (SELECT * FROM flights WHERE coalesce(cancelled, 0) = 0)"""

_FOLDED = (
    "(year(folded) * 1000000 + month(folded) * 10000 + day(folded) * 100 + {hour})"
)
_WEATHER_VALUES = """
         value AS temp_2m, k / 10 AS precip, value / 2 AS wind_speed, k + 1 AS wind_gusts,
         CASE WHEN k < 10 THEN k END AS snowfall"""
_WEATHER = f"""
readings AS (
  SELECT n_name AS iata, date_trunc('hour', ts) AS weather_ts, event_id, value,
         CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k
  FROM events JOIN nation ON user_id % 25 = n_nationkey
),
weather AS (
  SELECT iata, weather_ts, {_WEATHER_VALUES},
         year(weather_ts) * 1000000 + month(weather_ts) * 10000 + day(weather_ts) * 100
           + hour(weather_ts) AS hour_key
  FROM (SELECT *, row_number() OVER (PARTITION BY iata, weather_ts ORDER BY event_id) AS rn
        FROM readings)
  WHERE rn = 1
)"""
_POSITIONS = """
positions AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS icao24, ' FL' || user_id || ' ' AS callsign,
         CAST(20 AS DOUBLE) + ((event_id * 37) % 3500) / CAST(100 AS DOUBLE) AS lat,
         CAST(-130 AS DOUBLE) + ((event_id * 53) % 7000) / CAST(100 AS DOUBLE) AS lon,
         round(value * 20, 0) AS altitude, value AS velocity, CAST(event_id % 360 AS DOUBLE) AS heading,
         event_type = 'error' AS on_ground, CAST(floor(epoch(ts)) AS BIGINT) AS event_ts
  FROM events
)"""
_BOX = "lat BETWEEN 24 AND 50 AND lon BETWEEN -125 AND -66"
_SCORES = """
scores AS (
  SELECT greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), l_discount * 5 + l_tax * 2)) AS p,
         CAST(l_returnflag = 'R' AS INTEGER) AS y, CAST(year(l_shipdate) AS VARCHAR) AS name
  FROM lineitem
)"""
_RATE = "avg(CAST(dep_del15 AS DOUBLE))"
_TRAIN = "year BETWEEN 1995 AND 1999"
_TEST = "year IN (2000, 2001)"


def _flights(body: str, *more: str) -> str:
    return "WITH " + ",".join([_FLIGHTS, *more]) + "\n" + body


def _positions(body: str, *more: str) -> str:
    return "WITH " + ",".join([_POSITIONS, *more]) + "\n" + body


# --- silver and staging ----------------------------------------------------------------

_GAPS = [c for c in AFTER_THE_FACT if c not in ("dep_delay_minutes", "cancelled")]
_NULLS = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in _GAPS)

ORACLE["silver_flights"] = _flights(
    f"""SELECT flight_date, CAST(flight_date AS TIMESTAMP) + to_hours(dep_hour) AS flight_ts, year,
       month, day_of_week, carrier, {FLIGHT}, origin, dest, dep_hour, time_of_day_bucket, distance,
       crs_dep_time, crs_arr_time, crs_elapsed_time, is_holiday_window, dep_del15,
       dep_delay_minutes, cancelled, {_NULLS}
FROM flights"""
)
ORACLE["stg_flights"] = _flights(
    f"""SELECT flight_date, year, month, day_of_week, dep_hour, time_of_day_bucket, carrier,
       {FLIGHT} AS flight_number, origin, dest, distance, crs_dep_time, crs_arr_time,
       crs_elapsed_time, dep_del15, dep_delay_minutes, CAST(NULL AS INTEGER) AS arr_del15,
       CAST(cancelled AS INTEGER) AS cancelled, CAST(NULL AS INTEGER) AS diverted,
       CAST(NULL AS DOUBLE) AS carrier_delay, CAST(NULL AS DOUBLE) AS weather_delay,
       CAST(NULL AS DOUBLE) AS nas_delay, CAST(NULL AS DOUBLE) AS security_delay,
       CAST(NULL AS DOUBLE) AS late_aircraft_delay, is_holiday_window
FROM staged"""
)
ORACLE["dim_airports"] = _flights("SELECT iata, name, city, lat, lon FROM airports")
ORACLE["dedup_weather"] = (
    "WITH "
    + _WEATHER
    + """
SELECT iata, weather_ts, temp_2m AS temperature_2m, precip AS precipitation,
       wind_speed AS wind_speed_10m, wind_gusts AS wind_gusts_10m, snowfall,
       hour_key AS weather_hour_key FROM weather"""
)
ORACLE["valid_airports_semi"] = """
SELECT o_orderkey AS request_id, so.n_name AS origin, cn.n_name AS dest
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
JOIN nation so ON o_orderkey % 27 = so.n_nationkey"""
ORACLE["enforce_schema"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_linenumber <> 1 THEN CAST(l_quantity AS BIGINT) END AS distance,
       l_discount AS carrier_delay,
       CASE WHEN l_tax <= CAST(0.05 AS DOUBLE) THEN CAST(l_linenumber AS BIGINT) END AS dep_del15
FROM lineitem"""
ORACLE["union_by_name_missing"] = """
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS bal, CAST(NULL AS VARCHAR) AS segment
FROM supplier
UNION ALL
SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer"""
ORACLE["pending_partitions"] = _flights(
    """SELECT DISTINCT n_name AS iata, CAST(o_orderdate AS DATE) AS flight_date
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
EXCEPT
SELECT origin, flight_date FROM flights"""
)
ORACLE["dim_patch"] = _flights(
    """SELECT iata, name, lat, lon FROM airports
UNION ALL SELECT 'X ' || iata, 'Patched X ' || iata, lat, lon FROM airports"""
)

# --- scalar functions ----------------------------------------------------------------------

ORACLE["holiday_window"] = (
    "WITH "
    + _HOLIDAYS
    + """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
       CAST(CAST(o_orderdate AS DATE) IN (SELECT day FROM near_holidays) AS INTEGER)
         AS is_holiday_window
FROM orders"""
)
ORACLE["calendar_parts"] = f"""
SELECT event_id, CAST(isodow(ts) AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month,
       CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning'
            WHEN hour(ts) < 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day_bucket,
       year(ts) * 1000000 + month(ts) * 10000 + day(ts) * 100 + hour(ts) AS hour_key,
       date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day_num,
       greatest(0, {NOW} - CAST(floor(epoch(ts)) AS BIGINT)) AS stale_seconds
FROM events"""
# Tokyo is nine hours ahead all year.  Denver is seven behind, six from the first Sunday
# of April to the last of October, which was the rule in the years the flights cover.
# The hour skipped in April counts as winter time, the one repeated in October as summer.
ORACLE["weather_hour_utc"] = _flights(
    """, turns AS (
  SELECT y, a + CAST((7 - isodow(a)) AS INTEGER) AS spring,
         b - CAST(isodow(b) % 7 AS INTEGER) AS autumn
  FROM (SELECT y, make_date(y, 4, 1) AS a, make_date(y, 10, 31) AS b
        FROM range(1994, 2003) r(y))
),
local AS (
  SELECT origin, n_nationkey, CAST(flight_date AS TIMESTAMP) + to_hours(dep_hour) AS ts,
         CAST(spring AS TIMESTAMP) + INTERVAL 3 HOUR AS spring,
         CAST(autumn AS TIMESTAMP) + INTERVAL 2 HOUR AS autumn
  FROM flights JOIN nation ON origin = n_name JOIN turns ON y = year(flight_date)
),
utc AS (
  SELECT origin, CASE WHEN n_nationkey % 2 = 1 THEN ts - INTERVAL 9 HOUR
                      WHEN ts >= spring AND ts < autumn THEN ts + INTERVAL 6 HOUR
                      ELSE ts + INTERVAL 7 HOUR END AS u
  FROM local
)
SELECT origin, year(u) * 1000000 + month(u) * 10000 + day(u) * 100 + hour(u) AS hour_key,
       count(*) AS flights
FROM utc GROUP BY ALL"""
)
ORACLE["risk_band"] = (
    "WITH "
    + _SCORES
    + """
SELECT round(p, 6) AS p,
       CASE WHEN p < CAST(0.2 AS DOUBLE) THEN 'low' WHEN p < CAST(0.45 AS DOUBLE) THEN 'moderate'
            ELSE 'high' END AS band,
       list_sum(list_transform(range(1, 10),
             lambda k: CAST(p >= k * CAST(0.1 AS DOUBLE) AS INTEGER))) AS bin,
       count(*) AS n
FROM scores GROUP BY ALL"""
)
_MILES = """2 * CAST(3958.8 AS DOUBLE) * asin(sqrt(
         pow(sin(radians({y}lat - {x}lat) / 2), 2) + cos(radians({x}lat)) * cos(radians({y}lat))
         * pow(sin(radians({y}lon - {x}lon) / 2), 2)))"""
ORACLE["haversine"] = _flights(
    f"""SELECT origin, dest, round(m, 3) AS miles,
       round(round(m, 0) / 7 + 40, 0) AS minutes
FROM (SELECT origin, dest, {_MILES.format(x="a.", y="b.")} AS m
      FROM (SELECT DISTINCT origin, dest FROM staged)
      JOIN airports a ON origin = a.iata JOIN airports b ON dest = b.iata)"""
)
ORACLE["bbox_filter"] = _positions(f"SELECT event_id, lat, lon FROM positions WHERE {_BOX}")
ORACLE["geo_cell"] = _positions(
    """SELECT floor(lat / 0.5) * 0.5 AS cell_lat, floor(lon / 0.5) * 0.5 AS cell_lon, count(*) AS n
FROM (SELECT lat, lon FROM positions) GROUP BY ALL"""
).replace("0.5", "CAST(0.5 AS DOUBLE)")
_ENTRIES = (
    ("discount", "(l_discount - CAST(0.05 AS DOUBLE)) * 50"),
    ("tax", "(l_tax - CAST(0.04 AS DOUBLE)) * 50"),
    ("quantity", "(l_quantity - 25) / 10"),
    ("price", "(CAST(50000 AS DOUBLE) - l_extendedprice) / 10000"),
)
_SORTABLE = ", ".join(f"{{'s': -abs({c}), 'f': '{f}', 'c': {c}}}" for f, c in _ENTRIES)
ORACLE["top_factors"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rank, e.f AS feature,
       round(e.c, 6) AS contribution,
       CASE WHEN e.c >= 0 THEN 'increases' ELSE 'decreases' END AS direction
FROM (SELECT *, unnest(range(0, 3)) AS rank, unnest(list_sort([{_SORTABLE}])[1:3]) AS e
      FROM lineitem)"""

# --- documents and messages --------------------------------------------------------------------

ORACLE["json_hourly_explode"] = """
SELECT event_id, date_trunc('hour', ts) + to_hours(CAST(h AS BIGINT)) AS time,
       CASE h WHEN 0 THEN value WHEN 1 THEN value + 1 END AS temperature_2m,
       CASE WHEN h = 0 THEN value / 2 END AS precipitation,
       CAST(NULL AS DOUBLE) AS wind_speed_10m, CAST(NULL AS DOUBLE) AS wind_gusts_10m,
       CAST(h AS DOUBLE) AS snowfall
FROM events, range(0, 3) r(h)"""
ORACLE["state_vector_parse"] = _positions(
    """SELECT event_id, event_ts AS snapshot_time, icao24, trim(callsign) AS callsign, lat, lon,
       CASE WHEN on_ground THEN CAST(100.5 AS DOUBLE) ELSE altitude END AS altitude,
       CAST(7.5 AS DOUBLE) AS velocity, CAST(90 AS DOUBLE) AS heading, on_ground
FROM positions
UNION ALL
SELECT event_id, event_ts, 'x', NULL, lat, lon, NULL, NULL, NULL, false FROM positions"""
)
ORACLE["snapshot_payload"] = _positions(
    f"""SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_ts ELSE {NOW} END AS as_of,
       CASE WHEN event_id % 7 <> 0 THEN greatest(0, {NOW} - event_ts) ELSE 0 END AS stale_seconds,
       'live' AS source, CASE WHEN on_ground THEN 1 ELSE 2 END AS count, 8 AS fields, lat, on_ground
FROM positions"""
)
ORACLE["event_messages"] = _positions(
    """SELECT icao24 AS message_key, icao24, callsign, lat, lon, altitude, on_ground, event_ts
FROM positions WHERE event_id % 11 <> 0"""
)


def _congestion(starts: str, seconds: int, size: str, having: str, extra: str = "") -> str:
    return _positions(
        f"""SELECT make_timestamp(w * 1000000) AS window_start,
       make_timestamp((w + {seconds}) * 1000000) AS window_end,
       floor(lat / {size}) * {size} AS cell_lat, floor(lon / {size}) * {size} AS cell_lon,
       count(DISTINCT icao24) AS aircraft_count,
       CAST(sum(CASE WHEN on_ground THEN 1 ELSE 0 END) AS BIGINT) AS on_ground_count,
       round(avg(altitude), 0) AS avg_altitude_m
FROM (SELECT *, unnest({starts}) AS w FROM positions WHERE {_BOX} {extra})
GROUP BY w, floor(lat / {size}) * {size}, floor(lon / {size}) * {size} {having}"""
    )


ORACLE["congestion_windows"] = _congestion(
    "[event_ts // 120 * 120]", 120, "CAST(0.5 AS DOUBLE)", ""
)
ORACLE["congestion_sliding"] = _congestion(
    "[event_ts // 10800 * 10800, event_ts // 10800 * 10800 - 10800]",
    21600,
    "CAST(10 AS DOUBLE)",
    "HAVING count(DISTINCT icao24) >= 3",
)
_DAILY = _congestion("[event_ts // 86400 * 86400]", 86400, "CAST(2 AS DOUBLE)", "", "AND NOT on_ground")
ORACLE["keyed_json"] = f"""
SELECT cell_lat || ':' || cell_lon AS key,
       '{{"window_start":"' || strftime(window_start, '%Y-%m-%d %H:%M:%S')
       || '","window_end":"' || strftime(window_end, '%Y-%m-%d %H:%M:%S')
       || '","cell_lat":' || cell_lat || ',"cell_lon":' || cell_lon
       || ',"aircraft_count":' || aircraft_count || ',"on_ground_count":' || on_ground_count
       || ',"avg_altitude_m":' || avg_altitude_m || '}}' AS value
FROM ({_DAILY})"""
ORACLE["latest_per_key"] = _positions(
    """SELECT event_id, icao24, lat, lon, altitude, velocity, heading, on_ground, event_ts
FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY event_ts DESC, event_id DESC) AS rn
      FROM positions) WHERE rn = 1"""
)
ORACLE["latest_with_ttls"] = _positions(
    """SELECT event_id, icao24, lat, lon, altitude, velocity, heading, on_ground, event_ts,
       CASE WHEN last - event_ts < 300 THEN 'live' ELSE 'cached' END AS source,
       event_ts + CASE WHEN last - event_ts < 300 THEN 300 ELSE 86400 END AS expires_at
FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY event_ts DESC, event_id DESC) AS rn,
             max(event_ts) OVER () AS last FROM positions)
WHERE rn = 1 AND last - event_ts < 86400"""
)
ORACLE["positions_fallback"] = _positions(
    f"""SELECT feed, tier, as_of, n AS count,
       CASE WHEN tier = 3 THEN 0 ELSE greatest(0, {NOW} - as_of) END AS stale_seconds,
       CASE WHEN tier = 3 THEN 'sample' WHEN {NOW} - as_of <= 120 THEN 'live' ELSE 'cached' END
         AS source
FROM (SELECT *, min(tier) OVER (PARTITION BY feed) AS best FROM (
  SELECT icao24 AS feed, 1 AS tier, max(event_ts) AS as_of,
         count(*) FILTER (WHERE {_BOX} AND event_ts >= {NOW} - 3600) AS n
  FROM positions GROUP BY icao24
  UNION ALL
  SELECT icao24, 2, max(event_ts), count(*) FILTER (WHERE {_BOX} AND event_ts >= {NOW} - 86400)
  FROM positions GROUP BY icao24
  UNION ALL
  SELECT icao24, 3, min(event_ts), count(*) FILTER (WHERE {_BOX} AND NOT on_ground)
  FROM positions GROUP BY icao24) WHERE n > 0)
WHERE tier = best"""
)

# --- marts -----------------------------------------------------------------------------------------

_MARTS = f""",
routes AS (SELECT origin, dest, count(*) AS flights, {_RATE} AS delay_rate,
                  avg(dep_delay_minutes) AS avg_delay_min FROM staged GROUP BY ALL),
route_carriers AS (SELECT origin, dest, carrier, count(*) AS flights, {_RATE} AS delay_rate
                   FROM staged GROUP BY ALL),
origins AS (SELECT origin, count(*) AS flights, {_RATE} AS overall_delay_rate
            FROM staged GROUP BY ALL),
carriers AS (SELECT carrier, count(*) AS flights, {_RATE} AS delay_rate FROM staged GROUP BY ALL),
origin_hours AS (SELECT origin, dep_hour AS hour, count(*) AS flights, {_RATE} AS delay_rate
                 FROM staged GROUP BY ALL),
worst AS (SELECT origin, dest, flights, delay_rate,
                 row_number() OVER (PARTITION BY origin
                                    ORDER BY delay_rate DESC, flights DESC, dest) AS rnk
          FROM routes)"""


def _marts(body: str) -> str:
    return "WITH " + _FLIGHTS + _MARTS + "\n" + body


ORACLE["agg_route_reliability"] = _marts("SELECT * FROM routes")
ORACLE["agg_route_carrier_reliability"] = _marts("SELECT * FROM route_carriers")
ORACLE["agg_airport_reliability"] = _marts("SELECT * FROM origins")
ORACLE["agg_airport_hourly"] = _marts("SELECT * FROM origin_hours")
ORACLE["agg_carrier_reliability"] = _marts("SELECT * FROM carriers")
ORACLE["agg_hourly_patterns"] = _flights(
    f"""SELECT dep_hour, day_of_week, count(*) AS flights, {_RATE} AS delay_rate
FROM staged GROUP BY ALL"""
)
ORACLE["hourly_rollup"] = _flights(
    f"SELECT dep_hour, count(*) AS flights, round({_RATE}, 9) AS delay_rate FROM staged GROUP BY ALL"
)
ORACLE["agg_airport_worst_routes"] = _marts("SELECT * FROM worst")
ORACLE["top_delayed_routes"] = _marts(
    """SELECT * FROM routes WHERE flights >= 50
ORDER BY delay_rate DESC, origin, dest LIMIT 10"""
)

# --- serving -------------------------------------------------------------------------------------------

ORACLE["carrier_options"] = _marts(
    """SELECT carrier AS code, CASE WHEN carrier = '4-NOT SPECIFIED' THEN '4-not Specified'
         ELSE substr(carrier, 1, 1) || '-' || lower(substr(carrier, 3)) END AS name
FROM carriers"""
)
ORACLE["example_presets"] = _marts(
    """SELECT r.origin, r.dest, c.carrier, 5 AS day_of_week, 17 AS dep_hour, r.flights
FROM (SELECT * FROM routes ORDER BY flights DESC, origin, dest LIMIT 4) r
JOIN (SELECT *, row_number() OVER (PARTITION BY origin, dest ORDER BY flights DESC, carrier) AS rn
      FROM route_carriers) c ON r.origin = c.origin AND r.dest = c.dest AND rn = 1"""
)
_MILLIONTHS = "CAST(round(round(delay_rate, 6) * 1000000, 0) AS BIGINT)"
ORACLE["route_lookup"] = _marts(
    f"""SELECT r.origin, r.dest, round(r.delay_rate, 6) AS delay_rate, r.flights,
       round(r.avg_delay_min, 6) AS avg_delay_min, by_carrier
FROM routes r JOIN (
  SELECT origin, dest, string_agg(carrier || ':' || {_MILLIONTHS}, ';'
                                  ORDER BY flights DESC, carrier) AS by_carrier
  FROM route_carriers GROUP BY ALL) c ON r.origin = c.origin AND r.dest = c.dest
WHERE r.origin = 'NATION_3'"""
)
_NEARBY = """
nearby AS (
  SELECT iata, count(event_id) AS aircraft_nearby
  FROM airports a LEFT JOIN positions p
    ON abs(p.lat - a.lat) <= CAST(1.5 AS DOUBLE) AND abs(p.lon - a.lon) <= CAST(1.5 AS DOUBLE)
  GROUP BY iata
)"""
_LEVEL = "CASE WHEN aircraft_nearby >= 30 THEN 'high' WHEN aircraft_nearby >= 10 THEN 'moderate' ELSE 'low' END"
ORACLE["airport_bridge"] = (
    "WITH "
    + _FLIGHTS
    + _MARTS
    + ","
    + _POSITIONS
    + ","
    + _NEARBY
    + f"""
SELECT a.iata, a.name, a.lat, a.lon, round(overall_delay_rate, 6) AS overall_delay_rate,
       coalesce(by_hour, '') AS by_hour, coalesce(worst_routes, '') AS worst_routes,
       aircraft_nearby, {_LEVEL} AS level
FROM airports a
LEFT JOIN origins o ON a.iata = o.origin
LEFT JOIN (SELECT origin, string_agg(hour || ':' || {_MILLIONTHS}, ';' ORDER BY hour) AS by_hour
           FROM origin_hours GROUP BY origin) h ON a.iata = h.origin
LEFT JOIN (SELECT origin, string_agg(dest || ':' || {_MILLIONTHS}, ';' ORDER BY rnk) AS worst_routes
           FROM worst GROUP BY origin) w ON a.iata = w.origin
JOIN nearby n ON a.iata = n.iata"""
)
ORACLE["airport_congestion"] = (
    "WITH "
    + _FLIGHTS
    + ","
    + _POSITIONS
    + ","
    + _NEARBY
    + f"""
SELECT a.iata, lat, lon, aircraft_nearby, {_LEVEL} AS level
FROM airports a JOIN nearby n ON a.iata = n.iata"""
)
ORACLE["airports_in_use"] = _flights(
    """SELECT iata, name, count(*) AS flights
FROM airports JOIN (SELECT origin AS code FROM flights UNION ALL SELECT dest FROM flights)
  ON iata = code
GROUP BY iata, name ORDER BY flights DESC, iata LIMIT 12"""
)
ORACLE["route_medians"] = _flights(
    """SELECT origin, dest, round(median(distance), 6) AS median_distance,
       round(median(crs_elapsed_time), 6) AS median_crs_elapsed_time
FROM flights GROUP BY origin, dest"""
)

# --- history, enrichment, features -----------------------------------------------------------------------

_PRIOR_ALL = f"coalesce((SELECT {_RATE} FROM flights), 0)"
_PRIOR_TRAIN = f"coalesce((SELECT {_RATE} FROM flights WHERE {_TRAIN}), 0)"


def _history(prior: str) -> str:
    parts = []
    for name, keys in (("route", "origin, dest"), ("origin", "origin"), ("carrier", "carrier")):
        w = (
            f"OVER (PARTITION BY {keys} ORDER BY day_num "
            "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        )
        parts.append(
            f"""
{name}_hist AS (
  SELECT {keys}, day_num, coalesce(CAST(sum(s) {w} AS DOUBLE) / sum(c) {w}, {prior})
           AS {name}_hist_delay_rate
  FROM (SELECT {keys}, day_num, sum(dep_del15) AS s, count(*) AS c FROM flights GROUP BY ALL)
)"""
        )
    parts.append(
        """
history AS (
  SELECT * FROM flights JOIN route_hist USING (origin, dest, day_num)
  JOIN origin_hist USING (origin, day_num) JOIN carrier_hist USING (carrier, day_num)
)"""
    )
    return ",".join(parts)


_RATES = "route_hist_delay_rate, origin_hist_delay_rate, carrier_hist_delay_rate"
ORACLE["hist_features"] = _flights(f"SELECT {FLIGHT}, {_RATES} FROM history", _history(_PRIOR_ALL))
ORACLE["hist_features_train_prior"] = _flights(
    f"SELECT {FLIGHT}, {_RATES} FROM history", _history(_PRIOR_TRAIN)
)
ORACLE["prior_rate_route"] = _flights(
    "SELECT origin, dest, day_num, route_hist_delay_rate AS prior_rate FROM route_hist",
    _history(_PRIOR_ALL),
)


def _weather_columns(fill: dict[str, float]) -> str:
    return ", ".join(
        f"coalesce({a}.{s}, CAST({fill[s]} AS DOUBLE)) AS {side}_{s}"
        for side, a in (("origin", "wo"), ("dest", "wd"))
        for s in fill
    )


_FOLD = """(SELECT *, DATE '2024-01-01'
          + CAST((date_diff('day', DATE '1995-01-01', flight_date) % 30 + 30) % 30 AS INTEGER)
          AS folded FROM {rows})"""
_HOURS = _FOLDED.format(hour="dep_hour")
_WEATHER_JOINS = f"""
LEFT JOIN weather wo ON wo.iata = f.origin AND wo.hour_key = {_HOURS}
LEFT JOIN weather wd ON wd.iata = f.dest AND wd.hour_key = {_HOURS}"""
ORACLE["weather_join"] = _flights(
    f"SELECT {FLIGHT}, {_weather_columns(WEATHER_FILL)} FROM {_FOLD.format(rows='flights')} f"
    + _WEATHER_JOINS,
    _WEATHER,
)
ORACLE["gold_features"] = _flights(
    f"""SELECT origin, dest, carrier, dep_hour, day_of_week, month, time_of_day_bucket, distance,
       crs_elapsed_time, is_holiday_window, {_RATES}, {_weather_columns(WEATHER_FILL)},
       dep_del15, flight_date, year
FROM {_FOLD.format(rows="history")} f""" + _WEATHER_JOINS,
    _history(_PRIOR_ALL),
    _WEATHER,
)

_BASE = f""",
base_rates AS (SELECT origin, dest, {_RATE} AS base_rate, count(dep_del15) AS n FROM flights
               WHERE {_TRAIN} GROUP BY ALL HAVING count(dep_del15) >= {{least}})"""
_ROUND_TRIP = _MILES.format(x="a.", y="b.")
def _serve(rates: dict[str, str], joins: str, *more: str) -> str:
    """Requests with their features; ``rates`` are expressions over the tables of ``joins``."""
    return (
        "WITH "
        + ",".join([_FLIGHTS + _MARTS + _BASE.format(least=30), _WEATHER, *more])
        + f""",
medians AS (SELECT origin, dest, round(median(distance), 6) AS d,
                   round(median(crs_elapsed_time), 6) AS e
            FROM flights GROUP BY ALL),
asked AS (
  SELECT o_orderkey AS request_id, coalesce(so.n_name, 'NOWHERE') AS origin, cn.n_name AS dest,
         o_orderpriority AS carrier, CAST(o_orderdate AS DATE) AS flight_date,
         CAST(o_orderkey % 24 AS INTEGER) AS dep_hour
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
  LEFT JOIN nation so ON o_orderkey % 27 = so.n_nationkey
),
known AS (
  SELECT q.*, coalesce(m.d, round({_ROUND_TRIP}, 0), 800) AS distance, m.e,
         coalesce(base_rate, {_PRIOR_TRAIN}) AS baseline_probability,
         coalesce({rates["route"]}, base_rate, {_PRIOR_TRAIN}) AS route_hist_delay_rate,
         coalesce({rates["origin"]}, {_PRIOR_TRAIN}) AS origin_hist_delay_rate,
         coalesce({rates["carrier"]}, {_PRIOR_TRAIN}) AS carrier_hist_delay_rate
  FROM asked q
  LEFT JOIN medians m ON q.origin = m.origin AND q.dest = m.dest
  LEFT JOIN base_rates br ON q.origin = br.origin AND q.dest = br.dest
  {joins}
  LEFT JOIN airports a ON q.origin = a.iata
  LEFT JOIN airports b ON q.dest = b.iata
),
served AS (
  SELECT request_id, flight_date, origin, dest, carrier, dep_hour,
         CAST(isodow(flight_date) AS INTEGER) AS day_of_week,
         CAST(month(flight_date) AS INTEGER) AS month,
         CASE WHEN dep_hour < 6 THEN 'night' WHEN dep_hour < 12 THEN 'morning'
              WHEN dep_hour < 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day_bucket,
         distance, coalesce(e, round(distance / 7 + 40, 0)) AS crs_elapsed_time,
         CAST(CAST(flight_date IN (SELECT day FROM near_holidays) AS INTEGER) AS DOUBLE)
           AS is_holiday_window,
         {_RATES}, {_weather_columns({**WEATHER_FILL, "wind_speed": 8.0})},
         baseline_probability
  FROM {_FOLD.format(rows="known")} f {_WEATHER_JOINS}
)
"""
    )


_MART_RATES = {"route": "round(r.delay_rate, 6)", "origin": "round(o.overall_delay_rate, 6)", "carrier": "round(c.delay_rate, 6)"}
_MART_JOINS = """LEFT JOIN routes r ON q.origin = r.origin AND q.dest = r.dest
  LEFT JOIN origins o ON q.origin = o.origin
  LEFT JOIN carriers c ON q.carrier = c.carrier"""
ORACLE["serve_features"] = _serve(_MART_RATES, _MART_JOINS) + "SELECT *, round(origin_temp_2m, 1) AS temp_c, round(dest_precip, 2) AS precip_mm FROM served"


def _running(name: str, keys: str) -> str:
    return f"""
{name} AS (
  SELECT {keys}, flight_date, CAST(sum(s) OVER w AS DOUBLE) / sum(c) OVER w AS rate
  FROM (SELECT {keys}, flight_date, sum(dep_del15) AS s, count(*) AS c FROM flights GROUP BY ALL)
  WINDOW w AS (PARTITION BY {keys} ORDER BY flight_date))"""


ORACLE["serve_features_as_of"] = _serve(
    {"route": "r.rate", "origin": "o.rate", "carrier": "c.rate"},
    """ASOF LEFT JOIN upto_route r ON q.origin = r.origin AND q.dest = r.dest AND q.flight_date > r.flight_date
  ASOF LEFT JOIN upto_origin o ON q.origin = o.origin AND q.flight_date > o.flight_date
  ASOF LEFT JOIN upto_carrier c ON q.carrier = c.carrier AND q.flight_date > c.flight_date""",
    _running("upto_route", "origin, dest"),
    _running("upto_origin", "origin"),
    _running("upto_carrier", "carrier"),
) + "SELECT * FROM served"
ORACLE["serve_features_horizon"] = _serve(_MART_RATES, _MART_JOINS) + f"""
SELECT request_id, wo.iata IS NOT NULL OR wd.iata IS NOT NULL AS weather_ok, {_weather_columns({**WEATHER_FILL, "wind_speed": 8.0})}
FROM {_FOLD.format(rows="known")} f
LEFT JOIN weather wo ON wo.iata = f.origin AND wo.hour_key = {_HOURS} AND folded BETWEEN DATE '2024-01-10' AND DATE '2024-01-26'
LEFT JOIN weather wd ON wd.iata = f.dest AND wd.hour_key = {_HOURS} AND folded BETWEEN DATE '2024-01-10' AND DATE '2024-01-26'"""

# --- learning and evaluation --------------------------------------------------------------------------

ORACLE["temporal_split"] = _flights(
    """SELECT CASE WHEN year <= 1999 THEN 'train' ELSE 'test' END AS part, year, count(*) AS n,
       CAST(sum(dep_del15) AS BIGINT) AS positives
FROM flights WHERE year BETWEEN 1995 AND 2001 GROUP BY ALL"""
)
ORACLE["temporal_slices"] = _flights(
    f"""SELECT flight_date, {FLIGHT},
       CASE WHEN pos < n - nv - nc THEN 'fit' WHEN pos < n - nc THEN 'valid' ELSE 'calib' END
         AS slice
FROM (SELECT *, CASE WHEN a + b >= n THEN greatest(1, n // 5) ELSE a END AS nc,
             CASE WHEN a + b >= n THEN greatest(1, n // 5) ELSE b END AS nv
      FROM (SELECT flight_date, {FLIGHT}, count(*) OVER () AS n,
                   row_number() OVER (ORDER BY flight_date, substr(md5({FLIGHT}), 1, 3), {FLIGHT})
                     - 1 AS pos,
                   greatest(1, CAST(floor(count(*) OVER () * CAST(0.15 AS DOUBLE)) AS BIGINT)) AS a,
                   greatest(1, CAST(floor(count(*) OVER () * CAST(0.15 AS DOUBLE)) AS BIGINT)) AS b
            FROM flights WHERE {_TRAIN}))"""
)
ORACLE["base_rate_fit"] = "WITH " + _FLIGHTS + _BASE.format(least=60) + "\nSELECT * FROM base_rates"
ORACLE["base_rate_score"] = (
    "WITH "
    + _FLIGHTS
    + _BASE.format(least=60)
    + f"""
SELECT {FLIGHT}, coalesce(base_rate, {_PRIOR_TRAIN}) AS baseline_probability
FROM flights LEFT JOIN base_rates USING (origin, dest) WHERE {_TEST}"""
)
ORACLE["class_weight"] = _flights(
    f"""SELECT pos AS positives, neg AS negatives,
       CASE WHEN pos = 0 THEN 1 ELSE greatest(CAST(neg AS DOUBLE) / pos, 1) END AS scale_pos_weight
FROM (SELECT count(*) FILTER (WHERE dep_del15 = 1) AS pos,
             count(*) FILTER (WHERE dep_del15 = 0) AS neg FROM flights WHERE {_TRAIN})"""
)
ORACLE["category_levels"] = _flights(
    "SELECT feature, level, row_number() OVER (PARTITION BY feature ORDER BY n, level) - 1 AS code\n"
    "FROM ("
    + "\nUNION ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, "
        + (f"CAST({c} AS BIGINT)" if c in ("dep_hour", "day_of_week", "month") else "CAST(NULL AS BIGINT)")
        + " AS n FROM flights"
        for c in ("origin", "dest", "carrier", "dep_hour", "day_of_week", "month", "time_of_day_bucket")
    )
    + ")"
)
ORACLE["reliability_curve"] = (
    "WITH "
    + _SCORES
    + """
SELECT CAST(b AS INTEGER) AS bin, round(avg(p), 9) AS mean_predicted,
       round(avg(CAST(y AS DOUBLE)), 9) AS fraction_positive, count(p) AS n
FROM range(0, 10) r(b) LEFT JOIN scores
  ON p >= b * CAST(0.1 AS DOUBLE) AND (b = 9 OR p < (b + 1) * CAST(0.1 AS DOUBLE))
GROUP BY b"""
)
ORACLE["eval_brier"] = (
    "WITH "
    + _SCORES
    + """
SELECT name, count(*) AS n, round(avg(CAST(y AS DOUBLE)), 9) AS positive_rate,
       round(avg((p - y) * (p - y)), 9) AS brier
FROM scores GROUP BY name"""
)
_RANKED = """
by_score AS (SELECT name, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
             FROM {rows} GROUP BY ALL),
ranked AS (
  SELECT *, coalesce(sum(pos) OVER below, 0) AS pb, coalesce(sum(neg) OVER below, 0) AS nb,
         sum(pos) OVER (PARTITION BY name) AS pa, sum(neg) OVER (PARTITION BY name) AS na
  FROM by_score
  WINDOW below AS (PARTITION BY name ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
ranks AS (
  SELECT name, sum(pos * (nb + neg / 2)) / nullif(max(pa) * max(na), 0) AS roc_auc,
         sum(pos * (pa - pb) / (pa - pb + na - nb)) / nullif(max(pa), 0) AS average_precision
  FROM ranked GROUP BY name
)"""
_RANKS = "WITH " + _SCORES + "," + _RANKED.format(rows="scores")
ORACLE["roc_auc"] = _RANKS + "\nSELECT name, round(roc_auc, 9) AS roc_auc FROM ranks"
ORACLE["average_precision"] = (
    _RANKS + "\nSELECT name, round(average_precision, 9) AS average_precision FROM ranks"
)
ORACLE["evaluation"] = (
    "WITH "
    + _FLIGHTS
    + _BASE.format(least=30)
    + f""",
tested AS (
  SELECT dep_del15 AS y, least(1, crs_elapsed_time / 260) AS p,
         coalesce(base_rate, {_PRIOR_TRAIN}) AS b
  FROM flights LEFT JOIN base_rates USING (origin, dest) WHERE {_TEST}
),
long AS (
  SELECT 'raw' AS name, p * p AS p, y FROM tested
  UNION ALL SELECT 'cal', p, y FROM tested
  UNION ALL SELECT 'base', b, y FROM tested
),"""
    + _RANKED.format(rows="long")
    + """,
briers AS (SELECT name, count(*) AS n, avg(y) AS rate, avg((p - y) * (p - y)) AS brier
           FROM long GROUP BY name),
wide AS (
  SELECT max(n) AS n_test, max(rate) AS rate,
         max(roc_auc) FILTER (WHERE name = 'cal') AS mr,
         max(average_precision) FILTER (WHERE name = 'cal') AS mp,
         max(brier) FILTER (WHERE name = 'raw') AS br,
         max(brier) FILTER (WHERE name = 'cal') AS bc,
         max(roc_auc) FILTER (WHERE name = 'base') AS cr,
         max(average_precision) FILTER (WHERE name = 'base') AS cp,
         max(brier) FILTER (WHERE name = 'base') AS bb
  FROM ranks JOIN briers USING (name)
)
SELECT n_test, round(rate, 9) AS test_positive_rate, round(mr, 9) AS model_roc_auc,
       round(mp, 9) AS model_pr_auc, round(br, 9) AS model_brier_raw,
       round(bc, 9) AS model_brier_calibrated, round(cr, 9) AS baseline_roc_auc,
       round(cp, 9) AS baseline_pr_auc, round(bb, 9) AS baseline_brier,
       round(mr - cr, 9) AS roc_auc_lift, round(mp - cp, 9) AS pr_auc_lift,
       mr > cr AND mp > cp AS beats_baseline
FROM wide"""
)
ORACLE["training_facts"] = f"""SELECT n_test, test_positive_rate, baseline_roc_auc, baseline_pr_auc, baseline_brier,
       true AS calibrated_not_worse, true AS has_rounds FROM ({ORACLE["evaluation"]})"""
ORACLE["gate"] = (
    _RANKS
    + """,
runs AS (SELECT name AS run, round(roc_auc, 9) AS roc_auc FROM ranks),
seen AS (
  SELECT *, max(CASE WHEN roc_auc >= CAST(0.5 AS DOUBLE) THEN roc_auc END) OVER (
           ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM runs
)
SELECT *, coalesce(roc_auc >= CAST(0.5 AS DOUBLE) AND (previous IS NULL OR roc_auc > previous), false)
         AS published FROM seen"""
)

# --- data quality -----------------------------------------------------------------------------------------

_CHECKED = f""",
checked AS (
  SELECT {FLIGHT}, dep_hour, crs_dep_time, day_of_week, distance, dep_del15, origin,
         CASE WHEN dep_hour <> 3 THEN carrier END AS carrier,
         CASE WHEN dep_hour = 9 THEN 'X ' || dest WHEN dep_hour <> 5 THEN dest END AS dest
  FROM flights
),
known AS (SELECT iata FROM airports)"""


def _checks(body: str) -> str:
    return "WITH " + _FLIGHTS + _CHECKED + "\n" + body


ORACLE["dq_not_null"] = _checks(f"SELECT {FLIGHT}, dep_hour FROM checked WHERE carrier IS NULL")
ORACLE["dq_unique"] = """
SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL
GROUP BY l_orderkey HAVING count(*) > 1"""
ORACLE["dq_unique_combination"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
ORACLE["dq_accepted_values"] = """
SELECT o_orderstatus AS value, count(*) AS n FROM orders
WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus"""
ORACLE["dq_accepted_range"] = "SELECT l_quantity FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45"
ORACLE["dq_relationships"] = _checks(
    """SELECT dest AS value, count(*) AS n FROM checked
WHERE dest IS NOT NULL AND dest NOT IN (SELECT iata FROM known) GROUP BY dest"""
)


def _counted(check: str, column: str, source: str) -> str:
    return (
        f"SELECT 'flights' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\", "
        f"count(*) AS violations FROM {source}"
    )


_UNKNOWN = "checked WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT iata FROM known)"
ORACLE["dq_report"] = _checks(
    "\nUNION ALL ".join(
        [
            *[_counted("not_null", c, f"checked WHERE {c} IS NULL") for c in ("carrier", "dest", "origin")],
            _counted("unique", FLIGHT, f"(SELECT 1 FROM checked GROUP BY {FLIGHT} HAVING count(*) > 1)"),
            _counted(
                "unique_combination",
                "origin,dest,crs_dep_time",
                "(SELECT 1 FROM checked GROUP BY origin, dest, crs_dep_time HAVING count(*) > 1)",
            ),
            _counted("accepted_values", LABEL, f"checked WHERE {LABEL} NOT IN (0, 1)"),
            _counted("accepted_values", "day_of_week", "checked WHERE day_of_week NOT IN (1, 2, 3, 4, 5)"),
            _counted("accepted_range", "dep_hour", "checked WHERE dep_hour < 0 OR dep_hour > 20"),
            _counted("accepted_range", "distance", "checked WHERE distance < 2000 OR distance > 90000"),
            *[_counted("relationships", c, _UNKNOWN.format(c=c)) for c in ("origin", "dest")],
        ]
    )
)
