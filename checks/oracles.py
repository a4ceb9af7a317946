"""DuckDB SQL for every registered query, written from the rules and not from the Spark plans."""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"

EVENTS = "ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"


def rounded(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


def occupancy(bikes: str, docks: str) -> str:
    return rounded(f"{bikes} / (CASE WHEN {docks} = 0 THEN 1 ELSE {docks} END) * 100")


# The edges of the occupancy buckets, the labels of severities, the scores of bands.


def availability(pct: str) -> str:
    return (
        f"CASE WHEN {pct} > -1 AND {pct} <= 0 THEN 'Empty' WHEN {pct} > 0 AND {pct} <= 25 THEN 'Low' "
        f"WHEN {pct} > 25 AND {pct} <= 75 THEN 'Available' WHEN {pct} > 75 AND {pct} <= 101 THEN 'Full' ELSE 'nan' END"
    )


def severity_label(code: str) -> str:
    return (
        f"CASE {code} WHEN 10 THEN 'Good Service' WHEN 9 THEN 'Minor Delays' WHEN 8 THEN 'Severe Delays' "
        "WHEN 7 THEN 'Reduced Service' WHEN 6 THEN 'Bus Service' WHEN 5 THEN 'Part Suspended' "
        "WHEN 4 THEN 'Planned Closure' WHEN 3 THEN 'Part Closure' WHEN 2 THEN 'Suspended' WHEN 1 THEN 'Closed' "
        "WHEN 0 THEN 'Special Service' WHEN 20 THEN 'Not Running' ELSE 'Unknown' END"
    )


def band_score(band: str) -> str:
    return f"CASE {band} WHEN 'Low' THEN 1 WHEN 'Moderate' THEN 2 WHEN 'High' THEN 3 WHEN 'Very High' THEN 4 ELSE 0 END"


def capital(name: str) -> str:
    return f"upper(substr({name}, 1, 1)) || lower(substr({name}, 2))"


# --- bronze shapes -----------------------------------------------------------------

LINE_BRONZE = """line_bronze AS (
  SELECT ts AS extracted_at, CAST(ts AS DATE) AS extracted_date, event_type AS line_id,
         upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS line_name,
         k % 21 AS status_severity, (k % 21) <> 10 AS is_disrupted
  FROM ev)"""

BIKE_BRONZE = f"""bike0 AS (
  SELECT ts AS extracted_at, CAST(ts AS DATE) AS extracted_date, CAST(user_id AS INT) AS station_id,
         'Stop ' || user_id AS name,
         CAST(51 AS DOUBLE) + CAST(user_id AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat,
         CAST(0 AS DOUBLE) - CAST(user_id AS DOUBLE) / CAST(1000 AS DOUBLE) AS lon,
         CAST(floor(value) AS INT) % 45 AS nb_bikes, k % 40 AS nb_docks
  FROM ev),
bike_bronze AS (
  SELECT *, CASE WHEN nb_docks > nb_bikes THEN nb_docks - nb_bikes ELSE 0 END AS nb_empty_docks,
         {occupancy('nb_bikes', 'nb_docks')} AS occupancy_pct
  FROM bike0)"""

AIR_BRONZE = """air_bronze AS (
  SELECT ts AS extracted_at, CAST(ts AS DATE) AS extracted_date, event_type AS forecast_type,
         CASE k % 5 WHEN 0 THEN 'Low' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'High'
                    WHEN 3 THEN 'Very High' ELSE 'Unrated' END AS forecast_band,
         CASE k % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 ELSE 0 END AS forecast_score,
         'A' || (k % 7) AS no2_band, 'B' || (k % 3) AS o3_band, 'C' || (k % 2) AS pm10_band,
         'D' || (k % 11) AS pm25_band, 'E' || (k % 4) AS so2_band
  FROM ev)"""


# --- gold --------------------------------------------------------------------------


def daily_line(bronze: str) -> str:
    return f"""
SELECT extracted_date AS summary_date, line_id, line_name,
       CAST(count(*) AS INT) AS total_snapshots,
       CAST(count(*) FILTER (WHERE is_disrupted) AS INT) AS disrupted_snapshots,
       {rounded('count(*) FILTER (WHERE is_disrupted) * CAST(100 AS DOUBLE) / count(*)')} AS disruption_rate_pct,
       min(status_severity) AS min_severity, max(status_severity) AS max_severity,
       {rounded('avg(status_severity)')} AS avg_severity
FROM {bronze} GROUP BY extracted_date, line_id, line_name"""


def hourly_line(bronze: str) -> str:
    return f"""
SELECT CAST(extracted_at AS DATE) AS summary_date, CAST(hour(extracted_at) AS INT) AS summary_hour, line_id, line_name,
       CAST(count(*) AS INT) AS total_snapshots,
       CAST(count(*) FILTER (WHERE is_disrupted) AS INT) AS disrupted_snapshots,
       {rounded('count(*) FILTER (WHERE is_disrupted) * CAST(100 AS DOUBLE) / count(*)')} AS disruption_rate_pct,
       {rounded('avg(status_severity)')} AS avg_severity
FROM {bronze} GROUP BY 1, 2, 3, 4"""


# Summed as decimals, so that the order of the rows has no say in the last digit.
STATION_MEASURES = f"""
       {rounded('avg(nb_bikes)')} AS avg_bikes,
       {rounded('avg(nb_empty_docks)')} AS avg_empty_docks,
       {rounded('CAST(sum(CAST(occupancy_pct AS DECIMAL(18, 2))) AS DOUBLE) / count(*)')} AS avg_occupancy_pct,
       CAST(count(*) AS INT) AS total_snapshots"""


def daily_bike(bronze: str) -> str:
    return f"""
SELECT extracted_date AS summary_date, station_id, name, lat, lon, {STATION_MEASURES}
FROM {bronze} GROUP BY extracted_date, station_id, name, lat, lon"""


def hourly_bike(bronze: str) -> str:
    return f"""
SELECT CAST(extracted_at AS DATE) AS summary_date, CAST(hour(extracted_at) AS INT) AS summary_hour,
       station_id, name, lat, lon, {STATION_MEASURES}
FROM {bronze} GROUP BY 1, 2, 3, 4, 5, 6"""


def daily_air(bronze: str) -> str:
    return f"""
SELECT summary_date, forecast_type, forecast_band, forecast_score, no2_band, o3_band, pm10_band, pm25_band, so2_band
FROM (SELECT extracted_date AS summary_date, forecast_type, forecast_band,
             max(forecast_score) OVER (PARTITION BY extracted_date, forecast_type, forecast_band) AS forecast_score,
             no2_band, o3_band, pm10_band, pm25_band, so2_band,
             row_number() OVER (PARTITION BY extracted_date, forecast_type, forecast_band
                                ORDER BY extracted_at, no2_band, o3_band, pm10_band, pm25_band, so2_band) AS pos
      FROM {bronze}) AS ranked
WHERE pos = 1"""


def over(*ctes: str, query: str) -> str:
    return f"WITH {', '.join((EVENTS, *ctes))} {query}"


# --- documents ---------------------------------------------------------------------

FLATTEN_LINE_STATUS = f"""
WITH statuses AS (
  SELECT *, o_orderkey % 4 AS n, unnest(range(1, CAST(greatest(o_orderkey % 4, 1) + 1 AS INT))) AS i FROM orders)
SELECT strftime(o_orderdate, {ISO}) AS extracted_at, 'line-' || (o_custkey % 11) AS line_id, o_orderpriority AS line_name,
       CAST(CASE WHEN n = 0 OR (o_orderkey + i) % 5 = 0 THEN 10 ELSE (o_custkey + i * 3) % 21 END AS INT) AS status_severity,
       CASE WHEN n = 0 OR (o_custkey + i) % 7 = 0 THEN 'Good Service' ELSE ' d' || i END AS status_description,
       CASE WHEN n > 0 AND (o_custkey + i) % 3 = 0 AND o_orderkey % 2 = 0 THEN 'late ' || o_orderkey END AS disruption_reason,
       n > 0 AND (o_orderkey + i) % 5 <> 0 AND (o_custkey + i * 3) % 21 <> 10 AS is_disrupted
FROM statuses"""

FLATTEN_BIKE_POINTS = over(
    query=f"""
SELECT strftime(ts, {ISO}) AS extracted_at, 'BikePoints_' || user_id AS bike_point_id, 'Stop ' || user_id AS name,
       CAST(51 AS DOUBLE) + CAST(user_id AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat,
       CASE WHEN k % 4 <> 0 THEN CAST(0 AS DOUBLE) - CAST(user_id AS DOUBLE) / CAST(1000 AS DOUBLE) END AS lon,
       CAST(floor(value) AS INT) AS nb_bikes, CASE WHEN k % 3 = 1 THEN 7 ELSE 0 END AS nb_empty_docks,
       CASE WHEN k % 10 = 0 THEN 0 ELSE k + 5 END AS nb_docks
FROM ev
UNION ALL
SELECT strftime(ts, {ISO}), 'BikePoints_' || (user_id + 1000), '', NULL, NULL, 0, 0, 0 FROM ev"""
)

FLATTEN_AIR_QUALITY = over(
    query=f"""
SELECT strftime(ts, {ISO}) AS extracted_at, t.forecast_type,
       CASE WHEN k % 4 = 0 THEN '' ELSE t.band END AS forecast_band, 'summary ' || k AS forecast_summary,
       'A' || (k % 7) AS no2_band, CASE WHEN k % 3 = 0 THEN '' ELSE 'B' || (k % 3) END AS o3_band,
       'C' || (k % 2) AS pm10_band, 'D' || (k % 11) AS pm25_band, 'E' || (k % 6) AS so2_band
FROM ev JOIN (VALUES ('Current', 'Low', 0), ('Future', 'High', 1)) AS t(forecast_type, band, pos) ON t.pos <= k % 2
WHERE k % 10 NOT IN (0, 1)"""
)

# --- cleaners ----------------------------------------------------------------------

CLEAN_LINE_STATUS = over(
    query=f"""
SELECT ts AS extracted_at, CAST(ts AS DATE) AS extracted_date, event_type AS line_id,
       {capital('event_type')} || '-Line O''' || k || 'X' AS line_name, k % 22 AS status_severity,
       {severity_label('(k % 22)')} AS severity_label, 'status ' || (k % 22) AS status_description,
       CASE WHEN k % 22 <> 10 THEN 'because ' || event_type END AS disruption_reason, k % 22 <> 10 AS is_disrupted
FROM ev"""
)

CLEAN_BIKE_POINTS = over(
    query=f"""
SELECT b.extracted_at, b.extracted_date, b.station_id, 'BikePoints_' || b.station_id AS bike_point_id, b.name, b.lat, b.lon,
       b.nb_bikes, b.nb_empty_docks, b.nb_docks, b.occupancy_pct, {availability('b.occupancy_pct')} AS availability_status
FROM (SELECT extracted_at, extracted_date, station_id, name, lat, lon, nb_bikes, k % 13 AS nb_empty_docks, nb_docks,
             {occupancy('nb_bikes', 'nb_docks')} AS occupancy_pct
      FROM (SELECT ts AS extracted_at, CAST(ts AS DATE) AS extracted_date, CAST(user_id AS INT) AS station_id,
                   'Stop ' || user_id AS name,
                   CASE WHEN k % 9 = 4 THEN 'NaN'::DOUBLE
                     ELSE CAST(51 AS DOUBLE) + CAST(user_id AS DOUBLE) / CAST(1000 AS DOUBLE) END AS lat,
                   CASE WHEN k % 9 = 4 THEN 'NaN'::DOUBLE
                     ELSE CAST(0 AS DOUBLE) - CAST(user_id AS DOUBLE) / CAST(1000 AS DOUBLE) END AS lon,
                   CAST(floor(value) AS INT) % 45 AS nb_bikes, k % 40 AS nb_docks, k FROM ev)) AS b"""
)

CLEAN_AIR_QUALITY = over(
    query=f"""
SELECT ts AS extracted_at, CAST(ts AS DATE) AS extracted_date, event_type AS forecast_type, band AS forecast_band,
       {band_score('band')} AS forecast_score, 'summary ' || k AS forecast_summary, 'A' || (k % 7) AS no2_band,
       'B' || (k % 3) AS o3_band, 'C' || (k % 2) AS pm10_band, 'D' || (k % 11) AS pm25_band, 'E' || (k % 4) AS so2_band
FROM (SELECT *, CASE k % 6 WHEN 0 THEN 'Low' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'High' WHEN 3 THEN 'Very High'
                           WHEN 4 THEN 'Extreme' ELSE '' END AS band FROM ev)"""
)

# --- the pipeline over landed documents ----------------------------------------------

LANDED = f"""landed AS (
  SELECT *, CAST(ts AS DATE) AS extracted_date,
         date_trunc('day', ts) + CASE WHEN hour(ts) < 12 THEN INTERVAL 8 HOUR ELSE INTERVAL 16 HOUR END
           + INTERVAL 30 MINUTE + INTERVAL 15000001 MICROSECOND AS extracted_at
  FROM ev),
bronze_line_status AS (
  SELECT extracted_at, extracted_date, event_type AS line_id, {capital('event_type')} || '-Line' AS line_name,
         severity AS status_severity, {severity_label('severity')} AS severity_label,
         CASE WHEN k % 3 = 0 THEN 'Good Service' ELSE 's' || severity END AS status_description,
         CASE WHEN severity <> 10 THEN 'late ' || k END AS disruption_reason, severity <> 10 AS is_disrupted
  FROM (SELECT *, CASE WHEN k % 3 = 0 THEN 10 WHEN pos = 1 THEN k % 21 ELSE (k * 7 + 3) % 21 END AS severity
        FROM landed JOIN (VALUES (1), (2)) AS t(pos) ON pos <= greatest(k % 3, 1))),
bronze_bike_points AS (
  SELECT extracted_at, extracted_date, CAST(number AS INT) AS station_id, 'BikePoints_' || number AS bike_point_id,
         'Stop ' || number AS name, CAST(51 AS DOUBLE) + CAST(number AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat,
         CAST(0 AS DOUBLE) - CAST(number AS DOUBLE) / CAST(1000 AS DOUBLE) AS lon,
         CAST(nb_bikes AS INT) AS nb_bikes, CAST(greatest(nb_docks - nb_bikes, 0) AS INT) AS nb_empty_docks,
         CAST(nb_docks AS INT) AS nb_docks, {occupancy('nb_bikes', 'nb_docks')} AS occupancy_pct,
         {availability(occupancy('nb_bikes', 'nb_docks'))} AS availability_status
  FROM (SELECT *, user_id * 12 + j AS number, (CAST(floor(value) AS INT) + j) % 45 AS nb_bikes, (k + j * 3) % 40 AS nb_docks
        FROM landed CROSS JOIN range(12) AS t(j))),
bronze_air_quality AS (
  SELECT extracted_at, extracted_date, forecast_type, band AS forecast_band, {band_score('band')} AS forecast_score,
         'summary ' || k AS forecast_summary, 'A' || (k % 7) AS no2_band, 'B' || (k % 3) AS o3_band,
         'C' || (k % 2) AS pm10_band, 'D' || (k % 11) AS pm25_band, 'E' || (k % 6) AS so2_band
  FROM (SELECT *, CASE (k + shift) % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'High' ELSE 'Very High' END AS band
        FROM landed CROSS JOIN (VALUES ('Current', 0), ('Future', 1)) AS t(forecast_type, shift)))"""

STORED_GOLD = {
    "gold_daily_line_summary": daily_line("bronze_line_status"),
    "gold_hourly_line_summary": hourly_line("bronze_line_status"),
    "gold_daily_bike_summary": daily_bike("bronze_bike_points"),
    "gold_hourly_bike_summary": hourly_bike("bronze_bike_points"),
    "gold_daily_air_quality": daily_air("bronze_air_quality"),
}
STORED_BRONZE = ("bronze_line_status", "bronze_bike_points", "bronze_air_quality")


def stored(query: str, *gold: str) -> str:
    return over(LANDED, *(f"{name} AS ({STORED_GOLD[name]})" for name in gold), query=query)


ROW_TOTALS = stored(
    "SELECT (SELECT count(*) FROM bronze_line_status) AS line_status_rows, "
    "(SELECT count(*) FROM bronze_bike_points) AS bike_points_rows, "
    "(SELECT count(*) FROM bronze_air_quality) AS air_quality_rows"
)

LATEST_DISRUPTION = stored(
    "SELECT line_name, disruption_rate_pct, avg_severity FROM gold_daily_line_summary "
    "WHERE summary_date = (SELECT max(summary_date) FROM gold_daily_line_summary) ORDER BY disruption_rate_pct DESC",
    "gold_daily_line_summary",
)

BUSIEST_STATIONS = stored(
    "SELECT name, avg_occupancy_pct, avg_bikes FROM gold_daily_bike_summary "
    "WHERE summary_date = (SELECT max(summary_date) FROM gold_daily_bike_summary) "
    "ORDER BY avg_occupancy_pct DESC, station_id LIMIT 10",
    "gold_daily_bike_summary",
)

AIR_TREND = stored(
    "SELECT summary_date, forecast_type, forecast_band, forecast_score FROM gold_daily_air_quality "
    "WHERE summary_date >= DATE '2024-02-14' - 30 ORDER BY summary_date DESC",
    "gold_daily_air_quality",
)

SNAPSHOT_HISTORY = stored(
    "SELECT DISTINCT extracted_date, count(*) AS snapshots_that_day FROM bronze_line_status "
    "GROUP BY extracted_date ORDER BY extracted_date DESC"
)

# --- gates -------------------------------------------------------------------------

QUALITY_RAW = over(
    query="""
, checked AS (
  SELECT 'line_status' AS dataset, date_trunc('hour', ts) AS snapshot, 5 AS needed,
         (k % 23 - 1) NOT BETWEEN 0 AND 20 AS violates FROM ev
  UNION ALL
  SELECT 'bike_points', date_trunc('hour', ts), 100, CAST(floor(value) AS INT) % 45 < 1 OR k % 40 < 1 FROM ev
  UNION ALL
  SELECT 'air_quality', date_trunc('hour', ts), 1, k % 7 > 3 FROM ev),
per_snapshot AS (
  SELECT dataset, snapshot, needed, count(*) AS records, count(*) FILTER (WHERE violates) AS violations
  FROM checked GROUP BY dataset, snapshot, needed)
SELECT dataset, CAST(snapshot AS DATE) AS extracted_date, count(*) AS snapshots, CAST(sum(records) AS BIGINT) AS records,
       count(*) FILTER (WHERE records < needed) AS short_snapshots, CAST(sum(violations) AS BIGINT) AS violations,
       0::BIGINT AS repeated_documents,
       count(*) FILTER (WHERE records < needed) = 0 AND sum(violations) = 0 AS passed
FROM per_snapshot GROUP BY 1, 2""".lstrip()
)

QUALITY_GATE = over(
    query="""
, copied AS (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE k % 41 = 5),
checked AS (
  SELECT 'line_status' AS dataset, date_trunc('hour', ts) AS snapshot, event_id, 5 AS needed, k % 50 <> 7 AS is_record,
         (k % 23 - 1) NOT BETWEEN 0 AND 20 AS violates FROM copied
  UNION ALL
  SELECT 'bike_points', date_trunc('hour', ts), event_id, 100, k % 50 <> 7, CAST(floor(value) AS INT) % 45 < 1 OR k % 40 < 1
  FROM copied
  UNION ALL
  SELECT 'air_quality', date_trunc('hour', ts), event_id, 1, k % 50 <> 7 AND hour(ts) <> 5, k % 7 > 3 FROM copied),
per_document AS (
  SELECT dataset, snapshot, needed, event_id, count(*) AS times, count(*) FILTER (WHERE is_record) AS records,
         count(*) FILTER (WHERE is_record AND violates) AS violations
  FROM checked GROUP BY ALL),
per_snapshot AS (
  SELECT dataset, snapshot, needed, sum(records) AS records, sum(violations) AS violations,
         count(*) FILTER (WHERE times > 1) AS repeated
  FROM per_document GROUP BY dataset, snapshot, needed),
per_day AS (
  SELECT dataset, CAST(snapshot AS DATE) AS day, count(*) AS snapshots, sum(records) AS records,
         count(*) FILTER (WHERE records < needed) AS short, sum(violations) AS violations, sum(repeated) AS repeated
  FROM per_snapshot GROUP BY ALL),
asked AS (
  SELECT dataset, day FROM (VALUES ('line_status'), ('bike_points'), ('air_quality')) AS d(dataset),
    (SELECT DISTINCT CAST(ts AS DATE) AS day FROM ev WHERE CAST(ts AS DATE) > (SELECT min(CAST(ts AS DATE)) FROM ev)
     UNION ALL SELECT DATE '2030-01-01')),
found AS (
  SELECT dataset, day, coalesce(snapshots, 0) AS snapshots, coalesce(records, 0) AS records, coalesce(short, 0) AS short,
         coalesce(violations, 0) AS violations, coalesce(repeated, 0) AS repeated, 0 AS stray_dates, NULL::DATE AS first_stray,
         NULL::DATE AS last_stray,
         coalesce(snapshots > 0 AND short = 0 AND violations = 0 AND repeated = 0, false) AS passed, 'faulty' AS input
  FROM asked LEFT JOIN per_day USING (dataset, day)
  UNION ALL
  SELECT dataset, NULL, sum(snapshots), sum(records), sum(short), sum(violations), sum(repeated), count(*), min(day), max(day), false, 'faulty'
  FROM per_day ANTI JOIN asked USING (dataset, day) GROUP BY dataset
  UNION ALL
  SELECT dataset, day, 0, 0, 0, 0, 0, 0, NULL, NULL, false, 'empty' FROM asked WHERE dataset = 'line_status')
SELECT dataset, day AS extracted_date, CAST(snapshots AS BIGINT) AS snapshots, CAST(records AS BIGINT) AS records,
       CAST(short AS BIGINT) AS short_snapshots, CAST(violations AS BIGINT) AS violations, CAST(repeated AS BIGINT) AS repeated_documents,
       CAST(stray_dates AS BIGINT) AS stray_dates, first_stray, last_stray, passed, input
FROM found""".lstrip()
)

_MINIMUM = {"bronze_line_status": 5, "bronze_bike_points": 100}
_DAY = {name: "extracted_date" for name in STORED_BRONZE} | {name: "summary_date" for name in STORED_GOLD}

QUALITY_LOAD = stored(
    "SELECT table_name, day, CAST(count(*) FILTER (WHERE loaded) AS BIGINT) AS rows_loaded, "
    "count(*) FILTER (WHERE loaded) >= any_value(needed) AS passed FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {day} AS day, {_MINIMUM.get(name, 1)} AS needed, true AS loaded FROM {name} "
        f"UNION ALL SELECT '{name}', DATE '2030-01-01', {_MINIMUM.get(name, 1)}, false"
        for name, day in _DAY.items()
    )
    + ") GROUP BY table_name, day",
    *STORED_GOLD,
)

# --- table maintenance -------------------------------------------------------------

REPLACE_DATES = over(
    BIKE_BRONZE,
    query="""
SELECT extracted_date, station_id, CASE WHEN day(extracted_date) % 2 = 0 THEN nb_bikes + 1000 ELSE nb_bikes END AS nb_bikes,
       nb_docks, occupancy_pct
FROM bike_bronze WHERE day(extracted_date) % 6 <> 0""",
)

REPARTITION_BY_DATE = over(
    BIKE_BRONZE, query="SELECT extracted_date, station_id, nb_bikes, nb_docks, occupancy_pct FROM bike_bronze"
)

REPARTITION_ALL = stored(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, true AS swapped, false AS swapped_again, count(*) AS rows_after FROM {name}"
        for name in _DAY
    ),
    *STORED_GOLD,
)

STORED_ROW_ORDER = stored(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows_stored, 0::BIGINT AS misplaced FROM {name}" for name in _DAY
    ),
    *STORED_GOLD,
)

ORACLES: dict[str, str] = {
    "flatten_line_status": FLATTEN_LINE_STATUS,
    "flatten_bike_points": FLATTEN_BIKE_POINTS,
    "flatten_air_quality": FLATTEN_AIR_QUALITY,
    "clean_line_status": CLEAN_LINE_STATUS,
    "clean_bike_points": CLEAN_BIKE_POINTS,
    "clean_air_quality": CLEAN_AIR_QUALITY,
    "gold_daily_line": over(LINE_BRONZE, query=daily_line("line_bronze")),
    "gold_hourly_line": over(LINE_BRONZE, query=hourly_line("line_bronze")),
    "gold_daily_bike": over(BIKE_BRONZE, query=daily_bike("bike_bronze")),
    "gold_hourly_bike": over(BIKE_BRONZE, query=hourly_bike("bike_bronze")),
    "gold_daily_line_from_hours": over(LINE_BRONZE, query=daily_line("line_bronze")),
    "gold_daily_bike_from_hours": over(BIKE_BRONZE, query=daily_bike("bike_bronze")),
    "stored_row_order": STORED_ROW_ORDER,
    "gold_daily_air": over(AIR_BRONZE, query=daily_air("air_bronze")),
    **{f"stored_{name}": stored(f"SELECT * FROM {name}") for name in STORED_BRONZE},
    **{f"stored_{name}": stored(f"SELECT * FROM {name}", name) for name in STORED_GOLD},
    "row_totals": ROW_TOTALS,
    "latest_disruption": LATEST_DISRUPTION,
    "busiest_stations": BUSIEST_STATIONS,
    "air_trend_30d": AIR_TREND,
    "snapshot_history": SNAPSHOT_HISTORY,
    "quality_raw": QUALITY_RAW,
    "quality_gate": QUALITY_GATE,
    "quality_load": QUALITY_LOAD,
    "replace_dates": REPLACE_DATES,
    "repartition_by_date": REPARTITION_BY_DATE,
    "repartition_all": REPARTITION_ALL,
}
