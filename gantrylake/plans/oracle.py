"""Independent SQL for every query, written for a single-node SQL engine over the same tables."""

from __future__ import annotations

from gantrylake.plans.fixtures import GANTRIES, HOLIDAYS, LEAD_INS, MARKERS, REQUESTED, ROUTES, STATIONS, TARGETS
from gantrylake.schemas import VEHICLE_CODES, VEHICLE_LABELS, WEEKDAY_LABELS

SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
ENTRY = rf"([0-9]{{2}}[A-Za-z]{{1,2}}[0-9]{{3,4}}[NS]){SPACE}+([^\n]{{2,}})"


def _quoted(items: list[str]) -> str:
    return ", ".join(f"'{item}'" for item in items)


def _case(value: str, pairs: dict, default: str = "NULL") -> str:
    branches = " ".join(f"WHEN {k} THEN {v}" for k, v in pairs.items())
    return f"CASE {value} {branches} ELSE {default} END"


def _gantry(n: str) -> str:
    return _case(n, {i: f"'{g}'" for i, g in enumerate(GANTRIES)})


def _clock(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def _vehicle(event_type: str) -> str:
    return _case(event_type, {"'view'": 31, "'click'": 32, "'signup'": 41, "'purchase'": 42, "'error'": 5})


def _vehicle_label(code: str) -> str:
    named = _case(code, {k: f"'{v}'" for k, v in VEHICLE_LABELS.items()}, "'?'")
    return f"'VT=' || {code} || '(' || {named} || ')'"


def _weekday_label(day: str) -> str:
    return _case(day, {k: f"'{v}'" for k, v in WEEKDAY_LABELS.items()})


def _rounded(value: str, places: int) -> str:
    scale = f"{float(10**places)}::DOUBLE"
    return f"(round_even(({value}) * {scale}, 0)::DOUBLE / {scale})"


TRIPS = f"""
trips AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN 'abc' ELSE CAST({_vehicle('event_type')} AS VARCHAR) END AS VehicleType,
    CASE WHEN event_id % 101 = 0 THEN 'invalid' ELSE {_clock('ts')} END AS DetectionTime_O,
    CASE WHEN event_id % 103 = 0 THEN ''
         WHEN event_id % 7 = 0 THEN ' ' || {_gantry('user_id % 8')} || ' '
         ELSE {_gantry('user_id % 8')} END AS GantryID_O,
    {_clock('ts + INTERVAL 20 MINUTES')} AS DetectionTime_D,
    {_gantry('(user_id + event_id) % 8')} AS GantryID_D,
    CAST(value AS VARCHAR) AS TripLength, value, 'Y' AS TripEnd,
    {_gantry('user_id % 8')} || ';' || {_clock('ts')} || '|' ||
    {_gantry('(user_id + 3 * event_id) % 8')} || ';' || {_clock('ts + INTERVAL 10 MINUTES')} || '|' ||
    {_gantry('(user_id + event_id) % 8')} || ';' || {_clock('ts + INTERVAL 20 MINUTES')} AS TripInformation,
    'TRIPS_' || strftime(ts, '%Y%m%d_%H') || '0000.csv' AS file_name,
    ts
  FROM events)"""

COERCED = (
    TRIPS
    + """,
coerced AS (
  SELECT event_id, file_name, TRY_CAST(VehicleType AS INTEGER) AS vehicle, value AS trip_length,
    TRY_CAST(DetectionTime_O AS TIMESTAMP) AS t_o, nullif(trim(GantryID_O), '') AS o, nullif(trim(GantryID_D), '') AS d,
    TripInformation
  FROM trips),
sound AS (SELECT * FROM coerced WHERE vehicle IS NOT NULL AND t_o IS NOT NULL AND o IS NOT NULL)"""
)

CLEAN = (
    COERCED
    + f""",
touching AS (
  SELECT *, CASE WHEN o IN ({_quoted(TARGETS)}) THEN o ELSE d END AS target
  FROM sound WHERE o IN ({_quoted(TARGETS)}) OR d IN ({_quoted(TARGETS)})),
cleaned AS (SELECT * FROM touching WHERE year(t_o) = 2024 AND month(t_o) = 1)"""
)

HOURLY = (
    CLEAN
    + """,
hourly AS (
  SELECT CAST(year(t_o) AS INTEGER) AS year, CAST(month(t_o) AS INTEGER) AS month, CAST(day(t_o) AS INTEGER) AS day,
    CAST(isodow(t_o) AS INTEGER) AS weekday, CAST(hour(t_o) AS INTEGER) AS hour_0, target AS gantry_id_o,
    vehicle AS vehicle_type, CAST(count(*) AS INTEGER) AS counts, CAST((day(t_o) - 1) // 7 + 1 AS INTEGER) AS week_index
  FROM cleaned GROUP BY ALL)"""
)

FLOW = f"""
cells AS (
  SELECT strftime(time_bucket(INTERVAL 5 MINUTES, ts), '%Y-%m-%d %H:%M:%S') AS time_interval,
    {_gantry('user_id % 8')} AS gantry_id, {_vehicle('event_type')} AS vehicle_type, strftime(ts, '%Y%m') AS yyyymm,
    count(*) AS flow
  FROM events GROUP BY ALL),
flow AS (
  SELECT substr(time_interval, 1, 10) AS dt, CAST(substr(time_interval, 12, 2) AS INTEGER) AS hour, gantry_id,
    right(gantry_id, 1) AS direction, vehicle_type, CAST(sum(flow) AS BIGINT) AS hourly_flow, count(*) AS slot_count, yyyymm
  FROM cells WHERE gantry_id IN ({_quoted(STATIONS)}) GROUP BY ALL)"""

MULTI = f"""
multi AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(day(o_orderdate) AS INTEGER) AS day, CAST(isodow(o_orderdate) AS INTEGER) AS weekday,
    CAST(hour(o_orderdate) AS INTEGER) AS hour_0, {_gantry('o_custkey % 4')} AS gantry_id_o,
    {_case("left(o_orderpriority, 1)", {"'1'": 31, "'2'": 32, "'3'": 41, "'4'": 42, "'5'": 5})} AS vehicle_type,
    CAST(count(*) AS INTEGER) AS counts, CAST((day(o_orderdate) - 1) // 7 + 1 AS INTEGER) AS week_index,
    strftime(o_orderdate, '%Y%m') AS yyyymm
  FROM orders GROUP BY ALL)"""

FILES = """
remote AS (
  SELECT 'TRIPS_' || strftime(ts, '%Y%m%d_%H') || '0000.csv' AS file_name, strftime(ts, '%Y%m%d') AS yyyymmdd,
    CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour_0, CAST(sum(length(props)) AS BIGINT) AS size
  FROM events GROUP BY ALL),
local AS (
  SELECT file_name, yyyymmdd, day, hour_0, size + CASE WHEN (day * 24 + hour_0) % 19 = 0 THEN 1 ELSE 0 END AS size
  FROM remote WHERE (day * 24 + hour_0) % 17 <> 0),
calendar AS (SELECT CAST(d AS DATE) AS date FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 1 DAY) t(d)),
days AS (
  SELECT c.date, count(l.file_name) FILTER (WHERE l.size > 0) AS files
  FROM calendar c LEFT JOIN local l ON l.yyyymmdd = strftime(c.date, '%Y%m%d') GROUP BY c.date)"""

DIMENSION = """
old_dim AS (
  SELECT p_partkey AS gantry_id, p_brand AS route, p_name AS section,
    CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS county, 'city' AS city,
    CASE WHEN p_partkey % 5 = 0 THEN 'check' ELSE '' END AS note
  FROM part WHERE p_partkey % 50 <> 0),
new_dim AS (
  SELECT p_partkey AS gantry_id, p_brand AS route, p_name || CASE WHEN p_partkey % 13 = 0 THEN ' v2' ELSE '' END AS section
  FROM part WHERE p_partkey % 49 <> 0),
diff AS (
  SELECT coalesce(o.gantry_id, n.gantry_id) AS gantry_id,
    CASE WHEN o.gantry_id IS NULL THEN 'added' WHEN n.gantry_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
    o.section AS old_value, n.section AS new_value
  FROM old_dim o FULL JOIN new_dim n ON o.gantry_id = n.gantry_id
  WHERE o.gantry_id IS NULL OR n.gantry_id IS NULL OR o.section IS DISTINCT FROM n.section)"""

DAY_TOTALS = (
    HOURLY
    + """,
day_totals AS (
  SELECT gantry_id_o, year, month, day, weekday, CAST(sum(counts) AS BIGINT) AS total,
    CAST(count(DISTINCT hour_0) AS INTEGER) AS observed_hours
  FROM hourly GROUP BY ALL),
gantry_days AS (
  SELECT gantry_id_o, count(*) AS n, CAST(sum(total) AS BIGINT) AS s, sum(CAST(total AS HUGEINT) * total) AS q
  FROM day_totals GROUP BY ALL),
hour_totals AS (SELECT gantry_id_o, hour_0, CAST(sum(counts) AS BIGINT) AS total FROM hourly GROUP BY ALL),
ranked AS (
  SELECT h.*, n, row_number() OVER (PARTITION BY h.gantry_id_o ORDER BY total DESC, hour_0) AS top,
    row_number() OVER (PARTITION BY h.gantry_id_o ORDER BY total, hour_0) AS low
  FROM hour_totals h JOIN gantry_days USING (gantry_id_o)),
peaks AS (
  SELECT gantry_id_o,
    max(hour_0) FILTER (WHERE top = 1) AS peak_hour,
    max("""
    + _rounded("total::DOUBLE / n", 1)
    + """) FILTER (WHERE top = 1) AS peak_hour_avg,
    max(hour_0) FILTER (WHERE low = 1) AS off_hour,
    max("""
    + _rounded("total::DOUBLE / n", 1)
    + """) FILTER (WHERE low = 1) AS off_hour_avg
  FROM ranked GROUP BY gantry_id_o),
stats AS (
  SELECT gantry_id_o, n AS days_with_data, s // n AS daily_total_mean,
    CAST(CASE WHEN n * q - CAST(s AS HUGEINT) * s = 0 THEN 1
      ELSE trunc(sqrt((n * q - CAST(s AS HUGEINT) * s)::DOUBLE) / n) END AS BIGINT) AS daily_total_std,
    peak_hour, peak_hour_avg, off_hour, off_hour_avg
  FROM gantry_days JOIN peaks USING (gantry_id_o)),
anomalies AS (
  SELECT gantry_id_o, year, month, day, total, observed_hours, """
    + _rounded("(n * total - s)::DOUBLE / sqrt((n * q - CAST(s AS HUGEINT) * s)::DOUBLE)", 2)
    + """ AS z
  FROM day_totals JOIN gantry_days USING (gantry_id_o)
  WHERE n * q - CAST(s AS HUGEINT) * s > 0
    AND CAST(n * total - s AS HUGEINT) * (n * total - s) >= 4 * (n * q - CAST(s AS HUGEINT) * s)),
shares AS (
  SELECT gantry_id_o, vehicle_type, """
    + _vehicle_label("vehicle_type")
    + """ AS label, CAST(sum(counts) AS BIGINT) AS total,
    """
    + _rounded("sum(counts)::DOUBLE / CAST(sum(sum(counts)) OVER (PARTITION BY gantry_id_o) AS DOUBLE) * 100.0::DOUBLE", 2)
    + """ AS share_pct
  FROM hourly GROUP BY gantry_id_o, vehicle_type),
weekdays AS (
  SELECT gantry_id_o, weekday, """
    + _weekday_label("weekday")
    + """ AS label, count(*) AS days, """
    + _rounded("sum(total)::DOUBLE / count(*)", 1)
    + """ AS daily_avg
  FROM day_totals GROUP BY gantry_id_o, weekday)"""
)

#: The characters of Unicode's white space, and four separators that the clean-up counts in.
WHITESPACE_CODES = [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

MANUAL_LINES = """
manual_lines AS (
  SELECT doc_id, list_transform(string_split(text, chr(10)), lambda line, i:
    lpad(CAST(doc_id % 12 AS VARCHAR), 2, '0') || 'F' || lpad(CAST((i - 1) % 10000 AS VARCHAR), 4, '0')
    || CASE WHEN (doc_id + i - 1) % 2 = 0 THEN 'N' ELSE 'S' END || '  ' || line || '  ' || CAST(i - 1 AS VARCHAR)) AS lines
  FROM documents)"""

MANUAL = f"""
manual AS (
  SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda line, i:
    lpad(CAST(doc_id % 12 AS VARCHAR), 2, '0') || 'F' || lpad(CAST((i - 1) % 10000 AS VARCHAR), 4, '0')
    || CASE WHEN (doc_id + i - 1) % 2 = 0 THEN 'N' ELSE 'S' END || '  ' || line || '  ' || CAST(i - 1 AS VARCHAR)), chr(10)) AS text
  FROM documents),
matched AS (
  SELECT doc_id, regexp_extract_all(text, '{ENTRY}', 1) AS ids, regexp_extract_all(text, '{ENTRY}', 2) AS names FROM manual),
entries AS (
  SELECT doc_id, unnest(ids) AS gantry_id, unnest(names) AS name, unnest(range(len(ids))) AS entry_pos FROM matched)"""


def _chars() -> str:
    return " || ".join(f"chr({code})" for code in WHITESPACE_CODES)


def _strip(text: str) -> str:
    return f"trim({text}, {_chars()})"


CHAT = f"""
chat AS (
  SELECT conv_id, turn, ' ' || {_case('conv_id % 7', {i: f"'{p}'" for i, p in enumerate(LEAD_INS)}, "''")} || chr(10) || ' '
    || CASE WHEN conv_id % 3 = 0 THEN '```text' || chr(10) || text || chr(10) || '```' ELSE text END || chr(9) AS text
  FROM conversations)"""

_HOURLY_LIST = "year, month, day, weekday, hour_0, gantry_id_o, vehicle_type, counts, week_index"
_D = "gantry_id_o, year, month, day"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def _pivot(axis: str, values: list, names: list[str]) -> str:
    literal = lambda v: f"'{v}'" if isinstance(v, str) else v
    return ", ".join(
        f"CAST(coalesce(sum(counts) FILTER (WHERE {axis} = {literal(v)}), 0) AS BIGINT) AS \"{n}\"" for v, n in zip(values, names)
    )


_VT_NAMES = [f"vt_{c}" for c in VEHICLE_CODES]
_ROUTE_ROWS = ", ".join(f"('{r}')" for r in ROUTES)
_TEXT_LIST = (
    'year AS "Year", month AS "Month", day AS "Day", weekday AS "Weekday", hour_0 AS "Hour_0", gantry_id_o AS "GantryID_O", '
    'vehicle_type AS "VehicleType", counts, week_index AS "WeekIndex"'
)
_MARKER_ROWS = ", ".join(f"('{m}')" for m in MARKERS)
_REQUESTED_ROWS = ", ".join(f"('{g}')" for g in REQUESTED)
_HOLIDAY_ROWS = ", ".join(f"(DATE '{d}', '{n}')" for d, n in HOLIDAYS)

DOCUMENTS = (
    DAY_TOTALS
    + """,
share_docs AS (SELECT gantry_id_o, CAST('{' || string_agg('"' || label || '":' || to_json(share_pct), ',' ORDER BY vehicle_type) || '}' AS JSON) AS doc FROM shares GROUP BY gantry_id_o),
weekday_docs AS (SELECT gantry_id_o, CAST('{' || string_agg('"' || label || '":' || to_json(daily_avg), ',' ORDER BY weekday) || '}' AS JSON) AS doc FROM weekdays GROUP BY gantry_id_o),
anomaly_docs AS (
  SELECT gantry_id_o, to_json(list(struct_pack(year := year, month := month, day := day, total := total, z := z) ORDER BY year, month, day)) AS doc
  FROM anomalies GROUP BY gantry_id_o),
documents_ AS (
SELECT gantry_id_o, CAST(json_object('available', true, 'days_with_data', days_with_data, 'daily_total_mean', daily_total_mean,
  'daily_total_std', daily_total_std, 'peak_hour', peak_hour, 'peak_hour_avg', peak_hour_avg, 'off_hour', off_hour,
  'off_hour_avg', off_hour_avg, 'vehicle_share_pct', s.doc, 'weekday_daily_avg', w.doc, 'anomaly_days', coalesce(a.doc, '[]'::JSON)) AS VARCHAR) AS document
FROM stats JOIN share_docs s USING (gantry_id_o) JOIN weekday_docs w USING (gantry_id_o) LEFT JOIN anomaly_docs a USING (gantry_id_o))"""
)

SQL: dict[str, str] = {
    "hourly_counts": _with(HOURLY, "SELECT * FROM hourly"),
    "hourly_ordered": _with(
        HOURLY, "SELECT * FROM hourly ORDER BY year, month, day, hour_0, gantry_id_o, vehicle_type"
    ),
    "raw_scan": _with(
        TRIPS,
        "SELECT VehicleType, DetectionTime_O, nullif(GantryID_O, '') AS GantryID_O, DetectionTime_D, GantryID_D, TripLength, "
        "TripEnd, TripInformation, strftime(ts, '%Y%m') AS yyyymm FROM trips",
    ),
    "clean_trips": _with(
        CLEAN,
        'SELECT event_id, vehicle AS "VehicleType", trip_length AS "TripLength", CAST(year(t_o) AS INTEGER) AS "Year", '
        'CAST(month(t_o) AS INTEGER) AS "Month", CAST(day(t_o) AS INTEGER) AS "Day", CAST(hour(t_o) AS INTEGER) AS "Hour_0", '
        'CAST(isodow(t_o) AS INTEGER) AS "Weekday", o AS "GantryID_O", d AS "GantryID_D", target AS "TargetGantry" FROM cleaned',
    ),
    "endpoint_filter": _with(
        CLEAN,
        f"SELECT o IN ({_quoted(TARGETS)}) AS hit_o, d IN ({_quoted(TARGETS)}) AS hit_d, target AS \"TargetGantry\", "
        "count(*) AS trips FROM touching GROUP BY ALL",
    ),
    "endpoint_filter_table": _with(
        CLEAN, 'SELECT target AS "TargetGantry", vehicle AS "VehicleType", count(*) AS trips FROM touching GROUP BY ALL'
    ),
    "date_window": _with(
        COERCED,
        'SELECT CAST(day(t_o) AS INTEGER) AS "Day", d AS "TargetGantry", count(*) AS trips FROM sound '
        "WHERE t_o >= TIMESTAMP '2024-01-05' AND t_o < TIMESTAMP '2024-01-21' GROUP BY ALL",
    ),
    "quarantine_rows": _with(
        COERCED,
        "SELECT t.event_id, t.VehicleType, t.DetectionTime_O, t.GantryID_O, CASE WHEN c.t_o IS NULL THEN 'detection_time' "
        "WHEN c.o IS NULL THEN 'gantry_id' ELSE 'vehicle_type' END AS reject_reason FROM trips t JOIN coerced c USING (event_id) "
        "WHERE c.t_o IS NULL OR c.o IS NULL OR c.vehicle IS NULL",
    ),
    "run_summary": _with(
        HOURLY
        + """,
counters AS (
  SELECT (SELECT count(*) FROM trips) AS scanned_rows, (SELECT count(*) FROM cleaned) AS cleaned_rows,
    (SELECT count(*) FROM hourly) AS hourly_rows, (SELECT count(DISTINCT file_name) FROM trips) AS file_count)""",
        f"SELECT *, {_rounded('cleaned_rows::DOUBLE / scanned_rows * 100.0::DOUBLE', 2)} AS retained_pct, "
        f"{_rounded('hourly_rows::DOUBLE / cleaned_rows * 100.0::DOUBLE', 2)} AS hourly_pct FROM counters",
    ),
    "merge_partials": _with(HOURLY, "SELECT * FROM hourly"),
    "domain_check": _with(
        COERCED,
        """SELECT rule, CAST(violations AS BIGINT) AS violations, (SELECT count(*) FROM coerced) AS rows FROM (
  SELECT 'year' AS rule, count(*) FILTER (WHERE coalesce(year(t_o) BETWEEN 2020 AND 2099, false) = false) AS violations FROM coerced
  UNION ALL SELECT 'month', count(*) FILTER (WHERE coalesce(month(t_o) BETWEEN 1 AND 12, false) = false) FROM coerced
  UNION ALL SELECT 'gantry_id', count(*) FILTER (WHERE coalesce(regexp_full_match(o, '[0-9]{2}[A-Za-z]{1,2}[0-9]{3,4}[NS]'), false) = false)
  FROM coerced)""",
    ),
    "flow_hourly": _with(FLOW, "SELECT * FROM flow"),
    "flow_ctas": _with(FLOW, "SELECT * FROM flow"),
    "flow_q1": _with(
        FLOW,
        "SELECT yyyymm, count(*) AS rows, count(DISTINCT gantry_id) AS gantries, count(DISTINCT dt) AS days, "
        "CAST(sum(hourly_flow) AS BIGINT) AS total_flow FROM flow GROUP BY yyyymm ORDER BY yyyymm",
    ),
    "flow_q2": _with(
        FLOW,
        "SELECT gantry_id, direction, count(DISTINCT dt) AS days, count(*) AS hourly_rows, CAST(sum(hourly_flow) AS BIGINT) AS total_flow, "
        "min(slot_count) AS min_slots, max(slot_count) AS max_slots FROM flow WHERE yyyymm = '202401' "
        "GROUP BY gantry_id, direction ORDER BY gantry_id",
    ),
    "flow_q3": _with(FLOW, "SELECT slot_count, count(*) AS n FROM flow GROUP BY slot_count ORDER BY slot_count DESC"),
    "flow_q4": _with(
        FLOW,
        "SELECT gantry_id, CAST(sum(hourly_flow) AS BIGINT) AS total_flow FROM flow WHERE yyyymm BETWEEN '202401' AND '202412' "
        "GROUP BY gantry_id ORDER BY gantry_id",
    ),
    "daily_total": _with(HOURLY, f"SELECT {_D}, CAST(sum(counts) AS BIGINT) AS total FROM hourly GROUP BY ALL"),
    "day_hour_total": _with(HOURLY, f"SELECT {_D}, hour_0, CAST(sum(counts) AS BIGINT) AS total FROM hourly GROUP BY ALL"),
    "hour_profile": _with(
        DAY_TOTALS,
        "SELECT gantry_id_o, hour_0, total, n AS days, total::DOUBLE / n AS hour_avg FROM hour_totals JOIN gantry_days USING (gantry_id_o)",
    ),
    "peak_hours": _with(DAY_TOTALS, "SELECT * FROM peaks"),
    "vehicle_share": _with(DAY_TOTALS, "SELECT * FROM shares"),
    "vehicle_total": _with(
        HOURLY, "SELECT vehicle_type, count(*) AS rows, CAST(sum(counts) AS BIGINT) AS total FROM hourly GROUP BY vehicle_type"
    ),
    "weekday_avg": _with(DAY_TOTALS, "SELECT * FROM weekdays"),
    "vt_weekday_avg": _with(
        HOURLY
        + f""",
per_day AS (
  SELECT gantry_id_o, vehicle_type, weekday, year, month, day, sum(counts) AS total FROM hourly
  WHERE vehicle_type IN ({', '.join(map(str, VEHICLE_CODES))}) GROUP BY ALL),
means AS (SELECT gantry_id_o, vehicle_type, weekday, sum(total)::DOUBLE / count(*) AS daily_avg FROM per_day GROUP BY ALL),
grid AS (SELECT gantry_id_o, vehicle_type, CAST(unnest(range(1, 8)) AS INTEGER) AS weekday FROM (SELECT DISTINCT gantry_id_o, vehicle_type FROM per_day))""",
        "SELECT gantry_id_o, vehicle_type, weekday, coalesce(daily_avg, 0.0) AS daily_avg FROM grid LEFT JOIN means USING (gantry_id_o, vehicle_type, weekday)",
    ),
    "mean_24h": _with(
        HOURLY
        + """,
cells AS (SELECT gantry_id_o, year, month, day, hour_0, sum(counts) AS total FROM hourly GROUP BY ALL),
means AS (SELECT gantry_id_o, hour_0, sum(total)::DOUBLE / count(*) AS mean FROM cells GROUP BY ALL),
grid AS (SELECT gantry_id_o, CAST(unnest(range(24)) AS INTEGER) AS hour_0 FROM (SELECT DISTINCT gantry_id_o FROM hourly))""",
        "SELECT gantry_id_o, hour_0, coalesce(mean, 0.0) AS mean FROM grid LEFT JOIN means USING (gantry_id_o, hour_0)",
    ),
    "gantry_stats": _with(DAY_TOTALS, "SELECT * FROM stats"),
    "gantry_availability": _with(
        HOURLY,
        f"SELECT g.gantry_id, count(h.gantry_id_o) AS rows, count(h.gantry_id_o) > 0 AS available FROM (VALUES {_REQUESTED_ROWS}) g(gantry_id) "
        "LEFT JOIN hourly h ON h.gantry_id_o = g.gantry_id GROUP BY g.gantry_id",
    ),
    "anomaly_days": _with(DAY_TOTALS, "SELECT * FROM anomalies"),
    "global_stats": _with(
        HOURLY,
        "SELECT (SELECT count(*) FROM hourly) AS total_rows, (SELECT string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) "
        "FROM (SELECT DISTINCT day FROM hourly)) AS days_covered",
    ),
    "stats_json": _with(
        DOCUMENTS, """SELECT gantry_id_o, '{"gantry_id":"' || gantry_id_o || '",' || substr(document, 2) AS document FROM documents_"""
    ),
    "stats_global": _with(
        HOURLY,
        """SELECT '{"total_rows":' || (SELECT count(*) FROM hourly) || ',"days_covered":[' ||
  (SELECT string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) FROM (SELECT DISTINCT day FROM hourly)) || ']}' AS document""",
    ),
    "stats_requested": _with(
        DOCUMENTS,
        f"""SELECT g.gantry_id, '{{' || CASE WHEN g.gantry_id = '{REQUESTED[1]}' THEN '' ELSE '"label":"gantry ' || g.gantry_id || '",' END ||
  '"gantry_id":"' || g.gantry_id || '",' || coalesce(substr(document, 2), '"available":false}}') AS document
FROM (VALUES {_REQUESTED_ROWS}) g(gantry_id) LEFT JOIN documents_ d ON d.gantry_id_o = g.gantry_id""",
    ),
    "hour_grid": _with(
        HOURLY
        + f""",
grid AS (SELECT *, CAST(unnest(range(24)) AS INTEGER) AS hour_0 FROM (SELECT DISTINCT {_D} FROM hourly)),
cells AS (SELECT {_D}, hour_0, sum(counts) AS counts FROM hourly GROUP BY ALL)""",
        f"SELECT {_D}, hour_0, CAST(coalesce(counts, 0) AS BIGINT) AS counts FROM grid LEFT JOIN cells USING ({_D}, hour_0)",
    ),
    "hour_day_pivot": _with(
        HOURLY
        + """,
grid AS (SELECT *, CAST(unnest(range(24)) AS INTEGER) AS hour_0 FROM (SELECT DISTINCT gantry_id_o, year, month FROM hourly))""",
        "SELECT g.gantry_id_o, g.year, g.month, g.hour_0, "
        + _pivot("day", list(range(1, 32)), [f"day_{d:02d}" for d in range(1, 32)])
        + " FROM grid g LEFT JOIN hourly h ON (h.gantry_id_o, h.year, h.month, h.hour_0) = (g.gantry_id_o, g.year, g.month, g.hour_0) "
        "GROUP BY g.gantry_id_o, g.year, g.month, g.hour_0",
    ),
    "weekday_vt_total": _with(
        HOURLY
        + """,
grid AS (SELECT *, CAST(unnest(range(1, 8)) AS INTEGER) AS weekday FROM (SELECT DISTINCT gantry_id_o FROM hourly))""",
        "SELECT g.gantry_id_o, g.weekday, "
        + _pivot("vehicle_type", VEHICLE_CODES, _VT_NAMES)
        + " FROM grid g LEFT JOIN hourly h ON h.gantry_id_o = g.gantry_id_o AND h.weekday = g.weekday GROUP BY g.gantry_id_o, g.weekday",
    ),
    "month_gantry_pivot": _with(
        MULTI, f"SELECT yyyymm, {_pivot('gantry_id_o', TARGETS, [f'g_{g}' for g in TARGETS])} FROM multi GROUP BY yyyymm"
    ),
    "month_vt_pivot": _with(MULTI, f"SELECT yyyymm, {_pivot('vehicle_type', VEHICLE_CODES, _VT_NAMES)} FROM multi GROUP BY yyyymm"),
    "multi_month_union": _with(
        HOURLY + "," + MULTI,
        f"SELECT {_HOURLY_LIST}, yyyymm FROM multi UNION ALL SELECT {_HOURLY_LIST}, '202401' FROM hourly",
    ),
    "daily_date": _with(
        MULTI,
        "SELECT yyyymm, day, gantry_id_o, CAST(sum(counts) AS BIGINT) AS total, "
        "strftime(make_date(max(year), max(month), day), '%Y-%m-%d') AS date FROM multi GROUP BY yyyymm, day, gantry_id_o",
    ),
    "lake_rows": _with(HOURLY, "SELECT *, year || lpad(month::VARCHAR, 2, '0') AS yyyymm FROM hourly"),
    "lake_roundtrip": _with(
        HOURLY + "," + MULTI,
        f"SELECT {_HOURLY_LIST}, yyyymm FROM multi UNION ALL SELECT {_HOURLY_LIST}, '202401' FROM hourly",
    ),
    "week_layer": _with(HOURLY, "SELECT *, '202401' AS yyyymm FROM hourly WHERE week_index = 2"),
    "day_layer": _with(HOURLY, "SELECT *, '202401' AS yyyymm FROM hourly WHERE day = 17"),
    "layer_csv": _with(
        HOURLY,
        f"SELECT layer, {_TEXT_LIST} FROM hourly, (VALUES ('month'), ('week'), ('day')) l(layer)",
    ),
    "month_window_run": _with(
        HOURLY,
        f"SELECT {_HOURLY_LIST}, '202401' AS yyyymm FROM hourly WHERE day <> 30 AND (day NOT BETWEEN 5 AND 9 OR vehicle_type = 31)",
    ),
    "nested_files": _with(TRIPS, 'SELECT VehicleType AS "VehicleType", count(*) AS rows FROM trips GROUP BY 1'),
    "skipped_files": _with(HOURLY, "SELECT * FROM hourly"),
    "month_folder_skips": _with(HOURLY, "SELECT * FROM hourly"),
    "stream_skips_damaged": _with(HOURLY, "SELECT * FROM hourly"),
    "incremental_month": _with(HOURLY, "SELECT * FROM hourly"),
    "month_swap": _with(HOURLY, f"SELECT {_HOURLY_LIST}, '202401' AS yyyymm FROM hourly"),
    "reconcile_rows": _with(
        HOURLY
        + """,
actual AS (
  SELECT year, month, CASE WHEN day = 9 THEN 31 ELSE day END AS day, weekday, hour_0, gantry_id_o, vehicle_type,
    CASE WHEN day = 3 AND hour_0 = 8 THEN counts + 1 ELSE counts END AS counts, week_index
  FROM hourly WHERE day <> 5),
lost AS (SELECT 'MISSING' AS side, * FROM (SELECT * FROM hourly EXCEPT ALL SELECT * FROM actual)),
extra AS (SELECT 'EXTRA' AS side, * FROM (SELECT * FROM actual EXCEPT ALL SELECT * FROM hourly))""",
        f"SELECT side, count(*) AS copies, {_HOURLY_LIST} FROM (SELECT * FROM lost UNION ALL SELECT * FROM extra) GROUP BY ALL",
    ),
    "inventory_sizes": (
        "SELECT true AS filled, count(DISTINCT strftime(ts + INTERVAL 20 MINUTES, '%Y-%m-%d')) AS files FROM events UNION ALL SELECT false, 1"
    ),
    "hourly_reload": _with(
        HOURLY,
        'SELECT year AS "Year", month AS "Month", day AS "Day", weekday AS "Weekday", hour_0 AS "Hour_0", gantry_id_o AS "GantryID_O", '
        'vehicle_type AS "VehicleType", counts, week_index AS "WeekIndex" FROM hourly WHERE NOT (day % 11 = 0 AND hour_0 = 5)',
    ),
    "file_manifest": _with(
        FILES,
        "SELECT yyyymmdd, count(*) AS files, count(*) FILTER (WHERE size > 0) AS non_empty_files, CAST(sum(size) AS BIGINT) AS bytes "
        "FROM remote GROUP BY yyyymmdd",
    ),
    "month_bytes": _with(
        FILES, "SELECT left(yyyymmdd, 6) AS yyyymm, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes FROM remote GROUP BY 1"
    ),
    "missing_hours": _with(
        FILES + ",\ngrid AS (SELECT date, CAST(unnest(range(24)) AS INTEGER) AS hour_0 FROM calendar)",
        "SELECT strftime(date, '%Y-%m-%d') AS date, hour_0 FROM grid g WHERE NOT EXISTS (SELECT 1 FROM local l "
        "WHERE l.yyyymmdd = strftime(g.date, '%Y%m%d') AND l.hour_0 = g.hour_0 AND l.size > 0)",
    ),
    "month_complete": _with(
        FILES,
        "SELECT strftime(date, '%Y%m') AS yyyymm, CAST(sum(files) AS BIGINT) AS files, count(*) * 24 AS expected_files, "
        "count(*) FILTER (WHERE files >= 24) AS complete_days, count(*) AS days, bool_and(files >= 24) AS is_complete FROM days GROUP BY 1",
    ),
    "day_complete": _with(FILES, "SELECT strftime(date, '%Y-%m-%d') AS date, files, files >= 24 AS is_complete FROM days"),
    "manifest_pending": _with(
        FILES,
        "SELECT r.file_name, r.size, CASE WHEN l.file_name IS NULL THEN 'absent' ELSE 'size' END AS reason "
        "FROM remote r LEFT JOIN local l USING (file_name) WHERE l.file_name IS NULL OR l.size <> r.size",
    ),
    "reconcile": _with(
        HOURLY
        + """,
actual AS (
  SELECT year, month, CASE WHEN day = 9 THEN 31 ELSE day END AS day, weekday, hour_0, gantry_id_o, vehicle_type,
    CASE WHEN day = 3 AND hour_0 = 8 THEN counts + 1 ELSE counts END AS counts, week_index
  FROM hourly WHERE day <> 5),
e AS (SELECT week_index, day, count(*) AS n FROM hourly GROUP BY ALL),
a AS (SELECT week_index, day, count(*) AS n FROM actual GROUP BY ALL),
uneven AS (
  SELECT DISTINCT week_index, day FROM ((SELECT * FROM hourly EXCEPT ALL SELECT * FROM actual) UNION ALL (SELECT * FROM actual EXCEPT ALL SELECT * FROM hourly)))""",
        """SELECT week_index, day, coalesce(e.n, 0) AS expected_rows, coalesce(a.n, 0) AS actual_rows,
  CASE WHEN a.n IS NULL THEN 'MISSING' WHEN e.n IS NULL THEN 'EXTRA'
    WHEN (week_index, day) IN (SELECT (week_index, day) FROM uneven) THEN 'FAIL' ELSE 'PASS' END AS status
FROM e FULL JOIN a USING (week_index, day)""",
    ),
    "latest_status": (
        f"SELECT user_id AS job_id, {_clock('ts')} AS \"at\", event_id, event_type AS status FROM events "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
    ),
    "dim_enrich": _with(
        DIMENSION,
        """SELECT n.gantry_id, n.route, n.section,
  coalesce(nullif(o.county, ''), CASE WHEN n.gantry_id BETWEEN 1 AND 20 THEN 'assumed' END, '') AS county,
  coalesce(nullif(o.city, ''), CASE WHEN n.gantry_id BETWEEN 1 AND 20 THEN 'assumed city' END, '') AS city,
  CASE WHEN n.gantry_id BETWEEN 10 AND 20 THEN '' ELSE coalesce(o.note, '') END AS note
FROM new_dim n LEFT JOIN old_dim o USING (gantry_id)""",
    ),
    "version_diff": _with(DIMENSION, "SELECT * FROM diff"),
    "top_changes": _with(
        DIMENSION,
        """SELECT * FROM (SELECT CAST(gantry_id AS VARCHAR) AS item, old_value, new_value, CAST(0 AS BIGINT) AS more FROM diff
  WHERE change = 'changed' ORDER BY gantry_id LIMIT 30)
UNION ALL SELECT '...', NULL, NULL, count(*) - 30 FROM diff WHERE change = 'changed' HAVING count(*) > 30""",
    ),
    "dim_group_count": _with(DIMENSION, "SELECT route, count(*) AS rows FROM new_dim GROUP BY route"),
    "id_extract": _with(
        MANUAL,
        f"""SELECT gantry_id, doc_id, CAST(entry_pos AS INTEGER) AS entry_pos,
  {_strip(f"regexp_replace({_strip(f"regexp_replace(name, '{SPACE}+', ' ', 'g')")}, '{SPACE}*[0-9]+{SPACE}*$', '')")} AS section
FROM entries QUALIFY row_number() OVER (PARTITION BY gantry_id ORDER BY doc_id, entry_pos) = 1""",
    ),
    "entry_routes": _with(
        MANUAL_LINES
        + f""",
headed AS (
  SELECT doc_id, array_to_string(list_transform(lines, lambda line, i: CASE WHEN (i - 1) % 4 = 2
    THEN {_case('(doc_id + (i - 1) // 4) % 3', {n: f"'{route}'" for n, route in enumerate(ROUTES)})} || chr(10) || line ELSE line END), chr(10)) AS text
  FROM manual_lines),
opened AS (
  SELECT doc_id, text, route, strpos(text, route) AS start_pos FROM headed, (VALUES {_ROUTE_ROWS}) r(route) WHERE strpos(text, route) > 0
  UNION ALL SELECT doc_id, text, NULL, 0 FROM headed),
parts AS (
  SELECT doc_id, route, substr(text, greatest(start_pos, 1), coalesce(lead(start_pos) OVER w, length(text) + 1) - greatest(start_pos, 1)) AS part
  FROM opened WINDOW w AS (PARTITION BY doc_id ORDER BY start_pos)),
found AS (SELECT doc_id, route, unnest(regexp_extract_all(part, '{ENTRY}')) AS entry FROM parts)""",
        f"""SELECT doc_id, route, regexp_extract(entry, '{ENTRY}', 1) AS gantry_id,
  {_strip(f"regexp_replace({_strip(f"regexp_replace(regexp_extract(entry, '{ENTRY}', 2), '{SPACE}+', ' ', 'g')")}, '{SPACE}*[0-9]+{SPACE}*$', '')")} AS section
FROM found""",
    ),
    "both_directions": (
        "SELECT p_partkey AS part, printf('%06d', p_partkey) AS base_id, printf('%06d', p_partkey) || way AS gantry_id "
        "FROM part, (VALUES ('N'), ('S')) w(way)"
    ),
    "dictionary_rows": "SELECT printf('P%07d', p_partkey) AS gantry_id, p_name AS section, p_type AS county FROM part",
    "section_bounds": f"""WITH starts AS (
  SELECT page_id, marker, strpos(html, marker) AS start_pos, length(html) + 1 AS text_end
  FROM pages, (VALUES {_MARKER_ROWS}) m(marker) WHERE strpos(html, marker) > 0)
SELECT page_id, marker, CAST(start_pos AS INTEGER) AS start_pos,
  CAST(coalesce(lead(start_pos) OVER (PARTITION BY page_id ORDER BY start_pos, marker), text_end) AS INTEGER) AS end_pos FROM starts""",
    "text_normalise": _with(
        CHAT,
        f"""SELECT conv_id, turn, regexp_replace(regexp_replace({_strip('text')}, '^(?:{"|".join(LEAD_INS)}){SPACE}*', ''),
  '```[\\p{{L}}\\p{{N}}_]*\\n?', '', 'g') AS text FROM chat""",
    ),
    "concat_chunks": (
        "SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda line, i: '- line ' || i || '：' || line), chr(10)) "
        "AS summary FROM documents"
    ),
    "json_props": (
        "SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS sum_k, min(k) AS min_k, max(k) AS max_k FROM "
        "(SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type"
    ),
    "hourly_window": _with(
        COERCED,
        f"SELECT {_clock('date_trunc(' + chr(39) + 'hour' + chr(39) + ', t_o)')} AS window_start, "
        f"{_clock('date_trunc(' + chr(39) + 'hour' + chr(39) + ', t_o) + INTERVAL 1 HOUR')} AS window_end, "
        "vehicle AS vehicle_type, count(*) AS trips FROM sound GROUP BY ALL",
    ),
    "stream_equals_batch": _with(HOURLY, "SELECT * FROM hourly"),
    "strict_crossing": _with(
        TRIPS
        + """,
stops AS (SELECT event_id, TripInformation, list_transform(string_split(TripInformation, '|'), lambda p: split_part(p, ';', 1)) AS g FROM trips)""",
        f"""SELECT event_id, TripInformation FROM stops WHERE list_contains(g, '{GANTRIES[0]}') AND list_contains(g, '{GANTRIES[2]}')
  AND list_position(g, '{GANTRIES[0]}') < len(g) + 1 - list_position(list_reverse(g), '{GANTRIES[2]}')""",
    ),
    "segment_times": _with(
        TRIPS
        + """,
stops AS (
  SELECT event_id, unnest(string_split(TripInformation, '|')) AS stop, unnest(range(len(string_split(TripInformation, '|')))) AS segment FROM trips),
legs AS (
  SELECT event_id, segment, split_part(stop, ';', 1) AS from_gantry, lead(split_part(stop, ';', 1)) OVER w AS to_gantry,
    date_diff('second', CAST(split_part(stop, ';', 2) AS TIMESTAMP), lead(CAST(split_part(stop, ';', 2) AS TIMESTAMP)) OVER w) AS seconds
  FROM stops WINDOW w AS (PARTITION BY event_id ORDER BY segment))""",
        "SELECT event_id, CAST(segment AS INTEGER) AS segment, from_gantry, to_gantry, seconds FROM legs WHERE to_gantry IS NOT NULL",
    ),
    "od_pairs": _with(
        COERCED,
        f"SELECT {_clock('time_bucket(INTERVAL 5 MINUTES, t_o)')} AS slot_start, o AS \"GantryID_O\", d AS \"GantryID_D\", "
        'vehicle AS "VehicleType", count(*) AS trips FROM sound GROUP BY ALL',
    ),
    "holiday_flag": _with(
        HOURLY
        + f""",
daily AS (SELECT make_date(year, month, day) AS date, gantry_id_o, CAST(sum(counts) AS BIGINT) AS total FROM hourly GROUP BY ALL),
holidays AS (SELECT * FROM (VALUES {_HOLIDAY_ROWS}) h(date, holiday))""",
        "SELECT strftime(date, '%Y-%m-%d') AS date, gantry_id_o, total, holiday IS NOT NULL AS is_holiday, coalesce(holiday, '') AS holiday "
        "FROM daily LEFT JOIN holidays USING (date)",
    ),
}
