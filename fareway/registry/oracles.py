"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from fareway.constants import (
    MODEL_DISPLAY,
    PAYMENT_DISPLAY,
    PAYMENT_LABELS,
    PYRAMID_SCALES,
    ROADS,
    SEVERITY_DISPLAY,
    SEVERITY_DISPLAY_OTHER,
    SPLIT_SEED,
)

# --- pieces of SQL ---------------------------------------------------------------------


def half_up(value: str, digits: int) -> str:
    return f"(sign({value}) * floor(abs({value}) + 0.5e0) / 1e{digits})"


def rounded(value: str, digits: int) -> str:
    return half_up(f"(({value}) * 1e{digits})", digits)


def ratio(total: str, whole: str, digits: int) -> str:
    """total / whole, both whole numbers, rounded away from zero at ties."""
    steps = f"((abs({total}) * {2 * 10**digits} + {whole}) // (2 * {whole}))"
    return f"((CASE WHEN {total} < 0 THEN -1 ELSE 1 END) * CAST({steps} AS DOUBLE) / 1e{digits})"


def decimal_sum(column: str) -> str:
    """The sum of a column as a decimal, in 1/10^10."""
    return f"CAST(sum(CAST(CAST({column} AS DOUBLE) AS DECIMAL(28, 10))) * 10000000000 AS HUGEINT)"


def avg(column: str, digits: int = 3) -> str:
    return ratio(decimal_sum(column), f"nullif(CAST(count({column}) AS HUGEINT), 0) * 10000000000", digits)


def total(column: str, digits: int = 3) -> str:
    return ratio(decimal_sum(column), "CAST(10000000000 AS HUGEINT)", digits)


def plain(column: str) -> str:
    return f"(CAST({decimal_sum(column)} AS DOUBLE) / nullif(CAST(count({column}) AS DOUBLE) * 10000000000.0e0, 0))"


DISTANCE, FARE, TOTAL = avg("trip_distance"), avg("fare_amount"), avg("total_amount")
# a duration is a whole number of milliseconds
DURATION = ratio("CAST(sum(CAST(round(trip_duration_min * 60000.0e0) AS HUGEINT)) AS HUGEINT)", "nullif(CAST(count(trip_duration_min) AS HUGEINT), 0) * 60000", 3)
REVENUE, TIP = total("revenue"), avg("tip_amount")


def case_map(expr: str, names: dict, default: str) -> str:
    whens = " ".join(f"WHEN {k if isinstance(k, int) else repr(k)} THEN '{v}'" for k, v in names.items())
    return f"CASE {expr} {whens} ELSE {default} END"


def iou(a: str, b: str, epsilon: str = "0") -> str:
    """Over structs or table aliases with x1, y1, x2, y2."""
    w = f"greatest(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1), 0)"
    h = f"greatest(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1), 0)"
    shared = f"CAST({w} * {h} AS DOUBLE)"
    area = f"(({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1) + ({b}.x2 - {b}.x1) * ({b}.y2 - {b}.y1))"
    return f"(CASE WHEN {w} * {h} > 0 THEN {shared} / ({area} - {shared} + {epsilon}) ELSE 0e0 END)"


def md5_bits(key: str, seed: int, part: int = 0) -> str:
    return f"CAST(('0x' || substr(md5({key} || '|{seed}'), {1 + 8 * part}, 8)) AS UBIGINT)::BIGINT"


# --- shared tables ---------------------------------------------------------------------

TRIP_ROWS = f"""
trip_rows AS (
  SELECT event_id, event_id % 2 + 1 AS vendor_id, ts AS pickup_datetime,
    ts + to_minutes(CAST(event_id * 37 % 400 AS INTEGER)) AS dropoff_datetime,
    CASE WHEN event_id % 97 <> 0 THEN CAST(event_id % 10 AS DOUBLE) END AS passenger_count,
    value / 5e0 AS trip_distance, user_id AS pickup_location_id,
    CASE WHEN event_id % 101 <> 0 THEN event_id * 7 % 150 END AS dropoff_location_id,
    event_id % 8 AS payment_type, value AS fare_amount, value * 0.1e0 AS tip_amount,
    CASE WHEN event_id % 11 <> 0 THEN value * 1.2e0 END AS total_amount
  FROM events),
trip_raw AS (
  SELECT *, {case_map('payment_type', PAYMENT_LABELS, "'unknown'")} AS payment_type_label,
    (epoch_us(dropoff_datetime) // 1000000 - epoch_us(pickup_datetime) // 1000000) / 60.0e0 AS trip_duration_min
  FROM trip_rows)"""

DERIVED = """*, CAST(pickup_datetime AS DATE) AS pickup_date,
    strftime(pickup_datetime, '%Y-%m') AS pickup_month,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(isodow(pickup_datetime) - 1 AS INTEGER) AS pickup_weekday,
    CASE WHEN isodow(pickup_datetime) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    'zone_' || pickup_location_id AS pickup_zone, 'zone_' || dropoff_location_id AS dropoff_zone,
    'zone_' || pickup_location_id || '_to_zone_' || dropoff_location_id AS od_pair,
    coalesce(total_amount, fare_amount) AS revenue"""


def valid(duration: int = 360, distance: int = 80, fare: int = 400, passengers: int = 8) -> str:
    return f"""trip_duration_min > 0 AND trip_duration_min <= {duration}
    AND trip_distance > 0 AND trip_distance <= {distance}
    AND fare_amount > 0 AND fare_amount <= {fare}
    AND passenger_count > 0 AND passenger_count <= {passengers}
    AND pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL"""


LENIENT = """NOT (trip_duration_min <= 0 OR trip_duration_min > 360
    OR coalesce(trip_distance <= 0 OR trip_distance > 80, false)
    OR coalesce(fare_amount <= 0 OR fare_amount > 400, false)
    OR coalesce(passenger_count <= 0 OR passenger_count > 8, false))"""

TRIPS = f"{TRIP_ROWS}, trips AS (SELECT {DERIVED} FROM trip_raw WHERE {valid()})"
KEPT = f"{TRIP_ROWS}, trips AS (SELECT {DERIVED} FROM trip_raw WHERE {LENIENT})"

ROAD_ROWS = "roads(road_id, road_name, district, capacity, lat, lon) AS (VALUES " + ", ".join(
    f"('{r[0]}', '{r[1]}', '{r[2]}', {r[4]}, {r[5]}::DOUBLE, {r[6]}::DOUBLE)" for r in ROADS
) + ")"

CLASS = """CASE WHEN speed_kmh <= 12 OR occupancy >= 0.88e0 THEN 'severe'
    WHEN speed_kmh <= 22 OR occupancy >= 0.72e0 THEN 'moderate'
    WHEN speed_kmh <= 35 OR occupancy >= 0.55e0 THEN 'slow' ELSE 'smooth' END"""

READINGS = f"""
{ROAD_ROWS},
flat AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
    TIMESTAMP '2024-01-01 00:00:00' + to_milliseconds(event_id * 500) AS event_time,
    'R' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 3, '0') AS road_id, value AS speed_kmh,
    CAST(event_id % 90 + 1 AS INTEGER) AS vehicle_count, (event_id * 13 % 100) / 100.0e0 AS occupancy,
    {rounded('1e3 / greatest(value, 1e0) * 3.6e0', 2)} AS travel_time_sec
  FROM events),
readings AS (
  SELECT event_id, event_time, road_id, road_name, district, speed_kmh, vehicle_count, occupancy,
    travel_time_sec, {CLASS} AS congestion_level, lat, lon
  FROM flat LEFT JOIN roads USING (road_id))"""

HOPPED = """hopped AS (
  SELECT *, time_bucket(INTERVAL '10 seconds', event_time) - to_seconds(10 * i) AS window_start
  FROM readings, range(6) AS steps(i))"""

# five deliveries, one in 40 readings one late and one in 40 two late; what a batch may still
# count was fixed by the deliveries up to the one before the last
LATE_HOPPED = """delivered AS (
  SELECT *, least(4, CAST(floor(CAST(event_id AS BIGINT) * 5 / (max(CAST(event_id AS BIGINT)) OVER () + 1.0e0)) AS INTEGER)
    + CASE CAST(event_id AS BIGINT) % 40 WHEN 7 THEN 1 WHEN 9 THEN 2 ELSE 0 END) AS delivery FROM readings),
marks AS (SELECT d.n, max(event_time) - INTERVAL '5 seconds' AS mark FROM range(5) AS d(n) LEFT JOIN delivered ON delivery <= d.n - 2 GROUP BY d.n),
hopped AS (
  SELECT * FROM (
    SELECT delivered.*, mark, time_bucket(INTERVAL '10 seconds', event_time) - to_seconds(10 * i) AS window_start
    FROM delivered JOIN marks ON n = delivery, range(6) AS steps(i))
  WHERE mark IS NULL OR window_start + INTERVAL '60 seconds' > mark)"""

SEVERE_EVENTS = "count(*) FILTER (WHERE speed_kmh <= 12 OR congestion_level = 'severe')"

ALERT_SUMS = f"""sums AS (
  SELECT window_start, window_start + INTERVAL '60 seconds' AS window_end, road_id, road_name, district,
    count(*) AS vehicle_count, {plain('speed_kmh')} AS speed, {plain('occupancy')} AS occ,
    {avg('speed_kmh', 2)} AS avg_speed_kmh, {avg('occupancy', 4)} AS avg_occupancy,
    {avg('travel_time_sec', 2)} AS avg_travel_time_sec, {SEVERE_EVENTS} AS severe_event_count
  FROM hopped GROUP BY window_start, road_id, road_name, district),
alerts AS (
  SELECT window_start, window_end, road_id, road_name, district, vehicle_count, avg_speed_kmh,
    avg_occupancy, avg_travel_time_sec, severe_event_count,
    CASE WHEN speed <= 12 OR occ >= 0.88e0 THEN 'severe'
      WHEN speed <= 20 OR occ >= 0.75e0 THEN 'moderate' ELSE 'slow' END AS severity,
    road_name || ' 在 ' || strftime(window_start, '%Y-%m-%d %H:%M:%S.%g') || ' 至 '
      || strftime(window_end, '%Y-%m-%d %H:%M:%S.%g') || ' 窗口内平均速度 '
      || CAST(avg_speed_kmh AS VARCHAR) || ' km/h' AS alert_text
  FROM sums WHERE speed <= 25 OR occ >= 0.65e0 OR severe_event_count >= 5)"""

ALERTS = f"{READINGS}, {HOPPED}, {ALERT_SUMS}"
CLOSED = "window_end <= (SELECT max(event_time) - INTERVAL '5 seconds' FROM readings)"

CURRENT = "newest AS (SELECT * FROM alerts ORDER BY window_end DESC, window_start DESC, road_id LIMIT 100)"

RANKED = """coalesce(severity <> 'severe', true), coalesce(avg_speed_kmh, 999),
    -coalesce(vehicle_count, 0), window_end DESC, window_start DESC, road_id"""


def counted_text(name: str) -> str:
    return f"""{name} || ' 在 ' || strftime(window_start, '%Y-%m-%d %H:%M:%S') || ' 至 '
      || strftime(window_end, '%Y-%m-%d %H:%M:%S') || ' 窗口内平均速度 '
      || CAST(avg_speed_kmh AS VARCHAR) || ' km/h，车辆数 ' || vehicle_count"""


SERVED = f"""clean AS (SELECT window_start, window_end, road_id, road_name, district, vehicle_count,
        {rounded('avg_speed_kmh', 2)} AS avg_speed_kmh, {rounded('avg_occupancy', 3)} AS avg_occupancy,
        avg_travel_time_sec, severe_event_count, severity FROM held)
        SELECT *, {counted_text('road_name')} AS alert_text FROM clean ORDER BY {RANKED} LIMIT 30"""


ALL_BOXES = """
all_boxes AS (
  SELECT event_id // 20 AS image, event_id AS box_id,
    CAST(event_id * 97 % 400 AS INTEGER) AS x1, CAST(event_id * 53 % 200 AS INTEGER) AS y1,
    CAST(event_id * 97 % 400 + 40 + event_id * 7 % 60 AS INTEGER) AS x2,
    CAST(event_id * 53 % 200 + 80 + event_id * 11 % 90 AS INTEGER) AS y2,
    value / 491e0 AS score, event_type AS class
  FROM events),
truth AS (SELECT image, box_id AS object_id, x1, y1, x2, y2 FROM all_boxes WHERE class IN ('purchase', 'signup')),
images AS (
  SELECT image, CAST(image * 37 % 240 + 320 AS INTEGER) AS width, CAST(image * 23 % 160 + 260 AS INTEGER) AS height
  FROM (SELECT DISTINCT event_id // 20 AS image FROM events))"""

BOXES = f"""{ALL_BOXES},
dets AS (SELECT image, box_id AS det_id, x1, y1, x2, y2, score, class FROM all_boxes WHERE class NOT IN ('purchase', 'signup'))"""

GRID = f"""
sized AS (SELECT image, scale, greatest(64, CAST(floor(width * scale) AS INTEGER)) AS nw, greatest(128, CAST(floor(height * scale) AS INTEGER)) AS nh
FROM images, (VALUES {', '.join(f'({s}::DOUBLE)' for s in PYRAMID_SCALES)}) AS l(scale)),
rows AS (SELECT *, unnest(range(0, nh - 128 + 1, 16)) AS y FROM sized),
grid AS (SELECT *, unnest(range(0, nw - 64 + 1, 16)) AS x FROM rows)"""


def kept_of(source: str, threshold: str) -> str:
    """Tables that end in ``{source}_kept``: image and box ``k`` of the boxes that suppression leaves of ``source``."""
    return f"""{source}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, x1, y1, x2, y2) AS rn FROM {source}),
{source}_walk(image, rn, kept) AS (
  SELECT DISTINCT image, CAST(0 AS BIGINT),
    CAST([] AS STRUCT(det_id BIGINT, score DOUBLE, x1 INTEGER, y1 INTEGER, x2 INTEGER, y2 INTEGER)[]) FROM {source}
  UNION ALL
  SELECT w.image, r.rn,
    CASE WHEN len(list_filter(w.kept, lambda k: {iou('k', 'r', '1e-6')} >= {threshold})) > 0 THEN w.kept
      ELSE list_append(w.kept, {{'det_id': r.det_id, 'score': r.score, 'x1': r.x1, 'y1': r.y1, 'x2': r.x2, 'y2': r.y2}}) END
  FROM {source}_walk w JOIN {source}_ranked r ON r.image = w.image AND r.rn = w.rn + 1),
{source}_kept AS (
  SELECT image, unnest(kept) AS k FROM (SELECT image, max_by(kept, rn) AS kept FROM {source}_walk GROUP BY image))"""


def suppression(threshold: str) -> str:
    return f"""WITH RECURSIVE {BOXES},
{kept_of('dets', threshold)}
SELECT image, k.det_id AS det_id, k.score AS score FROM dets_kept"""


MATCHING = f"""
pairs AS (
  SELECT d.image, d.det_id, list(t.object_id ORDER BY {iou('d', 't')} DESC, t.object_id) AS near
  FROM dets d JOIN truth t ON t.image = d.image AND {iou('d', 't')} >= 0.5e0 GROUP BY d.image, d.det_id),
ranked AS (
  SELECT d.image, p.near, row_number() OVER (PARTITION BY d.image ORDER BY d.score DESC, d.det_id) AS rn
  FROM dets d JOIN pairs p ON p.image = d.image AND p.det_id = d.det_id),
walk(image, rn, taken) AS (
  SELECT DISTINCT image, CAST(0 AS BIGINT), CAST([] AS BIGINT[]) FROM ranked
  UNION ALL
  SELECT w.image, r.rn,
    CASE WHEN len(list_filter(r.near, lambda g: NOT list_contains(w.taken, g))) > 0
      THEN list_append(w.taken, list_filter(r.near, lambda g: NOT list_contains(w.taken, g))[1]) ELSE w.taken END
  FROM walk w JOIN ranked r ON r.image = w.image AND r.rn = w.rn + 1),
hits AS (SELECT image, max(len(taken)) AS tp FROM walk GROUP BY image),
sides AS (
  SELECT image, count(*) FILTER (WHERE side = 't') AS n_gt, count(*) FILTER (WHERE side = 'd') AS n_pred
  FROM (SELECT image, 't' AS side FROM truth UNION ALL SELECT image, 'd' FROM dets) GROUP BY image),
matches AS (
  SELECT image, coalesce(tp, 0) AS tp, n_pred - coalesce(tp, 0) AS fp, n_gt - coalesce(tp, 0) AS fn, n_gt, n_pred
  FROM sides LEFT JOIN hits USING (image))"""

MATCHES = f"{BOXES}, {MATCHING}"

SCANNED = f"""{ALL_BOXES}, {GRID},
valued AS (
  SELECT *, (x * 7919 + y * 104729 + image * 31) % 999983 / 999983e0 + scale * -0.05e0 AS score FROM grid),
found AS (
  SELECT image, CAST(row_number() OVER (PARTITION BY image ORDER BY score DESC, scale) AS BIGINT) AS det_id, score,
    CAST(trunc(x / scale) AS INTEGER) AS x1, CAST(trunc(y / scale) AS INTEGER) AS y1,
    CAST(trunc((x + 64) / scale) AS INTEGER) AS x2, CAST(trunc((y + 128) / scale) AS INTEGER) AS y2
  FROM valued WHERE score >= 0.93e0),
{kept_of('found', '0.3e0')},
dets AS (SELECT image, k.det_id AS det_id, k.score AS score, k.x1 AS x1, k.y1 AS y1, k.x2 AS x2, k.y2 AS y2 FROM found_kept),
{MATCHING}"""


def totals(matches: str) -> str:
    return f"""WITH RECURSIVE {matches}, sums AS (SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM matches),
        rates AS (SELECT *, {share('tp', 'tp + fp')} AS p, {share('tp', 'tp + fn')} AS r FROM sums)
        SELECT tp, fp, fn, {rounded('p', 4)} AS precision, {rounded('r', 4)} AS recall, {rounded(share('2e0 * p * r', 'p + r'), 4)} AS f1 FROM rates"""


MATCHED_BOXES = f"WITH RECURSIVE {MATCHES} SELECT image, tp, fp, fn, n_gt, n_pred FROM matches"

BACKGROUND = f"""{BOXES},
draws AS (
  SELECT image, width, height, attempt,
    {md5_bits("image || '|' || attempt", 42, 0)} AS h0,
    {md5_bits("image || '|' || attempt", 42, 1)} AS h1,
    {md5_bits("image || '|' || attempt", 42, 2)} AS h2
  FROM images, range(1, 201) AS tries(attempt)),
sized AS (
  SELECT *, CAST(floor((0.5e0 + h0 / 4294967296e0) * 64) AS INTEGER) AS w,
    CAST(floor((0.5e0 + h0 / 4294967296e0) * 128) AS INTEGER) AS h FROM draws),
placed AS (
  SELECT image, attempt, CAST(h1 % (width - w + 1) AS INTEGER) AS x1, CAST(h2 % (height - h + 1) AS INTEGER) AS y1, w, h
  FROM sized WHERE w <= width AND h <= height),
cands AS (SELECT image, attempt, x1, y1, x1 + w AS x2, y1 + h AS y2 FROM placed),
free AS (
  SELECT * FROM cands c WHERE NOT EXISTS (
    SELECT 1 FROM truth t WHERE t.image = c.image AND {iou('c', 't')} > 0.15e0)),
sampled AS (
  SELECT * FROM free QUALIFY row_number() OVER (PARTITION BY image ORDER BY attempt) <= 10)"""

STACKED = f"""{BACKGROUND},
positive AS (SELECT image, x1, y1, x2, y2, 1 AS label FROM truth WHERE x2 - x1 >= 32 AND y2 - y1 >= 32),
numbered AS (SELECT *, row_number() OVER (ORDER BY image, attempt) AS n FROM sampled),
stacked AS (
  SELECT * FROM positive UNION ALL
  SELECT image, x1, y1, x2, y2, 0 FROM numbered
  WHERE n <= (SELECT CAST(floor(count(*) * 1.2e0) AS BIGINT) FROM positive))"""

FEATURES = f"""{TRIPS},
features AS (
  SELECT pickup_date, pickup_hour, pickup_weekday, is_weekend, pickup_zone, count(*) AS demand,
    {DISTANCE} AS avg_distance, {FARE} AS avg_fare, {DURATION} AS avg_duration_min
  FROM trips GROUP BY ALL)"""

SPLIT = f"""{FEATURES},
parts AS (
  SELECT *, {md5_bits("CAST(pickup_date AS VARCHAR) || '|' || pickup_hour || '|' || pickup_zone", SPLIT_SEED)} % 100 < 75 AS is_train
  FROM features),
baseline AS (
  SELECT *, (SELECT avg(demand) FROM parts WHERE is_train) AS mean_demand FROM parts WHERE NOT is_train)"""

LINE_FEATURES = ["pickup_hour", "pickup_weekday", "is_weekend", "avg_fare", "avg_duration_min"]
LINE_SYSTEM = ", ".join(
    "[" + ", ".join([f"sum(d[{i}] * d[{j}])" for j in range(1, 6)] + [f"sum(d[{i}] * e)"]) + "]" for i in range(1, 6)
)
# normal equations of the rows less their zone's means, solved by elimination
ZONE_LINE = f"""{SPLIT},
xs AS (SELECT *, CAST(demand AS DOUBLE) AS y, [{', '.join(f'CAST({c} AS DOUBLE)' for c in LINE_FEATURES)}] AS x FROM parts),
means AS (SELECT pickup_zone, count(*) AS n, avg(y) AS my, [{', '.join(f'avg(x[{i}])' for i in range(1, 6))}] AS mx FROM xs WHERE is_train GROUP BY pickup_zone),
centred AS (SELECT list_transform(range(1, 6), lambda i: x[i] - mx[i]) AS d, y - my AS e FROM xs JOIN means USING (pickup_zone) WHERE is_train),
solve(k, m) AS (
  SELECT 0, [{LINE_SYSTEM}] FROM centred
  UNION ALL
  SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda v: v / r[k + 1])
    ELSE list_transform(r, lambda v, j: v - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END) FROM solve WHERE k < 5),
line AS (SELECT list_transform(m, lambda r: r[6]) AS b FROM solve WHERE k = 5),
levels AS (SELECT pickup_zone, n, my - list_dot_product(mx, b) AS level FROM means, line),
unseen AS (SELECT sum(n * level) / sum(n) AS level FROM levels)"""

EVENT_ROWS = f"""{TRIPS},
numbered AS (SELECT *, row_number() OVER (ORDER BY pickup_datetime, event_id) AS n FROM trips)"""

LINE_TRIPS = """
line_trips AS (
  SELECT 'zone_' || l_suppkey AS pickup_zone, 'zone_' || l_suppkey || '_to_zone_' || l_partkey AS od_pair,
    l_quantity AS trip_distance, l_extendedprice AS fare_amount, l_linenumber * 7.5e0 AS trip_duration_min,
    l_extendedprice * (1 - l_discount) AS revenue
  FROM lineitem)"""

WEIGHT_LIST = "[" + ", ".join(f"{((i * 7) % 13 - 6) / 10}::DOUBLE" for i in range(64)) + "]"
SCORES = f"""
scored AS (
  SELECT vec_id, list_reduce(list_prepend(0e0, list_transform(range(1, 65),
      lambda i: CAST(embedding[i] AS DOUBLE) * ({WEIGHT_LIST})[i])), lambda a, b: a + b) + 0.1e0 AS decision,
    CASE WHEN label < 5 THEN 1 ELSE 0 END AS label
  FROM embeddings),
judged AS (SELECT *, CASE WHEN decision >= 0 THEN 1 ELSE 0 END AS prediction FROM scored)"""

MODEL_ROWS = """
guesses AS (
  SELECT 'by_quantity' AS model, l_extendedprice AS y, l_quantity * 1000 AS p FROM lineitem
  UNION ALL SELECT 'flat', l_extendedprice, 25000e0 FROM lineitem)"""


def regression(extra: str, source: str, y: str, p: str, group: str = "") -> str:
    return f"""SELECT {extra} {rounded(f'sqrt(avg(({y} - {p}) * ({y} - {p})))', 4)} AS rmse,
    {rounded(f'avg(abs({y} - {p}))', 4)} AS mae,
    {rounded(f'1e0 - avg(({y} - {p}) * ({y} - {p})) / nullif(var_pop({y}), 0)', 4)} AS r2
    FROM {source} {group}"""


def summary(source: str, columns: list[str], quartiles: bool) -> str:
    q = "".join(
        f" {rounded(f'quantile_cont(v, {p})', 4)} AS {n}," for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    )
    parts = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM {source}" for c in columns)
    return f"""SELECT "column", count(v) AS count, {rounded('avg(v)', 4)} AS mean,
    {rounded('stddev_samp(v)', 4)} AS stddev, {rounded('min(v)', 4)} AS min,{q if quartiles else ''}
    {rounded('max(v)', 4)} AS max FROM ({parts}) GROUP BY "column" """


SUMMARY_COLUMNS = ["trip_distance", "fare_amount", "total_amount", "trip_duration_min", "passenger_count"]


def quality(rule: str, digits: int) -> str:
    return f"""WITH {TRIP_ROWS}, n AS (
    SELECT count(*) AS before_rows, count(*) FILTER (WHERE {rule}) AS after_rows FROM trip_raw)
    SELECT before_rows, after_rows, before_rows - after_rows AS removed_rows,
    floor(CAST(before_rows - after_rows AS DOUBLE) * 1e{digits} / CAST(before_rows AS DOUBLE) + 0.5e0) / 1e{digits} AS removal_rate FROM n"""


CLEAN_COLUMNS = """event_id, passenger_count, trip_duration_min, pickup_date, pickup_month, pickup_hour,
    pickup_weekday, is_weekend, pickup_zone, dropoff_zone, od_pair, revenue, payment_type_label"""

HOURLY = f"{DISTANCE} AS avg_distance, {FARE} AS avg_fare, {DURATION} AS avg_duration_min, {REVENUE} AS revenue"

PEAK = """CASE WHEN pickup_hour BETWEEN 7 AND 9 THEN 'morning_peak'
    WHEN pickup_hour BETWEEN 17 AND 19 THEN 'evening_peak'
    WHEN pickup_hour BETWEEN 0 AND 5 THEN 'night' ELSE 'off_peak' END"""
FIVE = """CASE WHEN pickup_hour <= 5 THEN 'late_night' WHEN pickup_hour <= 10 THEN 'morning_peak'
    WHEN pickup_hour <= 15 THEN 'midday' WHEN pickup_hour <= 20 THEN 'evening_peak' ELSE 'night' END"""

BUCKETS = """CASE WHEN trip_distance <= 1 THEN 0 WHEN trip_distance <= 3 THEN 1 WHEN trip_distance <= 5 THEN 2
    WHEN trip_distance <= 10 THEN 3 WHEN trip_distance <= 20 THEN 4 ELSE 5 END"""

GOLD_TABLES = {
    "hourly_metrics": f"SELECT pickup_hour, count(*) AS trip_count, {HOURLY} FROM trips GROUP BY ALL",
    "daily_metrics": f"SELECT pickup_date, count(*) AS trip_count, {REVENUE} AS revenue, {FARE} AS avg_fare FROM trips GROUP BY ALL",
    "pickup_hotspots": f"SELECT pickup_zone, count(*) AS trip_count, {REVENUE} AS revenue, {DISTANCE} AS avg_distance FROM trips GROUP BY ALL",
    "od_routes": f"SELECT od_pair, count(*) AS trip_count, {FARE} AS avg_fare, {DURATION} AS avg_duration_min FROM trips GROUP BY ALL",
    "payment_metrics": f"SELECT payment_type_label AS payment_type, count(*) AS trip_count, {REVENUE} AS revenue, {TIP} AS avg_tip FROM trips GROUP BY payment_type_label",
    "demand_features": "SELECT pickup_date, pickup_hour, pickup_weekday, is_weekend, pickup_zone, demand, avg_distance, avg_fare, avg_duration_min FROM features",
}
GOLD_COLUMNS = {
    "hourly_metrics": "pickup_hour,trip_count,avg_distance,avg_fare,avg_duration_min,revenue",
    "daily_metrics": "pickup_date,trip_count,revenue,avg_fare",
    "pickup_hotspots": "pickup_zone,trip_count,revenue,avg_distance",
    "od_routes": "od_pair,trip_count,avg_fare,avg_duration_min",
    "payment_metrics": "payment_type,trip_count,revenue,avg_tip",
    "demand_features": "pickup_date,pickup_hour,pickup_weekday,is_weekend,pickup_zone,demand,avg_distance,avg_fare,avg_duration_min",
}
ANALYSIS_TABLES = {
    "demand_pattern": f"SELECT pickup_hour, count(*) AS trip_count, {REVENUE} AS revenue, {DURATION} AS avg_duration_min FROM trips GROUP BY ALL",
    "peak_periods": f"SELECT {PEAK} AS period, count(*) AS trip_count, {FARE} AS avg_fare, {DURATION} AS avg_duration_min FROM trips GROUP BY 1",
    "hotspots": f"SELECT pickup_zone, count(*) AS trip_count, {FARE} AS avg_fare FROM trips GROUP BY ALL ORDER BY trip_count DESC, pickup_zone LIMIT 30",
    "fare_distance": f"SELECT ['0-1', '1-3', '3-5', '5-10', '10-20', '20+'][bucket_no + 1] AS distance_bucket, bucket_no, trip_count, avg_fare, avg_total FROM (SELECT {BUCKETS} AS bucket_no, count(*) AS trip_count, {FARE} AS avg_fare, {TOTAL} AS avg_total FROM trips GROUP BY 1)",
    "time_features": f"SELECT pickup_weekday, pickup_hour, count(*) AS trip_count, {FARE} AS avg_fare FROM trips GROUP BY ALL",
    "od_rank": f"SELECT od_pair, count(*) AS trip_count, {FARE} AS avg_fare FROM trips GROUP BY ALL ORDER BY trip_count DESC, od_pair LIMIT 50",
}
TABLE_ORDER = {
    "hourly_metrics": "pickup_hour",
    "daily_metrics": "pickup_date",
    "pickup_hotspots": "trip_count DESC, pickup_zone",
    "od_routes": "trip_count DESC, od_pair",
    "payment_metrics": "trip_count DESC, payment_type",
    "demand_features": "pickup_date, pickup_hour, pickup_zone",
    "demand_pattern": "pickup_hour",
    "peak_periods": "trip_count DESC, period",
    "hotspots": "trip_count DESC, pickup_zone",
    "fare_distance": "bucket_no",
    "time_features": "pickup_weekday, pickup_hour",
    "od_rank": "trip_count DESC, od_pair",
}


def records(section: str, table: str, order: str, limit: int | None = None) -> str:
    cut = f"WHERE rank <= {limit}" if limit else ""
    return f"""SELECT '{section}' AS section, rank, record FROM (
    SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, CAST(to_json(t) AS VARCHAR) AS record
    FROM ({table}) t) {cut}"""


SMALL_SECTIONS = [
    ("hourly", "hourly_metrics", None),
    ("daily", "daily_metrics", None),
    ("hotspots", "pickup_hotspots", 15),
    ("od_routes", "od_routes", 15),
    ("payment", "payment_metrics", None),
]
SMALL_BUNDLE = " UNION ALL ".join(records(s, GOLD_TABLES[t], TABLE_ORDER[t], n) for s, t, n in SMALL_SECTIONS)
FULL_SECTIONS = [
    ("hourly", "hourly_metrics", None),
    ("daily", "daily_metrics", None),
    ("hotspots", "pickup_hotspots", 50),
    ("od_routes", "od_routes", 50),
    ("payment", "payment_metrics", None),
    ("demand_features", "demand_features", 500),
]
HEADLINE = """SELECT (SELECT pickup_hour FROM trips GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_hour,
        (SELECT pickup_zone FROM trips GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_zone,
        (SELECT od_pair FROM trips GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_od_pair"""

RAW_NAMES = [
    "event_id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "pickup_location_id", "dropoff_location_id", "payment_type", "fare_amount", "tip_amount", "total_amount",
]
TRIP_COLUMNS = RAW_NAMES + ["payment_type_label"]
LINE_TYPES = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
]


def rows_of(pairs, names: str) -> str:
    return f"(VALUES {', '.join(str(p) for p in pairs)}) AS v({names})"


def missing(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing_count FROM {source}" for c in columns
    )


MODEL_LINES = """lined AS (
  SELECT xs.*, (SELECT avg(demand) FROM parts WHERE is_train) AS mean_demand, coalesce(levels.level, unseen.level) + list_dot_product(x, b) AS lined
  FROM xs LEFT JOIN levels USING (pickup_zone), line, unseen WHERE NOT is_train)"""
RATED = (
    regression("'baseline_mean' AS model,", "lined", "demand", "mean_demand")
    + " UNION ALL " + regression("'linear_regression_baseline' AS model,", "lined", "demand", "lined")
)
METRICS = f"SELECT model, {', '.join(f'CAST({c} AS DECIMAL(18, 4)) AS {c}' for c in ('rmse', 'mae', 'r2'))} FROM ({RATED})"
EVALUATION = f"""SELECT 'demand' AS target, (SELECT count(*) FROM parts WHERE is_train) AS train_rows,
    (SELECT count(*) FROM parts WHERE NOT is_train) AS test_rows,
    (SELECT model FROM ({RATED}) WHERE r2 IS NOT NULL ORDER BY r2 DESC, model LIMIT 1) AS selected_model"""
SIDE_BY_SIDE = f"""SELECT pickup_date, pickup_hour, pickup_zone, pickup_weekday, {rounded('CAST(demand AS DOUBLE)', 3)} AS actual_demand,
    {rounded('mean_demand', 3)} AS baseline_prediction, {rounded('lined', 3)} AS improved_prediction FROM lined"""
MANIFEST = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", 'gold/{t}' AS path, count(*) AS rows, [{', '.join(repr(c) for c in GOLD_COLUMNS[t].split(','))}] AS columns FROM ({sql})"
    for t, sql in GOLD_TABLES.items()
)
BY_DEMAND = "pickup_date, pickup_hour, pickup_zone"
SMALL_NAMES = ["hourly", "daily", "hotspots", "od_routes", "payment", "predictions"]
OFFLINE_NAMES = [
    "quality.source", "quality.bronze_profile", "quality.silver_quality", "quality.gold_manifest",
    "gold.hourly", "analysis.summary", "analysis.demand_pattern", "analysis.peak_periods", "analysis.od_rank",
    "model.metrics", "model.evaluation_report", "model.predictions",
]
FULL_BUNDLE = " UNION ALL ".join(
    [records(f"gold.{s}", GOLD_TABLES[t], TABLE_ORDER[t], n) for s, t, n in FULL_SECTIONS]
    + [records("analysis.summary", HEADLINE, "top_hour")]
    + [records(f"analysis.{t}", sql, TABLE_ORDER[t]) for t, sql in ANALYSIS_TABLES.items()]
    + [
        records("quality.source", "SELECT count(*) AS rows, ['event_id', 'ts', 'user_id', 'event_type', 'value', 'props'] AS columns FROM events", "rows"),
        records("quality.bronze_profile", missing("trip_raw", TRIP_COLUMNS), '"column"'),
        records("quality.silver_quality", f"SELECT * FROM ({quality(valid(), 6)})", "before_rows"),
        records("quality.gold_manifest", MANIFEST, '"table"'),
        records("model.metrics", METRICS, "model"),
        records("model.evaluation_report", EVALUATION, "target"),
        records("model.predictions", SIDE_BY_SIDE, BY_DEMAND, 500),
    ]
)
SMALL_WITH_MODEL = f"{SMALL_BUNDLE} UNION ALL " + records("predictions", SIDE_BY_SIDE, BY_DEMAND, 80)


def check(rule: str, table: str, observed: str, needed: int) -> str:
    return f"""SELECT '{rule}' AS rule, '{table}' AS "table", observed, CAST({needed} AS BIGINT) AS needed,
    observed >= {needed} AS ok FROM (SELECT CAST({observed} AS BIGINT) AS observed FROM {table})"""


SILVER_CHECKED = "pickup_datetime,dropoff_datetime,trip_duration_min,pickup_hour,pickup_weekday,pickup_zone,dropoff_zone,od_pair,payment_type_label"

COUNT_WINDOWS = f"""WITH {EVENT_ROWS},
last AS (SELECT max(n) AS n FROM numbered),
ends AS (SELECT DISTINCT k FROM (SELECT unnest(range(25, n + 1, 25)) AS k FROM last UNION ALL SELECT n FROM last)),
covered AS (SELECT k, t.* FROM ends JOIN numbered t ON t.n > k - 120 AND t.n <= k),
zones AS (SELECT k, pickup_zone, count(*) AS c FROM covered GROUP BY k, pickup_zone
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, pickup_zone) = 1)
SELECT k AS event_id, CAST(count(*) AS INTEGER) AS window_size, count(*) AS trip_count, {FARE} AS avg_fare,
  {DISTANCE} AS avg_distance, any_value(z.pickup_zone) AS hotspot_zone
FROM covered JOIN zones z USING (k) GROUP BY k"""


def stratified(label: str, key: str = "event_id", columns: str = "event_id, event_type", source: str = "events") -> str:
    return f"""coded AS (
  SELECT {columns}, {label} AS label, {md5_bits(key, 42)} AS code FROM {source}),
split AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY code, {key})
    <= floor(count(*) OVER (PARTITION BY label) * 80 / 100.0) AS in_train FROM coded)"""


def share(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0)"


SCALED = f"""WITH cells AS (SELECT vec_id, CAST(i - 1 AS INTEGER) AS dim, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) AS r(i)),
    stats AS (SELECT dim, avg(v) AS m, stddev_samp(v) AS s FROM cells GROUP BY dim)
    SELECT vec_id, dim, {rounded('(v - m) / s', 4)} AS z FROM cells JOIN stats USING (dim)"""


def all_oracles() -> dict[str, str]:
    return {name: sql.strip() for name, sql in _ORACLES.items()}


_ORACLES: dict[str, str] = {
    "table_scan": "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem",
    "raw_trip_names": f"""SELECT CAST(p AS INTEGER) AS position, n AS "column", (SELECT count(*) FROM events) AS rows
        FROM {rows_of([(i + 1, n) for i, n in enumerate(RAW_NAMES)], 'p, n')}""",
    "typed_raw_trips": f"""WITH {TRIP_ROWS} SELECT event_id,
        CASE WHEN event_id % 13 <> 0 THEN pickup_datetime END AS pickup_datetime,
        CASE WHEN event_id % 13 <> 0 THEN trip_distance END AS trip_distance,
        CASE WHEN event_id % 13 <> 0 THEN fare_amount END AS fare_amount, payment_type_label FROM trip_raw""",
    "required_columns": """SELECT 'trips' AS "table", count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM events
        UNION ALL SELECT 'events', count(*), 'missing required columns: [''dropoff_datetime'', ''dropoff_location_id'', ''fare_amount'', ''passenger_count'', ''payment_type'', ''pickup_datetime'', ''pickup_location_id'', ''total_amount'', ''trip_distance'']' FROM events
        UNION ALL SELECT 'fares', count(*), 'missing required columns: [''fare_amount'', ''payment_type'']' FROM events""",
    "payment_labels": f"WITH {TRIP_ROWS} SELECT event_id, payment_type, payment_type_label FROM trip_raw",
    "payment_labels_missing_column": "SELECT event_id, 'unknown' AS payment_type_label FROM events",
    "trip_durations": """SELECT event_id,
        (epoch_us(ts + to_microseconds(750000 * (event_id % 400))) // 1000000 - epoch_us(ts) // 1000000) / 60.0e0 AS duration_min,
        (750000 * (event_id % 400)) / 60000000.0e0 AS duration_min_fractional FROM events""",
    "calendar_columns": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
        strftime(o_orderdate, '%Y-%m') AS order_month, CAST(hour(o_orderdate) AS INTEGER) AS order_hour,
        CAST(isodow(o_orderdate) - 1 AS INTEGER) AS order_weekday,
        CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM orders""",
    "zone_and_route_keys": f"WITH {TRIP_ROWS}, t AS (SELECT {DERIVED} FROM trip_raw) SELECT event_id, pickup_zone, dropoff_zone, od_pair FROM t",
    "trip_revenue": f"WITH {TRIP_ROWS} SELECT event_id, coalesce(total_amount, fare_amount) AS revenue FROM trip_raw",
    "clean_trips_strict": f"WITH {TRIPS} SELECT {CLEAN_COLUMNS} FROM trips",
    "clean_trips_lenient": f"WITH {KEPT} SELECT {CLEAN_COLUMNS} FROM trips",
    "quality_report": quality(valid(), 6),
    "quality_report_lenient": quality(LENIENT, 4),
    "quality_report_tight": quality(valid(60, 10, 100, 4), 6),
    "trip_event_rows": f"WITH {TRIPS} SELECT strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S.%f') AS pickup_datetime, pickup_zone, fare_amount, trip_distance FROM trips",
    "payment_display_names": f"""WITH {TRIPS} SELECT payment_type_label AS payment_type,
        {case_map('payment_type_label', PAYMENT_DISPLAY, 'payment_type_label')} AS payment_type_display,
        count(*) AS trip_count FROM trips GROUP BY payment_type_label""",
    "missing_values": f"WITH {TRIP_ROWS} " + missing("trip_raw", TRIP_COLUMNS),
    "missing_values_with_nan": """SELECT 'event_id' AS "column", CAST(0 AS BIGINT) AS missing_count UNION ALL
        SELECT 'value', count(*) FILTER (WHERE event_id % 9 = 0 OR event_id % 7 = 0) FROM events UNION ALL
        SELECT 'event_type', CAST(0 AS BIGINT)""",
    "column_types": f"""SELECT CAST(p AS INTEGER) AS position, n AS "column", t AS dtype,
        (SELECT count(*) FROM lineitem) AS rows, {len(LINE_TYPES)} AS columns
        FROM {rows_of([(i + 1, n, t) for i, (n, t) in enumerate(LINE_TYPES)], 'p, n, t')}""",
    "numeric_summary": f"WITH {TRIPS} " + summary("trips", SUMMARY_COLUMNS, False),
    "numeric_summary_exact": f"WITH {TRIPS} " + summary("trips", SUMMARY_COLUMNS, True),
    "sketched_quartiles": f"""WITH {TRIPS}, v AS ({' UNION ALL '.join(f"SELECT '{c}' AS c, CAST({c} AS DOUBLE) AS v FROM trips" for c in SUMMARY_COLUMNS)})
        SELECT c AS "column", count(v) AS count, q AS quartile, 0.01e0 AS bound, true AS within
        FROM v, (VALUES (0.25e0), (0.5e0), (0.75e0)) AS l(q) GROUP BY c, q""",
    "lineitem_summary_exact": summary("lineitem", ["l_quantity", "l_extendedprice", "l_discount"], True),
    "table_manifest": f"WITH {FEATURES} " + " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", 'gold/{t}' AS path, count(*) AS rows, '{GOLD_COLUMNS[t]}' AS columns FROM ({sql})"
        for t, sql in GOLD_TABLES.items()
    ),
    "source_files": """SELECT count(*) AS rows, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns,
        true AS has_size FROM orders""",
    "delivery_checks": f"""WITH RECURSIVE {ZONE_LINE}, {MODEL_LINES}, bronze AS (SELECT * FROM trip_raw), silver AS (SELECT * FROM trips),
        demand_features AS (SELECT * FROM features), demand_pattern AS ({ANALYSIS_TABLES['demand_pattern']}),
        od_rank AS ({ANALYSIS_TABLES['od_rank']}), model_metrics AS ({METRICS}),
        dashboard AS ({SMALL_WITH_MODEL}), offline AS ({FULL_BUNDLE}) """ + " UNION ALL ".join([
        check("bronze.rows(5000)", "bronze", "count(*)", 5000),
        check("silver.rows(5000)", "silver", "count(*)", 5000),
        check(f"silver.columns({SILVER_CHECKED})", "silver", "9 + 0 * count(*)", 9),
        check("demand_features.rows(1000)", "demand_features", "count(*)", 1000),
        check("demand_pattern.rows(1)", "demand_pattern", "count(*)", 1),
        check("od_rank.rows(1)", "od_rank", "count(*)", 1),
        check("bronze.filled(passenger_count)", "bronze", "-count(*) FILTER (WHERE passenger_count IS NULL)", 0),
        check("silver.values(cash,dispute,barter)", "silver", "count(DISTINCT payment_type_label) FILTER (WHERE payment_type_label IN ('cash', 'dispute', 'barter'))", 3),
        # one of the two demanded models is not among them
        check("model_metrics.values(linear_regression_baseline,random_forest_regressor)", "model_metrics", "count(*) FILTER (WHERE model = 'linear_regression_baseline')", 2),
        check("model_metrics.filled(rmse,mae,r2)", "model_metrics", "-count(*) FILTER (WHERE rmse IS NULL OR mae IS NULL OR r2 IS NULL)", 0),
        check("model_metrics.bounds(r2,-inf,1.0)", "model_metrics", "-count(*) FILTER (WHERE r2 IS NULL OR r2 > 1)", 0),
        check(f"dashboard.sections({','.join(SMALL_NAMES)})", "dashboard", f"count(DISTINCT section) FILTER (WHERE section IN ({', '.join(repr(n) for n in SMALL_NAMES)}))", len(SMALL_NAMES)),
        check(f"offline.sections({','.join(OFFLINE_NAMES)})", "offline", f"count(DISTINCT section) FILTER (WHERE section IN ({', '.join(repr(n) for n in OFFLINE_NAMES)}))", len(OFFLINE_NAMES)),
        check("offline.model.metrics.keys(model,rmse,mae,r2)", "offline", "-count(*) FILTER (WHERE section = 'model.metrics' AND NOT list_has_all(json_keys(record), ['model', 'rmse', 'mae', 'r2']))", 0),
        check("offline.model.metrics.bounds(r2,-inf,1.0)", "offline", "-count(*) FILTER (WHERE section = 'model.metrics' AND NOT coalesce(CAST(json_extract(record, '$.r2') AS DOUBLE) <= 1, false))", 0),
    ]),
    "hourly_metrics": f"WITH {TRIPS} {GOLD_TABLES['hourly_metrics']}",
    "hourly_metrics_counting_passengers": f"WITH {KEPT} SELECT pickup_hour, count(passenger_count) AS trip_count, {HOURLY} FROM trips GROUP BY ALL",
    "daily_metrics": f"WITH {TRIPS} {GOLD_TABLES['daily_metrics']}",
    "daily_metrics_in_month": f"WITH {TRIPS} SELECT * FROM ({GOLD_TABLES['daily_metrics']}) WHERE strftime(pickup_date, '%Y-%m') = '2024-01'",
    "pickup_hotspots": f"WITH {TRIPS} {GOLD_TABLES['pickup_hotspots']}",
    "od_routes": f"WITH {TRIPS} {GOLD_TABLES['od_routes']}",
    "payment_metrics": f"WITH {TRIPS} {GOLD_TABLES['payment_metrics']}",
    "payment_metrics_by_code": f"WITH {TRIPS} SELECT payment_type, count(*) AS trip_count, {REVENUE} AS revenue, {TIP} AS avg_tip FROM trips GROUP BY payment_type",
    "demand_features": f"WITH {FEATURES} SELECT * FROM features",
    "demand_features_weekend_share": f"WITH {FEATURES} SELECT *, CAST(is_weekend AS DOUBLE) AS weekend_share FROM features",
    "demand_pattern_from_cube": f"WITH {TRIPS} {ANALYSIS_TABLES['demand_pattern']}",
    "peak_periods": f"WITH {TRIPS} {ANALYSIS_TABLES['peak_periods']}",
    "peak_periods_five": f"WITH {TRIPS} SELECT {FIVE} AS period, count(*) AS trip_count, {FARE} AS avg_fare, {DURATION} AS avg_duration_min FROM trips GROUP BY 1",
    "fare_by_distance": f"WITH {KEPT} {ANALYSIS_TABLES['fare_distance']}",
    "fare_by_distance_bins": f"""WITH {TRIPS} SELECT ['(0, 1]', '(1, 3]', '(3, 5]', '(5, 10]', '(10, 20]', '(20, 100]'][bucket_no + 1] AS distance_bucket, *
        FROM (SELECT {BUCKETS} AS bucket_no, count(*) AS trip_count, {FARE} AS avg_fare, {TOTAL} AS avg_total
        FROM trips WHERE trip_distance > 0 AND trip_distance <= 100 GROUP BY 1)""",
    "weekday_hour": f"WITH {TRIPS} {ANALYSIS_TABLES['time_features']}",
    "weekday_hour_grid": f"""WITH {TRIPS}, cells AS (SELECT CAST(i // 24 AS INTEGER) AS pickup_weekday, CAST(i % 24 AS INTEGER) AS pickup_hour FROM range(168) AS r(i)),
        filled AS (SELECT c.pickup_weekday, c.pickup_hour, coalesce(trip_count, 0) AS trip_count, avg_fare
        FROM cells c LEFT JOIN ({ANALYSIS_TABLES['time_features']}) t USING (pickup_weekday, pickup_hour))
        SELECT *, max(trip_count) OVER () AS max_count FROM filled""",
    "trip_headline": f"WITH {TRIPS} {HEADLINE}",
    "top_zones": f"WITH {TRIPS} {ANALYSIS_TABLES['hotspots']}",
    "top_routes": f"WITH {TRIPS} {ANALYSIS_TABLES['od_rank']}",
    "seven_decimals": f"""WITH v AS (SELECT event_type, (value + event_id / 10000000.0e0) * CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END AS v FROM events)
        SELECT event_type, count(*) AS rows, CAST(sum(CAST(v AS DECIMAL(28, 7))) AS DOUBLE) AS total, {avg('v', 7)} AS average FROM v GROUP BY event_type""",
    "lineitem_hotspots": f"WITH {LINE_TRIPS} SELECT pickup_zone, count(*) AS trip_count, {REVENUE} AS revenue, {DISTANCE} AS avg_distance FROM line_trips GROUP BY pickup_zone",
    "lineitem_routes": f"WITH {LINE_TRIPS} SELECT od_pair, count(*) AS trip_count, {FARE} AS avg_fare, {DURATION} AS avg_duration_min FROM line_trips GROUP BY od_pair",
    "lineitem_top_routes": f"WITH {LINE_TRIPS} SELECT od_pair, count(*) AS trip_count, {FARE} AS avg_fare FROM line_trips GROUP BY od_pair ORDER BY trip_count DESC, od_pair LIMIT 50",
    "first_feature_records": f"WITH {FEATURES} SELECT * FROM features ORDER BY pickup_date, pickup_hour, pickup_zone LIMIT 500",
    "dashboard_small": f"WITH RECURSIVE {ZONE_LINE}, {MODEL_LINES} {SMALL_WITH_MODEL}",
    "dashboard_full": f"WITH RECURSIVE {ZONE_LINE}, {MODEL_LINES} {FULL_BUNDLE}",
    "dashboard_sections": f"WITH {TRIPS} SELECT section, count(*) AS records FROM ({SMALL_BUNDLE}) GROUP BY section",
    "stacked_tables": f"""WITH {TRIPS} SELECT 'hourly' AS "table", * FROM ({GOLD_TABLES['hourly_metrics']})
        UNION ALL BY NAME SELECT 'daily' AS "table", * FROM ({GOLD_TABLES['daily_metrics']})
        UNION ALL BY NAME SELECT 'pattern' AS "table", * FROM ({ANALYSIS_TABLES['demand_pattern']})""",
    "congestion_classes": f"SELECT event_id, {CLASS} AS congestion_level FROM (SELECT event_id, value AS speed_kmh, (event_id * 13 % 100) / 100.0e0 AS occupancy FROM events)",
    "reading_measures": f"""WITH {READINGS} SELECT event_id,
        {rounded('least(1e0, greatest(0.05e0, vehicle_count / CAST(capacity AS DOUBLE)))', 4)} AS occupancy, travel_time_sec
        FROM readings JOIN roads USING (road_id)""",
    "json_readings": f"WITH {READINGS} SELECT * FROM readings",
    "hop_windows": f"WITH {READINGS}, {HOPPED} SELECT window_start, window_start + INTERVAL '60 seconds' AS window_end, road_id, count(*) AS readings FROM hopped GROUP BY window_start, road_id",
    "congestion_alerts": f"WITH {ALERTS} SELECT * FROM alerts",
    "stream_congestion_alerts": f"WITH {ALERTS} SELECT * FROM alerts WHERE {CLOSED}",
    "stream_late_readings": f"WITH {READINGS}, {LATE_HOPPED}, {ALERT_SUMS} SELECT * FROM alerts WHERE {CLOSED}",
    "served_alerts_from_sink": f"""WITH {ALERTS}, held AS (SELECT * FROM alerts WHERE {CLOSED} ORDER BY window_end DESC, window_start DESC, road_id LIMIT 100),
        {SERVED}""",
    "stream_named_alerts": f"WITH {ALERTS} SELECT * REPLACE ({counted_text('road_name')} AS alert_text) FROM alerts",
    "severe_alerts": f"WITH {ALERTS} SELECT window_start, window_end, road_id, avg_speed_kmh FROM alerts WHERE severity = 'severe'",
    "enriched_alerts": f"""WITH {ALERTS} SELECT window_start, window_end, road_id,
        CASE WHEN road_id <> 'R010' THEN road_name END AS road_name, CASE WHEN road_id <> 'R010' THEN district ELSE '?' END AS district,
        vehicle_count, {rounded('avg_speed_kmh', 2)} AS avg_speed_kmh, {rounded('avg_occupancy', 3)} AS avg_occupancy,
        avg_travel_time_sec, severe_event_count, severity,
        CASE WHEN road_id <> 'R010' THEN {counted_text('road_name')} ELSE alert_text END AS alert_text FROM alerts""",
    "latest_alerts": f"""WITH {ALERTS} SELECT window_start, window_end, road_id, vehicle_count + 1 AS vehicle_count, 2 AS arrival
        FROM alerts ORDER BY window_end DESC, window_start DESC, road_id LIMIT 100""",
    "ranked_alerts": f"WITH {ALERTS} SELECT window_start, window_end, road_id, severity, avg_speed_kmh, vehicle_count FROM alerts ORDER BY {RANKED} LIMIT 30",
    "newest_alert": f"WITH {ALERTS} SELECT window_start, window_end, road_id, avg_speed_kmh FROM alerts ORDER BY window_end DESC, window_start DESC, {RANKED} LIMIT 1",
    "served_alerts": f"""WITH {ALERTS}, held AS (SELECT * FROM alerts ORDER BY window_end DESC, window_start DESC, road_id LIMIT 100),
        {SERVED}""",
    "speed_trend": f"""WITH {ALERTS}, top AS (SELECT * FROM alerts QUALIFY row_number() OVER (PARTITION BY window_start, window_end ORDER BY {RANKED}) = 1)
        SELECT window_start, window_end, coalesce(avg_speed_kmh, 0) AS speed_kmh FROM top ORDER BY window_end DESC LIMIT 30""",
    "severity_counts": f"""WITH {ALERTS} SELECT s AS severity, count(severity) AS alerts,
        {case_map('s', SEVERITY_DISPLAY, f"'{SEVERITY_DISPLAY_OTHER}'")} AS severity_display
        FROM (VALUES ('severe'), ('moderate'), ('slow')) AS l(s) LEFT JOIN alerts ON severity = s GROUP BY s""",
    "road_ranking": f"""WITH {ALERTS} SELECT coalesce(nullif(road_name, ''), road_id) AS road, count(*) AS alerts,
        min(CASE WHEN coalesce(avg_speed_kmh, 0) = 0 THEN 999e0 ELSE avg_speed_kmh END) AS min_speed_kmh
        FROM alerts GROUP BY 1 ORDER BY alerts DESC, min_speed_kmh, road LIMIT 10""",
    "alert_headline": f"""WITH {ALERTS} SELECT count(*) FILTER (WHERE severity = 'severe') AS severe_alerts,
        min(CASE WHEN coalesce(avg_speed_kmh, 0) = 0 THEN 999e0 ELSE avg_speed_kmh END) AS min_speed_kmh,
        (SELECT vehicle_count FROM alerts ORDER BY window_end DESC, window_start DESC, vehicle_count DESC LIMIT 1) AS latest_vehicles FROM alerts""",
    "current_severity_counts": f"""WITH {ALERTS}, {CURRENT} SELECT s AS severity, count(severity) AS alerts,
        {case_map('s', SEVERITY_DISPLAY, f"'{SEVERITY_DISPLAY_OTHER}'")} AS severity_display
        FROM (VALUES ('severe'), ('moderate'), ('slow')) AS l(s) LEFT JOIN newest ON severity = s GROUP BY s""",
    "current_road_ranking": f"""WITH {ALERTS}, {CURRENT} SELECT coalesce(nullif(road_name, ''), road_id) AS road, count(*) AS alerts,
        min(CASE WHEN coalesce(avg_speed_kmh, 0) = 0 THEN 999e0 ELSE avg_speed_kmh END) AS min_speed_kmh
        FROM newest GROUP BY 1 ORDER BY alerts DESC, min_speed_kmh, road LIMIT 10""",
    "current_alert_headline": f"""WITH {ALERTS}, {CURRENT} SELECT count(*) FILTER (WHERE severity = 'severe') AS severe_alerts,
        min(CASE WHEN coalesce(avg_speed_kmh, 0) = 0 THEN 999e0 ELSE avg_speed_kmh END) AS min_speed_kmh,
        (SELECT vehicle_count FROM newest ORDER BY window_end DESC, window_start DESC, vehicle_count DESC LIMIT 1) AS latest_vehicles FROM newest""",
    "current_speed_trend": f"""WITH {ALERTS}, {CURRENT}, top AS (SELECT * FROM newest QUALIFY row_number() OVER (PARTITION BY window_start, window_end ORDER BY {RANKED}) = 1)
        SELECT window_start, window_end, coalesce(avg_speed_kmh, 0) AS speed_kmh FROM top ORDER BY window_end DESC LIMIT 30""",
    "ingest_stats": f"WITH {ALERTS} SELECT count(*) AS messages, max(window_end) AS last_message_time, least(count(*), 100) AS alerts_held FROM alerts",
    "numbered_events": f"WITH {EVENT_ROWS} SELECT n AS event_id, event_id AS trip_id FROM numbered",
    "first_events": f"WITH {EVENT_ROWS} SELECT n AS event_id, event_id AS trip_id, pickup_zone FROM numbered WHERE n <= 500",
    "count_windows": COUNT_WINDOWS,
    "stream_count_windows": COUNT_WINDOWS,
    "annotation_boxes": """SELECT event_id AS image, CAST(k AS INTEGER) AS object_id,
        CAST((event_id * 97 + k * 11) % 400 AS INTEGER) AS x1, CAST((event_id * 53 + k * 7) % 200 AS INTEGER) AS y1,
        CAST((event_id * 97 + k * 11) % 400 + 60 AS INTEGER) AS x2, CAST((event_id * 53 + k * 7) % 200 + 120 AS INTEGER) AS y2
        FROM events JOIN range(1, 4) AS r(k) ON k <= event_id % 3 + 1""",
    "large_boxes": f"WITH {BOXES} SELECT * FROM truth WHERE x2 - x1 >= 70 AND y2 - y1 >= 70",
    "confident_detections": f"WITH {BOXES} SELECT image, det_id, score FROM dets WHERE score >= 0.25e0",
    "detection_classes": f"WITH {BOXES} SELECT image, class, count(*) AS detections FROM dets GROUP BY image, class",
    "images_with_boxes": f"WITH {BOXES} SELECT * FROM images WHERE image IN (SELECT image FROM truth WHERE x2 - x1 >= 95 AND y2 - y1 >= 95)",
    "background_boxes": f"""WITH {BOXES} SELECT image, det_id, x1, y1, x2, y2 FROM dets d WHERE NOT EXISTS (
        SELECT 1 FROM truth t WHERE t.image = d.image AND {iou('d', 't')} > 0.15e0)""",
    "suppressed_boxes": suppression("0.3e0"),
    "suppressed_boxes_loose": suppression("0.45e0"),
    "suppressed_boxes_in_rounds": suppression("0.3e0"),
    "matched_boxes": MATCHED_BOXES,
    "matched_boxes_in_rounds": MATCHED_BOXES,
    "detection_totals": totals(MATCHES),
    "scanned_images": totals(SCANNED),
    "sampled_background": f"WITH {BACKGROUND} SELECT image, CAST(attempt AS INTEGER) AS attempt, x1, y1, x2, y2 FROM sampled",
    "training_boxes": f"WITH {STACKED} SELECT * FROM stacked",
    "training_counts": f"""WITH {STACKED}, n AS (SELECT count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives FROM stacked)
        SELECT positives, negatives, {rounded('CAST(negatives AS DOUBLE) / nullif(CAST(positives AS DOUBLE), 0)', 2)} AS negatives_per_positive FROM n""",
    "detection_windows": f"""WITH {ALL_BOXES}, {GRID}
        SELECT image, scale, count(*) AS windows, CAST(sum(trunc(x / scale)) AS BIGINT) AS sum_x1, CAST(sum(trunc(y / scale)) AS BIGINT) AS sum_y1,
        CAST(sum(trunc((x + 64) / scale)) AS BIGINT) AS sum_x2, CAST(sum(trunc((y + 128) / scale)) AS BIGINT) AS sum_y2
        FROM grid GROUP BY image, scale""",
    "hash_split": f"WITH {SPLIT} SELECT pickup_date, pickup_hour, pickup_zone, CASE WHEN is_train THEN 'train' ELSE 'test' END AS part FROM parts",
    "zone_indexes": f"""WITH {FEATURES} SELECT pickup_zone, CAST(row_number() OVER (ORDER BY count(*) DESC, pickup_zone) - 1 AS INTEGER) AS zone_index
        FROM features GROUP BY pickup_zone""",
    "assembled_features": f"""WITH {FEATURES} SELECT pickup_date, pickup_hour, pickup_zone,
        [CAST(pickup_hour AS DOUBLE), CAST(pickup_weekday AS DOUBLE), CAST(is_weekend AS DOUBLE), avg_distance, avg_fare, avg_duration_min] AS vector
        FROM features""",
    "stratified_split": f"WITH {stratified('event_type')} SELECT event_id, event_type, in_train FROM split",
    "split_counts": f"""WITH {stratified("CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END")},
        n AS (SELECT count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives,
        count(*) FILTER (WHERE in_train) AS train_rows, count(*) FILTER (WHERE NOT in_train) AS test_rows FROM split)
        SELECT *, {rounded('CAST(negatives AS DOUBLE) / nullif(CAST(positives AS DOUBLE), 0)', 2)} AS negatives_per_positive FROM n""",
    "mean_baseline": f"WITH {SPLIT} SELECT pickup_date, pickup_hour, pickup_zone, {rounded('mean_demand', 4)} AS baseline_prediction FROM baseline",
    "mean_baseline_metrics": f"WITH {SPLIT} " + regression("", "baseline", "demand", "mean_demand"),
    "zone_line_coefficients": f"""WITH RECURSIVE {ZONE_LINE}
        SELECT unnest([{', '.join(repr(c) for c in LINE_FEATURES)}]) AS feature, unnest(list_transform(b, lambda v: {rounded('v', 6)})) AS coefficient FROM line
        UNION ALL SELECT 'level', {rounded('level', 6)} FROM unseen""",
    "zone_line_predictions": f"""WITH RECURSIVE {ZONE_LINE} SELECT pickup_date, pickup_hour, pickup_zone,
        {rounded('coalesce(levels.level, unseen.level) + list_dot_product(x, b)', 5)} AS baseline_prediction
        FROM xs LEFT JOIN levels USING (pickup_zone), line, unseen WHERE NOT is_train""",
    "demand_prediction_rows": f"""WITH {SPLIT} SELECT pickup_date, pickup_hour, pickup_weekday, pickup_zone, demand, true AS in_range
        FROM baseline ORDER BY pickup_date, pickup_hour, pickup_zone LIMIT 5000""",
    "svm_optimum": f"""WITH {stratified('CASE WHEN label < 5 THEN 1 ELSE 0 END', 'vec_id', 'vec_id', 'embeddings')}
        SELECT CAST(dim AS INTEGER) AS dim, count(*) AS rows, true AS weight_at_rest, true AS bias_at_rest
        FROM split, range(64) AS d(dim) WHERE in_train GROUP BY dim""",
    "model_comparison": f"WITH {MODEL_ROWS} " + regression("model,", "guesses", "y", "p", "GROUP BY model"),
    "best_model": f"WITH {MODEL_ROWS}, m AS ({regression('model,', 'guesses', 'y', 'p', 'GROUP BY model')}) SELECT model, r2 FROM m ORDER BY r2 DESC, model LIMIT 1",
    "linear_scores": f"WITH {SCORES} SELECT vec_id, {rounded('decision', 6)} AS decision FROM scored",
    "report_averages": f"""WITH {SCORES}, c AS (SELECT k, count(*) FILTER (WHERE label = k AND prediction = k) AS hit,
        count(*) FILTER (WHERE label = k) AS support, count(*) FILTER (WHERE prediction = k) AS guessed
        FROM judged, (VALUES (0), (1)) AS l(k) GROUP BY k),
        r AS (SELECT *, {share('hit', 'guessed')} AS p, {share('hit', 'support')} AS q FROM c),
        s AS (SELECT *, {share('2e0 * p * q', 'p + q')} AS f FROM r),
        n AS (SELECT CAST(sum(support) AS BIGINT) AS support, CAST(sum(hit) AS DOUBLE) / CAST(sum(support) AS DOUBLE) AS hits,
        avg(p) AS mp, avg(q) AS mq, avg(f) AS mf, sum(p * support) / sum(support) AS wp, sum(q * support) / sum(support) AS wq,
        sum(f * support) / sum(support) AS wf FROM s)
        SELECT 'accuracy' AS average, CAST(NULL AS DOUBLE) AS precision, CAST(NULL AS DOUBLE) AS recall, {rounded('hits', 4)} AS f1, support FROM n
        UNION ALL SELECT 'macro avg', {rounded('mp', 4)}, {rounded('mq', 4)}, {rounded('mf', 4)}, support FROM n
        UNION ALL SELECT 'weighted avg', {rounded('wp', 4)}, {rounded('wq', 4)}, {rounded('wf', 4)}, support FROM n""",
    "full_confusion_matrix": f"""WITH {SCORES}, shown AS (SELECT * FROM judged WHERE prediction = 1),
        k AS (SELECT label AS c FROM shown UNION SELECT prediction FROM shown)
        SELECT a.c AS label, b.c AS prediction, (SELECT count(*) FROM shown WHERE label = a.c AND prediction = b.c) AS rows
        FROM k AS a, k AS b""",
    "confusion_matrix": f"WITH {SCORES} SELECT label, prediction, count(*) AS rows FROM judged GROUP BY label, prediction",
    "class_report": f"""WITH {SCORES}, c AS (SELECT k AS class, count(*) FILTER (WHERE label = k AND prediction = k) AS hit,
        count(*) FILTER (WHERE label = k) AS support, count(*) FILTER (WHERE prediction = k) AS guessed
        FROM judged, (VALUES (0), (1)) AS l(k) GROUP BY k),
        r AS (SELECT *, {share('hit', 'guessed')} AS p, {share('hit', 'support')} AS q FROM c)
        SELECT class, {rounded('p', 4)} AS precision, {rounded('q', 4)} AS recall, {rounded(share('2e0 * p * q', 'p + q'), 4)} AS f1, support FROM r""",
    "scaled_vectors": SCALED,
    "stored_model": SCALED,
    "stored_table": f"WITH {FEATURES} SELECT * FROM features",
    "stored_csv": f"WITH {TRIPS} {GOLD_TABLES['od_routes']}",
    "stored_records": f"WITH {FEATURES} SELECT * FROM features ORDER BY pickup_date, pickup_hour, pickup_zone LIMIT 500",
    "model_display_names": f"""WITH {MODEL_ROWS}, m AS ({regression('model,', 'guesses', 'y', 'p', 'GROUP BY model')}),
        named AS (SELECT CASE model WHEN 'by_quantity' THEN 'linear_regression_baseline' ELSE model END AS model, r2 FROM m)
        SELECT model, {case_map('model', MODEL_DISPLAY, 'model')} AS model_display, r2 FROM named""",
}
