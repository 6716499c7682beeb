"""The queries in standard SQL, over the same parquet tables."""

from __future__ import annotations

from obsflow.operators.kmeans import FEATURES as POINT
from obsflow.operators.svm import (
    FEATURES,
    ITERATIONS,
    MIN_ROWS,
    REGULARISATION,
    SPLIT_SEED,
    STEP,
    TOLERANCE,
    TRAIN_SHARE,
)
from obsflow.plans.registry import EXAMPLE_CENTRES, EXAMPLE_WEIGHTS, LOG_THRESHOLD, MEASURED, PLACES
from obsflow.schema import DIVISORS, FIELDS, MESSAGE_KEY, SKY_CODES, STATION_CODES


def _round(expression, places=PLACES):
    e, unit = f"({expression})", f"1e{places}::DOUBLE"
    moved = f"round({e} * {unit} + sign({e}) * 1e{places - 12}::DOUBLE)"
    return f"(CASE WHEN {moved} = 0 THEN 0.0::DOUBLE ELSE {moved} / {unit} END)"


def _shown(columns, places=PLACES):
    return ", ".join(f"{_round(c, places)} AS {c}" for c in columns)


def _list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _floor(ts, seconds):
    us = seconds * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {us}) * {us})"


STATIONS = _list(STATION_CODES)
SKIES = _list([*SKY_CODES, "M"])

RAW = f"""
keyed AS (SELECT *, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k FROM events),
raw AS (
  SELECT event_id, k, user_id,
    {STATIONS}[user_id % 11 + 1] AS station,
    {_floor('ts', 300)} AS valid,
    CAST(value AS DOUBLE) AS tmpf,
    CAST(k - 20 AS DOUBLE) AS dwpf, CAST(k AS DOUBLE) AS relh, CAST(k + 5 AS DOUBLE) AS feel,
    CAST((user_id * 10) % 360 AS DOUBLE) AS drct, CAST(k % 30 AS DOUBLE) AS sped,
    CAST(29 AS DOUBLE) AS alti,
    CASE WHEN k % 4 = 0 THEN '-1.0' ELSE CAST(1000 + k % 40 AS VARCHAR) END AS mslp,
    '0.00' AS p01m, CAST(k % 11 AS DOUBLE) AS vsby,
    {SKIES}[event_id % 7 + 1] AS skyc1,
    CASE WHEN k % 5 = 0 THEN 'M' ELSE CAST(k * 100 AS VARCHAR) END AS skyl1,
    CASE WHEN k % 3 = 0 THEN 'M' ELSE CAST(k AS VARCHAR) END AS wxcodes,
    CASE WHEN event_id % 10 < 9 THEN 'M' ELSE '0.01' END AS ice_acceretion_1hr
  FROM keyed)"""

_SKY_CODE = "CASE skyc1 " + " ".join(f"WHEN '{s}' THEN '{c}'" for s, c in SKY_CODES.items()) + " ELSE '0' END"

CLEAN = RAW + f""",
clean AS (
  SELECT event_id, CAST(user_id % 11 AS VARCHAR) AS station, valid,
    tmpf / 100 AS tmpf, dwpf / 100 AS dwpf, relh / 100 AS relh, feel / 100 AS feel, drct / 100 AS drct,
    sped / 100 AS sped, alti / 100 AS alti,
    CASE WHEN k % 4 = 0 THEN 0.0::DOUBLE ELSE CAST(mslp AS DOUBLE) / 1000 END AS mslp,
    p01m, vsby / 100 AS vsby, {_SKY_CODE} AS skyc1,
    CASE WHEN skyl1 = 'M' THEN 0.0::DOUBLE ELSE CAST(skyl1 AS DOUBLE) / 100 END AS skyl1,
    CASE WHEN wxcodes = 'M' THEN '88' ELSE wxcodes END AS wxcodes,
    CASE WHEN ice_acceretion_1hr = 'M' THEN '0' ELSE ice_acceretion_1hr END AS ice_acceretion_1hr
  FROM raw)"""

SHORT = CLEAN + """,
aligned AS (SELECT * FROM clean WHERE epoch_us(valid) % 900000000 = 0),
framed AS (
  SELECT station, valid, avg(tmpf) OVER w AS temp, avg(relh) OVER w AS relh_avg, avg(vsby) OVER w AS vsby_avg
  FROM aligned
  WINDOW w AS (PARTITION BY station ORDER BY valid RANGE BETWEEN INTERVAL 2 HOURS PRECEDING AND CURRENT ROW)),
short AS (
  SELECT station, valid, valid - INTERVAL 2 HOURS AS window_start, max(temp) AS temp,
    max(relh_avg) AS relh_avg, max(vsby_avg) AS vsby_avg
  FROM framed GROUP BY station, valid)"""

SLIDING = """
weeks AS (
  SELECT station, date_trunc('day', valid) - to_days(CAST(d AS INTEGER)) AS window_start, tmpf
  FROM clean, (SELECT unnest(range(0, 7)) AS d)),
sliding AS (
  SELECT station, CAST(window_start AS TIMESTAMP) AS window_start,
    CAST(window_start + INTERVAL 7 DAYS AS TIMESTAMP) AS window_end,
    avg(tmpf) AS avg_temp, stddev_samp(tmpf) AS stddev_temp
  FROM weeks GROUP BY ALL)"""


def _scored(previous_start="valid - INTERVAL 7 DAYS", previous_end="valid - INTERVAL 1 DAY"):
    return (
        SHORT
        + ","
        + SLIDING
        + f""",
compared AS (
  SELECT *, {previous_start} AS prev_week_start, {previous_end} AS prev_week_end FROM short),
base AS (
  SELECT station, window_start AS baseline_start, {_round('avg_temp', 4)} AS avg_temp,
    {_round('stddev_temp', 4)} AS stddev_temp
  FROM sliding),
scored AS (
  SELECT c.*, b.baseline_start, b.avg_temp, b.stddev_temp,
    (c.temp - b.avg_temp) / nullif(b.stddev_temp, 0) AS z_score
  FROM compared c JOIN base b
    ON c.station = b.station AND CAST(c.prev_week_start AS DATE) = CAST(b.baseline_start AS DATE)
  WHERE b.stddev_temp <> 0)"""
    )


SCORED = _scored()
COLD = _scored(
    "CASE WHEN valid < TIMESTAMP '2024-01-08' THEN TIMESTAMP '2024-01-01' ELSE valid - INTERVAL 7 DAYS END",
    "CASE WHEN valid < TIMESTAMP '2024-01-02' THEN valid - INTERVAL 15 MINUTES ELSE valid - INTERVAL 1 DAY END",
)

SCORED_COLUMNS = (
    "station, valid, window_start, prev_week_start, prev_week_end, baseline_start, "
    + _shown(["temp", "relh_avg", "vsby_avg", "avg_temp", "stddev_temp", "z_score"])
)
SHORT_COLUMNS = "station, valid, window_start, " + _shown(["temp", "relh_avg", "vsby_avg"])

TWO_HOURS = """
two_hours AS (
  SELECT station, CAST(date_trunc('hour', valid) - to_hours(CAST(h AS INTEGER)) AS TIMESTAMP) AS window_start,
    tmpf AS temperature
  FROM clean, (SELECT unnest(range(0, 2)) AS h)),
dated AS (
  SELECT station, window_start, window_start + INTERVAL 2 HOURS AS window_end, temperature,
    CAST(CAST(window_start AS DATE) - 7 AS TIMESTAMP) AS prev_week_start,
    CAST(CAST(window_start AS DATE) - 1 AS TIMESTAMP) AS prev_week_end
  FROM two_hours)"""

RANGED = (
    CLEAN
    + ","
    + SLIDING
    + ","
    + TWO_HOURS
    + """,
ranged AS (
  SELECT d.*, s.window_start AS baseline_start, s.window_end AS baseline_end, s.avg_temp, s.stddev_temp,
    (d.temperature - s.avg_temp) / nullif(s.stddev_temp, 0) AS z_score
  FROM dated d JOIN sliding s
    ON d.station = s.station AND s.window_start >= d.prev_week_start AND s.window_start <= d.prev_week_end)"""
)
RANGED_COLUMNS = (
    "station, window_start, window_end, prev_week_start, prev_week_end, baseline_start, baseline_end, "
    + _shown(["temperature", "avg_temp", "stddev_temp", "z_score"])
)

WEEK = _floor("valid", 604800)


def _weekly(predicate):
    return f"""SELECT {WEEK} AS window_start, {WEEK} + INTERVAL 7 DAYS AS window_end, station,
    {_round('avg(tmpf)')} AS avg_temp, {_round('stddev_samp(tmpf)')} AS stddev_temp
  FROM clean WHERE {predicate} GROUP BY ALL"""


DAY = "hour(valid) >= 8 AND hour(valid) < 19"
NIGHT = "hour(valid) >= 19 OR hour(valid) < 8"

SCORE = " + ".join(f"{c} * ({w})" for c, w in zip(FEATURES, EXAMPLE_WEIGHTS))
LINEAR = SCORED + f""",
linear AS (
  SELECT station, valid, {SCORE} AS score, CASE WHEN {SCORE} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
    CASE WHEN abs(z_score) > 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
  FROM scored)"""


def _trained(columns=FEATURES, threshold=2):
    """Subgradient descent as a recursive query: a row per round, the last one with the weights."""
    weights = [f"w{i}" for i in range(len(columns))]
    margin = " + ".join(f"{c} * {w}" for c, w in zip(columns, weights))
    pulls = ", ".join(f"sum(CASE WHEN sign * ({margin}) < 1 THEN sign * {c} ELSE 0 END) AS g{i}" for i, c in enumerate(columns))
    pace = f"({STEP}::DOUBLE / sqrt(i + 1))"
    new = ", ".join(f"{w} * (1 - {pace} * {REGULARISATION}::DOUBLE) + {pace} * (g{i} / n) AS n{i}" for i, w in enumerate(weights))
    change = " + ".join(f"pow(n{i} - {w}, 2)" for i, w in enumerate(weights))
    length = " + ".join(f"pow(n{i}, 2)" for i in range(len(weights)))
    return f"""WITH RECURSIVE {SCORED.lstrip()},
judged AS (
  SELECT *, CASE WHEN abs(z_score) > {threshold} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
    CAST('0x' || substr(md5(station || '|' || strftime(valid, '%Y-%m-%d %H:%M:%S') || '|{SPLIT_SEED}'), 1, 8) AS BIGINT)
      / 4294967296.0 < {TRAIN_SHARE} AS is_train FROM scored),
train AS MATERIALIZED (SELECT label * 2 - 1 AS sign, {", ".join(columns)} FROM judged WHERE is_train),
rounds(i, {", ".join(weights)}, done) AS (
  SELECT 0, {", ".join("0.0::DOUBLE" for _ in weights)}, false
  UNION ALL
  SELECT i + 1, {", ".join(f"n{i}" for i in range(len(weights)))},
    i > 0 AND sqrt({change}) < {TOLERANCE}::DOUBLE * greatest(sqrt({length}), 1.0)
  FROM (SELECT *, {new} FROM (
    SELECT i, {", ".join(weights)}, count(*) AS n, {pulls}
    FROM rounds, train WHERE NOT done AND i < {ITERATIONS} GROUP BY i, {", ".join(weights)}))),
model AS (SELECT * FROM rounds WHERE i > 0 ORDER BY i DESC LIMIT 1),
gate AS (
  SELECT count(*) > {MIN_ROWS} AND count(*) FILTER (is_train) > 0 AND coalesce(sum(label) FILTER (is_train), 0) > 0
    AND coalesce(sum(label) FILTER (is_train), 0) < count(*) FILTER (is_train) AS ready FROM judged),
predicted AS (
  SELECT station, valid, label, {margin} AS score, CASE WHEN {margin} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM judged, model, gate WHERE NOT is_train AND ready)
SELECT station, valid, label, {_round('predicted.score')} AS score, prediction FROM predicted"""


def _distance(centre):
    return "sqrt(" + " + ".join(f"pow({c} - ({x}), 2)" for c, x in zip(POINT, centre)) + ")"


_D = [_distance(p) for p in EXAMPLE_CENTRES.points]
POINTS = SCORED + f""",
points AS (SELECT DISTINCT station, valid, {", ".join(POINT)} FROM scored),
measured AS (SELECT *, {_D[0]} AS d0, {_D[1]} AS d1, {_D[2]} AS d2 FROM points),
assigned AS (
  SELECT station, valid, {", ".join(POINT)}, least(d0, d1, d2) AS distance,
    CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS INTEGER) AS cluster
  FROM measured)"""


def _moved():
    values = ", ".join(
        f"({i}, {w * 0.5}::DOUBLE, " + ", ".join(f"({x})::DOUBLE" for x in p) + ")"
        for i, (p, w) in enumerate(zip(EXAMPLE_CENTRES.points, EXAMPLE_CENTRES.weights))
    )
    olds = ", ".join(f"o{i}" for i in range(len(POINT)))
    moved = ", ".join(
        f"{_round(f'CASE WHEN count(cluster) = 0 THEN o{i} ELSE (o{i} * kept + sum({c})) / (kept + count(cluster)) END')} AS {c}"
        for i, c in enumerate(POINT)
    )
    return f"""WITH {POINTS},
centres(id, kept, {olds}) AS (VALUES {values})
SELECT id::INTEGER AS cluster, {_round('kept + count(cluster)')} AS weight, {moved}
FROM centres LEFT JOIN assigned ON cluster = id GROUP BY id, kept, {olds}"""


def _followed(decay=0.9):
    """Two batches of closed windows: the first flagged with the first centres, the second with those it moved."""
    values = ", ".join(
        f"({i}, {w * decay}::DOUBLE, " + ", ".join(f"({x})::DOUBLE" for x in p) + ")"
        for i, (p, w) in enumerate(zip(EXAMPLE_CENTRES.points, EXAMPLE_CENTRES.weights))
    )
    olds = ", ".join(f"o{i}" for i in range(len(POINT)))
    new = ", ".join(
        f"CASE WHEN count(cluster) = 0 THEN o{i} ELSE (o{i} * kept + sum({c})) / (kept + count(cluster)) END AS o{i}"
        for i, c in enumerate(POINT)
    )
    near = "sqrt(" + " + ".join(f"pow({c} - o{i}, 2)" for i, c in enumerate(POINT)) + ")"
    return f"""WITH {SCORED},
half AS (
  SELECT make_timestamp(epoch_us(min(valid)) + (epoch_us(max(valid)) - epoch_us(min(valid))) // 2 + 1) AS bound FROM clean),
marks AS (
  SELECT (SELECT max(valid) FROM aligned, half WHERE valid < bound) - INTERVAL 15 MINUTES AS one,
    (SELECT max(valid) FROM aligned) - INTERVAL 15 MINUTES AS two),
points AS (
  SELECT DISTINCT station, valid, {", ".join(POINT)}, CASE WHEN valid + INTERVAL 15 MINUTES <= one THEN 1 ELSE 2 END AS batch
  FROM scored, marks WHERE valid + INTERVAL 15 MINUTES <= two),
centres(id, kept, {olds}) AS (VALUES {values}),
first_near AS (
  SELECT station, valid, {", ".join(POINT)}, arg_min(id, ({near}, id)) AS cluster, min({near}) AS distance
  FROM points, centres WHERE batch = 1 GROUP BY ALL),
moved AS (SELECT id, {new} FROM centres LEFT JOIN first_near ON cluster = id GROUP BY id, kept, {olds}),
second_near AS (
  SELECT station, valid, {", ".join(POINT)}, min({near}) AS distance FROM points, moved WHERE batch = 2 GROUP BY ALL),
both_batches AS (
  SELECT station, valid, {", ".join(POINT)}, distance, 1 AS batch FROM first_near
  UNION ALL SELECT station, valid, {", ".join(POINT)}, distance, 2 FROM second_near),
moments AS (SELECT batch, avg(distance) AS m, stddev_samp(distance) AS s FROM both_batches GROUP BY batch)
SELECT station, valid, {_shown(POINT)}, coalesce((distance - m) / nullif(s, 0) > 1, false) AS prediction
FROM both_batches JOIN moments USING (batch)"""


MESSAGE_FIELDS = ", ".join(f for f in FIELDS if f != "valid")

# A window is final once the watermark, a quarter hour behind the last row, has
# reached its end.
CLOSED_SHORT = (
    "valid + INTERVAL 15 MINUTES <= (SELECT max(valid) FROM aligned) - INTERVAL 15 MINUTES"
)

CLOSED_TWO_HOURS = "window_start + INTERVAL 2 HOURS <= (SELECT max(valid) FROM {table}) - INTERVAL 15 MINUTES"

ORACLE = {
    "flagship_zscore": f"WITH {SCORED} SELECT {SCORED_COLUMNS} FROM scored",
    "zscore_anomalies": f"WITH {SCORED} SELECT {SCORED_COLUMNS}, 1.0::DOUBLE AS label FROM scored WHERE abs(z_score) > 2",
    "zscore_cold_start": f"WITH {COLD} SELECT {SCORED_COLUMNS} FROM scored",
    "json_roundtrip": f"""WITH {RAW} SELECT '{MESSAGE_KEY}' AS event_key, valid, {MESSAGE_FIELDS},
  strftime(valid, '%Y-%m-%d %H:%M:%S') AS valid_text FROM raw""",
    "pattern_valid": f"WITH {RAW} SELECT event_id, valid FROM raw",
    "reformatted_valid": f"""WITH {RAW} SELECT event_id, strftime(valid, '%Y-%m-%d %H:%M:%S') AS valid_text, tmpf, valid
  FROM raw""",
    "csv_roundtrip": f"WITH {RAW} SELECT strftime(valid, '%Y-%m-%d %H:%M') AS valid, {MESSAGE_FIELDS} FROM raw",
    "impute_sentinels": f"""WITH {RAW} SELECT event_id,
  CASE WHEN k % 4 = 0 THEN '0' ELSE mslp END AS mslp,
  CASE WHEN skyl1 = 'M' THEN '0' ELSE skyl1 END AS skyl1,
  CASE WHEN wxcodes = 'M' THEN '88' ELSE wxcodes END AS wxcodes,
  CASE WHEN ice_acceretion_1hr = 'M' THEN '0' ELSE ice_acceretion_1hr END AS ice_acceretion_1hr,
  CASE WHEN skyc1 = 'M' THEN 'CLR' ELSE skyc1 END AS skyc1 FROM raw""",
    "encode_sky": f"""WITH {RAW} SELECT event_id,
  CASE WHEN skyc1 = 'M' THEN 'M' ELSE {_SKY_CODE} END AS skyc1 FROM raw""",
    "encode_station": f"WITH {RAW} SELECT event_id, CAST(user_id % 11 AS VARCHAR) AS station FROM raw",
    "scale_measurements": f"""WITH {RAW} SELECT event_id, """
    + ", ".join(f"{_round(f'TRY_CAST({c} AS DOUBLE) / {d}')} AS {c}" for c, d in DIVISORS.items())
    + " FROM raw",
    "feature_engineering": f"""WITH {CLEAN} SELECT event_id, station, valid, p01m, skyc1, wxcodes, ice_acceretion_1hr,
  {_shown(DIVISORS)} FROM clean""",
    "day_rows": "SELECT * FROM events WHERE hour(ts) >= 8 AND hour(ts) < 19",
    "night_rows": "SELECT * FROM events WHERE hour(ts) >= 19 OR hour(ts) < 8",
    "recent_week": "SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS",
    "aligned_rows": f"WITH {RAW} SELECT event_id, station, valid FROM raw WHERE epoch_us(valid) % 900000000 = 0",
    "count_by_topic_sorted": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type ORDER BY event_type",
    "window_count": f"""SELECT {_floor('ts', 10)} AS window_start, {_floor('ts', 10)} + INTERVAL 10 SECONDS AS window_end,
  event_type, count(*) AS count FROM events GROUP BY ALL""",
    "window_mean": f"""SELECT {_floor('ts', 10)} AS window_start, {_floor('ts', 10)} + INTERVAL 10 SECONDS AS window_end,
  {_round('avg(value)')} AS moving_average FROM events GROUP BY ALL""",
    "window_stats": f"""SELECT {_floor('ts', 10)} AS window_start, {_floor('ts', 10)} + INTERVAL 10 SECONDS AS window_end,
  {_round('avg(value)', 4)} AS avg, {_round('stddev_samp(value)', 4)} AS standard_dev, count(*) AS count,
  CAST(0 AS BIGINT) AS page, string_agg(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY value) AS list
FROM events GROUP BY ALL""",
    "window_outliers_1sigma": f"""WITH stats AS (
  SELECT {_floor('ts', 21600)} AS window_start, {_round('avg(value)', 4)} AS avg,
    {_round('stddev_samp(value)', 4)} AS standard_dev FROM events GROUP BY ALL),
scored AS (
  SELECT window_start, avg, standard_dev, value, (value - avg) / nullif(standard_dev, 0) AS z_score
  FROM events JOIN stats ON {_floor('ts', 21600)} = window_start)
SELECT window_start, {_shown(['avg', 'standard_dev', 'value', 'z_score'])} FROM scored WHERE abs(z_score) > 1""",
    "weekly_day": f"WITH {CLEAN} {_weekly(DAY)}",
    "weekly_night": f"WITH {CLEAN} {_weekly(NIGHT)}",
    "weekly_day_night": f"""WITH {CLEAN} SELECT *, 'day' AS period FROM ({_weekly(DAY)})
UNION ALL SELECT *, 'night' AS period FROM ({_weekly(NIGHT)})""",
    "sliding_week": f"""WITH {CLEAN}, {SLIDING} SELECT window_start, window_end, station,
  {_shown(['avg_temp', 'stddev_temp'])} FROM sliding""",
    "trailing_week": f"""WITH {CLEAN},
framed AS (
  SELECT station, valid, avg(tmpf) OVER w AS a, stddev_samp(tmpf) OVER w AS s FROM clean
  WINDOW w AS (PARTITION BY station ORDER BY valid RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW))
SELECT station, valid, {_round('max(a)')} AS avg_temp, {_round('max(s)')} AS stddev_temp
FROM framed GROUP BY station, valid""",
    "trailing_week_events": f"""WITH marked AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE event_type END AS kind, ts,
    value + 10 * CASE WHEN event_id % 3 = 0 THEN 0 ELSE length(event_type) END AS value FROM events),
framed AS (
  SELECT kind, ts, avg(value) OVER w AS a, stddev_samp(value) OVER w AS s FROM marked
  WINDOW w AS (PARTITION BY kind ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW))
SELECT kind, ts, {_round('max(a)')} AS avg_temp, {_round('max(s)')} AS stddev_temp FROM framed GROUP BY kind, ts""",
    "two_hour_lists": f"""WITH {RAW},
two_hours AS (
  SELECT station, CAST(date_trunc('hour', valid) - to_hours(CAST(h AS INTEGER)) AS TIMESTAMP) AS window_start, tmpf
  FROM raw, (SELECT unnest(range(0, 2)) AS h))
SELECT station, window_start, window_start + INTERVAL 2 HOURS AS window_end, CAST(0 AS BIGINT) AS page,
  string_agg(CAST(CAST(round(tmpf * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY tmpf) AS list
FROM two_hours GROUP BY station, window_start""",
    "two_hour_exploded": f"""WITH {CLEAN}, {TWO_HOURS}
SELECT station, window_start, window_end, {_shown(['temperature'])}, prev_week_start, prev_week_end FROM dated""",
    "range_join_compare": f"WITH {RANGED} SELECT {RANGED_COLUMNS} FROM ranged",
    "range_join_anomalies": f"WITH {RANGED} SELECT {RANGED_COLUMNS} FROM ranged WHERE abs(z_score) > 2",
    "trailing_mean_range": f"WITH {SHORT} SELECT {SHORT_COLUMNS} FROM short",
    "trailing_mean_window": f"WITH {SHORT} SELECT {SHORT_COLUMNS} FROM short",
    "window_standardise": f"""WITH {CLEAN},
placed AS (SELECT *, {_floor('valid', 21600)} AS window_start FROM clean),
stats AS (SELECT window_start, {", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in MEASURED)}
  FROM placed GROUP BY window_start)
SELECT event_id, window_start,
  {", ".join(f"{_round(f'({c} - {c}_m) / nullif({c}_s, 0)')} AS {c}_norm" for c in MEASURED)}
FROM placed JOIN stats USING (window_start)""",
    "standard_scale": f"""WITH {RAW}
SELECT event_id, {_round('tmpf / (SELECT stddev_samp(tmpf) FROM raw)')} AS tmpf_norm FROM raw""",
    "mean_impute": f"""WITH {RAW},
known AS (SELECT event_id, CASE WHEN mslp <> '-1.0' THEN CAST(mslp AS DOUBLE) END AS mslp FROM raw)
SELECT event_id, {_round('coalesce(mslp, (SELECT avg(mslp) FROM known))')} AS mslp FROM known""",
    "svm_features": f"""WITH {SCORED} SELECT station, valid,
  CASE WHEN abs(z_score) > 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, {_shown(FEATURES)} FROM scored""",
    "hash_split": f"""WITH {SCORED} SELECT station, valid,
  CAST('0x' || substr(md5(station || '|' || strftime(valid, '%Y-%m-%d %H:%M:%S') || '|11'), 1, 8) AS BIGINT)
    / 4294967296.0 < 0.6 AS is_train FROM scored""",
    "linear_score_fixed": f"""WITH {LINEAR} SELECT station, valid, {_shown(['score'])}, prediction
FROM linear WHERE prediction > 0""",
    "auroc_hard": f"""WITH {LINEAR} SELECT {_round('''(avg(CASE WHEN label = 1 THEN prediction END)
  + avg(CASE WHEN label = 0 THEN 1 - prediction END)) / 2''')} AS auroc FROM linear""",
    "train_gate": f"""WITH {LINEAR}, counted AS (SELECT count(*) AS n_rows, coalesce(sum(label), 0) AS n_positive FROM linear)
SELECT *, n_rows > 4 AND n_positive > 0 AND n_positive < n_rows AS ready FROM counted""",
    "kmeans_assign": f"WITH {POINTS} SELECT station, valid, {_shown([*POINT, 'distance'])}, cluster FROM assigned",
    "kmeans_distance_anomaly": f"""WITH {POINTS},
moments AS (SELECT avg(distance) AS m, stddev_samp(distance) AS s FROM assigned),
judged AS (SELECT station, valid, distance, (distance - m) / nullif(s, 0) AS distance_z FROM assigned, moments)
SELECT station, valid, {_shown(['distance', 'distance_z'])}, distance_z > 1 AS anomaly FROM judged""",
    "kmeans_distance_stats": f"""WITH {POINTS} SELECT count(distance) AS n, {_round('sum(distance)')} AS total,
  {_round('avg(distance)')} AS mean, {_round('stddev_samp(distance)')} AS sd FROM assigned""",
    "kmeans_step": _moved(),
    "top_anomalies": f"""WITH {SCORED} SELECT station, valid, {_shown(['temp', 'avg_temp', 'stddev_temp', 'z_score'])}
FROM scored WHERE abs(z_score) > 2 ORDER BY abs({_round('scored.z_score')}) DESC, station, valid LIMIT 10""",
    "access_log_parse": """WITH lines AS (SELECT *, event_id % 13 <> 5 AND event_id % 19 <> 6 AS good FROM events)
SELECT CASE WHEN good THEN '10.0.' || (user_id // 256) || '.' || (user_id % 256) END AS ip,
  CASE WHEN good THEN date_trunc('second', ts) - INTERVAL 210 MINUTES END AS ts,
  CASE WHEN good THEN ['GET', 'POST', 'HEAD', 'OPTIONS'][event_id % 4 + 1] END AS request_type,
  CASE WHEN good THEN '/' || event_type || CASE WHEN event_id % 17 = 4 THEN chr(1) ELSE '?' END || 'id=' || event_id END AS path,
  CAST(CASE WHEN good THEN CASE WHEN event_id % 2 = 0 THEN 200 ELSE 404 END END AS INTEGER) AS status,
  CASE WHEN good THEN CAST(floor(value * 100) AS BIGINT) END AS response_size, CASE WHEN good THEN '-' END AS referer,
  CASE WHEN good THEN CASE WHEN event_id % 11 = 3 THEN 'say \\"' || (user_id % 7) || '\\"' ELSE 'agent/' || (user_id % 7) END END AS agent
FROM lines""",
    "stream_weekly": f"""WITH {CLEAN} SELECT * FROM ({_weekly('TRUE')})
WHERE window_end <= (SELECT max(valid) FROM clean) - INTERVAL 15 MINUTES""",
    "stream_trailing_mean": f"WITH {SHORT} SELECT {SHORT_COLUMNS} FROM short WHERE {CLOSED_SHORT}",
    "stream_zscore_join": f"WITH {SCORED} SELECT {SCORED_COLUMNS} FROM scored WHERE {CLOSED_SHORT}",
    "stream_window_outliers": f"""WITH stats AS (
  SELECT {_floor('ts', 21600)} AS window_start, {_round('avg(value)', 4)} AS avg,
    {_round('stddev_samp(value)', 4)} AS standard_dev FROM events GROUP BY ALL),
scored AS (
  SELECT window_start, avg, standard_dev, value, (value - avg) / nullif(standard_dev, 0) AS z_score
  FROM events JOIN stats ON {_floor('ts', 21600)} = window_start)
SELECT window_start, {_shown(['avg', 'standard_dev', 'value', 'z_score'])} FROM scored
WHERE abs(z_score) > 1 AND window_start + INTERVAL 6 HOURS <= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTES""",
    "stream_window_standardise": f"""WITH {CLEAN},
placed AS (SELECT *, {_floor('valid', 21600)} AS window_start FROM clean),
stats AS (SELECT window_start, {", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in MEASURED)}
  FROM placed GROUP BY window_start)
SELECT event_id, window_start,
  {", ".join(f"{_round(f'({c} - {c}_m) / nullif({c}_s, 0)')} AS {c}_norm" for c in MEASURED)}
FROM placed JOIN stats USING (window_start)
WHERE window_start + INTERVAL 6 HOURS <= (SELECT max(valid) FROM clean) - INTERVAL 15 MINUTES""",
    "stream_two_hour_lists": f"""WITH {RAW},
two_hours AS (
  SELECT station, CAST(date_trunc('hour', valid) - to_hours(CAST(h AS INTEGER)) AS TIMESTAMP) AS window_start, tmpf
  FROM raw, (SELECT unnest(range(0, 2)) AS h))
SELECT station, window_start, window_start + INTERVAL 2 HOURS AS window_end, CAST(0 AS BIGINT) AS page,
  string_agg(CAST(CAST(round(tmpf * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY tmpf) AS list
FROM two_hours WHERE {CLOSED_TWO_HOURS.format(table='raw')} GROUP BY station, window_start""",
    "stream_two_hour_list_pages": f"""WITH {RAW},
two_hours AS (
  SELECT station, CAST(date_trunc('hour', valid) - to_hours(CAST(h AS INTEGER)) AS TIMESTAMP) AS window_start, tmpf
  FROM raw, (SELECT unnest(range(0, 2)) AS h)),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY station, window_start ORDER BY tmpf) - 1) // 2 AS page FROM two_hours)
SELECT station, window_start, window_start + INTERVAL 2 HOURS AS window_end, page,
  string_agg(CAST(CAST(round(tmpf * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY tmpf) AS list
FROM placed WHERE {CLOSED_TWO_HOURS.format(table='raw')} GROUP BY station, window_start, page""",
    "stream_two_hour_exploded": f"""WITH {CLEAN}, {TWO_HOURS}
SELECT station, window_start, window_end, {_shown(['temperature'])}, prev_week_start, prev_week_end FROM dated
WHERE {CLOSED_TWO_HOURS.format(table='clean')}""",
    "stream_paced": f"WITH {RAW} SELECT event_id, valid, {MESSAGE_FIELDS} FROM raw",
    "stream_distinct": "SELECT DISTINCT * FROM events",
    "stream_count_sorted": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type",
    "stream_range_join": f"WITH {RANGED} SELECT {RANGED_COLUMNS} FROM ranged WHERE abs(z_score) > 2",
    "anomaly_log": f"""WITH {POINTS},
moments AS (SELECT avg(distance) AS m, stddev_samp(distance) AS s FROM assigned)
SELECT station, valid, {_shown(POINT)}, (distance - m) / nullif(s, 0) > 1 AS prediction FROM assigned, moments""",
    "svm_fit_predict": _trained(),
    "supervised_log": _trained(threshold=LOG_THRESHOLD) + " WHERE prediction > 0",
    "stream_kmeans": _followed(),
}
