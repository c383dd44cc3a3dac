"""DuckDB SQL for each registered query that SQL can express.

Every statement starts from the raw tables and repeats the rules on its own: nothing here is shared with
the Spark code but the column names.
"""

from __future__ import annotations

_FLIGHTS = """
raw AS (
  SELECT event_id,
    CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day_of_month,
    CASE WHEN event_id % 97 = 0 THEN ' '
         ELSE ['AA','DL','UA','WN','B6','OO'][CAST(event_id % 6 AS INTEGER) + 1] END AS airline,
    CAST(CASE WHEN event_id % 101 = 0 THEN 1275 WHEN event_id % 211 = 0 THEN 2400
              ELSE hour(ts) * 100 + minute(ts) END AS INTEGER) AS crs_dep_time,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE floor(value) - 15.0 END AS dep_delay,
    CAST(CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS cancelled,
    CAST(CASE WHEN (event_type = 'signup' AND event_id % 7 = 0) OR (event_type = 'error' AND event_id % 55 = 0)
              THEN 1 ELSE 0 END AS DOUBLE) AS diverted,
    CAST(10000 + user_id % 10 AS INTEGER) AS origin_airport_id,
    CAST(20000 + CAST(json_extract(props, '$.k') AS INTEGER) AS INTEGER) AS dest_airport_id
  FROM events),
timed AS (
  SELECT *,
    CASE WHEN crs_dep_time = 2400 THEN epoch_ms(make_timestamp(year, month, day_of_month, 23, 59, 0.0))
         WHEN crs_dep_time // 100 BETWEEN 0 AND 23 AND crs_dep_time % 100 BETWEEN 0 AND 59
         THEN epoch_ms(make_timestamp(year, month, day_of_month, crs_dep_time // 100, crs_dep_time % 100, 0.0))
    END AS event_ms,
    CAST(CASE WHEN crs_dep_time % 100 BETWEEN 0 AND 59 THEN (crs_dep_time // 100) % 24 ELSE -1 END AS INTEGER) AS dep_hour
  FROM raw),
flights AS (
  SELECT *, event_ms + CASE WHEN event_id % 19 = 7 THEN 60000 * (1 + (event_id // 19) % 30) ELSE 0 END AS publish_ms
  FROM timed),
clean AS (
  SELECT event_id, year, month, day_of_month, airline, crs_dep_time, coalesce(dep_delay, 0.0) AS dep_delay,
    cancelled = 1.0 AS is_cancelled, diverted = 1.0 AS is_diverted, origin_airport_id, dest_airport_id,
    event_ms, dep_hour, publish_ms
  FROM flights
  WHERE trim(airline) <> '' AND origin_airport_id IS NOT NULL AND dest_airport_id IS NOT NULL
    AND event_ms IS NOT NULL AND dep_hour >= 0 AND NOT (cancelled = 1.0 AND diverted = 1.0)),
target AS (SELECT * FROM clean WHERE airline IN ('AA', 'DL', 'UA', 'WN')),
active AS (SELECT * FROM clean WHERE NOT is_cancelled AND NOT is_diverted)
"""

HOUR = 3_600_000
DAY = 24 * HOUR
_SIZES = {"1h": HOUR, "6h": 6 * HOUR, "1d": DAY, "7d": 7 * DAY}
_LOG_START = 1_704_067_200_000


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([_FLIGHTS.strip(), *[c.strip() for c in ctes]]) + "\n" + body.strip()


def _round(x: str, n: int = 2) -> str:
    scale = f"{10 ** n}.0e0"
    return f"(floor(({x}) * {scale} + 0.5e0) / {scale})"


def _ratio(num: str, den: str) -> str:
    return f"(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0e0 END)"


def _start(ms: str, size: int) -> str:
    return f"({ms} - {ms} % {size})"


# --- Q1 -----------------------------------------------------------------------------------------------


def _q1(src: str = "target", size: int = HOUR) -> str:
    flown = "count(*) FILTER (NOT is_cancelled)"
    return f"""
SELECT {_start('event_ms', size)} AS window_start, {_start('event_ms', size)} + {size} AS window_end, airline,
  count(*) AS num_flights,
  count(*) FILTER (NOT is_cancelled AND NOT is_diverted) AS completed,
  count(*) FILTER (is_cancelled) AS cancelled,
  count(*) FILTER (NOT is_cancelled AND is_diverted) AS diverted,
  {_round(_ratio('coalesce(sum(dep_delay) FILTER (NOT is_cancelled), 0)', flown))} AS dep_delay_mean,
  {_round(_ratio('count(*) FILTER (is_cancelled)', 'count(*)') + ' * 100.0e0')} AS cancellation_rate,
  {_round(_ratio('count(*) FILTER (NOT is_cancelled AND dep_delay > 15)', flown) + ' * 100.0e0')} AS late_departure_rate
FROM {src} GROUP BY ALL"""


# --- Q2 -----------------------------------------------------------------------------------------------


def _q2_stats(size: int, min_flights: int, src: str = "active") -> str:
    return f"""
SELECT {_start('event_ms', size)} AS window_start, {_start('event_ms', size)} + {size} AS window_end, origin_airport_id,
  count(*) AS num_flights, count(*) FILTER (dep_delay > 30) AS severe_delays,
  {_round('sum(dep_delay) / count(*)')} AS dep_delay_mean, max(dep_delay) AS dep_delay_max
FROM {src} GROUP BY ALL HAVING count(*) >= {min_flights}"""


_ENTRY = "{'carrier': airline, 'dest': CAST(dest_airport_id AS VARCHAR), 'dep_delay': dep_delay}"
_BY_DELAY = "dep_delay DESC, airline, CAST(dest_airport_id AS VARCHAR)"


def _q2_lists(size: int, src: str = "active", top: int = 20) -> str:
    return f"""
SELECT window_start, window_end, origin_airport_id, list({_ENTRY} ORDER BY {_BY_DELAY}) AS flights
FROM (SELECT *, row_number() OVER (PARTITION BY window_start, origin_airport_id ORDER BY {_BY_DELAY}) AS place
      FROM (SELECT *, {_start('event_ms', size)} AS window_start, {_start('event_ms', size)} + {size} AS window_end
            FROM {src} WHERE dep_delay > 30))
WHERE place <= {top} GROUP BY ALL"""


_RANK = (
    "CAST(row_number() OVER (PARTITION BY window_end ORDER BY severe_delays DESC, dep_delay_mean DESC, "
    "origin_airport_id) AS INTEGER)"
)
_LIST_JSON = "CASE WHEN l.flights IS NULL THEN '[]' ELSE CAST(to_json(l.flights) AS VARCHAR) END"


def _q2_ctes(label: str, min_flights: int, src: str = "active", airports: int = 10, flights: int = 20) -> list[str]:
    size = _SIZES[label]
    return [
        f"stats AS ({_q2_stats(size, min_flights, src)})",
        f"lists AS ({_q2_lists(size, src, flights)})",
        f"ranked AS (SELECT * FROM (SELECT *, {_RANK} AS rank FROM stats) WHERE rank <= {airports})",
        f"""q2 AS (
  SELECT r.window_start, r.window_end, '{label}' AS window_type, r.rank, r.origin_airport_id, r.num_flights,
    r.severe_delays, r.dep_delay_mean, r.dep_delay_max, l.flights, {_LIST_JSON} AS delayed_flights
  FROM ranked r LEFT JOIN lists l USING (window_start, window_end, origin_airport_id))""",
    ]


_Q2_COLUMNS = (
    "window_start, window_end, window_type, rank, origin_airport_id, num_flights, severe_delays, "
    "dep_delay_mean, dep_delay_max, delayed_flights"
)


def _q2(label: str, min_flights: int, **top: int) -> str:
    return _with(f"SELECT {_Q2_COLUMNS} FROM q2", *_q2_ctes(label, min_flights, **top))


def _q2_global(last: str, min_flights: int = 30) -> str:
    """``last``: SQL for the last boundary, over ``hourly``."""
    return _with(
        f"SELECT {_Q2_COLUMNS} FROM q2",
        f"""hourly AS (
  SELECT {_start('event_ms', HOUR)} + {HOUR} AS hour_end, origin_airport_id, count(*) AS n,
    count(*) FILTER (dep_delay > 30) AS severe, sum(dep_delay) AS total, max(dep_delay) AS longest
  FROM active GROUP BY ALL)""",
        f"""boundaries AS (
  SELECT unnest(generate_series((SELECT min(hour_end) FROM hourly), ({last}), {HOUR})) AS window_end)""",
        f"""stats AS (
  SELECT CAST({_LOG_START} AS BIGINT) AS window_start, b.window_end, origin_airport_id,
    CAST(sum(n) AS BIGINT) AS num_flights, CAST(sum(severe) AS BIGINT) AS severe_delays,
    {_round('sum(total) / sum(n)')} AS dep_delay_mean, max(longest) AS dep_delay_max
  FROM boundaries b JOIN hourly h ON h.hour_end <= b.window_end GROUP BY ALL HAVING sum(n) >= {min_flights})""",
        f"ranked AS (SELECT * FROM (SELECT *, {_RANK} AS rank FROM stats) WHERE rank <= 10)",
        f"""lists AS (
  SELECT window_end, origin_airport_id, list({_ENTRY} ORDER BY {_BY_DELAY}) AS flights
  FROM (SELECT b.window_end, a.*, row_number() OVER (PARTITION BY b.window_end, origin_airport_id ORDER BY {_BY_DELAY}) AS place
        FROM boundaries b JOIN active a ON a.event_ms < b.window_end WHERE dep_delay > 30)
  WHERE place <= 20 GROUP BY ALL)""",
        f"""q2 AS (
  SELECT r.window_start, r.window_end, 'global' AS window_type, r.rank, r.origin_airport_id, r.num_flights,
    r.severe_delays, r.dep_delay_mean, r.dep_delay_max, {_LIST_JSON} AS delayed_flights
  FROM ranked r LEFT JOIN lists l USING (window_end, origin_airport_id))""",
    )


# The view with holes: null ids, times and carriers.
_GAPS = """
gaps AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 59 <> 0 THEN airline END AS airline, CASE WHEN event_id % 61 <> 0 THEN origin_airport_id END AS origin_airport_id,
    CASE WHEN event_id % 67 <> 0 THEN dest_airport_id END AS dest_airport_id, CASE WHEN event_id % 71 <> 0 THEN crs_dep_time END AS crs_dep_time,
    CASE WHEN event_id % 73 <> 0 THEN year END AS year,
    CASE WHEN event_id % 71 <> 0 AND event_id % 73 <> 0 THEN event_ms END AS event_ms) FROM flights),
judged AS (
  SELECT *, CASE
    WHEN airline IS NULL OR trim(airline) = '' OR origin_airport_id IS NULL OR dest_airport_id IS NULL
      OR crs_dep_time IS NULL OR year IS NULL THEN 'completeness'
    WHEN event_ms IS NULL THEN 'event_time'
    WHEN cancelled = 1.0 AND diverted = 1.0 THEN 'contradiction' END AS reject_rule FROM gaps)"""


# --- sketch -------------------------------------------------------------------------------------------

# Accuracy 0.01, cubic interpolation.
_K = "34.998833302220895e0"
_A, _B, _C = "(6.0e0/35.0e0)", "(-0.6e0)", "(10.0e0/7.0e0)"
_OFFSET = 40000


def _bins(name: str, src: str, keys: str, value: str, weight: str = "1") -> str:
    """CTE ``name``: keys, bin, cnt, lo, hi. Bins sort in value order."""
    size = "abs(v)"
    return f"""{name} AS (
  SELECT {keys}, CASE WHEN v = 0 THEN 0 ELSE CAST(sign(v) AS INTEGER) * CAST({_OFFSET} + floor({_K} * (e + (({_A} * s + {_B}) * s + {_C}) * s)) AS INTEGER) END AS bin,
    CAST(sum(w) AS BIGINT) AS cnt, min(v) AS lo, max(v) AS hi
  FROM (SELECT *, {size} / pow(2.0e0, e) - 1.0e0 AS s
        FROM (SELECT *, CASE WHEN v <> 0 THEN g - (CASE WHEN pow(2.0e0, g) > {size} THEN 1 ELSE 0 END)
                                               + (CASE WHEN pow(2.0e0, g + 1) <= {size} THEN 1 ELSE 0 END) ELSE 0 END AS e
              FROM (SELECT *, CASE WHEN v <> 0 THEN floor(log2({size})) ELSE 0 END AS g
                    FROM (SELECT *, CAST({value} AS DOUBLE) AS v, {weight} AS w FROM {src}))))
  GROUP BY ALL)"""


def _bin_value(bin_: str) -> str:
    y = f"((abs({bin_}) - {_OFFSET}) / {_K})"
    whole = f"floor({y})"
    d0 = f"({_B} * {_B} - 3.0e0 * {_A} * {_C})"
    d1 = f"(2.0e0 * {_B} * {_B} * {_B} - 9.0e0 * {_A} * {_B} * {_C} - 27.0e0 * {_A} * {_A} * ({y} - {whole}))"
    p = f"cbrt(({d1} - sqrt({d1} * {d1} - 4.0e0 * {d0} * {d0} * {d0})) / 2.0e0)"
    inverse = f"(pow(2.0e0, {whole}) * (1.0e0 - ({_B} + {p} + {d0} / {p}) / (3.0e0 * {_A})))"
    return f"(CASE WHEN {bin_} = 0 THEN 0.0e0 ELSE sign({bin_}) * 1.01e0 * {inverse} END)"


def _quantiles(bins: str, keys: str, probabilities: dict[str, float], extra: str = "") -> str:
    hits = ", ".join(f"min(bin) FILTER (seen > {q}e0 * (total - 1)) AS {n}_bin" for n, q in probabilities.items())
    values = ", ".join(f"{_round(_bin_value(f'{n}_bin'), 6)} AS {n}" for n in probabilities)
    return f"""
SELECT {keys}, {extra} count, min, {values}, max
FROM (SELECT {keys}, CAST(sum(cnt) AS BIGINT) AS count, min(lo) AS min, max(hi) AS max, {hits}
      FROM (SELECT *, sum(cnt) OVER (PARTITION BY {keys}) AS total,
                   sum(cnt) OVER (PARTITION BY {keys} ORDER BY bin) AS seen FROM {bins})
      GROUP BY ALL)"""


_Q3_PROBS = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}
_LATE_PROBS = {"p50": 0.50, "p90": 0.90, "p95": 0.95, "p99": 0.99}
_Q3_KEYS = "window_start, window_end, airline, hour"
_Q3_ACTIVE = "q3_rows AS (SELECT * FROM target WHERE NOT is_cancelled AND NOT is_diverted)"


def _q3(label: str, where: str = "") -> str:
    size = _SIZES[label]
    kind = f"'{label}' AS window_type,"
    return _with(
        f"SELECT * FROM ({_quantiles('bins', _Q3_KEYS, _Q3_PROBS, kind)}) {where}",
        _Q3_ACTIVE,
        f"""windowed AS (
  SELECT {_start('event_ms', size)} AS window_start, {_start('event_ms', size)} + {size} AS window_end, airline,
    dep_hour AS hour, dep_delay FROM q3_rows)""",
        _bins("bins", "windowed", _Q3_KEYS, "dep_delay"),
    )


def _q3_special() -> str:
    """Delays that are no number do not count; a few are very large."""
    size = _SIZES["7d"]
    return _with(
        _quantiles("bins", _Q3_KEYS, _Q3_PROBS, "'7d' AS window_type,"),
        _Q3_ACTIVE,
        f"""windowed AS (
  SELECT {_start('event_ms', size)} AS window_start, {_start('event_ms', size)} + {size} AS window_end, airline,
    dep_hour AS hour, dep_delay * CASE WHEN event_id % 47 = 0 THEN 100000 ELSE 1 END AS dep_delay
  FROM q3_rows WHERE event_id % 13 <> 0)""",
        _bins("bins", "windowed", _Q3_KEYS, "dep_delay"),
    )


def _q3_global(last: str) -> str:
    return _with(
        _quantiles("bins", _Q3_KEYS, _Q3_PROBS, "'global' AS window_type,"),
        _Q3_ACTIVE,
        f"""boundaries AS (
  SELECT unnest(generate_series((SELECT min({_start('event_ms', DAY)} + {DAY}) FROM q3_rows), ({last}), {DAY})) AS window_end)""",
        f"""windowed AS (
  SELECT CAST({_LOG_START} AS BIGINT) AS window_start, b.window_end, airline, dep_hour AS hour, dep_delay
  FROM boundaries b JOIN q3_rows r ON r.event_ms < b.window_end)""",
        _bins("bins", "windowed", _Q3_KEYS, "dep_delay"),
    )


# --- late data ----------------------------------------------------------------------------------------

_WATERMARKS = """
per_minute AS (SELECT publish_ms // 60000 AS minute, max(event_ms) AS newest FROM flights WHERE event_ms IS NOT NULL GROUP BY ALL),
marks AS (
  SELECT minute, max(newest) OVER (ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM per_minute)
"""


def _late_report() -> str:
    cases = (("q1", "1h", "target"), ("q2", "1h", "active"), ("q2", "6h", "active"), ("q3", "1d", "q3_rows"), ("q3", "7d", "q3_rows"))
    parts = [
        f"""SELECT '{q}' AS query, '{w}' AS window_type, d AS watermark_delay, l AS allowed_lateness,
  {_start('event_ms', _SIZES[w])} + {_SIZES[w]} AS window_end, seen
FROM {src} JOIN marks ON minute = publish_ms // 60000, (VALUES (30, 0), (5, 25), (10, 0), (0, 0)) s(d, l)"""
        for q, w, src in cases
    ]
    lost = "coalesce(window_end + (watermark_delay + allowed_lateness) * 60000 <= seen, false)"
    fired = "coalesce(window_end + watermark_delay * 60000 <= seen, false)"
    return _with(
        f"""SELECT query, window_type, watermark_delay, allowed_lateness, count(*) AS num_rows,
  count(*) FILTER (NOT {fired}) AS on_time, count(*) FILTER ({fired} AND NOT {lost}) AS "update",
  count(*) FILTER ({lost}) AS lost
FROM (SELECT query, window_type, CAST(watermark_delay AS INTEGER) AS watermark_delay,
             CAST(allowed_lateness AS INTEGER) AS allowed_lateness, window_end, seen FROM everything) GROUP BY ALL""",
        _Q3_ACTIVE, _WATERMARKS, "everything AS (" + "\nUNION ALL\n".join(parts) + ")",
    )


def _lost_rows(delay: int, lateness: int) -> str:
    end = f"({_start('event_ms', HOUR)} + {HOUR})"
    return f"""
lost AS (
  SELECT a.*, {end} AS window_end,
    (seen - {delay} * 60000 - ({end} + {lateness} * 60000)) / 60000.0e0 AS lateness_min
  FROM active a JOIN marks ON minute = publish_ms // 60000
  WHERE {end} + {delay + lateness} * 60000 <= seen)"""


def _lateness_stats() -> str:
    inner = _quantiles("bins", "scope", _LATE_PROBS)
    values = ", ".join(f"coalesce(max({n}), 0.0e0) AS lateness_{n}" for n in _LATE_PROBS)
    return _with(
        f"""SELECT CAST(coalesce(sum(count), 0) AS BIGINT) AS total_late_records,
  CAST(coalesce(floor(max(max)), 0) AS BIGINT) AS max_lateness_minutes, {values} FROM ({inner})""",
        _WATERMARKS, _lost_rows(0, 0),
        "positive AS (SELECT 'all' AS scope, lateness_min FROM lost WHERE lateness_min > 0)",
        _bins("bins", "positive", "scope", "lateness_min"),
    )


_INGEST = f"""
bounds AS (
  SELECT {_start('event_ms', HOUR)} AS window_start, {_start('event_ms', HOUR)} + {HOUR} AS window_end, airline,
    max(publish_ms) AS newest_ingest_ms, min(publish_ms) AS oldest_ingest_ms,
    CAST(sum(publish_ms) AS BIGINT) AS sum_ingest_ms, count(publish_ms) AS ingest_count,
    CAST(sum(publish_ms) // count(publish_ms) AS BIGINT) AS avg_ingest_ms
  FROM target WHERE publish_ms > 0 GROUP BY ALL)"""


def _ingest_of(src: str, size: int, *keys: str) -> str:
    named = ", ".join(keys)
    return f"""
bounds AS (
  SELECT {_start('event_ms', size)} AS window_start, {_start('event_ms', size)} + {size} AS window_end, {named},
    max(publish_ms) AS newest_ingest_ms, min(publish_ms) AS oldest_ingest_ms,
    CAST(sum(publish_ms) AS BIGINT) AS sum_ingest_ms, count(publish_ms) AS ingest_count,
    CAST(sum(publish_ms) // count(publish_ms) AS BIGINT) AS avg_ingest_ms
  FROM {src} WHERE publish_ms > 0 GROUP BY ALL)"""


def _encode_q3() -> str:
    columns = ("window_start", "window_end", "window_type", "airline", "hour", "count", "min", "p25", "p50", "p75", "p90", "max")
    obj = "{" + ", ".join(f"'{c}': {c}" for c in columns) + "}"
    return f"SELECT CAST(NULL AS VARCHAR) AS key, CAST(to_json({obj}) AS VARCHAR) AS value FROM ({_q3('1d')})"


def _latency_stats() -> str:
    samples = "\nUNION ALL\n".join(
        f"""SELECT 'q1_window' AS step, 'e2e_{m}_ms' AS metric,
  CAST(greatest(window_end + 1800000 - {m}_ingest_ms, 0) AS DOUBLE) AS latency_ms FROM bounds"""
        for m in ("newest", "oldest", "avg")
    )
    names = ", ".join(_LATE_PROBS)
    return _with(
        f"SELECT step, metric, count, {names}, max FROM ({_quantiles('bins', 'step, metric', _LATE_PROBS)})",
        _INGEST, f"samples AS ({samples})", _bins("bins", "samples", "step, metric", "latency_ms"),
    )


# --- streams ------------------------------------------------------------------------------------------


def _arrival_part(ms: str) -> str:
    day = f"(({ms} - {_LOG_START}) // {DAY})"
    return f"(CASE WHEN {day} < 8 THEN 0 WHEN {day} < 16 THEN 1 WHEN {day} < 24 THEN 2 ELSE 3 END)"


def _seen_by_part(src: str) -> str:
    """Largest event time of all rows with a valid time in earlier arrival parts; delays of hours, not minutes."""
    slow = "(event_ms + (publish_ms - event_ms) * 60)"
    return f"""
newest AS (SELECT {_arrival_part(slow)} AS part, max(event_ms) AS newest FROM flights WHERE event_ms IS NOT NULL GROUP BY ALL),
seen AS (SELECT p.part, max(n.newest) AS seen FROM newest p LEFT JOIN newest n ON n.part < p.part GROUP BY ALL),
parts AS (SELECT *, {_arrival_part(slow)} AS part FROM {src})"""


def _stream_restart() -> str:
    kept = f"""
kept AS (SELECT parts.* FROM parts JOIN seen USING (part)
  WHERE seen IS NULL OR {_start('event_ms', HOUR)} + {HOUR} > seen - 10 * 60000)"""
    return _with(_q1("kept"), _seen_by_part("target"), kept)


def _stream_all() -> str:
    """Rows and flights of each result; the two since the start have a row for every snapshot."""
    results = {
        "q1": (_with(_q1()), "num_flights"), "q2_1h": (_q2("1h", 2), "num_flights"), "q2_6h": (_q2("6h", 2), "num_flights"),
        "q2_global": (_q2_global(_LAST_HOUR, 2), "num_flights"), "q3_1d": (_q3("1d"), "count"),
        "q3_7d": (_q3("7d"), "count"), "q3_global": (_q3_global(_LAST_DAY), "count"),
    }
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS query, count(*) AS result_rows, CAST(sum({n}) AS BIGINT) AS flights FROM ({sql})"
        for name, (sql, n) in results.items())


def _stream_late_split() -> str:
    end = f"({_start('event_ms', HOUR)} + {HOUR})"
    lateness = f"((seen - {end} - 10 * 60000) / 60000.0e0)"
    return _with(
        f"""SELECT event_id, {end} AS window_end, {_round(lateness, 6)} AS lateness_min
FROM parts JOIN seen USING (part) WHERE seen IS NOT NULL AND {lateness} >= 0 AND NOT is_cancelled AND NOT is_diverted""",
        _seen_by_part("clean"),
    )


# --- sources and results ------------------------------------------------------------------------------


def _scan_csv() -> str:
    return _with("""
SELECT CAST(CASE WHEN event_id % 41 = 0 THEN 20 ELSE year END AS INTEGER) AS year, month, day_of_month,
  trim(airline) AS op_unique_carrier, CAST(event_id AS VARCHAR) AS op_carrier_fl_num,
  origin_airport_id, dest_airport_id,
  CAST(CASE WHEN event_id % 43 = 0 THEN 0 ELSE crs_dep_time END AS INTEGER) AS crs_dep_time,
  dep_delay, cancelled, diverted, CAST(event_id % 3000 AS DOUBLE) AS distance, CAST(NULL AS VARCHAR) AS origin_state_abr
FROM raw WHERE event_id % 53 <> 0 AND event_id % 37 <> 0""")


def _encode_results() -> str:
    q1_cols = ("window_start", "window_end", "airline", "num_flights", "completed", "cancelled", "diverted",
               "dep_delay_mean", "cancellation_rate", "late_departure_rate")
    q2_cols = ("window_start", "window_end", "window_type", "rank", "origin_airport_id", "num_flights",
               "severe_delays", "dep_delay_mean", "dep_delay_max")
    obj1 = "{" + ", ".join(f"'{c}': {c}" for c in q1_cols) + "}"
    obj2 = "{" + ", ".join(f"'{c}': {c}" for c in q2_cols) + ", 'delayed_flights': coalesce(flights, [])}"
    return _with(
        f"""SELECT 'q1' AS query, airline AS key, CAST(to_json({obj1}) AS VARCHAR) AS value FROM q1
UNION ALL
SELECT 'q2_6h' AS query, CAST(origin_airport_id AS VARCHAR) AS key, CAST(to_json({obj2}) AS VARCHAR) AS value FROM q2""",
        f"q1 AS ({_q1()})", *_q2_ctes("6h", 5),
    )


def _lww() -> str:
    return _with(
        f"""SELECT * REPLACE (num_flights * CASE
  WHEN airline = 'AA' AND window_start % {2 * HOUR} = 0 THEN 100
  WHEN airline IN ('AA', 'UA') THEN 10 ELSE 1 END AS num_flights) FROM q1""",
        f"q1 AS ({_q1()})",
    )


def _text(ms: str) -> str:
    return f"strftime(epoch_ms({ms}), '%Y-%m-%d %H:%M:%S')"


def _export_q2() -> str:
    item = "printf('(%s,%s,%.2f)', f.carrier, f.dest, f.dep_delay)"
    return _with(
        f"""SELECT {_text('window_start')} AS ts, CAST(rank AS VARCHAR) AS rank, origin_airport_id, num_flights,
  severe_delays, dep_delay_mean, dep_delay_max,
  '[' || coalesce(array_to_string(list_transform(flights, lambda f: {item}), ', '), '') || ']' AS delayed_flights
FROM q2""",
        *_q2_ctes("6h", 5),
    )


_RUN_STATS = f"""
WITH runs AS (
  SELECT substr('SMF', CAST(user_id % 3 AS INTEGER) + 1, 1) AS scenario,
    substr('136', CAST(event_id % 3 AS INTEGER) + 1, 1) AS parallelism, day(ts) AS run,
    CAST(count(*) AS DOUBLE) AS rows_in, CAST(sum(floor(value)) AS DOUBLE) AS value_sum
  FROM events GROUP BY ALL)
SELECT scenario, parallelism, {_round('avg(rows_in)', 6)} AS rows_in_mean,
  {_round('coalesce(stddev_samp(rows_in), 0)', 6)} AS rows_in_std, {_round('avg(value_sum)', 6)} AS value_sum_mean,
  {_round('coalesce(stddev_samp(value_sum), 0)', 6)} AS value_sum_std
FROM runs GROUP BY ALL"""

_LAST_HOUR = "SELECT max(hour_end) FROM hourly"
_LAST_DAY = f"SELECT max({_start('event_ms', DAY)} + {DAY}) FROM q3_rows"
_EIGHTHS = "(floor(value) / 8.0e0 - 4.0e0)"

ORACLES: dict[str, str] = {
    "event_time": _with("SELECT event_id, crs_dep_time, event_ms, dep_hour FROM timed"),
    "clean_flights": _with("SELECT * EXCLUDE (publish_ms) FROM clean"),
    "rejects_by_rule": _with("""
SELECT reject_rule, count(*) AS corrupted_records_total FROM (
  SELECT CASE WHEN trim(airline) = '' OR origin_airport_id IS NULL OR dest_airport_id IS NULL THEN 'completeness'
              WHEN event_ms IS NULL OR dep_hour < 0 THEN 'event_time'
              WHEN cancelled = 1.0 AND diverted = 1.0 THEN 'contradiction' END AS reject_rule FROM flights)
WHERE reject_rule IS NOT NULL GROUP BY ALL"""),
    "active_flights": _with("SELECT event_id, airline, origin_airport_id, dep_delay FROM active"),
    "target_airlines": _with("SELECT event_id, airline, is_cancelled, is_diverted, dep_delay FROM target"),
    "global_avg_delay": _with("SELECT sum(dep_delay) / count(*) AS avg_delay FROM clean"),
    "round_half_up": f"""
SELECT event_id, {_round(_EIGHTHS)} AS two_decimals, {_round(_EIGHTHS, 1)} AS one_decimal,
  floor({_EIGHTHS} + 0.5e0) AS whole FROM events""",
    "safe_math": f"""
SELECT event_id, {_ratio('floor(value)', '(user_id - 75)')} AS ratio,
  {_round(_ratio('floor(value)', '(user_id - 75)'))} AS ratio_rounded,
  {_round(_ratio('floor(value)', '(user_id - 75)') + ' * 100.0e0')} AS percent FROM events""",
    "ts_format_parse": _with(f"""
SELECT event_id, {_text('event_ms')} AS event_text, coalesce(event_ms, 0) AS parsed_ms,
  coalesce({_start('event_ms', HOUR)}, 0) AS hour_start_ms FROM timed"""),
    "q1_1h": _with(_q1()),
    "q2_airport_stats": _with(_q2_stats(HOUR, 2)),
    "q2_top20": _with(
        "SELECT window_start, window_end, origin_airport_id, CAST(to_json(flights) AS VARCHAR) AS delayed_flights FROM lists",
        f"lists AS ({_q2_lists(6 * HOUR)})",
    ),
    "q2_1h": _q2("1h", 2),
    "q2_6h": _q2("6h", 5),
    "q2_global": _q2_global(_LAST_HOUR),
    "q3_1d": _q3("1d"),
    "q3_7d": _q3("7d"),
    "q3_global": _q3_global(_LAST_DAY),
    "ddsketch_quantiles": "WITH " + _bins("bins", "events", "event_type", "value - 15.0e0") + _quantiles(
        "bins", "event_type", {"p01": 0.01, "p25": 0.25, "p50": 0.50, "p90": 0.90, "p99": 0.99}
    ),
    "ddsketch_merge": _q3("7d"),
    "merge_equivalence": _q2("6h", 5),
    "merge_carrier": _with(_q1(size=DAY)),
    "disorder_assign": _with("SELECT event_id, event_ms, publish_ms FROM flights WHERE event_ms IS NOT NULL"),
    "late_report": _late_report(),
    "late_rows": _with(
        f"SELECT event_id, event_ms, publish_ms, window_end, {_round('lateness_min', 6)} AS lateness_min FROM lost",
        _WATERMARKS, _lost_rows(10, 0),
    ),
    "lateness_stats": _lateness_stats(),
    "ingest_bounds": _with("SELECT * FROM bounds", _INGEST),
    "ingest_bounds_q2": _with("SELECT * FROM bounds", _ingest_of("active", HOUR, "origin_airport_id")),
    "ingest_bounds_q3": _with(
        "SELECT * FROM bounds", _Q3_ACTIVE, _ingest_of("q3_rows", DAY, "airline", "dep_hour AS hour")),
    "encode_q3_json": _encode_q3(),
    "latency_stats": _latency_stats(),
    "scan_csv": _scan_csv(),
    "first_n_by_event_time": _with("""
SELECT event_id, epoch_ms(make_timestamp(year, month, day_of_month, 0, 0, 0.0))
    + (crs_dep_time // 100 * 60 + crs_dep_time % 100) * 60000 AS replay_ms, airline, crs_dep_time
FROM raw ORDER BY replay_ms NULLS FIRST, event_id LIMIT 500"""),
    "decode_json": _with("""
SELECT event_id, year, month, day_of_month, airline, crs_dep_time, dep_delay, cancelled, diverted,
  origin_airport_id, dest_airport_id, event_ms
FROM timed WHERE event_id % 23 <> 0 AND event_id % 29 <> 0 AND event_id % 31 <> 0"""),
    "encode_results_json": _encode_results(),
    "plain_string": _with(f"SELECT CAST({_round('sum(dep_delay) / count(*)')} AS VARCHAR) AS value FROM clean"),
    "typed_decode_q2": _with(
        """SELECT window_start AS time_ms, CAST(rank AS VARCHAR) AS rank, window_type,
  CAST(origin_airport_id AS BIGINT) AS origin_airport_id, window_end, num_flights, severe_delays,
  dep_delay_mean, dep_delay_max, delayed_flights FROM q2""",
        *_q2_ctes("6h", 5),
    ),
    "lww_upsert": _lww(),
    "pivot_fields": _with(
        """SELECT window_start, airline, CAST(num_flights AS DOUBLE) AS num_flights, CAST(completed AS DOUBLE) AS completed,
  CAST(cancelled AS DOUBLE) AS cancelled, CAST(diverted AS DOUBLE) AS diverted, dep_delay_mean, cancellation_rate,
  late_departure_rate FROM q1""",
        f"q1 AS ({_q1()})",
    ),
    "export_q1": _with(
        f"""SELECT * REPLACE ({_text('window_start')} AS window_start, {_text('window_end')} AS window_end) FROM q1""",
        f"q1 AS ({_q1()})",
    ),
    "export_q2": _export_q2(),
    "export_q3": f"""
SELECT {_text('window_start')} AS ts, airline, hour, count, min, p25, p50, p75, p90, max FROM ({_q3('7d')})""",
    "run_stats": _RUN_STATS,
    "q2_1h_top3": _q2("1h", 2, airports=3, flights=3),
    "q2_6h_top3": _q2("6h", 5, airports=3, flights=3),
    "rejects_with_gaps": _with(
        "SELECT reject_rule, count(*) AS corrupted_records_total FROM judged WHERE reject_rule IS NOT NULL GROUP BY ALL", _GAPS),
    "clean_with_gaps": _with("SELECT event_id, event_ms, airline FROM judged WHERE reject_rule IS NULL", _GAPS),
    "q3_7d_special": _q3_special(),
    # A drained stream ends its input, so every window is in its result.
    "stream_q1_1h": _with(_q1()),
    "stream_q1_lateness": _with(_q1()),
    "stream_restart": _stream_restart(),
    "stream_late_split": _stream_late_split(),
    "stream_q2_1h": _q2("1h", 2),
    "stream_q2_6h": _q2("6h", 5),
    "stream_q2_global": _q2_global(_LAST_HOUR),
    "stream_q3_1d": _q3("1d"),
    "stream_q3_7d": _q3("7d"),
    "stream_q3_global": _q3_global(_LAST_DAY),
    "stream_q2_lateness": _q2("1h", 2),
    "stream_q3_lateness": _q3("1d"),
    "stream_all": _stream_all(),
    "stream_q2_global_late": f"SELECT * FROM ({_q2_global(_LAST_HOUR)}) QUALIFY window_end = max(window_end) OVER ()",
    "stream_q3_global_late": f"SELECT * FROM ({_q3_global(_LAST_DAY)}) QUALIFY window_end = max(window_end) OVER ()",
}
