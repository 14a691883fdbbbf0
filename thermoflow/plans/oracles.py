"""SQL counterparts of the registered queries, for an independent engine (DuckDB)."""

from __future__ import annotations

_READINGS = """
readings AS (
    SELECT CAST(user_id % 5 AS VARCHAR) AS room_id,
           CASE WHEN event_type IN ('view', 'click') THEN 'IN' ELSE 'OUT' END AS source,
           ts, CAST(floor(value) AS INTEGER) AS temperature, event_id
    FROM events)"""

_NAMED = _READINGS + """,
named AS (
    SELECT 'room_' || room_id || '_' || source AS id, ts, temperature, event_id FROM readings)"""

_HOUR = "time_bucket(INTERVAL '1 hour', ts)"
_MINUTES = "time_bucket(INTERVAL '5 minutes', ts)"
_DAY = "time_bucket(INTERVAL '1 day', ts)"

_AVERAGES = _READINGS + f""",
averages AS (
    SELECT room_id, source, {_HOUR} AS window_start, {_HOUR} + INTERVAL '1 hour' AS window_end,
           sum(temperature) * 1.0::DOUBLE / count(*) AS avg_temperature
    FROM readings GROUP BY ALL)"""

_RELATION = _AVERAGES + """,
relation AS (
    SELECT i.room_id, i.avg_temperature AS avg_in, o.avg_temperature AS avg_out,
           i.avg_temperature / nullif(o.avg_temperature, 0) AS relation, i.window_end
    FROM averages i JOIN averages o USING (room_id, window_start)
    WHERE i.source = 'IN' AND o.source = 'OUT')"""

_POINTS = _RELATION + """,
rooms_avg AS (
    SELECT 'rooms_avg' AS measurement, window_end AS time, room_id AS room, relation AS value FROM relation),
rooms_temperatures AS (
    SELECT 'rooms_temperatures' AS measurement, window_end AS time, room_id AS room, source,
           avg_temperature AS value FROM averages)"""

_MESSAGES = """
messages AS (
    SELECT role AS sender, CASE WHEN role = 'user' THEN 'assistant' ELSE 'user' END AS recipient,
           conv_id * 60000 + turn * 1000 AS sentAt, text AS message,
           TIMESTAMP '1970-01-01' + to_milliseconds(conv_id * 60000 + turn * 1000) AS ts,
           conv_id * 1000 + turn AS event_id
    FROM conversations)"""

_WIRE = _READINGS + """,
wire AS (
    SELECT event_id, '{"roomId":"' || room_id || '_' || source || '"}' AS key,
           '{"value":' || temperature || ',"timestamp":' || (epoch_us(ts) // 1000) || '}' AS value
    FROM readings)"""


def _warnings(mean: str = "CAST((prev_temperature + temperature) // 2 AS DOUBLE)") -> str:
    return _READINGS + f""",
pairs AS (
    SELECT *, lag(ts) OVER w AS prev_ts, lag(temperature) OVER w AS prev_temperature
    FROM readings WINDOW w AS (PARTITION BY room_id, source ORDER BY ts, event_id)),
warned AS (
    SELECT room_id, source, ts, event_id, {mean} AS avg_temperature, prev_ts
    FROM pairs
    WHERE temperature >= 30 AND prev_temperature >= 30 AND ts - prev_ts < INTERVAL '1 hour')"""


def _alerts(keys: str = "source", warned: str = "warned") -> str:
    return f""",
warning_pairs AS (
    SELECT *, lag(ts) OVER w AS before_ts, lag(room_id) OVER w AS before_room,
           lag(avg_temperature) OVER w AS before_avg
    FROM {warned} WINDOW w AS (PARTITION BY {keys} ORDER BY ts, event_id)),
alerted AS (
    SELECT before_room AS room_id, source, ts, event_id, avg_temperature AS alerted_temperature, before_ts
    FROM warning_pairs
    WHERE before_avg < avg_temperature AND ts - before_ts < INTERVAL '2 hours')"""


_ALERT = "SELECT room_id, source, ts, event_id, alerted_temperature FROM alerted"


def _tokens(text: str, separator: str) -> str:
    kept = f"rtrim({text}, '{separator}')"
    return (
        f"CASE WHEN {text} = '' THEN [''] WHEN {kept} = '' THEN CAST([] AS VARCHAR[]) "
        f"ELSE string_split({kept}, '{separator}') END"
    )


def _parts(table: str, bucket: str, width: str, value: str, separator: str, keys: str = "", extra: str = "") -> str:
    """Ordered texts of windows in parts of 100 rows."""
    by = f"{keys}, " if keys else ""
    return f"""
SELECT {by}window_start, window_start + INTERVAL '{width}' AS window_end, part, {extra}
       count(*) AS n, string_agg({value}, '{separator}' ORDER BY ts, event_id) AS text
FROM (SELECT *, (row_number() OVER (PARTITION BY {by}{bucket} ORDER BY ts, event_id) - 1) // 100 AS part,
             {bucket} AS window_start FROM {table})
GROUP BY {by}window_start, part"""


_INT_VALUES = """
SELECT {keys}, window_start, window_start + INTERVAL '{width}' AS window_end, part,
       CAST(any_value(total) AS BIGINT) // any_value(rows) AS avg_temperature,
       string_agg(CAST(temperature AS VARCHAR), ', ' ORDER BY ts, event_id) || ', ' AS "values"
FROM (SELECT *, (row_number() OVER (PARTITION BY {keys}, {bucket} ORDER BY ts, event_id) - 1) // 100 AS part,
             sum(temperature) OVER (PARTITION BY {keys}, {bucket}) AS total,
             count(*) OVER (PARTITION BY {keys}, {bucket}) AS rows, {bucket} AS window_start
      FROM {table})
GROUP BY {keys}, window_start, part"""

_LEN_CONCAT = _parts(
    "(SELECT * FROM events WHERE props IS NOT NULL AND props <> '')", _DAY, "1 day",
    "CAST(length(props) AS VARCHAR)", "", "event_type",
)

# The watermark when a stream has used all its input: the newest time, cut to
# milliseconds, less the delay.
_CLOSED = "(SELECT epoch_us(max(ts)) // 1000 * 1000 - 3000000 FROM events)"
_HOUR_US, _SLICE_US = 3_600_000_000, 6 * 3_600_000_000


def _emitted(ts: str, before: str, within_us: int, watermark: str) -> str:
    """Whether a stream has given out a pair: its slice, or the chain of its slices, is closed."""
    step = within_us + _SLICE_US
    end = f"(epoch_us({ts}) // {_SLICE_US} + 1) * {_SLICE_US}"
    return f"""
CASE WHEN epoch_us({ts}) // {_SLICE_US} = epoch_us({before}) // {_SLICE_US} THEN {end} <= {watermark}
     ELSE (({end} - 1) // {step} + 1) * {step} <= {watermark} END"""


_STREAM_WARNED = _warnings() + f""",
emitted AS (SELECT * FROM warned WHERE {_emitted('ts', 'prev_ts', _HOUR_US, _CLOSED)})"""
_ALERT_DELAY = _HOUR_US + 2 * _SLICE_US
_ALERTS_CLOSED = f"(SELECT epoch_us(max(ts)) // 1000 * 1000 - {_ALERT_DELAY} FROM emitted)"

_HISTOGRAM = """
    count(*) AS "count", min(temperature) AS min, max(temperature) AS max,
    sum(temperature)::DOUBLE / count(*) AS mean, round(stddev_samp(temperature), 6) AS stddev,
    round(quantile_cont(temperature, 0.5), 6) AS p50, round(quantile_cont(temperature, 0.75), 6) AS p75,
    round(quantile_cont(temperature, 0.95), 6) AS p95, round(quantile_cont(temperature, 0.98), 6) AS p98,
    round(quantile_cont(temperature, 0.99), 6) AS p99, round(quantile_cont(temperature, 0.999), 6) AS p99_9"""

_WINDOW_POINTS = """
    SELECT measurement, time, room, source, value FROM rooms_temperatures
    UNION ALL
    SELECT measurement, time, room, NULL AS source, value FROM rooms_avg WHERE value IS NOT NULL"""


def _latest(source: str) -> str:
    return f"""
WITH {_POINTS},
side AS (SELECT * FROM rooms_temperatures WHERE source = '{source}')
SELECT room, max(time) AS time, arg_max(value, time) AS value
FROM side WHERE time > (SELECT max(time) FROM side) - INTERVAL '3 hours' GROUP BY room"""


_LAGS = "WINDOW w AS (PARTITION BY room_id, source ORDER BY ts, event_id)"

_ARRIVALS = _READINGS + """,
arrived AS (
    SELECT room_id, source, temperature, event_id, make_timestamp(epoch_us(ts) // 60) AS ts,
           make_timestamp(epoch_us(ts) // 60 + event_id * 7919 % 10000 * 1000) AS arrival
    FROM readings),
met AS (
    SELECT *, time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS window_end,
           max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
    FROM arrived)"""


def _late(delay: str) -> str:
    return f"""
WITH {_ARRIVALS}
SELECT event_id, ts, arrival, newest - INTERVAL '{delay}' AS watermark, window_end FROM met
WHERE newest - INTERVAL '{delay}' >= window_end - INTERVAL '1 millisecond'"""


_TRIPLES = f"""
WITH {_READINGS},
lags AS (
    SELECT room_id, source, lag(event_id, 2) OVER w AS low_event_id, lag(temperature, 2) OVER w AS low_temperature,
           lag(event_id) OVER w AS middle_event_id, lag(temperature) OVER w AS middle_temperature,
           event_id AS high_event_id, temperature AS high_temperature, ts - lag(ts, 2) OVER w AS took,
           (epoch_us(ts) // {_SLICE_US} + 1) * {_SLICE_US} <= {_CLOSED} AS closed
    FROM readings {_LAGS}),
triples AS (
    SELECT * FROM lags
    WHERE low_temperature < middle_temperature AND middle_temperature < high_temperature
      AND high_temperature > low_temperature + middle_temperature AND took < INTERVAL '12 hours')"""

# Every row that is not refused, with the count and sum of its window so far and whether it fires a result.
_FIRED = _ARRIVALS + """,
counted AS (
    SELECT *, newest IS NOT NULL AND newest - INTERVAL '1 millisecond' >= window_end - INTERVAL '1 millisecond' AS late
    FROM met WHERE NOT coalesce(newest - INTERVAL '1 millisecond' >= window_end + INTERVAL '2499 milliseconds', false)),
sums AS (
    SELECT *, count(*) OVER w AS n, sum(temperature) OVER w AS total,
           count(*) FILTER (NOT late) OVER (PARTITION BY room_id, source, window_end) AS punctual,
           row_number() OVER (PARTITION BY room_id, source, window_end ORDER BY late, arrival, event_id) AS place
    FROM counted WINDOW w AS (PARTITION BY room_id, source, window_end ORDER BY late, arrival, event_id)),
fired AS (
    SELECT *, place - greatest(punctual, 1) AS version FROM sums WHERE place >= greatest(punctual, 1)),
log AS (
    SELECT room_id, source, window_end, version, '+' AS op, n, total FROM fired
    UNION ALL
    SELECT room_id, source, window_end, version - 1, '-', n - 1, total - temperature FROM fired WHERE version > 0)"""


def oracle_sql() -> dict[str, str]:
    return {
        # Sources, decoding and encoding
        "wire_records": f"WITH {_WIRE} SELECT event_id, key, value FROM wire",
        "readings_roundtrip": f"""
WITH {_READINGS} SELECT room_id, source, date_trunc('milliseconds', ts) AS ts, temperature, event_id FROM readings""",
        "dead_letters": """
SELECT '{"roomId":"1_IN"}' AS key, props AS value, 'no timestamp' AS error FROM events
UNION ALL
SELECT '{"roomId":"' || role || '"}' AS key, text AS value, 'no source' AS error FROM conversations
UNION ALL
SELECT '{"roomId":"1_IN"}' AS key, '{"value":5,"timestamp":-92233720368547' || lpad(event_id::VARCHAR, 5, '0') || '}' AS value,
    'no timestamp' AS error FROM events
UNION ALL
SELECT '{"roomId":"' || lpad(event_id::VARCHAR, 5, '0') || '_XX"}' AS key, '{"value":5,"timestamp":1}' AS value,
    'unknown source' AS error FROM events""",
        "raw_records": 'SELECT event_type AS key, props AS value, ts AS "timestamp" FROM events',
        "messages_roundtrip": f"WITH {_MESSAGES} SELECT event_id, sender, recipient, sentAt, message FROM messages",
        "topic_rows": f"""
SELECT CAST(window_start AS VARCHAR) || '|' || event_type || '|' || part AS key, text AS value
FROM ({_LEN_CONCAT})""",
        # Filters, projections, tokens
        "readings_in": f"WITH {_READINGS} SELECT * FROM readings WHERE source = 'IN'",
        "readings_out": f"WITH {_READINGS} SELECT * FROM readings WHERE source = 'OUT'",
        "hot_readings": f"WITH {_NAMED} SELECT * FROM named WHERE temperature >= 25",
        "non_empty_messages": f"""
WITH {_MESSAGES} SELECT event_id, message FROM messages WHERE message IS NOT NULL AND message <> ''""",
        "hot_ids": f"WITH {_NAMED} SELECT id FROM named WHERE temperature >= 25",
        "hot_ids_split": f"""
WITH {_NAMED} SELECT unnest({_tokens('id', '_')}) AS token FROM named WHERE temperature >= 25""",
        "words_with_one": f"""
SELECT word, CAST(1 AS INTEGER) AS one FROM (SELECT unnest({_tokens('text', ' ')}) AS word FROM documents)""",
        "upper_type": "SELECT event_id, upper(event_type) AS event_type FROM events",
        "split_compound_id": f"""
WITH {_NAMED},
averages AS ({_INT_VALUES.format(keys='id', width='1 hour', bucket=_HOUR, table='named')})
SELECT window_start, window_end, part, avg_temperature, "values",
       split_part(id, '_', 1) || '_' || split_part(id, '_', 2) AS room, split_part(id, '_', 3) AS source
FROM averages""",
        "room_partitions": f"""
WITH {_READINGS} SELECT event_id, CAST(room_id AS INTEGER) % 3 AS partition FROM readings""",
        "message_lengths": f"WITH {_MESSAGES} SELECT event_id, CAST(length(message) AS VARCHAR) AS length FROM messages",
        # Windows and aggregates
        "window_avg_in": f"""
WITH {_AVERAGES} SELECT room_id, avg_temperature, window_start, window_end FROM averages WHERE source = 'IN'""",
        "window_avg_out": f"""
WITH {_AVERAGES} SELECT room_id, avg_temperature, window_start, window_end FROM averages WHERE source = 'OUT'""",
        "int_avg_values": f"""
WITH {_READINGS} {_INT_VALUES.format(keys='room_id, source', width='1 day', bucket=_DAY, table='readings')}""",
        "int_avg": f"""
WITH {_READINGS}
SELECT room_id, source, CAST(sum(temperature) AS BIGINT) // count(*) AS avg_temperature,
       {_HOUR} AS window_start, {_HOUR} + INTERVAL '1 hour' AS window_end
FROM readings GROUP BY ALL""",
        "window_sum_keyed": f"""
WITH {_NAMED}
SELECT id, {_HOUR} AS window_start, {_HOUR} + INTERVAL '1 hour' AS window_end,
       CAST(sum(temperature) AS BIGINT) AS total
FROM named GROUP BY ALL""",
        "window_first_sum": f"""
WITH {_READINGS}
SELECT {_HOUR} AS window_start, {_HOUR} + INTERVAL '1 hour' AS window_end,
       arg_min(room_id, row(ts, event_id)) AS room_id, arg_min(source, row(ts, event_id)) AS source,
       CAST(sum(temperature) AS BIGINT) AS total
FROM readings GROUP BY {_HOUR}""",
        "window_concat": _parts(
            f"(SELECT *, first_value(event_type) OVER (PARTITION BY {_DAY} ORDER BY ts, event_id) AS first_type FROM events)",
            _DAY, "1 day", "props", "", extra="any_value(first_type) AS event_type,",
        ),
        "window_concat_values": _parts("events", _HOUR, "1 hour", "event_type", ""),
        "window_len_concat": _LEN_CONCAT,
        "backup_messages": "SELECT window_start, window_end, part, n, '{\"inputMessages\":[' || text || ']}' AS value FROM ("
        + _parts(
            "events", _DAY, "1 day",
            """'{"sender":"' || user_id || '","recipient":"' || event_type || '","sentAt":' || (epoch_us(ts) // 1000)
               || ',"message":"event ' || event_id || '"}'""",
            ",",
        ) + ")",
        "window_max_by": f"""
WITH {_MESSAGES}
SELECT * EXCLUDE (rank) FROM (
    SELECT {_MINUTES} AS window_start, {_MINUTES} + INTERVAL '5 minutes' AS window_end, messages.*,
           row_number() OVER (PARTITION BY {_MINUTES} ORDER BY sentAt DESC, event_id) AS rank
    FROM messages) WHERE rank = 1""",
        # Relation of IN and OUT
        "in_out_relation": f"WITH {_RELATION} SELECT room_id, relation, window_end FROM relation",
        "in_out_relation_join": f"WITH {_RELATION} SELECT room_id, relation, window_end FROM relation",
        "in_out_relation_ieee": f"""
WITH {_RELATION}
SELECT room_id, window_end,
       CASE WHEN avg_out <> 0 THEN 'finite' WHEN avg_in > 0 THEN 'inf' WHEN avg_in < 0 THEN '-inf' ELSE 'nan' END AS kind,
       relation
FROM relation""",
        "int_relation": f"""
WITH {_READINGS},
means AS (
    SELECT room_id, source, {_HOUR} AS window_start, CAST(sum(temperature) AS BIGINT) // count(*) AS mean
    FROM readings GROUP BY ALL)
SELECT i.room_id, CAST(i.mean AS DOUBLE) / nullif(CAST(o.mean AS DOUBLE), 0) AS relation,
       i.window_start + INTERVAL '1 hour' AS window_end, true AS text_is_same
FROM means i JOIN means o USING (room_id, window_start) WHERE i.source = 'IN' AND o.source = 'OUT'""",
        "main_job_points": f"WITH {_POINTS} {_WINDOW_POINTS}",
        # Patterns
        "warnings_in": f"WITH {_warnings()} SELECT * EXCLUDE (prev_ts) FROM warned WHERE source = 'IN'",
        "warnings_out": f"WITH {_warnings()} SELECT * EXCLUDE (prev_ts) FROM warned WHERE source = 'OUT'",
        "warnings_exact": f"""
WITH {_warnings('(prev_temperature + temperature) / 2.0::DOUBLE')} SELECT * EXCLUDE (prev_ts) FROM warned""",
        "alerts_in_global": f"WITH {_warnings()}{_alerts()} {_ALERT} WHERE source = 'IN'",
        "alerts_out_global": f"WITH {_warnings()}{_alerts()} {_ALERT} WHERE source = 'OUT'",
        "alerts_by_room": f"WITH {_warnings()}{_alerts('room_id, source')} {_ALERT}",
        "alerts_compat_out": f"""
WITH {_warnings()}{_alerts()}
SELECT room_id, 'OUT' AS source, ts, event_id, alerted_temperature FROM alerted WHERE source = 'IN'""",
        "alert_count": f"WITH {_warnings()}{_alerts()} SELECT source, count(*) AS alerts FROM alerted GROUP BY source",
        "alert_counter_series": f"""
WITH {_warnings()}{_alerts()}
SELECT source, {_HOUR} AS time, count(*) AS alerts,
       CAST(sum(count(*)) OVER (PARTITION BY source ORDER BY {_HOUR}) AS BIGINT) AS alerts_so_far
FROM alerted GROUP BY source, {_HOUR}""",
        # Running aggregates
        "running_mean": f"""
WITH {_READINGS}
SELECT room_id, source, ts, event_id, count(*) OVER w AS "count", CAST(sum(temperature) OVER w AS BIGINT) AS total,
       CAST(sum(temperature) OVER w AS BIGINT) // (count(*) OVER w) AS mean
FROM readings WINDOW w AS (PARTITION BY room_id, source ORDER BY ts, event_id)""",
        "mean_per_key": f"""
WITH {_READINGS}
SELECT room_id, source, count(*) AS "count", CAST(sum(temperature) AS BIGINT) AS total,
       CAST(sum(temperature) AS BIGINT) // count(*) AS mean
FROM readings GROUP BY room_id, source""",
        "word_count": f"""
SELECT word, count(*) AS "count" FROM (SELECT unnest({_tokens('text', ' ')}) AS word FROM documents) GROUP BY word""",
        "running_word_count": f"""
WITH split AS (SELECT conv_id, turn, {_tokens('text', ' ')} AS list FROM conversations),
words AS (SELECT conv_id, turn, unnest(list) AS word, unnest(range(len(list))) AS position FROM split)
SELECT conv_id, turn, CAST(position AS INTEGER) AS position, word,
       count(*) OVER (PARTITION BY word ORDER BY conv_id, turn, position) AS "count"
FROM words""",
        "running_sum": f"""
WITH {_READINGS}
SELECT room_id, temperature, ts, event_id,
       CAST(sum(temperature) OVER (PARTITION BY room_id ORDER BY ts, event_id) AS BIGINT) AS sum_temperature
FROM readings""",
        # Points and dashboard
        "points_rooms_avg": f"WITH {_POINTS} SELECT * FROM rooms_avg",
        "points_rooms_temperatures": f"WITH {_POINTS} SELECT * FROM rooms_temperatures",
        "points_new_rooms": f"""
WITH {_READINGS}
SELECT 'newrooms' AS measurement, ts AS time, room_id AS room, source, temperature AS temp FROM readings""",
        "line_protocol": f"""
WITH {_POINTS}
SELECT measurement || ',room=' || room || ',source=' || source || ' value=' || value || ' ' || epoch_us(time) * 1000 AS line
FROM rooms_temperatures""",
        "line_protocol_ratios": f"""
WITH {_POINTS}
SELECT measurement || ',room=' || room || ' value=' || value || ' ' || epoch_us(time) * 1000 AS line FROM rooms_avg
WHERE value IS NOT NULL""",
        "sum_by_position": f"""
WITH {_READINGS}
SELECT room_id, {_HOUR} AS window_start, {_HOUR} + INTERVAL '1 hour' AS window_end, CAST(sum(temperature) AS BIGINT) AS total
FROM readings GROUP BY ALL""",
        "rebalanced_counts": f"WITH {_READINGS} SELECT room_id, source, count(*) AS count FROM readings GROUP BY ALL",
        "line_protocol_readings": f"""
WITH {_READINGS}
SELECT 'newrooms,room=' || room_id || ',source=' || source || ' temp=' || temperature || 'i ' || epoch_us(ts) * 1000 AS line
FROM readings""",
        "ratio_series": f"""
WITH {_POINTS}
SELECT room, time, value FROM rooms_avg WHERE time >= (SELECT max(time) FROM rooms_avg) - INTERVAL '7 days'""",
        "ratio_grid_cells": f"""
WITH {_POINTS}
SELECT room, time, value,
       CASE WHEN value IS NOT NULL THEN sqrt(greatest(0.0::DOUBLE, least(2.0::DOUBLE, value)) / 2) END AS strength
FROM rooms_avg""",
        "latest_in": _latest("IN"),
        "latest_out": _latest("OUT"),
        "threshold_bands": f"""
WITH {_POINTS}
SELECT time, room, source, value,
       CASE WHEN value < 20 THEN 'green' WHEN value < 30 THEN '#EAB839' ELSE 'red' END AS band,
       greatest(0.0::DOUBLE, least(40.0::DOUBLE, value)) / 40 AS filled
FROM rooms_temperatures""",
        "series_reduced": f"""
WITH {_POINTS}
SELECT room, source, round(avg(value), 6) AS mean, arg_max(value, time) AS last
FROM rooms_temperatures GROUP BY room, source""",
        # Measurements
        "event_counter": "SELECT count(*) AS events FROM events",
        "throughput": f"""
SELECT {_HOUR} AS window_start, count(*) AS events, count(*) / 3600.0::DOUBLE AS per_second FROM events GROUP BY {_HOUR}""",
        "value_histogram": f"""
WITH {_READINGS} SELECT {_DAY} AS window_start, source, {_HISTOGRAM} FROM readings GROUP BY {_DAY}, source""",
        "recent_value_histogram": f"""
WITH {_READINGS} SELECT {_HISTOGRAM}
FROM (SELECT temperature FROM readings ORDER BY ts DESC, event_id DESC LIMIT 500)""",
        # Streams
        "stream_relation": f"""
WITH {_RELATION} SELECT room_id, relation, window_end FROM relation WHERE epoch_us(window_end) <= {_CLOSED}""",
        "stream_relation_join": f"""
WITH {_RELATION} SELECT room_id, relation, window_end FROM relation WHERE epoch_us(window_end) <= {_CLOSED}""",
        "stream_main_job_points": f"""
WITH {_POINTS} SELECT * FROM ({_WINDOW_POINTS}) WHERE epoch_us(time) <= {_CLOSED}""",
        "stream_warning_pairs": f"WITH {_STREAM_WARNED} SELECT * EXCLUDE (prev_ts) FROM emitted",
        "stream_alert_pairs": f"""
WITH {_STREAM_WARNED}{_alerts(warned='emitted')}
{_ALERT} WHERE {_emitted('ts', 'before_ts', 2 * _HOUR_US, _ALERTS_CLOSED)}""",
        "stream_mean_per_key": f"""
WITH {_READINGS}
SELECT room_id, source, count(*) AS "count", CAST(sum(temperature) AS BIGINT) AS total,
       CAST(sum(temperature) AS BIGINT) // count(*) AS mean
FROM readings GROUP BY room_id, source""",
        "stream_word_count": f"""
SELECT word, count(*) AS "count" FROM (SELECT unnest({_tokens('p_name', ' ')}) AS word FROM part) GROUP BY word""",
        # Patterns of any length
        "pattern_warnings": f"WITH {_warnings()} SELECT * EXCLUDE (prev_ts) FROM warned",
        "pattern_alerts": f"WITH {_warnings()}{_alerts()} {_ALERT}",
        "rising_triples": f"{_TRIPLES} SELECT * EXCLUDE (took, closed) FROM triples",
        "hot_streaks": f"""
WITH {_READINGS},
lags AS (
    SELECT room_id, source, event_id AS cool_id, temperature AS t, lag(temperature, 1) OVER w AS d, lag(temperature, 2) OVER w AS c,
           lag(temperature, 3) OVER w AS b, lag(temperature, 4) OVER w AS a, lag(event_id, 1) OVER w AS di,
           lag(event_id, 2) OVER w AS ci, lag(event_id, 3) OVER w AS bi, lag(event_id, 4) OVER w AS ai
    FROM readings {_LAGS})
SELECT room_id, source, '[' || ai || ',' || bi || ',' || ci || ',' || di || ']' AS hot_ids, a + b + c + d AS hot_total, cool_id
FROM lags WHERE least(a, b, c, d) >= 30 AND a IS NOT NULL AND a <> b AND b <> c AND c <> d AND t < 30""",
        "rising_runs": f"""
WITH {_READINGS},
marked AS (
    SELECT *, coalesce(lag(temperature) OVER w < temperature, false) AS goes_on FROM readings {_LAGS}),
numbered AS (
    SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER w AS run FROM marked {_LAGS})
SELECT room_id, source, min_by(event_id, ts) AS first_id, max_by(event_id, ts) AS last_id, count(*) AS n,
       sum(temperature)::BIGINT AS total
FROM numbered GROUP BY room_id, source, run HAVING count(*) >= 3""",
        # Late rows and corrections
        "late_rows_ascending": _late("1 millisecond"),
        "late_rows_bounded": _late("3 seconds"),
        "late_rows_punctuated": _late("1500 milliseconds"),
        "corrections": f"""
WITH {_FIRED}
SELECT room_id, source, window_end - INTERVAL '5 seconds' AS window_start, window_end, version, op, n, total::BIGINT AS total
FROM log""",
        "corrections_upserted": f"""
WITH {_FIRED}
SELECT room_id, source, window_end - INTERVAL '5 seconds' AS window_start, window_end,
       count(*) - greatest(count(*) FILTER (NOT late), 1) AS version, count(*) AS n, sum(temperature)::BIGINT AS total
FROM counted GROUP BY room_id, source, window_end""",
        "corrections_summed": f"""
WITH {_FIRED} SELECT room_id, count(*) AS n, sum(temperature)::BIGINT AS total FROM counted GROUP BY room_id""",
        # Exactly once
        "committed_points": f"WITH {_POINTS} SELECT * FROM rooms_temperatures",
        # Meters, distributions and latest values on large data
        "sliding_throughput": f"""
WITH {_ARRIVALS},
panes AS (SELECT source, epoch_us(ts) // 1000000 AS pane, count(*) AS n FROM arrived GROUP BY 1, 2),
steps AS (SELECT source, pane AS step FROM panes UNION SELECT source, pane + 5 FROM panes)
SELECT source, make_timestamp((step + 1) * 1000000) AS time, coalesce(sum(n), 0)::BIGINT AS events,
       coalesce(sum(n), 0)::BIGINT / 5.0::DOUBLE AS per_second
FROM steps LEFT JOIN panes USING (source) WHERE panes.pane BETWEEN step - 4 AND step OR panes.pane IS NULL
GROUP BY source, step
UNION ALL
SELECT source, make_timestamp((step + 1) * 1000000), 0, 0.0 FROM steps
WHERE NOT EXISTS (FROM panes WHERE panes.source = steps.source AND panes.pane BETWEEN step - 4 AND step)""",
        "counter_with_restarts": f"""
WITH {_READINGS},
scraped AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts, event_id) % 97 AS value FROM readings),
pairs AS (
    SELECT *, lag(value) OVER (PARTITION BY source ORDER BY ts, event_id) AS before FROM scraped),
increases AS (
    SELECT *, CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END AS increase FROM pairs)
SELECT source, {_HOUR} AS window_start, sum(increase)::BIGINT AS increase, count(*) FILTER (value < before) AS restarts,
       sum(increase)::BIGINT / 3600.0::DOUBLE AS per_second
FROM increases GROUP BY source, {_HOUR}""",
        "sketched_quantiles": f"""
WITH {_READINGS}
SELECT room_id, unnest(['p50', 'p75', 'p95', 'p98', 'p99', 'p99_9']) AS quantile, count(*) AS n, min(temperature)::BIGINT AS min,
       max(temperature)::BIGINT AS max, true AS within_error
FROM readings GROUP BY room_id""",
        "recent_per_room": f"""
WITH {_READINGS}
SELECT room_id, source, count(*) AS n, min(temperature) AS min, max(temperature) AS max, sum(temperature)::BIGINT AS total,
       min(event_id) AS first_id
FROM (SELECT *, row_number() OVER (PARTITION BY room_id, source ORDER BY ts DESC, event_id DESC) AS place FROM readings)
WHERE place <= 100 GROUP BY room_id, source""",
        "latest_table": f"""
WITH {_POINTS}
SELECT room, source, max(time) AS time, max_by(value, time) AS value FROM rooms_temperatures
WHERE time > (SELECT max(time) FROM rooms_temperatures) - INTERVAL '3 hours' GROUP BY room, source""",
        "bucketed_relation": f"WITH {_RELATION} SELECT room_id, relation, window_end FROM relation",
        "stream_texts": f"""
WITH {_READINGS}
SELECT * FROM ({_parts('readings', _DAY, '1 day', 'CAST(temperature AS VARCHAR)', ' ', 'source')})
WHERE epoch_us(window_end) <= {_CLOSED}""",
        "stream_rising_triples": f"{_TRIPLES} SELECT * EXCLUDE (took, closed) FROM triples WHERE closed",
    }
