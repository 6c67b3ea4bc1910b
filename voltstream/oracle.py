"""The registered queries in SQL, for a second engine to run on the same tables.

Three patterns recur. A sum of readings is taken over decimals, so its value does
not hang on the order of rows. A mean is rounded from its shortest decimal text,
half up. A stream emits a window once its end is a minute behind the newest row;
later windows stay open.
"""

from __future__ import annotations

K = "CAST(props->>'$.k' AS INT)"
ALERTING = f"value > 100 AND {K} < 50"
EXACT_SUM = "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)"


def _round(expression: str, digits: int) -> str:
    text = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,20))"
    return f"CAST(round({text}, {digits}) AS DOUBLE)"


def _window(size: str) -> str:
    bucket = f"time_bucket(INTERVAL '{size}', ts)"
    return f"{bucket} AS window_start, {bucket} + INTERVAL '{size}' AS window_end"


def _alert_rows(extra: str = "") -> str:
    return f"""
        SELECT ts AS "timestamp", CAST(user_id AS INT) AS planta_id,
               CAST(value AS FLOAT) AS "Radiacion", CAST({K} AS FLOAT) AS "Potencia",
               'Sin Generacion' AS "Alerta"{extra}
        FROM events WHERE {ALERTING}"""


def _closed(condition: str) -> str:
    return f"""window_end <= (
        SELECT date_trunc('millisecond', max(ts)) - INTERVAL '1 minute'
        FROM events WHERE {condition})"""


CHARGE = f"""
    SELECT CAST(user_id AS VARCHAR) AS device_id, {_window('30 seconds')},
           {EXACT_SUM} AS charge_consumed
    FROM events GROUP BY ALL"""

PLANT_MEANS = f"""
    SELECT event_type AS planta_id, {_window('60 seconds')},
           {_round(f'{EXACT_SUM} / count(value)', 2)} AS "Potencia",
           {_round(f'CAST(sum({K}) AS DOUBLE) / count(*)', 2)} AS "Radiacion"
    FROM events GROUP BY ALL"""

TYPE_MEANS = f"""
    SELECT event_type, {_window('10 minutes')},
           {_round(f'{EXACT_SUM} / count(value)', 1)} AS mean_value
    FROM events GROUP BY ALL"""


def _feed(kind: str, mean: str, name: str) -> str:
    return f"""
        SELECT {_window('10 minutes')}, CAST({_round(mean, 1)} AS FLOAT) AS "{name}"
        FROM events WHERE event_type = '{kind}' GROUP BY ALL"""


def _joined(mean: str) -> str:
    return f"""
        SELECT e.window_start, e.window_end, "Radiacion", "PA"
        FROM ({_feed('click', mean, 'Radiacion')}) e
        INNER JOIN ({_feed('view', mean, 'PA')}) i ON e.window_start = i.window_start"""


JOINED = _joined(f"{EXACT_SUM} / count(value)")

# The sum of four doubles with each addition's exact error carried to the end.
STATS = """
    WITH readings AS (
        SELECT l_orderkey || '-' || l_linenumber AS device_id, l_quantity AS a,
               l_extendedprice AS b, l_discount AS c, l_tax AS d
        FROM lineitem),
    s1 AS (SELECT *, a + b AS ab FROM readings),
    s2 AS (SELECT *, ab + c AS abc, ab - a AS b1 FROM s1),
    s3 AS (SELECT *, abc + d AS abcd, abc - ab AS c1,
                  (a - (ab - b1)) + (b - b1) AS e1 FROM s2),
    s4 AS (SELECT *, abcd - abc AS d1, (ab - (abc - c1)) + (c - c1) AS e2 FROM s3),
    s5 AS (SELECT *, (abc - (abcd - d1)) + (d - d1) AS e3 FROM s4),
    total AS (SELECT device_id, abcd + (e1 + e2 + e3) AS charge FROM s5)
    SELECT device_id, charge AS total_charge_consumed, charge / 4 AS avg_15
    FROM total"""

SLIDING = f"""
    SELECT event_type, window_start, window_start + INTERVAL '60 minutes' AS window_end,
           {_round(f'{EXACT_SUM} / count(value)', 1)} AS mean_value, count(*) AS n
    FROM (
        SELECT *, time_bucket(INTERVAL '10 minutes', ts) - unnest(range(6)) * INTERVAL '10 minutes' AS window_start
        FROM events)
    GROUP BY event_type, window_start"""

SESSIONS = f"""
    SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL '30 minutes' AS window_end,
           count(*) AS n, {EXACT_SUM} AS total
    FROM (
        SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit FROM (
            SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                + INTERVAL '30 minutes' THEN 0 ELSE 1 END AS begins FROM events))
    GROUP BY user_id, visit"""

ORACLE: dict[str, str] = {
    "q01_select_where_string": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ts, CAST(o_custkey AS VARCHAR) AS device,
               o_orderpriority AS temp
        FROM orders WHERE o_orderpriority >= '2'""",
    "q02_limit": "SELECT * FROM events ORDER BY event_id LIMIT 10",
    "q03_distinct": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS device FROM events",
    "q04_topk_string": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ts, CAST(o_custkey AS VARCHAR) AS device,
               o_orderpriority AS temp
        FROM orders WHERE o_orderpriority >= '20'
        ORDER BY temp DESC, ts, device LIMIT 20""",
    "q04_topk_string_sql": """
        SELECT CAST(value AS VARCHAR) AS temp FROM events
        WHERE CAST(value AS VARCHAR) >= '20' ORDER BY temp DESC LIMIT 20""",
    "q05_csv_roundtrip": "SELECT * FROM events",
    "q05_csv_text_roundtrip": r"""
        SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN '' WHEN 1 THEN NULL
            WHEN 2 THEN '  "\n\r' || text || '", ' ELSE text END AS text
        FROM documents""",
    "q06_alert_rows": _alert_rows(),
    "q07_alert_json": f"""
        SELECT CAST(event_id AS VARCHAR) AS message_id,
               CAST(user_id AS INT) AS planta_id, value AS "Radiacion",
               CAST({K} AS DOUBLE) AS "Potencia", 'Sin Generacion' AS alert,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS "timestamp"
        FROM events WHERE {ALERTING}""",
    "q08_raw_normalise": f"""
        SELECT CAST(event_id AS VARCHAR) AS message_id,
               CAST(user_id AS INT) AS planta_id,
               '{{"Radiacion":' || CAST(value AS VARCHAR)
                   || ',"Potencia":' || {K} || '.0}}' AS message,
               ts AS "timestamp"
        FROM events""",
    "q08_raw_rejects": f"""
        SELECT CASE WHEN event_id % 7 <> 0 THEN CAST(event_id AS VARCHAR) END AS message_id,
               event_id % 7 <> 0 AS accepted,
               CASE WHEN event_id % 7 = 0 THEN substr('{{"message_id":"' || event_id
                   || '","planta_id":' || CAST(user_id AS INT) || ',"message":{{"Radiacion":', 1, 40)
               END AS value
        FROM events""",
    "q08_bad_event_times": """
        SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END AS ts_ltz
        FROM events""",
    "q09_tumble60_keyed_avg": PLANT_MEANS,
    "q09_plant_json_means": PLANT_MEANS,
    "q10_tumble30_sum_sql": CHARGE,
    "q11_tumble30_sum_df": CHARGE,
    "q11_device_json_charge": CHARGE,
    "q12_window_join": JOINED,
    "q12_window_join_one_scan": JOINED,
    "q12_window_join_json_sql": _joined("avg(CAST(CAST(value AS FLOAT) AS DOUBLE))"),
    "q12_window_join_views": JOINED,
    "q13_row_function": STATS,
    "q13_row_function_batches": STATS,
    "q13_row_function_rows": STATS,
    "q13_user_function": f"""
        SELECT event_id, CAST(gcd(event_id, {K}) AS BIGINT) AS divisor
        FROM events WHERE gcd(event_id, {K}) > 1""",
    "q13_hourly_csv": STATS,
    "q14_tumble10_keyed_avg": TYPE_MEANS,
    "q14_stream_tumble": f"SELECT * FROM ({TYPE_MEANS}) WHERE {_closed('true')}",
    "q14_stream_tumble_batches": TYPE_MEANS,
    "q14_stream_tumble_flushed": TYPE_MEANS,
    "q15_stream_window_join_batches": JOINED,
    "q15_stream_window_join": f"""
        SELECT * FROM ({JOINED})
        WHERE {_closed("event_type = 'click'")} AND {_closed("event_type = 'view'")}""",
    "q15_stream_window_join_flushed": JOINED,
    "q16_stream_alerts": _alert_rows(),
    "q17_stream_fan_out": f"""
        {_alert_rows(", 'csv' AS sink")} UNION ALL {_alert_rows(", 'parquet' AS sink")}""",
    "q18_stream_clock_tumble": f"""
        SELECT event_type, {EXACT_SUM} AS total FROM events GROUP BY event_type""",
    "q19_stream_csv_filter": """
        SELECT CAST(event_id AS VARCHAR) AS ts, CAST(user_id AS VARCHAR) AS device,
               CAST(value AS VARCHAR) AS temp
        FROM events WHERE CAST(value AS VARCHAR) >= '20'""",
    "q20_kafka_record_roundtrip": f"SELECT device_id AS key, * FROM ({CHARGE})",
    "q21_csv_filter_job": """
        SELECT CAST(event_id AS VARCHAR) AS ts, CAST(user_id AS VARCHAR) AS device,
               CAST(value AS VARCHAR) AS temp
        FROM events WHERE CAST(value AS VARCHAR) >= '20'""",
    "q22_named_devices": "SELECT DISTINCT CAST(user_id AS VARCHAR) AS device FROM events",
    "q23_stream_dead_letters": f"""
        SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, count(*) AS n,
               {EXACT_SUM} AS total, NULL AS reason
        FROM events WHERE event_id % 5 <> 0 GROUP BY ALL
        UNION ALL
        SELECT NULL, count(*), NULL, CASE event_id % 10 WHEN 0 THEN 'not json' ELSE 'no event time' END AS reason
        FROM events WHERE event_id % 5 = 0 GROUP BY ALL""",
    "q24_stream_late_records": f"""
        WITH q AS (
            SELECT event_id, date_trunc('second', ts) AS ts,
                   [0, 3, 2, 1][CAST(floor(event_id / ((SELECT max(event_id) + 1 FROM events) / 4)) AS INT) + 1] AS batch
            FROM events),
        newest AS (
            SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
            FROM (SELECT * FROM q) GROUP BY batch),
        judged AS (
            SELECT event_id, time_bucket(INTERVAL '10 minutes', ts) AS window_start, coalesce(
                time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' <= newest - INTERVAL '1 minute', false) AS late
            FROM q JOIN newest USING (batch))
        SELECT window_start, count(*) AS n, NULL AS reason, NULL AS event_id
        FROM judged WHERE NOT late GROUP BY ALL
        UNION ALL
        SELECT NULL, NULL, 'late', event_id FROM judged WHERE late""",
    "q25_sliding_mean": SLIDING,
    "q25_stream_sliding_mean": SLIDING,
    "q26_sessions": SESSIONS,
    "q26_stream_sessions": SESSIONS,
}
