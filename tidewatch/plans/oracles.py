"""The registered queries as SQL over the same tables, for an independent engine."""

from __future__ import annotations

_ORDERS = """
    SELECT CAST(l_orderkey AS VARCHAR) AS key,
           '{"orderId":' || l_orderkey || ',"product":"' || p_type || '","quantity":'
             || CAST(l_quantity AS INTEGER) || ',"price":' || l_extendedprice || '}' AS value,
           CAST(l_orderkey AS INTEGER) AS "orderId", p_type AS product,
           CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS price,
           l_orderkey % 4 AS part, l_shipdate AS ts
    FROM lineitem JOIN part ON l_partkey = p_partkey
"""

_TEXT = "rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0')"
_TEXT = f"({_TEXT} || CASE WHEN ends_with({_TEXT}, '.') THEN '0' ELSE '' END)"

_ISO = """
    strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE
      WHEN epoch_us(ts) % 1000000 = 0 THEN ''
      WHEN epoch_us(ts) % 1000 = 0 THEN '.' || strftime(ts, '%g')
      ELSE '.' || strftime(ts, '%f') END || 'Z'
"""

_ALERTS = f"""
    SELECT *, 'This is a ' || level || ' alert' AS mesg, {_TEXT} AS ts_text, {_ISO} AS ts_iso
    FROM (SELECT event_id, ts, CAST(100 * (1 + event_id % 4) AS VARCHAR) AS code,
                 CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'HIGH'
                                 ELSE 'ELEVATED' END AS level
          FROM events)
"""

_VIEWS = f"""
    SELECT event_id, ts, 'user-' || user_id AS "user", event_type AS view_topic,
           CAST(1 + event_id % 10 AS INTEGER) AS minutes, {_TEXT} AS ts_text, {_ISO} AS ts_iso
    FROM events
"""

_SHIFTED = """
    SELECT event_id, 'user-' || user_id AS "user", 1 + event_id % 10 AS minutes,
           user_id % 4 AS part, ts - to_hours(CAST((event_id * 7) % 13 AS INTEGER)) AS ts
    FROM events
"""

# A record is late if its 6-hour window ends no later than the newest time so far.
_STRICT = f"""
    SELECT *, b + 21600000000 > max(epoch_us(ts)) OVER (
               PARTITION BY part ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS accepted
    FROM (SELECT *, epoch_us(ts) // 21600000000 * 21600000000 AS b FROM ({_SHIFTED}))
"""


def _start(micros: str) -> str:
    return f"strftime(make_timestamp({micros}), '%Y-%m-%dT%H:%M:%SZ')"


def _windowed(rows: str, seconds: int, key: str, agg: str, grace: int = 0) -> str:
    """Closed windows ``b, key, agg`` of ``rows`` with column ``ts``."""
    size = seconds * 1_000_000
    return f"""
        SELECT * FROM (
          SELECT epoch_us(ts) // {size} * {size} AS b, {key}, {agg} FROM ({rows}) GROUP BY 1, 2)
        WHERE b + {size} + {grace * 1_000_000} <= (SELECT max(epoch_us(ts)) FROM ({rows}))
    """


def _high_volume(seconds: int, threshold: int) -> str:
    size_ms = seconds * 1000
    counts = _windowed(_ALERTS, seconds, "code", "count(*) AS n")
    return f"""
        SELECT '[' || code || '@' || b // 1000 || '/' || (b // 1000 + {size_ms}) || ']' AS key,
               '"' || {_start("b")} || '","' || code || '","' || n || '"' AS value
        FROM ({counts}) WHERE n > {threshold}
    """


# Windows are final once all topic partitions have passed their end.
_LOW_WATER = "(SELECT min(t) FROM (SELECT max(epoch_us(ts)) AS t FROM events GROUP BY user_id % 4))"

_FAN_OUT = """
    SELECT 'streaming.alerts.critical' AS topic, key, value FROM ({critical})
    UNION ALL
    SELECT 'streaming.alerts.highvolume', '[' || code || '@' || b // 1000 || '/' || (b // 1000 + 3600000) || ']',
           '"' || {start} || '","' || code || '","' || n || '"'
    FROM (SELECT epoch_us(ts) // 3600000000 * 3600000000 AS b, code, count(*) AS n FROM ({alerts}) GROUP BY 1, 2)
    WHERE b + 3600000000 <= {low_water}
"""


def _user_minutes(seconds: int, grace: int = 0) -> str:
    totals = _windowed(_VIEWS, seconds, '"user"', "CAST(sum(minutes) AS BIGINT) AS m", grace)
    return f"""
        SELECT {_start("b")} AS interval_timestamp, "user", m AS total_minutes FROM ({totals})
    """


_ORDER_SUMMARY = f"""
    SELECT {_start("b")} AS interval_timestamp, product, round(t, 2) AS total_value
    FROM ({_windowed(_ORDERS, 5, "product", "sum(price * quantity) AS t")})
"""

_CRITICAL = f"""
    SELECT CAST(event_id AS VARCHAR) AS key,
           '"' || ts_text || '","' || code || '","' || mesg || '"' AS value
    FROM ({_ALERTS}) WHERE level = 'CRITICAL'
"""


def _board(member: str, score: str) -> str:
    return f"""
        SELECT row_number() OVER (ORDER BY score DESC, member DESC) AS position, member, score
        FROM (SELECT {member} AS member, CAST({score} AS DOUBLE) AS score FROM events GROUP BY 1)
    """


_PLAYERS = _board("'user-' || user_id", "sum(1 + event_id % 10)")
_TOPICS = _board("event_type", "count(*)")

_LATE = f"""
    SELECT part AS partition, count(*) AS n, count(*) FILTER (NOT accepted) AS dropped
    FROM ({_STRICT}) GROUP BY part
"""

_STRICT_MINUTES = f"""
    SELECT {_start("b")} AS interval_timestamp, "user", count(*) AS n,
           CAST(sum(minutes) AS BIGINT) AS total_minutes
    FROM ({_STRICT}) WHERE accepted
    GROUP BY b, "user"
    HAVING b + 21600000000 <= (SELECT max(epoch_us(ts)) FROM ({_SHIFTED}))
"""


def _labels(table: str, key: str) -> str:
    return rf"""
        WITH sentences AS (
          SELECT {key} AS key, list_filter(
                   list_transform(string_split_regex(text, '[.!?]+'),
                                  lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')),
                   lambda s: s <> '') AS s, text IS NULL AS missing
          FROM {table}),
        words AS (
          SELECT key, missing, string_split_regex(lower(s[-1]), '[^a-z]+') AS w FROM sentences),
        sums AS (
          SELECT key, missing,
                 coalesce(len(list_filter(w, lambda x: x IN ('the', 'is', 'it'))), 0)
               - coalesce(len(list_filter(w, lambda x: x IN ('of', 'to', 'a'))), 0) AS total
          FROM words)
        SELECT key, CASE WHEN missing THEN 'Error' WHEN total <= -2 THEN 'Very Negative'
                         WHEN total = -1 THEN 'Negative' WHEN total = 0 THEN 'Neutral'
                         WHEN total = 1 THEN 'Positive' ELSE 'Very Positive' END AS label
        FROM sums
    """


_TOTAL_MINUTES = """
    SELECT 'user-' || user_id AS "user", CAST(sum(1 + event_id % 10) AS BIGINT) AS total_minutes
    FROM events GROUP BY 1
"""

_DOCUMENT_LABELS = _labels("documents", "CAST(doc_id AS VARCHAR)")

ORACLE_SQL: dict[str, str] = {
    "order_encode": f"SELECT key, value FROM ({_ORDERS})",
    "order_decode": f'SELECT "orderId", product, quantity, price FROM ({_ORDERS})',
    "order_dead_letters": """
        SELECT CAST(l_orderkey AS VARCHAR) AS key, 'broken ' || l_orderkey AS value,
               'not a JSON object' AS reason
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey % 97 = 0""",
    "order_offsets": f"""
        SELECT CAST(part AS INTEGER) AS partition,
               row_number() OVER (PARTITION BY part ORDER BY ts, key, value) - 1 AS "offset",
               key, value
        FROM ({_ORDERS})""",
    "alert_encode": f"""
        SELECT CAST(event_id AS VARCHAR) AS key,
               '"' || ts_text || '","' || level || '","' || code || '","' || mesg || '"' AS value
        FROM ({_ALERTS})""",
    "alert_decode": f"SELECT ts_iso AS alert_ts, level, code, mesg FROM ({_ALERTS})",
    "view_encode": f"""
        SELECT CAST(event_id AS VARCHAR) AS key,
               '"' || ts_text || '","' || "user" || '","' || view_topic || '",' || minutes AS value
        FROM ({_VIEWS})""",
    "view_decode": f'SELECT ts_iso AS view_ts, "user", view_topic, minutes FROM ({_VIEWS})',
    "score_decode": """
        SELECT event_id AS "offset", 'user-' || user_id AS key,
               CAST(1 + event_id % 10 AS DOUBLE) AS score
        FROM events""",
    "publish_reviews": """
        SELECT CAST(doc_id AS VARCHAR) AS key, text AS value,
               'streaming.sentiment.input' AS topic, doc_id AS seconds
        FROM documents""",
    "text_lines": "SELECT unnest(string_split(text, chr(10))) AS line FROM documents",
    "order_window_summary": _ORDER_SUMMARY,
    "order_window_summary_batch": _ORDER_SUMMARY,
    "order_window_summary_batches": _ORDER_SUMMARY,
    "order_summary_report": f"""
        SELECT count(*) AS total_records, round(sum(t), 2) AS total_value
        FROM ({_windowed(_ORDERS, 5, "product", "sum(price * quantity) AS t")})""",
    "critical_alerts": _CRITICAL,
    "critical_alerts_batch": _CRITICAL,
    "high_volume_alerts_1h": _high_volume(3600, 2),
    "high_volume_alerts_1h_batch": _high_volume(3600, 2),
    "code_counts_1h": _high_volume(3600, 0),
    "high_volume_alerts_10s": _high_volume(10, 0),
    "user_minutes_1h": _user_minutes(3600),
    "user_minutes_1h_batch": _user_minutes(3600),
    "user_minutes_1h_grace": _user_minutes(3600, 7200),
    "user_minutes_5s": _user_minutes(5),
    "open_windows_state": f"""
        SELECT {_start("b")} AS interval_timestamp, "user",
               CAST(sum(minutes) AS BIGINT) AS total_minutes
        FROM (SELECT *, epoch_us(ts) // 86400000000 * 86400000000 AS b FROM ({_VIEWS}))
        WHERE b + 86400000000 > (SELECT max(epoch_us(ts)) FROM events)
        GROUP BY b, "user\"""",
    "late_rejects": _LATE,
    "late_rejects_batch": _LATE,
    "user_minutes_strict": _STRICT_MINUTES,
    "user_minutes_strict_batch": _STRICT_MINUTES,
    "user_minutes_strict_batches": _STRICT_MINUTES,
    "late_rejects_batches": _LATE,
    "append_sink_replay": _CRITICAL,
    "fan_out": _FAN_OUT.format(critical=_CRITICAL, start=_start("b"), alerts=_ALERTS, low_water=_LOW_WATER),
    "leaderboard": _PLAYERS,
    "leaderboard_batches": _PLAYERS,
    "periodic_board": _PLAYERS,
    "leaderboard_ranged": _PLAYERS,
    "leaderboard_top3": f"SELECT * FROM ({_PLAYERS}) WHERE position <= 3",
    "leaderboard_last3": f"""
        SELECT * FROM ({_PLAYERS})
        WHERE position > (SELECT count(DISTINCT user_id) FROM events) - 3""",
    "topic_leaderboard": _TOPICS,
    "topic_leaderboard_batch": _TOPICS,
    "sentiment_labels": _DOCUMENT_LABELS,
    "sentiment_labels_batch": _DOCUMENT_LABELS,
    "sentiment_labels_conversations": _labels("conversations", "conv_id || '/' || turn"),
    "remote_score": """
        SELECT CAST(doc_id AS VARCHAR) AS key,
               CASE WHEN text IS NULL THEN 'Error' ELSE
                 ['Very Negative', 'Negative', 'Neutral', 'Positive', 'Very Positive'][
                   length(text) % 5 + 1] END AS label
        FROM documents""",
    "sink_report": """
        SELECT count(*) AS total_records, round(coalesce(sum(o_totalprice), 0), 2) AS total_value
        FROM orders WHERE o_orderkey > 100""",
    "high_mark": "SELECT coalesce(max(o_orderkey), 0) AS latest_id FROM orders",
    "custom_agg": _TOTAL_MINUTES,
    "custom_agg_longest": """
        SELECT source, text AS longest FROM documents WHERE source IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY length(text) DESC NULLS LAST, text DESC) = 1""",
    "custom_agg_stream": _TOTAL_MINUTES,
}
