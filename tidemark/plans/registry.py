"""Named queries, each with the SQL that computes the same relation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql.strip()
        return run

    return add


# The feed derived in ``feeds.as_records``, as relations.
FEED_SQL = r"""
feed AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_id, event_type, value AS amount, props,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS change_ts,
         event_type = 'error' AND value < 10 AS truncated,
         event_type = 'view' AND value < 5 AS undated,
         event_type = 'click' AND value >= 100 AS mistyped,
         event_type = 'purchase' AND value >= 100 AS extended
  FROM events
),
message AS (
  SELECT *, '{"user_id":"' || user_id || '","event_type":"' || event_type || '","amount":'
         || CASE WHEN mistyped THEN '"n/a"' ELSE CAST(amount AS VARCHAR) END
         || ',"props":"' || replace(props, '"', '\"') || '"'
         || CASE WHEN undated THEN '' ELSE ',"change_ts":"' || change_ts || '"' END
         || ',"op":"' || op || '"' || CASE WHEN extended THEN ',"coupon":"yes"' ELSE '' END || '}' AS whole
  FROM feed
),
parsed AS (
  SELECT event_id, ts,
         CASE WHEN NOT truncated THEN user_id END AS user_id,
         CASE WHEN NOT truncated THEN event_type END AS event_type,
         CASE WHEN NOT truncated AND NOT mistyped THEN amount END AS amount,
         CASE WHEN NOT truncated THEN props END AS props,
         CASE WHEN NOT truncated AND NOT undated THEN change_ts END AS change_ts,
         CASE WHEN NOT truncated THEN op END AS op,
         CASE WHEN truncated OR undated THEN DATE '1900-01-01' ELSE CAST(ts AS DATE) END AS partition_date,
         CASE WHEN truncated THEN substr(whole, 1, length(whole) - 5) WHEN mistyped THEN whole END AS corrupt,
         extended AND NOT truncated AS extended
  FROM message
)
"""

# The clean typed feed of ``feeds.typed_events``.
TYPED_SQL = """
typed AS (
  SELECT user_id, event_type, value AS amount, props, ts AS change_at, event_id,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
         CASE WHEN event_type = 'purchase' THEN value END AS patched
  FROM events
)
"""
