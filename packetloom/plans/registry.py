"""Named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PACKETS_SQL = """
e AS (SELECT event_id, user_id, event_type, value, CAST(json_extract_string(props,'$.k') AS INT) AS k FROM events),
n AS (SELECT *, user_id AS s, CASE WHEN event_id % 5 = 0 THEN CAST(k AS BIGINT)
    WHEN k BETWEEN 12 AND 15 AND user_id < 64 THEN CAST(4 AS BIGINT) ELSE user_id - user_id % 8 + k % 8 END AS d0 FROM (
  SELECT event_id, CASE WHEN event_id % 5 = 0 THEN CAST(1 AS BIGINT) ELSE user_id END AS user_id, event_type, value, k
  FROM e) q),
m AS (SELECT *, CASE WHEN d0 = s THEN s - s % 8 + (s + 1) % 8 ELSE d0 END AS d FROM n),
packets AS (
SELECT event_id AS id,
 TIMESTAMP '2024-01-01 08:55:00' + to_microseconds(event_id * 50000 + k * 300 + (event_id // 400) * 7000000)
   AS timestamp,
 CASE WHEN s % 10 = 9 THEN '198.18.' ELSE '10.0.' END || CAST(s // 250 AS VARCHAR) || '.' || CAST(s % 250 AS VARCHAR)
   AS src_ip,
 CASE WHEN d % 10 = 9 THEN '198.18.' ELSE '10.0.' END || CAST(d // 250 AS VARCHAR) || '.' || CAST(d % 250 AS VARCHAR)
   AS dst_ip,
 CAST(CASE WHEN event_type='error' THEN 0 WHEN k % 10 = 0 THEN 53 ELSE 1024 + (event_id * 7919) % 60000 END AS INT)
   AS src_port,
 CAST(CASE WHEN event_type='error' THEN 0 WHEN k = 44 THEN 4444 WHEN k = 37 THEN 31337
   WHEN event_id % 5 = 0 THEN 1 + (event_id * 13) % 2000
   WHEN k % 5 = 0 THEN 53 WHEN k % 5 = 1 THEN 80 WHEN k % 5 = 2 THEN 443 WHEN k % 5 = 3 THEN 22 ELSE 3306 END AS INT)
   AS dst_port,
 CASE event_type WHEN 'signup' THEN 'UDP' WHEN 'error' THEN 'ICMP' ELSE 'TCP' END AS protocol,
 CAST(CASE WHEN k = 77 THEN 9000 + floor(value * 40) ELSE 40 + floor(value * 10) END AS BIGINT) AS packet_size,
 CASE WHEN event_type IN ('signup','error') THEN NULL WHEN event_id % 5 = 0 THEN 'SYN' WHEN k % 6 = 0 THEN 'SYN'
   WHEN k % 6 = 1 THEN 'ACK' WHEN k % 6 = 2 THEN 'SYN-ACK'
   WHEN k % 6 = 3 THEN 'FIN' WHEN k % 6 = 4 THEN 'RST' ELSE 'PSH-ACK' END AS flags,
 CAST(CASE WHEN k % 3 = 0 THEN 64 WHEN k % 3 = 1 THEN 128 ELSE 255 END AS INT) AS ttl
FROM m)
"""

LOGS_SQL = """
logs AS (SELECT *, packet_size > 10000 AS is_anomaly,
  CASE WHEN packet_size > 10000 THEN least(1.0, packet_size / 50000.0::DOUBLE) ELSE 0.0::DOUBLE END AS anomaly_score
  FROM packets)
"""


def query(name: str, sql: str | None = None, ctes: str | list[str] = ()):
    """Register a query; ``sql`` sees ``packets`` and whatever ``ctes`` define."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            parts = [ctes] if isinstance(ctes, str) else list(ctes)
            ORACLES[name] = "WITH RECURSIVE " + ",\n".join([PACKETS_SQL, *parts]) + "\n" + sql
        return fn

    return register
