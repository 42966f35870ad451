"""Check SQL shared by the detector and alert queries."""

ROLL_SQL = """
ix AS (SELECT *, row_number() OVER (ORDER BY timestamp, id) AS i,
  date_diff('microsecond', lag(timestamp) OVER (ORDER BY timestamp, id), timestamp) AS iat_us FROM packets),
rs AS (SELECT *, least(i, 1000) AS n, least(i - 1, 1000) AS k,
  sum(CAST(packet_size AS HUGEINT)) OVER w AS sx, sum(CAST(packet_size AS HUGEINT) * packet_size) OVER w AS sxx,
  sum(CAST(iat_us AS HUGEINT)) OVER w AS sy, sum(CAST(iat_us AS HUGEINT) * iat_us) OVER w AS syy
  FROM ix WINDOW w AS (ORDER BY i ROWS BETWEEN 999 PRECEDING AND CURRENT ROW)),
roll AS (SELECT id, timestamp, src_ip, dst_ip, packet_size, i, iat_us, n, CAST(sx AS DOUBLE) / n AS size_mean,
  CASE WHEN n * sxx - sx * sx > 0 THEN sqrt(CAST(n * sxx - sx * sx AS DOUBLE)) / n ELSE 1.0::DOUBLE END AS size_std,
  k AS iat_n, CASE WHEN k > 0 THEN CAST(sy AS DOUBLE) / k / 1e6 END AS iat_mean,
  CASE WHEN k > 0 THEN CASE WHEN k * syy - sy * sy > 0 THEN sqrt(CAST(k * syy - sy * sy AS DOUBLE)) / k / 1e6
    ELSE 1.0::DOUBLE END END AS iat_std FROM rs)
"""

STATISTICAL_SQL = """
zs AS (SELECT *, iat_us / 1e6 AS iat,
  CASE WHEN size_std < 1e-6 THEN 0 ELSE abs(packet_size - size_mean) / size_std END AS size_z,
  coalesce(CASE WHEN iat_std < 1e-6 THEN 0 ELSE abs(iat_us / 1e6 - iat_mean) / iat_std END, 0) AS iat_z
  FROM roll WHERE i >= 20),
d_stat AS (SELECT id AS packet_id, timestamp, src_ip, dst_ip, 'statistical' AS detection_method, 0 AS rule_order,
  greatest(CASE WHEN size_z > 3 THEN least(1.0::DOUBLE, size_z / 6) ELSE 0 END,
    CASE WHEN iat_z > 3 THEN least(1.0::DOUBLE, iat_z / 6) ELSE 0 END) AS score,
  [src_ip, dst_ip] AS related_ips,
  'anomalies=' || concat_ws('; ',
     CASE WHEN size_z > 3 THEN printf('Unusual packet size: %d bytes (Z=%.2f)', packet_size, size_z) END,
     CASE WHEN iat_z > 3 THEN printf('Unusual timing: IAT=%.4fs (Z=%.2f)', iat, iat_z) END)
   || ', packet_size=' || packet_size || ', size_mean=' || printf('%.4f', size_mean)
   || ', size_std=' || printf('%.4f', size_std) || ', z_score=' || printf('%.4f', size_z) AS description
  FROM zs WHERE size_z > 3 OR iat_z > 3)
"""

RULES_SQL = """
d_port AS (SELECT id AS packet_id, timestamp, src_ip, dst_ip, 'rule:suspicious_port' AS detection_method,
  1 AS rule_order, 0.7::DOUBLE AS score, [src_ip, dst_ip] AS related_ips,
  'rule=Suspicious port detected, src_port=' || src_port || ', dst_port=' || dst_port AS description FROM packets
  WHERE dst_port IN (4444,5555,6666,6667,31337,12345,27374) OR src_port IN (4444,5555,6666,6667,31337,12345,27374)),
d_large AS (SELECT id AS packet_id, timestamp, src_ip, dst_ip, 'rule:large_packet' AS detection_method,
  2 AS rule_order, 0.5::DOUBLE AS score, [src_ip, dst_ip] AS related_ips,
  'rule=Unusually large packet, size=' || packet_size || ', threshold=1500' AS description
  FROM packets WHERE packet_size > 1500),
wp AS (SELECT *, date_trunc('minute', timestamp) AS win FROM packets),
fp AS (SELECT *, row_number() OVER (PARTITION BY win, src_ip, dst_port ORDER BY timestamp, id) AS seen FROM wp),
rc AS (SELECT *, row_number() OVER a AS src_count,
  CAST(sum(CASE WHEN seen = 1 THEN 1 ELSE 0 END) OVER a AS BIGINT) AS unique_ports,
  CAST(sum(CASE WHEN protocol = 'TCP' AND contains(coalesce(flags, ''), 'SYN') THEN 1 ELSE 0 END) OVER a AS BIGINT)
    AS syns
  FROM fp WINDOW a AS (PARTITION BY win, src_ip ORDER BY timestamp, id ROWS UNBOUNDED PRECEDING)),
tc AS (SELECT *, row_number() OVER b AS total,
  CAST(sum(CASE WHEN src_count = 1 THEN 1 ELSE 0 END) OVER b AS BIGINT) AS sources
  FROM rc WINDOW b AS (PARTITION BY win ORDER BY timestamp, id ROWS UNBOUNDED PRECEDING)),
d_scan AS (SELECT id AS packet_id, timestamp, src_ip, CAST(NULL AS VARCHAR) AS dst_ip, 'rule:port_scan' AS detection_method, 3 AS rule_order,
  0.8::DOUBLE AS score, [src_ip] AS related_ips,
  'rule=Potential port scan, source_ip=' || src_ip || ', unique_ports=' || unique_ports AS description
  FROM tc WHERE unique_ports > 20
  QUALIFY row_number() OVER (PARTITION BY win, src_ip ORDER BY timestamp, id) = 1),
d_rate AS (SELECT id AS packet_id, timestamp, src_ip, dst_ip, 'rule:high_rate' AS detection_method, 4 AS rule_order,
  0.6::DOUBLE AS score, [src_ip] AS related_ips,
  'rule=High packet rate, source_ip=' || src_ip || ', packet_count=' || src_count || ', window_seconds=60'
    AS description FROM tc WHERE src_count > 100
  QUALIFY row_number() OVER (PARTITION BY win, src_ip ORDER BY timestamp, id) = 1),
d_ddos AS (SELECT id AS packet_id, timestamp, src_ip, dst_ip, 'rule:ddos_10x_avg' AS detection_method,
  5 AS rule_order, 0.9::DOUBLE AS score, [src_ip] AS related_ips,
  'rule=DDoS suspect: 10x average request rate, source_ip=' || src_ip || ', packet_count=' || src_count
   || ', average_count=' || printf('%.2f', CAST(total AS DOUBLE) / sources)
   || ', ratio=' || printf('%.2f', src_count / (CAST(total AS DOUBLE) / sources)) AS description
  FROM tc WHERE sources >= 2 AND src_count * sources >= 10 * total
  QUALIFY row_number() OVER (PARTITION BY win, src_ip ORDER BY timestamp, id) = 1),
d_syn AS (SELECT id AS packet_id, timestamp, src_ip, dst_ip, 'rule:syn_flood' AS detection_method, 6 AS rule_order,
  0.85::DOUBLE AS score, [src_ip, dst_ip] AS related_ips,
  'rule=Potential SYN flood, source_ip=' || src_ip || ', syn_count=' || syns AS description
  FROM tc WHERE syns > 50
  QUALIFY row_number() OVER (PARTITION BY win, src_ip ORDER BY timestamp, id) = 1)
"""

DETECTIONS = [
    ROLL_SQL,
    STATISTICAL_SQL,
    RULES_SQL,
    "det AS (" + " UNION ALL ".join(
        f"SELECT * FROM {t}" for t in ("d_stat", "d_port", "d_large", "d_scan", "d_rate", "d_ddos", "d_syn")
    ) + ")",
]

ALERTS = [
    *DETECTIONS,
    """alerts AS (SELECT packet_id * 16 + rule_order AS id, timestamp,
  CASE WHEN contains(detection_method, 'port_scan') THEN 'port_scan'
    WHEN contains(detection_method, 'ddos') OR contains(detection_method, 'high_rate')
      OR contains(detection_method, 'syn_flood') THEN 'ddos_suspect'
    WHEN contains(detection_method, 'large_packet') THEN 'large_packet' ELSE 'anomaly' END AS alert_type,
  CAST(CASE WHEN score >= 0.8 THEN 4 WHEN score >= 0.6 THEN 3 WHEN score >= 0.4 THEN 2 ELSE 1 END AS INT) AS severity,
  related_ips[1] AS src_ip, CASE WHEN len(related_ips) > 1 THEN related_ips[2] END AS dst_ip, description,
  CAST(0 AS BIGINT) AS packet_count, CAST(0 AS BIGINT) AS byte_count FROM det)""",
]

EMIT = (
    "SELECT packet_id, timestamp, src_ip, dst_ip, detection_method, CAST(rule_order AS INT) AS rule_order,"
    " round(score, 6) AS score, array_to_string(related_ips, ',') AS related_ips, description FROM {0}"
)
