"""Anomaly detectors over the packet table.

Every detector returns the same columns: ``packet_id, timestamp, src_ip,
dst_ip, detection_method, rule_order, score, related_ips, details``. The time of
a detection is the event time of the packet that caused it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.functions import net
from packetloom.operators import ordering
from packetloom.operators.ordering import Indexed

# Ports that malware is known to use.
SUSPICIOUS_PORTS = [4444, 5555, 6666, 6667, 31337, 12345, 27374]

MAX_NORMAL_PACKET = 1500
WINDOW = "60 seconds"
PORT_SCAN_PORTS, HIGH_RATE_PACKETS, SYN_FLOOD_SYNS, TIMES_AVERAGE = 20, 100, 50, 10
# Weight of each detector family in the combined score.
WEIGHTS = {"statistical": 0.3, "rule": 0.4, "ml": 0.5}
RULE_ORDER = {
    "statistical": 0,
    "rule:suspicious_port": 1,
    "rule:large_packet": 2,
    "rule:port_scan": 3,
    "rule:high_rate": 4,
    "rule:ddos_10x_avg": 5,
    "rule:syn_flood": 6,
    "ml": 7,
}
COLUMNS = [
    "packet_id", "timestamp", "src_ip", "dst_ip", "detection_method", "rule_order", "score", "related_ips", "details",
]

# The texts that alert descriptions carry.
SIZE_TEXT = "Unusual packet size: %d bytes (Z=%.2f)"
TIME_TEXT = "Unusual timing: IAT=%.4fs (Z=%.2f)"
PORT_TEXT = "Suspicious port detected"
LARGE_TEXT = "Unusually large packet"
SCAN_TEXT = "Potential port scan"
RATE_TEXT = "High packet rate"
SYN_TEXT = "Potential SYN flood"
DDOS_TEXT = "DDoS suspect: 10x average request rate"


def _details(**parts) -> Column:
    """An ordered map of text."""
    entries = []
    for key, value in parts.items():
        value = value if isinstance(value, Column) else F.lit(value)
        entries += [F.lit(key), value.cast("string")]
    return F.create_map(*entries)


def _emit(rows: DataFrame, method: str, score, details: Column, id_column: str = "id", related=None) -> DataFrame:
    related = F.array("src_ip", "dst_ip") if related is None else related
    return rows.select(
        F.col(id_column).alias("packet_id"),
        "timestamp",
        "src_ip",
        "dst_ip",
        F.lit(method).alias("detection_method"),
        F.lit(RULE_ORDER[method.split(":")[0] if method.startswith("ml") else method]).alias("rule_order"),
        (score if isinstance(score, Column) else F.lit(float(score))).alias("score"),
        related.alias("related_ips"),
        details.alias("details"),
    )


# --- rolling statistics -------------------------------------------------------

def rolling_stats(idx: Indexed, frame: int = 1000) -> DataFrame:
    """Mean and deviation of the last ``frame`` sizes and inter-arrival times.

    All sums are exact (BIGINT for sizes, DECIMAL for squared microseconds), with
    one division at the end, so the outcome does not depend on partitioning. A
    deviation of zero reads as 1.
    """
    size = F.col("packet_size")
    iat = F.col("iat_us").cast("decimal(18,0)")
    rows = ordering.rolling_frame(
        idx,
        frame,
        sums={
            "_sx": size,
            "_sxx": size * size,
            "_sy": iat,
            "_syy": (iat * iat).cast("decimal(30,0)"),
        },
        context={"iat_us": lambda w: net.micros_between(F.lag("timestamp").over(w), "timestamp")},
    )
    n = F.least(F.col("i"), F.lit(frame))
    k = F.least(F.col("i") - 1, F.lit(frame))
    spread_x = (n * F.col("_sxx") - F.col("_sx") * F.col("_sx")).cast("double")
    kd = k.cast("decimal(8,0)")
    sy, syy = F.col("_sy").cast("decimal(18,0)"), F.col("_syy").cast("decimal(30,0)")
    spread_y = (kd * syy - sy * sy).cast("double")
    return rows.select(
        "id", "timestamp", "src_ip", "dst_ip", "packet_size", "i", "iat_us",
        n.alias("n"),
        (F.col("_sx") / n).alias("size_mean"),
        F.when(spread_x > 0, F.sqrt(spread_x) / n).otherwise(1.0).alias("size_std"),
        k.alias("iat_n"),
        F.when(k > 0, sy.cast("double") / k / 1e6).alias("iat_mean"),
        F.when(k > 0, F.when(spread_y > 0, F.sqrt(spread_y) / k / 1e6).otherwise(1.0)).alias("iat_std"),
    )


def _z(value: Column, mean: Column, std: Column) -> Column:
    return F.when(std < 1e-6, F.lit(0.0)).otherwise(F.abs(value - mean) / std)


def statistical(idx: Indexed, frame: int = 1000, threshold: float = 3.0, warmup: int = 20) -> DataFrame:
    """Packets whose size or timing is more than ``threshold`` deviations off."""
    scored = (
        rolling_stats(idx, frame)
        .where(F.col("i") >= warmup)
        .withColumn("iat", F.col("iat_us") / F.lit(1e6))
        .withColumn("size_z", _z(F.col("packet_size"), F.col("size_mean"), F.col("size_std")))
        .withColumn("iat_z", F.coalesce(_z(F.col("iat"), F.col("iat_mean"), F.col("iat_std")), F.lit(0.0)))
    )
    by_size, by_time = F.col("size_z") > threshold, F.col("iat_z") > threshold
    hit = scored.where(by_size | by_time)
    score = F.greatest(
        F.when(by_size, F.least(F.lit(1.0), F.col("size_z") / (2 * threshold))).otherwise(0.0),
        F.when(by_time, F.least(F.lit(1.0), F.col("iat_z") / (2 * threshold))).otherwise(0.0),
    )
    messages = F.array_compact(
        F.array(
            F.when(by_size, F.format_string(SIZE_TEXT, "packet_size", "size_z")),
            F.when(by_time, F.format_string(TIME_TEXT, "iat", "iat_z")),
        )
    )
    details = _details(
        anomalies=F.array_join(messages, "; "),
        packet_size=F.col("packet_size"),
        size_mean=F.format_string("%.4f", "size_mean"),
        size_std=F.format_string("%.4f", "size_std"),
        z_score=F.format_string("%.4f", "size_z"),
    )
    return _emit(hit, "statistical", score, details)


# --- stateless rules -----------------------------------------------------------

def suspicious_port(packets: DataFrame) -> DataFrame:
    return _hits(packets, [_port_hit()])


def large_packet(packets: DataFrame, limit: int = MAX_NORMAL_PACKET) -> DataFrame:
    return _hits(packets, [_size_hit(limit)])


def packet_rules(packets: DataFrame) -> DataFrame:
    """Both rules about a packet alone, in one scan."""
    return _hits(packets, [_port_hit(), _size_hit(MAX_NORMAL_PACKET)])


def _hit(condition: Column, method: str, score: float, details: Column) -> Column:
    """NULL, or what a rule says of the packet."""
    return F.when(condition, F.struct(F.lit(method).alias("method"), F.lit(score).alias("score"), details.alias("details")))


def _port_hit() -> Column:
    odd = F.col("dst_port").isin(SUSPICIOUS_PORTS) | F.col("src_port").isin(SUSPICIOUS_PORTS)
    return _hit(odd, "rule:suspicious_port", 0.7, _details(rule=PORT_TEXT, src_port=F.col("src_port"), dst_port=F.col("dst_port")))


def _size_hit(limit: int) -> Column:
    return _hit(F.col("packet_size") > limit, "rule:large_packet", 0.5, _details(rule=LARGE_TEXT, size=F.col("packet_size"), threshold=limit))


def _hits(packets: DataFrame, rules: list[Column]) -> DataFrame:
    found = packets.select("id", "timestamp", "src_ip", "dst_ip", F.explode(F.array_compact(F.array(*rules))).alias("hit"))
    order = F.create_map(*[F.lit(x) for pair in RULE_ORDER.items() for x in pair])
    return found.select(
        F.col("id").alias("packet_id"), "timestamp", "src_ip", "dst_ip", F.col("hit.method").alias("detection_method"),
        order[F.col("hit.method")].alias("rule_order"), "hit.score", F.array("src_ip", "dst_ip").alias("related_ips"), "hit.details",
    )


# --- counting rules per (window, source) ----------------------------------------

def windowed(packets: DataFrame) -> DataFrame:
    """Aligned one-minute event-time windows."""
    return packets.withColumn("win", net.minute_window())


def _nth_per_source(rows: DataFrame, n: int) -> DataFrame:
    """The ``n``-th row of each (window, source) in time order.

    The rank limit is pushed below the shuffle: every map task keeps at most
    ``n`` rows of a group, so a source that sends a third of all packets
    reaches its window as ``n`` rows per task.
    """
    rank = F.row_number().over(W.partitionBy("win", "src_ip").orderBy("timestamp", "id"))
    return rows.withColumn("_rank", rank).where(F.col("_rank") == n)


def port_scan(packets: DataFrame, threshold: int = PORT_SCAN_PORTS) -> DataFrame:
    """First packet with which a source has touched more than ``threshold`` ports in its window.

    The first touch of a port is the least (time, id), packed into one DECIMAL so
    that plain hash aggregation can keep it; an aggregate over a struct would sort
    all packets first. The rule is about a source, so no destination is named.
    """
    base = F.lit("10000000000000000000").cast("decimal(20,0)")
    moment = net.micros("timestamp").cast("decimal(18,0)")
    packed = (moment * base + F.col("id").cast("decimal(19,0)")).cast("decimal(38,0)")
    touched_at = F.floor(F.col("first") / base).cast("bigint")  # ids stay below 0.93 of the base
    first_touch = (
        windowed(packets)
        .groupBy("win", "src_ip", "dst_port")
        .agg(F.min(packed).alias("first"))
        .select(
            "win",
            "src_ip",
            F.lit(None).cast("string").alias("dst_ip"),
            F.timestamp_add("MICROSECOND", touched_at, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")).alias("timestamp"),
            F.pmod("first", base).cast("bigint").alias("id"),
        )
    )
    return _emit(
        _nth_per_source(first_touch, threshold + 1),
        "rule:port_scan",
        0.8,
        _details(rule=SCAN_TEXT, source_ip=F.col("src_ip"), unique_ports=threshold + 1),
        related=F.array("src_ip"),
    )


def high_rate(packets: DataFrame, threshold: int = HIGH_RATE_PACKETS) -> DataFrame:
    rows = windowed(packets).select("win", "src_ip", "dst_ip", "timestamp", "id")
    return _rate_hit(_nth_per_source(rows, threshold + 1), threshold)


def syn_flood(packets: DataFrame, threshold: int = SYN_FLOOD_SYNS) -> DataFrame:
    syns = windowed(packets).where(_is_syn())
    return _syn_hit(_nth_per_source(syns.select("win", "src_ip", "dst_ip", "timestamp", "id"), threshold + 1), threshold)


def source_rules(packets: DataFrame) -> DataFrame:
    """High rate and SYN flood in one scan: a SYN is a row for each."""
    kinds = F.array_compact(F.array(F.lit("rate"), F.when(_is_syn(), "syn")))
    rows = windowed(packets).select("win", "src_ip", "dst_ip", "timestamp", "id", F.explode(kinds).alias("kind"))
    rank = F.row_number().over(W.partitionBy("win", "src_ip", "kind").orderBy("timestamp", "id"))
    limits = {"rate": HIGH_RATE_PACKETS + 1, "syn": SYN_FLOOD_SYNS + 1}
    crossing = F.when(F.col("kind") == "rate", limits["rate"]).otherwise(limits["syn"])
    # the literal limit is what goes below the shuffle
    met = rows.withColumn("_rank", rank).where(F.col("_rank") <= max(limits.values())).where(F.col("_rank") == crossing)
    related = F.when(F.col("kind") == "rate", F.array("src_ip")).otherwise(F.array("src_ip", "dst_ip"))
    details = F.when(F.col("kind") == "rate", _rate_details(HIGH_RATE_PACKETS)).otherwise(_syn_details(SYN_FLOOD_SYNS))
    method = F.when(F.col("kind") == "rate", "rule:high_rate").otherwise("rule:syn_flood")
    order = F.when(F.col("kind") == "rate", RULE_ORDER["rule:high_rate"]).otherwise(RULE_ORDER["rule:syn_flood"])
    score = F.when(F.col("kind") == "rate", 0.6).otherwise(0.85)
    return met.select(
        F.col("id").alias("packet_id"), "timestamp", "src_ip", "dst_ip", method.alias("detection_method"), order.alias("rule_order"),
        score.alias("score"), related.alias("related_ips"), details.alias("details"),
    )


def _is_syn() -> Column:
    return (F.col("protocol") == "TCP") & F.col("flags").contains("SYN")


def _rate_details(threshold: int) -> Column:
    return _details(rule=RATE_TEXT, source_ip=F.col("src_ip"), packet_count=threshold + 1, window_seconds=60)


def _syn_details(threshold: int) -> Column:
    return _details(rule=SYN_TEXT, source_ip=F.col("src_ip"), syn_count=threshold + 1)


def _rate_hit(rows: DataFrame, threshold: int) -> DataFrame:
    return _emit(rows, "rule:high_rate", 0.6, _rate_details(threshold), related=F.array("src_ip"))


def _syn_hit(rows: DataFrame, threshold: int) -> DataFrame:
    return _emit(rows, "rule:syn_flood", 0.85, _syn_details(threshold))


def running_source_counts(idx: Indexed) -> Indexed:
    """Packets so far per (window, source)."""
    return ordering.running_sums(idx.replace(windowed(idx.df)), ["win", "src_ip"], {"src_count": F.lit(1)})


def running_distinct_ports(idx: Indexed) -> Indexed:
    """Distinct destination ports so far per (window, source).

    The first sighting of each port is one small row per (window, source, port);
    flagging it needs no running count over the packets.
    """
    rows = windowed(idx.df)
    first = rows.groupBy("win", "src_ip", "dst_port").agg(F.min("i").alias("i")).select("i", F.lit(1).alias("_new"))
    flagged = rows.join(first, "i", "left").withColumn("_new", F.coalesce("_new", F.lit(0)))
    out = ordering.running_sums(idx.replace(flagged), ["win", "src_ip"], {"unique_ports": F.col("_new")})
    return out.replace(out.df.drop("_new"))


def ddos_10x(idx: Indexed, times: int = TIMES_AVERAGE) -> DataFrame:
    """First packet per (window, source) whose count reaches ``times`` the running average.

    count >= times * total / sources is tested in integers.
    """
    lean = idx.replace(idx.df.select("i", "id", "timestamp", "src_ip", "dst_ip"))
    counted = running_source_counts(lean)
    totals = ordering.running_sums(
        counted,
        ["win"],
        {"total": F.lit(1), "sources": F.when(F.col("src_count") == 1, 1).otherwise(0)},
    ).df
    hit = totals.where(
        (F.col("sources") >= 2) & (F.col("src_count") * F.col("sources") >= times * F.col("total"))
    )
    # fixed-width values only, so hits are reduced by hash; the destination is looked up for the few first ones
    numbers = ["id", "timestamp", "src_count", "sources", "total"]
    first = (
        hit.groupBy("win", "src_ip")
        .agg(F.min("i").alias("i"), *[F.min_by(c, "i").alias(c) for c in numbers])
        .join(idx.df.select("i", "dst_ip"), "i")
    )
    average = F.col("total") / F.col("sources")
    return _emit(
        first,
        "rule:ddos_10x_avg",
        0.9,
        _details(
            rule=DDOS_TEXT,
            source_ip=F.col("src_ip"),
            packet_count=F.col("src_count"),
            average_count=F.format_string("%.2f", average),
            ratio=F.format_string("%.2f", F.col("src_count") / average),
        ),
        related=F.array("src_ip"),
    )


# --- the ensemble ----------------------------------------------------------------

def detect_all(
    packets: DataFrame,
    enable: Iterable[str] = ("statistical", "rule"),
    idx: Indexed | None = None,
    ml: DataFrame | None = None,
) -> DataFrame:
    """Union of the enabled detectors; one index serves all that need order."""
    enable = set(enable)
    lean = packets.select(
        "id", "timestamp", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "packet_size", "flags"
    )
    if enable & {"statistical", "rule"} and idx is None:
        idx = ordering.with_global_index(lean)
    parts = []
    if "statistical" in enable:
        parts.append(statistical(idx))
    if "rule" in enable:
        rows = idx.df
        parts += [packet_rules(rows), port_scan(rows), source_rules(rows), ddos_10x(idx)]
    if "ml" in enable:
        if ml is None:
            raise ValueError("the ml detector needs its detections (see operators.ml_detect)")
        parts.append(ml)
    if not parts:
        raise ValueError("no detector enabled")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def aggregate_score(detections: DataFrame) -> DataFrame:
    """Weighted score per packet; the weight sum counts as at least 1."""
    family = F.split("detection_method", ":")[0]
    weight = F.coalesce(
        F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair])[family], F.lit(0.3)
    ).cast("decimal(4,1)")
    # Summed as decimals: the order of a packet's detections must not matter.
    weighted = F.sum((F.col("score").cast("decimal(18,12)") * weight)).cast("double")
    total = F.sum(weight).cast("double")
    return detections.groupBy("packet_id").agg(
        F.count("*").alias("detections"),
        F.least(F.lit(1.0), weighted / F.greatest(total, F.lit(1.0))).alias("aggregate_score"),
    )


def detector_stats(detections: DataFrame, packets: DataFrame, enable=("statistical", "rule")) -> DataFrame:
    checked = packets.agg(F.count("*")).scalar()
    return detections.agg(F.count("*").alias("anomalies_detected")).select(
        checked.alias("total_packets_checked"),
        "anomalies_detected",
        (F.col("anomalies_detected") / F.greatest(checked, F.lit(1))).alias("anomaly_rate"),
        *[F.lit(name in enable).alias(f"{name}_enabled") for name in ("statistical", "rule", "ml")],
    )


def recent_detections(detections: DataFrame, limit: int = 20) -> DataFrame:
    return detections.orderBy(F.desc("timestamp"), F.desc("packet_id"), F.desc("rule_order")).limit(limit)
