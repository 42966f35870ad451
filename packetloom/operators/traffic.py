"""Filters, aggregates and top-k reports over the packet table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.functions import net


def _minutes(n: float) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n * 60.0).cast("decimal(18,6)"))


def latest(df: DataFrame, column: str = "timestamp") -> Column:
    """Newest event time as a scalar subquery, the default for every ``as_of``.

    Of a log partitioned by ``dt`` only the newest day is read.
    """
    if "dt" in df.columns:
        df = df.where(F.col("dt") == df.agg(F.max("dt")).scalar())
    return df.agg(F.max(column)).scalar()


def since(df: DataFrame, minutes: float, as_of=None) -> DataFrame:
    """Rows of the last ``minutes`` up to the event time ``as_of``; prunes ``dt`` partitions when present."""
    return df.where(_not_before(df, _cutoff(df, minutes, as_of)))


def _cutoff(df: DataFrame, minutes: float, as_of=None) -> Column:
    anchor = latest(df) if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    return anchor - _minutes(minutes)


def _not_before(df: DataFrame, cutoff: Column) -> Column:
    kept = F.col("timestamp") >= cutoff
    return kept & (F.col("dt") >= cutoff.cast("date")) if "dt" in df.columns else kept


def _recent(df: DataFrame, minutes: float | None, as_of) -> DataFrame:
    return df if minutes is None else since(df, minutes, as_of)


# --- filters ----------------------------------------------------------------

def in_time_range(packets: DataFrame, start, end) -> DataFrame:
    """Both ends inclusive, oldest first. Prunes ``dt`` partitions when present."""
    low, high = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    hit = packets.where(F.col("timestamp").between(low, high))
    if "dt" in packets.columns:
        hit = hit.where(F.col("dt").between(low.cast("date"), high.cast("date")))
    return hit.orderBy("timestamp", "id")


def by_ip(packets: DataFrame, ip: str, direction: str = "both") -> DataFrame:
    tests = {
        "src": F.col("src_ip") == ip,
        "dst": F.col("dst_ip") == ip,
        "both": (F.col("src_ip") == ip) | (F.col("dst_ip") == ip),
    }
    if direction not in tests:
        raise ValueError(f"direction must be one of {sorted(tests)}, not {direction!r}")
    return packets.where(tests[direction]).orderBy(F.desc("timestamp"), F.desc("id"))


def anomalies(logs: DataFrame, limit: int = 100) -> DataFrame:
    return logs.where("is_anomaly").orderBy(F.desc("anomaly_score"), F.desc("timestamp"), "id").limit(limit)


def capture_filter(packets: DataFrame, protocol=None, port=None, host=None, net_prefix=None) -> DataFrame:
    """Row filter at the source: every given condition must hold."""
    out = packets
    if protocol is not None:
        out = out.where(F.col("protocol") == protocol.upper())
    if port is not None:
        out = out.where((F.col("src_port") == port) | (F.col("dst_port") == port))
    if host is not None:
        out = out.where((F.col("src_ip") == host) | (F.col("dst_ip") == host))
    if net_prefix is not None:
        out = out.where(F.col("src_ip").startswith(net_prefix) | F.col("dst_ip").startswith(net_prefix))
    return out


def split_retention(logs: DataFrame, days: float = 7, as_of=None) -> tuple[DataFrame, DataFrame]:
    """(kept, expired) around ``as_of - days``; the cutoff itself is kept."""
    cutoff = _cutoff(logs, days * 1440, as_of)
    expired = F.col("timestamp") < cutoff
    if "dt" in logs.columns:
        expired &= F.col("dt") <= cutoff.cast("date")
    return logs.where(_not_before(logs, cutoff)), logs.where(expired)


def retention_counts(logs: DataFrame, days: float = 7, as_of=None) -> DataFrame:
    """Kept and deleted row counts, in one pass over the log."""
    anchor = latest(logs) if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    expired = F.col("timestamp") < anchor - _minutes(days * 1440)
    return logs.agg(F.count_if(expired).alias("deleted"), F.count_if(~expired).alias("kept"))


# --- aggregates -------------------------------------------------------------

def packet_count_by_ip(packets: DataFrame, minutes: float, as_of=None, ip: str | None = None) -> DataFrame:
    """Packets sent per source in the trailing period; one source if ``ip`` is given."""
    recent = since(packets, minutes, as_of)
    if ip is not None:
        recent = recent.where(F.col("src_ip") == ip)
    return recent.groupBy("src_ip").agg(F.count("*").alias("packet_count"))


def traffic_totals(packets: DataFrame, minutes: float | None = None, as_of=None, approximate=False) -> DataFrame:
    """Packets, bytes, mean size and distinct endpoints as one row (zeros when empty)."""
    rows = _recent(packets, minutes, as_of)
    n, size, sized = F.count("*"), F.sum("packet_size"), F.count("packet_size")
    if not approximate:
        # one row per pair first: packets are read once and not repeated per distinct count
        rows = rows.groupBy("src_ip", "dst_ip").agg(n.alias("n"), size.alias("size"), sized.alias("sized"))
        n, size, sized = F.coalesce(F.sum("n"), F.lit(0)), F.sum("size"), F.sum("sized")
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return rows.agg(
        n.alias("packet_count"),
        F.coalesce(size, F.lit(0)).alias("total_bytes"),
        F.coalesce(size / sized, F.lit(0.0)).alias("avg_packet_size"),
        distinct("src_ip").alias("unique_sources"),
        distinct("dst_ip").alias("unique_destinations"),
    )


def protocol_distribution(packets: DataFrame, minutes: float | None = None, as_of=None) -> DataFrame:
    return (
        _recent(packets, minutes, as_of).groupBy("protocol")
        .agg(F.count("*").alias("packet_count"))
        .orderBy(F.desc("packet_count"), "protocol")
    )


def top_sources(packets: DataFrame, limit: int = 10, minutes: float | None = None, as_of=None) -> DataFrame:
    return (
        _recent(packets, minutes, as_of).groupBy("src_ip")
        .agg(F.count("*").alias("packet_count"), F.sum("packet_size").alias("total_bytes"))
        .orderBy(F.desc("packet_count"), "src_ip")
        .limit(limit)
    )


def bandwidth_hogs(packets: DataFrame, k: int = 5) -> DataFrame:
    return (
        packets.groupBy("src_ip")
        .agg(F.sum("packet_size").alias("total_bytes"))
        .orderBy(F.desc("total_bytes"), "src_ip")
        .limit(k)
    )


def anomaly_trend(logs: DataFrame, minutes: float | None = None, as_of=None) -> DataFrame:
    logs = _recent(logs, minutes, as_of)
    n = F.greatest(F.count("*"), F.lit(1))
    bad = F.count_if("is_anomaly")
    good = F.count_if(~F.col("is_anomaly"))
    return logs.agg(
        bad.alias("anomaly_count"),
        good.alias("normal_count"),
        F.round(100.0 * good / n, 6).alias("normal_percent"),
        F.round(100.0 * bad / n, 6).alias("anomalous_percent"),
    )


def pair_protocol_counts(packets: DataFrame, times: bool = True) -> DataFrame:
    """Counters per (src, dst, protocol), the compact form all pair reports start from.

    Plain hash aggregation with map-side combine: a busy pair leaves each task as
    a handful of rows, and no set is built over packets.
    """
    spans = [F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen")] if times else []
    return packets.groupBy("src_ip", "dst_ip", "protocol").agg(
        F.count("*").alias("packet_count"), F.sum("packet_size").alias("total_bytes"), *spans
    )


def connection_pairs(packets: DataFrame, limit: int | None = 100) -> DataFrame:
    """Directed pairs with counters, protocols and the first and last sighting."""
    pairs = pair_protocol_counts(packets).groupBy("src_ip", "dst_ip").agg(
        F.sum("packet_count").alias("packet_count"),
        F.sum("total_bytes").alias("total_bytes"),
        F.array_join(F.array_sort(F.collect_list("protocol")), ",").alias("protocols"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
    ranked = pairs.orderBy(F.desc("packet_count"), "src_ip", "dst_ip")
    return ranked if limit is None else ranked.limit(limit)


def ip_stats(packets: DataFrame) -> DataFrame:
    """Per address: sent and received counters, peers, protocols and first/last sent.

    Every pair counter speaks for both of its ends. Grouped by address, role and peer first, a peer is one row of an
    address and peers are counted by counting rows; a busy address is reduced peer by peer. The protocols come from
    distinct (address, protocol) pairs, a few per address. An address without one of the roles gets zeros there.
    """
    src, dst = F.col("src_ip"), F.col("dst_ip")
    never = F.lit(None).cast("timestamp_ntz")

    def end(role, ip, peer, first, last):
        return F.struct(F.lit(role).alias("role"), ip.alias("ip"), peer.alias("peer"), first.alias("first"), last.alias("last"))

    ends = pair_protocol_counts(packets).select("packet_count", "total_bytes", F.explode(F.array(
        end(0, src, dst, F.col("first_seen"), F.col("last_seen")), end(1, dst, src, never, never))).alias("e"))
    peers = ends.select("packet_count", "total_bytes", "e.*").groupBy("ip", "role", "peer").agg(
        F.sum("packet_count").alias("n"), F.sum("total_bytes").alias("b"), F.min("first").alias("first"), F.max("last").alias("last"))
    of = lambda role, value: F.coalesce(F.sum(F.when(F.col("role") == role, value)), F.lit(0))
    known = F.col("peer").isNotNull().cast("bigint")
    counters = peers.groupBy("ip").agg(
        of(0, F.col("n")).alias("packets_sent"), of(0, F.col("b")).alias("bytes_sent"),
        of(1, F.col("n")).alias("packets_received"), of(1, F.col("b")).alias("bytes_received"),
        of(0, known).alias("unique_destinations"), of(1, known).alias("unique_sources"),
        F.min("first").alias("first_seen"), F.max("last").alias("last_seen"))
    spoken = packets.select(src.alias("ip"), "protocol").distinct().groupBy("ip").agg(
        F.array_join(F.array_sort(F.collect_list("protocol")), ",").alias("protocols_used"))
    return counters.join(spoken, "ip", "left").select(
        "ip", "packets_sent", "bytes_sent", "packets_received", "bytes_received", "unique_destinations",
        "unique_sources",
        (F.col("packets_sent") + F.col("packets_received")).alias("total_packets"),
        (F.col("bytes_sent") + F.col("bytes_received")).alias("total_bytes"),
        F.coalesce("protocols_used", F.lit("")).alias("protocols_used"), "first_seen", "last_seen",
    )


def table_stats(logs: DataFrame, alerts: DataFrame) -> DataFrame:
    return (
        logs.agg(F.count("*").alias("n"))
        .select(F.lit("traffic_log").alias("table_name"), F.col("n").alias("row_count"))
        .unionByName(
            alerts.agg(F.count("*").alias("n")).select(
                F.lit("alerts").alias("table_name"), F.col("n").alias("row_count")
            )
        )
    )


def capture_stats(packets: DataFrame) -> DataFrame:
    """Totals per protocol family and packets per second over at least one second."""
    runtime = net.micros_between(F.min("timestamp"), F.max("timestamp")) / F.lit(1e6)
    known = ["TCP", "UDP", "ICMP"]
    return packets.agg(
        F.count("*").alias("total_packets"),
        F.coalesce(F.sum("packet_size"), F.lit(0)).alias("total_bytes"),
        *[F.count_if(F.col("protocol") == p).alias(f"{p.lower()}_packets") for p in known],
        F.count_if(~F.col("protocol").isin(known)).alias("other_packets"),
        F.round(F.coalesce(runtime, F.lit(0.0)), 6).alias("runtime_seconds"),
        F.round(F.count("*") / F.greatest(F.coalesce(runtime, F.lit(0.0)), F.lit(1.0)), 6).alias(
            "packets_per_second"
        ),
    )


def volume_per_minute(packets: DataFrame, fold_days: bool = False) -> DataFrame:
    """Packets per minute, oldest first; empty when there are fewer than two minutes.

    ``fold_days`` keys by ``HH:mm`` and so adds up the same minute of all days.
    """
    key = F.date_format("timestamp", "HH:mm") if fold_days else net.minute_window()
    counts = packets.groupBy(key.alias("minute")).agg(F.count("*").alias("packets"))
    # One row per minute of traffic: small enough to count in one window.
    all_minutes = W.partitionBy(F.lit(0))
    return (
        counts.withColumn("_minutes", F.count("*").over(all_minutes)).where("_minutes >= 2").drop("_minutes")
        .orderBy("minute")
    )


def volume_per_minute_filled(packets: DataFrame) -> DataFrame:
    """Packets per minute with a zero row for every silent minute in between."""
    counts = packets.groupBy(net.minute_window().alias("minute")).agg(F.count("*").alias("packets"))
    span = counts.agg(F.min("minute").alias("lo"), F.max("minute").alias("hi"))
    axis = span.select(F.explode(F.expr("sequence(lo, hi, INTERVAL 1 MINUTE)")).alias("minute"))
    return axis.join(counts, "minute", "left").fillna(0, ["packets"]).orderBy("minute")


# --- order and limit ---------------------------------------------------------

def recent(df: DataFrame, limit: int = 100) -> DataFrame:
    """Newest rows; a per-task heap, never a full sort."""
    return df.orderBy(F.desc("timestamp"), F.desc("id")).limit(limit)


# --- endpoint sets -----------------------------------------------------------

def endpoints(packets: DataFrame) -> DataFrame:
    """Every address seen as a source or destination, once.

    Distinct pairs first: the explode then meets edges, not packets.
    """
    pairs = packets.select("src_ip", "dst_ip").distinct()
    return pairs.select(F.explode(F.array("src_ip", "dst_ip")).alias("ip")).distinct()


def neighbors(packets: DataFrame, direction: str = "out", ip: str | None = None) -> DataFrame:
    """(ip, neighbor) pairs, of one address or of all."""
    if direction not in ("out", "in", "both"):
        raise ValueError(f"unknown direction {direction!r}")
    pairs = packets.select("src_ip", "dst_ip").distinct()
    out = pairs.select(F.col("src_ip").alias("ip"), F.col("dst_ip").alias("neighbor"))
    into = pairs.select(F.col("dst_ip").alias("ip"), F.col("src_ip").alias("neighbor"))
    chosen = {"out": out, "in": into}.get(direction)
    if chosen is None:
        chosen = out.unionByName(into).distinct()
    return chosen if ip is None else chosen.where(F.col("ip") == ip)
