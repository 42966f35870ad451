"""Small packet tables and plain sequential versions of the ordered operators."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

from packetloom.schema import PACKET, PACKET_COLUMNS

START = datetime(2024, 1, 1, 8, 58, 50)


def packet(spark_rows, at, src, dst, sport=1000, dport=80, protocol="TCP", size=100, flags="ACK", ttl=64):
    spark_rows.append((len(spark_rows), at, src, dst, sport, dport, protocol, size, flags, ttl))


def random_packets(n=400, seed=7, hot_share=0.4):
    """Traffic where one source sends ``hot_share`` of everything and times repeat."""
    rng = random.Random(seed)
    rows, at = [], START
    for _ in range(n):
        at += timedelta(microseconds=rng.choice([0, 1000, 50_000, 400_000, 400_000, 900_000]))
        if rng.random() < 0.02:
            at += timedelta(seconds=rng.choice([4, 7, 40]))
        hot = rng.random() < hot_share
        src = "10.0.0.1" if hot else f"10.0.0.{rng.randint(2, 9)}"
        protocol = rng.choice(["TCP", "TCP", "UDP", "ICMP"])
        packet(
            rows, at, src, f"10.0.1.{rng.randint(1, 6)}", rng.choice([53, 1024, 2048, 4444]), rng.randint(1, 40),
            protocol, rng.choice([40, 60, 100, 1400, 9000]) + rng.randint(0, 5),
            rng.choice(["SYN", "ACK", "SYN-ACK", "FIN", "RST"]) if protocol == "TCP" else None,
        )
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, PACKET)


def named(rows):
    return [dict(zip(PACKET_COLUMNS, r)) for r in sorted(rows, key=lambda r: (r[1], r[0]))]


def minute(at):
    return at.replace(second=0, microsecond=0)


def rolling(rows, frame):
    sizes, gaps, last, out = [], [], None, {}
    for p in named(rows):
        sizes.append(p["packet_size"])
        if last is not None:
            gaps.append((p["timestamp"] - last).total_seconds())
        last = p["timestamp"]
        sizes, gaps = sizes[-frame:], gaps[-frame:]

        def moments(values):
            mean = sum(values) / len(values)
            variance = sum((v - mean) ** 2 for v in values) / len(values)
            return mean, math.sqrt(variance) if variance > 1e-15 else 1.0

        out[p["id"]] = (moments(sizes), moments(gaps) if gaps else None)
    return out


def running_rules(rows):
    """Per packet id: packets and distinct ports so far of its source; and the first 10x crossings."""
    counts, ports, window, seen, crossings = {}, {}, None, {}, []
    for p in named(rows):
        w, src = minute(p["timestamp"]), p["src_ip"]
        if w != window:
            counts, ports, window, alerted = {}, {}, w, set()
        counts[src] = counts.get(src, 0) + 1
        ports.setdefault(src, set()).add(p["dst_port"])
        seen[p["id"]] = (counts[src], len(ports[src]))
        average = sum(counts.values()) / len(counts)
        if len(counts) >= 2 and counts[src] >= 3 * average and src not in alerted:
            alerted.add(src)
            crossings.append(p["id"])
    return seen, crossings


def anchored(rows, seconds):
    start, out = None, {}
    for p in named(rows):
        if start is None or p["timestamp"] > start + timedelta(seconds=seconds):
            start = p["timestamp"]
        out[p["id"]] = start
    return out


def feature_row(packets):
    n = len(packets)
    sizes = [p["packet_size"] for p in packets]
    mean = sum(sizes) / n
    gaps = [(b["timestamp"] - a["timestamp"]).total_seconds() for a, b in zip(packets, packets[1:])]
    span = (packets[-1]["timestamp"] - packets[0]["timestamp"]).total_seconds()
    gap_mean = sum(gaps) / len(gaps) if gaps else 0.0
    flagged = [p for p in packets if p["protocol"] == "TCP" and p["flags"]]

    def share(name):
        return sum(name in p["flags"] for p in flagged) / len(flagged) if flagged else 0.0

    return [
        mean, math.sqrt(sum((s - mean) ** 2 for s in sizes) / n), min(sizes), max(sizes), gap_mean,
        math.sqrt(sum((g - gap_mean) ** 2 for g in gaps) / len(gaps)) if gaps else 0.0,
        n / span if n > 1 and span > 0 else 0.0,
        *[sum(p["protocol"] == x for p in packets) / n for x in ("TCP", "UDP", "ICMP")],
        len({p["src_port"] for p in packets}), len({p["dst_port"] for p in packets}),
        sum((p["src_port"] < 1024) + (p["dst_port"] < 1024) for p in packets) / (2 * n),
        len({p["dst_ip"] for p in packets}), len({p["src_ip"] for p in packets}),
        sum(sizes) / len({(p["src_ip"], p["dst_ip"]) for p in packets}),
        share("SYN"), share("ACK"), share("FIN"), share("RST"),
        sum(p["timestamp"].hour for p in packets) / n,
        sum(9 <= p["timestamp"].hour < 17 for p in packets) / n,
    ]


def trailing(rows, seconds, every):
    ordered, out = named(rows), {}
    for k, p in enumerate(ordered, start=1):
        if k % every == 0:
            live = [q for q in ordered[:k] if q["timestamp"] > p["timestamp"] - timedelta(seconds=seconds)]
            out[k] = feature_row(live)
    return out
