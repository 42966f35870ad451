"""Column expressions for addresses, flags and protocol fields. No UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# IP protocol numbers and their names.
PROTOCOL_NAMES = {
    1: "ICMP",
    6: "TCP",
    17: "UDP",
    41: "IPv6",
    47: "GRE",
    50: "ESP",
    51: "AH",
    58: "ICMPv6",
    89: "OSPF",
}

# Flag letters in the order in which they are printed.
FLAG_LETTERS = [("S", "SYN"), ("A", "ACK"), ("F", "FIN"), ("R", "RST"), ("P", "PSH"), ("U", "URG")]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ip_to_long(ip) -> Column:
    """Dotted quad to a number; NULL when it has not four numeric parts.

    Octets are not range-checked: ``10.0.999.1`` still maps to a number.
    """
    parts = F.split(_col(ip), "\\.")
    octets = [F.trim(F.get(parts, i)).try_cast("bigint") for i in range(4)]
    value = octets[0] * 256**3 + octets[1] * 256**2 + octets[2] * 256 + octets[3]
    return F.when(F.size(parts) == 4, value)


def is_internal_ip(ip) -> Column:
    """True for loopback and the three private IPv4 ranges."""
    n = ip_to_long(ip)
    blocks = [("10.0.0.0", 8), ("172.16.0.0", 12), ("192.168.0.0", 16), ("127.0.0.0", 8)]
    hit = F.lit(False)
    for base, bits in blocks:
        low = sum(int(p) << (8 * (3 - i)) for i, p in enumerate(base.split(".")))
        hit = hit | n.between(low, low + 2 ** (32 - bits) - 1)
    return F.coalesce(hit, F.lit(False))


def connection_key(src="src_ip", dst="dst_ip") -> Column:
    """Undirected pair: the smaller address first."""
    a, b = _col(src), _col(dst)
    return F.struct(F.least(a, b).alias("ip_a"), F.greatest(a, b).alias("ip_b"))


def directed_key(src="src_ip", dst="dst_ip") -> Column:
    return F.struct(_col(src).alias("src_ip"), _col(dst).alias("dst_ip"))


def tcp_flag_text(letters) -> Column:
    """``SA`` -> ``SYN-ACK``; fixed order, unknown letters ignored, empty -> ``NONE``."""
    value = F.coalesce(_col(letters), F.lit(""))
    names = F.array_compact(F.array(*[F.when(value.contains(letter), F.lit(name)) for letter, name in FLAG_LETTERS]))
    return F.when(F.size(names) == 0, F.lit("NONE")).otherwise(F.array_join(names, "-"))


def protocol_name(number) -> Column:
    n = _col(number)
    lookup = F.create_map(*[F.lit(x) for pair in PROTOCOL_NAMES.items() for x in pair])
    return F.coalesce(lookup[n.cast("int")], F.concat(F.lit("UNKNOWN("), n.cast("string"), F.lit(")")))


def byte_at(raw, position: int) -> Column:
    """Unsigned byte of a BINARY column, 0-based."""
    return F.conv(F.hex(F.substring(_col(raw), position + 1, 1)), 16, 10).cast("int")


def micros_between(start, end) -> Column:
    """Whole microseconds from ``start`` to ``end`` (works on zoneless timestamps)."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def micros(ts="timestamp") -> Column:
    """Microseconds since the epoch of a zoneless timestamp."""
    return micros_between(F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), ts)


def minute_window(ts="timestamp") -> Column:
    return F.date_trunc("minute", _col(ts)).cast("timestamp_ntz")
