"""Bulk decoding of IPv4 headers and normalisation of decoded packets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.functions import net

MIN_HEADER = 20
PAYLOAD_PREVIEW = 100


def _dotted(raw: str, start: int) -> Column:
    return F.concat_ws(".", *[net.byte_at(raw, start + k).cast("string") for k in range(4)])


def reject_reason(raw: str = "raw") -> Column:
    """NULL for a decodable header, else why it is not."""
    version = F.shiftright(net.byte_at(raw, 0), 4)
    return (
        F.when(F.col(raw).isNull(), "missing")
        .when(F.octet_length(raw) < MIN_HEADER, "too_short")
        .when(version != 4, "not_ipv4")
    )


def decode(headers: DataFrame, raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """(decoded rows, quarantined rows with ``reason``); all other columns are kept."""
    marked = headers.withColumn("reason", reject_reason(raw))
    others = [c for c in headers.columns if c != raw]
    first = net.byte_at(raw, 0)
    good = marked.where(F.col("reason").isNull()).select(
        *others,
        F.shiftright(first, 4).alias("version"),
        (first.bitwiseAND(F.lit(15)) * 4).alias("header_length"),
        (net.byte_at(raw, 2) * 256 + net.byte_at(raw, 3)).alias("total_length"),
        net.byte_at(raw, 8).alias("ttl"),
        net.byte_at(raw, 9).alias("protocol"),
        _dotted(raw, 12).alias("src_ip"),
        _dotted(raw, 16).alias("dst_ip"),
    )
    return good, marked.where(F.col("reason").isNotNull()).select(*others, raw, "reason")


def decode_report(headers: DataFrame, raw: str = "raw") -> DataFrame:
    """Rows per outcome."""
    outcome = F.coalesce(reject_reason(raw), F.lit("decoded"))
    return headers.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("headers"))


def normalize(decoded: DataFrame, preview: int = PAYLOAD_PREVIEW) -> DataFrame:
    """Decoded headers as packet rows.

    Input: ``id, timestamp, src_ip, dst_ip, proto, sport, dport, flag_letters,
    icmp_type, icmp_code, payload, size, ttl``. TCP and UDP keep ports and the
    first ``preview`` payload bytes, ICMP puts type and code into the ports.
    """
    tcp, udp, icmp = (F.col("proto") == n for n in (6, 17, 1))
    ported = tcp | udp
    return decoded.select(
        "id",
        "timestamp",
        "src_ip",
        "dst_ip",
        F.when(ported, F.col("sport")).when(icmp, F.col("icmp_type")).otherwise(0).alias("src_port"),
        F.when(ported, F.col("dport")).when(icmp, F.col("icmp_code")).otherwise(0).alias("dst_port"),
        net.protocol_name("proto").alias("protocol"),
        F.col("size").cast("bigint").alias("packet_size"),
        F.when(tcp, net.tcp_flag_text("flag_letters")).alias("flags"),
        "ttl",
        F.when(ported, F.substring("payload", 1, preview)).alias("payload_preview"),
    )
