"""The 22 traffic features of a group of packets."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.functions import net
from packetloom.operators import ordering
from packetloom.operators.anchored import anchored_windows
from packetloom.operators.ordering import Indexed
from packetloom.schema import FEATURES
from packetloom.session import cut, scratch_tables

WELL_KNOWN = 1023
TRAILING_BLOCK = 100_000
BUSINESS_FROM, BUSINESS_TO = 9, 17
INPUT = ["id", "timestamp", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "packet_size", "flags"]


def spread(n: Column, total: Column, squares: Column) -> Column:
    """n * sum(x^2) - sum(x)^2 without overflow: n^2 times the population variance."""
    n, total = n.cast("decimal(18,0)"), total.cast("decimal(28,0)")
    return (n * squares.cast("decimal(38,0)") - total * total).cast("double")


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _row_marks() -> dict[str, Column]:
    """Per packet: the 0/1 marks whose counts the ratios need."""
    tcp_flags = (F.col("protocol") == "TCP") & (F.coalesce("flags", F.lit("")) != "")
    hour = F.hour("timestamp")
    mark = lambda c: F.coalesce(c, F.lit(False)).cast("bigint")
    return {
        "n_tcp": mark(F.col("protocol") == "TCP"),
        "n_udp": mark(F.col("protocol") == "UDP"),
        "n_icmp": mark(F.col("protocol") == "ICMP"),
        "n_known": mark(F.col("src_port").between(0, WELL_KNOWN)) + mark(F.col("dst_port").between(0, WELL_KNOWN)),
        "n_flags": mark(tcp_flags),
        **{f"n_{f.lower()}": mark(tcp_flags & F.col("flags").contains(f)) for f in ("SYN", "ACK", "FIN", "RST")},
        "s_hour": hour.cast("bigint"),
        "n_business": mark((hour >= BUSINESS_FROM) & (hour < BUSINESS_TO)),
    }


def _finish(c: dict[str, Column]) -> list[Column]:
    """The 22 features from counts and sums (all exact until here)."""
    n = c["n"]
    pairs = F.greatest(n - 1, F.lit(0))
    formulas = {
        "avg_packet_size": _ratio(c["s_size"], n),
        "std_packet_size": _ratio(F.sqrt(spread(n, c["s_size"], c["q_size"])), n),
        "min_packet_size": F.coalesce(c["min_size"], F.lit(0)),
        "max_packet_size": F.coalesce(c["max_size"], F.lit(0)),
        "avg_inter_arrival_time": _ratio(c["span_us"], pairs) / 1e6,
        "std_inter_arrival_time": _ratio(F.sqrt(F.greatest(spread(pairs, c["span_us"], c["q_iat"]), F.lit(0.0))), pairs)
        / 1e6,
        "packets_per_second": F.when(n >= 2, _ratio(n, c["span_us"] / F.lit(1e6))).otherwise(0.0),
        "tcp_ratio": _ratio(c["n_tcp"], n),
        "udp_ratio": _ratio(c["n_udp"], n),
        "icmp_ratio": _ratio(c["n_icmp"], n),
        "unique_src_ports": c["d_src_port"],
        "unique_dst_ports": c["d_dst_port"],
        "well_known_port_ratio": _ratio(c["n_known"], 2 * n),
        "unique_destinations": c["d_dst"],
        "unique_sources": c["d_src"],
        "avg_bytes_per_connection": _ratio(c["s_size"], c["d_pair"]),
        "syn_ratio": _ratio(c["n_syn"], c["n_flags"]),
        "ack_ratio": _ratio(c["n_ack"], c["n_flags"]),
        "fin_ratio": _ratio(c["n_fin"], c["n_flags"]),
        "rst_ratio": _ratio(c["n_rst"], c["n_flags"]),
        "hour_of_day": _ratio(c["s_hour"], n),
        "is_business_hours": _ratio(c["n_business"], n),
    }
    return [formulas[name].cast("double").alias(name) for name in FEATURES]


def _port_counts(packets: DataFrame, keys: list[str]) -> DataFrame:
    """Exact distinct ports per key: 64 ports are the bits of one BIGINT, so tasks send words, not ports."""
    entry = lambda kind, port: F.struct(
        F.lit(kind).alias("kind"), F.shiftright(port, 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(port).bitwiseAND(63)).alias("bit"))
    bits = packets.select(*keys, F.explode(F.array(entry(0, "src_port"), entry(1, "dst_port"))).alias("e"))
    words = bits.select(*keys, "e.*").groupBy(*keys, "kind", "word").agg(F.bit_or("bit").alias("bits"))
    ports = lambda kind: F.sum(F.when(F.col("kind") == kind, F.bit_count("bits").cast("bigint")))
    return words.groupBy(*keys).agg(ports(0).alias("d_src_port"), ports(1).alias("d_dst_port"))


def features(idx: Indexed, keys: Sequence[str] = ()) -> DataFrame:
    """One feature row per key (one row of zeros for an empty keyless input).

    Inter-arrival times are taken inside each key by way of blocks; sums are one aggregation with map-side combine, so a
    key that owns most packets is still reduced by all tasks. Distinct counts are taken apart, from narrow rows that are
    reduced first: ports as bits of words, addresses from the distinct (source, destination) pairs. No packet is repeated
    with all its columns for a count.
    """
    keys = list(keys)
    marks = list(_row_marks())
    rows = ordering.inter_arrival(idx, keys, out="iat_us").df.withColumns(_row_marks())
    iat = F.col("iat_us").cast("decimal(18,0)")
    size = F.col("packet_size").cast("decimal(18,0)")
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum("packet_size").alias("s_size"),
        F.sum((size * size).cast("decimal(28,0)")).alias("q_size"),
        F.min("packet_size").alias("min_size"),
        F.max("packet_size").alias("max_size"),
        net.micros_between(F.min("timestamp"), F.max("timestamp")).alias("span_us"),
        F.sum((iat * iat).cast("decimal(28,0)")).alias("q_iat"),
        *[F.sum(m).alias(m) for m in marks],
    )
    pairs = idx.df.select(*keys, F.col("src_ip").alias("_src"), F.col("dst_ip").alias("_dst")).distinct()
    senders = pairs.groupBy(*keys, "_src").agg(F.count_if(F.col("_dst").isNotNull()).alias("_n"))
    counts = [
        _port_counts(idx.df, keys),
        senders.groupBy(*keys).agg(F.count("_src").alias("d_src"), F.sum(F.when(F.col("_src").isNotNull(), F.col("_n"))).alias("d_pair")),
        pairs.select(*keys, "_dst").distinct().groupBy(*keys).agg(F.count("_dst").alias("d_dst")),
    ]
    grouped = sums
    for table in counts:
        names = [c for c in table.columns if c not in keys]
        if keys:
            table = table.withColumnsRenamed({k: f"_k_{k}" for k in keys})
            same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
            grouped = grouped.join(table, same, "left").drop(*[f"_k_{k}" for k in keys])
        else:
            grouped = grouped.select("*", *[table.select(name).scalar().alias(name) for name in names])
    grouped = grouped.fillna(0, ["d_src_port", "d_dst_port", "d_src", "d_pair", "d_dst"])
    columns = {c: F.col(c) for c in grouped.columns if c not in keys}
    return grouped.select(*keys, F.col("n").alias("packets"), *_finish(columns))


def index_packets(packets: DataFrame, **options) -> Indexed:
    """With a ``store``, the packets are worked out once and not again for the range bounds."""
    rows = packets.select(*INPUT)
    return ordering.with_global_index(options["store"](rows) if "store" in options else rows, **options)


def features_all(packets: DataFrame) -> DataFrame:
    return features(index_packets(packets))


def features_windowed(packets: DataFrame | Indexed, seconds: int = 60, slide: int | None = None) -> DataFrame:
    """Features per aligned event-time window, tumbling or sliding."""
    idx = packets if isinstance(packets, Indexed) else index_packets(packets)
    window = F.window("timestamp", f"{seconds} seconds", f"{slide or seconds} seconds")
    rows = idx.df.withColumn("_w", window).withColumn("window_start", F.col("_w.start")).drop("_w")
    return features(idx.replace(rows), ["window_start"])


def features_of_windows(packets: DataFrame) -> DataFrame:
    """Features per window of packets that carry their ``window_start``, once for every window they lie in."""
    return features(ordering.with_global_index(packets.select(*INPUT, "window_start")), ["window_start"])


def features_anchored(packets: DataFrame | Indexed, seconds: float = 5.0) -> DataFrame:
    """Features per anchored window (each opens at its first packet)."""
    idx = packets if isinstance(packets, Indexed) else index_packets(packets)
    return features(anchored_windows(idx, seconds), ["window_start"])


def features_by_ip(packets: DataFrame, direction: str = "src", seconds: int | None = None) -> DataFrame:
    """Features per address as sender, receiver or either (a packet counts once per address)."""
    ip = {
        "src": F.array("src_ip"),
        "dst": F.array("dst_ip"),
        "both": F.array_distinct(F.array("src_ip", "dst_ip")),
    }.get(direction)
    if ip is None:
        raise ValueError(f"unknown direction {direction!r}")
    idx = index_packets(packets)
    rows = idx.df.withColumn("ip", F.explode(ip))
    keys = ["ip"]
    if seconds is not None:
        rows = rows.withColumn("_w", F.window("timestamp", f"{seconds} seconds")).withColumn(
            "window_start", F.col("_w.start")
        ).drop("_w")
        keys.append("window_start")
    return features(idx.replace(rows), keys)


# --- trailing buffer -------------------------------------------------------------

DISTINCT = {
    "d_src_port": ["src_port"],
    "d_dst_port": ["dst_port"],
    "d_src": ["src_ip"],
    "d_dst": ["dst_ip"],
    "d_pair": ["src_ip", "dst_ip"],
}


def features_trailing(idx: Indexed, seconds: int = 30, every: int = 1) -> DataFrame:
    """Features of the last ``seconds`` at every ``every``-th packet, linear in the packets.

    The live packets of a moment are a run of the index, so their counts are differences of running sums: those at
    the moment's packet less those before the oldest live one. A value is counted distinct by its arrival when no live
    packet already has it, and leaves with the packet that no later one has renewed. Minimum and maximum
    come from tiles of one window length: the part of the current tile so far and
    the rest of the previous tile from the oldest live packet on. No packet is
    ever paired with the packets of its window. The index must hold all its positions.
    """
    span = seconds * 1_000_000
    # A block is sorted once per distinct count, so blocks are kept small enough to fall evenly on the tasks.
    idx = Indexed(idx.df, min(idx.block_rows, TRAILING_BLOCK), idx.total)
    with scratch_tables(idx.df.sparkSession) as store:
        oldest = store(_oldest_live(idx, seconds, every, store))
        sums, carry = _running_amounts(idx, span, every, oldest, store)
        return cut(_live(sums, carry, oldest, every))


def _oldest_live(idx: Indexed, seconds: int, every: int, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(i, oldest): the position of the oldest packet that is live at every ``every``-th one.

    On the time line of these moments and of all departures, a moment's place less the moments up to it is the number
    of packets gone; one beyond the last position, if all are gone.
    """
    moments = idx.df.where(F.col("i") % every == 0).select(
        F.col("timestamp").alias("at"), F.lit(1).alias("kind"), F.col("i").alias("pos")
    )
    departures = idx.df.select(
        F.timestamp_add("SECOND", F.lit(seconds), F.col("timestamp")).alias("at"), F.lit(0).alias("kind"),
        F.col("i").alias("pos"),
    )
    line = ordering.with_global_index(moments.unionByName(departures), order=("at", "kind", "pos"), store=store)
    gone = F.col("i") - F.floor(F.col("pos") / F.lit(every)).cast("bigint")
    return line.df.where("kind = 1").select(F.col("pos").alias("i"), (gone + 1).alias("oldest"))


def _running_amounts(
    idx: Indexed, span: int, every: int, oldest: DataFrame, store: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Sums of the block so far, at the packets asked for, and per block the sums of all blocks before it.

    ``to_x`` includes the row, ``before_x`` does not. Asked for are every ``every``-th packet and the oldest live ones.
    """
    def fresh(name: str, side: str) -> Column:
        """1 unless the neighbouring packet of the same value is within the span."""
        return F.coalesce((F.col(f"{name}_{side}_us") >= span).cast("bigint"), F.lit(1).cast("bigint"))

    tiled = idx.replace(
        idx.df.select(*INPUT, "i").withColumn("tile", F.floor(net.micros("timestamp") / F.lit(span)).cast("bigint"))
    )
    wanted = oldest.select(F.col("oldest").alias("i")).distinct().withColumn("_wanted", F.lit(True))
    rows = tiled.df.join(wanted.hint("shuffle_hash"), "i", "left").withColumn("_block", idx.block())
    rows = rows.repartition(max(-(-idx.total // idx.block_rows), 1), "_block")  # tasks of few blocks, evenly dealt
    rows = ordering.neighbour_gaps(tiled, {"all": [], **DISTINCT}, within=span, rows=rows).df
    rows = ordering.running_extremes(tiled, ["tile"], "packet_size", rows=rows).df
    size = F.coalesce("packet_size", F.lit(0)).cast("decimal(18,0)")
    iat = F.coalesce(F.col("all_prev_us"), F.lit(0)).cast("decimal(18,0)")
    amounts = {
        "s_size": size,
        "q_size": (size * size).cast("decimal(28,0)"),
        "q_iat": (iat * iat).cast("decimal(28,0)"),
        **_row_marks(),
        **{f"{d}_{side}": fresh(d, side) for d in DISTINCT for side in ("prev", "next")},
    }
    so_far = W.partitionBy("_block").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumns({f"own_{x}": c for x, c in amounts.items()})
    rows = rows.withColumns({f"to_{x}": F.sum(f"own_{x}").over(so_far) for x in amounts})
    last = (F.col("i") % idx.block_rows == 0) | (F.col("i") == idx.total)
    kept = rows.where((F.col("i") % every == 0) | F.col("_wanted") | last)
    sums = store(kept.select(
        "i", "_block", "id", "timestamp", "tile", "so_far_low", "so_far_high", "rest_low", "rest_high", "own_q_iat",
        *[f"to_{x}" for x in amounts], *[(F.col(f"to_{x}") - F.col(f"own_{x}")).alias(f"before_{x}") for x in amounts],
    ))
    earlier = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carry = sums.where(last).select(
        "_block", *[F.coalesce(F.sum(f"to_{x}").over(earlier), F.lit(0)).alias(f"c_{x}") for x in amounts]
    )
    return sums, F.broadcast(carry)


def _live(sums: DataFrame, carry: DataFrame, oldest: DataFrame, every: int) -> DataFrame:
    """The features at every ``every``-th packet from the running sums there and at its oldest live packet."""
    amounts = [c[2:] for c in carry.columns if c.startswith("c_")]
    whole = sums.join(carry, "_block")
    at = whole.where(F.col("i") % every == 0).select(
        "i", "id", "timestamp", "tile", "so_far_low", "so_far_high",
        *[(F.col(f"to_{x}") + F.col(f"c_{x}")).alias(f"to_{x}") for x in amounts],
    )
    start = whole.select(
        F.col("i").alias("oldest"), F.col("timestamp").alias("_timestamp"), F.col("tile").alias("_tile"), "rest_low",
        "rest_high", F.col("own_q_iat").alias("_q"),
        *[(F.col(f"before_{x}") + F.col(f"c_{x}")).alias(f"before_{x}") for x in amounts],
    )
    met = at.join(oldest, "i").join(start, "oldest", "left")
    past = lambda to, before: F.col(f"to_{to}") - F.col(f"before_{before}")
    from_before = F.col("_tile") < F.col("tile")
    columns = {
        "n": F.col("i") - F.col("oldest") + 1,
        **{x: past(x, x) for x in ["q_size", *_row_marks()]},
        "s_size": past("s_size", "s_size").cast("bigint"),
        "q_iat": past("q_iat", "q_iat") - F.col("_q"),
        **{d: past(f"{d}_prev", f"{d}_next") for d in DISTINCT},
        "min_size": F.when(from_before, F.least("so_far_low", "rest_low")).otherwise(F.col("so_far_low")),
        "max_size": F.when(from_before, F.greatest("so_far_high", "rest_high")).otherwise(F.col("so_far_high")),
        "span_us": net.micros_between("_timestamp", "timestamp"),
    }
    met = met.withColumns(columns)
    return met.select("id", "i", "timestamp", F.col("n").alias("packets"), *_finish({c: F.col(c) for c in columns}))
