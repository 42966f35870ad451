"""Anchored windows: a window opens at its first packet and holds ``seconds`` of time.

The next packet after that opens the next window, so starts form a chain that is
sequential by nature. Blocks of the global index turn it into three parallel
steps: each block computes, for every start that could enter it, where the chain
leaves; pointer doubling over those few entries finds the blocks' real entries;
each block then lists its starts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.functions import net
from packetloom.operators.ordering import Indexed
from packetloom.session import cut


def _chain(times: np.ndarray, width: int) -> np.ndarray:
    """Index of the next start for each time; the length of ``times`` if it lies outside."""
    return np.searchsorted(times, times + width, side="right")


def _crossings(width: int):
    """Per block: possible entries (times within one width of its first) and their last start inside."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        times = np.unique(pdf["_t"].to_numpy())
        following = _chain(times, width)
        n = len(times)
        jump = np.where(following == n, np.arange(n), following)
        while True:
            further = jump[jump]
            if np.array_equal(further, jump):
                break
            jump = further
        entries = min(n, int(np.searchsorted(times, times[0] + width, side="right")) + 1)
        return pd.DataFrame(
            {
                "_block": pdf["_block"].iloc[0],
                "entry": times[:entries],
                "leave": times[jump[:entries]],
                "last": times[-1],
            }
        )

    return run


def _starts(width: int):
    """Per block with an entry: every window start from there on."""

    def run(rows: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or entry.empty:
            return pd.DataFrame({"_block": pd.Series(dtype="int64"), "start": pd.Series(dtype="int64")})
        times = np.unique(rows["_t"].to_numpy())
        following = _chain(times, width)
        at, found = int(np.searchsorted(times, entry["entry"].iloc[0])), []
        while at < len(times):
            found.append(times[at])
            at = int(following[at])
        return pd.DataFrame({"_block": rows["_block"].iloc[0], "start": found})

    return run


def _entries(nodes: DataFrame, width: int) -> DataFrame:
    """(_block, entry) of the real chain, from the first packet on."""
    bounds = nodes.groupBy("_block").agg(F.max("last").alias("last")).orderBy("_block").collect()
    last_times = np.array([row["last"] for row in bounds], dtype=np.int64)

    @F.pandas_udf("bigint")
    def block_after(moment: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(last_times, moment.to_numpy(), side="right"))

    probes = (
        nodes.select("leave").distinct()
        .withColumn("at", F.col("leave") + width)
        .withColumn("_block", block_after("at"))
        .where(F.col("_block") < len(last_times))
    )
    merged = probes.select("_block", "at", "leave", F.lit(None).cast("bigint").alias("entry")).unionByName(
        nodes.select("_block", F.col("entry").alias("at"), F.lit(None).cast("bigint").alias("leave"), "entry")
    )
    # Going down in time, the entry seen last before a probe is the first one after it.
    downwards = (
        W.partitionBy("_block").orderBy(F.desc("at"), F.col("entry").asc_nulls_first())
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    landing = (
        merged.withColumn("to_entry", F.last("entry", ignorenulls=True).over(downwards))
        .where(F.col("leave").isNotNull())
        .select("leave", F.col("_block").alias("to_block"), "to_entry")
    )
    jumps = cut(nodes.join(landing, "leave").select("_block", "entry", "to_block", "to_entry"))
    first = nodes.where(F.col("_block") == 0).groupBy("_block").agg(F.min("entry").alias("entry"))
    reached, count = cut(first), 1
    while True:
        onward = reached.join(jumps, ["_block", "entry"]).select(
            F.col("to_block").alias("_block"), F.col("to_entry").alias("entry")
        )
        reached = cut(reached.unionByName(onward).distinct())
        now = reached.count()
        if now == count:
            return reached
        count = now
        further = jumps.select(
            F.col("_block").alias("to_block"), F.col("entry").alias("to_entry"),
            F.col("to_block").alias("far_block"), F.col("to_entry").alias("far_entry"),
        )
        jumps = cut(
            jumps.join(further, ["to_block", "to_entry"]).select(
                "_block", "entry", F.col("far_block").alias("to_block"), F.col("far_entry").alias("to_entry")
            )
        )


def anchored_windows(idx: Indexed, seconds: float = 5.0) -> Indexed:
    """Add ``window_start``: the time of the packet that opened the row's window."""
    width = int(round(seconds * 1_000_000))
    rows = idx.df.withColumn("_block", idx.block()).withColumn("_t", net.micros("timestamp"))
    times = rows.select("_block", "_t")
    nodes = cut(
        times.groupBy("_block").applyInPandas(
            _crossings(width), "_block BIGINT, entry BIGINT, leave BIGINT, last BIGINT"
        )
    )
    if nodes.isEmpty():
        return idx.replace(idx.df.withColumn("window_start", F.col("timestamp")))
    entries = _entries(nodes, width)
    starts = cut(
        times.groupBy("_block").cogroup(entries.groupBy("_block")).applyInPandas(
            _starts(width), "_block BIGINT, start BIGINT"
        )
    )
    # The window open at a block's beginning: the last start of any earlier block.
    blocks = nodes.select("_block").distinct().join(
        starts.groupBy("_block").agg(F.max("start").alias("start")), "_block", "left"
    )
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carried = blocks.select("_block", F.max("start").over(before).alias("start")).where(F.col("start").isNotNull())
    markers = starts.unionByName(carried).select("_block", F.col("start").alias("_t"), F.col("start").alias("_start"))
    in_time = (
        W.partitionBy("_block").orderBy("_t", F.col("i").asc_nulls_first())
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    placed = (
        rows.withColumn("_start", F.lit(None).cast("bigint"))
        .unionByName(markers, allowMissingColumns=True)
        .withColumn("_start", F.last("_start", ignorenulls=True).over(in_time))
        .where(F.col("i").isNotNull())
        .withColumn(
            "window_start",
            F.timestamp_add("MICROSECOND", F.col("_start"), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")),
        )
    )
    return idx.replace(placed.drop("_block", "_t", "_start"))
