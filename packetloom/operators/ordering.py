"""Order-dependent building blocks that never put all rows into one task.

``with_global_index`` numbers rows by range partitioning; everything else works
on *blocks*, fixed-length runs of that index. A block has at most
``block_rows`` rows whatever the keys look like, so a source, window or
timestamp that holds most of the data is spread over many tasks. State that
crosses a block edge travels as one small row per (block, key).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from packetloom.session import cut

ORDER = ("timestamp", "id")
MIN_BLOCK, MAX_BLOCK = 4_096, 1_000_000


class Indexed:
    """A packet table with its 1-based global position and block length."""

    def __init__(self, df: DataFrame, block_rows: int, total: int):
        self.df = df
        self.block_rows = block_rows
        self.total = total

    def block(self, column: str = "i") -> Column:
        return F.floor((F.col(column) - 1) / F.lit(self.block_rows)).cast("bigint")

    def replace(self, df: DataFrame) -> "Indexed":
        return Indexed(df, self.block_rows, self.total)


def with_global_index(
    df: DataFrame,
    order: Sequence[str] = ORDER,
    partitions: int | None = None,
    block_rows: int | None = None,
    store: Callable[[DataFrame], DataFrame] = cut,
) -> Indexed:
    """Number all rows in ``order`` as column ``i``.

    One range shuffle, sorted inside partitions; the position within a partition
    is known without a window. The result is written out because the partition
    offsets and the rows must come from the same placement. The offsets are one
    row per partition, a size bounded by the partition count. ``store`` writes it out.
    """
    spark = df.sparkSession
    # Without a number AQE may merge neighbouring small ranges, which keeps the order.
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = store(
        ranged
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33).cast("int"))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_at")
    )
    counts = placed.groupBy("_part").agg((F.max("_row") + 1).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if block_rows is None:
        spread = max(total // max(2 * spark.sparkContext.defaultParallelism, 1), 1)
        block_rows = min(max(spread, MIN_BLOCK), MAX_BLOCK)
    indexed = (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("i", F.col("_offset") + F.col("_row") + 1)
        .drop("_part", "_row", "_offset")
    )
    return Indexed(indexed, block_rows, total)


def running_sums(idx: Indexed, keys: Sequence[str], sums: dict[str, Column], block: str = "_block") -> Indexed:
    """Running sums per key in index order, current row included.

    Inside a block an ordinary window does the work. Each (block, key) total is
    one row; its exclusive running sum over the blocks of the key is what the
    rows of the next blocks must add. Only keys that continue from an earlier
    block produce such a row, so the joined side stays small.
    """
    rows = idx.df.withColumn(block, idx.block())
    group = [block, *keys]
    inside = W.partitionBy(*group).orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = rows.groupBy(*group).agg(*[F.sum(expr).alias(f"_t_{name}") for name, expr in sums.items()])
    earlier = W.partitionBy(*keys).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(
        *group,
        F.count("*").over(earlier).alias("_blocks"),
        *[F.sum(f"_t_{name}").over(earlier).alias(f"_c_{name}") for name in sums],
    ).where("_blocks > 0")
    local = rows.withColumns({name: F.sum(expr).over(inside) for name, expr in sums.items()})
    joined = local.join(carry.drop("_blocks"), group, "left").withColumns(
        {name: F.col(name) + F.coalesce(f"_c_{name}", F.lit(0)) for name in sums}
    )
    return idx.replace(joined.drop(block, *[f"_c_{name}" for name in sums]))


def with_halo(idx: Indexed, rows_before: int, block: str = "_block", own: str = "_own") -> DataFrame:
    """Blocks that also hold the last ``rows_before`` rows of the preceding index range.

    A row lands in its own block and as context (``own`` false) in every block
    that starts within ``rows_before`` positions after it.
    """
    size = idx.block_rows
    last = F.floor((F.col("i") - 1 + rows_before) / F.lit(size)).cast("bigint")
    rows = idx.df.withColumn("_home", idx.block()).withColumn(
        block, F.explode(F.sequence(F.col("_home"), F.greatest(F.col("_home"), last)))
    )
    return rows.withColumn(own, F.col(block) == F.col("_home")).drop("_home")


def neighbour_gaps(
    idx: Indexed, key_sets: dict[str, Sequence[str]], ts: str = "timestamp", within: int | None = None,
    rows: DataFrame | None = None,
) -> Indexed:
    """Microseconds from the previous and to the next row of each key, NULL at the ends.

    For every entry ``name: keys`` adds ``<name>_prev_us`` and ``<name>_next_us``.
    A neighbour inside the block comes from an ordinary window; at a block edge it
    is the key's last (first) time in the nearest earlier (later) block, one row
    per (block, key). All of these come from the same input, so asking for several
    key sets costs one shuffle each and the plan grows linearly.

    ``within`` says that gaps of that many microseconds and more are all the same to the caller, for an index in order
    of ``ts``: then only rows that near to an edge of their block are looked at for neighbours across it, and a farther
    one reads as NULL. ``rows`` are those of the index with ``_block`` and further columns, for use in place of them;
    they keep ``_block``.
    """
    base = idx.df.withColumn("_block", idx.block())
    out = base if rows is None else rows
    at_edges = base
    if within is not None:
        ends = base.groupBy("_block").agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"))
        used = dict.fromkeys(["_block", "i", ts, *[k for keys in key_sets.values() for k in keys]])
        gap = lambda start, end: F.timestamp_diff("MICROSECOND", start, end)
        near = (gap(F.col("_from"), F.col(ts)) < within) | (gap(F.col(ts), F.col("_to")) < within)
        at_edges = cut(base.join(F.broadcast(ends), "_block").where(near).select(*used))
    for name, keys in key_sets.items():
        group = ["_block", *keys]
        # where many keys are told apart, a hash leads the sort: its prefix does so without a look at the rows
        lead = [F.xxhash64(*keys)] if keys and within is not None else []
        inside = W.partitionBy(*lead, *group).orderBy("i")
        across = (W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy("_block")
        source = at_edges if keys else base
        edges = source.groupBy(*group).agg(F.min_by(ts, "i").alias("_first"), F.max_by(ts, "i").alias("_last"))
        carry = edges.withColumns(
            {"_before": F.lag("_last").over(across), "_after": F.lead("_first").over(across)}
        ).where(F.col("_before").isNotNull() | F.col("_after").isNotNull())
        if within is not None and keys:
            carry = carry.where(
                (gap(F.col("_before"), F.col("_first")) < within) | (gap(F.col("_last"), F.col("_after")) < within)
            )
        carry = carry.drop("_first", "_last")
        out = (
            out.withColumns({"_prev": F.lag(ts).over(inside), "_next": F.lead(ts).over(inside)})
            .join(carry if keys else F.broadcast(carry), group, "left")
            .withColumns(
                {
                    f"{name}_prev_us": F.timestamp_diff("MICROSECOND", F.coalesce("_prev", "_before"), F.col(ts)),
                    f"{name}_next_us": F.timestamp_diff("MICROSECOND", F.col(ts), F.coalesce("_next", "_after")),
                }
            )
            .drop("_prev", "_next", "_before", "_after")
        )
    return idx.replace(out.drop("_block") if rows is None else out)


def inter_arrival(idx: Indexed, keys: Sequence[str] = (), ts: str = "timestamp", out: str = "iat_us") -> Indexed:
    """Microseconds since the previous row of the key in index order; NULL for the first."""
    gaps = neighbour_gaps(idx, {"_g": list(keys)}, ts)
    return gaps.replace(gaps.df.withColumnRenamed("_g_prev_us", out).drop("_g_next_us"))


def running_extremes(idx: Indexed, keys: Sequence[str], column: str, rows: DataFrame | None = None) -> Indexed:
    """Minimum and maximum of ``column`` from the start of the key so far, and from here to its end.

    Adds ``so_far_low``, ``so_far_high``, ``rest_low`` and ``rest_high``, current
    row included in all four. The keys are runs of the index, so at most two of a block go on beyond it. ``rows`` as in
    ``neighbour_gaps``.
    """
    base = idx.df.withColumn("_block", idx.block())
    group = ["_block", *keys]
    totals = base.groupBy(*group).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    carries, windows = [], {}
    for side, upwards in (("so_far", True), ("rest", False)):
        position, block = (F.asc("i"), F.asc("_block")) if upwards else (F.desc("i"), F.desc("_block"))
        windows[side] = W.partitionBy(*group).orderBy(position).rowsBetween(W.unboundedPreceding, W.currentRow)
        across = W.partitionBy(*keys).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
        carries += [F.min("_lo").over(across).alias(f"_{side}_lo"), F.max("_hi").over(across).alias(f"_{side}_hi")]
    carry = totals.select(*group, *carries).where(F.col("_so_far_lo").isNotNull() | F.col("_rest_lo").isNotNull())
    joined = (base if rows is None else rows).withColumns(
        {
            f"{side}_{end}": fn(column).over(window)
            for side, window in windows.items()
            for end, fn in (("low", F.min), ("high", F.max))
        }
    ).join(F.broadcast(carry), group, "left")
    for side in windows:
        joined = joined.withColumns(
            {
                f"{side}_low": F.least(f"{side}_low", f"_{side}_lo"),
                f"{side}_high": F.greatest(f"{side}_high", f"_{side}_hi"),
            }
        ).drop(f"_{side}_lo", f"_{side}_hi")
    return idx.replace(joined.drop("_block") if rows is None else joined)


def rolling_frame(
    idx: Indexed, frame: int, sums: dict[str, Column], context: dict[str, Column] | None = None
) -> DataFrame:
    """Sums over the last ``frame`` rows, as differences of running sums inside haloed blocks.

    ``context`` columns are window expressions evaluated first (over the block in
    index order, given as a function of the window), e.g. the previous timestamp.
    Constant work per row whatever the frame length.
    """
    rows = with_halo(idx, frame)
    order = W.partitionBy("_block").orderBy("i")
    for name, make in (context or {}).items():
        rows = rows.withColumn(name, make(order))
    growing = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumns({f"_r_{name}": F.sum(expr).over(growing) for name, expr in sums.items()})
    rows = rows.withColumns({f"_l_{name}": F.lag(f"_r_{name}", frame).over(order) for name in sums})
    rows = rows.where("_own").withColumns(
        {
            name: F.coalesce(F.col(f"_r_{name}"), F.lit(0)) - F.coalesce(F.col(f"_l_{name}"), F.lit(0))
            for name in sums
        }
    )
    return rows.drop("_block", "_own", *[f"_{x}_{name}" for x in "rl" for name in sums])


def every_nth(idx: Indexed, n: int = 10) -> DataFrame:
    return idx.df.where(F.col("i") % n == 0)


def chronological_split(idx: Indexed, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """The first floor(n * percent / 100) rows and the rest."""
    edge = idx.total * train_percent // 100
    return idx.df.where(F.col("i") <= edge), idx.df.where(F.col("i") > edge)
