"""Pairs of rows that share a list, for lists of any length, compared many at a time.

A task gets whole lists, or of a long list all rows of which one piece are its own, sorted by size of the set. A row
meets the larger ones up to the size that the threshold allows, a run of the rows behind it. Runs of many rows and lists
are laid out as two index arrays and go through the bounds together: components first, then sizes and positions, then
the operator's own. No pair becomes a row before it has passed them. Every pair is met once per list, in the piece of
its first row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import arrow_schema, batch_of

AT_ONCE = 1 << 14  # pairs; their bits are copied, 256 bytes a row

Columns = dict[str, np.ndarray]
Passing = Callable[[Columns, np.ndarray, np.ndarray], np.ndarray]


def whole_lists(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows sorted by list and piece, in tables that end where a list or piece ends."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        of, piece = batch.column(key).to_numpy(), batch.column("piece").to_numpy()
        if held and last != (of[0], piece[0]):
            yield pa.Table.from_batches(held)
            held = []
        starts = np.flatnonzero((of[1:] != of[:-1]) | (piece[1:] != piece[:-1])) + 1
        if len(starts):
            yield pa.Table.from_batches([*held, batch.slice(0, int(starts[-1]))])
            held = []
            batch = batch.slice(int(starts[-1]))
        held.append(batch)
        last = (of[-1], piece[-1])
    if held:
        yield pa.Table.from_batches(held)


def columns_of(table: pa.Table) -> Columns:
    """Arrays by column; of a column of arrays of one length a matrix, of other ones a list of theirs and their lengths."""
    out: Columns = {}
    for name in table.column_names:
        column = table.column(name).combine_chunks()
        if pa.types.is_list(column.type):
            out[f"{name}_lengths"] = column.value_lengths().to_numpy(zero_copy_only=False)
            column = column.flatten()
        out[name] = column.to_numpy(zero_copy_only=False)
    return out


def runs(rows: Columns, key: str, percent: int) -> np.ndarray:
    """For every row the end of the run of rows behind it, of its list, that are small enough to be linked to it."""
    of, piece, n, at = rows[key], rows["piece"], rows["n"], rows["at"]
    which = np.concatenate([[0], np.cumsum((of[1:] != of[:-1]) | (piece[1:] != piece[:-1]))])
    wide = int(n.max()) + 1
    # (100 + percent) (n - at) >= percent (n + n2), see near
    most = np.minimum(np.maximum((100 + percent) * (n - at) // percent - n, -1), wide - 1)
    return np.searchsorted(which * wide + n, which * wide + most, side="right")


def near(rows: Columns, one: np.ndarray, two: np.ndarray, percent: int) -> np.ndarray:
    """Size filter and positional filter for pairs of sets that share the element at these places."""
    n, n2, at, at2 = rows["n"][one], rows["n"][two], rows["at"][one], rows["at"][two]
    sizes = 100 * np.minimum(n, n2) >= percent * np.maximum(n, n2)
    return sizes & ((100 + percent) * np.minimum(n - at, n2 - at2) >= percent * (n + n2))


def bits_between(bits: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits[one] ^ bits[two]).sum(1, dtype=np.int64)


def pairs_of(rows: Columns, key: str, percent: int, passing: Passing) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the rows of pairs, of different components and the smaller component first, that pass all bounds."""
    rows = rows | {name: rows[name].astype(np.int64) for name in ("n", "at")}
    here = np.arange(len(rows["n"]))
    count = np.where(rows["mine"], np.maximum(runs(rows, key, percent) - here - 1, 0), 0)
    until = np.cumsum(count)
    start = 0
    while start < len(here):
        done = until[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(until, done + AT_ONCE, side="right")))
        some = count[start:stop]
        one = np.repeat(here[start:stop], some)
        two = one + 1 + np.arange(len(one)) - np.repeat(until[start:stop] - some - done, some)
        apart = rows["root"][one] != rows["root"][two]
        one, two = one[apart], two[apart]
        kept = near(rows, one, two, percent)
        one, two = one[kept], two[kept]
        if len(one):
            kept = passing(rows, one, two)
            one, two = one[kept], two[kept]
        if len(one):
            turned = rows["root"][one] > rows["root"][two]
            yield np.where(turned, two, one), np.where(turned, one, two)
        start = stop


def pairs_in_lists(rows: DataFrame, key: str, node: str, percent: int, prepared: Callable[[Columns], Columns], passing: Passing) -> DataFrame:
    """(node, root, node2, root2) of the pairs that share a list and pass ``near`` and ``passing``, root < root2.

    ``rows`` has key, node, root, n, at (place of the element in the set's prefix, or 0), pieces (of the list) and what
    ``passing`` reads, once ``prepared`` has seen the columns of a run of lists. Columns of arrays hold numbers.
    """
    spark = rows.sparkSession
    dealt = rows.withColumn("own", F.pmod(F.xxhash64(node), F.col("pieces")).cast("int")).withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.col("pieces").cast("int") - 1)))
    dealt = dealt.withColumn("mine", F.col("own") == F.col("piece")).drop("own", "pieces")
    # by number: the time of a task follows pairs and not bytes, so partitions must not be put together by bytes
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(number, key, "piece").sortWithinPartitions(key, "piece", "n", node, "root")
    schema = f"{node} long, root long, {node}2 long, root2 long"
    types = arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_lists(batches, key):
            found = prepared(columns_of(table))
            for one, two in pairs_of(found, key, percent, passing):
                ends = {node: found[node][one], "root": found["root"][one], f"{node}2": found[node][two], "root2": found["root"][two]}
                yield batch_of(ends, types)

    return dealt.mapInArrow(run, schema)
