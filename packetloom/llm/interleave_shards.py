"""Proportional stratified interleaving, with DataFrame functions only.

Rows of a source are put in a seeded random order (by md5 of seed, id, size, checksum and copy) and get the fraction
(rank + u) / rows of the source, where u in [0, 1) is the source's own offset. Sorted by that fraction the sources lie
evenly mixed, so any run of it has the mixture of the whole; the shards are equal runs.

Offsets matter for small sources: without them all sources of one row would lie side by side. Sources of equal size are
numbered in a seeded order and the k-th gets the fractional part of k times the golden ratio, so any number of them
covers the whole range evenly, and sources of one row are spread over the shards like one large source.

No order needs one task per source or one for all rows. Ranks: the md5 spreads the rows of a source (and the sources of
a size) over ``BUCKETS`` equal buckets, bucket sizes are summed beforehand, and rows are numbered inside a bucket only.
Places: the fractions are uniform in every source, so ``BUCKETS`` equal intervals of them are even too. Text stays out
of every shuffle.

Rows that agree in id, source, size and checksum are copies; they are counted first and numbered, so however many there
are they are spread like other rows. Null sources are a source of their own, null ids and texts have keys like others,
null text has size 1 and checksum 0. Empty table: no rows. Extra columns of the input do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import store

HEX_DIGITS = 3
BUCKETS = 16**HEX_DIGITS
GOLDEN = 0.6180339887498949
STEPS = 1 << 20  # of an offset, so that fractions are quotients of whole numbers
COPIES = 4_096  # numbered in one row before they are spread


def _bucket(key: str) -> F.Column:
    return F.conv(F.substring(key, 1, HEX_DIGITS), 16, 10).cast("int")


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, by ``order``, which begins with an md5) and ``members`` of the group."""
    rows = rows.withColumn("bucket", _bucket(order[0]))
    # one row per group and bucket
    counts = rows.groupBy(group, "bucket").agg(F.count("*").alias("n"))
    in_group = Window.partitionBy(group)
    starts = counts.select(
        F.col(group).alias("_g"), F.col("bucket").alias("_b"),
        (F.sum("n").over(in_group.orderBy("bucket")) - F.col("n")).alias("_before"), F.sum("n").over(in_group).alias("members"))
    placed = rows.join(starts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("bucket") == F.col("_b")))
    in_bucket = Window.partitionBy(group, "bucket").orderBy(*order)
    return placed.withColumn("rank", F.col("_before") + F.row_number().over(in_bucket) - 1).drop("_g", "_b", "_before", "bucket")


def offsets(sizes: DataFrame, seed: str) -> DataFrame:
    """(source, of_source, u) with u in 0 .. STEPS - 1 for every row of ``sizes(source, of_source)``."""
    key = F.md5(F.concat(F.lit(f"{seed}:source:"), F.coalesce(F.col("source").cast("string"), F.lit("\0"))).cast("binary"))
    ranked = numbered(sizes.withColumn("_key", key), "of_source", ["_key", "source"])
    turn = (F.col("rank") + 0.5) * GOLDEN
    return ranked.select("source", "of_source", F.floor((turn - F.floor(turn)) * STEPS).cast("long").alias("u"))


def interleave_shards(
    docs: DataFrame, shards: int = 8, seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """doc id, size, text_crc32, shard, slot of every row."""
    fields = ["id", "source", "size", "text_crc32"]
    alike = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
    ).groupBy(*fields).agg(F.count("*").alias("copies"))
    # a row that stands for very many copies is cut up and dealt out before it is repeated
    runs = alike.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES))).alias("run"))
    few, many = runs.where(F.col("copies") <= COPIES), runs.where(F.col("copies") > COPIES).repartition("id", "run")
    first = F.col("run") * COPIES
    last = F.least(first + COPIES, F.col("copies")) - 1
    each = few.unionByName(many).select(*fields, F.explode(F.sequence(first, last)).alias("copy"))
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("id", "size", "text_crc32", "copy")])
    keyed = store(each.withColumn("key", F.md5(text.cast("binary"))), "keyed")
    sizes = store(offsets(keyed.groupBy("source").agg(F.count("*").alias("of_source")), seed), "offsets")
    ranked = numbered(keyed, "source", ["key", *fields, "copy"]).drop("members")
    own = sizes.withColumnRenamed("source", "_source")
    fraction = (F.col("rank") * STEPS + F.col("u")) / (F.col("of_source") * STEPS)
    ranked = store(
        ranked.join(own, F.col("source").eqNullSafe(F.col("_source"))).withColumn("fraction", fraction)
        .select(*fields, "rank", "fraction", F.floor(F.col("fraction") * BUCKETS).cast("int").alias("interval")), "ranked")
    total = ranked.count()
    per_interval = ranked.groupBy("interval").agg(F.count("*").alias("n"))
    # at most BUCKETS rows
    starts = per_interval.select(
        F.col("interval").alias("i"), (F.sum("n").over(Window.orderBy("interval")) - F.col("n")).alias("offset"))
    in_interval = Window.partitionBy("interval").orderBy("fraction", "source", "rank")
    position = F.col("offset") + F.row_number().over(in_interval) - 1
    cut = (
        ranked.join(starts, F.col("interval") == F.col("i"))
        .withColumn("position", position)
        .withColumn("shard", F.expr(f"CAST(position * {shards} DIV {max(total, 1)} AS INT)"))
    )
    begin = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}) DIV {shards}")
    return cut.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("position") - begin).alias("slot"))
