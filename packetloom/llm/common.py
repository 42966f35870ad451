"""Reading, storing and mapping tables, shared by the operators of this folder."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.session import scratch_path


ROWS_AT_ONCE = 2_000  # of an Arrow batch, so that whole texts and what is made of them stay small in memory


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ROWS_AT_ONCE rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: a cut lineage that outlives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more, and let Spark's cleaner drop shuffle files of dead plans.

    The cleaner acts when the driver's JVM collects garbage, which a driver that does little seldom does.
    """
    for path in {os.path.dirname(f) for t in tables for f in t.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    gc.collect()
    spark._jvm.System.gc()


BROADCAST_KEYS = 1 << 20  # 8 MB of keys; more are joined by a shuffle


_remembering: dict[str, Callable[[], None]] = {}


def alone(owner: str, forget: Callable[[], None]) -> None:
    """Called in a task of ``owner``: what tasks of other operators have left in this worker's memory is freed.

    A worker lives through many stages; ``forget`` frees what this owner remembers, once another one comes.
    """
    if _remembering.keys() != {owner}:
        for name in list(_remembering):
            if name != owner:
                _remembering.pop(name)()
        _remembering[owner] = forget


def few_keys(keys: DataFrame) -> DataFrame:
    """The distinct rows of ``keys``, for the right side of a join: broadcast if there are few enough, else shuffled.

    Written first, so that they are counted before the join is planned.
    """
    stored = store(keys.distinct(), "keys")
    return F.broadcast(stored) if stored.count() <= BROADCAST_KEYS else stored


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in ``gone``; where few go, no row is shuffled. Columns are as they were."""
    kept = rows.join(few_keys(gone.select(key)), key, "left_anti")
    return kept.select([F.col(f"`{c}`") for c in rows.columns])


def of_texts(fn: Callable[[list[str | None]], list], kind: str, done: Callable[[], None] | None = None) -> Callable[[Column], Column]:
    """A column of type ``kind`` from a text column, ``fn`` applied to runs of texts.

    Only the text goes to Python; all other columns of a row stay where they are, whatever they are called. ``done``
    is called when a task has seen all its texts: a worker lives on and should not hold what the task remembered.
    """

    @F.arrow_udf(kind)
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            parts = [fn(array.slice(start, ROWS_AT_ONCE).to_pylist()) for start in range(0, len(array), ROWS_AT_ONCE)]
            yield pa.array([value for part in parts for value in part], type=types.field(0).type)
        if done is not None:
            done()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    types = to_arrow_schema(StructType.fromDDL(f"value {kind}"))
    return run


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, object]], schema: str) -> DataFrame:
    """Apply ``fn`` (columns as lists in, columns out) to every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            yield batch_of(fn(part.to_pydict()), types)

    types = arrow_schema(df.sparkSession, schema)
    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def batch_of(columns: dict[str, object], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in types], schema=types)


def slices(texts: list[str], limit: int) -> Iterator[slice]:
    """Consecutive runs of texts of about ``limit`` characters together, one text at least each."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def remainder(column: str, by: int) -> F.Column:
    """crc32 of the value as text, modulo ``by``: the fixed split of rows into folds."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(by))
