"""What the training-data operators share: session settings, written tables, text rules."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship
from ..sources.sinks import scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Rows of a side that may be broadcast. Every broadcast of data is behind a count against it.
BROADCAST_ROWS = 1_000_000


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get, so that long texts fit in memory, and send them this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write as Parquet into the folder in spark.checkpoint.dir and read again: lineage ends, lost executors cost nothing.

    Where that is unset, a temporary folder takes its place on a single machine, as in tests; on a cluster it is an error.
    """
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join; ``small`` (a written table) is broadcast if its counted rows are within the bound, else shuffled."""
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, how)


#: Rows of one key that may meet in a task of a join with a table of counted keys.
HOT_ROWS = 1000


def join_counted(rows: DataFrame, counted: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join with a written table of one row per key, whose ``size`` is the key's number of rows.

    Keys over HOT_ROWS come as a broadcast, so that their rows stay where they are; the others are shuffled. There is
    at most one hot key in HOT_ROWS rows; should even these exceed the bound of a broadcast, all are shuffled.
    """
    hot = counted.filter(F.col("size") > HOT_ROWS)
    if not 0 < hot.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(counted, on, how)
    apart = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(counted.filter(F.col("size") <= HOT_ROWS), on, how)
    return rows.join(F.broadcast(hot), on).unionByName(apart)


def join_sized(rows: DataFrame, counted: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """``join_small`` within the bound of a broadcast, else ``join_counted``; without the column ``size``."""
    if counted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(counted.drop("size")), on, how)
    return join_counted(rows, counted, on, how).drop("size")


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def crc_mod(key: Column, n: int, remainder: int) -> Column:
    """crc32 of the key as text modulo n is the remainder; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % n == remainder, F.lit(False))


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns))


def batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``most`` rows and about 4 MB from tuples."""
    kept: list[tuple] = []
    size = 0
    for row in rows:
        kept.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if len(kept) >= most or size > 4 << 20:
            yield _batch(kept, schema)
            kept, size = [], 0
    if kept:
        yield _batch(kept, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def by_key(rows: Iterator[tuple], n: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Groups of consecutive rows that share their first n values."""
    key, kept = None, []
    for row in rows:
        if row[:n] != key and kept:
            yield key, kept
            kept = []
        key = row[:n]
        kept.append(row[n:])
    if kept:
        yield key, kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
