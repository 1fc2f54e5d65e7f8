"""Sharding by extendible hashing, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_counted, table, written

#: Bits of an address: the first 15 hexadecimal digits of MD5 of the key as text.
BITS = 60
#: Bytes of text a shard of the query may hold.
SHARD_BYTES = 1 << 20


def extendible_shards(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """One row per input row: key, shard (its bits), depth, n_bytes, shard_bytes, shard_docs, overflow.

    A row's address is the leading bits of MD5 of its key. The directory starts at depth 0; a bucket
    over ``limit`` bytes is split on its next bit, others are left alone. Bucket sizes of all depths
    come from one histogram of cells at a depth somewhat beyond the expected one; only rows in cells
    that are still oversized there enter another, deeper round.

    Null text has 0 bytes; a null key is the key ''. Rows that share a key share an address: a bucket of
    one address that exceeds the limit cannot be split, and is returned at the full depth with
    overflow true. An empty table gives no rows. Other columns are not read.
    """
    key = F.col(key_col)
    address = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")
    rows = written(docs.select(key.alias(key_col), address.alias("a"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")), "addresses")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    start, bits = 0, min(BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + 4)
    found = []
    while True:
        cell = F.shiftright("a", BITS - bits)
        cells = rows.groupBy(cell.alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs"))
        depths = cells.select("*", F.explode(F.sequence(F.lit(start), F.lit(bits))).alias("depth"))
        depths = depths.withColumn("prefix", F.expr(f"shiftright(cell, {bits} - depth)"))
        sizes = depths.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
        fits = sizes.filter((F.col("shard_bytes") <= limit) | (F.col("depth") == BITS))
        best = depths.join(fits, ["depth", "prefix"]).groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_docs")).alias("s"), F.max("docs").alias("size"))
        best = written(best.select("cell", "s.*", "size"), "directory")
        placed = join_counted(rows.withColumn("cell", cell), best, "cell", "left").drop("size")  # rows of one key are one cell, and stay where they are
        found.append(placed.filter("depth is not null"))
        if bits == BITS:
            break
        rows = written(placed.filter("depth is null").select(rows.columns), "rest")
        if rows.isEmpty():
            break
        start, bits = bits + 1, min(BITS, bits + 8)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(
        key_col,
        F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("lpad(bin(prefix), depth, '0')")).alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        "n_bytes",
        "shard_bytes",
        "shard_docs",
        (F.col("shard_bytes") > limit).alias("overflow"),
    )


def write_shards(docs: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text", limit: int = SHARD_BYTES) -> None:
    """Write whole rows as one folder per shard. Rows that share a key go to the same shard."""
    where = extendible_shards(docs, key_col, text_col, limit).select(F.col(key_col).alias("__key"), "shard").distinct()
    docs.join(where, docs[key_col].eqNullSafe(F.col("__key"))).drop("__key").repartition("shard").write.partitionBy("shard").parquet(path)


def op2_extendible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_shards(table(spark, sf_dir, "documents"))


OP2_SQL = f"""
WITH b AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS a,
                  CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes FROM documents),
l AS (SELECT doc_id, n_bytes, d, a >> ({BITS} - d) AS p FROM b, (SELECT CAST(range AS INTEGER) AS d FROM range({BITS + 1}))),
s AS (SELECT d, p, sum(n_bytes) AS shard_bytes, count(*) AS shard_docs FROM l GROUP BY d, p),
f AS (SELECT l.doc_id, l.n_bytes, l.d, l.p, shard_bytes, shard_docs,
             row_number() OVER (PARTITION BY l.doc_id ORDER BY l.d) AS r
      FROM l JOIN s ON l.d = s.d AND l.p = s.p WHERE shard_bytes <= {SHARD_BYTES} OR l.d = {BITS})
SELECT doc_id, CASE WHEN d = 0 THEN '' ELSE lpad(bin(p), d, '0') END AS shard, d AS depth, n_bytes,
       CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_docs, shard_bytes > {SHARD_BYTES} AS overflow
FROM f WHERE r = 1
"""
