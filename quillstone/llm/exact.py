"""Exact dedup by content sort."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, batches, join_small, lower_az, partitions, prepare, rows_of, table, written

_RUNS = pa.schema([("id", pa.int64()), ("lead", pa.bool_()), ("lead_id", pa.int64()), ("n", pa.int64()), ("text_sha256", pa.string()), ("pid", pa.int32()), ("run", pa.int64()), ("edge", pa.int32())])
_RUNS_DDL = "id long, lead boolean, lead_id long, n long, text_sha256 string, pid int, run long, edge int"


def _runs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted partition; only the identifiers of the current run are held."""
    pid = TaskContext.get().partitionId()

    def finished(ids: list, norm: bytes, run: int, last: bool) -> Iterator[tuple]:
        sha, edge = hashlib.sha256(norm).hexdigest(), (run == 0) + 2 * last
        for k, i in enumerate(ids):
            yield i, k == 0, ids[0], len(ids), sha, pid, run, edge

    def out() -> Iterator[tuple]:
        ids, before, run = [], None, 0
        for batch in it:
            for i, norm in rows_of(batch):
                if before is not None and norm != before:
                    yield from finished(ids, before, run, False)
                    ids, run = [], run + 1
                ids.append(i)
                before = norm
        if ids:
            yield from finished(ids, before, run, True)

    yield from batches(out(), _RUNS, 5000)


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Splitters sampled by Spark range-partition the rows by the first bytes of the normalised text
    (A-Z lower-cased), its hash and the identifier; so a group of copies spreads over as many
    partitions as its size asks for. Each partition is sorted externally and neighbours are compared
    in full. Runs that meet at a partition's seam are merged by SHA-256 of the full normalised text
    from a table of at most two runs per partition.

    Null text counts as empty; empty texts are copies of each other. Rows with a null identifier sort
    last: one is kept only if its group has no other. Of repeated rows exactly one is kept. An empty
    table gives no rows. Columns other than the two are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    order = F.col("id").desc_nulls_last() if keep == "largest" else F.col("id").asc_nulls_last()
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), lower_az(F.col(text_col)).cast("binary").alias("norm"))
    keyed = keyed.select("id", "norm", F.substring("norm", 1, 16).alias("head"), F.xxhash64("norm").alias("h"))
    dealt = keyed.repartitionByRange(partitions(spark), F.col("head"), F.col("h"), order)
    dealt = dealt.sortWithinPartitions(F.col("head"), F.col("h"), F.col("norm"), order)
    runs = written(dealt.select("id", "norm").mapInArrow(_runs, _RUNS_DDL), "runs")
    seams = runs.filter("edge > 0").groupBy("pid", "run", "edge").agg(F.first("text_sha256").alias("sha"), F.max(F.when(F.col("lead"), F.col("lead_id"))).alias("lead_id"), F.count("*").alias("n"))
    fixes = _merge_seams(sorted(seams.collect(), key=lambda r: (r["pid"], r["run"])))
    fixed = F.broadcast(spark.createDataFrame(fixes, "pid int, run long, whole_id long, whole_n long, later boolean"))
    return runs.join(fixed, ["pid", "run"], "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("later").isNull(), F.col("lead_id")).otherwise(F.col("whole_id")).alias("keep_id"),
        F.coalesce("whole_n", "n").alias("group_size"),
        (F.col("lead") & ~F.coalesce("later", F.lit(False))).alias("kept"),
        "text_sha256",
    )


def _merge_seams(edges: list) -> list[tuple]:
    """Rows (partition, run, identifier and size of the whole group, whether it began earlier) for groups over several partitions."""
    out, chain = [], []

    def close() -> None:
        if len(chain) > 1:
            total = sum(r["n"] for r in chain)
            out.extend((r["pid"], r["run"], chain[0]["lead_id"], total, k > 0) for k, r in enumerate(chain))

    for r in edges:
        if chain and chain[-1]["pid"] != r["pid"] and chain[-1]["sha"] == r["sha"]:
            chain.append(r)
        else:
            close()
            chain = [r]
    close()
    return out


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The kept rows with all their columns, one of each group and one of repeated rows.

    With identifiers that are unique and not null, the dropped ones are anti-joined: as a broadcast within
    the bound, so that texts are not shuffled again. Otherwise rows are told apart by identifier and normalised text.
    """
    found = written(content_sort(docs, id_col, text_col, keep).select(F.col(id_col).alias("__id"), "kept", "text_sha256"), "found")
    plain = found.filter("__id is null").isEmpty() and found.groupBy("__id").count().filter("count > 1").isEmpty()
    if plain:
        gone = written(found.filter("not kept").select(F.col("__id").alias(id_col)), "gone")
        return join_small(docs, gone, [id_col], "left_anti").select(*docs.columns)
    kept = found.filter("kept").select(F.col("__id").alias("__kept"), F.col("text_sha256").alias("__kept_sha"))
    own = docs.withColumn("__sha", F.sha2(lower_az(F.col(text_col)).cast("binary"), 256))
    joined = own.join(kept, own[id_col].cast("long").eqNullSafe(F.col("__kept")) & (F.col("__sha") == F.col("__kept_sha")), "left_semi")
    return joined.dropDuplicates([id_col, "__sha"]).drop("__sha")


def op1_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort(table(spark, sf_dir, "documents").select("doc_id", "text"), keep="largest")


OP1_SQL = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
