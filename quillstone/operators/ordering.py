"""Places in an order over a whole table, without a task that sees all of it."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import python_repr
from ..sources.sinks import kept

c = F.col


def numbered(rows: DataFrame, order: list[Column], column: str = "place", start: int = 1) -> DataFrame:
    """The rows with their place in the order, from ``start`` without gaps.

    Sampled splitters deal the rows by range, each task sorts and counts its own, and what the tasks before it
    have is added: one number per partition goes through the driver. Give an order without long ties, such as one that
    ends in an id: equal keys lie in one partition.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = kept(dealt.withColumns({"__part": F.spark_partition_id(), "__at": within}), "numbered")
    sizes = sorted(tuple(r) for r in placed.groupBy("__part").count().collect())
    before = [0, *accumulate(n for _, n in sizes)]
    first = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "__part int, __first long")
    return placed.join(F.broadcast(first), "__part").withColumn(column, c("__at") + c("__first") + start).drop("__part", "__at", "__first")


def tuple_text(columns: list[str]) -> Column:
    """The text of a tuple of texts as Python writes it; null is None."""
    return F.concat(F.lit("("), F.concat_ws(", ", *[F.coalesce(python_repr(c(x)), F.lit("None")) for x in columns]), F.lit(")"))
