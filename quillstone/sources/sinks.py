"""Sinks: appends, overwrites, upserts, atomic builds, exports."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import nul_joined
from ..operators.state import replay
from .moves import qualified, write_new_files
from .readers import exists

c = F.col


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder's name under spark.checkpoint.dir. Where that is unset, a temporary one on a single machine; an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="quillstone-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/quillstone-{tag}-{uuid.uuid4().hex}"


def kept(df: DataFrame, tag: str) -> DataFrame:
    """The rows written to the folder in spark.checkpoint.dir and read again, so that they are made once."""
    path = scratch(df.sparkSession, tag)
    with swept(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a table that may be broadcast, by count.
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A table that is written, to be broadcast if its counted rows are within the bound."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


#: Sessions in ``swept``: how many times, and the setting before.
_SWEPT: dict[SparkSession, list] = {}
_LOCK = threading.Lock()


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query are removed when it ends. Else they stay until the driver's JVM collects garbage, those of many queries side by side."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with _LOCK:
        own = _SWEPT.setdefault(spark, [0, spark.conf.get(setting, "false")])
        own[0] += 1
        spark.conf.set(setting, "true")
    try:
        yield
    finally:
        with _LOCK:
            own[0] -= 1
            if not own[0]:
                spark.conf.set(setting, _SWEPT.pop(spark)[1])


def append_jsonl(df: DataFrame, path: str) -> None:
    df.select(*sorted(df.columns)).write.mode("append").json(path)


def write_jsonl(df: DataFrame, path: str) -> int:
    df.write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(df.schema).json(path).count()


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that the pointer in ``path`` names; None before the first ``put``."""
    version = pointed(spark, path)
    return spark.read.parquet(f"{path}/{version}") if version else None


def pointed(spark: SparkSession, path: str) -> str | None:
    """The version that the pointer in ``path`` names."""
    if not exists(spark, f"{path}/_current"):
        return None
    jvm = spark.sparkContext._jvm
    pointer = jvm.org.apache.hadoop.fs.Path(f"{path}/_current")
    stream = pointer.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(pointer)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put(df: DataFrame, path: str) -> None:
    """Make ``df`` the table at ``path``: a new version is written, then the pointer is renamed over the old one, in one step.

    A reader sees the old table or the new one, and a crash leaves the old one. Old versions stay for
    readers that still use them; ``vacuum`` removes them.
    """
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    point(df.sparkSession, path, version)


def point(spark: SparkSession, path: str, version: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    draft, pointer = hadoop.Path(f"{path}/_next-{uuid.uuid4().hex}"), hadoop.Path(f"{path}/_current")
    out = pointer.getFileSystem(conf).create(draft)
    out.write(bytearray(version.encode()))
    out.close()
    over = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(pointer.getFileSystem(conf).getUri(), conf).rename(draft, pointer, over)


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove the versions that the pointer does not name; the number of them."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    now = pointed(spark, path)
    old = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("version-") and f.getPath().getName() != now]
    for found in old:
        fs.delete(found, True)
    return len(old)


def write_clustered(df: DataFrame, path: str, key: str, files: int) -> None:
    """Write ``df`` in ranges of a key, sorted, with Bloom filters on it, and beside it a table of each file's first and last key."""
    rows = df.repartitionByRange(files, key).sortWithinPartitions(key)
    rows.write.option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(f"{path}/rows")
    each = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows").groupBy(c("_metadata.file_path").alias("file"))
    each.agg(F.min(key).alias("first"), F.max(key).alias("last")).write.parquet(f"{path}/ranges")


def replace_build(df: DataFrame, path: str) -> None:
    """Replace the builds that ``df`` holds, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("build_id").parquet(path)


def guarded_overwrite(df: DataFrame, path: str) -> None:
    """Overwrite the table at ``path``, unless that would leave a table with rows empty."""
    spark = df.sparkSession
    old = current(spark, path)
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    if old is not None and spark.read.schema(df.schema).parquet(f"{path}/{version}").isEmpty() and not old.isEmpty():
        raise ValueError("refusing to replace rows by none")
    point(spark, path, version)


def flat(df: DataFrame) -> DataFrame:
    """Complex columns as compact JSON text."""
    return df.select(*[F.to_json(c(n)).alias(n) if t.startswith(("struct", "array", "map")) else c(n) for n, t in df.dtypes])


def export_table(df: DataFrame, folder: str, name: str) -> None:
    out = flat(df)
    out.write.mode("overwrite").parquet(f"{folder}/parquet/{name}")
    out.write.mode("overwrite").option("header", True).csv(f"{folder}/csv/{name}")


#: The columns of the state file, in its order.
STATE_COLUMNS = ["paper_id", "overall_status", "current_stage", "last_successful_stage", "next_stage", "is_processable", "is_complete", "is_ready_for_export", "blocked_reason", "last_error_code", "last_error_message", "has_pdf", "has_markdown", "has_structured_paper", "has_structured_blocks", "has_paper_classification", "has_experiment_map", "has_canonical_evidence", "paper_family"]


def write_state_csv(df: DataFrame, path: str) -> None:
    df.select(*[x for x in STATE_COLUMNS if x in df.columns]).write.mode("overwrite").option("header", True).csv(path)


def write_bibliography(entries: DataFrame, path: str) -> dict[str, int]:
    """Entries as text, a blank line between them; how many there are, and how many keys were changed to be unique."""
    entries.select(F.concat("entry", F.lit("\n")).alias("value")).write.mode("overwrite").text(path)
    renamed = F.count_if(c("citekey") != c("base")) if "base" in entries.columns else F.lit(0)
    n, changed = entries.agg(F.count("*"), renamed).first()
    return {"entries": n, "renamed": changed}


#: Folders over which the folders of papers are dealt, so that each can be listed by a task of its own.
SHARDS = 1024


def paper_folder(folder: str, paper_id: Column) -> Column:
    """The folder of a paper, by its hash in one of SHARDS, named as Spark names partitions."""
    text = paper_id.cast("string")
    odd = "[\\x00-\\x1f\\x7f\"#%'*/:=?\\\\{\\[\\]^]"
    coded = F.array_join(F.transform(F.split(text, ""), lambda x: F.when(x.rlike(odd), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(x)), 2, "0"))).otherwise(x)), "")
    name = F.when(text.rlike(odd), coded).when(text != "", text).otherwise("__HIVE_DEFAULT_PARTITION__")
    return F.concat(F.lit(f"{folder}/shard="), F.pmod(F.xxhash64(text), F.lit(SHARDS)), F.lit("/paper_id="), name)


def write_per_paper(rows: DataFrame, folder: str) -> int:
    """One JSON text (paper_id, payload) per paper in its own folder, those that are there left out; how many were written.

    The tasks put the files in place, each whole or not at all, and look themselves which are there: neither a commit nor a list of the
    folders passes through the driver. The files are what a run that stopped goes on from; several texts of a paper are lines of its file.
    """
    top = qualified(rows.sparkSession, folder)
    path = rows.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(top)
    path.getFileSystem(rows.sparkSession.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    line = F.concat(F.coalesce("payload", F.lit("")), F.lit("\n")).cast("binary")
    return write_new_files(rows.select(F.concat(paper_folder(top, c("paper_id")), F.lit("/payload.txt")).alias("path"), line.alias("content")))


def deliver(df: DataFrame, sink: Callable[[DataFrame], None], outbox: str, batch: int | str | None = None, record_type: str = "record") -> bool:
    """Write through ``sink``; if that fails, put the rows into the outbox for a replay.

    With a ``batch`` number the rows have its folder, so that a batch that is delivered again is stored once.
    """
    batch = uuid.uuid4().hex if batch is None else batch
    try:
        sink(df)
        return True
    except Exception as e:  # noqa: BLE001  any failure of the store goes to the outbox
        payload = F.to_json(F.struct(*df.columns))
        rows = df.select(nul_joined("outbox", F.lit(record_type), payload).alias("outbox_id"), F.lit(record_type).alias("record_type"), payload.alias("payload"), F.lit(str(e)[:500]).alias("error"), F.lit(0).alias("attempt_count"))
        rows.write.mode("overwrite").json(f"{outbox}/batch={batch}")
        return False


def replay_outbox(outbox: DataFrame, delivered: DataFrame, sinks: dict[str, Callable[[DataFrame], None]], dry_run: bool = False) -> DataFrame:
    """Deliver the outbox rows (outbox_id, record_type, payload, attempt_count) by type: the rows with outcome, error and attempts.

    Delivered before: skipped. Empty payload or a type without a sink: failed. A sink gets the rows of its type; what it
    raises is the error of these rows. A dry run calls no sink; its outcomes are what there is to do: ``pending``.
    """
    plan = kept(replay(outbox, delivered).withColumn("error", F.when(c("outcome") == "failed", "empty payload")), "replay")
    out = [plan.filter("outcome <> 'delivered'")]
    due = plan.filter("outcome = 'delivered'")
    if dry_run:
        return out[0].unionByName(due.withColumns({"outcome": F.lit("pending"), "attempt_count": c("attempt_count") - 1}))
    for kind, sink in sinks.items():
        rows = due.filter(c("record_type") == kind)
        try:
            if not rows.isEmpty():
                sink(rows)
            out.append(rows)
        except Exception as e:  # noqa: BLE001  whatever the store raises is the outcome
            out.append(rows.withColumns({"outcome": F.lit("failed"), "error": F.lit(str(e)[:500])}))
    unknown = due.filter(~F.coalesce(c("record_type").isin(list(sinks)), F.lit(False)))
    out.append(unknown.withColumns({"outcome": F.lit("failed"), "error": F.concat(F.lit("no sink for "), F.coalesce("record_type", F.lit("null")))}))
    report = out[0]
    for rows in out[1:]:
        report = report.unionByName(rows)
    return report


def sample_bundle(sample: DataFrame, evidence: DataFrame, pdfs: DataFrame) -> DataFrame:
    """Manifest of sampled papers: rows of evidence and whether a PDF is there."""
    counts = evidence.groupBy("paper_id").agg(F.count("*").alias("n_evidence"))
    have = pdfs.select("paper_id", F.lit(True).alias("has_pdf")).distinct()
    j = sample.join(counts, "paper_id", "left").join(have, "paper_id", "left")
    return j.select("paper_id", F.coalesce("n_evidence", F.lit(0)).alias("n_evidence"), c("has_pdf").isNull().alias("missing_pdf"))
