"""Files copied and moved by Spark tasks: staged, checked by hash, then renamed into place."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fnmatch import fnmatchcase
from itertools import groupby

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..shipping import ship

CHUNK = 4 << 20


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI; a plain path is local to the task, so on a cluster a mount that all share."""
    if uri.startswith("file:"):
        uri = uri.removeprefix("file:")
        return pafs.LocalFileSystem(), "/" + uri.lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def digest(fs: pafs.FileSystem, path: str) -> tuple[str, int] | None:
    """(SHA-256, bytes) of a file, read in chunks; None if there is none."""
    if fs.get_file_info(path).type != pafs.FileType.File:
        return None
    h, n = hashlib.sha256(), 0
    with fs.open_input_stream(path) as f:
        while part := f.read(CHUNK):
            h.update(part)
            n += len(part)
    return h.hexdigest(), n


def staged(fs: pafs.FileSystem, path: str) -> str:
    """Where a file is written before it takes its name: beside it, by a name of its own, so that a task that died is overwritten by its repetition."""
    folder, _, name = path.rpartition("/")
    return f"{folder}/.staging-{hashlib.sha256(name.encode()).hexdigest()[:24]}"


def placed(fs: pafs.FileSystem, path: str, chunks: Iterator[bytes]) -> str:
    """Write chunks aside, read them back, and rename; the SHA-256. A reader sees the whole file or none."""
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    aside, h = staged(fs, path), hashlib.sha256()
    with fs.open_output_stream(aside) as f:
        for part in chunks:
            h.update(part)
            f.write(part)
    found = digest(fs, aside)
    if found is None or found[0] != h.hexdigest():
        raise OSError(f"{aside} does not hold what was written")
    fs.move(aside, path)
    return h.hexdigest()


def _chunks(fs: pafs.FileSystem, path: str) -> Iterator[bytes]:
    with fs.open_input_stream(path) as f:
        while part := f.read(CHUNK):
            yield part


def moved(source: str, target: str, move: bool, overwrite: bool, starts: bytes = b"") -> tuple[str, str | None, int | None]:
    """(outcome, SHA-256 of what the target holds, bytes of the source) of one file."""
    (from_fs, a), (to_fs, b) = opened(source), opened(target)
    new, old = digest(from_fs, a), digest(to_fs, b)
    if new is None:
        return "missing", old and old[0], None
    if starts:
        with from_fs.open_input_stream(a) as f:
            if f.read(len(starts)) != starts:
                raise ValueError("the file is of another kind")
    if old == new:
        outcome, sha = "same", old[0]
    elif old is not None and not overwrite:
        return "conflict", old[0], new[1]
    else:
        outcome, sha = "copied", placed(to_fs, b, _chunks(from_fs, a))
    if move and (from_fs, a) != (to_fs, b):
        from_fs.delete_file(a)
    return outcome, sha, new[1]


def copy_files(plan: DataFrame, move: bool = False, overwrite: bool = False, starts: bytes = b"") -> DataFrame:
    """The plan (source, target, ...) with outcome, sha256, n_bytes, error: each source copied, or moved, to its target.

    copied; same (the target holds the same bytes); conflict (it holds others, and stays, unless ``overwrite``); missing (no source);
    failed, with the error: a null source or target, or a file that does not begin with ``starts``. The files are their own journal: a run that stopped is run again, and what it
    copied is the same then. A moved source goes after its target has been read back. Sources of one target are taken
    in order by one task: the first is copied, those that differ from it are conflicts. Write the result once: each action on it copies anew.
    """
    ship(plan.sparkSession)
    names = plan.columns

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for source, target in zip(b.column("source").to_pylist(), b.column("target").to_pylist()):
                try:
                    if source is None or target is None:
                        raise ValueError("source and target are required")
                    out.append((*moved(source, target, move, overwrite, starts), None))
                except Exception as e:  # noqa: BLE001  what a store raises is the outcome
                    out.append(("failed", None, None, f"{type(e).__name__}: {e}"))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)]], names=[*names, "outcome", "sha256", "n_bytes", "error"])

    schema = StructType([*plan.schema.fields]).add("outcome", "string").add("sha256", "string").add("n_bytes", "long").add("error", "string")
    dealt = plan.repartition(F.coalesce("target", "source")).sortWithinPartitions("target", "source")
    return dealt.mapInArrow(run, schema)


def write_files(rows: DataFrame) -> int:
    """Files of (path, content) put in place one by one; how many."""
    ship(rows.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                placed(*opened(path), iter([content or b""]))
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    return rows.select("path", "content").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_new_files(rows: DataFrame) -> int:
    """Files of (path, content) put in place by the tasks, those that are there left as they are; how many rows were written.

    The rows of one path follow each other in its file, in order; one task streams them. A task that is repeated counts what its first try had left.
    """
    ship(rows.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0

        def parts(own: Iterator[tuple]) -> Iterator[bytes]:
            nonlocal n
            for _, content in own:
                n += 1
                yield content or b""

        pairs = (r for b in it for r in zip(b.column("path").to_pylist(), b.column("content").to_pylist()))
        for name, own in groupby(pairs, lambda r: r[0]):
            fs, path = opened(name)
            if fs.get_file_info(path).type == pafs.FileType.NotFound:
                placed(fs, path, parts(own))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    dealt = rows.select("path", "content").repartition(_parts(rows.sparkSession), "path").sortWithinPartitions("path", "content")
    return dealt.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark takes it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _found(uri: str, deep: bool) -> Iterator[tuple[str, bool]]:
    """(URI, whether a folder) of what is in a folder, in order; names that begin with . or _ are not seen, as Spark's readers do not."""
    fs, path = opened(uri)
    top = path.rstrip("/")
    for info in sorted(fs.get_file_info(pafs.FileSelector(path, recursive=deep)), key=lambda x: x.path):
        rest = info.path[len(top) :]
        if not any(x.startswith((".", "_")) for x in rest.strip("/").split("/")):
            yield uri.rstrip("/") + rest, info.type == pafs.FileType.Directory


def listed(spark: SparkSession, folder: str, glob: str, deep: bool = False) -> DataFrame:
    """(path) of the files in a folder whose names match, with ``deep`` also of those under its folders; a missing folder is an error.

    One task lists the folder; what is in it is dealt over all tasks, and each lists what is under its own. No list goes through the driver.
    """
    ship(spark)

    def top(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for uri in b.column("path").to_pylist():
                rows = list(_found(uri, False))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_())], names=["path", "folder"])

    def under(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for uri, is_folder in zip(b.column("path").to_pylist(), b.column("folder").to_pylist()):
                rows = [uri] if not is_folder else [x for x, more in _found(uri, True) if not more] if deep else []
                yield pa.RecordBatch.from_arrays([pa.array([x for x in rows if fnmatchcase(x.rpartition("/")[2], glob)], pa.string())], names=["path"])

    root = spark.createDataFrame([(qualified(spark, folder),)], "path string")
    first = root.mapInArrow(top, "path string, folder boolean").repartition(_parts(spark), "path")
    return first.mapInArrow(under, "path string")


def contents(files: DataFrame) -> DataFrame:
    """(path, content) of files (path), dealt over all tasks and read one by one."""
    ship(files.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], names=["path", "content"])
        rows, size = [], 0
        for b in it:
            for uri in b.column("path").to_pylist():
                fs, path = opened(uri)
                with fs.open_input_stream(path) as f:
                    rows.append((uri, f.read()))
                size += len(rows[-1][1])
                if size > CHUNK or len(rows) >= 1000:
                    yield batch(rows)
                    rows, size = [], 0
        yield batch(rows)

    return files.select("path").repartition(_parts(files.sparkSession), "path").mapInArrow(run, "path string, content binary")
