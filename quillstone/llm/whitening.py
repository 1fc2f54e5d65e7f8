"""Embedding whitening by a covariance in two passes."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, table, written

#: An entry c counts as the whole number floor(SCALE * c).
SCALE = 256
COMPONENTS = 4
_MOST = float(1 << 62)


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: the number of points, their exact sums, components by falling eigenvalue, and how far whitened points are from unit covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - sums) squared of each row, exact; None beyond 64 bits."""
        if not len(x):
            return []
        most = max(abs(int(x.max())), abs(int(x.min()))) * self.n + max(map(abs, self.sums))
        if most < 1 << 62:
            d = x * self.n - np.array(self.sums, dtype=np.int64)
            near = np.square(d.astype(np.float64)).sum(axis=1)
            if near.max() < 9e18:
                return np.square(d).sum(axis=1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist())
        return [v if v < 1 << 63 else None for v in exact]


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row in the narrowest of three widths that holds it: equal rows have equal bytes."""
    most = np.maximum(np.abs(x.max(axis=1)), np.abs(x.min(axis=1))) if x.shape[1] else np.zeros(len(x))
    return [b"\x02" + r.astype("<i2").tobytes() if m < 1 << 15 else b"\x04" + r.astype("<i4").tobytes() if m < 1 << 31 else b"\x08" + r.astype("<i8").tobytes() for r, m in zip(x, most)]


def _unpacked(column: pa.Array, d: int) -> np.ndarray:
    """Rows of packed vectors as a matrix."""
    found = column.to_pylist()
    out = np.empty((len(found), d), dtype=np.int64)
    width = np.array([f[0] for f in found])
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        out[rows] = np.frombuffer(b"".join(found[r][1:] for r in rows), dtype=f"<i{w}").reshape(len(rows), d)
    return out


def _quantiser(scale: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            lists = b.column(1)
            lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            values = lists.flatten()  # of null lists nothing
            bad = values.is_null().to_numpy(zero_copy_only=False)
            c = values.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                c = np.floor(c * scale)
                bad = bad | ~(np.abs(c) < _MOST)
            starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
            faults = np.concatenate([[0], np.cumsum(bad)])
            whole = np.flatnonzero((lengths >= 0) & (faults[starts + np.maximum(lengths, 0)] == faults[starts]))
            packed: list[bytes | None] = [None] * len(lengths)
            x = np.where(bad, 0, c).astype(np.int64)
            for d in np.unique(lengths[whole]):
                rows = whole[lengths[whole] == d]
                for r, v in zip(rows, _packed(x[starts[rows][:, None] + np.arange(d)])):
                    packed[r] = v
            keep = pa.array(whole)
            yield pa.RecordBatch.from_arrays([b.column(0).take(keep), pa.array([packed[r] for r in whole], pa.binary()), pa.array(lengths[whole].astype(np.int32))], names=["id", "x", "d"])

    return run


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> tuple[DataFrame, int]:
    """(rows id, x of the whole vectors as a written table, their dimension).

    Left out are vectors that are null, hold a null or non-finite entry, or one whose whole number has over 62 bits,
    and those of another dimension than most have (of equally frequent dimensions, the largest).
    """
    prepare(vectors.sparkSession)
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = written(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).mapInArrow(_quantiser(scale), f"id {kind}, x binary, d int"), "vectors")
    most = rows.filter("d > 0").groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most["d"] if most else 0
    return rows.filter(F.col("d") == d).select("id", "x"), d


def _merged(points: DataFrame, each, merge, zero):
    """One partial result of each partition, merged in a tree on the executors. each: from a partition's matrices to its result as bytes."""

    def partial(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([each(b.column(0) for b in it if b.num_rows)], pa.binary())], names=["part"])

    return points.mapInArrow(partial, "part binary").rdd.map(lambda r: bytes(r[0])).treeAggregate(zero, merge, merge, depth=2)


def _sums(d: int):
    def each(columns: Iterator[pa.Array]) -> bytes:
        n, sums = 0, [0] * d
        for column in columns:
            x = _unpacked(column, d)
            n += len(x)
            safe = max(abs(int(x.max())), abs(int(x.min()))) * len(x) < 1 << 62
            sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0) if safe else x.astype(object).sum(axis=0))]
        return json.dumps([n, *sums]).encode()

    return each


def _add_sums(a: bytes, b: bytes) -> bytes:
    return json.dumps([x + y for x, y in zip(json.loads(a), json.loads(b))]).encode()


def _products(d: int, centred, k: int):
    """Of centred rows the outer products, summed by matrix product; before them the sum of the rows."""

    def each(columns: Iterator[pa.Array]) -> bytes:
        out = np.zeros((k + 1, k))
        for column in columns:
            c = centred(_unpacked(column, d))
            out[0] += c.sum(axis=0)
            out[1:] += c.T @ c
        return out.tobytes()

    return each


def _add_products(a: bytes, b: bytes) -> bytes:
    return (np.frombuffer(a) + np.frombuffer(b)).tobytes()


def _covariance(points: DataFrame, d: int, n: int, centred, k: int) -> np.ndarray:
    found = np.frombuffer(_merged(points, _products(d, centred, k), _add_products, np.zeros((k + 1) * k).tobytes())).reshape(k + 1, k)
    rest = found[0] / n  # zero but for rounding
    return found[1:] / n - np.outer(rest, rest)


def fit(points: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of a written table of packed vectors x, each of which counts; None if they do not vary.

    The first pass sums whole numbers exactly, the second the outer products of rows less the mean, a matrix product a
    batch; partitions' sums are merged in a tree, so the driver gets a few matrices of the square of the dimension.
    Components whose eigenvalue is zero to double precision are not whitened and left out.
    """
    if not d:
        return None
    n, *sums = json.loads(_merged(points, _sums(d), _add_sums, json.dumps([0] * (d + 1)).encode()))
    if not n:
        return None
    mean = np.array([s / n for s in sums])
    covariance = _covariance(points, d, n, lambda x: x - mean, d)
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = [k for k in np.argsort(values)[::-1] if values[k] > d * np.finfo(float).eps * max(values[-1], 0)][:components]
    if not order:
        return None
    found = vectors[:, order].T
    found = found * np.sign(found[np.arange(len(found)), np.abs(found).argmax(axis=1)])[:, None]
    model = Whitening(n, sums, np.ascontiguousarray(found), values[order], float(np.trace(covariance)))
    unit = _covariance(points, d, n, model.project, len(order))
    return Whitening(n, sums, model.components, model.values, model.trace, float(np.abs(unit - np.eye(len(order))).max()))


def fitted(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, components: int = COMPONENTS) -> tuple[DataFrame, int, Whitening | None]:
    """(rows id and x, dimension, the whitening of their distinct vectors): copies count once, wherever they lie."""
    rows, d = quantised(vectors, id_col, vector_col, scale)
    return rows, d, fit(written(rows.select("x").distinct(), "points"), d, components)


def _applied(rows: DataFrame, d: int, model: Whitening, ddl: str, columns) -> DataFrame:
    """Rows in which ``columns`` makes the columns after the id from a batch's matrix and the broadcast model."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                yield columns(b.column(0), _unpacked(b.column(1), d), shared.value)

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {ddl}")


def _whitened(ids: pa.Array, x: np.ndarray, model: Whitening) -> pa.RecordBatch:
    w = model.project(x)
    return pa.RecordBatch.from_arrays([ids, pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))], names=["id", "whitened"])


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, components: int = COMPONENTS) -> DataFrame:
    """One row per whole vector: id, whitened (array<double>, one entry per component).

    Vectors that are null or hold null or non-finite entries are dropped, see ``quantised``. Repeated rows get a row each and count once in the fit.
    A table without vectors that differ gives no rows. Other columns are not read.
    """
    rows, d, model = fitted(vectors, id_col, vector_col, scale, components)
    if model is None:
        return rows.select(F.col("id").alias(id_col), F.lit(None).cast("array<double>").alias("whitened")).limit(0)
    return _applied(rows, d, model, "whitened array<double>", _whitened).withColumnRenamed("id", id_col)


_REPORT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _reported(ids: pa.Array, x: np.ndarray, model: Whitening) -> pa.RecordBatch:
    m, k = len(x), len(model.values)
    rows = pa.array(np.repeat(np.arange(m), k))
    columns = [
        ids.take(rows), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)), pa.array(model.deviations(x), pa.int64()).take(rows),
        pa.array(model.project(x).ravel()), pa.array(np.tile(model.values / model.trace, m)), pa.array(np.full(m * k, model.identity_error)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["id", *[x.split()[0] for x in _REPORT.split(", ")]])


def whitening_report(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, components: int = COMPONENTS) -> DataFrame:
    """One row per whole vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Rows as in ``whiten``. A deviation beyond 64 bits is null.
    """
    rows, d, model = fitted(vectors, id_col, vector_col, scale, components)
    if model is None:
        return rows.selectExpr(f"id as `{id_col}`", *[f"cast(null as {x.split()[1]}) as {x.split()[0]}" for x in _REPORT.split(", ")]).limit(0)
    return _applied(rows, d, model, _REPORT, _reported).withColumnRenamed("id", id_col)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_report(table(spark, sf_dir, "embeddings"))
