"""Packing in the order of a space-filling curve."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encoder
from .common import batches, prepare, rows_of, table, written

SEQUENCE = 1024
#: Dimensions and bits of each of the Hilbert curve.
DIMS, CURVE_BITS = 3, 10
#: Tokens that one task of the range sort packs, about.
TASK_TOKENS = 8 << 20
#: Ids of a row of the sorted table: long documents are cut, so that rows, by which Spark splits the range, weigh alike.
PART = 2048
END = 0


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def directions(vocabulary: int) -> np.ndarray:
    """A fixed pseudo-random vector of DIMS dimensions for each id: the hashed projection."""
    return np.random.default_rng(9).standard_normal((vocabulary, DIMS)).astype(np.float32)


def hilbert(points: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Hilbert keys of integer points, rows of ``points``, after Skilling's transposed form."""
    x = points.T.astype(np.int64).copy()
    n, q = len(x), 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            up, p = (x[i] & q) != 0, q - 1
            t = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(up, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(vectors: np.ndarray) -> np.ndarray:
    """Mean token vectors squashed to the curve's cube, then their Hilbert keys."""
    cells = (0.5 + 0.5 * np.tanh(4 * vectors)) * (1 << CURVE_BITS)
    return hilbert(np.clip(cells, 0, (1 << CURVE_BITS) - 1).astype(np.int64))


def token_ids(texts: list[str], path: str, ranks_path: str | None, pattern: str | None) -> list[list[int]]:
    """Ids as the tokenizer file gives them without added special tokens. With the same vocabulary as ranks,
    the faster encoder takes every text but those that hold the string of an added token."""
    t = tokenizer(path)
    if ranks_path is None:
        return [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    e, added = encoder(ranks_path, pattern), [a.content for a in t.get_added_tokens_decoder().values()]
    return [t.encode(x, add_special_tokens=False).ids if any(a in x for a in added) else e.encode_ordinary(x) for x in texts]


def _tokenise(path: str, ranks_path: str | None, pattern: str | None):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = tokenizer(path).get_vocab_size()
        table = directions(size)

        def out() -> Iterator[tuple]:
            for b in it:
                rows = list(rows_of(b))
                for k in range(0, len(rows), 64):
                    part = rows[k : k + 64]
                    found = [np.asarray([*e, END], dtype="<u4") for e in token_ids([x or "" for _, x in part], path, ranks_path, pattern)]
                    keys = curve_keys(np.stack([table[f].mean(axis=0) for f in found]))
                    for (i, _), f, key in zip(part, found, keys.tolist()):
                        raw = f.astype("<u2") if size <= 65536 else f
                        for at in range(0, len(f), PART):
                            yield i, key, len(f), at, raw[at : at + PART].tobytes()

        yield from batches(out(), schema)

    return run


def curve_tokens(docs: DataFrame, path: str, ranks_path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table (doc_id, key on the curve, n, start, ids) of every document's ids with the end id, in parts of at most PART ids."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return written(rows.mapInArrow(_tokenise(path, ranks_path, pattern), "doc_id long, key long, n long, start long, ids binary"), "tokens")


_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
_PIECE_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def _fill(size: int, with_ids: bool):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, used = TaskContext.get().partitionId() << 40, 0

        def out() -> Iterator[tuple]:
            nonlocal sequence, used
            for b in it:
                for i, n, start, raw in rows_of(b):
                    ids, at = np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * min(PART, n - start) else "<u4").astype("<u4"), 0
                    while at < len(ids):
                        if used == size:
                            sequence, used = sequence + 1, 0
                        piece = ids[at : at + size - used].tobytes()
                        yield i, start + at, len(piece) // 4, zlib.crc32(piece), n, sequence, used, piece if with_ids else None
                        at, used = at + len(piece) // 4, used + len(piece) // 4

        yield from batches(out(), _PIECE, 5000)

    return run


def pack(docs: DataFrame, path: str, ranks_path: str | None = None, pattern: str | None = None, size: int = SEQUENCE, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of every document.

    A document's vector is the mean of the fixed vectors of its ids. Documents are range-sorted by their
    Hilbert key (ties by identifier) and laid one after another into sequences of ``size`` ids, cut where
    a sequence is full and where a task ends; so only the last sequence of each task of about TASK_TOKENS ids is padded.

    A null or empty text is one end id. Null identifiers pass through, repeated rows are packed each,
    other columns are not read, an empty table gives no pieces. ``ids`` is null without ``with_ids``.
    """
    tokens = curve_tokens(docs, path, ranks_path, pattern, id_col, text_col)
    total = tokens.filter("start = 0").agg(F.sum("n")).first()[0] or 0
    order = [F.col("key"), F.col("doc_id").asc_nulls_first(), F.col("start")]
    dealt = tokens.repartitionByRange(1 + total // TASK_TOKENS, *order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "n", "start", "ids").mapInArrow(_fill(size, with_ids), _PIECE_DDL)


def op9_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return pack(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=False).drop("ids")
