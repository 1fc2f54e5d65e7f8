"""Byte-level BPE encoding and decoding in overlapping chunks."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, by_key, partitions, prepare, rows_of, table, written

#: Texts over CHUNK characters are cut into chunks that overlap by OVERLAP characters.
CHUNK, OVERLAP = 32_768, 1_024


@lru_cache(maxsize=4)
def encoder(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def boundaries(text: str, pattern: str, start: int, last: bool) -> list[int]:
    """Ends of the pre-tokens of a chunk at ``start``. Without the text's end, a pre-token is certain only
    if the chunk holds two more characters, for no alternative of the pattern looks further ahead."""
    ends = [m.end() for m in _compiled(pattern).finditer(text)]
    return [start + e for e in ends if last or e + 2 <= len(text)]


@lru_cache(maxsize=4)
def _compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def packed(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


_DOC = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_DOC_DDL = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _whole(path: str, pattern: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        yield from batches(((i, packed(e.encode_ordinary(t or ""))) for b in it for i, t in rows_of(b)), pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())]))

    return run


def _split(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int64()), ("start", pa.int64()), ("last", pa.bool_()), ("text", pa.string())])

    def out() -> Iterator[tuple]:
        for b in it:
            for row, i, t in rows_of(b):
                starts = range(0, len(t), CHUNK)
                for k, s in enumerate(starts):
                    yield row, i, k, s, k + 1 == len(starts), t[s : s + CHUNK + OVERLAP]

    yield from batches(out(), schema)


def _pretokenise(pattern: str):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int64()), ("start", pa.int64()), ("last", pa.bool_()), ("text", pa.string()), ("head", pa.list_(pa.int64())), ("tail", pa.list_(pa.int64()))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for b in it:
                for row, i, k, s, last, t in rows_of(b):
                    ends = boundaries(t, pattern, s, last)
                    head = [s, *(e for e in ends if e <= s + OVERLAP)] if k else []
                    yield row, i, k, s, last, t, head, [e for e in ends if e >= s + CHUNK] if not last else []

        yield from batches(out(), schema)

    return run


def _pieces(path: str, pattern: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        schema = pa.schema([("row", pa.int64()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])
        yield from batches(((row, k, i, packed(e.encode_ordinary(t[lo - s : None if hi is None else hi - s]))) for b in it for row, k, i, s, t, lo, hi in rows_of(b)), schema)

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (row, chunk, doc_id, ids) of every text; ids are little-endian unsigned 32-bit integers.

    Texts of at most CHUNK characters are one piece. Longer ones are cut into overlapping chunks, dealt
    over all tasks and pre-tokenised there from a cold start. A chunk and its successor agree from their
    first common boundary in the overlap on, since the pattern never looks behind; there the pieces
    meet. A text with a pre-token longer than the overlap, where two chunks may share no boundary, is
    encoded whole. ``row`` tells repeated rows apart.

    Null and empty texts give one piece without ids. Null identifiers pass through; other columns are
    not read; an empty table gives no pieces.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.length("text") > CHUNK, F.lit(False))
    piece = "row long, chunk long, doc_id long, ids binary"
    short = rows.filter(~is_long).mapInArrow(_whole(ranks_path, pattern), "doc_id long, ids binary")
    short = short.select(F.lit(None).cast("long").alias("row"), F.lit(0).cast("long").alias("chunk"), "doc_id", "ids")
    chunk = "row long, doc_id long, chunk long, start long, last boolean, text string"
    long = rows.filter(is_long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(_split, chunk)
    long = long.repartition(partitions(docs.sparkSession), "row", "chunk").mapInArrow(_pretokenise(pattern), chunk + ", head array<long>, tail array<long>")
    long = written(long, "chunks")
    heads = long.filter("chunk > 0").select("row", "chunk", "head")
    tails = long.filter("not last").select("row", (F.col("chunk") + 1).alias("chunk"), "tail")
    seams = written(heads.join(tails, ["row", "chunk"]).select("row", "chunk", F.array_min(F.array_intersect("head", "tail")).alias("at")), "seams")
    unsynced = seams.filter("at is null").select("row").distinct()
    before = seams.select("row", "chunk", F.col("at").alias("lo"))
    after = seams.select("row", (F.col("chunk") - 1).alias("chunk"), F.col("at").alias("hi"))
    cut = long.drop("head", "tail").join(unsynced, "row", "left_anti").join(before, ["row", "chunk"], "left").join(after, ["row", "chunk"], "left")
    cut = cut.select("row", "chunk", "doc_id", "start", "text", F.coalesce("lo", F.lit(0)).alias("lo"), "hi")
    whole = long.join(unsynced, "row", "left_semi").select("row", "doc_id", F.struct("chunk", F.substring("text", 1, CHUNK).alias("t")).alias("c"))
    whole = whole.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list("c")).alias("c"))
    whole = whole.select("row", F.lit(0).cast("long").alias("chunk"), "doc_id", F.lit(0).cast("long").alias("start"), F.expr("array_join(transform(c, x -> x.t), '')").alias("text"), F.lit(0).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"))
    return short.unionByName(cut.unionByName(whole).mapInArrow(_pieces(ranks_path, pattern), piece))


def _digest(path: str, pattern: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)

        def out() -> Iterator[tuple]:
            for (_, doc_id), group in by_key((r for b in it for r in rows_of(b)), 2):
                n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
                for _, ids in group:
                    found = np.frombuffer(ids, dtype="<u4")
                    n += len(found)
                    ids_sha.update(ids)
                    text_sha.update(e.decode_bytes(found.tolist()))
                yield doc_id, n, ids_sha.hexdigest(), text_sha.hexdigest()

        yield from batches(out(), _DOC)

    return run


def _digest_each(path: str, pattern: str):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)

        def out() -> Iterator[tuple]:
            for b in it:
                for doc_id, ids in rows_of(b):
                    found = np.frombuffer(ids, dtype="<u4")
                    yield doc_id, len(found), hashlib.sha256(ids).hexdigest(), hashlib.sha256(e.decode_bytes(found.tolist())).hexdigest()

        yield from batches(out(), _DOC)

    return run


def decode(pieces: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The pieces with ``decoded``, the concatenated raw bytes of their ids."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks_path, pattern)
        schema = pa.schema([("row", pa.int64()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("decoded", pa.binary())])
        yield from batches(((*k, e.decode_bytes(np.frombuffer(ids, dtype="<u4").tolist())) for b in it for *k, ids in rows_of(b)), schema)

    return pieces.select("row", "chunk", "doc_id", "ids").mapInArrow(run, "row long, chunk long, doc_id long, decoded binary")


def digests(pieces: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids and of the decoded bytes. Only cut texts are brought together."""
    single = pieces.filter("row is null").select("doc_id", "ids").mapInArrow(_digest_each(ranks_path, pattern), _DOC_DDL)
    cut = pieces.filter("row is not null").select("row", "doc_id", "chunk", "ids")
    cut = cut.repartition(partitions(pieces.sparkSession), "row").sortWithinPartitions("row", "chunk")
    return single.unionByName(cut.mapInArrow(_digest(ranks_path, pattern), _DOC_DDL))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    path = P.path("byte_bpe_50k.tiktoken")
    return digests(encode(table(spark, sf_dir, "documents"), path, P.PATTERN), path, P.PATTERN)
