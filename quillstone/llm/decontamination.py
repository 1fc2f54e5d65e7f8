"""Benchmark decontamination by a broadcast set of n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, prepare, rows_of, table, written

NGRAM = 10
#: Windows of items, and bytes of their text, that one broadcast may hold. More are broadcast in turn, a block at a time.
BLOCK_ROWS, BLOCK_BYTES = 250_000, 24 << 20
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_WORD = re.compile(rb"[^ ]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def folded(raw: bytes) -> bytes:
    """UTF-8 with A-Z lower-cased and every character that is in no word as one space: bytes keep their places."""
    return raw.translate(_FOLD)


def _windows(n: int):
    """(item, text) to (item, window): every n words of an item, or all of an item with fewer."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for b in it:
                for item, raw in rows_of(b):
                    words = folded(raw).split()
                    for k in range(max(len(words) - n, 0) + 1 if words else 0):
                        yield item, b" ".join(words[k : k + n])

        yield from batches(out(), pa.schema([("item", pa.string()), ("window", pa.binary())]))

    return run


class NGrams:
    """A block of windows: numbers of their words and, by window length, hashes in order, the windows as numbers, and the items of each."""

    def __init__(self, rows: list[tuple[str, bytes]]) -> None:
        self.words: dict[bytes, int] = {}
        by: dict[int, dict[tuple, list[str]]] = {}
        for item, window in rows:
            ids = tuple(self.words.setdefault(w, len(self.words) + 1) for w in window.split())
            by.setdefault(len(ids), {}).setdefault(ids, []).append(item)
        self.by_length = []
        for n, found in sorted(by.items()):
            grams = np.array(list(found), dtype=np.int32).reshape(len(found), n)
            h = _rolled(grams.ravel(), n)[::n] if len(grams) else np.zeros(0, dtype=np.uint64)
            order = np.argsort(h, kind="stable")
            self.by_length.append((n, h[order], grams[order], [list(found.values())[k] for k in order]))

    def hits(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """(which words lie in an occurrence of a window, or None; the items of these windows). Equal hashes are compared word by word."""
        ids = np.array([self.words.get(w, 0) for w in words], dtype=np.int32)
        edges, items = None, set()
        if not ids.any():
            return None, items
        for n, hashes, grams, owners in self.by_length:
            if len(ids) < n:
                continue
            known = np.concatenate([[0], np.cumsum(ids > 0)])
            starts = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(starts):
                continue
            h = _rolled(ids, n)[starts]
            at = np.searchsorted(hashes, h)
            while len(starts):  # one turn, but for windows of one hash
                near = at < len(hashes)
                starts, at, h = starts[near], at[near], h[near]
                same = hashes[at] == h
                starts, at, h = starts[same], at[same], h[same]
                equal = (ids[starts[:, None] + np.arange(n)] == grams[at]).all(axis=1) if len(starts) else np.zeros(0, dtype=bool)
                for g in np.unique(at[equal]):
                    items.update(owners[g])
                if equal.any():
                    edges = np.zeros(len(ids) + 1, dtype=np.int64) if edges is None else edges
                    np.add.at(edges, starts[equal], 1)
                    np.add.at(edges, starts[equal] + n, -1)
                starts, at, h = starts[~equal], at[~equal] + 1, h[~equal]
        return (None if edges is None else np.cumsum(edges[:-1]) > 0), items


def _rolled(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n numbers in a row."""
    m = len(ids) - n + 1
    h = np.zeros(m, dtype=np.uint64)
    for j in range(n):
        h = (h ^ (h >> np.uint64(29))) * _MIX + ids[j : j + m].astype(np.uint64)
    return h


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
_SPANS_DDL = "array<struct<first: long, end: long>>"


def _scan(block: Broadcast):
    """Adds to (..., raw) n_words, spans of hit words as (first, end) and items, in place of raw."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            counts, spans, items = [], [], []
            for raw in b.column(b.num_columns - 1).to_pylist():
                words = folded(raw).split()
                hit, found = block.value.hits(words)
                counts.append(len(words))
                spans.append([] if hit is None else [{"first": s, "end": e} for s, e in _runs(hit)])
                items.append(sorted(found))
            new = [pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *new], names=[*b.schema.names[:-1], "n_words", "spans", "items"])

    return run


def _union(spans: Column) -> Column:
    """Spans that overlap or touch made one; of sorted spans."""

    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["first"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.lit(None).cast(_SPANS_DDL), lambda done, s: F.when(done.isNull(), F.array(s)).otherwise(step(done, s)))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = NGRAM) -> DataFrame:
    """One row per document row: id, n_words, spans of hit words (first, end), items whose windows occur.

    A window is n words in a row of an item, or all words of an item with fewer. Windows are broadcast as a set of
    hashes with the words beside them, and every hit is compared word by word. A block holds at most about
    BLOCK_ROWS windows and BLOCK_BYTES of text, by count of the table; a larger benchmark is dealt by hash into blocks that are scanned one
    after the other, and each document's spans are united.

    Null and empty texts have no words and no hits, items without words no window; items of a null id are one item, of
    the empty name. Repeated documents are scanned each, repeated items count once. An empty table gives
    no rows, an empty benchmark no hits. Other columns are not read.
    """
    return _found(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw")), benchmark, item_col, item_text, n).withColumnRenamed("id", id_col)


def _found(rows: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, n: int) -> DataFrame:
    """n_words, spans and items in place of the last column, raw."""
    spark = rows.sparkSession
    prepare(spark)
    given = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text), F.lit("")).cast("binary").alias("raw"))
    windows = written(given.mapInArrow(_windows(n), "item string, window binary").distinct(), "windows")
    size = windows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("window") + F.octet_length("item")), F.lit(0)).alias("b")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ROWS), -(-size["b"] // BLOCK_BYTES))

    def block(k: int) -> Broadcast:
        own = windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == k)
        return spark.sparkContext.broadcast(NGrams([(r["item"], bytes(r["window"])) for r in own.collect()]))

    kept = [f for f in rows.schema if f.name != "raw"]
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "n_words long", f"spans {_SPANS_DDL}", "items array<string>"])
    if blocks == 1:
        return rows.mapInArrow(_scan(block(0)), ddl)
    numbered = written(rows.select(F.monotonically_increasing_id().alias("__row"), *rows.columns), "numbered")
    parts = []
    for k in range(blocks):  # one block is in memory at a time
        shared = block(k)
        parts.append(written(numbered.mapInArrow(_scan(shared), f"__row long, {ddl}"), "scanned"))
        shared.destroy()
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    names = [f.name for f in kept]
    gathered = every.groupBy("__row").agg(
        *[F.first(x).alias(x) for x in [*names, "n_words"]],
        F.coalesce(_union(F.flatten(F.collect_list("spans"))), F.array().cast(_SPANS_DDL)).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    return gathered.drop("__row")


def _without_spans(text: int, at: int, names: list[str]):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            columns, new = b.columns, []
            for old, spans in zip(columns[text].to_pylist(), columns[at].to_pylist()):
                if not spans:
                    new.append(old)
                    continue
                raw, out, done = old.encode(), [], 0
                places = [m.span() for m in _WORD.finditer(folded(raw))]
                for s in spans:
                    out.append(raw[done : places[s["first"]][0]])
                    done = places[s["end"] - 1][1]
                new.append(b"".join([*out, raw[done:]]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if k == text else c for k, c in enumerate(columns) if k != at], names=names)

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = NGRAM) -> DataFrame:
    """The documents with all their columns: without their hit spans (``remove="spans"``, first to last hit word of each), or without the documents that have one (``"documents"``).

    Awkward rows as in ``contaminated``; a text without a hit, also a null one, stays as it is.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is spans or documents, not {remove!r}")
    names = docs.columns
    inner = docs.toDF(*[f"c{k}" for k in range(len(names))])
    text = names.index(text_col)
    found = _found(inner.withColumn("raw", F.coalesce(F.col(f"c{text}"), F.lit("")).cast("binary")), benchmark, item_col, item_text, n).drop("n_words", "items")
    if remove == "documents":
        return found.filter(F.size("spans") == 0).drop("spans").toDF(*names)
    return found.mapInArrow(_without_spans(text, len(names), inner.columns), inner.schema).toDF(*names)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP13_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_CLASS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_CLASS}') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), {NGRAM}) AS n, array_to_string(list_slice(w, i, i + least(len(w), {NGRAM}) - 1), ' ') AS t
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {NGRAM}, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM g),
s AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS t
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN ns ON len(w) >= n)),
h AS (SELECT doc_id, item_id, i, n FROM s JOIN g USING (n, t)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
x AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN x USING (doc_id)
"""
