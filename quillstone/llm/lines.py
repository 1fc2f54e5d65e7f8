"""Quality rules with cross-document line frequency."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, batches, join_sized, prepare, rows_of, table, written

#: A line in more than this share (in per cent) of a host's documents is removed there, if it is in more than LINE_FLOOR of them.
LINE_PERCENT, LINE_FLOOR = 5, 5
#: A document is depleted if less than this share (in per cent) of its words is left.
KEEP_PERCENT = 70
MIN_WORDS, REPEAT_PERCENT, NGRAM = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\r\x0b\x0c"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes], n: int = NGRAM) -> int:
    """Words in n-word windows that occur at least twice in the list."""
    if len(words) <= n:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.uint64) + np.uint64(1)
    m = len(ids) - n + 1
    key = np.zeros(m, dtype=np.uint64)
    for j in range(n):
        key = (key ^ (key >> np.uint64(29))) * _MIX + ids[j : j + m] * np.uint64(0xBF58476D1CE4E5B9)
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    often = counts[inverse] > 1
    if not often.any():
        return 0
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(edges, np.flatnonzero(often), 1)
    np.add.at(edges, np.flatnonzero(often) + n, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def line_hash(words: list[bytes]) -> int:
    """Hash of a normalised line: its words, A-Z lower-cased, joined by one space."""
    return signed(xxhash.xxh3_64_intdigest(b" ".join(words).lower()))


_STATS = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), ("row", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("lines", pa.list_(pa.struct([("h", pa.int64()), ("words", pa.int64())])))])
_STATS_DDL = "doc_id long, host string, row long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<h: long, words: long>>"


def _stats(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out() -> Iterator[tuple]:
        for b in it:
            for i, host, row, raw in rows_of(b):
                words = raw.split()
                chars = sum(map(len, words)) - sum(len(w) - len(w.decode()) for w in words if not w.isascii())
                seen: set[bytes] = set()
                duplicates, lines = 0, {}
                for line in raw.split(b"\n"):
                    if own := line.split():
                        duplicates += line in seen
                        seen.add(line)
                        h = line_hash(own)
                        lines[h] = lines.get(h, 0) + len(own)
                yield i, host, row, len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), duplicates, repeated_words(words), [{"h": h, "words": n} for h, n in lines.items()]

    yield from batches(out(), _STATS)


def _counted(docs: DataFrame, row: F.Column, id_col: str, text_col: str, host_col: str, percent: int, floor: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(statistics of each row, its lines, the frequent lines): a line's frequency is the number of distinct documents of a host that hold it.

    Rows that share an identifier are one document; a row without one is a document of its own. A null host
    is a host of its own. Both counts first bring a document's rows together, spread by the whole key,
    and then combine on the map side, and the joins keep rows of hot hosts and hot lines where they are, so that neither
    meets in one task.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(host_col).cast("string")), F.lit("")).alias("host"), row.alias("row"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))
    stats = written(rows.mapInArrow(_stats, _STATS_DDL), "lines")
    document = ["doc_id", F.when(F.col("doc_id").isNull(), F.col("row")).alias("own")]
    size = stats.groupBy("host", *document).agg(F.lit(1)).groupBy("host").agg(F.count("*").alias("documents"))
    size = written(size.withColumn("size", F.col("documents")), "hosts")
    lines = stats.select("row", "host", "doc_id", F.inline("lines"))
    found = lines.groupBy("host", "h", *document).agg(F.lit(1)).groupBy("host", "h").agg(F.count("*").alias("n"))
    often = join_sized(found.filter(F.col("n") > floor), size, "host").filter(100 * F.col("n") > percent * F.col("documents"))
    return stats, lines, written(often.select("host", "h", F.col("n").alias("size")), "frequent-lines")


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", line_percent: int = LINE_PERCENT, line_floor: int = LINE_FLOOR, keep_percent: int = KEEP_PERCENT) -> DataFrame:
    """One row per input row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, left_words.

    Lines are normalised (white space collapsed, A-Z lower-cased) and hashed. A line in more than
    ``line_percent`` per cent of a host's distinct documents, and in more than ``line_floor`` of them, is removed
    from the host's documents; a document of which less than ``keep_percent`` per cent of the words is left is
    rejected, and so is one that fails the base rules. ``without_frequent_lines`` returns the texts without them.

    Null text has no words; a null host is a host of its own; rows that share an identifier count as one
    document of a line, rows without one as a document each, and each row is judged alone; an empty
    table gives no rows.
    """
    stats, lines, often = _counted(docs, F.monotonically_increasing_id(), id_col, text_col, host_col, line_percent, line_floor)
    removed = join_sized(lines, often, ["host", "h"]).groupBy("row").agg(F.sum("words").alias("removed"))
    judged = stats.drop("lines", "host").join(removed, "row", "left")
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return judged.select(
        F.col("doc_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (100 * left >= keep_percent * F.col("n_words"))).alias("kept"), left.alias("left_words"),
    )


def without_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", line_percent: int = LINE_PERCENT, line_floor: int = LINE_FLOOR) -> DataFrame:
    """The same rows and columns, each text without its host's frequent lines; null and wordless texts stay as they are.

    The rows are written once with a number, by which each text gets the hashes of its own lines that go.
    """
    numbered = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    _, lines, often = _counted(numbered, F.col("__row"), id_col, text_col, host_col, line_percent, line_floor)
    gone = join_sized(lines, often, ["host", "h"]).groupBy(F.col("row").alias("__row")).agg(F.collect_set("h").alias("__gone"))
    kept = numbered.join(gone, "__row", "left").drop("__row")
    names, text, at = docs.columns, kept.columns.index(text_col), kept.columns.index("__gone")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            columns = b.columns
            old, gone = columns[text].to_pylist(), columns[at].to_pylist()
            new = [t if not hs else "\n".join(x for x in t.split("\n") if not (own := x.encode().split()) or line_hash(own) not in hs) for t, hs in zip(old, gone)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if k == text else c for k, c in enumerate(columns) if k != at], names=names)

    return kept.mapInArrow(run, docs.schema)


def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(table(spark, sf_dir, "documents")).drop("left_words")


OP6_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
base AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
                length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols FROM d),
pos AS (SELECT doc_id, unnest(range(1, len(w) - {NGRAM - 2})) AS i, w FROM d WHERE len(w) >= {NGRAM}),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + {NGRAM - 1}), ' ') AS g FROM pos),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + {NGRAM})) AS p FROM rep) GROUP BY doc_id),
ln AS (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw FROM ln),
lk AS (SELECT *, translate(array_to_string(lw, ' '), '{UPPER}', '{LOWER}') AS k FROM lw WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lk GROUP BY doc_id),
sz AS (SELECT host, count(DISTINCT doc_id) AS documents FROM d GROUP BY host),
oft AS (SELECT host, k FROM lk JOIN sz USING (host) GROUP BY host, k
        HAVING count(DISTINCT doc_id) > {LINE_FLOOR} AND 100 * count(DISTINCT doc_id) > {LINE_PERCENT} * max(documents)),
rem AS (SELECT doc_id, sum(len(lw)) AS removed FROM lk JOIN oft USING (host, k) GROUP BY doc_id),
j AS (SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed, 0) AS removed
      FROM base LEFT JOIN cov USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rem USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words)
         AND 100 * (n_words - removed) >= {KEEP_PERCENT} * n_words AS kept
FROM j
"""
