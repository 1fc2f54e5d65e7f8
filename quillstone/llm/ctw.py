"""Language-model scoring by context-tree weighting over binary-decomposed bytes."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, crc_mod, partitions, prepare, rows_of, table, utf8, written

#: Bytes of context.
DEPTH = 5
#: Subtrees of contexts of TOP bytes are weighted in tasks; what lies above them, on the driver.
TOP = 3
#: Pairs of a context and a byte that make at least one in SHARE of all places are broadcast with their probability, so
#: at most SHARE of them; the others are joined. It decides where a probability is looked up, not what it is.
SHARE = 1 << 22
#: Pairs that a task weights at once, at least; contexts of TOP bytes are not cut.
CHUNK = 200_000
#: Distinct grams that a task holds before it merges them, and before it hands them on.
MERGE_GRAMS, FLUSH_GRAMS = 1_000_000, 1_500_000
#: Upper-case A never occurs in lower-cased text: it begins and ends each text.
EDGE = 0x41
#: At most so many of the most frequent words are broadcast; the others are joined.
BROADCAST_WORDS = 1 << 19
#: Distinct words that a task holds before it hands its counts on.
FLUSH_WORDS = 200_000


def places(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each place of each text and its end: the DEPTH bytes before, nearest first, and the byte; and each text's number of places."""
    edge = bytes([EDGE])
    raw = np.frombuffer(edge * DEPTH + (edge * (DEPTH + 1)).join(texts) + edge, dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    keep = np.ones(len(raw) - DEPTH, dtype=bool)
    ends = np.cumsum(sizes + DEPTH)[:-1]
    for j in range(DEPTH):
        keep[ends - DEPTH + j] = False
    return [raw[DEPTH - 1 - j : len(raw) - 1 - j][keep] for j in range(DEPTH)], raw[DEPTH:][keep], sizes


def mask(depth: int) -> int:
    """Bits of a context key that hold its nearest ``depth`` bytes, of nine bits each."""
    return (1 << (9 * depth)) - 1


def grams(texts: list[bytes]) -> np.ndarray:
    """Code of (context key, byte) at each place."""
    before, byte, _ = places(texts)
    code = byte.astype(np.int64)
    for j, b in enumerate(before):
        code |= b.astype(np.int64) << (8 + 9 * j)
    return code


_COUNTS = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("n", pa.int64())])


def _count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (kind 0, by hash) and of byte grams (kind 1) of the texts of a task; of texts not learnt from, grams only (kind 2)."""

    def arrays(kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(keys), 100_000):
            part = keys[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int8)), pa.array(part), pa.array(n[k : k + 100_000])], schema=_COUNTS)

    def words_out(words: Counter) -> Iterator[pa.RecordBatch]:
        keys = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words)).view(np.int64)
        yield from arrays(0, keys, np.fromiter(words.values(), np.int64, len(words)))

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(inverse, weights=np.concatenate([n for _, n in parts]), minlength=len(keys)).astype(np.int64)

    words, parts, held = Counter(), {1: [], 2: []}, {1: 0, 2: 0}
    for b in it:
        both: dict[int, list[bytes]] = {1: [], 2: []}
        for t, learnt in rows_of(b):
            both[1 if learnt else 2].append(t.lower())  # of bytes: A-Z only
        for t in both[1]:
            words.update(t.split())
            if len(words) > FLUSH_WORDS:
                yield from words_out(words)
                words = Counter()
        for kind, texts in both.items():
            for k in range(0, len(texts), 256):
                parts[kind].append(np.unique(grams(texts[k : k + 256]), return_counts=True))
                held[kind] += len(parts[kind][-1][0])
                if held[kind] > MERGE_GRAMS:
                    parts[kind] = [merged(parts[kind])]
                    held[kind] = len(parts[kind][0][0])
                    if held[kind] > FLUSH_GRAMS:
                        yield from arrays(kind, *parts[kind][0])
                        parts[kind], held[kind] = [], 0
                    held[kind] = min(held[kind], MERGE_GRAMS // 2)
    yield from words_out(words)
    for kind, own in parts.items():
        if own:
            yield from arrays(kind, *merged(own))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log of gamma for x >= 0.5, by Stirling's series from x + 8 on."""
    shift = np.ones_like(x)
    for j in range(8):
        shift *= x + j
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - 1.1447298858494002 - _log_gamma(zeros + ones + 1)


def leaves(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of depth DEPTH, (context key, place in the byte), with their counts of zeros and ones; and for each bit and code its node's position."""
    key, byte = code >> 8, code & 255
    nodes, at = np.unique(np.concatenate([(key << 8) | (1 << b) | (byte >> (8 - b)) for b in range(8)]), return_inverse=True)
    bit = np.concatenate([(byte >> (7 - b)) & 1 for b in range(8)])
    w = np.tile(n, 8)
    return nodes, np.bincount(at, weights=w * (1 - bit), minlength=len(nodes)), np.bincount(at, weights=w * bit, minlength=len(nodes)), at.reshape(8, -1)


class Level:
    """Nodes of a depth from those of the next one (or from sums over them): ``parent`` is each child's position.

    A node's weighted probability is half its KT estimate plus half the product of its children's; ``share``, the
    ratio of the two, is the weight with which a prediction mixes ``p`` into that of the child. A node without
    counts has a weighted probability of 1 and predicts one half, so it stands for what was never seen.
    """

    def __init__(self, depth: int, child: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray) -> None:
        self.nodes, self.parent = np.unique((((child >> 8) & mask(depth)) << 8) | (child & 255), return_inverse=True)
        self.zeros, self.ones, below = (np.bincount(self.parent, weights=x, minlength=len(self.nodes)) for x in (zeros, ones, weighted))
        own = log_kt(self.zeros, self.ones)
        self.weighted = math.log(0.5) + np.logaddexp(own, below)
        self.share = 1 / (1 + np.exp(-np.clip(own - below, -700, 700)))
        self.p = (self.ones + 0.5) / (self.zeros + self.ones + 1)

    def mix(self, p: np.ndarray, at: np.ndarray) -> np.ndarray:
        return p + (self.p[at] - p) * self.share[at]


class ContextTree:
    """Context trees, one for each of the 255 places of the binary decomposition of a byte, in memory.

    Leaves are the contexts of DEPTH bytes. ``code``, ``n``: (context, byte) and how often. It holds every node with
    all bytes, so it is for small tables; ``probabilities`` has the same tree as a written table.
    """

    def __init__(self, code: np.ndarray, n: np.ndarray) -> None:
        self.keys = [np.unique((code >> 8) & mask(d)) if d else np.zeros(1, dtype=np.int64) for d in range(DEPTH + 1)]
        self.levels: list = [None] * (DEPTH + 1)
        nodes, zeros, ones, _ = leaves(code, n)
        weighted, p, share = log_kt(zeros, ones), (ones + 0.5) / (zeros + ones + 1), np.ones(len(nodes))
        for d in range(DEPTH, -1, -1):
            if d < DEPTH:
                up = Level(d, nodes, zeros, ones, weighted)
                nodes, zeros, ones, weighted, p, share = up.nodes, up.zeros, up.ones, up.weighted, up.p, up.share
            own, mixed = np.full((len(self.keys[d]), 256), 0.5, dtype=np.float32), np.full((len(self.keys[d]), 256), 0.5, dtype=np.float32)
            row = np.searchsorted(self.keys[d], nodes >> 8)
            own[row, nodes & 255], mixed[row, nodes & 255] = p, share
            self.levels[d] = (own, mixed)

    def _log10(self, p: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
        """log10 probability of each byte, from bit probabilities below ``depth`` and the nodes of the keys up to the root."""
        for d in range(depth, -1, -1):
            own, share = self.levels[d]
            row = np.searchsorted(self.keys[d], keys & mask(d))
            p = p + (own[row] - p) * share[row]
        out = np.zeros((len(keys), 256))
        for b in range(8):
            one = p[:, 1 << b : 2 << b]
            out += np.repeat(np.log10(np.stack([1 - one, one], axis=-1)).reshape(len(keys), -1), 1 << (7 - b), axis=1)
        return out

    def machine(self) -> tuple[np.ndarray, np.ndarray]:
        """(next, logs): from state 0, next[state, byte] for the bytes before a place, nearest first, ends in a row of ``logs``.

        States from len(next) on are final: contexts that are leaves, and what was never seen below an inner context.
        """
        leaf_of = [np.isin(k, self.keys[d + 1] & mask(d), invert=True) if d < DEPTH else np.ones(len(k), dtype=bool) for d, k in enumerate(self.keys)]
        if leaf_of[0][0]:
            leaf_of[0][0] = False
        inner = [k[~x] for k, x in zip(self.keys, leaf_of)]
        first = np.cumsum([0, *map(len, inner)])
        states, logs = first[-1], []
        following = np.empty((states, 256), dtype=np.int32)
        made = states
        for d in range(DEPTH + 1):
            if not len(inner[d]):
                continue
            rows = slice(first[d], first[d + 1])
            logs.append(self._rows(inner[d], d, unseen=True))
            following[rows] = np.arange(made, made + len(inner[d]))[:, None]
            made += len(inner[d])
            if d == DEPTH:
                continue
            for keys, begin in ((self.keys[d + 1][leaf_of[d + 1]], None), (inner[d + 1], first[d + 1])):
                if not len(keys):
                    continue
                if begin is None:
                    logs.append(self._rows(keys, d + 1, unseen=False))
                    begin, made = made, made + len(keys)
                ids = np.arange(begin, begin + len(keys))
                parent, symbol = first[d] + np.searchsorted(inner[d], keys & mask(d)), keys >> (9 * d)
                following[parent, symbol] = ids
        return following, np.concatenate(logs)

    def _rows(self, keys: np.ndarray, depth: int, unseen: bool) -> np.ndarray:
        out = np.empty((len(keys), 256), dtype=np.float16)
        for k in range(0, len(keys), 2048):
            out[k : k + 2048] = self._log10(np.full((len(keys[k : k + 2048]), 256), 0.5, dtype=np.float32), keys[k : k + 2048], depth)
        return out


def place_logs(machine: tuple[np.ndarray, np.ndarray], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability at each place of each text, and each text's number of places."""
    following, logs = machine
    before, byte, sizes = places(texts)
    states, table = len(following), following.reshape(-1)
    state = table[before[0]]
    for b in before[1:]:
        inner = np.flatnonzero(state < states)
        state[inner] = table[(state[inner] << 8) | b[inner]]
    # no state is inner after all bytes: contexts of DEPTH bytes are leaves
    return logs.reshape(-1)[((state - states) << 8) | byte].astype(np.float64), sizes


def count(rows: DataFrame) -> DataFrame:
    """Written table (kind, key, n) of the word and gram counts of all texts; ``rows`` has (t, learnt)."""
    found = rows.mapInArrow(_count, "kind byte, key long, n long")
    return written(found.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")


def context_tree(counted: DataFrame) -> ContextTree:
    """Tree in memory of the gram counts (key, n)."""
    found = counted.toArrow()
    return ContextTree(found["key"].to_numpy().astype(np.int64), found["n"].to_numpy().astype(np.float64))


_WEIGHED = pa.schema([("key", pa.int64()), ("zeros", pa.float64()), ("ones", pa.float64()), ("weighted", pa.float64()), ("seen", pa.int64()), ("bits", pa.binary())])
_WEIGHED_DDL = "key long, zeros double, ones double, weighted double, seen long, bits binary"


def _weigh(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (code, learnt, n) in the order of contexts of TOP bytes: the nodes of depth TOP, and for each code its eight bit probabilities so far."""

    def cut(code: np.ndarray, learnt: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        codes, at = np.unique(code, return_inverse=True)
        seen = np.bincount(at, weights=n, minlength=len(codes)).astype(np.int64)
        nodes, zeros, ones, each = leaves(codes, np.bincount(at, weights=n * learnt, minlength=len(codes)))
        p, weighted = ((ones + 0.5) / (zeros + ones + 1))[each], log_kt(zeros, ones)
        for d in range(DEPTH - 1, TOP - 1, -1):
            level = Level(d, nodes, zeros, ones, weighted)
            each = level.parent[each]
            p = level.mix(p, each)
            nodes, zeros, ones, weighted = level.nodes, level.zeros, level.ones, level.weighted
        bits = np.ascontiguousarray(p.T)
        for k in range(0, len(nodes), 50_000):
            x = slice(k, k + 50_000)
            m = len(nodes[x])
            yield pa.RecordBatch.from_arrays([*map(pa.array, (nodes[x], zeros[x], ones[x], weighted[x])), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary())], schema=_WEIGHED)
        for k in range(0, len(codes), 50_000):
            x = slice(k, k + 50_000)
            m = len(codes[x])
            none = pa.nulls(m, pa.float64())
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(64), m, [None, pa.py_buffer(bits[x].tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(codes[x]), none, none, none, pa.array(seen[x]), packed], schema=_WEIGHED)

    parts: list[tuple] = []
    held = 0
    for b in it:
        parts.append(tuple(c.to_numpy(zero_copy_only=False) for c in b.columns))
        held += len(b)
        if held >= CHUNK:
            code, learnt, n = (np.concatenate(c) for c in zip(*parts))
            context = (code >> 8) & mask(TOP)
            end = int(np.flatnonzero(context != context[-1])[-1]) + 1 if context[0] != context[-1] else 0
            if end:
                yield from cut(code[:end], learnt[:end], n[:end])
            parts, held = [(code[end:], learnt[end:], n[end:])], 0
    if parts:
        yield from cut(*(np.concatenate(c) for c in zip(*parts)))


def _finish(top):
    """Log probability of each code, its bits mixed with the levels above TOP."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if not len(b):
                continue
            code = b.column(0).to_numpy()
            p = np.frombuffer(b"".join(b.column(2).to_pylist()), np.float64).reshape(-1, 8)
            out = np.zeros(len(code))
            for j in range(8):
                own, place = p[:, j], (1 << j) | ((code & 255) >> (8 - j))
                for d, nodes, mixed, share in top.value:
                    at = np.searchsorted(nodes, (((code >> 8) & mask(d)) << 8) | place)
                    own = own + (mixed[at] - own) * share[at]
                out += np.log10(np.where((code >> (7 - j)) & 1, own, 1 - own))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out)], ["key", "seen", "value"])

    return run


def probabilities(counted: DataFrame) -> DataFrame:
    """Written table (key, seen, value) of the log10 probability of every (context, byte) of ``counted`` (kind, key, n).

    Kind 1 counts, kind 2 only asks. All contexts are nodes. A task has whole contexts of TOP bytes; the driver
    gets the nodes of one byte less: at most 65,536 contexts of 255 places each (16.7 million nodes of 32 bytes) at any
    size of corpus, if all pairs of bytes occur before all bytes; text in UTF-8 has a small share of them.
    """
    spark = counted.sparkSession
    context = F.shiftright("key", 8).bitwiseAND(mask(TOP))
    dealt = counted.filter("kind > 0").select("key", (F.col("kind") == 1).alias("learnt"), "n").repartition(partitions(spark), context).sortWithinPartitions(context)
    tree = written(dealt.mapInArrow(_weigh, _WEIGHED_DDL), "tree")
    above = F.shiftleft(F.shiftright("key", 8).bitwiseAND(mask(TOP - 1)), 8).bitwiseOR(F.col("key").bitwiseAND(255))
    sums = tree.filter("bits is null").groupBy(above.alias("key")).agg(*[F.sum(x).alias(x) for x in ("zeros", "ones", "weighted")]).toArrow()
    rows, top = [sums[x].to_numpy() for x in ("key", "zeros", "ones", "weighted")], []
    for d in range(TOP - 1, -1, -1):
        level = Level(d, *rows)
        rows = [level.nodes, level.zeros, level.ones, level.weighted]
        top.append((d, level.nodes, level.p, level.share))
    shared = spark.sparkContext.broadcast(top)
    return written(tree.filter("bits is not null").select("key", "seen", "bits").mapInArrow(_finish(shared), "key long, seen long, value double"), "logs")


_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64()), *[(f"rest_{x}", pa.list_(pa.int64())) for x in ("words", "word_times", "pairs", "pair_times")]])
_SCORED_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, n_bytes long, rest_words array<long>, rest_word_times array<long>, rest_pairs array<long>, rest_pair_times array<long>"


def _lists(arrays: tuple[np.ndarray, ...]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(arrays).astype(np.int64))


#: Bits of a gram's code, and an odd factor that mixes it one to one.
CODE_BITS = 8 + 9 * DEPTH
_MIX = 0x9E3779B97F4A7C15 & ((1 << CODE_BITS) - 1) | 1


class Lookup:
    """Values of codes, in buckets by the high bits of the mixed code; the low bits tell a bucket's few codes apart, so a hit is exact."""

    def __init__(self, codes: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(int(len(codes)).bit_length(), CODE_BITS - 32)
        mixed = self._mix(codes)
        order = np.argsort(mixed)
        bucket = (mixed >> np.int64(CODE_BITS - self.bits))[order]
        self.start = np.searchsorted(bucket, np.arange((1 << self.bits) + 1)).astype(np.uint32)
        self.low = self._low(mixed[order])
        self.values = values[order].astype(np.float32)

    def _mix(self, codes: np.ndarray) -> np.ndarray:
        return (codes.view(np.uint64) * np.uint64(_MIX) & np.uint64((1 << CODE_BITS) - 1)).view(np.int64)

    def _low(self, mixed: np.ndarray) -> np.ndarray:
        return (mixed & np.int64((1 << (CODE_BITS - self.bits)) - 1)).astype(np.uint32)

    def __call__(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value of each code, 0 for what has none; the positions of those)."""
        if not len(self.low):
            return np.zeros(len(codes), np.float32), np.arange(len(codes))
        mixed = self._mix(codes)
        bucket, low = mixed >> np.int64(CODE_BITS - self.bits), self._low(mixed)
        at, end = self.start[bucket], self.start[bucket + 1]
        last = np.uint32(len(self.low) - 1)
        left = np.flatnonzero((at == end) | (self.low[np.minimum(at, last)] != low))
        out = self.values[np.minimum(at, last)]
        out[left] = 0
        left, missed = left[at[left] < end[left]], [left[at[left] == end[left]]]
        step = np.uint32(0)
        while len(left):
            step += np.uint32(1)
            place = at[left] + step
            inside = place < end[left]
            missed.append(left[~inside])
            left, place = left[inside], place[inside]
            hit = self.low[place] == low[left]
            out[left[hit]] = self.values[place[hit]]
            left = left[~hit]
        return out, np.sort(np.concatenate(missed))


def _score(likely, frequent):
    """Scores from the broadcast pairs and words; the others of each text go on, with their numbers."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, (keys, logs) = likely.value, frequent.value
        cache: dict[bytes, float] = {}

        def learn(texts: list[list[bytes]]) -> None:
            """Brings the words of the texts into the cache, by one search for all new ones; NaN for what is not broadcast."""
            if len(cache) > 300_000:
                cache.clear()
            new = [w for w in set().union(*texts) if w not in cache]
            if new:
                h = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new)).view(np.int64)
                at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                cache.update(zip(new, np.where(keys[at] == h, logs[at], math.nan).tolist() if len(keys) else [math.nan] * len(new)))

        def of_words(split: list[list[bytes]]) -> Iterator[tuple[float, int, np.ndarray, np.ndarray]]:
            learn(split)
            flat = [w for words in split for w in words]
            values = np.fromiter(map(cache.__getitem__, flat), np.float64, len(flat))
            doc = np.repeat(np.arange(len(split)), [len(words) for words in split])
            missed = np.flatnonzero(np.isnan(values))
            values[missed] = 0
            base, unknown = np.bincount(doc, weights=values, minlength=len(split)), np.bincount(doc[missed], minlength=len(split))
            keys = np.fromiter((xxhash.xxh3_64_intdigest(flat[k]) for k in missed.tolist()), np.uint64, len(missed)).view(np.int64)
            ends = np.cumsum(unknown)
            for k, words in enumerate(split):
                yield float(base[k]), len(words) - int(unknown[k]), *np.unique(keys[ends[k] - unknown[k] : ends[k]], return_counts=True)

        def of_pairs(texts: list[bytes]) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
            sizes = np.array([len(t) + 1 for t in texts])
            code = grams(texts)
            values, missed = lookup(code)
            scores = np.add.reduceat(values, np.cumsum(sizes) - sizes, dtype=np.float64)
            cut = np.searchsorted(missed, np.cumsum(sizes))
            for k, s in enumerate(scores.tolist()):
                yield s, *np.unique(code[missed[cut[k - 1] if k else 0 : cut[k]]], return_counts=True)

        for b in it:
            ids, held, texts = (c.to_pylist() for c in b.columns)
            texts = [t.lower() for t in texts]
            for k in range(0, len(texts), 256):
                part = texts[k : k + 256]
                split = [t.split() for t in part]
                base, known, words, tf = zip(*of_words(split))
                score, pairs, times = zip(*of_pairs(part))
                tokens, sizes = [len(w) + 1 for w in split], [len(t) for t in part]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) if not f.name.startswith("rest") else _lists(x) for x, f in zip((ids[k : k + 256], held[k : k + 256], tokens, known, base, score, sizes, words, tf, pairs, times), _SCORED)], schema=_SCORED)

    return run


def _bytes(text_col: str) -> F.Column:
    return utf8(F.col(text_col)).alias("t")


def score(docs: DataFrame, training: DataFrame, held_out: F.Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    The model is a context tree over bytes, learnt from all whole texts of ``training``; ``score`` is the
    log10 probability of the lower-cased text and its end, each byte decomposed into eight binary
    decisions that mix the KT estimates of all depths. Every context that occurs is a node; the probabilities
    of all pairs of a context and a byte that the texts hold are a written table. Frequent pairs come as a broadcast
    of at most SHARE, frequent words as one of at most BROADCAST_WORDS, all others by a join, so no join key is hot.
    ``held_out`` is true for the rows of ``docs`` that ``training`` lacks; without it all are taken to be lacking.

    Null and empty texts are one end token. Null identifiers and repeated rows pass through, each row is
    scored alone. Without training rows each byte has probability 2 ** -8. An empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    asked = docs if held_out is None else docs.filter(held_out)
    counts = count(training.select(_bytes(text_col), F.lit(True).alias("learnt")).union(asked.select(_bytes(text_col), F.lit(False))))
    logs_of = probabilities(counts)
    words = counts.filter("kind = 0").select("key", "n")
    texts = training.count()
    seen, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = seen + texts, distinct + (texts > 0)
    shift = math.log10(n + v + 1)
    least = 0
    if distinct > BROADCAST_WORDS:  # the least count with at most BROADCAST_WORDS words at or over it
        held, least = 0, 1 << 62
        level = F.when(F.col("n") < 1024, F.col("n")).otherwise(F.expr("shiftleft(1L, cast(floor(log2(n)) as int))"))
        for c, k in sorted(((r[0], r[1]) for r in words.groupBy(level.alias("c")).count().collect()), reverse=True):
            held += k
            if held > BROADCAST_WORDS:
                break
            least = c
    top = words.filter(F.col("n") >= least).toArrow()
    keys, logs = top["key"].to_numpy(), np.log10(top["n"].to_numpy() + 1.0)
    order = np.argsort(keys)
    bar = (logs_of.agg(F.sum("seen")).first()[0] or 0) / SHARE
    pairs = logs_of.filter(F.col("seen") >= bar).select("key", F.col("value").cast("float")).toArrow()
    sc = spark.sparkContext
    likely = sc.broadcast(Lookup(pairs["key"].to_numpy(), pairs["value"].to_numpy()))
    frequent = sc.broadcast((keys[order], logs[order]))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.lit(None).cast("boolean") if held_out is None else held_out).alias("held_out"), _bytes(text_col))
    scored = rows.mapInArrow(_score(likely, frequent), _SCORED_DDL).withColumn("row", F.monotonically_increasing_id())
    scored = written(scored, "scores")
    listed = lambda kind, keys, times: scored.select("row", F.explode(F.zip_with(keys, times, lambda a, n: F.struct(a.alias("key"), n.alias("tf")))).alias("x")).select("row", F.lit(kind).alias("kind"), "x.key", "x.tf")
    rest = listed(0, "rest_words", "rest_word_times").union(listed(1, "rest_pairs", "rest_pair_times"))
    values = words.filter(F.col("n") < least).select(F.lit(0).alias("kind"), "key", F.log10(F.col("n") + 1).alias("value"))
    values = values.union(logs_of.filter(F.col("seen") < bar).select(F.lit(1), "key", "value"))
    of_kind = lambda k, x: F.sum(F.when(F.col("kind") == k, x))
    rest = rest.join(values, ["kind", "key"]).groupBy("row").agg(of_kind(0, F.col("tf") * F.col("value")).alias("rest_base"), of_kind(0, F.col("tf")).alias("rest_known"), of_kind(1, F.col("tf") * F.col("value")).alias("rest_score"))
    end = F.lit(math.log10(texts + 1))
    whole = F.col("score") + F.coalesce("rest_score", F.lit(0.0))
    return scored.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "n_bytes").join(rest, "row", "left").select(
        F.col("doc_id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rest_known", F.lit(0)) + int(texts > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", F.lit(0.0)) + end - F.col("n_tokens") * shift).alias("base_score"),
        whole.alias("score"),
        (-whole * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )


def op7_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 7, 2)
    return score(docs, docs.filter(~held_out), held_out)
