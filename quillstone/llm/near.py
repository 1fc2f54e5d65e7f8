"""Near-duplicate documents by a chosen-path set similarity join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, by_key, join_counted, join_small, partitions, prepare, rows_of, table, utf8, written

#: Minwise functions of a signature; the trees choose their paths among them.
HASHES, LEVELS = 128, 3
RECALL = 0.9998
#: A node of at most so many documents is compared exhaustively; larger ones branch.
NODE = 128
#: Documents whose full sets are compared in one block.
BLOCK = 256
#: Share of equal signature bytes from which two documents are compared in full: five deviations below 0.8.
SIMILAR = 0.62
#: Crowded documents branch on by other minwise functions, at these depths, with as many trees as each needs for RECALL.
DEPTHS, LONG = (4, 8, 12), 512
#: The same share for their sketches of LONG bytes.
LONG_SIMILAR = 0.71
#: Documents of a cell in which a crowded node is compared; with more than WIDE cells' outside the largest component it branches on.
OUTSIDE, WIDE = 1024, 8

_RNG = np.random.default_rng(3)
_A = _RNG.integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(1, 1 << 62, HASHES, dtype=np.uint64)
_LONG_A = _RNG.integers(1, 1 << 62, LONG, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LONG_B = _RNG.integers(1, 1 << 62, LONG, dtype=np.uint64)


def trees(threshold: float, depth: int = LEVELS, recall: float = RECALL) -> int:
    """Independent trees, so that a pair at the threshold meets in one of them with the wanted probability at full depth."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of 64-bit hashes of k-word shingles of lower-cased texts; word hashes are cached."""

    def __init__(self, k: int) -> None:
        self.k, self.cache = k, {}

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # of bytes: A-Z only
        if not words:
            return np.empty(0, np.uint64)
        if len(self.cache) > 150_000:
            self.cache.clear()
        cache, hashes = self.cache, np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            h = cache.get(w)
            if h is None:
                h = cache[w] = xxhash.xxh3_64_intdigest(w)
            hashes[i] = h
        n = min(self.k, len(words))
        m = len(words) - n + 1
        key = np.full(m, n, np.uint64)
        for j in range(n):
            key = _mix(key + np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + m])
        return np.unique(key)


def signature(items: np.ndarray, a: np.ndarray = _A, b: np.ndarray = _B) -> np.ndarray:
    """Minwise values of a non-empty set, one for each function."""
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    step = 4096 * HASHES // len(a)
    for k in range(0, len(items), step):
        part = items[k : k + step]
        low = np.minimum(low, ((part[None] * a[:, None] + b[:, None]) >> np.uint64(11)).min(axis=1))
    return low


_SIG = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_hash", pa.binary()), ("sig", pa.binary()), ("paths", pa.list_(pa.int64()))])
_SIG_DDL = "doc_id long, n_shingles long, set_hash binary, sig binary, paths array<long>"


def _signatures(k: int, n_trees: int):
    """paths: for each tree its node keys at levels 1 to LEVELS."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(k)
        at = np.arange(n_trees * LEVELS).reshape(n_trees, LEVELS) % HASHES

        def out() -> Iterator[tuple]:
            for b in it:
                for i, text in rows_of(b):
                    items = shingles(text)
                    if not len(items):
                        yield i, 0, None, None, None
                        continue
                    low = signature(items)
                    key, path = np.arange(n_trees, dtype=np.uint64), []
                    for level in range(LEVELS):
                        key = _mix(key + low[at[:, level]])
                        path.append(key.view(np.int64))
                    yield i, len(items), xxhash.xxh3_128_digest(items.tobytes()), low.astype(np.uint8).tobytes(), np.stack(path, axis=1).reshape(-1).tolist()

        yield from batches(out(), _SIG)

    return run


def forest_of(root: list[int], pairs: Iterator[tuple[int, int]], linked) -> list[int]:
    """Roots after joining the pairs that are ``linked`` to what ``root`` joins; pairs that are joined already are not asked about."""
    root = list(root)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b and linked(i, j):
            root[max(a, b)] = min(a, b)
    return [find(x) for x in range(len(root))]


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compare_node(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning edges of similar signatures in each block of a node."""

    def out() -> Iterator[tuple]:
        for _, group in by_key((r for b in it for r in rows_of(b)), 2):
            if len(group) < 2:
                continue
            ids = [g[0] for g in group]
            sig = np.frombuffer(b"".join(g[1] for g in group), np.uint8).reshape(-1, HASHES)
            root = list(range(len(ids)))
            for i in range(len(ids) - 1):
                for j in (i + 1 + np.flatnonzero((sig[i + 1 :] == sig[i]).sum(axis=1) >= SIMILAR * HASHES)).tolist():
                    a, b = i, j
                    while root[a] != a:
                        a = root[a]
                    while root[b] != b:
                        b = root[b]
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        yield ids[i], ids[j]

    yield from batches(out(), _EDGE, 5000)


def components(edges: DataFrame) -> DataFrame:
    """(id, component): smallest id reachable over the edges (a, b), by alternating large and small stars.

    Either star writes a table of at most one row per edge, so that plans stay small in the driver; a hub's rows are only
    aggregated with map-side combination and joined, which AQE splits. Loops until the edges are stars around smallest ids.
    """
    both = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    both = written(both, "edges")
    while not _are_stars(both):
        around = both.union(both.select("v", "u"))
        low = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("v", "m").filter("v <> m").union(low)
        both = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
    return both.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _are_stars(both: DataFrame) -> bool:
    """Whether of the distinct edges (u, v), v < u, each u has one v, which is no other's u: then v is the smallest id of u's component."""
    ends = both.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(both.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.agg(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


def candidate_edges(reps: DataFrame, n_trees: int) -> tuple[DataFrame, DataFrame]:
    """(candidate pairs, crowded nodes as (node, doc_id)): each tree branches documents by their minwise tokens until a node is small, then compares its signatures.

    Node sizes are counted with map-side combination. Documents alone in their node are done there. A
    node that is large on the last level is crowded: its documents are compared in blocks by a hash that differs
    with the tree, its smallest and largest ones in each, which ties near copies together; what stays apart branches on
    in ``deep_links``.
    """
    rows = reps.select("doc_id", F.explode(F.expr(f"transform(sequence(0, {n_trees} - 1), t -> struct(t, slice(paths, t * {LEVELS} + 1, {LEVELS}) as p))")).alias("x"))
    rows = rows.select("doc_id", *[F.col("x.p")[k].alias(f"k{k}") for k in range(LEVELS)])
    done = []
    for level in range(LEVELS):
        key = f"k{level}"
        sizes = written(rows.groupBy(key).agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
        rows = written(join_counted(rows, sizes, key), f"level{level}")
        done.append(rows.filter(F.col("size") <= NODE).select(F.col(key).alias("node"), F.lit(0).cast("long").alias("block"), "doc_id"))
        rows = rows.filter(F.col("size") > NODE)
        if rows.isEmpty():
            break
        if level + 1 < LEVELS:
            rows = rows.drop("size", key)
    crowded = rows.select(F.col(key).alias("node"), "doc_id", "size")
    blocks = F.ceil(F.col("size") / NODE)
    done.append(crowded.select("node", F.pmod(F.xxhash64("doc_id", "node"), blocks).alias("block"), "doc_id"))
    ends = crowded.groupBy("node").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.max(blocks).alias("n"))
    done.append(ends.select("node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("block"), "x", "y").select("node", "block", F.explode(F.array("x", "y")).alias("doc_id")))
    nodes = done[0]
    for d in done[1:]:
        nodes = nodes.unionByName(d)
    nodes = nodes.join(reps.select("doc_id", "sig"), "doc_id").select("node", "block", "doc_id", "sig")
    dealt = nodes.repartition(partitions(reps.sparkSession), "node", "block").sortWithinPartitions("node", "block", "doc_id")
    return written(dealt.mapInArrow(_compare_node, "a long, b long").filter("a <> b").distinct(), "candidates"), crowded.drop("size")


_SETS = pa.schema([("cc", pa.int64()), ("doc_id", pa.int64()), ("items", pa.binary())])


def _sets(k: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(k)
        yield from batches(((cc, i, shingles(t).tobytes()) for b in it for cc, i, t in rows_of(b)), _SETS)

    return run


def _link_block(percent: int):
    """Edges that join the exactly linked documents of each block; those that share a label are joined already."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for _, group in by_key((r for b in it for r in rows_of(b)), 2):
                ids = [g[0] for g in group]
                sets = [np.frombuffer(g[1], np.uint64) for g in group]
                first: dict[int, int] = {}
                start = [first.setdefault(g[2], n) for n, g in enumerate(group)]

                def linked(i: int, j: int) -> bool:
                    x, y = sets[i], sets[j]
                    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                        return False
                    both = np.concatenate([x, y])
                    both.sort(kind="stable")
                    shared = int((both[1:] == both[:-1]).sum())
                    return 100 * shared >= percent * (len(both) - shared)

                for x, r in enumerate(forest_of(start, ((i, j) for j in range(1, len(ids)) for i in range(j)), linked)):
                    if x != r and ids[x] != ids[r]:
                        yield ids[r], ids[x]

        yield from batches(out(), _EDGE, 5000)

    return run


def _blocks(sets: DataFrame, percent: int) -> DataFrame:
    """Links of (cc, block, doc_id, items, label), block by block."""
    dealt = sets.repartition(partitions(sets.sparkSession), "cc", "block").sortWithinPartitions("cc", "block", "doc_id")
    return dealt.select("cc", "block", "doc_id", "items", "label").mapInArrow(_link_block(percent), "a long, b long")


def exact_edges(docs: DataFrame, groups: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(edges of exact links inside the candidate groups (id, cc), on full sets; the groups over BLOCK documents as (node, doc_id)).

    A group of at most BLOCK documents is one block, of which all pairs not joined yet are compared. A
    larger one is cut into blocks, each of which also holds four documents of the group, so that near copies become
    one component; what stays apart in it branches on in ``deep_links``. No task holds a whole group.
    """
    sizes = written(groups.groupBy("cc").agg(F.count("*").alias("size")), "sizes")
    groups = written(join_counted(groups, sizes, "cc"), "groups")
    texts = join_small(docs, groups.select("id", "cc").withColumnRenamed("id", "doc_id"), ["doc_id"])
    sets = written(texts.select("cc", "doc_id", "t").mapInArrow(_sets(k), "cc long, doc_id long, items binary"), "sets")
    count = F.ceil(F.col("size") / BLOCK)
    placed = sets.join(groups.select(F.col("id").alias("doc_id"), "size"), "doc_id").withColumn("block", F.pmod(F.xxhash64("doc_id", "cc"), count))
    columns = ["cc", "block", "doc_id", "items", F.col("doc_id").alias("label")]
    large = groups.filter(F.col("size") > BLOCK)
    if large.isEmpty():
        return written(_blocks(placed.select(columns), percent), "links"), large.select(F.col("cc").alias("node"), F.col("id").alias("doc_id"))
    h = F.struct(F.xxhash64("id").alias("h"), F.col("id"))
    pivots = large.groupBy("cc").agg(F.min("id").alias("p0"), F.max("id").alias("p1"), F.min(h)["id"].alias("p2"), F.max(h)["id"].alias("p3"), F.max(count).alias("n"))
    pivots = pivots.select(F.explode(F.array_distinct(F.array("p0", "p1", "p2", "p3"))).alias("doc_id"), "n")
    pivots = sets.join(pivots, "doc_id").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).select(columns)
    found = written(_blocks(placed.select(columns).unionByName(pivots), percent), "links")
    return found, large.select(F.xxhash64("cc", F.lit("group")).alias("node"), F.col("id").alias("doc_id"))


_LONG_SIG = pa.schema([("doc_id", pa.int64()), ("sketch", pa.binary()), ("nodes", pa.list_(pa.int64()))])


def _long_signatures(k: int, depth: int, n_trees: int):
    """Sketch of LONG bytes and the node of each tree at the depth."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(k)
        order = np.random.default_rng(depth)
        at = np.concatenate([order.permutation(LONG) for _ in range(-(-n_trees * depth // LONG))])[: n_trees * depth].reshape(n_trees, depth)

        def out() -> Iterator[tuple]:
            for b in it:
                for i, text in rows_of(b):
                    low = signature(shingles(text), _LONG_A, _LONG_B)
                    key = np.arange(n_trees, dtype=np.uint64) + np.uint64(depth << 32)
                    for level in range(depth):
                        key = _mix(key + low[at[:, level]])
                    yield i, low.astype(np.uint8).tobytes(), key.view(np.int64).tolist()

        yield from batches(out(), _LONG_SIG, 500)

    return run


_MEMBER = pa.schema([("cc", pa.int64()), ("block", pa.int64()), ("doc_id", pa.int64()), ("label", pa.int64())])


def _compare_crowded(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (node, cell, role, doc_id, label, sketch): role 2 against role 3, of other labels. Documents tied by similar sketches are a block to compare in full."""

    def out() -> Iterator[tuple]:
        for (node, cell), group in by_key((r for b in it for r in rows_of(b)), 2):
            outside = sum(g[0] == 2 for g in group)
            if not 0 < outside < len(group):
                continue
            sig = np.frombuffer(b"".join(g[3] for g in group), np.uint8).reshape(-1, LONG)
            label = np.array([g[2] for g in group])
            inner, pairs = sig[outside:], []
            for i in range(outside):
                hit = np.flatnonzero(((inner == sig[i]).sum(axis=1) >= LONG_SIMILAR * LONG) & (label[outside:] != label[i]))
                pairs.extend((i, outside + j) for j in hit.tolist())
            if not pairs:
                continue
            tied = {x for p in pairs for x in p}
            for x, r in enumerate(forest_of(list(range(len(group))), iter(pairs), lambda i, j: True)):
                if x in tied:
                    yield node, (cell << 20) + r, group[x][1], group[x][2]

    yield from batches(out(), _MEMBER, 5000)


def _apart(members: DataFrame, labels: DataFrame, tag: str) -> tuple[DataFrame, DataFrame]:
    """(node, doc_id, label) of the nodes with more than one label; and (node, main, size, outside): their commonest label and the documents without it."""
    rows = written(members.distinct().join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id")), tag)
    parts = rows.groupBy("node", "label").agg(F.count("*").alias("n"))
    nodes = parts.groupBy("node").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size"), F.count("*").alias("labels")).filter("labels > 1")
    nodes = written(nodes.select("node", F.col("top.label").alias("main"), "size", (F.col("size") - F.col("top.n")).alias("outside")), tag)
    return rows, nodes


def deep_links(docs: DataFrame, members: DataFrame, labels: DataFrame, k: int, percent: int) -> DataFrame | None:
    """Exact links between crowded documents of different labels (doc_id, label: components so far); None if there is nothing to compare.

    ``members`` (node, doc_id) are crowded sets. The documents of sets with more than one label branch on from the
    root, in independent trees of each of DEPTHS. In a node, the documents outside its largest component are
    compared with all of it by long sketches, in cells of at most OUTSIDE of both kinds, and what resembles each other on
    full sets. A node with more than WIDE * OUTSIDE such documents branches on at the next depth; on the last one it is
    compared all the same, in more cells. So the rows of a family that is not linked grow with its documents.
    """
    _, nodes = _apart(members, labels, "crowded")
    if nodes.isEmpty():
        return None
    open_docs = join_counted(members, nodes.select("node", "size"), "node").select("doc_id").distinct()
    found = []
    for depth in DEPTHS:
        texts = join_small(docs, written(open_docs, "open"), ["doc_id"], "left_semi").dropDuplicates(["doc_id"])
        deep = written(texts.select("doc_id", "t").mapInArrow(_long_signatures(k, depth, trees(percent / 100, depth)), "doc_id long, sketch binary, nodes array<long>"), "sketches")
        rows, nodes = _apart(deep.select("doc_id", F.explode("nodes").alias("node")), labels, f"depth{depth}")
        ready = nodes if depth == DEPTHS[-1] else nodes.filter(F.col("outside") <= WIDE * OUTSIDE)
        placed = join_counted(rows, ready, "node")
        cells, strips = F.ceil(F.col("size") / OUTSIDE), F.ceil(F.col("outside") / OUTSIDE)
        at = lambda strip, cell: (strip * 1_000_003 + cell).alias("cell")
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
        strip, cell = F.pmod(F.xxhash64("doc_id", F.lit(7)), strips), F.pmod(F.xxhash64("doc_id", "node"), cells)
        columns = ["node", "doc_id", "label"]
        inner = placed.select(*columns, cell.alias("c"), every(strips).alias("s")).select(*columns, at(F.col("s"), F.col("c")), F.lit(3).alias("role"))
        outer = placed.filter("label <> main").select(*columns, strip.alias("s"), every(cells).alias("c")).select(*columns, at(F.col("s"), F.col("c")), F.lit(2).alias("role"))
        grid = inner.unionByName(outer).join(deep.select("doc_id", "sketch"), "doc_id").select("node", "cell", "role", "doc_id", "label", "sketch")
        dealt = grid.repartition(partitions(docs.sparkSession), "node", "cell").sortWithinPartitions("node", "cell", "role", "doc_id")
        blocks = written(dealt.mapInArrow(_compare_crowded, "cc long, block long, doc_id long, label long").distinct(), "blocks")
        sets = join_small(docs, written(blocks.select("doc_id").distinct(), "compared"), ["doc_id"], "left_semi").dropDuplicates(["doc_id"])
        sets = sets.select(F.lit(0).cast("long").alias("cc"), "doc_id", "t").mapInArrow(_sets(k), "cc long, doc_id long, items binary")
        found.append(written(_blocks(blocks.join(sets.select("doc_id", "items"), "doc_id"), percent), "links"))
        late = nodes.filter(F.col("outside") > WIDE * OUTSIDE).select("node", "size")
        if depth == DEPTHS[-1] or late.isEmpty():
            break
        open_docs = join_counted(rows, late, "node").select("doc_id").distinct()
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    A document is the set of its distinct k-word shingles, after A-Z are lower-cased (with fewer words,
    the whole sequence is the one shingle); two are linked if their sets' Jaccard similarity is at least
    ``percent`` / 100, confirmed on the full sets. Documents with equal sets are one representative.

    Null and wordless texts have an empty set, are linked with nothing and kept. Rows that share an id and a set
    get the same component; those that share an id only are linked apart, each with what resembles its own text. A null
    id gets a null component and is not kept unless its set is empty. An empty table gives no rows. Other columns
    are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    n = trees(percent / 100)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("t"))
    sigs = written(rows.mapInArrow(_signatures(k, n), _SIG_DDL), "signatures")
    some = sigs.filter("n_shingles > 0 and doc_id is not null")
    heads = written(some.groupBy("set_hash").agg(F.min("doc_id").alias("head"), F.count("*").alias("size")), "heads")
    if not heads.groupBy("head").count().filter("count > 1").isEmpty():
        return _by_row(docs, id_col, text_col, k, percent)
    reps = some.join(heads.select(F.col("head").alias("doc_id")).distinct(), "doc_id", "left_semi").select("doc_id", "sig", "paths").dropDuplicates(["doc_id"])
    reps = written(reps, "representatives")
    pairs, crowded = candidate_edges(reps, n)
    groups = components(pairs)
    groups = groups.union(groups.select(F.col("component").alias("id"), "component")).distinct().withColumnRenamed("component", "cc")
    linked, large = exact_edges(rows, groups, k, percent)
    found = components(linked)
    members = crowded.unionByName(large)
    if not members.isEmpty():
        more = deep_links(rows, members, found.select(F.col("id").alias("doc_id"), F.col("component").alias("label")), k, percent)
        found = found if more is None else components(linked.unionByName(more))
    ids = join_counted(sigs.select("doc_id", "n_shingles", "set_hash"), heads, "set_hash", "left").drop("size")
    out = ids.join(found, ids["head"] == found["id"], "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component", "head", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == component, F.col("n_shingles") == 0)
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _by_row(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """``near_duplicates`` where an id has several texts: rows are written with numbers, linked by number, and named by the smallest id of their component."""
    rows = written(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row")), "numbered")
    named = rows.filter("id is not null").select("row", "text")
    found = near_duplicates(named, "row", "text", k, percent).drop("kept").join(rows.select("row", "id"), "row")
    found = written(found.select("id", "n_shingles", "component_id"), "rows")
    names = written(found.groupBy("component_id").agg(F.min("id").alias("name"), F.count("*").alias("size")), "names")
    out = join_counted(found, names, "component_id").select(F.col("id").alias(id_col), "n_shingles", F.col("name").alias("component_id"), (F.col("id") == F.col("name")).alias("kept"))
    none = near_sets(rows.filter("id is null").select("text"), k)
    return out.unionByName(none.select(F.lit(None).cast("long").alias(id_col), "n_shingles", F.lit(None).cast("long").alias("component_id"), (F.col("n_shingles") == 0).alias("kept")))


def near_sets(texts: DataFrame, k: int) -> DataFrame:
    """n_shingles of each text."""
    sized = texts.select(F.lit(0).cast("long").alias("cc"), F.lit(0).cast("long").alias("doc_id"), utf8(F.col("text")).alias("t")).mapInArrow(_sets(k), "cc long, doc_id long, items binary")
    return sized.select((F.octet_length("items") / 8).cast("long").alias("n_shingles"))


def op3_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)
