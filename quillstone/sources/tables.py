"""A store of keyed tables: several change at once, only the rows that change are written, and rules are tested before.

A version is a small file that names, for each table and label, the folders that hold its rows. A label is a bucket of the
key or, of a table with parts, a part's name. The next version is a file that can be made only once: of two
writers one makes it, and the other applies its change to what the first has left.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.metadata import last_wins
from .sinks import bounded, kept, swept

c = F.col
#: Layers of changes on a bucket; the change after them writes the bucket anew.
LAYERS = 8
#: A column that marks keys as removed, in the layers alone.
GONE = "__gone"
#: A column that marks rows which only bring values to others.
FILL = "__fill"
#: Rows of a table whose ids are broadcast to test references; those of more are dealt.
BROADCAST_IDS = 100_000
#: Tries of a writer that others overtake.
TRIES = 20


@dataclass(frozen=True)
class Table:
    """How a table is kept and what holds for its rows.

    Rows are unique by ``key``. With ``part``, a column, rows are replaced by its values, else they are upserted in
    ``buckets`` of the key; that number is fixed by the table's first version. A table that ``grows`` gets new keys only, so that layers
    are read side by side and never merged. Rules: columns that are ``required``, columns that are
    ``unique`` over the table, columns that refer to (table, column), and checks as SQL, which a null passes.
    """

    key: tuple[str, ...]
    part: str | None = None
    buckets: int = 64
    grows: bool = False
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    refers: dict[str, tuple[str, str]] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)


def packed(rows: DataFrame, column: str) -> Column:
    """A text that ends in 64 hexadecimal digits, as ids do, as bytes of half the length; other texts as theirs. No two give the same. Values that are no text stay."""
    text = c(column)
    if rows.schema[column].dataType.typeName() != "string":
        return text
    short = F.concat(F.unhex(F.right(text, F.lit(64))), F.left(text, F.length(text) - 64).cast("binary"), F.lit(b"\x01"))
    return F.when(text.rlike("[0-9a-f]{64}\\z"), short).otherwise(F.concat(text.cast("binary"), F.lit(b"\x00")))


def unpacked(rows: DataFrame, column: str) -> Column:
    """What was ``packed``."""
    if rows.schema[column].dataType.typeName() != "binary":
        return c(column)
    part = lambda first, n: F.substr(c(column), F.lit(first), n)
    n = F.length(column)
    return F.when(part(-1, F.lit(1)) == F.lit(b"\x01"), F.concat(part(33, n - 33).cast("string"), F.lower(F.hex(part(1, F.lit(32)))))).otherwise(part(1, n - 1).cast("string"))


class BrokenRulesError(ValueError):
    def __init__(self, counts: dict[str, int]) -> None:
        super().__init__(f"rows break rules: {counts}")
        self.counts = counts


@dataclass
class Change:
    """Rows written for a table, not yet in a version: the labels they touch, which of these they replace, and the folders these had before."""

    name: str
    folder: str
    labels: list[str]
    replaced: set[str]
    before: dict[str, list[str]]
    schema: str

    def applied(self, version: dict) -> None:
        entry = version["tables"].setdefault(self.name, {"labels": {}, "buckets": None})
        entry["schema"] = self.schema
        for label in self.labels:
            entry["labels"][label] = [*([] if label in self.replaced else entry["labels"].get(label, [])), self.folder]


class Store:
    """Tables under ``root``, in any store that Spark reads and whose rename refuses a target that is there."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Table]) -> None:
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        self._staged: dict[DataFrame, Change] = {}
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(self.root).getFileSystem(self.conf)

    # Versions

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def _listed(self, folder: str) -> list:
        path = self._path(f"{self.root}/{folder}")
        return list(self.fs.listStatus(path)) if self.fs.exists(path) else []

    def latest(self) -> tuple[int, dict]:
        """(number, contents) of the newest version; 0 of an empty store."""
        number = max((int(f.getPath().getName()) for f in self._listed("_versions")), default=0)
        return number, self._version(number) if number else {"tables": {}}

    def _version(self, number: int) -> dict:
        stream = self.fs.open(self._path(f"{self.root}/_versions/{number:020d}"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _made(self, number: int, version: dict) -> bool:
        """Whether this writer made the version: its text is written aside, then takes the name if nobody has."""
        draft, target = (self._path(f"{self.root}/{x}") for x in (f"_drafts/{uuid.uuid4().hex}", f"_versions/{number:020d}"))
        out = self.fs.create(draft)
        out.write(bytearray(json.dumps(version).encode()))
        out.close()
        self.fs.mkdirs(target.getParent())
        try:
            if self.fs.getUri().getScheme() == "file":  # a local rename would replace the other's file
                local = lambda p: self.jvm.java.nio.file.Paths.get(self.fs.makeQualified(p).toUri())
                self.jvm.java.nio.file.Files.createLink(local(target), local(draft))
            else:
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
                context.rename(draft, target, self.spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        finally:
            self.fs.delete(draft, False)
        return True

    # Reading

    def read(self, name: str, version: dict | None = None, labels: set[str] | None = None) -> DataFrame | None:
        """The table's rows, of some labels only if given; None if there is no such table. Changed rows hide those under them."""
        entry = (version or self.latest()[1])["tables"].get(name)
        if entry is None:
            return None
        schema = StructType.fromJson(json.loads(entry["schema"]))
        live = {label: folders for label, folders in entry["labels"].items() if folders and (labels is None or label in labels)}
        single: dict[str, list[str]] = {}
        layers: dict[str, list[tuple[int, str]]] = {}
        for label, folders in live.items():
            if len(folders) == 1 or self.tables[name].grows:
                for folder in folders:
                    single.setdefault(folder, []).append(label)
            else:
                for place, folder in enumerate(folders):
                    layers.setdefault(folder, []).append((place, label))
        out = [self._rows(folder, schema, found).drop("__label") for folder, found in single.items()]
        if layers:
            stacked = None
            for folder, found in layers.items():
                place = F.create_map(*[F.lit(x) for at, label in found for x in (label, at)])
                rows = self._rows(folder, schema, [label for _, label in found]).withColumn("__place", place[c("__label")])
                stacked = rows if stacked is None else stacked.unionByName(rows)
            key = list(self.tables[name].key)
            newest = [F.max_by(x, "__place").alias(x) for x in schema.names if x not in key]  # one by one, so that columns nobody asks for are not read
            rows = stacked.groupBy(*key)
            out.append(rows.agg(*newest).select(*schema.names) if newest else stacked.select(*key).distinct())
        whole = self.spark.createDataFrame([], schema) if not out else out[0]
        for rows in out[1:]:
            whole = whole.unionByName(rows)
        return whole.filter(f"{GONE} is null").drop(GONE) if GONE in schema.names else whole

    def _rows(self, folder: str, schema: StructType, labels: list[str] | None) -> DataFrame:
        """Rows of a folder under some labels, or all, with the label; columns that the table has got since are null."""
        rows = self.spark.read.schema(StructType([*schema.fields]).add("__label", "string")).parquet(f"{self.root}/{folder}")
        return rows if labels is None else rows.filter(c("__label").isin(labels))

    def has(self, name: str) -> bool:
        return name in self.latest()[1]["tables"]

    def near(self, name: str, rows: DataFrame) -> DataFrame | None:
        """The table's rows in the buckets of the given rows' keys; None if there is no such table."""
        version = self.latest()[1]
        if name not in version["tables"]:
            return None
        return self.read(name, version, {r[0] for r in rows.select(self._label(name, version)).distinct().collect()})

    # Changes

    def _label(self, name: str, version: dict) -> Column:
        table = self.tables[name]
        if table.part:
            return c(table.part).cast("string")
        buckets = version["tables"].get(name, {}).get("buckets") or table.buckets
        return F.pmod(F.xxhash64(*table.key), F.lit(buckets)).cast("string")

    def _written(self, name: str, rows: DataFrame, labels: list[str], replaced: set[str], version: dict, fill: list[str] | None = None) -> Change:
        folder = f"data/{uuid.uuid4().hex}/{name}"
        if self.tables[name].part and len(labels) == 1:  # a part may be the whole table: its rows stay in the tasks that have them
            dealt = rows
        elif self.tables[name].part:
            dealt = rows.repartition("__label", *self.tables[name].key)
        else:
            dealt = rows.repartition(max(1, min(len(labels), 1000)), "__label")
        if fill:  # the window is over the buckets as dealt, so it moves nothing
            w = Window.partitionBy("__label", *self.tables[name].key)
            dealt = dealt.withColumns({x: F.coalesce(F.max(F.when(c(FILL), c(x))).over(w), c(x)) for x in fill}).filter(~c(FILL)).drop(FILL)
        with swept(self.spark):
            dealt.write.option("compression", "zstd").partitionBy("__label").parquet(f"{self.root}/{folder}")
        return self._change(name, folder, rows.drop("__label", FILL).schema, labels, replaced, version)

    def _change(self, name: str, folder: str, schema: StructType, labels: list[str], replaced: set[str], version: dict) -> Change:
        entry = version["tables"].get(name, {"labels": {}})
        if "schema" in entry:  # columns are added, never lost
            old = StructType.fromJson(json.loads(entry["schema"]))
            schema = StructType([*old.fields, *[f for f in schema.fields if f.name not in old.names]])
        return Change(name, folder, labels, replaced, {x: entry["labels"].get(x, []) for x in labels}, schema.json())

    def staged(self, name: str, rows: DataFrame, labels: list[str]) -> DataFrame:
        """Rows of the named parts written where a version can name them, and read again. ``replace`` by this very frame writes nothing.

        Until a version names the folder, only its age keeps it from ``vacuum``.
        """
        own = self._written(name, rows.withColumn("__label", self._label(name, {})), labels, set(labels), {"tables": {}})
        found = self._rows(own.folder, StructType.fromJson(json.loads(own.schema)), None).drop("__label")
        self._staged[found] = own
        return found

    def upsert(self, name: str, rows: DataFrame, order: str | None = None, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None, gone: DataFrame | None = None, settled: bool = False, fill: DataFrame | None = None) -> Callable[[dict], Change]:
        """The change that puts rows over those of their keys: the last by ``order``, what ``merge(old, new)`` makes of them, or the new ones. Rows of the keys in ``gone`` are removed.

        Only rows of these keys are written, as a layer; a bucket with LAYERS of them is written anew. Old rows are
        read from the touched buckets alone. Rows are written aside first, since they are made several times, unless they are
        ``settled``: made of tables by expressions that give the same each time. ``fill``, unique by key and with keys of ``rows``, has values that take
        the place of theirs where it is not null; it goes into the buckets with the rows, so that these move once.
        """
        table = self.tables[name]
        written: list[DataFrame] = []

        def change(version: dict) -> Change:
            if not written:
                once = (lambda df: df) if settled else (lambda df: kept(df, name))
                written.append(once(rows))
                written.append(written[0].select(*table.key).limit(0) if gone is None else once(gone.select(*table.key).distinct()))
            keys = written[0].select(*table.key).unionByName(written[1])
            labels = sorted(r[0] for r in keys.select(self._label(name, version)).distinct().collect())
            entry = version["tables"].get(name, {"labels": {}})
            full = {x for x in labels if len(entry["labels"].get(x, [])) >= LAYERS}
            new, key = written[0], list(table.key)
            touched = None if table.grows and not full else self.read(name, version, set(labels))
            old = new.limit(0) if touched is None else touched
            known = old.join(new.select(*key).distinct(), key, "left_semi")
            removed = written[1].join(new.select(*key), key, "left_anti").withColumn(GONE, F.lit(True))
            out = merge(known, new) if merge else last_wins(known.unionByName(new, allowMissingColumns=True), key, [order]) if order else new
            if full:
                rest = self.read(name, version, full).join(keys.distinct(), key, "left_anti")
                out = out.unionByName(rest, allowMissingColumns=True)
            if gone is not None:
                out = out.unionByName(removed, allowMissingColumns=True)
            brought = None if fill is None else [x for x in fill.columns if x not in key]
            if brought is not None:
                out = out.withColumn(FILL, F.lit(False)).unionByName(fill.withColumn(FILL, F.lit(True)), allowMissingColumns=True)
            return self._written(name, out.withColumn("__label", self._label(name, version)), labels, full, version, brought)

        return change

    def replace(self, name: str, rows: DataFrame, labels: list[str]) -> Callable[[dict], Change]:
        """The change that makes ``rows`` the only ones of the named parts. Rows of other parts are an error; folders of other parts stay as they are.

        Rows that are ``staged`` for the table are named where they lie, others are written.
        """

        def change(version: dict) -> Change:
            own = self._staged.get(rows)
            if own and own.name == name:
                own = self._change(name, own.folder, StructType.fromJson(json.loads(own.schema)), labels, set(labels), version)
            else:
                own = self._written(name, rows.withColumn("__label", self._label(name, version)), labels, set(labels), version)
            found = {r[0] for r in self._rows(own.folder, StructType.fromJson(json.loads(own.schema)), None).select("__label").distinct().collect()}
            if found - set(labels):
                raise BrokenRulesError({f"{name}: rows of other parts": len(found - set(labels))})
            return own

        return change

    def commit(self, *changes: Callable[[dict], Change]) -> int:
        """Make a version with all the changes, or none if their rows break a rule; the version's number.

        If another writer was first, changes whose labels it left alone are kept as written and the others are made
        anew; rules are tested again.
        """
        done: list[Change | None] = [None] * len(changes)
        for _ in range(TRIES):
            number, version = self.latest()
            for k, change in enumerate(changes):
                own = done[k]
                now = version["tables"].get(own.name, {"labels": {}})["labels"] if own else {}
                if own is None or any(now.get(x, []) != folders for x, folders in own.before.items()):
                    done[k] = change(version)
            after = json.loads(json.dumps(version))
            for own in done:
                own.applied(after)
                if after["tables"][own.name]["buckets"] is None:
                    after["tables"][own.name]["buckets"] = self.tables[own.name].buckets
            with swept(self.spark):
                broken = {r["rule"]: r["n"] for r in self.faults(version, after, done).groupBy("rule").agg(F.count("*").alias("n")).collect()}
            if broken:
                raise BrokenRulesError(broken)
            if self._made(number + 1, after):
                return number + 1
        raise RuntimeError(f"other writers were first {TRIES} times")

    # Rules

    def faults(self, before: dict, after: dict, changes: list[Change]) -> DataFrame:
        """(rule, key) of rows that would break a rule: of the changed rows, and of rows whose references a replaced part no longer holds.

        Changed rows are tested alone or by hash joins on their keys; other rows are read only where they are the other side. The keys of a part
        are dealt by a hash, and whole only where one repeats; references by packed ids. Each of these tests is a query of its own, so that the disk holds one.
        A folder that the version before has was tested then, and is again only with a table that it refers to.
        """
        found = [self.spark.createDataFrame([], "rule string, key string")]
        new = {own.name for own in changes if any(before["tables"].get(own.name, {"labels": {}})["labels"].get(x) != [own.folder] for x in own.labels)}
        for own in changes:
            table, name = self.tables[own.name], own.name
            if not new & {name, *(target for target, _ in table.refers.values())}:
                continue
            rows = self._rows(own.folder, StructType.fromJson(json.loads(own.schema)), own.labels).drop("__label")
            rows = rows.filter(f"{GONE} is null").drop(GONE) if GONE in rows.columns else rows
            key = list(table.key)

            def say(df: DataFrame, rule: str, key: list[str] = key, name: str = name) -> None:
                found.append(df.select(F.lit(f"{name}: {rule}").alias("rule"), F.to_json(F.struct(*key)).alias("key")))

            for column in dict.fromkeys([*key, *table.required]):
                say(rows.filter(c(column).isNull()), f"{column} is null")
            if not table.part or not rows.groupBy(F.xxhash64(*key)).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
                say(rows.groupBy(*key).count().filter("count > 1"), "key repeats")
            if table.part:
                others = set(after["tables"][name]["labels"]) - set(own.labels)
                ids = [packed(rows, x).alias(x) for x in key]
                if others and not rows.select(*ids).join(self.read(name, after, others).select(*ids), key, "left_semi").isEmpty():
                    say(rows.join(self.read(name, after, others).select(*key), key, "left_semi"), "key is in another part")
            for column in table.unique:
                names = rows.select(column).filter(c(column).isNotNull()).distinct()
                twice = self.read(name, after).join(names, column, "left_semi").groupBy(column).count().filter("count > 1")
                say(twice, f"{column} repeats", [column])
            for rule, sql in table.checks.items():
                say(rows.filter(f"NOT coalesce({sql}, true)"), rule)
            for column, (target, other) in table.refers.items():
                held = self.read(target, after)
                there = rows.filter(c(column).isNotNull())
                if held is None:
                    say(there, f"{column} is not in {target}")
                elif not there.select(packed(there, column).alias("id")).join(bounded(held.select(packed(held, other).alias("id")), BROADCAST_IDS), "id", "left_anti").isEmpty():
                    say(there.join(held.select(c(other).alias(column)), column, "left_anti"), f"{column} is not in {target}")
            if table.part and name in new and before["tables"].get(name):
                for of, column, other in [(of, x, y) for of, t in self.tables.items() for x, (target, y) in t.refers.items() if target == name and of in after["tables"]]:
                    told = {x for each in changes if each.name == of and self.tables[of].part for x in each.labels}  # these are tested for what they refer to
                    rest = set(after["tables"][of]["labels"]) - told
                    if not rest:
                        continue
                    old, left = self.read(name, before, set(own.labels)), self.read(of, after, rest)
                    gone = old.select(packed(old, other).alias("id")).join(rows.select(packed(rows, other).alias("id")), "id", "left_anti")
                    if not gone.isEmpty():
                        left = left.select(packed(left, column).alias("id")).join(gone, "id", "left_semi")
                        say(left.select(unpacked(left, "id").alias(column)), f"{other} is still named in {of}", [column])
        out = found[0]
        for rows in found[1:]:
            out = out.unionByName(rows)
        return out

    def vacuum(self, keep: int = 1, older_than: float = 3600.0) -> int:
        """Remove all but the newest versions and the folders that none of these name, if they are older than so many seconds: others may be writing. How many folders went."""
        numbers = sorted(int(f.getPath().getName()) for f in self._listed("_versions"))
        for number in numbers[:-keep]:
            self.fs.delete(self._path(f"{self.root}/_versions/{number:020d}"), False)
        named = {folder.split("/")[1] for n in numbers[-keep:] for t in self._version(n)["tables"].values() for folders in t["labels"].values() for folder in folders}
        limit = (time.time() - older_than) * 1000
        old = [f.getPath() for f in self._listed("data") if f.getPath().getName() not in named and f.getModificationTime() <= limit]
        for path in old:
            self.fs.delete(path, True)
        return len(old)


def upserted(spark: SparkSession, root: str, name: str, table: Table, rows: DataFrame, order: str | None = None, merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> Store:
    """A store of one table, after an upsert."""
    store = Store(spark, root, {name: table})
    store.commit(store.upsert(name, rows, order, merge))
    return store
